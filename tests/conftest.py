import gzip
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tomeworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores="8", partitions=4)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def land(tmp_path):
    """Land listing pages and texts the way a fetcher would."""
    return Landing(str(tmp_path / "landing"))


class Landing:
    def __init__(self, root, provider="gutenberg"):
        self.root, self.provider, self.runs = root, provider, 0

    def listing(self, records, page_size, only=None):
        """Write the records as pages of a new fetch; ``only`` limits which pages land."""
        self.runs += 1
        folder = f"{self.root}/listing/provider={self.provider}"
        os.makedirs(folder, exist_ok=True)
        pages = [records[i : i + page_size] for i in range(0, len(records), page_size)]
        for number, results in enumerate(pages, 1):
            if only is not None and number not in only:
                continue
            body = {"next": "more" if number < len(pages) else None, "results": results}
            with open(f"{folder}/page-{number:06d}.run-{self.runs}.json", "w") as out:
                json.dump(body, out, indent=1)
        return self

    def texts(self, spark, texts, mode="append"):
        rows = [(self.provider, str(k), v) for k, v in texts.items()]
        spark.createDataFrame(rows, "provider string, source_id string, text string").write.mode(
            mode
        ).parquet(f"{self.root}/texts")
        return self


@pytest.fixture
def gz(tmp_path):
    def write(name, lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wb") as out:
            out.write(b"\n".join(lines) + b"\n")
        return str(path)

    return write
