import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import ODD_TEXTS  # noqa: E402


@pytest.fixture
def table(spark, tmp_path):
    """Rows as a scan of files, with columns whose names may clash."""

    def build(rows, schema="doc_id long, text string"):
        extra = ", fp long, text_key string, line string, start int, blocked string, lang string, source string"
        n = len(extra.split(",")) - 1
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame([(*r, *[None] * n) for r in rows], schema + extra).coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return build


@pytest.fixture
def odd(table):
    return table(ODD_TEXTS)
