"""The thin queries ``opN_<name>`` over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe, contamination, langid, lines, perplexity, phrases, pii, resample, simhash, substrings, tokenfile, topk, urls,
)
from .common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    r AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """
)
def op1_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op2_perplexity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 1
    model = perplexity.fit(docs.filter(~held_out), order=3)
    keep = {"doc_id": F.col("doc_id"), "held_out": held_out, "train_tokens": F.lit(model.tokens).cast("long")}
    return perplexity.score(docs, model, keep)


@query()
def op3_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op4_lines(spark, sf_dir):
    """The text of every document with its duplicate lines gone, as counts and a digest."""
    docs = table(spark, sf_dir, "documents")
    left = lines.dedup_lines(docs.select("doc_id", "text", F.col("text").alias("before")))
    count = lambda c: F.when(F.length(c) > 0, F.size(F.split(c, "\n", -1))).otherwise(0)
    return left.select(
        "doc_id",
        F.coalesce(count(F.col("before")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(count(F.col("text")), F.lit(0)).cast("long").alias("n_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query(
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (
      SELECT doc_id, s, w[s : s + 19] AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
    r AS (
      SELECT doc_id, s FROM (
        SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS k FROM p) WHERE k > 1),
    g AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS k FROM r),
    c AS (SELECT doc_id, count(*) AS n, list(k) AS gone FROM g GROUP BY doc_id),
    k AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept FROM (
        SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d)
      ANTI JOIN g USING (doc_id, k) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
      sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
    """
)
def op5_substrings(spark, sf_dir):
    return substrings.digests(table(spark, sf_dir, "documents"))


@query()
def op6_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query()
def op7_bpe(spark, sf_dir):
    return bpe.digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


@query()
def op8_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


@query(
    r"""
    WITH u AS (
      SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched,
        lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#@]*@)?([^/:?#]*)', 2)) AS host,
        list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
          lambda x : x <> '') AS steps
      FROM pages),
    e AS (
      SELECT DISTINCT
        CASE page_id % 3 WHEN 0 THEN 'allow' WHEN 1 THEN 'adult' ELSE 'spam' END AS list,
        CASE WHEN page_id % 2 = 0 OR len(steps) = 0 THEN host ELSE host || '/' || steps[1] END AS pattern,
        CASE WHEN page_id % 5 = 0 THEN 'remove' ELSE 'add' END AS action,
        DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS dated
      FROM u WHERE host <> ''),
    l AS (SELECT list, pattern, dated, max(action) AS action FROM e GROUP BY ALL),
    i AS (
      SELECT list, pattern, dated AS since, action,
        lead(dated) OVER (PARTITION BY list, pattern ORDER BY dated) AS until FROM l),
    k AS (
      SELECT page_id, fetched, unnest(list_distinct(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1),
          lambda n : array_to_string(string_split(host, '.')[n:], '.')),
        list_transform(range(1, len(steps) + 1),
          lambda n : host || '/' || array_to_string(steps[1:n], '/'))))) AS pattern
      FROM u WHERE host <> ''),
    f AS (
      SELECT page_id, list, pattern, since, count(*) OVER (PARTITION BY page_id) AS n_active,
        row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, pattern DESC, list DESC) AS place
      FROM k JOIN i USING (pattern)
      WHERE action = 'add' AND since <= fetched AND (until IS NULL OR fetched < until))
    SELECT u.page_id, url, fetched, coalesce(list <> 'allow', false) AS blocked, list, pattern, since,
      CAST(coalesce(n_active, 0) AS BIGINT) AS n_active
    FROM u LEFT JOIN f ON u.page_id = f.page_id AND place = 1
    """
)
def op9_urls(spark, sf_dir):
    """Every page is a capture, and names one dated entry of a list: its host, or host and first step."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    page = F.col("page_id")
    keys, host = urls.keys_of(F.col("url")), urls.host_of(F.col("url"))
    step = F.get(F.filter(keys, lambda k: k.contains("/")), F.lit(0))
    entries = pages.filter(host != "").select(
        F.when(page % 3 == 0, urls.ALLOW).when(page % 3 == 1, "adult").otherwise("spam").alias("list"),
        F.when(page % 2 == 0, host).otherwise(F.coalesce(step, host)).alias("pattern"),
        F.when(page % 5 == 0, "remove").otherwise("add").alias("action"),
        day(page * 37 % 366).alias("dated"),
    )
    return urls.evaluate(pages.withColumn("fetched", day(page % 366)), entries)


@query(
    r"""
    WITH d AS (
      SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    i AS (
      SELECT DISTINCT item_id, w[s : s + least(10, len(w)) - 1] AS win
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
    n AS (SELECT DISTINCT len(win) AS n FROM i),
    p AS (
      SELECT doc_id, s, w[s : s + n - 1] AS win
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, n WHERE len(w) >= n)),
    h AS (SELECT doc_id, s, len(win) AS n, item_id FROM p JOIN i USING (win)),
    c AS (
      SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM h) GROUP BY doc_id),
    t AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
    """
)
def op10_contamination(spark, sf_dir):
    found = contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    r"""
    WITH p AS (
      SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
    f AS (
      SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda s : array_to_string(w[s : s + m - 1], ' '))) AS phrase
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
      GROUP BY ALL HAVING count(*) >= 30),
    c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE m > 1),
    k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
    s AS (
      SELECT k.lang, k.m, k.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score,
        row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY (2000000::HUGEINT * a) // (x.f + y.f), k) AS place
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(v[1 : k], ' ')
        JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(v[k + 1 : k.m], ' ')),
    i AS (
      SELECT lang, array_to_string(v[s : s + z - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT *, unnest(range(1, m - z + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS z FROM c)) GROUP BY 1, 2),
    o AS (
      SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
      FROM s LEFT JOIN i ON i.lang = s.lang AND i.phrase = s.phrase
      WHERE place = 1 AND NOT coalesce(100 * longer::HUGEINT >= 80 * a::HUGEINT, false))
    SELECT o.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000
    """
)
def op11_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH u AS (
      SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    d AS (
      SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM u),
    f AS (
      SELECT side, doc_id, unnest(list_transform(range(1, len(w) - m + 2),
        lambda s : array_to_string(w[s : s + m - 1], ' '))) AS feature
      FROM d, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m),
    b AS (
      SELECT list_transform(range(256), lambda c : list_reduce(list_concat([c], list_transform(range(8), lambda z : z)),
        lambda a, z : CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
    x AS (SELECT feature, hex(feature) AS h FROM (SELECT DISTINCT feature FROM f)),
    k AS (
      SELECT feature, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(len(h) // 2), lambda i : CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT))),
        lambda a, z : xor(a >> 8, crc[1 + (xor(a, z) & 255)]))) % 10000 AS bucket
      FROM x, b),
    c AS (
      SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
      FROM f JOIN k USING (feature) GROUP BY bucket),
    g AS (
      SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM c),
    v AS (
      SELECT doc_id, count(*) AS n_features, sum(gain) AS weight
      FROM f JOIN k USING (feature) JOIN g USING (bucket) WHERE side = 'd' GROUP BY doc_id),
    z AS (
      SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
        CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1 : 8] AS BIGINT) + 0.5::DOUBLE)
          / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN v USING (doc_id) WHERE side = 'd'),
    r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM z)
    SELECT doc_id, n_features, weight, score,
      CASE WHEN n_words >= 20 AND place <= 5 * (SELECT count(*) FROM z WHERE n_words >= 20) // 100 THEN place END AS rank
    FROM r
    """
)
def op12_resample(spark, sf_dir):
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_tokens(spark, sf_dir):
    return tokenfile.digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )
