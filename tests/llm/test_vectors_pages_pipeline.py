"""Top-k, archives and the pipeline, against brute force."""

import gzip
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from evidencepanel.llm import queries, topk, warc
from oracle import difference, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.ORACLE_SQL[name]) == ""


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names and len(queries.QUERIES) == 10


# ------------------------------------------------------------------------ vectors
def brute_top(rows, k):
    used = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for q, a in {i: v for i, v in used if i % 3 == 0}.items():
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in used if i != q and len(b) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_top_k(spark):
    random.seed(8)
    rows = [(i, [random.uniform(-1, 1) for _ in range(4)]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(120, 140)]  # ties
    rows += [(140, None), (141, [1.0, None, 0.0, 0.0]), (142, [float("nan")] * 4), (143, [float("inf"), 0.0, 0.0, 0.0]), (144, [1.0, 2.0]), (147, [2.0, 2.0]), (None, [1.0] * 4), (150, [])]
    rows += [(151, [1e7, 1e7, 1e7, -1e7])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(5)
    got = sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 3 == 0, 10).collect())
    assert got == brute_top(rows, 10)
    assert topk.top_k(table.where("false"), F.lit(True)).count() == 0


def test_tiles_of_any_size_agree(spark, monkeypatch):
    random.seed(9)
    rows = [(i, [random.gauss(0, 1) for _ in range(3)]) for i in range(300)]
    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 30)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 3 == 0, 5).collect())
    assert got == brute_top(rows, 5)


# ------------------------------------------------------------------------- archives
def test_archive_round_trip(spark, tmp_path):
    big = "<p>" + "x\r\n\r\n" * 100
    rows = [
        (3, "http://a.example/x?q=1", big),
        (1, "https://www.B.example:80/y", big),
        (2, None, None),
        (4, "http://a.example/\r\nX: y", ""),
        (5, "http://a.example/x?q=1", "short é"),
        (6, "http://a.example/x?q=1", "short é"),
        (None, "u", big),
        (7, "http://c.example", "y" * 100),
        (7, "http://c.example", "y" * 100),
    ]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    got = warc.archived_pages(pages, str(tmp_path / "w"), F.timestamp_seconds("page_id")).collect()
    assert all(r.intact for r in got) and len(got) == len(rows)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = min((j for j, _, h in rows if j is not None and h == html), default=None) if len(data) >= 100 else None
        again = first is not None and i != first
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert warc.archived_pages(pages.where("false"), str(tmp_path / "none")).count() == 0
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*.gz"))
    assert raw.count(b"WARC/1.1\r\n") == len(rows) and raw.endswith(b"\r\n\r\n")


def test_loser_tree_merges_any_runs():
    random.seed(1)
    row = lambda key: ("f", key, key, "u", str(key % 7), "t", "response", None, 0, "", True)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((row(random.randrange(50)) for _ in range(random.randrange(6))), key=warc.sort_key) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted((r for run in runs for r in run), key=lambda r: warc.sort_key(r))


def test_url_keys():
    assert warc.url_key("https://user@www.A.example:8080/P?q=1#f") == "example,a)/p?q=1"
    assert warc.url_key(None) == ")" and warc.url_key("http://x.example") == "example,x)"


# ------------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, docs):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    at = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, at, FOLDER)
        assert new.columns == table.columns, name
        assert new.join(at, "doc_id", "left_anti").count() == 0 and 0 < new.count() <= at.count()
        at = spark.createDataFrame(new.collect(), table.schema)
    got = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == {r.doc_id for r in at.select("doc_id").collect()}
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_on_awkward_rows(spark, docs, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).count() == 0, name
        out = stage(spark, docs, FOLDER)
        assert out.count() > 0 and (name == "packing" or out.columns == docs.columns)
