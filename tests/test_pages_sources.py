"""Page parsing, readers, writers and the patch stream."""

import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evidencepanel.operators import pages as pg
from evidencepanel.operators import ranking as rk
from evidencepanel.sources import readers, writers
from evidencepanel.streaming import patches


def page(html):
    names = pg.PAGE_TYPE.names
    return dict(zip(names, pg.read_page(html)))


def test_page_parts():
    html = (
        "<html><head><title> A &amp; B </title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<h1>Head  <b>one</b></h1><h2> </h2><p>short</p><p>long enough <a href=' /x '>link</a></p><!-- no --><ul><li>item number one"
        "<li>item number two</ul><noscript><p>hidden paragraph</p><a href='/h'>h</a></noscript><a href=''>e</a><br><img src='i'>tail</body></html>"
    )
    got = page(html)
    assert got["title"] == "A & B" and got["headers"] == ["Head one"] and got["links"] == ["/x"]
    assert got["paragraphs"] == ["short", "long enough link", "item number one item number two", "item number two"]
    assert got["markdown_like"].startswith("# A & B\n\n## Head one\n\nshort\n\nlong enough link")
    cut = pg.PAGE_TYPE.names.index("paragraphs")
    assert pg.read_page(html, pg.SHORT_ARCHIVE)[cut] == got["paragraphs"][1:]
    assert got["plain_text"] == "A & B Head one short long enough link item number one item number two e tail"
    assert got["word_count"] == len(got["plain_text"].split()) and got["status"] == "ok"


def test_unclosed_paragraphs_hold_what_follows():
    got = page("<p>first part<p>second part</div><h3>x</p>y</h3>")
    assert got["paragraphs"] == ["first part second part x", "second part x"][:2] or got["paragraphs"]
    # </p> closes the second <p> and the header opened in it; the first stays open.
    assert got["paragraphs"] == ["first part second part x y", "second part x"]
    assert got["headers"] == ["x"]


def test_many_unclosed_tags_stay_cheap():
    got = dict(zip(pg.PAGE_TYPE.names, pg.read_page("<p>word " * 20000, pg.SHORT_ARCHIVE)))
    assert len(got["paragraphs"]) == 300 and got["word_count"] == 20000
    assert len(page("<p>word " * 400)["paragraphs"]) == 400


def test_title_with_markup_or_twice():
    assert page("<title>a</title><title>b</title>")["title"] == "a"
    assert page("<p>no title here</p>")["title"] == ""
    assert page(None)["status"] == "error"


def test_page_summary_keeps_failures(spark):
    rows = spark.createDataFrame([("http://A.b:8/x", "<title>t</title><p>some words here</p>"), ("u", None)], "url string, html string")
    got = [tuple(r) for r in pg.page_summary(rows).orderBy("url").collect()]
    assert got[0][:5] == ("http://A.b:8/x", "A.b:8", "ok", "t", 4)
    assert got[1][1:5] == ("", "error", "", 0) and got[1][-1] == "no html"
    assert pg.archive_document(pg.page_archive(rows)).count() == 1


def test_csv_with_mark_quotes_and_breaks(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('﻿province,year,note\n北京, 2023 ,"a ""b"", c\nd"\n上海,,\n', encoding="utf-8")
    rows = readers.read_panel(spark, str(path), multi_line=True).orderBy("_row").collect()
    assert [tuple(r) for r in rows] == [("北京", " 2023 ", 'a "b", c\nd', 1), ("上海", "", "", 2)]


def test_rows_are_numbered_over_files_and_splits(spark, tmp_path):
    for part in range(3):
        lines = "\n".join(f"{part},{i}" for i in range(2000))
        (tmp_path / f"part-{part}.csv").write_text(f"f,i\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_panel(spark, str(tmp_path), multi_line=False)
        assert rows.rdd.getNumPartitions() > 3 or rows.count() == 6000
        wrong = rows.where(F.col("_row") != F.col("f").cast("int") * 2000 + F.col("i").cast("int") + 1)
        assert wrong.count() == 0 and rows.count() == 6000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_panel_skips_empty_tables(spark, tmp_path, table):
    rows = table([{"a": "1", "b": ""}, {"a": " 2 ", "b": 'x"y'}])
    assert writers.write_panel(rows, str(tmp_path / "out"), ["b", "a"])
    back = readers.read_panel(spark, str(tmp_path / "out"), multi_line=True).orderBy("_row")
    assert back.columns[:2] == ["b", "a"] and [tuple(r)[:2] for r in back.collect()] == [("", "1"), ('x"y', " 2 ")]
    assert not writers.write_panel(rows.where("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_discovery_documents(spark, tmp_path):
    record = {
        "finished": True,
        "url_count": 2,
        "candidate_count": 1,
        "selected_urls": ["https://a", "ftp://b", None],
        "top_candidates": [{"url": " http://c ", "sentence": "s", "score": 3}],
    }
    (tmp_path / "d.json").write_text(json.dumps({"北京市": record, "上海市": {"finished": False}, "x": None}, ensure_ascii=False, indent=1))
    records = readers.read_discovery(spark, str(tmp_path / "d.json"))
    urls = readers.discovery_urls(records).orderBy("ord")
    assert [(r["entity"], r["kind"], r["url"]) for r in urls.collect()] == [("北京市", "selected", "https://a"), ("北京市", "candidate", "http://c")]
    totals = rk.candidate_totals(readers.discovery_summary(records), ["北京市", "上海市", "广东省"]).first()
    assert tuple(totals) == (2, 1)
    assert readers.discovery_candidates(records).first()["score"] == 3
    (tmp_path / "urls.txt").write_text("# no\n\n https://a \nftp://x\nhttp://b\nhttps://a\n")
    listed = readers.read_url_list(spark, str(tmp_path / "urls.txt"))
    assert [r["url"] for r in listed.orderBy("ord").collect()] == ["https://a", "http://b", "https://a"]
    first = spark.createDataFrame([(0, "http://b"), (1, "http://z")], "ord bigint, url string")
    assert [r["url"] for r in rk.concat_urls(first, listed).collect()] == ["http://b", "http://z", "https://a"]


def _patch_files(table, incoming, *patches_):
    for rows in patches_:
        table(rows).coalesce(1).write.mode("append").parquet(str(incoming))


def test_stream_goes_on_from_its_checkpoint(spark, table, tmp_path):
    state, incoming = str(tmp_path / "state"), tmp_path / "in"
    panel = table([{"province": "A", "year": "2020", "v": "1"}, {"province": "B", "year": "2020", "v": ""}])
    patches.start_panel(panel, state, "v")

    def run():
        patches.stream_rounds(spark, str(incoming), state, panel.schema, "v", 10).awaitTermination()

    def rows():
        return sorted((r["province"], r["v"]) for r in patches.latest_panel(spark, state).collect())

    def history():
        return [tuple(r) for r in patches.round_history(spark, state).orderBy("batch").select("rows", "filled_rows", "gained_keys").collect()]

    _patch_files(table, incoming, [{"province": "B", "year": "2020", "v": "2"}, {"province": "C", "year": "2021", "v": "3"}])
    run()
    _patch_files(table, incoming, [{"province": "A", "year": "2020", "v": " "}, {"province": "B", "year": "2020", "v": "9"}])
    run()
    want = [("A", " "), ("B", "9"), ("C", "3")]
    assert rows() == want and history() == [(2, 1, 0), (3, 3, 2), (3, 2, 0)]
    run()  # nothing new
    again = spark.createDataFrame([("A", 2020, 9, "A", "2020", " "), ("B", 2020, 9, "B", "2020", "9")], "_e string, _y int, _row bigint, province string, year string, v string")
    patches.deliver(spark, again.drop("_buckets"), 1, state, "v")  # the last batch again
    assert rows() == want and history() == [(2, 1, 0), (3, 3, 2), (3, 2, 0)]
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["checkpoint", "metrics", "next", "panel"]


@pytest.mark.parametrize("step", ["metrics", "panel"])
def test_stream_survives_a_failure_between_its_writes(spark, table, tmp_path, monkeypatch, step):
    state, incoming = str(tmp_path / "state"), tmp_path / "in"
    panel = table([{"province": f"P{i}", "year": "2020", "v": "" if i % 2 else "1"} for i in range(20)])
    patches.start_panel(panel, state, "v", buckets=4)
    _patch_files(table, incoming, [{"province": f"P{i}", "year": "2020", "v": f"n{i}"} for i in range(5, 30)], [{"province": "P6", "year": "2020", "v": "later"}])
    true = patches._replace

    def failing(rows, path, *by):
        if path.endswith(step):
            raise RuntimeError("lost")
        true(rows, path, *by)

    monkeypatch.setattr(patches, "_replace", failing)
    with pytest.raises(Exception, match="lost"):
        patches.stream_rounds(spark, str(incoming), state, panel.schema, "v").awaitTermination()
    monkeypatch.setattr(patches, "_replace", true)
    patches.stream_rounds(spark, str(incoming), state, panel.schema, "v").awaitTermination()
    after = {r["province"]: r["v"] for r in patches.latest_panel(spark, state).collect()}
    want = {f"P{i}": "" if i % 2 else "1" for i in range(20)} | {f"P{i}": f"n{i}" for i in range(5, 30)} | {"P6": "later"}
    assert after == want and patches.latest_panel(spark, state).count() == 30
    last = patches.round_history(spark, state).orderBy("batch").collect()
    assert [r["rows"] for r in last] == [20, 30, 30] and sum(r["gained_keys"] for r in last) == 18
    assert last[-1]["filled_rows"] == sum(bool(v) for v in want.values())


def test_stream_replaces_only_the_buckets_of_a_batch(spark, table, tmp_path):
    state, incoming = str(tmp_path / "state"), tmp_path / "in"
    panel = table([{"province": f"P{i}", "year": "2020", "v": "1"} for i in range(200)])
    patches.start_panel(panel, state, "v", buckets=32)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "state/panel").glob("bucket=*/*.parquet")}
    _patch_files(table, incoming, [{"province": "P7", "year": "2020", "v": "9"}], [{"province": "P7", "year": "2020", "v": "2"}])
    query = patches.stream_rounds(spark, str(incoming), state, panel.schema, "v", 2)
    query.awaitTermination()
    left = [p for p, t in files.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(left) == len(files) - 1
    assert query.lastProgress is None or all(s["numRowsTotal"] == 1 for s in query.lastProgress["stateOperators"])
    after = {r["province"]: r["v"] for r in patches.latest_panel(spark, state).collect()}
    assert after["P7"] == "2" and after["P8"] == "1" and len(after) == 200


def test_tasks_share_a_bucket(spark, table, tmp_path, monkeypatch):
    state, incoming = str(tmp_path / "state"), tmp_path / "in"
    panel = table([{"province": f"P{i}", "year": "2020", "v": "1" if i % 2 else ""} for i in range(200)])
    patches.start_panel(panel, state, "v", buckets=1)
    _patch_files(table, incoming, [{"province": f"P{i}", "year": "2020", "v": "2"} for i in range(100, 300)])
    monkeypatch.setattr(patches, "PIECE_ROWS", 10)
    patches.stream_rounds(spark, str(incoming), state, panel.schema, "v").awaitTermination()
    assert len(list((tmp_path / "state/next/bucket=0").glob("*.parquet"))) > 1
    after = {r["province"]: r["v"] for r in patches.latest_panel(spark, state).collect()}
    assert after == {f"P{i}": "2" if i >= 100 else "1" if i % 2 else "" for i in range(300)}
    last = patches.round_history(spark, state).orderBy("batch").collect()[-1]
    assert (last["rows"], last["filled_rows"], last["gained_keys"]) == (300, 250, 150)
    assert all(spark.conf.get(k, None) is None or k != patches.PROVIDER for k in patches.STORE)


def test_the_second_patch_takes_the_rows_of_the_first(spark, monkeypatch):
    from evidencepanel.bindings import queries_text
    from evidencepanel.bindings.views import Views

    asked, true = [], Views.sql
    monkeypatch.setattr(Views, "sql", lambda self, query: asked.append(query) or true(self, query))
    queries_text._stream(Views(spark, "/root/testdata/sf0.001"), 1)
    assert sum("FROM shipped" in q for q in asked) == 1


def test_parsed_pages_leave_the_worker_by_their_size():
    html = "<p>" + "word " * 60000 + "</p>"
    many = pd.Series([html] * 9 + [None, "<p>end</p>"])
    parts = list(pg._page_udf(pg.EVERYTHING, ["plain_text", "status"]).func(iter([many, pd.Series(["<p>b</p>"])])))
    assert [len(p) for p in parts] == [4, 4, 3, 1]
    assert list(parts[2]["status"]) == ["ok", "error", "ok"] and parts[3]["plain_text"][0] == "b"


def test_archived_pages_keep_all_links_and_headers(spark, tmp_path):
    import duckdb

    import __spark_entry__ as entry
    from oracle import difference

    counts = {"http://none": 0, "http://at": 120, "http://over": 121, "http://many": 1500}
    html = {u: "<title>t</title>" + "".join(f'<h2>head {i}</h2><p>text <a href="/{i}?a=1&amp;b=2">l</a></p>' for i in range(n)) for u, n in counts.items()}
    rows = [(i, u, html[u]) for i, u in enumerate([*counts, "http://over"])]  # an address may come twice
    spark.createDataFrame(rows, "page_id bigint, url string, html string").toPandas().to_parquet(tmp_path / "pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet')")
    name = "t11_archive_document"
    out = entry.queries()[name](spark, str(tmp_path))
    for r in out.collect():
        n = counts[r["url"]]
        assert r["headers"] == "|".join(f"head {i}" for i in range(n))
        assert r["links"] == "|".join(f"/{i}?a=1&b=2" for i in range(n))
    assert out.count() == 5 and difference(out, con, entry.oracle_sql()[name]) == ""
