"""Physical plans, row order, skew, and ranking against a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from evidencepanel.bindings.views import Views
from evidencepanel.functions.entity import normalize_entity_join, with_other_entity
from evidencepanel.operators import panel as pan
from evidencepanel.operators import ranking as rk
from evidencepanel.operators import registry as regs
from evidencepanel.operators.mentions import mentions, name_index

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def builds():
    return entry.queries()


def test_no_nested_loops_and_no_python_outside_pages(spark, builds):
    for name, build in builds.items():
        if name.startswith(("r4", "x1", "e2", "s1", "s3", "s4", "s5", "s8", "t10_fields_of_pages", "t11", "t12", "op", "pipeline")):
            continue
        text = plan(build(spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "EvalPython" not in text and "MapInPandas" not in text, name


def test_page_parser_gets_the_html_column_only(spark, builds):
    text = plan(builds["t12_page_summary"](spark, SMALL))
    assert text.count("ArrowEvalPython") >= 1


def test_top_per_group_is_cut_below_the_shuffle(spark, builds):
    text = plan(builds["w4_cap_per_domain"](spark, SMALL))
    assert text.count("WindowGroupLimit") >= 4


def test_costly_expressions_run_once(spark, builds):
    for name, text in (("t1_split_sentences", "split("), ("t6_extract_candidates", "split("), ("w7_shortlist", "split("), ("t9_extract_with_window", "regexp_instr")):
        shown = builds[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert shown.lower().count(text) == 1, name


def test_columns_are_pruned_at_the_scan(spark, builds):
    text = plan(builds["a3_coverage_summary"](spark, SMALL))
    schemas = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert schemas and all("o_orderpriority" not in s and "c_name" not in s for s in schemas)


def test_names_in_texts_are_found_by_one_index_probe_a_gram(spark, builds):
    for name in ("t5_names_in_texts", "t6_extract_candidates_large", "w7_shortlist_large"):
        shown = builds[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(" not in shown and 1 <= shown.count("explode(array_distinct(concat(regexp_extract_all") <= 2, name


def test_names_in_texts_equal_a_plain_search(spark):
    rng = random.Random(7)
    letters = "ab😀中 .\n"
    names = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(60)} | {"a", "中", ".*"}
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(150)] + [None, "", "a", "a.*b"]
    places = spark.createDataFrame([(n,) for n in names for _ in range(2)] + [("",), (None,)], "short string")
    said = spark.createDataFrame(list(enumerate(texts)), "id int, said string")
    got = sorted((r["id"], r["short"]) for r in mentions(said, "id", "said", places).collect())
    assert got == sorted((i, n) for i, t in enumerate(texts) for n in names if n in (t or ""))
    owned = spark.createDataFrame([(i, t, rng.choice([*names, None])) for i, t in enumerate(texts)], "id int, said string, own string")
    for r in with_other_entity(owned, "said", "own", places).collect():
        assert r["_other"] == any(n in (r["said"] or "") and n != r["own"] for n in names), r


def test_names_that_begin_alike_share_one_entry_of_the_index(spark):
    numbers = spark.range(3000).select(F.format_string("地%09d", F.col("id") * 7).alias("short"))
    odd = ["地\\E", "\\Ea.", "ab\\Q\\Ec", "a\\", "地00"]
    places = numbers.unionByName(spark.createDataFrame([(n,) for n in odd], "short string"))
    assert name_index(numbers, "short").collect() == [("地00", 10)]
    lines = [f"从地{i * 21:09d}至地{i * 5:09d}" for i in range(50)] + [n + "x" + n for n in odd] + ["地00000000", None]
    said = spark.createDataFrame(list(enumerate(lines)), "id int, said string")
    names = [r["short"] for r in places.collect()]
    got = sorted((r["id"], r["short"]) for r in mentions(said, "id", "said", places).collect())
    assert got == sorted((i, n) for i, t in enumerate(lines) for n in names if n in (t or ""))


def test_dimensions_given_as_tables_are_not_broadcast(spark, tmp_path):
    spark.range(500).select(F.format_string("地%09d", "id").alias("short")).write.parquet(str(tmp_path / "d"))
    name = F.col("short")
    dim = spark.read.parquet(str(tmp_path / "d")).select(F.lit(1).alias("ordinal"), name, F.concat(name, F.lit("县")).alias("full"), name.alias("code"))
    rows = spark.createDataFrame([("地000000007县", "a"), ("地000000008北", "b")], "entity string, x string")
    met = normalize_entity_join(rows, "entity", dim, "named")
    assert "SortMergeJoin [tier" in plan(met)
    assert sorted(r["named"] for r in met.select("named").collect()) == ["地000000007", "地000000008"]
    found = plan(mentions(rows, "x", "entity", dim))
    assert "SortMergeJoin [_piece" in found and "SortMergeJoin [_k" in found


def test_shortlist_keeps_its_names_from_the_driver(spark, builds):
    shown = plan(builds["w7_shortlist_large"](spark, SMALL))
    assert "SortMergeJoin [tier" in shown and "BroadcastHashJoin [tier" not in shown


def test_steps_of_a_large_shortlist_are_planned_once(spark, builds):
    # Planned anew in every use, the candidates alone read their tables 16 times.
    for name in ("w7_shortlist_large", "t6_extract_candidates_large"):
        shown = plan(builds[name](spark, SMALL))
        assert "orders.parquet" not in shown and shown.count("customer.parquet") <= 4, name


def test_hot_keys_are_split(spark):
    left = spark.range(200000).select(
        F.col("id").alias("_row"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("source_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("source_name"),
        F.lit("").alias("source_level"),
        F.lit("").alias("source_url"),
    )
    reg = spark.range(4000).select(
        F.col("id").alias("_row"),
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("source_id"),
        F.lit("n").alias("source_name"),
        F.lit("A").alias("source_level"),
        F.lit("u").alias("source_url"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        # The payload has to travel, or the hot partition is too small to split.
        sums = [F.count(F.lit(1)).alias("count"), F.max("source_name")]
        found = regs.match_registry(left, reg).groupBy("match_mode").agg(*sums)
        rows = {r["match_mode"]: r["count"] for r in found.collect()}
        hot = spark.range(200000).where("id % 3 = 0").count()
        assert rows["source_id"] >= hot and sum(rows.values()) == 200000
        assert "skew=true" in plan(found)
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_results_do_not_depend_on_partitioning(spark):
    v = Views(spark, SMALL)
    keys = ["province", "year", "series"]

    def shuffled(df, n):
        return df.repartition(n, F.rand(n))

    def merged(n):
        out = pan.merge_panel(shuffled(v.panel, n), shuffled(v.patch, n), keys, ["stock_10k"], "short")
        return sorted(map(tuple, out.select("_row", "stock_10k").collect()))

    assert merged(3) == merged(7)

    def matched(n):
        out = regs.match_registry(shuffled(v.panel, n), shuffled(v.registry, n))
        return sorted(map(str, out.select("_row", "match_mode", "registry.note").collect()))

    assert matched(2) == matched(5)


def walk_cap(rows, max_pages, cap):
    """The selection as a plain walk over one entity's ranked rows."""
    if max_pages <= 0:
        return []
    chosen, aside, used = [], [], {}
    for host, place in rows:
        if cap > 0 and host and used.get(host, 0) >= cap:
            aside.append(place)
            continue
        used[host] = used.get(host, 0) + 1
        chosen.append(place)
    return (chosen + aside)[:max_pages] if len(chosen) < max_pages else chosen[:max_pages]


@pytest.mark.parametrize(("max_pages", "cap"), [(0, 2), (5, 0), (6, 1), (8, 2), (40, 3)])
def test_cap_per_domain_equals_the_walk(spark, max_pages, cap):
    rng = random.Random(max_pages * 10 + cap)
    rows, want = [], {}
    for entity in range(60):
        hosts = [rng.choice(["", "a", "b", "c", "d"]) for _ in range(rng.randrange(0, 25))]
        listed = []
        for i, host in enumerate(hosts):
            rows.append((f"e{entity}", f"http://{host}.x/{i}" if host else f"none{i}", 100 - i // 3, i))
            listed.append((host, i))
        want[f"e{entity}"] = walk_cap(listed, max_pages, cap)
    df = spark.createDataFrame(rows, "entity string, url string, search_score int, ord int")
    got = {e: [] for e in want}
    for r in rk.cap_per_domain(df, max_pages, cap).orderBy("entity", "_rank").collect():
        got[r["entity"]].append(r["ord"])
    assert got == want


def test_dedup_results_equals_the_walk(spark):
    rng = random.Random(5)
    rows, want = [], []
    for q in range(80):
        best = {}
        for i in range(rng.randrange(0, 15)):
            url, title, snippet = rng.choice(["u", "v", " ", "w "]), "t" * rng.randrange(4), "s" * rng.randrange(4)
            rows.append((f"q{q}", url, title, snippet, i))
            key = url.strip()
            if not key:
                continue
            if key not in best:
                best[key] = (i, title, snippet)
            elif len(title + snippet) > len(best[key][1] + best[key][2]):
                best[key] = (best[key][0], title, snippet)
        want += [(f"q{q}", k, t, s, o) for k, (o, t, s) in best.items()]
    df = spark.createDataFrame(rows, "query string, url string, title string, snippet string, ord int")
    got = [tuple(r) for r in rk.dedup_results(df).select("query", "url", "title", "snippet", "ord").collect()]
    assert sorted(got) == sorted(want)
