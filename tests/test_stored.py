"""Stored panels: plans, files left alone, nulls, empty tables, hot keys, repeated runs."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from evidencepanel.operators import stored as st

COLUMNS = ["province", "year", "v"]


def cell(province, year, v, **more):
    return {"province": province, "year": year, "v": v, **more}


@pytest.fixture
def kept(table, tmp_path):
    """Stores rows as a panel; gives its place and its folder."""

    def build(rows, parts=8, buckets=4):
        at = st.StoredPanel(f"t_{uuid.uuid4().hex}", parts=parts, buckets=buckets)
        folder = str(tmp_path / at.table)
        st.store_panel(table(rows, COLUMNS), at, folder)
        return at, folder

    return build


def rows_of(spark, at):
    return sorted(tuple(r) for r in st.stored_rows(spark, at).select(*COLUMNS).collect())


def test_only_the_patch_is_exchanged(spark, kept, table):
    at, _ = kept([cell(f"p{i}", "2020", str(i)) for i in range(50)])
    patch = table([cell("p1", "2020", "x"), cell("new", "2020", "y")])
    for how in ("left", "full"):
        text = st.touched_rows(spark, at, patch, how)._jdf.queryExecution().executedPlan().toString()
        old, new = text[text.index("SortMergeJoin") :].split(":- ", 1)[1].split("\n      +- ", 1)
        assert "Exchange" not in old and "Bucketed: true" in old and "Location" in old
        assert new.count("Exchange hashpartitioning") == 1


def test_parts_without_a_key_of_the_patch_keep_their_files(spark, kept, table):
    at, folder = kept([cell(f"p{i}", "2020", str(i)) for i in range(200)], parts=16)

    def files():
        return {d: sorted(os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if d.startswith("_part=")}

    before = files()
    assert len(before) == 16
    assert st.upsert_stored(table([cell("p7", "2020", "x"), cell(" p7 ", "2020", "y")]), at) == {"replaced": 1, "added": 0}
    after = files()
    assert sum(before[d] != after[d] for d in before) == 1
    # One file a bucket, whatever the number of patches.
    assert max(len([f for f in names if f.endswith(".parquet")]) for names in after.values()) <= at.buckets
    assert [v for p, _, v in rows_of(spark, at) if p.strip() == "p7"] == ["y"] and len(rows_of(spark, at)) == 200


def test_the_three_patches(spark, kept, table):
    at, _ = kept([cell("a", "2020", "1"), cell("b", "2020", "2"), cell("b", " 2020", "3"), cell("c", "2021", None)])
    assert rows_of(spark, at) == [("a", "2020", "1"), ("b", " 2020", "3"), ("c", "2021", None)]
    patch = table([cell("a", "2020", "9"), cell("a", "2020", " "), cell("b", "2020", "8"), cell("d", "2020", "7")])
    for _ in range(2):  # a patch run again changes nothing
        assert st.merge_stored(patch, at, ["v"]) == {"cells_written": 1}
        assert rows_of(spark, at)[:2] == [("a", "2020", "1"), ("b", " 2020", "8")]
    assert st.overwrite_stored(patch, at, ["v"], years=[2020]) == {"updated": 2}
    assert rows_of(spark, at)[0] == ("a", "2020", " ")
    assert st.overwrite_stored(patch, at, ["v"], years=[1999]) == {"updated": 0}
    assert st.overwrite_stored(patch, at, ["v"], require="v") == {"updated": 1}
    assert st.upsert_stored(patch.drop("v"), at) == {"replaced": 2, "added": 1}
    assert rows_of(spark, at) == [("a", "2020", None), ("b", "2020", None), ("c", "2021", None), ("d", "2020", None)]


def test_null_keys_empty_tables_and_extra_columns(spark, kept, table, tmp_path):
    at, _ = kept([cell(None, None, "1"), cell("", " ", "2"), cell("a", "2020", "3")])
    assert st.stored_rows(spark, at).count() == 2
    nothing = table([cell("a", "2020", "x")]).where("false")
    assert st.upsert_stored(nothing, at) == {"replaced": 0, "added": 0}
    extra = table([cell(None, "", "4", _old="o", _new="n", _o="p", _h="q")])
    assert st.upsert_stored(extra, at) == {"replaced": 1, "added": 0}
    assert {r[2] for r in st.stored_rows(spark, at).select(*COLUMNS).collect()} == {"3", "4"}
    hollow = st.StoredPanel(f"t_{uuid.uuid4().hex}", parts=2, buckets=2)
    st.store_panel(nothing, hollow, str(tmp_path / "hollow"))
    assert st.upsert_stored(table([cell("a", "2020", "1")]), hollow) == {"replaced": 0, "added": 1}
    assert rows_of(spark, hollow) == [("a", "2020", "1")]


def test_a_hot_key_in_the_patch_equals_the_plain_fold(spark, kept, table):
    at, _ = kept([cell(f"p{i}", "2020", "0") for i in range(30)])
    patch = spark.range(6000).select(
        F.col("id").alias("_row"),
        F.when(F.col("id") % 3 == 0, "p1").otherwise(F.concat(F.lit("p"), (F.col("id") % 40).cast("string"))).alias("province"),
        F.lit("2020").alias("year"),
        F.col("id").cast("string").alias("v"),
    )
    want = {f"p{i}": "0" for i in range(30)}
    for r in patch.orderBy("_row").collect():
        want[r["province"]] = r["v"]
    st.upsert_stored(patch, at)
    assert {p: v for p, _, v in rows_of(spark, at)} == want
