"""Panel, registry, quality, coverage, score and round rules on literal cases."""

import pytest
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES
from evidencepanel.operators import coverage as cov
from evidencepanel.operators import panel as pan
from evidencepanel.operators import quality as qc
from evidencepanel.operators import registry as regs
from evidencepanel.operators import scorecard as sc
from evidencepanel.operators.groups import number_rows, top_per_group
from evidencepanel.plans import rounds
from evidencepanel.plans.session import written_once

KEYS = ["province", "year"]


def cell(province, year="2023", **more):
    return {"province": province, "year": year, **more}


def values(df, column="v"):
    return [r[column] for r in df.orderBy("_row").collect()]


def test_merge_fills_and_counts(table):
    base = table([cell("北京", v=""), cell("上海", v="")])
    new = table([cell("北京", v="100"), cell("上海", v="200")])
    out = pan.merge_panel(base, new, KEYS, ["v"])
    assert values(out) == ["100", "200"]
    assert pan.cells_written(out).first()["cells_written"] == 2


def test_merge_maps_names_and_last_row_wins(table):
    base = table([cell("北京", v=""), cell("上海", v="old")])
    named = table([cell("北京市", v="300"), cell("上海市", v="400")])
    assert values(pan.merge_panel(base, named, KEYS, ["v"], entity_form="short")) == ["300", "400"]
    twice = table([cell("北京", v="111"), cell("北京", v="222"), cell("上海", v=" ")])
    assert values(pan.merge_panel(base, twice, KEYS, ["v"])) == ["222", "old"]
    hidden = table([cell("北京", v="111"), cell("北京", v="")])
    assert values(pan.merge_panel(base, hidden, KEYS, ["v"])) == ["", "old"]
    added = pan.merge_panel(base, table([cell("北京", w="x")]), KEYS, ["w"])
    assert values(added, "w") == ["x", ""]


def test_reference_fill_only_fills_blanks_in_listed_years(table):
    data = table([cell("北京", v=""), cell("上海", v="1"), cell("天津", "2022", v="")])
    ref = table([cell(" 北京", v="9"), cell("上海", v="8"), cell("天津", "2022", v="7")])
    out = pan.reference_fill(data, ref, KEYS, "v", [2023])
    assert values(out) == ["9", "1", ""]
    assert tuple(pan.fill_counts(out).first()) == (2, 1)
    assert values(pan.reference_fill(data, ref, KEYS, "v")) == ["9", "1", "7"]


def test_upsert_and_patch(table):
    old = table([cell("A", "2020", v="1"), cell("", "2020", v="2"), cell("B", "0", v="3"), cell("B", "2021", v="4")])
    new = table([cell("A", "2020", v="5"), cell("C", "2019", v="6"), cell("C", "2019", v="7")])
    got = [(r["province"], r["v"]) for r in pan.upsert(old, new).collect()]
    assert got == [("A", "5"), ("B", "4"), ("C", "7")]
    patched = pan.overwrite_columns(old, new, ["v"], KEYS, years=[2020], require="v")
    assert values(patched) == ["5", "2", "3", "4"]


def test_compare_panels(table):
    a = table([cell("A", x="1", y="a", z="1"), cell("B", x="2", y="3", z="")])
    b = table([cell("A", x="1", y="2", w="1"), cell("B", x="2.5", y="3", w="1")])
    got = {r["column"]: tuple(r)[1:] for r in pan.compare_panels(a, b, KEYS).collect()}
    assert got == {"x": (2, 1, 0.5, 0.25), "y": (1, 0, 0.0, 0.0)}
    assert pan.shared_columns(a, b, KEYS) == {"shared": ["_row", "x", "y"], "left_only": ["z"], "right_only": ["w"]}


def test_fill_with_status(table, spark):
    panel = table([cell("A", v="", source_url="u0"), cell("B", v="5", source_url="u1"), cell("D", v="", source_url="")])
    spec = {"source_level": "A", "source_name": "n", "note": "t"}
    specs = table(
        [
            cell("A", source_id="1", source_url="gone", pattern="([0-9]+)", **spec),
            cell("A", source_id="2", source_url="p", pattern="人口\\s*([0-9]+)", **spec),
            cell("A", source_id="3", source_url="p", pattern="([0-9]+)", **spec),
            cell("B", source_id="4", source_url="p", pattern="([0-9]+)", **spec),
            cell("C", source_id="5", source_url="p", pattern="([0-9]+)", **spec),
            cell("D", source_id="6", source_url="p", pattern="zz([0-9]+)", **spec),
        ]
    )
    pages = spark.createDataFrame([("p", "年末人口  12 万")], "url string, text string")
    out = pan.fill_with_status(panel, specs, pages, "v", "2025-01-01")
    got = [(r["status"], r["value"], r["error"]) for r in out["evidence"].orderBy("_row").collect()]
    assert got == [
        ("error", "", "no_text"),
        ("ok", "12", ""),
        ("skipped_already_filled", "12", ""),
        ("skipped_already_filled", "5", ""),
        ("error", "", "panel_row_not_found"),
        ("error", "", "regex_not_matched"),
    ]
    assert values(out["panel"]) == ["12", "5", ""]
    assert [r["source_id"] for r in out["registry"].collect()] == ["2"]


def test_quality_checks(table):
    rows = table(
        [
            cell("北京", v="123", source_url="u"),
            cell("北京", v="1.2万台", source_url="u"),
            cell("上海", v="", source_url=""),
            cell("广东", v="500辆", source_url=" "),
            cell("广西", v="600台", source_url="u"),
            cell("海南", v="1.2e3", source_url="u"),
        ]
    )
    assert [tuple(r) for r in qc.duplicate_keys(rows, KEYS).collect()] == [("北京", "2023", 2)]
    gated = [(r["line"], r["entity"], r["column"]) for r in qc.check_required(rows, ["source_url"], ["v"]).collect()]
    assert gated == [(5, "广东", "source_url")]
    assert sorted(r["entity"] for r in qc.check_required(rows, ["source_url"]).collect()) == ["上海", "广东"]
    units = {r["raw"]: r["reason"] for r in qc.check_unit(rows, ["v"], "台").collect()}
    assert units == {"1.2万台": qc.NOT_CONVERTED, "500辆": qc.WRONG_UNIT + "台"}
    assert qc.infer_value_cols(["province", "year", "a", "source_id", "b_url", "note", "b", "c"], KEYS) == ["a", "b"]
    broken = qc.check_rules(rows, {"short": F.length("v") < 5, "none": F.lit(None).cast("boolean")})
    assert broken.groupBy("check").count().orderBy("check").collect()[0]["count"] == 6
    model = table([cell("", ""), cell("A", " ")])
    assert [(r["line"], r["column"]) for r in qc.check_panel_model(model).orderBy("line").collect()] == [(2, "province"), (3, "year")]
    with pytest.raises(ValueError):
        qc.check_required(rows, ["absent"])


def source(source_id="", level="", name="", url="", cross="", variable="x"):
    return {
        "source_id": source_id,
        "variable": variable,
        "source_level": level,
        "source_name": name,
        "source_url": url,
        "cross_check_url": cross,
        "access_date": "d",
        "note": "r" + source_id,
    }


def row(province, v, source_id="", level="", name="", url="", cross="", access="d", year="2023"):
    return {
        **cell(province, year, v=v),
        "source_id": source_id,
        "source_level": level,
        "source_name": name,
        "source_url": url,
        "cross_check_url": cross,
        "access_date": access,
        "note": "",
    }


def test_scorecard_of_matched_rows(table):
    panel = table([row("北京", "1", "S1", "A", "n1", "u1"), row("上海市", "2", "", "C", "n2", "u2"), row("天津", "", "S1", "A", "n1", "u1")])
    reg = table([source("S1", "A", "n1", "u1"), source("S2", "C", "n2", "u2", cross="y")])
    card = sc.scorecard(panel, reg, "x", ["v"], KEYS, [2023]).first()
    assert (card["expected_key_count"], card["filled_key_count"], card["filled_row_count"]) == (30, 2, 2)
    assert (card["registry_match_rate"], card["c_cross_check_rate"], card["source_quality_score"]) == (100.0, 100.0, 70.0)
    assert (card["level_A"], card["level_C"]) == (1, 1)
    assert card["fill_rate"] == 6.6667 and card["overall_score"] == 62.8333


def test_scorecard_of_an_unmatched_row(table):
    panel = table([row("北京", "1", "", "C", "n", "u", access="")])
    card = sc.scorecard(panel, table([source("S9", "A", "o", "p")]), "x", ["v"], KEYS, [2023]).first()
    assert (card["registry_match_rate"], card["c_cross_check_rate"]) == (0.0, 0.0)
    assert (card["provenance_completeness_rate"], card["source_quality_score"]) == (60.0, 40.0)
    assert card["overall_score"] == 19.1667
    nothing = sc.scorecard(panel.where("false"), table([source("S9")]), "x", ["v"], KEYS).first()
    assert (nothing["fill_rate"], nothing["c_cross_check_rate"], nothing["overall_score"]) == (0.0, 100.0, 10.0)


def test_matching_rules(table):
    reg = table(
        [
            source("S1", "A", "n", "u"),
            source("S1", "B", "n2", "u2"),
            source("", "C", "t", "w"),
            source("S4", "C", "t", "w", cross="y"),
            source("S5", "", "", ""),
        ]
    )
    rows = table([row("a", "1", " S1 "), row("b", "1", "zz", "C", " t", "w"), row("c", "1"), row("d", "1", "", "", "", "")])
    got = [(r["match_mode"], r["registry"] and r["registry"]["note"]) for r in regs.match_registry(rows, reg).orderBy("_row").collect()]
    assert got == [("source_id", "rS1"), ("source_tuple", "r"), ("unmatched", None), ("unmatched", None)]


def test_registry_checks(table):
    reg = table([source("S1", "C", "n", "u"), source("S2", "C", "m", "w"), source("S3", "C", "m", "w", cross="y")])
    rows = table([row("a", "1", "S1", "C", "n", "u"), row("b", "1", "S2", "C", "m", "w"), row("c", "1", "", "B", "q", "z"), row("d", "", "no", "B", "q", "z")])
    assert [r["province"] for r in regs.uncrossed_c_rows(rows, reg, ["v"]).collect()] == ["a"]
    assert [r["province"] for r in regs.unregistered_rows(rows, reg, ["v"]).collect()] == ["c"]
    assert [(r["province"], r["reason"]) for r in regs.misaligned_source_ids(rows, reg, ["v"]).collect()] == [("c", regs.NO_SOURCE_ID)]
    issues = qc.validate_round(rows, reg, "x", KEYS, ["source_url"], ["v"])
    assert {r["check"] for r in issues.collect()} == {"unregistered", "c_cross_check", "source_id"}
    only_c = qc.validate_round(rows.where("province = 'a'"), reg, "x", KEYS, ["source_url"], ["v"])
    assert qc.round_passes(only_c) and not qc.round_passes(only_c, strict_cross_check=True)


def test_registry_upkeep(table):
    reg = table([source("S1", "A"), source("S2", "B"), source("S2", "C")])
    new = table([source("S2", "x"), source("S3", "y"), source("S3", "z")])
    assert sorted((r["source_id"], r["source_level"]) for r in regs.registry_append(reg, new).collect()) == [
        ("S1", "A"),
        ("S2", "B"),
        ("S2", "C"),
        ("S3", "y"),
    ]
    used = table([row("a", "1", " S2")])
    assert [(r["source_id"], r["source_level"]) for r in regs.registry_prune(reg, used, reg).collect()] == [("S2", "C")]
    assert regs.registry_prune(reg, table([row("a", "1", "no")]), reg).count() == 3
    ids = regs.assign_source_ids(table([cell("a"), cell("b")]), "P_")
    assert values(ids, "source_id") == ["P_01", "P_02"]


def test_conflicts_take_the_best_then_the_newest(table):
    rows = table(
        [
            {"k": "1", "source_level": "B", "access_date": "2025-01-01", "source_id": "a"},
            {"k": "1", "source_level": "A", "access_date": "2023-01-01", "source_id": "b"},
            {"k": "1", "source_level": "A", "access_date": "2024-01-01", "source_id": "c"},
            {"k": "2", "source_level": "?", "access_date": "2024-01-01", "source_id": "d"},
        ]
    )
    got = {r["k"]: r["source_id"] for r in regs.resolve_conflicts(rows, ["k"]).collect()}
    assert got == {"1": "c", "2": "d"}


def test_evidence_records_and_pack(table, spark, tmp_path):
    panel = table([row("北京", "1", "S1", "A", "n1", "u1"), row("上海", ""), row("天津", "3", "", "B", "t", "w")])
    reg = table([source("S1", "A", "n1", "u1"), source("S2", "B", "t", "w"), source("S3", variable="other")])
    got = sc.evidence_records(panel, reg, KEYS, ["v"], "x").orderBy("row_index").collect()
    assert [(r["row_index"], r["provenance"]["match_mode"]) for r in got] == [(2, "source_id"), (4, "source_tuple")]
    assert got[0]["row_key"] == {"province": "北京", "year": "2023"} and got[0]["values"] == {"v": "1"}
    assert got[0]["provenance"]["registry_record"]["note"] == "rS1"
    assert got[1]["provenance"]["resolved_source_id"] == "S2"
    manifest = sc.evidence_pack(panel, reg, str(tmp_path / "pack"), KEYS, ["v"], "x").first()
    assert (manifest["total_dataset_rows"], manifest["registry_rows_in_scope"]) == (3, 2)
    assert (manifest["evidence_record_count"], manifest["unique_source_id_count"]) == (2, 2)
    assert spark.read.json(str(tmp_path / "pack" / "source_ids")).count() == 2


def test_coverage_and_gaps(table):
    rows = table([cell("北京市", "02023", v="1"), cell("北京", "2023", v="2"), cell("火星", "2023", v="3"), cell("上海", "x", v="4"), cell("天津", "2022", v=" ")])
    stats = cov.coverage_stats(rows, KEYS, ["v"], [2022, 2023])
    summary = stats.summary.first()
    assert (summary["total_rows"], summary["all_keys_count"], summary["filled_keys_count"]) == (5, 60, 3)
    assert {r["year"]: r["filled_rows"] for r in stats.by_year.collect()} == {2023: 3}
    gaps = cov.gap_matrix(rows, "v", 2022, 2023)
    assert gaps.count() == 59 and gaps.where("entity = '北京'").count() == 1
    first = gaps.where("year = 2022").orderBy("ordinal").first()
    assert first["entity"] == "北京"
    summary = {r["year"]: tuple(r)[1:] for r in cov.year_gap_summary(gaps, 2022, 2023, 30).collect()}
    assert summary == {2022: (0, 30, 2), 2023: (1, 29, 1)}
    assert [r["year"] for r in cov.focus_years(cov.year_gap_summary(gaps, 2022, 2023, 30), 1).collect()] == [2023]


def test_rounds_stop_after_a_low_gain_round(table, spark):
    panel = table([cell("北京", v=""), cell("上海", v="")])
    first, second = table([cell("北京", v="1")]), table([cell("北京", v="9")])
    run = rounds.run_rounds(panel, [first, second, first], ["v"], 2023, 2023)
    assert [r["gained"] for r in run.rounds] == [1, 0]
    assert [(r["missing_before"], r["missing_after"]) for r in run.rounds] == [(30, 29), (29, 29)]
    assert values(run.panel) == ["9", ""]
    kept = rounds.run_rounds(panel, [first, second], ["v"], 2023, 2023, fill_only=True)
    assert values(kept.panel) == ["1", ""]
    history = spark.createDataFrame([(1, 1, 9), (2, 0, 9), (3, 0, 9), (4, 2, 0)], "round int, gained int, missing_after int")
    stops = rounds.stop_decision(history, 1, 2).orderBy("round").collect()
    assert [(r["low_gain_streak"], r["stop"]) for r in stops] == [(0, False), (1, False), (2, True), (0, True)]


def test_numbering_is_consecutive(spark):
    rows = spark.range(0, 5000).select((F.col("id") * F.col("id") % 7919 * 10000 + F.col("id")).alias("o")).repartition(7)
    got = number_rows(rows, "o", buckets=32).orderBy("o").collect()
    assert [r["_n"] for r in got] == list(range(1, 5001))


def test_large_k_uses_slices_and_stays_exact(spark):
    rows = spark.range(0, 6000).select((F.col("id") % 2).alias("g"), F.col("id"))
    got = top_per_group(rows, ["g"], [F.col("id").desc()], 1500)
    assert got.groupBy("g").agg(F.min("id").alias("m"), F.max("_rank").alias("r")).orderBy("g").collect() == [(0, 3000, 1500), (1, 3001, 1500)]


def test_counts_of_changed_rows_equal_counts_of_whole_panels(spark):
    """Rows that share a key or a pair with a changed one count as well; spellings of a name are one key."""
    names = ["江苏", "江苏省", "上海", "上海市", "Nowhere", "", None]
    rows = [(i, names[i % 7], str(2020 + i % 4), f"s{i % 3}", ["", "5", None, " "][i % 4], "") for i in range(80)]
    panel = spark.createDataFrame(rows, "_row long, province string, year string, series string, v string, w string")
    patches = [
        spark.createDataFrame([(j, names[(3 * j + k) % 7], str(2020 + j % 4), f"s{j % 3}", ["9", ""][j % 2], ["", "x"][k % 2]) for j in range(12)], panel.schema)
        for k in range(3)
    ]
    for keys in (["province", "year"], ["province", "year", "series"]):
        for more in ({}, {"entity_form": "short"}, {"fill_only": True}):
            run = rounds.run_rounds(panel, patches, ["v", "w"], 2020, 2022, keys, min_gain=-1, **more)
            assert len(run.rounds) == 3
            before = panel
            for patch, got in zip(patches, run.rounds):
                if "fill_only" in more:
                    after = pan.reference_fill(before, patch, keys, "v").drop("_scanned", "_filled")
                else:
                    after = pan.merge_panel(before, patch, keys, ["v", "w"], more.get("entity_form")).drop("_written")
                want = rounds.round_metrics(before, after, keys, ["v", "w"], 2020, 2022).first().asDict()
                assert got == {"round": got["round"], "gained": want.pop("gained_keys"), **want}
                before = after


def test_counting_a_round_exchanges_no_panel(spark):
    """Ids that changed are broadcast to both scans; only folded counts are exchanged."""
    panel = spark.range(1000).selectExpr(
        "id AS _row", "'江苏' AS province", "CAST(2000 + id % 20 AS string) AS year", "CAST(id AS string) AS v", "id < 3 AS _changed"
    )
    ids = rounds._ids(panel, ["province", "year"], ["v"], 2000, 2020, PROVINCES, F.lit(True))
    touched = written_once(ids.where("new").select("is_key", "id").distinct(), "ids")
    plan = ids.join(touched, ["is_key", "id"], "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_rounds_resolve_names_and_write_a_repeated_patch_once(table, monkeypatch):
    resolved, written = [], []
    resolve, write = rounds.resolve_entity, rounds.written_once
    monkeypatch.setattr(rounds, "resolve_entity", lambda *a, **k: resolved.append(1) or resolve(*a, **k))
    monkeypatch.setattr(rounds, "written_once", lambda df, name: written.append(name) or write(df, name))
    rows = [{"province": p, "year": "2023", "v": v} for p, v in (("北京市", ""), ("上海", "1"), ("上海市", ""), ("火星省", ""))]
    patch = table([{"province": "北京", "year": "2023", "v": "7"}, {"province": "火星省", "year": "2023", "v": "9"}])
    run = rounds.run_rounds(table(rows), [patch, patch], ["v"], 2023, 2023, min_gain=0, entity_form="full")
    assert [(r["gained"], r["missing_before"], r["missing_after"]) for r in run.rounds] == [(2, 29, 28), (0, 28, 28)]
    assert run.panel.columns == table(rows).columns
    assert sorted((r["province"], r["v"]) for r in run.panel.collect()) == [("上海", "1"), ("上海市", ""), ("北京市", "7"), ("火星省", "9")]
    assert len(resolved) == 1 and written.count("round-patch") == 1
