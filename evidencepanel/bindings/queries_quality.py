"""Queries over quality checks, the source registry, scores and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.bindings.catalog import KEYED, any_in, has, host, matched, number, query, s, year
from evidencepanel.bindings.views import FIRST_YEAR, LAST_YEAR, Views
from evidencepanel.functions import grading
from evidencepanel.functions.entity import PROVINCES
from evidencepanel.functions.text import to_number
from evidencepanel.operators import quality as qc
from evidencepanel.operators import registry as regs
from evidencepanel.operators import scorecard as sc
from evidencepanel.operators.panel import check_merge_invariant, merge_panel
from evidencepanel.plans.session import scratch_path
from evidencepanel.sources import writers

KEYS = ["province", "year", "series"]
VALUES = ["stock_10k", "aux_value"]
REQUIRED = ["source_url", "source_name", "source_level", "source_id", "access_date"]
YEARS = list(range(FIRST_YEAR, LAST_YEAR + 1))
VALUED = f"({has('stock_10k')} OR {has('aux_value')})"


# ---------------------------------------------------------------- key checks
@query("a1_duplicate_keys", "SELECT province, year, series, count(*) AS count FROM panel GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(v: Views) -> DataFrame:
    return qc.duplicate_keys(v.panel, KEYS)


COVERED = ["province", "stock_10k", "source_id", "source_url", "cross_check_url", "access_date"]


@query(
    "a2_column_coverage",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({has(c)}) AS non_blank, count(*) AS total, "
        f"round(count(*) FILTER ({has(c)}) * 100.0::DOUBLE / count(*), 4) AS pct FROM panel"
        for c in COVERED
    ),
)
def _(v: Views) -> DataFrame:
    return qc.column_coverage(v.panel, COVERED).withColumn("pct", F.round("pct", 4))


NEGATIVE = f"count(*) FILTER ({number('stock_10k')} < 0)"


@query(
    "a9_gate_checks",
    f"""WITH t AS (SELECT count(*) AS n, count(DISTINCT (province, year, series)) AS k, count(*) FILTER ({has('stock_10k')}) AS a,
            count(*) FILTER ({has('source_url')}) AS b, {NEGATIVE} AS neg FROM panel)
        SELECT 'duplicate_rows' AS "check", 'province,year,series' AS "column", n - k AS count, n AS total, cast(NULL AS double) AS pct, n = k AS passed FROM t
        UNION ALL SELECT 'coverage', 'stock_10k', a, n, round(a * 100.0::DOUBLE / n, 4), a * 100.0 / n >= 80 FROM t
        UNION ALL SELECT 'coverage', 'source_url', b, n, round(b * 100.0::DOUBLE / n, 4), b * 100.0 / n >= 80 FROM t
        UNION ALL SELECT 'coverage', 'absent', 0, n, 0.0, false FROM t
        UNION ALL SELECT 'non_negative', 'stock_10k', neg, n, NULL, neg = 0 FROM t""".replace("WITH t AS", "SELECT * FROM (WITH t AS")
    + ")",
)
def _(v: Views) -> DataFrame:
    out = qc.gate_checks(v.panel, KEYS, ["stock_10k", "source_url", "absent"], 80.0, ["stock_10k"])
    return out.withColumn("pct", F.round("pct", 4))


@query(
    "a13_range_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({number(c)}) AS n_numeric, min({number(c)}) AS min_value, max({number(c)}) AS max_value, "
        f"round(avg({number(c)}), 4) AS mean_value FROM panel"
        for c in VALUES
    ),
)
def _(v: Views) -> DataFrame:
    return qc.range_profile(v.panel, VALUES).withColumn("mean_value", F.round("mean_value", 4))


# ---------------------------------------------------------------- row checks
def _issue(check: str, column: str, raw: str, reason: str, where: str, table: str = "panel", label: str = "province, year") -> str:
    entity, yr = label.split(", ")
    return (
        f"SELECT '{check}' AS \"check\", _row + 1 AS line, {entity} AS entity, {yr} AS year, '{column}' AS \"column\", "
        f"{raw} AS raw, {reason} AS reason FROM {table} WHERE {where}"
    )


MODEL = _issue("panel_model", "province", "province", "'province 不能为空'", f"NOT {has('province')}")
MODEL += " UNION ALL " + _issue("panel_model", "year", "year", "'year 不能为空'", f"{has('province')} AND NOT {has('year')}")


@query("q1_check_panel_model", MODEL)
def _(v: Views) -> DataFrame:
    return qc.check_panel_model(v.panel)


@query(
    "q2_check_source_model",
    """SELECT 'source_model' AS "check", _row + 1 AS line, '?' AS entity, '?' AS year, 'variable' AS "column", '' AS raw,
         'variable is not text' AS reason FROM registry WHERE _row % 9 = 0""",
)
def _(v: Views) -> DataFrame:
    holes = v.registry.withColumn("variable", F.when(F.col("_row") % 9 != 0, F.col("variable")))
    return qc.check_source_model(holes)


@query(
    "q2_check_candidate_model",
    _issue("candidate_model", "url", "url", "'url 不能为空'", f"NOT {has('url')}", "(SELECT ord AS _row, * FROM results)", "'?', '?'")
    + " UNION ALL "
    + _issue(
        "candidate_model",
        "score",
        "snippet",
        "'score is not a number'",
        f"{has('url')} AND {number('snippet')} IS NULL",
        "(SELECT ord AS _row, * FROM results)",
        "'?', '?'",
    ),
)
def _(v: Views) -> DataFrame:
    return qc.check_candidate_model(v.results.withColumn("score", F.col("snippet")), order="ord")


NEED = " UNION ALL ".join(_issue("required", c, c, "'required'", f"{VALUED} AND NOT {has(c)}") for c in REQUIRED)


@query("q3_check_required", NEED)
def _(v: Views) -> DataFrame:
    return qc.check_required(v.panel, REQUIRED, VALUES)


@query("q3_check_required_ungated", _issue("required", "source_url", "source_url", "'required'", f"NOT {has('source_url')}"))
def _(v: Views) -> DataFrame:
    return qc.check_required(v.panel, ["source_url"])


PURE = r"^[-+]?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
V = s("stock_10k")
OPEN = f"{V} <> '' AND NOT regexp_matches({V}, '{PURE}')"
UNIT = _issue("unit", "stock_10k", V, "'包含万/亿等未换算单位'", f"{OPEN} AND {any_in(V, ['万', '亿'])}")
UNIT += " UNION ALL " + _issue(
    "unit",
    "stock_10k",
    V,
    "'单位疑似不为台'",
    f"{OPEN} AND NOT {any_in(V, ['万', '亿'])} AND {any_in('lower(' + V + ')', ['台', '辆', '吨', '千瓦时', 'kwh'])} AND NOT contains({V}, '台')",
)


@query("q4_check_unit", UNIT)
def _(v: Views) -> DataFrame:
    return qc.check_unit(v.panel, ["stock_10k"], "台")


@query("q5_infer_value_cols", UNIT)
def _(v: Views) -> DataFrame:
    cols = qc.infer_value_cols(v.panel.columns, ["province", "year", "series"], ["access_date"])
    return qc.check_unit(v.panel, cols, "台")


SCOPE = "registry WHERE trim(variable) = 'stock_10k'"
TUPLES = f"""sc AS (SELECT * FROM {SCOPE}), tup AS (SELECT {s('source_level')} AS tl, {s('source_name')} AS tn, {s('source_url')} AS tu,
    bool_or({has('cross_check_url')}) AS crossed FROM sc GROUP BY 1, 2, 3), ids AS (SELECT DISTINCT {s('source_id')} AS sid FROM sc),
    flagged AS (SELECT p.*, t.tl IS NOT NULL AS reg_ok, t.crossed, i.sid IS NOT NULL AS id_ok FROM panel p
      LEFT JOIN tup t ON {s('p.source_level')} = tl AND {s('p.source_name')} = tn AND {s('p.source_url')} = tu
      LEFT JOIN ids i ON {s('p.source_id')} = sid)"""
LABEL = f"{s('source_level')} || ' | ' || {s('source_name')} || ' | ' || {s('source_url')}"
ID_REASON = f"CASE WHEN NOT {has('source_id')} THEN '缺少source_id' ELSE 'source_id未在registry找到: ' || {s('source_id')} END"
ID_BAD = f"{VALUED} AND (NOT {has('source_id')} OR NOT id_ok)"
C_BAD = f"{VALUED} AND {s('source_level')} = 'C' AND reg_ok AND NOT crossed"
DUPES = """SELECT 'duplicate_key' AS "check", cast(NULL AS bigint) AS line, province AS entity, year, 'province,year,series' AS "column",
    province || ',' || year || ',' || series AS raw, cast(count(*) AS string) || ' rows' AS reason FROM panel GROUP BY province, year, series HAVING count(*) > 1"""
ROUND = " UNION ALL ".join(
    [
        MODEL,
        NEED,
        UNIT,
        _issue("unregistered", "source", LABEL, "'not in registry'", f"{VALUED} AND NOT reg_ok", "flagged"),
        _issue("c_cross_check", "cross_check_url", s("source_name"), "'no cross-check address'", C_BAD, "flagged"),
        _issue("source_id", "source_id", s("source_id"), ID_REASON, ID_BAD, "flagged"),
        DUPES,
    ]
)


def _all_issues(v: Views) -> DataFrame:
    return qc.validate_round(v.panel, v.registry, "stock_10k", KEYS, REQUIRED, VALUES, "台")


@query("q6_validate_round", ROUND, TUPLES)
def _(v: Views) -> DataFrame:
    # aux_value holds plain counts, so the unit check has nothing to say about it.
    return _all_issues(v)


@query(
    "q6_round_verdict",
    f'SELECT "check", count(*) AS n_issues, "check" <> \'c_cross_check\' AS fails_round FROM ({ROUND}) GROUP BY 1',
    TUPLES,
)
def _(v: Views) -> DataFrame:
    return qc.round_verdict(_all_issues(v))


@query(
    "q7_merge_invariant",
    f"""SELECT count(*) AS rows_before, count(*) AS rows_after, count(*) FILTER ({has('m.v')}) AS values_after,
          (SELECT count(*) FILTER ({has('stock_10k')}) FROM patch) AS values_source, true AS rows_kept,
          count(*) FILTER ({has('m.v')}) = (SELECT count(*) FILTER ({has('stock_10k')}) FROM patch) AS values_match
        FROM (SELECT CASE WHEN {has('w.stock_10k')} THEN w.stock_10k ELSE p.stock_10k END AS v FROM panel p LEFT JOIN w
          ON w.province = p.province AND w.year = p.year AND w.series = p.series) m""",
    "w AS (SELECT province, year, series, arg_max(stock_10k, _row) AS stock_10k FROM patch GROUP BY 1, 2, 3)",
)
def _(v: Views) -> DataFrame:
    after = merge_panel(v.panel, v.patch, KEYS, ["stock_10k"])
    return check_merge_invariant(v.panel, after, v.patch, "stock_10k")


@query("q8_check_numeric", _issue("numeric", "stock_10k", V, "'not a number'", f"{has('stock_10k')} AND {number('stock_10k')} IS NULL"))
def _(v: Views) -> DataFrame:
    return qc.check_numeric(v.panel, ["stock_10k"])


@query(
    "q8_check_year_range",
    _issue("year_range", "year", s("year"), "'outside 1996-2000'", f"NOT coalesce({year()} BETWEEN 1996 AND 2000, false)"),
)
def _(v: Views) -> DataFrame:
    return qc.check_year_range(v.panel, 1996, 2000)


@query(
    "q8_check_entity_form",
    _issue("entity_form", "province", s("province"), "'not in short form'", f"{s('province')} NOT IN (SELECT short_name FROM dim)"),
)
def _(v: Views) -> DataFrame:
    return qc.check_entity_form(v.panel, "short", PROVINCES)


@query(
    "f3_check_rules",
    _issue("positive", "", "''", "'rule broken'", f"NOT coalesce({number('stock_10k')} > 0, false)")
    + " UNION ALL "
    + _issue("noted", "", "''", "'rule broken'", "note = 'n1'"),
)
def _(v: Views) -> DataFrame:
    return qc.check_rules(v.panel, {"positive": to_number("stock_10k") > 0, "noted": F.col("note") != "n1"})


# ------------------------------------------------------------------ registry
@query("p8_norm_level", f"SELECT _row, CASE WHEN upper(substr({s('source_level')}, 1, 1)) IN ('A', 'B', 'C') THEN upper(substr({s('source_level')}, 1, 1)) ELSE 'B' END AS level FROM panel")
def _(v: Views) -> DataFrame:
    return v.panel.select("_row", grading.norm_level("source_level").alias("level"))


H = host("url")


@query(
    "p9_suggest_level",
    rf"""SELECT ord, CASE WHEN contains({H}, 'tjj.') OR contains({H}, 'stats.') OR contains(lower(regexp_extract(url,
          '(?i)^(?:[a-z][a-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)), 'tjgb') THEN 'A-候选' WHEN {H} LIKE '%.gov.cn' THEN 'B-候选' ELSE 'C-候选' END AS level,
          CASE WHEN {H} LIKE '%.gov.cn' THEN 4 ELSE 0 END + CASE WHEN contains({H}, 'tjj.') THEN 6 ELSE 0 END
          + CASE WHEN contains({H}, 'stats.') THEN 4 ELSE 0 END AS host_score FROM results""",
)
def _(v: Views) -> DataFrame:
    return v.results.select(
        "ord", grading.suggest_level("url").alias("level"), grading.host_score("url").alias("host_score")
    )


@query(
    "p10_source_name_from_url",
    f"SELECT ord, CASE WHEN {H} = '' THEN '省级政府站点（2024人口发布）' ELSE {H} || '（2024人口发布）' END AS source_name FROM results",
)
def _(v: Views) -> DataFrame:
    return v.results.select("ord", grading.source_name_from_url("url").alias("source_name"))


@query("p16_registry_scope", f"SELECT _row, source_id, variable FROM {SCOPE}")
def _(v: Views) -> DataFrame:
    return regs.registry_scope(v.registry, "stock_10k").select("_row", "source_id", "variable")


@query(
    "j5_match_registry",
    "SELECT h._row, match_mode, r.source_id AS reg_id, r.note AS reg_note FROM hits h LEFT JOIN reg r ON r._row = h.rid",
    matched(),
)
def _(v: Views) -> DataFrame:
    out = regs.match_registry(v.panel, v.registry)
    return out.select(
        "_row", "match_mode", F.col("registry.source_id").alias("reg_id"), F.col("registry.note").alias("reg_note")
    )


@query(
    "j6_resolve_provenance",
    f"""SELECT _row, coalesce(r_id, '') AS resolved_source_id, coalesce(r_level, '') AS resolved_source_level,
          coalesce(r_name, '') AS resolved_source_name, coalesce(r_url, '') AS resolved_source_url,
          {s('cross_check_url')} AS cross_check_url, {s('access_date')} AS access_date, {s('note')} AS note FROM resolved""",
    matched(),
)
def _(v: Views) -> DataFrame:
    p = F.col("provenance")
    names = [f"resolved_{c}" for c in ("source_id", *regs.TUPLE)] + ["cross_check_url", "access_date", "note"]
    return sc.provenance_frame(v.panel, v.registry).select("_row", *[p[n].alias(n) for n in names])


@query("j7_unregistered_rows", f"SELECT _row, province, year FROM flagged WHERE {VALUED} AND NOT reg_ok", TUPLES)
def _(v: Views) -> DataFrame:
    scope = regs.registry_scope(v.registry, "stock_10k", exact=True)
    return regs.unregistered_rows(v.panel, scope, VALUES).select("_row", "province", "year")


@query("j8_uncrossed_c_rows", f"SELECT _row, province, year, source_name FROM flagged WHERE {C_BAD}", TUPLES)
def _(v: Views) -> DataFrame:
    scope = regs.registry_scope(v.registry, "stock_10k", exact=True)
    return regs.uncrossed_c_rows(v.panel, scope, VALUES).select("_row", "province", "year", "source_name")


@query("j9_misaligned_source_ids", f"SELECT _row, province, year, {ID_REASON} AS reason FROM flagged WHERE {ID_BAD}", TUPLES)
def _(v: Views) -> DataFrame:
    scope = regs.registry_scope(v.registry, "stock_10k", exact=True)
    return regs.misaligned_source_ids(v.panel, scope, VALUES).select("_row", "province", "year", "reason")


NEW_SOURCES = f"SELECT _row, CASE WHEN _row % 2 = 0 THEN source_id ELSE 'SRC_0000001' END AS source_id, source_name, 'patched' AS note FROM patch"


@query(
    "j12_registry_append",
    """SELECT source_id, variable, source_name, note FROM registry UNION ALL
       SELECT source_id, '', arg_min(source_name, _row), arg_min(note, _row) FROM fresh WHERE source_id NOT IN (SELECT source_id FROM registry) GROUP BY source_id""",
    f"fresh AS ({NEW_SOURCES})",
)
def _(v: Views) -> DataFrame:
    reg = v.registry.select("source_id", "variable", "source_name", "note")
    return regs.registry_append(reg, v.sql(NEW_SOURCES))


@query(
    "j13_registry_prune",
    f"""SELECT _row, source_id, note FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY _row DESC) AS rn FROM registry)
        WHERE rn = 1 AND source_id IN (SELECT {s('source_id')} FROM panel WHERE {has('source_id')})""",
)
def _(v: Views) -> DataFrame:
    return regs.registry_prune(v.registry, v.panel, v.registry).select("_row", "source_id", "note")


@query(
    "j13_registry_prune_fallback",
    "SELECT _row, source_id FROM registry",
)
def _(v: Views) -> DataFrame:
    nothing_used = v.panel.withColumn("source_id", F.concat(F.lit("other-"), F.col("series")))
    return regs.registry_prune(v.registry, nothing_used, v.registry).select("_row", "source_id")


@query("w9_assign_source_ids", "SELECT _row, 'SRC_N_' || lpad(cast(row_number() OVER (ORDER BY _row) AS string), 9, '0') AS source_id FROM patch")
def _(v: Views) -> DataFrame:
    return regs.assign_source_ids(v.patch, "SRC_N_", 9).select("_row", "source_id")


@query(
    "w10_resolve_conflicts",
    f"""SELECT province, year, _row FROM (SELECT *, row_number() OVER (PARTITION BY province, year ORDER BY
          CASE {s('source_level')} WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 ELSE 9 END, {s('access_date')} DESC, {s('source_id')}) AS rn
        FROM (SELECT * REPLACE (lpad(cast(_row AS string), 12, '0') AS source_id) FROM panel)) WHERE rn = 1""",
)
def _(v: Views) -> DataFrame:
    rows = v.panel.withColumn("source_id", F.lpad(F.col("_row").cast("string"), 12, "0"))
    return regs.resolve_conflicts(rows, ["province", "year"]).select("province", "year", "_row")


# -------------------------------------------------------------------- scores
@query(
    "a6_match_summary",
    """SELECT 'match_mode' AS kind, match_mode AS name, count(*) AS count FROM resolved GROUP BY 2
       UNION ALL SELECT 'source_level', r_level, count(*) FROM resolved WHERE coalesce(r_level, '') <> '' GROUP BY 2""",
    matched(),
)
def _(v: Views) -> DataFrame:
    return sc.match_summary(sc.provenance_frame(v.panel, v.registry)).withColumn("count", F.col("count").cast("bigint"))


@query(
    "a6_match_summary_own_level",
    f"""SELECT 'match_mode' AS kind, match_mode AS name, count(*) AS count FROM resolved GROUP BY 2
       UNION ALL SELECT 'source_level', {s('source_level')}, count(*) FROM resolved WHERE {has('source_level')} GROUP BY 2""",
    matched(),
)
def _(v: Views) -> DataFrame:
    return sc.match_summary(sc.provenance_frame(v.panel, v.registry), level="own")


def _card_sql(keys: str, expected: str) -> str:
    ok = " + ".join(f"CASE WHEN coalesce({c}, '') <> '' THEN 1 ELSE 0 END" for c in ("r_id", "r_level", "r_name", "r_url", s("access_date")))
    return f"""WITH f AS (SELECT r.*, {ok} AS present FROM resolved r WHERE {VALUED}),
      m AS (SELECT (SELECT count(*) FROM panel) AS data_row_count, (SELECT count(*) FROM registry) AS registry_row_count,
        (SELECT count(*) FROM reg) AS registry_rows_in_scope,
        (SELECT count(DISTINCT {keys}) FROM keyed) AS data_unique_key_count, {expected} AS expected_key_count,
        (SELECT count(DISTINCT {keys}) FROM keyed WHERE {VALUED}) AS filled_key_count,
        count(*) AS filled_row_count, sum(present) AS present, count(*) FILTER (match_mode <> 'unmatched') AS hit,
        count(*) FILTER (r_level <> '') AS nlev, sum(CASE r_level WHEN 'A' THEN 100 WHEN 'B' THEN 70 WHEN 'C' THEN 40 ELSE 0 END) AS pts,
        count(*) FILTER (r_level = 'C') AS nc, count(*) FILTER (r_level = 'C' AND ({has('cross_check_url')} OR coalesce(trim(reg_cross), '') <> '')) AS cc,
        count(*) FILTER (match_mode = 'source_id') AS mode_source_id, count(*) FILTER (match_mode = 'source_tuple') AS mode_source_tuple,
        count(*) FILTER (match_mode = 'unmatched') AS mode_unmatched, count(*) FILTER (r_level = 'A') AS "level_A",
        count(*) FILTER (r_level = 'B') AS "level_B", count(*) FILTER (r_level = 'C') AS "level_C",
        count(*) FILTER (r_level <> '' AND r_level NOT IN ('A', 'B', 'C')) AS level_other FROM f),
      r AS (SELECT *, round_even(filled_key_count / expected_key_count * 100, 4) AS fill_rate,
        round_even(present * 20 / filled_row_count, 4) AS provenance_completeness_rate,
        round_even(hit / filled_row_count * 100, 4) AS registry_match_rate,
        round_even(cc / nc * 100, 4) AS c_cross_check_rate, round_even(pts / nlev, 4) AS source_quality_score FROM m)
      SELECT * EXCLUDE (present, hit, nlev, pts, nc, cc), round_even(fill_rate * 0.35::DOUBLE + provenance_completeness_rate * 0.2::DOUBLE
        + registry_match_rate * 0.2::DOUBLE + source_quality_score * 0.15::DOUBLE + c_cross_check_rate * 0.1::DOUBLE, 4) AS overall_score FROM r"""


REG_SCOPED = matched(f"({'SELECT * FROM ' + SCOPE})")


@query(
    "a7_a8_scorecard",
    "SELECT * FROM (" + _card_sql("(k_province, k_year)", f"{30 * len(YEARS)}::BIGINT") + ")",
    KEYED + ", " + REG_SCOPED,
)
def _(v: Views) -> DataFrame:
    return sc.scorecard(v.panel, v.registry, "stock_10k", VALUES, ["province", "year"], YEARS)


@query(
    "a7_a8_scorecard_any_keys",
    "SELECT * FROM ("
    + _card_sql("(k_province, k_year, series)", "(SELECT count(DISTINCT (k_province, k_year, series)) FROM keyed)")
    + ")",
    KEYED + ", " + matched(),
)
def _(v: Views) -> DataFrame:
    return sc.scorecard(v.panel, v.registry, "", VALUES, KEYS)


# ------------------------------------------------------------------ evidence
@query(
    "e1_evidence_records",
    f"""SELECT _row + 1 AS row_index, {s('province')} AS key_province, {s('year')} AS key_year,
          nullif({V}, '') AS value_stock, nullif({s('aux_value')}, '') AS value_aux,
          match_mode, coalesce(r_id, '') AS resolved_source_id, reg_note, province AS raw_province FROM resolved WHERE {VALUED}""",
    matched(),
)
def _(v: Views) -> DataFrame:
    out = sc.evidence_records(v.panel, v.registry, ["province", "year"], VALUES)
    return out.select(
        "row_index",
        F.col("row_key")["province"].alias("key_province"),
        F.col("row_key")["year"].alias("key_year"),
        F.try_element_at("values", F.lit("stock_10k")).alias("value_stock"),
        F.try_element_at("values", F.lit("aux_value")).alias("value_aux"),
        F.col("provenance.match_mode").alias("match_mode"),
        F.col("provenance.resolved_source_id").alias("resolved_source_id"),
        F.col("provenance.registry_record.note").alias("reg_note"),
        F.col("row")["province"].alias("raw_province"),
    )


@query(
    "e1_evidence_default_values",
    f"SELECT _row + 1 AS row_index, cast(1 + CASE WHEN {has('stock_10k')} THEN 1 ELSE 0 END + CASE WHEN {has('aux_value')} THEN 1 ELSE 0 END AS int) AS n_values FROM panel",
)
def _(v: Views) -> DataFrame:
    return sc.evidence_records(v.panel, v.registry).select("row_index", F.size("values").alias("n_values"))


def _pack(v: Views) -> tuple[DataFrame, str]:
    path = scratch_path(v.spark, "pack")
    return sc.evidence_pack(v.panel, v.registry, path, ["province", "year"], VALUES, "stock_10k"), path


@query("e2_dataset", "SELECT _row, province, year, stock_10k FROM (SELECT row_number() OVER (ORDER BY _row) AS _row, province, year, stock_10k FROM panel)")
def _(v: Views) -> DataFrame:
    from evidencepanel.sources.readers import read_panel

    return read_panel(v.spark, f"{_pack(v)[1]}/dataset").select("_row", "province", "year", "stock_10k")


@query("e2_source_registry", "SELECT source_id, source_name, source_url FROM reg", REG_SCOPED)
def _(v: Views) -> DataFrame:
    from evidencepanel.sources.readers import read_panel

    return read_panel(v.spark, f"{_pack(v)[1]}/source_registry").select("source_id", "source_name", "source_url")


@query("e2_source_ids", f"SELECT DISTINCT r_id AS source_id FROM resolved WHERE {VALUED} AND coalesce(r_id, '') <> ''", REG_SCOPED)
def _(v: Views) -> DataFrame:
    return v.spark.read.schema("source_id string").json(f"{_pack(v)[1]}/source_ids")


@query("e2_records", f"SELECT _row + 1 AS row_index, match_mode, {s('year')} AS key_year FROM resolved WHERE {VALUED}", REG_SCOPED)
def _(v: Views) -> DataFrame:
    schema = "row_index bigint, row_key map<string,string>, provenance struct<match_mode:string>"
    back = v.spark.read.schema(schema).json(f"{_pack(v)[1]}/evidence_records")
    return back.select("row_index", "provenance.match_mode", F.col("row_key")["year"].alias("key_year"))


@query(
    "e2_evidence_pack",
    f"""SELECT (SELECT count(*) FROM panel) AS total_dataset_rows, (SELECT count(*) FROM registry) AS total_registry_rows,
          (SELECT count(*) FROM reg) AS registry_rows_in_scope, count(*) AS evidence_record_count,
          count(*) FILTER (match_mode = 'source_id') AS n_source_id, count(*) FILTER (match_mode = 'unmatched') AS n_unmatched,
          count(*) FILTER ({s('source_level')} = 'C') AS n_level_c, count(DISTINCT nullif(coalesce(r_id, ''), '')) AS unique_source_id_count
        FROM resolved WHERE {VALUED}""",
    REG_SCOPED,
)
def _(v: Views) -> DataFrame:
    out, _path = _pack(v)
    return out.select(
        "total_dataset_rows",
        "total_registry_rows",
        "registry_rows_in_scope",
        "evidence_record_count",
        F.col("match_summary.source_id").alias("n_source_id"),
        F.col("match_summary.unmatched").alias("n_unmatched"),
        F.col("source_level_summary.C").alias("n_level_c"),
        "unique_source_id_count",
    )


@query(
    "s3_write_evidence",
    f"SELECT _row + 1 AS row_index, match_mode, {s('year')} AS key_year FROM resolved WHERE {VALUED}",
    matched(),
)
def _(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "records")
    writers.write_evidence(sc.evidence_records(v.panel, v.registry, value_cols=VALUES), path)
    schema = "row_index bigint, row_key map<string,string>, provenance struct<match_mode:string>"
    back = v.spark.read.schema(schema).json(path)
    return back.select("row_index", "provenance.match_mode", F.col("row_key")["year"].alias("key_year"))


@query(
    "s8_e3_scorecard_report",
    "SELECT filled_row_count, mode_unmatched, \"level_C\" AS level_c, fill_rate, overall_score FROM ("
    + _card_sql("(k_province, k_year)", f"{30 * len(YEARS)}::BIGINT")
    + ")",
    KEYED + ", " + REG_SCOPED,
)
def _(v: Views) -> DataFrame:
    card = sc.scorecard(v.panel, v.registry, "stock_10k", VALUES, ["province", "year"], YEARS)
    path = scratch_path(v.spark, "report")
    writers.write_report(sc.scorecard_report(card, "stock_10k", ["province", "year"], VALUES), path)
    back = v.spark.read.json(path)
    return back.select(
        "counts.filled_row_count",
        F.col("distributions.match_mode.unmatched").alias("mode_unmatched"),
        F.col("distributions.source_level.C").alias("level_c"),
        "metrics.fill_rate",
        "metrics.overall_score",
    )


