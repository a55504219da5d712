"""Match summaries, the weighted quality scorecard, evidence records and packs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, Dim
from evidencepanel.functions.grading import LEVEL_SCORES
from evidencepanel.functions.text import has_text, has_value, raw, strip
from evidencepanel.operators.coverage import universe_size, with_key_columns
from evidencepanel.operators.groups import ROW, need
from evidencepanel.operators.registry import UNMATCHED, match_registry, registry_scope, resolve_provenance
from evidencepanel.plans.session import written_once

# Weights of the overall score and the provenance columns.
SCORE_WEIGHTS: dict[str, float] = {
    "fill_rate": 0.35,
    "provenance_completeness_rate": 0.20,
    "registry_match_rate": 0.20,
    "source_quality_score": 0.15,
    "c_cross_check_rate": 0.10,
}
PROVENANCE_COLUMNS = (
    "source_id",
    "source_level",
    "source_name",
    "source_url",
    "cross_check_url",
    "access_date",
    "note",
)
COMPLETE_FIELDS = (
    "resolved_source_id",
    "resolved_source_level",
    "resolved_source_name",
    "resolved_source_url",
    "access_date",
)
MATCH_MODES = ("source_id", "source_tuple", UNMATCHED)


def provenance_frame(panel: DataFrame, reg: DataFrame, variable: str = "", order: str = ROW) -> DataFrame:
    """Panel rows with their registry match and resolved provenance."""
    return resolve_provenance(match_registry(panel, registry_scope(reg, variable), order))


def match_summary(resolved: DataFrame, level: str = "resolved") -> DataFrame:
    """Rows per match mode and per source level, as (kind, name, count).

    ``level='own'`` counts the level written in the row, ``'resolved'`` the one
    after the registry filled it.  Blank levels are not counted.
    """
    field = {"own": "provenance.source_level", "resolved": "provenance.resolved_source_level"}[level]
    return _summed(resolved.groupBy("match_mode", F.col(field).alias("_level")).agg(F.count(F.lit(1)).alias("_n")))


def _summed(rows: DataFrame) -> DataFrame:
    """(kind, name, count) from numbers ``_n`` of rows by match mode and level."""
    pairs = F.array(
        F.struct(F.lit("match_mode").alias("kind"), F.col("match_mode").alias("name")),
        F.struct(F.lit("source_level").alias("kind"), F.col("_level").alias("name")),
    )
    long = rows.select(F.explode(pairs).alias("p"), "_n").select("p.*", "_n")
    return long.where(F.col("name") != "").groupBy("kind", "name").agg(F.sum("_n").alias("count"))


def _percent(part: Column, whole: Column, empty: float) -> Column:
    return F.bround(F.coalesce(F.try_divide(part, whole) * 100, F.lit(empty)), 4)


def scorecard(
    panel: DataFrame,
    reg: DataFrame,
    variable: str = "",
    value_cols: Sequence[str] = (),
    keys: Sequence[str] = ("province", "year"),
    years: Sequence[int] | None = None,
    dim: Dim = PROVINCES,
    order: str = ROW,
) -> DataFrame:
    """Counts, level and mode distributions and the five metrics, as one row.

    The panel is read once: matched, folded per key with partial sums, then
    folded to one row.  Level scores are whole numbers, so sums are exact.
    """
    need(panel, *keys, *value_cols)
    rows = provenance_frame(panel, reg, variable, order)
    p = "provenance."
    # Provenance fields are stripped already.
    present = sum(((F.col(p + f) != "").cast("int") for f in COMPLETE_FIELDS), F.lit(0))
    crossed = (F.col(p + "cross_check_url") != "") | F.coalesce(has_text("registry.cross_check_url"), F.lit(False))
    # Facts of a row first, each computed once; the sums below only read them.
    names = [f"k_{k}" for k in keys]
    rows, key_cells = with_key_columns(rows, keys, dim)
    facts = rows.select(
        *key_cells,
        has_value(value_cols).alias("valued"),
        F.col("match_mode").alias("mode"),
        F.col(p + "resolved_source_level").alias("level"),
        present.alias("present"),
        crossed.alias("crossed"),
    )
    level, mode = F.col("level"), F.col("mode")
    quality = F.lit(0)
    for name, points in LEVEL_SCORES.items():
        quality = F.when(level == name, F.lit(int(points))).otherwise(quality)

    def tally(test: Column, amount: Column | None = None) -> Column:
        return F.sum(F.when(F.col("valued") & test, amount if amount is not None else F.lit(1)).otherwise(F.lit(0)))

    yes = F.lit(True)
    sums: dict[str, Column] = {
        "rows": F.count(F.lit(1)),
        "filled": tally(yes),
        "fields": tally(yes, F.col("present")),
        "levels": tally(level != ""),
        "points": tally(level != "", quality),
        "c_rows": tally(level == "C"),
        "c_crossed": tally((level == "C") & F.col("crossed")),
        **{f"mode_{m}": tally(mode == m) for m in MATCH_MODES},
        **{f"level_{name}": tally(level == name) for name in LEVEL_SCORES},
        "level_other": tally((level != "") & ~level.isin(*LEVEL_SCORES)),
    }
    per_key = facts.groupBy(*names).agg(*[c.alias(n) for n, c in sums.items()])
    whole = per_key.agg(
        F.count(F.lit(1)).alias("unique_keys"),
        F.count(F.when(F.col("filled") > 0, 1)).alias("filled_keys"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums],
    )
    reg_counts = reg.agg(
        F.count(F.lit(1)).alias("registry_row_count"),
        F.count(F.when(F.lit(True) if not variable else strip("variable") == variable, 1)).alias(
            "registry_rows_in_scope"
        ),
    )
    fixed = universe_size(keys, years, dim)
    expected = fixed.cast("bigint") if fixed is not None else F.col("unique_keys")
    filled = F.col("filled")
    table = whole.select(
        F.col("rows").alias("data_row_count"),
        # Scalar subqueries: two counts over the registry, no join.
        reg_counts.select("registry_row_count").scalar().alias("registry_row_count"),
        reg_counts.select("registry_rows_in_scope").scalar().alias("registry_rows_in_scope"),
        F.col("unique_keys").alias("data_unique_key_count"),
        expected.alias("expected_key_count"),
        F.col("filled_keys").alias("filled_key_count"),
        filled.alias("filled_row_count"),
        *[F.col(f"mode_{m}") for m in MATCH_MODES],
        *[F.col(f"level_{n}") for n in (*LEVEL_SCORES, "other")],
        _percent(F.col("filled_keys"), expected, 0.0).alias("fill_rate"),
        F.bround(F.coalesce(F.try_divide(F.col("fields") * 20, filled), F.lit(0.0)), 4).alias(
            "provenance_completeness_rate"
        ),
        _percent(filled - F.col(f"mode_{UNMATCHED}"), filled, 0.0).alias("registry_match_rate"),
        _percent(F.col("c_crossed"), F.col("c_rows"), 100.0).alias("c_cross_check_rate"),
        F.bround(F.coalesce(F.try_divide(F.col("points"), F.col("levels")), F.lit(0.0)), 4).alias(
            "source_quality_score"
        ),
    )
    return table.withColumn("overall_score", overall_score())


def overall_score(weights: Mapping[str, float] = SCORE_WEIGHTS) -> Column:
    """Weighted sum of the five metrics of a scorecard row."""
    score = F.lit(0.0)
    for name, weight in weights.items():
        score = score + F.col(name) * F.lit(weight)
    return F.bround(score, 4)


def scorecard_report(
    card: DataFrame,
    variable: str = "",
    keys: Sequence[str] = ("province", "year"),
    value_cols: Sequence[str] = (),
) -> DataFrame:
    """A scorecard row as one nested report document."""

    def group(names: Sequence[str], prefix: str = "") -> Column:
        return F.struct(*[F.col(prefix + n).alias(n) for n in names])

    counts = (
        "data_row_count",
        "registry_row_count",
        "registry_rows_in_scope",
        "data_unique_key_count",
        "expected_key_count",
        "filled_key_count",
        "filled_row_count",
    )
    return card.select(
        F.current_timestamp().alias("generated_at_utc"),
        F.lit(variable).alias("variable_filter"),
        F.array(*[F.lit(k) for k in keys]).alias("key_columns"),
        (F.array(*[F.lit(c) for c in value_cols]) if value_cols else F.array().cast("array<string>")).alias(
            "value_columns"
        ),
        group(counts).alias("counts"),
        F.struct(
            group((*LEVEL_SCORES, "other"), "level_").alias("source_level"),
            group(MATCH_MODES, "mode_").alias("match_mode"),
        ).alias("distributions"),
        group((*SCORE_WEIGHTS, "overall_score")).alias("metrics"),
    )


def _text_map(names: Sequence[str], cell) -> Column:
    if not names:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for n in names for x in (F.lit(n), cell(n))])


def evidence_records(
    panel: DataFrame,
    reg: DataFrame,
    keys: Sequence[str] = ("province", "year"),
    value_cols: Sequence[str] = (),
    variable: str = "",
    order: str = ROW,
) -> DataFrame:
    """Valued rows as nested records: key, values, provenance and the whole row.

    ``row_index`` counts from 2 over all rows, valued or not, where ``order`` numbers the
    rows from 1 as ``read_panel`` does; else it is the order value plus one.
    """
    columns = [c for c in panel.columns if c != order]
    chosen = list(value_cols) or [c for c in columns if c not in (*keys, *PROVENANCE_COLUMNS)]
    valued = panel.where(has_value(value_cols))
    rows = provenance_frame(valued, reg, variable, order)
    values = F.map_filter(_text_map(chosen, strip), lambda _, v: v != "")
    return rows.select(
        (F.col(order) + 1).cast("bigint").alias("row_index"),
        _text_map(list(keys), strip).alias("row_key"),
        values.alias("values"),
        "provenance",
        _text_map(columns, raw).alias("row"),
    )


def evidence_pack(
    panel: DataFrame,
    reg: DataFrame,
    out_dir: str,
    keys: Sequence[str] = ("province", "year"),
    value_cols: Sequence[str] = (),
    variable: str = "",
    order: str = ROW,
) -> DataFrame:
    """Writes dataset, scoped registry, records, used source ids and manifest.

    The used source ids are a table of their own, since their number grows with
    the registry; the manifest holds their count.  Returns the manifest row.
    """
    from evidencepanel.sources.writers import write_evidence, write_panel, write_report

    root = PurePosixPath(out_dir) if "://" not in out_dir else None

    def at(name: str) -> str:
        return str(root / name) if root else f"{out_dir.rstrip('/')}/{name}"

    scope = registry_scope(reg, variable)
    write_panel(panel, at("dataset"), [c for c in panel.columns if c != order], order=order, keep_empty=True)
    write_panel(scope, at("source_registry"), [c for c in reg.columns if c != order], order=order, keep_empty=True)
    records = evidence_records(panel, reg, keys, value_cols, variable, order)
    # Records are computed once, into the pack; all that follows reads them there.
    write_evidence(records, at("evidence_records"))
    records = panel.sparkSession.read.schema(records.schema).json(at("evidence_records"))
    # One scan folds them to a row per source, mode and level; ids, summary and counts come from that.
    folded = written_once(
        records.groupBy(
            F.col("provenance.match_mode").alias("match_mode"),
            F.col("provenance.source_level").alias("_level"),
            F.col("provenance.resolved_source_id").alias("source_id"),
        ).agg(F.count(F.lit(1)).alias("_n")),
        "folded-records",
    )
    used = folded.where("source_id <> ''").select("source_id").distinct()
    used.orderBy("source_id").write.mode("overwrite").json(at("source_ids"))
    summary = _summed(folded)
    # Levels are free text, so their full counts are a table; the manifest has
    # the known ones and the rest as one number.
    summary.write.mode("overwrite").json(at("summary"))
    kind, name, count = F.col("kind"), F.col("name"), F.col("count")

    def counted(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, count)), F.lit(0))

    modes = [counted((kind == "match_mode") & (name == m)).alias(m) for m in MATCH_MODES]
    known = [counted((kind == "source_level") & (name == n)).alias(n) for n in LEVEL_SCORES]
    rest = counted((kind == "source_level") & ~name.isin(*LEVEL_SCORES)).alias("other")
    manifest = summary.agg(
        F.struct(*modes).alias("match_summary"), F.struct(*known, rest).alias("source_level_summary")
    ).select(
        F.current_timestamp().alias("generated_at_utc"),
        F.lit(variable).alias("variable_filter"),
        F.array(*[F.lit(k) for k in keys]).alias("key_columns"),
        (F.array(*[F.lit(c) for c in value_cols]) if value_cols else F.array().cast("array<string>")).alias(
            "value_columns"
        ),
        panel.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_dataset_rows"),
        reg.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_registry_rows"),
        scope.agg(F.count(F.lit(1)).alias("n")).scalar().alias("registry_rows_in_scope"),
        folded.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar().alias("evidence_record_count"),
        "match_summary",
        "source_level_summary",
        used.agg(F.count(F.lit(1)).alias("n")).scalar().alias("unique_source_id_count"),
    )
    write_report(manifest, at("manifest"))
    return panel.sparkSession.read.json(at("manifest"))
