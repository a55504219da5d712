"""Gaps and coverage of a panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, Dim, EntityDim, entity_count, norm_key, normalize_entity, normalize_entity_join, resolve_entity
from evidencepanel.functions.text import any_of, has_text, has_value, raw, strip, to_int
from evidencepanel.operators.groups import need
from evidencepanel.operators.panel import panel_skeleton


@dataclass(frozen=True)
class Coverage:
    """Coverage of a panel: one summary row, rows per column and per year, filled keys."""

    summary: DataFrame
    by_column: DataFrame
    by_year: DataFrame
    filled_keys: DataFrame


def key_columns(keys: Sequence[str], known: Column | None = None) -> list[Column]:
    return [norm_key(k, known=known).alias(f"k_{k}") for k in keys]


def with_key_columns(df: DataFrame, keys: Sequence[str], dim: Dim = PROVINCES) -> tuple[DataFrame, list[Column]]:
    """The table with what its keys need, and the keys in comparable form."""
    if isinstance(dim, EntityDim):
        return df, [norm_key(k, dim).alias(f"k_{k}") for k in keys]
    if "province" not in keys:
        return df, key_columns(keys)
    return resolve_entity(df, "province", dim), key_columns(keys, F.col("_entity"))


def universe_size(keys: Sequence[str], years: Sequence[int] | None, dim: Dim) -> Column | None:
    """Entities times years when the keys are exactly these two, else unknown."""
    if years and set(keys) == {"province", "year"}:
        return entity_count(dim) * len(set(years))
    return None


def coverage_stats(
    df: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    years: Sequence[int] | None = None,
    dim: Dim = PROVINCES,
) -> Coverage:
    """Filled keys against the key universe.

    Filled keys are not clipped to the universe, so the rate can pass 100.
    """
    need(df, *keys, *value_cols)
    filled = has_value(value_cols) if value_cols else F.lit(False)
    cells = [has_text(c).alias(f"_t{i}") for i, c in enumerate(value_cols)]
    keyed, key_cells = with_key_columns(df, keys, dim)
    facts = keyed.select(*key_cells, *cells)
    texts = [F.col(f"_t{i}") for i in range(len(value_cols))]
    per_key = facts.groupBy(*[f"k_{k}" for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(any_of(texts)).alias("_filled"),
        *[F.count(F.when(t, 1)).alias(f"_c{i}") for i, t in enumerate(texts)],
    )
    fixed = universe_size(keys, years, dim)
    whole = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("all_keys_count"),
        F.count(F.when(F.col("_filled"), 1)).alias("filled_keys_count"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(value_cols))],
    )
    if fixed is not None:
        whole = whole.withColumn("all_keys_count", fixed.cast("bigint"))
    whole = whole.withColumn(
        "fill_rate",
        F.coalesce(F.try_divide(F.col("filled_keys_count"), F.col("all_keys_count")) * 100, F.lit(0.0)),
    )
    columns = [
        F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("non_blank")) for i, c in enumerate(value_cols)
    ]
    empty = "array<struct<column:string,non_blank:bigint>>"
    year = strip("year") if "year" in df.columns else F.lit("")
    by_year = (
        df.where(filled & year.rlike(r"\A[0-9]+\z"))
        .groupBy(year.try_cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("filled_rows"))
    )
    return Coverage(
        summary=whole.select("total_rows", "all_keys_count", "filled_keys_count", "fill_rate"),
        by_column=whole.select(F.inline(F.array(*columns) if columns else F.array().cast(empty))),
        by_year=by_year,
        filled_keys=per_key.where("_filled").select(*[f"k_{k}" for k in keys]),
    )


def gap_matrix(
    df: DataFrame,
    value_col: str,
    first_year: int,
    last_year: int,
    dim: Dim = PROVINCES,
    spark: SparkSession | None = None,
) -> DataFrame:
    """(year, entity) pairs without a value, entities in dimension order.

    Bad years, unknown entities and blank values do not cover anything.  The
    covered pairs are distinct before they meet the grid, so a hot entity costs
    one row per map task.
    """
    need(df, "province", "year", value_col)
    year = to_int("year")
    valued = df.where(has_text(value_col) & year.between(first_year, last_year))
    if isinstance(dim, EntityDim):
        covered = valued.select(normalize_entity(strip("province"), dim).alias("entity"), year.alias("year"))
    else:
        pairs = valued.select(strip("province").alias("province"), year.alias("year")).distinct()
        covered = normalize_entity_join(pairs, "province", dim).select("entity", "year")
    covered = covered.where(F.col("entity").isNotNull()).distinct()
    grid = panel_skeleton(dim, first_year, last_year, "short", spark=spark or df.sparkSession)
    grid = grid.select("ordinal", F.col("province").alias("entity"), "year")
    return grid.join(covered, ["entity", "year"], "left_anti").select("year", "entity", "ordinal")


def year_gap_summary(gaps: DataFrame, first_year: int, last_year: int, n_entities: int) -> DataFrame:
    """Covered and missing entities per year, with a focus rank.

    Focus: years that have gaps, the fewest first, then the earlier year.
    """
    spark = gaps.sparkSession
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    counts = gaps.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    table = years.join(counts, "year", "left").select(
        "year",
        (F.lit(n_entities) - F.coalesce("n", F.lit(0))).cast("bigint").alias("covered"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("missing"),
    )
    # One row per year: small by nature.
    ranked = F.row_number().over(_by_missing())
    return table.withColumn("_has", F.col("missing") > 0).withColumn("focus_rank", F.when(F.col("_has"), ranked)).drop("_has")


def _by_missing():
    from pyspark.sql import Window

    return Window.orderBy((F.col("missing") == 0).asc(), F.col("missing").asc(), F.col("year").asc())


def focus_years(summary: DataFrame, top: int) -> DataFrame:
    return summary.where(F.col("focus_rank") <= top).orderBy("focus_rank")


def year_status(df: DataFrame, year: int | str, value_col: str) -> DataFrame:
    """Every entity of one year with its filled flag, sorted by entity.

    One row per entity, not one list: lists would grow with the data.
    """
    need(df, "province", "year", value_col)
    return (
        df.where(strip("year") == str(year))
        .groupBy(raw("province").alias("entity"))
        .agg(F.max(has_text(value_col)).alias("filled"))
        .orderBy("entity")
    )


def gained_keys(after: DataFrame, before: DataFrame) -> DataFrame:
    """Filled keys present after and not before."""
    return after.join(before, after.columns, "left_anti").distinct()


def render_templates(
    gaps: DataFrame,
    templates: Sequence[str],
    keyword_name: str,
    value_col: str,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fills the slots of every template for every gap row.

    ``names`` maps further slots (as ``{entity}``) to columns of the gap table.
    Templates are a literal list, so they are exploded rather than joined.
    """
    numbered = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(t).alias("t")) for i, t in enumerate(templates)])
    out = gaps.select("*", F.explode(numbered).alias("_t"))
    year = F.col("year").cast("string")
    text = F.col("_t.t")
    slots: list[tuple[str, Column]] = [("{year}", year), ("{YEAR}", year)]
    slots += [("{keyword_name}", F.lit(keyword_name)), ("{value_col}", F.lit(value_col))]
    slots += [(slot, F.col(c)) for slot, c in (names or {}).items()]
    for slot, value in slots:
        text = F.replace(text, F.lit(slot), value)
    return out.select(*gaps.columns, F.col("_t.n").alias("template_no"), text.alias("query"))
