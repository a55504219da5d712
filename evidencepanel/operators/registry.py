"""Source registry: matching, provenance, consistency checks, upkeep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.functions.text import any_of, first_text, has_text, has_value, is_blank, raw, strip
from evidencepanel.operators.groups import ROW, keep_first, need, number_rows, pick_by, same_key, top_per_group
from evidencepanel.plans.session import written_once

TUPLE = ("source_level", "source_name", "source_url")
UNMATCHED = "unmatched"

# Columns of a source registry, and issue texts.
REGISTRY_COLUMNS = (
    "source_id",
    "variable",
    "source_level",
    "source_name",
    "source_url",
    "cross_check_url",
    "publish_date",
    "access_date",
    "evidence_file",
    "is_primary",
    "note",
)
NO_SOURCE_ID = "缺少source_id"
UNKNOWN_SOURCE_ID = "source_id未在registry找到: "


def registry_scope(reg: DataFrame, variable: str = "", exact: bool = False) -> DataFrame:
    """Rows of one variable.  A blank name means all rows unless ``exact``."""
    if not variable and not exact:
        return reg
    return reg.where(strip("variable") == variable)


def _registry_side(reg: DataFrame, keys: list[Column], keep: Column, prefix: str, order: str) -> DataFrame:
    """First registry row per key as a struct, one row per key."""
    cols = [c for c in reg.columns if c != order]
    names = [f"{prefix}{i}" for i in range(len(keys))]
    side = reg.where(keep).select(
        *[k.alias(n) for k, n in zip(keys, names)],
        F.struct(*[raw(c).alias(c) for c in cols]).alias(f"{prefix}row"),
        F.col(order).alias("_o"),
    )
    return side.groupBy(*names).agg(F.min_by(f"{prefix}row", "_o").alias(f"{prefix}row"))


def match_registry(rows: DataFrame, reg: DataFrame, order: str = ROW) -> DataFrame:
    """Adds ``match_mode`` and ``registry``: by id, else by (level, name, url).

    Two equality joins against one row per key; a blank id or an all-blank
    tuple never matches.  Neither join is hinted, so the planner broadcasts a
    small registry and splits hot keys of a large one.
    """
    need(rows, "source_id", *TUPLE)
    need(reg, "source_id", *TUPLE, order)
    by_id = _registry_side(reg, [strip("source_id")], has_text("source_id"), "_i", order)
    by_tuple = _registry_side(reg, [strip(c) for c in TUPLE], any_of(has_text(c) for c in TUPLE), "_t", order)
    joined = rows.join(by_id, same_key([(strip(rows["source_id"]), by_id["_i0"])]), "left")
    joined = joined.join(by_tuple, _same_tuple(rows, by_tuple), "left")
    mode = (
        F.when(F.col("_irow").isNotNull(), F.lit("source_id"))
        .when(F.col("_trow").isNotNull(), F.lit("source_tuple"))
        .otherwise(F.lit(UNMATCHED))
    )
    return joined.select(
        *[rows[c] for c in rows.columns], mode.alias("match_mode"), F.coalesce("_irow", "_trow").alias("registry")
    )


def resolve_provenance(matched: DataFrame) -> DataFrame:
    """Adds ``provenance``: own field first, registry field when own is blank.

    Cross-check address, access date and note come from the row alone.
    """

    def own(name: str) -> Column:
        return strip(name) if name in matched.columns else F.lit("")

    four = ("source_id", *TUPLE)
    fields = [F.col("match_mode").alias("match_mode")]
    fields += [own(c).alias(c) for c in four]
    fields += [first_text(own(c), F.col(f"registry.{c}")).alias(f"resolved_{c}") for c in four]
    fields += [own(c).alias(c) for c in ("cross_check_url", "access_date", "note")]
    fields += [F.col("registry").alias("registry_record")]
    return matched.withColumn("provenance", F.struct(*fields))


def _same_tuple(rows: DataFrame, side: DataFrame) -> Column:
    return same_key((strip(rows[c]), side[f"_t{i}"]) for i, c in enumerate(TUPLE))


def _known_tuples(reg: DataFrame) -> DataFrame:
    return reg.groupBy(*[strip(c).alias(f"_t{i}") for i, c in enumerate(TUPLE)]).agg(
        F.max(has_text("cross_check_url")).alias("_crossed")
    )


def add_registry_flags(rows: DataFrame, reg: DataFrame) -> DataFrame:
    """Adds ``_in_registry``, ``_crossed`` and ``_id_known`` with two equality joins."""
    tuples = _known_tuples(reg)
    ids = reg.select(strip("source_id").alias("_sid")).distinct()
    out = rows.join(tuples, _same_tuple(rows, tuples), "left")
    flags = [F.col("_t0").isNotNull().alias("_in_registry"), F.col("_crossed")]
    if "source_id" in rows.columns:
        out = out.join(ids, same_key([(strip(rows["source_id"]), ids["_sid"])]), "left")
        flags.append(F.col("_sid").isNotNull().alias("_id_known"))
    return out.select(*[rows[c] for c in rows.columns], *flags)


def unregistered_rows(rows: DataFrame, reg: DataFrame, value_cols: Sequence[str] = ()) -> DataFrame:
    """Valued rows whose (level, name, url) is not in the registry."""
    tuples = _known_tuples(reg)
    valued = rows.where(has_value(value_cols))
    return valued.join(tuples, _same_tuple(valued, tuples), "left_anti")


def uncrossed_c_rows(rows: DataFrame, reg: DataFrame, value_cols: Sequence[str] = ()) -> DataFrame:
    """Valued level-C rows that are registered but nowhere cross-checked."""
    lacking = _known_tuples(reg.where(strip("source_level") == "C")).where(~F.col("_crossed"))
    c_rows = rows.where(has_value(value_cols) & (strip("source_level") == "C"))
    return c_rows.join(lacking, _same_tuple(c_rows, lacking), "left_semi")


def misaligned_source_ids(rows: DataFrame, reg: DataFrame, value_cols: Sequence[str] = ()) -> DataFrame:
    """Valued rows with a blank or unknown source id, with the reason."""
    if "source_id" not in rows.columns:
        return rows.where(F.lit(False)).withColumn("reason", F.lit(""))
    ids = reg.select(strip("source_id").alias("_sid")).distinct().withColumn("_known", F.lit(True))
    valued = rows.where(has_value(value_cols))
    joined = valued.join(ids, same_key([(strip(valued["source_id"]), ids["_sid"])]), "left")
    return joined.where(is_blank("source_id") | F.col("_known").isNull()).select(
        *[valued[c] for c in rows.columns], source_id_reason("source_id").alias("reason")
    )


def source_id_reason(c: str) -> Column:
    return F.when(is_blank(c), F.lit(NO_SOURCE_ID)).otherwise(F.concat(F.lit(UNKNOWN_SOURCE_ID), strip(c)))


def registry_append(reg: DataFrame, new: DataFrame, order: str = ROW) -> DataFrame:
    """Adds sources whose id is not there yet; the first new row of an id wins."""
    need(reg, "source_id")
    need(new, "source_id", order)
    keyed = new.withColumn("source_id", raw("source_id"))
    first = keep_first(keyed, ["source_id"], order)
    known = reg.select(raw("source_id").alias("source_id")).distinct()
    fresh = first.join(known, "source_id", "left_anti")
    cols = reg.columns
    fresh = fresh.select(*[F.col(c) if c in fresh.columns else F.lit("").alias(c) for c in cols])
    return reg.unionByName(fresh)


def registry_prune(reg: DataFrame, panel: DataFrame, fallback: DataFrame, order: str = ROW) -> DataFrame:
    """Only sources the panel uses, by id; the fallback registry if none is left."""
    used = panel.where(has_text("source_id")).select(strip("source_id").alias("source_id")).distinct()
    last = pick_by(reg.withColumn("source_id", raw("source_id")), ["source_id"], order, last=True)
    # Both the union and the test for an empty result read it: computed once.
    kept = written_once(last.join(used, "source_id", "left_semi").select(*reg.columns), "kept-sources")
    spare = fallback.select(*reg.columns).where(~kept.select("source_id").exists())
    return kept.unionByName(spare).orderBy("source_id")


def assign_source_ids(df: DataFrame, prefix: str, width: int = 2, order: str = ROW, out: str = "source_id") -> DataFrame:
    """Consecutive ids ``PREFIX01`` in input order, numbered in parallel."""
    numbered = number_rows(df.drop(out) if out in df.columns else df, order, "_n")
    return numbered.withColumn(out, F.format_string(f"{prefix}%0{width}d", "_n")).drop("_n")


def resolve_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One source per key: level A before B before C, then the newest, then id."""
    level = F.coalesce(F.array_position(F.array(F.lit("A"), F.lit("B"), F.lit("C")), strip("source_level")), F.lit(0))
    rank = F.when(level == 0, F.lit(9)).otherwise(level)
    order = [rank.asc(), strip("access_date").desc(), strip("source_id").asc()]
    return top_per_group(df, keys, order, 1).drop("_rank")
