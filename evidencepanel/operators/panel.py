"""Panel algebra: merge, fill, upsert, patch, grid, assemble, compare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, Dim, EntityDim, resolve_entity
from evidencepanel.functions.text import has_text, is_blank, raw, strip, to_int, to_number
from evidencepanel.operators.groups import ROW, key_hash, need, pick_by, same_key
from evidencepanel.plans.session import written_once

# CO2 factors per ton of fuel.
GASOLINE_FACTOR = 2.925
DIESEL_FACTOR = 3.096


def merge_panel(
    base: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | None = None,
    entity_form: str | None = None,
    dim: Dim = PROVINCES,
    entity_col: str = "province",
    order: str = ROW,
) -> DataFrame:
    """New cells overwrite base cells of the same key unless they are blank.

    The whole last new row of a key counts, so a blank in it hides an earlier
    value.  ``_written`` holds the number of cells written per row.
    """
    need(base, *keys)
    need(new, *keys, order)
    cols = list(cols) if cols is not None else [c for c in new.columns if c not in (*keys, order)]
    known = [c for c in cols if c in new.columns]

    bring = bool(entity_form) and entity_col in keys
    if bring:
        new = resolve_entity(new, entity_col, dim, entity_form)

    def new_key(k: str) -> Column:
        return F.coalesce("_entity", raw(k)) if bring and k == entity_col else raw(k)

    patch = new.select(
        *[new_key(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[raw(c).alias(f"_c{i}") for i, c in enumerate(known)],
        F.col(order).alias("_o"),
    )
    patch = pick_by(patch, [f"_k{i}" for i in range(len(keys))], "_o", last=True)
    joined = base.join(patch, same_key((raw(base[k]), patch[f"_k{i}"]) for i, k in enumerate(keys)), "left")
    writes = {c: has_text(patch[f"_c{i}"]) for i, c in enumerate(known)}

    def cell(c: str) -> Column:
        old = raw(base[c]) if c in base.columns else F.lit("")
        return F.when(writes[c], patch[f"_c{known.index(c)}"]).otherwise(old) if c in writes else old

    out = [cell(c).alias(c) if c in cols else base[c] for c in base.columns]
    out += [cell(c).alias(c) for c in cols if c not in base.columns]
    written = sum((w.cast("int") for w in writes.values()), F.lit(0))
    return joined.select(*out, written.alias("_written"))


def cells_written(merged: DataFrame) -> DataFrame:
    return merged.agg(F.coalesce(F.sum("_written"), F.lit(0)).cast("bigint").alias("cells_written"))


def reference_fill(
    data: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    value_col: str,
    years: Sequence[str | int] = (),
    year_col: str = "year",
    order: str = ROW,
) -> DataFrame:
    """Fills blank cells from the last reference row of the key; never overwrites.

    ``_scanned`` marks rows in the listed years (all, when none are listed) and
    ``_filled`` rows that got a value.
    """
    need(data, *keys, value_col)
    need(ref, *keys, value_col, order)
    names = [f"_k{i}" for i in range(len(keys))]
    side = ref.select(
        *[strip(k).alias(n) for k, n in zip(keys, names)], strip(value_col).alias("_ref"), F.col(order).alias("_o")
    )
    side = pick_by(side, names, "_o", last=True)
    joined = data.join(side, same_key((strip(data[k]), side[n]) for k, n in zip(keys, names)), "left")
    scanned = strip(data[year_col]).isin([str(y) for y in years]) if years else F.lit(True)
    fills = scanned & is_blank(data[value_col]) & has_text(side["_ref"])
    cells = [
        F.when(fills, side["_ref"]).otherwise(data[c]).alias(c) if c == value_col else data[c] for c in data.columns
    ]
    return joined.select(*cells, scanned.alias("_scanned"), fills.alias("_filled"))


def fill_counts(filled: DataFrame) -> DataFrame:
    return filled.agg(
        F.coalesce(F.sum(F.col("_scanned").cast("bigint")), F.lit(0)).alias("scanned"),
        F.coalesce(F.sum(F.col("_filled").cast("bigint")), F.lit(0)).alias("filled"),
    )


def panel_skeleton(
    dim: Dim,
    first_year: int,
    last_year: int,
    form: str = "full",
    blank_cols: Sequence[str] = (),
    spark: SparkSession | None = None,
) -> DataFrame:
    """Every entity in every year, in dimension order, with blank columns.

    The years are a generated sequence per entity, so no join is involved.
    """
    if isinstance(dim, EntityDim):
        dim = dim.frame(spark or SparkSession.active())
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    return dim.select(
        "ordinal", F.col(form).alias("province"), years.alias("year"), *[F.lit("").alias(c) for c in blank_cols]
    )


def assemble_panel(
    skeleton: DataFrame,
    parts: Sequence[DataFrame],
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = ("province", "year"),
    dim: Dim = PROVINCES,
    entity_col: str = "province",
    form: str = "full",
) -> DataFrame:
    """Left-joins every part onto the skeleton, entity names brought to one form."""
    out = skeleton
    for part in parts:
        side = part
        if entity_col in keys:
            side = resolve_entity(part, entity_col, dim, form)
            side = side.withColumn(entity_col, F.coalesce("_entity", raw(entity_col))).drop("_entity")
        for k in keys:
            side = side.withColumn(k, side[k].cast(skeleton.schema[k].dataType))
        out = out.join(side, list(keys), "left")
    out = out.select(*columns) if columns else out
    return out.orderBy(*keys)


def derive_ratios(df: DataFrame) -> DataFrame:
    """Per-head output, urban share and tertiary share; null on division by zero."""
    people = F.col("resident_population_10k_person")
    return df.withColumns(
        {
            "gdp_per_capita_yuan": F.try_divide(F.col("gdp_100m_cny") * 10000, people),
            "urbanization_rate": F.try_divide(F.col("urban_population_10k_person"), people),
            "tertiary_share": F.try_divide(F.col("tertiary_value_added_100m_cny"), F.col("gdp_100m_cny")),
        }
    )


def estimate_emission(
    df: DataFrame,
    gasoline: str = "gasoline_consumption_10k_ton",
    diesel: str = "diesel_consumption_10k_ton",
    out: str = "transport_co2_est_10k_ton",
) -> DataFrame:
    """Weighted fuel sum; a ``*_filled`` twin stands in for a missing cell."""

    def fuel(name: str) -> Column:
        twin = f"{name}_filled"
        return F.coalesce(F.col(name), F.col(twin)) if twin in df.columns else F.col(name)

    df = df.withColumns({gasoline: fuel(gasoline), diesel: fuel(diesel)})
    return df.withColumn(out, F.col(gasoline) * GASOLINE_FACTOR + F.col(diesel) * DIESEL_FACTOR)


def upsert(
    existing: DataFrame,
    new: DataFrame,
    entity_col: str = "province",
    year_col: str = "year",
    order: str = ROW,
) -> DataFrame:
    """New rows replace existing rows of the same key whole.

    Existing rows without an entity or with year 0 go.  Both sides meet in one
    aggregate: (side, order) decides, so no join and no second shuffle is needed.
    """
    need(existing, entity_col, year_col, order)
    need(new, entity_col, year_col, order)
    cols = existing.columns
    old_year, new_year = F.coalesce(to_int(year_col), F.lit(0)), to_int(year_col)
    old = existing.select(*cols, strip(entity_col).alias("_e"), old_year.alias("_y"), F.lit(0).alias("_side"))
    old = old.where((F.col("_e") != "") & (F.col("_y") != 0))
    fresh = new.select(
        *[(F.col(c) if c in new.columns else F.lit(None).cast("string")).alias(c) for c in cols],
        raw(entity_col).alias("_e"),
        new_year.alias("_y"),
        F.lit(1).alias("_side"),
    )
    both = old.unionByName(fresh)
    picked = both.groupBy(key_hash(["_e", "_y"]), "_e", "_y").agg(F.max_by(F.struct(*cols), F.struct("_side", order)).alias("_pick"))
    return picked.orderBy("_e", "_y").select(*[F.col("_pick")[c].alias(c) for c in cols])


def overwrite_columns(
    panel: DataFrame,
    patch: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = ("province", "year"),
    years: Sequence[str | int] = (),
    require: str | None = None,
    year_col: str = "year",
    order: str = ROW,
) -> DataFrame:
    """Copies columns from the last patch row of the key into the panel.

    ``years`` limits the rows touched; ``require`` names a patch column that
    must hold text.  ``_updated`` marks the touched rows.
    """
    need(panel, *keys)
    need(patch, *keys, order)
    names = [f"_k{i}" for i in range(len(keys))]
    tests = [has_text(require).alias("_ok")] if require else [F.lit(True).alias("_ok")]
    side = patch.select(
        *[strip(k).alias(n) for k, n in zip(keys, names)],
        *[(raw(c) if c in patch.columns else F.lit("")).alias(f"_c{i}") for i, c in enumerate(cols)],
        *tests,
        F.col(order).alias("_o"),
    )
    side = pick_by(side, names, "_o", last=True)
    joined = panel.join(side, same_key((strip(panel[k]), side[n]) for k, n in zip(keys, names)), "left")
    gate = strip(panel[year_col]).isin([str(y) for y in years]) if years else F.lit(True)
    hit = gate & F.coalesce(side["_ok"], F.lit(False))
    spot = {c: side[f"_c{i}"] for i, c in enumerate(cols)}

    def cell(c: str) -> Column:
        old = panel[c] if c in panel.columns else F.lit("")
        return F.when(hit, spot[c]).otherwise(old).alias(c)

    kept = [cell(c) if c in spot else panel[c] for c in panel.columns]
    added = [cell(c) for c in cols if c not in panel.columns]
    return joined.select(*kept, *added, hit.alias("_updated"))


def shared_columns(left: DataFrame, right: DataFrame, keys: Sequence[str] = ()) -> dict[str, list[str]]:
    """Column sets of two tables; reads schemas only."""
    a, b = left.columns, right.columns
    return {
        "shared": [c for c in a if c in b and c not in keys],
        "left_only": [c for c in a if c not in b],
        "right_only": [c for c in b if c not in a],
    }


def compare_panels(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("province", "year"), tolerance: float = 1e-9
) -> DataFrame:
    """Numeric differences per shared column over matching keys.

    All columns are measured in one global aggregate; only its single row is
    turned into one row per column.
    """
    shared = sorted(c for c in shared_columns(left, right, keys)["shared"] if c != ROW)
    a = left.select(*keys, *[to_number(c).alias(f"_a{i}") for i, c in enumerate(shared)])
    b = right.select(*keys, *[to_number(c).alias(f"_b{i}") for i, c in enumerate(shared)])
    diffs = a.join(b, list(keys), "inner").select(
        *[F.abs(F.col(f"_a{i}") - F.col(f"_b{i}")).alias(f"_d{i}") for i in range(len(shared))]
    )
    measures: list[Column] = []
    for i in range(len(shared)):
        d = F.col(f"_d{i}")
        measures += [
            F.count(d).alias(f"n{i}"),
            F.count(F.when(d > tolerance, d)).alias(f"u{i}"),
            F.max(d).alias(f"x{i}"),
            F.avg(d).alias(f"m{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("both_non_na"),
            F.col(f"u{i}").alias("unequal_count"),
            F.coalesce(f"x{i}", F.lit(0.0)).alias("max_abs_diff"),
            F.coalesce(f"m{i}", F.lit(0.0)).alias("mean_abs_diff"),
        )
        for i, c in enumerate(shared)
    ]
    return diffs.agg(*measures).select(F.inline(F.array(*rows)))


def check_merge_invariant(before: DataFrame, after: DataFrame, source: DataFrame, value_col: str) -> DataFrame:
    """Rows kept by a merge, and cells filled against the cells the source holds."""

    def facts(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(has_text(value_col).cast("bigint")), F.lit(0)).alias("v"),
        ).select(F.lit(name).alias("side"), "n", "v")

    sides = facts(before, "before").unionByName(facts(after, "after")).unionByName(facts(source, "source"))

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(column)))

    seen = sides.agg(
        of("before", "n").alias("rows_before"),
        of("after", "n").alias("rows_after"),
        of("after", "v").alias("values_after"),
        of("source", "v").alias("values_source"),
    )
    return seen.withColumns(
        {
            "rows_kept": F.col("rows_before") == F.col("rows_after"),
            "values_match": F.col("values_after") == F.col("values_source"),
        }
    )


def fill_with_status(
    panel: DataFrame,
    specs: DataFrame,
    pages: DataFrame,
    value_col: str,
    access_date: str,
    note_prefix: str = "Round3严格补采; ",
    order: str = ROW,
    evidence_chars: int | None = None,
    text_order: str | None = None,
) -> dict[str, DataFrame]:
    """Tries one source rule per spec against stored page text.

    ``specs`` holds province, year, source_id, source_level, source_name,
    source_url, pattern, note and an order; ``pages`` holds url and text.
    Specs of one key act in order: the first that works fills the cell and the
    later ones find it filled.  Of several texts of an address all are tried, the first
    with a match by ``text_order`` (the text itself if not named) counts.  Gives
    ``evidence``, ``panel`` and ``registry``, all read from one stored table of the
    tried specs.  ``evidence_chars`` cuts the evidence.
    """
    from evidencepanel.functions.extraction import extract_with_window

    keys = ["province", "year"]
    need(panel, *keys, value_col, "source_url", order)
    need(specs, *keys, "source_id", "source_level", "source_name", "source_url", "pattern", "note", order)
    cells = pick_by(
        panel.select(
            *[raw(k).alias(k) for k in keys],
            raw(value_col).alias("_old"),
            raw("source_url").alias("_old_url"),
            F.col(order).alias("_o"),
        ),
        keys,
        "_o",
        last=True,
    )
    cells = cells.select(F.col("province").alias("_p"), F.col("year").alias("_y"), "_old", "_old_url")
    by_cell = same_key([(specs["province"], cells["_p"]), (specs["year"], cells["_y"])])
    tried = specs.join(cells, by_cell, "left").select(*[specs[c] for c in specs.columns], "_old", "_old_url")
    texts = pages.select(
        F.col("url").alias("_url"),
        F.regexp_replace("text", r"(?U)[\s\x1c-\x1f]+", " ").alias("_text"),
        (F.col(text_order) if text_order else F.col("text")).alias("_at"),
    )
    rules = tried.select(order, F.col("source_url").alias("_u"), "pattern")
    # One row per spec and text; a spec keeps the match of the first text that has one.
    met = rules.join(texts, same_key([(rules["_u"], texts["_url"])])).select(
        order, "_at", F.col("_text").isNotNull().alias("_has"), extract_with_window("_text", "pattern").alias("_m")
    )
    hits = met.groupBy(F.col(order).alias("_n")).agg(
        F.max("_has").alias("_has_text"), F.min_by("_m", F.when(F.col("_m").isNotNull(), F.col("_at"))).alias("_hit")
    )
    tried = tried.join(hits, same_key([(tried[order], hits["_n"])]), "left").drop("_n")
    has_page = F.coalesce("_has_text", F.lit(False))
    works = F.col("_old").isNotNull() & is_blank("_old") & F.col("_hit").isNotNull()
    tried = written_once(tried.withColumn("_works", works), "tried")
    winner = (
        tried.where("_works")
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct(F.col("_hit.value").alias("w_value"), F.col("source_url").alias("w_url")), order).alias("w"),
            F.min(order).alias("_first"),
        )
        .select(*[F.col(k).alias(f"_{k}") for k in keys], "w.w_value", "w.w_url", "_first")
    )
    done = tried.join(winner, same_key((tried[k], winner[f"_{k}"]) for k in keys), "left").drop(*[f"_{k}" for k in keys])
    later = F.col("_first").isNotNull() & (F.col(order) > F.col("_first"))
    is_first = F.col("_works") & (F.col(order) == F.col("_first"))
    status = (
        F.when(F.col("_old").isNull(), F.lit("error"))
        .when(has_text("_old") | later, F.lit("skipped_already_filled"))
        .when(is_first, F.lit("ok"))
        .otherwise(F.lit("error"))
    )
    error = (
        F.when(F.col("_old").isNull(), F.lit("panel_row_not_found"))
        .when(has_text("_old") | later | is_first, F.lit(""))
        .when(~has_page, F.lit("no_text"))
        .otherwise(F.lit("regex_not_matched"))
    )
    skipped = F.col("status") == "skipped_already_filled"
    shown = F.col("_hit.evidence") if evidence_chars is None else F.substring("_hit.evidence", 1, evidence_chars)
    done = done.withColumns({"status": status, "error": error})
    evidence = done.select(
        order,
        *keys,
        "status",
        F.when(F.col("status") == "ok", F.col("_hit.value"))
        .when(skipped, F.when(has_text("_old"), F.col("_old")).otherwise(F.col("w_value")))
        .otherwise(F.lit(""))
        .alias("value"),
        F.when(skipped, F.when(has_text("_old"), F.col("_old_url")).otherwise(F.col("w_url")))
        .otherwise(F.col("source_url"))
        .alias("source_url"),
        F.when(F.col("status") == "ok", shown).otherwise(F.lit("")).alias("evidence"),
        "error",
    )
    ok = done.where(F.col("status") == "ok")
    patch = ok.select(
        order,
        *keys,
        F.col("_hit.value").alias(value_col),
        "source_id",
        "source_level",
        "source_name",
        "source_url",
        F.lit("").alias("publish_date"),
        F.lit(access_date).alias("access_date"),
        shown.alias("evidence"),
        F.concat(F.lit(note_prefix), raw("note")).alias("note"),
    )
    fresh = ok.select(
        order,
        "source_id",
        F.lit(value_col).alias("variable"),
        "source_level",
        "source_name",
        "source_url",
        F.lit("").alias("cross_check_url"),
        F.lit("").alias("publish_date"),
        F.lit(access_date).alias("access_date"),
        F.lit("").alias("evidence_file"),
        F.lit("0").alias("is_primary"),
        "note",
    )
    cols = [c for c in patch.columns if c not in (order, *keys)]
    return {
        "evidence": evidence,
        "panel": overwrite_columns(panel, patch, cols, keys, order=order),
        "registry": fresh,
    }

