"""Quality checks.  Row checks are column expressions that give an array of
issues, so any number of them runs in a single pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, Dim, form_index, resolve_entity
from evidencepanel.functions.text import (
    contains_any,
    has_text,
    has_value,
    is_blank,
    raw,
    strip,
    to_int,
    to_number,
)
from evidencepanel.operators.groups import ROW, need
from evidencepanel.operators.registry import (
    TUPLE,
    add_registry_flags,
    registry_scope,
    source_id_reason,
)

# Unit words, magnitude words and issue texts.
UNIT_WORDS = ("台", "辆", "吨", "千瓦时", "kwh", "mwh", "gwh")
MAGNITUDE_WORDS = ("万", "亿")
NOT_CONVERTED = "包含万/亿等未换算单位"
WRONG_UNIT = "单位疑似不为"
PURE_NUMBER = r"(?U)\A[-+]?\d+(\.\d+)?([eE][-+]?\d+)?\z"
BLANK_FIELD = " 不能为空"
BAD_SCORE = "score is not a number"
NULL_FIELD = " is not text"

ISSUE_FIELDS = ("check", "line", "entity", "year", "column", "raw", "reason")
# What each check means for the verdict of a round.
WARNING_ONLY = "c_cross_check"


class RowChecks:
    """Builds issue arrays for one table: line numbers and labels in one place."""

    def __init__(self, df: DataFrame, order: str = ROW, entity_col: str = "province", year_col: str = "year") -> None:
        need(df, order)
        self.df = df
        self.line = (F.col(order) + 1).cast("bigint")
        self.entity = raw(entity_col) if entity_col in df.columns else F.lit("?")
        self.year = raw(year_col) if year_col in df.columns else F.lit("?")

    def issue(self, check: str, column: str, value: Column, reason: Column | str) -> Column:
        text = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(
            F.lit(check).alias("check"),
            self.line.alias("line"),
            self.entity.alias("entity"),
            self.year.alias("year"),
            F.lit(column).alias("column"),
            value.alias("raw"),
            text.alias("reason"),
        )

    def when(self, test: Column, check: str, column: str, value: Column, reason: Column | str) -> Column:
        return F.when(test, self.issue(check, column, value, reason))

    def panel_model(self, fields: Sequence[str] = ("province", "year")) -> list[Column]:
        """First blank key field of a row."""
        present = [f for f in fields if f in self.df.columns]
        if not present:
            return []
        return [F.coalesce(*[self.when(is_blank(f), "panel_model", f, raw(f), f + BLANK_FIELD) for f in present])]

    def required(self, columns: Sequence[str], value_cols: Sequence[str] = ()) -> list[Column]:
        """Blank required cells; with value columns, only on rows that hold a value."""
        need(self.df, *columns)
        gate = has_value(value_cols)
        return [self.when(gate & is_blank(c), "required", c, raw(c), "required") for c in columns]

    def unit(self, columns: Sequence[str], expected: str) -> list[Column]:
        """Values that still carry a magnitude word or another unit."""
        need(self.df, *columns)
        out = []
        for c in columns:
            text = strip(c)
            open_text = (text != "") & ~text.rlike(PURE_NUMBER)
            other = (contains_any(text, UNIT_WORDS) | contains_any(F.lower(text), UNIT_WORDS)) & ~text.contains(
                F.lit(expected)
            )
            magnitude = contains_any(text, MAGNITUDE_WORDS)
            reason = F.when(magnitude, F.lit(NOT_CONVERTED)).otherwise(F.lit(WRONG_UNIT + expected))
            out.append(self.when(open_text & (magnitude | other), "unit", c, text, reason))
        return out

    def registry(self, value_cols: Sequence[str] = ()) -> list[Column]:
        """Needs the flags of ``add_registry_flags``."""
        gate = has_value(value_cols)
        label = F.concat_ws(" | ", *[strip(c) for c in TUPLE])
        out = [
            self.when(gate & ~F.col("_in_registry"), "unregistered", "source", label, "not in registry"),
            self.when(
                gate & (strip("source_level") == "C") & F.col("_in_registry") & ~F.col("_crossed"),
                WARNING_ONLY,
                "cross_check_url",
                strip("source_name"),
                "no cross-check address",
            ),
        ]
        if "_id_known" in self.df.columns:
            bad = is_blank("source_id") | ~F.col("_id_known")
            out.append(
                self.when(gate & bad, "source_id", "source_id", strip("source_id"), source_id_reason("source_id"))
            )
        return out

    def issues(self, checks: Sequence[Column]) -> DataFrame:
        """One pass over the table for all the given checks."""
        if not checks:
            return self.df.select(F.explode(F.array_compact(F.array(self.issue("", "", F.lit(""), "")))).alias("i")).where(
                F.lit(False)
            ).select("i.*")
        return self.df.select(F.explode(F.array_compact(F.array(*checks))).alias("i")).select("i.*")


def check_panel_model(df: DataFrame, fields: Sequence[str] = ("province", "year"), order: str = ROW) -> DataFrame:
    checks = RowChecks(df, order)
    return checks.issues(checks.panel_model(fields))


def check_required(
    df: DataFrame, required: Sequence[str], value_cols: Sequence[str] = (), order: str = ROW
) -> DataFrame:
    checks = RowChecks(df, order)
    return checks.issues(checks.required(required, value_cols))


def check_unit(df: DataFrame, columns: Sequence[str], expected: str, order: str = ROW) -> DataFrame:
    checks = RowChecks(df, order)
    return checks.issues(checks.unit(columns, expected))


def check_source_model(reg: DataFrame, order: str = ROW) -> DataFrame:
    """Registry fields default to blank; only a null cell breaks the model."""
    checks = RowChecks(reg, order)
    fields = ("source_level", "source_name", "source_url", "source_id", "variable", "cross_check_url")
    tests = [
        checks.when(F.col(f).isNull(), "source_model", f, F.lit(""), f + NULL_FIELD) for f in fields if f in reg.columns
    ]
    return checks.issues([F.coalesce(*tests)] if tests else [])


def check_candidate_model(df: DataFrame, order: str = ROW) -> DataFrame:
    """A candidate needs an address; its score, if given, must be a number."""
    need(df, "url")
    checks = RowChecks(df, order)
    tests = [checks.when(is_blank("url"), "candidate_model", "url", raw("url"), "url" + BLANK_FIELD)]
    if "score" in df.columns:
        bad = F.col("score").isNotNull() & to_number("score").isNull()
        tests.append(checks.when(bad, "candidate_model", "score", raw("score"), BAD_SCORE))
    return checks.issues([F.coalesce(*tests)])


def check_rules(df: DataFrame, rules: Mapping[str, Column], order: str = ROW) -> DataFrame:
    """Own row rules: name to a condition that must hold (null counts as broken)."""
    checks = RowChecks(df, order)
    return checks.issues(
        [checks.when(~F.coalesce(ok, F.lit(False)), name, "", F.lit(""), "rule broken") for name, ok in rules.items()]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, on the cells as stored."""
    need(df, *keys)
    groups = df.groupBy(*[raw(k).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("count"))
    return groups.where(F.col("count") > 1)


def column_coverage(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cells with text per column, in one global aggregate."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c != ROW]
    need(df, *cols)
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.when(has_text(c), 1)).alias(f"_c{i}") for i, c in enumerate(cols)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_c{i}").alias("non_blank"),
            F.col("_n").alias("total"),
            F.coalesce(F.try_divide(F.col(f"_c{i}") * 100.0, F.col("_n")), F.lit(0.0)).alias("pct"),
        )
        for i, c in enumerate(cols)
    ]
    return counts.select(F.inline(F.array(*rows)))


def range_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean of the numbers per column."""
    need(df, *cols)
    measures: list[Column] = []
    for i, c in enumerate(cols):
        x = to_number(c)
        measures += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"), F.avg(x).alias(f"m{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("n_numeric"),
            F.col(f"l{i}").alias("min_value"),
            F.col(f"h{i}").alias("max_value"),
            F.col(f"m{i}").alias("mean_value"),
        )
        for i, c in enumerate(cols)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def gate_checks(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    min_pct: float = 95.0,
    non_negative: Sequence[str] = (),
) -> DataFrame:
    """Rows beyond the first of a key, coverage per column, negative numbers.

    One shuffle by key with partial sums, then one global aggregate.  A missing
    column fails its check.
    """
    need(df, *keys)
    present = [c for c in cols if c in df.columns]
    signed = [c for c in non_negative if c in df.columns]
    sums = [F.count(F.lit(1)).alias("_n")]
    sums += [F.count(F.when(has_text(c), 1)).alias(f"_c{i}") for i, c in enumerate(present)]
    sums += [F.count(F.when(to_number(c) < 0, 1)).alias(f"_g{i}") for i, c in enumerate(signed)]
    per_key = df.groupBy(*[raw(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(*sums)
    names = [c for c in per_key.columns if not c.startswith("_k")]
    whole = per_key.agg(
        F.count(F.lit(1)).alias("_keys"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
    ).withColumn("_dup", F.col("_n") - F.col("_keys"))

    def row(check: str, column: str, count: Column, pct: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            count.cast("bigint").alias("count"),
            F.col("_n").alias("total"),
            pct.cast("double").alias("pct"),
            passed.alias("passed"),
        )

    none = F.lit(None).cast("double")
    rows = [row("duplicate_rows", ",".join(keys), F.col("_dup"), none, F.col("_dup") == 0)]
    for c in cols:
        if c in present:
            n = F.col(f"_c{present.index(c)}")
            pct = F.coalesce(F.try_divide(n * 100.0, F.col("_n")), F.lit(0.0))
            rows.append(row("coverage", c, n, pct, pct >= min_pct))
        else:
            rows.append(row("coverage", c, F.lit(0), F.lit(0.0), F.lit(False)))
    for i, c in enumerate(signed):
        rows.append(row("non_negative", c, F.col(f"_g{i}"), none, F.col(f"_g{i}") == 0))
    return whole.select(F.inline(F.array(*rows)))


def infer_value_cols(columns: Sequence[str], keys: Sequence[str], required: Sequence[str] = (), limit: int = 2) -> list[str]:
    """Columns that look like values; reads names only."""
    aside = {*keys, *required, "note", ROW}
    open_cols = [c for c in columns if c not in aside and not c.endswith("_url") and not c.startswith("source_")]
    return open_cols[:limit]


def check_numeric(df: DataFrame, cols: Sequence[str], order: str = ROW) -> DataFrame:
    """Cells with text that is not a number."""
    checks = RowChecks(df, order)
    return checks.issues(
        [checks.when(has_text(c) & to_number(c).isNull(), "numeric", c, strip(c), "not a number") for c in cols]
    )


def check_year_range(df: DataFrame, first: int, last: int, year_col: str = "year", order: str = ROW) -> DataFrame:
    checks = RowChecks(df, order, year_col=year_col)
    year = to_int(year_col)
    bad = ~F.coalesce(year.between(first, last), F.lit(False))
    return checks.issues([checks.when(bad, "year_range", year_col, strip(year_col), f"outside {first}-{last}")])


def check_entity_form(
    df: DataFrame,
    form: str = "short",
    dim: Dim = PROVINCES,
    entity_col: str = "province",
    order: str = ROW,
) -> DataFrame:
    """Entity names that are not in the one agreed form."""
    form_index(form)
    checks = RowChecks(resolve_entity(df, entity_col, dim, form), order, entity_col=entity_col)
    name = strip(entity_col)
    bad = ~F.coalesce(F.col("_entity") == name, F.lit(False))
    return checks.issues([checks.when(bad, "entity_form", entity_col, name, f"not in {form} form")])


def validate_round(
    panel: DataFrame,
    reg: DataFrame,
    variable: str,
    keys: Sequence[str] = ("province", "year"),
    required: Sequence[str] = ("source_url", "source_name", "source_level", "source_id", "access_date"),
    value_cols: Sequence[str] = (),
    expected_unit: str | None = None,
    order: str = ROW,
) -> DataFrame:
    """All issues of a round.

    Row checks and the registry checks share one pass over the panel with two
    registry joins; duplicate keys need a second pass over the key columns.
    """
    scope = registry_scope(reg, variable, exact=True)
    flagged = add_registry_flags(panel, scope)
    checks = RowChecks(flagged, order)
    rows = checks.panel_model([k for k in ("province", "year") if k in keys])
    rows += checks.required(required, value_cols)
    if expected_unit and value_cols:
        rows += checks.unit(value_cols, expected_unit)
    rows += checks.registry(value_cols)
    found = checks.issues(rows)
    dup = duplicate_keys(panel, keys)
    duplicates = dup.select(
        F.lit("duplicate_key").alias("check"),
        F.lit(None).cast("bigint").alias("line"),
        (F.col("province") if "province" in keys else F.lit("?")).alias("entity"),
        (F.col("year") if "year" in keys else F.lit("?")).alias("year"),
        F.lit(",".join(keys)).alias("column"),
        F.concat_ws(",", *keys).alias("raw"),
        F.concat(F.col("count").cast("string"), F.lit(" rows")).alias("reason"),
    )
    return found.unionByName(duplicates).unionByName(check_source_model(reg, order))


def round_verdict(issues: DataFrame, strict_cross_check: bool = False) -> DataFrame:
    """Issue counts per check, and whether each fails the round."""
    counts = issues.groupBy("check").agg(F.count(F.lit(1)).alias("n_issues"))
    fails = F.lit(True) if strict_cross_check else F.col("check") != WARNING_ONLY
    return counts.withColumn("fails_round", fails)


def round_passes(issues: DataFrame, strict_cross_check: bool = False) -> bool:
    verdict = round_verdict(issues, strict_cross_check)
    return verdict.where("fails_round").isEmpty()
