"""Rounds: what a change to a panel gained, when to stop, and the loop itself."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, Dim, entity_count, norm_key, resolve_entity
from evidencepanel.functions.text import has_text, has_value, to_int
from evidencepanel.operators.coverage import universe_size
from evidencepanel.operators.groups import ROW, need
from evidencepanel.operators.panel import merge_panel, reference_fill
from evidencepanel.operators.quality import round_passes, validate_round
from evidencepanel.plans.session import shared_dir, written_once


def _with_ids(df: DataFrame, keys: Sequence[str], first_year: int, last_year: int, dim: Dim) -> DataFrame:
    """Adds ``_id_key``, the row's key, and ``_id_pair``, the (entity, year) pair it can cover."""
    need(df, *keys, "province", "year")
    df = resolve_entity(df, "province", dim)
    entity, year = F.col("_entity"), to_int("year")
    pair = F.when(entity.isNotNull() & year.between(first_year, last_year), F.array(entity, year.cast("string")))
    key = F.array(*[norm_key(k, known=entity) for k in keys])
    return df.withColumns({"_id_key": key, "_id_pair": pair}).drop("_entity")


def _with_flags(df: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """Adds ``_had`` and ``_stood``: whether the row holds values and covers its pair, as of now."""
    return df.withColumns({"_had": has_value(value_cols), "_stood": has_text(value_cols[0])})


def _ids(
    df: DataFrame, keys: Sequence[str], value_cols: Sequence[str], first_year: int, last_year: int, dim: Dim, new: Column, was: bool = False
) -> DataFrame:
    """What every row speaks for: its key and, through the first value column, the
    (entity, year) pair it covers; on request as it was before the round (``_with_flags``)."""
    need(df, *value_cols)
    if "_id_key" not in df.columns:
        df = _with_ids(df, keys, first_year, last_year, dim)
    stands, filled = (F.col("_stood"), F.col("_had")) if was else (has_text(value_cols[0]), has_value(value_cols))
    pair = F.when(stands, F.col("_id_pair"))
    ids = F.array(
        F.struct(F.lit(True).alias("is_key"), F.col("_id_key").alias("id")), F.struct(F.lit(False).alias("is_key"), pair.alias("id"))
    )
    rows = df.select(F.explode(ids).alias("i"), filled.alias("filled"), new.alias("new"))
    return rows.select("i.is_key", "i.id", "filled", "new").where(F.col("id").isNotNull())


def _compared(rows: DataFrame) -> DataFrame:
    """One row of counts from the ids of an old and a new panel."""
    new = F.col("new")
    folded = rows.groupBy("is_key", "id").agg(
        F.max(~new).alias("in_old"),
        F.max(new).alias("in_new"),
        F.max(~new & F.col("filled")).alias("old"),
        F.max(new & F.col("filled")).alias("now"),
    )

    def count(test: Column) -> Column:
        return F.count(F.when(test, 1))

    is_key = F.col("is_key")
    return folded.agg(
        count(is_key & F.col("now") & ~F.col("old")).alias("gained_keys"),
        *[count(is_key & F.col(c)).alias(c) for c in ("in_old", "in_new", "old", "now")],
        count(~is_key & F.col("in_old")).alias("covered_old"),
        count(~is_key & F.col("in_new")).alias("covered_new"),
    )


@dataclass
class Counters:
    """What is known of a panel: keys, filled keys, covered (entity, year) pairs, and the sizes they are held against."""

    keys: int
    filled: int
    covered: int
    grid: int
    size: int | None

    @property
    def missing(self) -> int:
        return self.grid - self.covered

    @property
    def fill_rate(self) -> float:
        total = self.keys if self.size is None else self.size
        return self.filled / total * 100 if total else 0.0


def panel_counters(
    panel: DataFrame, keys: Sequence[str], value_cols: Sequence[str], first_year: int, last_year: int, dim: Dim = PROVINCES, was: bool = False
) -> Counters:
    """The counters of a whole panel, in one pass; on request as it was before the round."""
    years = range(first_year, last_year + 1)
    size = universe_size(keys, years, dim)
    row = _compared(_ids(panel, keys, value_cols, first_year, last_year, dim, F.lit(True), was)).select(
        "in_new", "now", "covered_new", (entity_count(dim) * len(years)).alias("grid"), (F.lit(None) if size is None else size).alias("size")
    ).first()
    return Counters(*row)


def count_round(
    counters: Counters,
    before: DataFrame,
    after: DataFrame,
    changed: str,
    keys: Sequence[str],
    value_cols: Sequence[str],
    first_year: int,
    last_year: int,
    dim: Dim = PROVINCES,
    was: bool = False,
) -> tuple[int, Counters]:
    """Keys gained and the new counters, from the ids of changed rows alone.

    ``after`` is ``before`` with some cells written, ``changed`` its column that marks the
    rows this touched.  Cells are only written with text, so no row stops covering its pair.  All other ids count in both panels alike, so only the marked rows'
    ids are folded: as a written table of known size they are broadcast to both scans
    where they are small, and neither panel is exchanged.  With ``was``, ``before`` is
    ``after`` too and carries what it was (``_with_flags``).
    """
    scope = (keys, value_cols, first_year, last_year, dim)
    here = _ids(after.where(changed), *scope, F.lit(True)).select("is_key", "id")
    touched = written_once(here.distinct(), "touched-ids")
    rows = _ids(before, *scope, F.lit(False), was).unionByName(_ids(after, *scope, F.lit(True)))
    row = _compared(rows.join(touched, ["is_key", "id"], "left_semi")).first()
    return row.gained_keys, replace(
        counters,
        keys=counters.keys + row.in_new - row.in_old,
        filled=counters.filled + row.now - row.old,
        covered=counters.covered + row.covered_new - row.covered_old,
    )


def round_metrics(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    first_year: int,
    last_year: int,
    dim: Dim = PROVINCES,
) -> DataFrame:
    """Keys gained, gaps before and after, and the two fill rates, as one row.

    Each panel is read once: its keys and covered pairs go through one aggregate
    with map-side combine, and everything follows from the folded ids.
    """
    scope = (keys, value_cols, first_year, last_year, dim)
    whole = _compared(_ids(before, *scope, F.lit(False)).unionByName(_ids(after, *scope, F.lit(True))))
    grid = entity_count(dim) * max(0, last_year - first_year + 1)
    size = universe_size(keys, range(first_year, last_year + 1), dim)

    def rate(filled: str, known: str) -> Column:
        total = size if size is not None else F.col(known)
        return F.coalesce(F.try_divide(F.col(filled), total) * 100, F.lit(0.0))

    return whole.select(
        "gained_keys",
        (grid - F.col("covered_old")).alias("missing_before"),
        (grid - F.col("covered_new")).alias("missing_after"),
        rate("old", "in_old").alias("fill_rate_before"),
        rate("now", "in_new").alias("fill_rate_after"),
    )


def stop_decision(
    history: DataFrame,
    min_gain: int = 1,
    patience: int = 1,
    series: Sequence[str] = (),
    order: str = "round",
    gained: str = "gained",
    missing: str = "missing_after",
) -> DataFrame:
    """Adds the low-gain streak and whether the round is one to stop after.

    A streak is a run of low rounds since the last good one: the running count
    of good rounds names the run.  Without ``series`` the history is one short
    list of rounds.
    """
    walk = Window.partitionBy(*series).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    low = F.col(gained) < min_gain
    runs = history.withColumn("_run", F.sum(F.when(low, 0).otherwise(1)).over(walk))
    inside = Window.partitionBy(*series, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    streak = F.sum(F.when(low, 1).otherwise(0)).over(inside)
    out = runs.withColumn("low_gain_streak", streak).drop("_run")
    return out.withColumn("stop", (F.col("low_gain_streak") >= patience) | (F.col(missing) == 0))


def totals_stopped_growing(history: DataFrame, order: str = "round", total: str = "total", series: Sequence[str] = ()) -> DataFrame:
    """Adds ``stop``: the candidate total did not grow over the round before."""
    before = F.lag(total).over(Window.partitionBy(*series).orderBy(order))
    return history.withColumn("stop", F.coalesce(F.col(total) <= before, F.lit(False)))


def pending_entities(targets: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Targets not finished yet; all of them when forced."""
    if force:
        return targets
    finished = done.where(F.coalesce("finished", F.lit(False))).select("entity").distinct()
    return targets.join(finished, "entity", "left_anti")


@dataclass
class RoundRun:
    """The last panel and one record per executed round."""

    panel: DataFrame
    rounds: list[dict] = field(default_factory=list)
    stopped: str = "all patches used"


def run_rounds(
    panel: DataFrame,
    patches: Sequence[DataFrame],
    value_cols: Sequence[str],
    first_year: int,
    last_year: int,
    keys: Sequence[str] = ("province", "year"),
    min_gain: int = 1,
    patience: int = 1,
    registry: DataFrame | None = None,
    variable: str = "",
    fill_only: bool = False,
    dim: Dim = PROVINCES,
    entity_form: str | None = None,
) -> RoundRun:
    """Applies one patch table per round until nothing is missing or gained.

    Each round's panel is written below the shared folder, which cuts the lineage and
    survives lost executors.  No round changes the ids of a row, so they are found once and
    carried along, with what the row held before the round: the first round's file gives the
    first counts too, and later counts come from the ids of changed rows.  A patch given for
    several rounds is written once.  Only one summary row per round reaches the driver.
    """
    shared_dir(panel.sparkSession)
    run = RoundRun(panel)
    scope = (keys, value_cols, first_year, last_year, dim)
    # Where a round writes key columns, ids change with it and are found anew.
    carried = not set(value_cols) & {*keys, "province", "year"}
    current = _with_ids(panel, keys, first_year, last_year, dim) if carried else panel
    used = list(dict.fromkeys([*keys, ROW, *value_cols]))
    again: dict[int, DataFrame] = {}
    known = None
    streak = 0
    for number, patch in enumerate(patches, start=1):
        if known and known.missing == 0:
            run.stopped = "no gaps left"
            break
        if sum(p is patch for p in patches) > 1:
            if id(patch) not in again:
                again[id(patch)] = written_once(patch.select(*[c for c in used if c in patch.columns]), "round-patch")
            patch = again[id(patch)]
        before = _with_flags(current, value_cols)
        if fill_only:
            filled = reference_fill(before, patch, keys, value_cols[0])
            marked = filled.withColumn("_changed", F.col("_filled")).drop("_scanned", "_filled")
        else:
            merged = merge_panel(before, patch, keys, value_cols, entity_form, dim)
            marked = merged.withColumn("_changed", F.col("_written") > 0).drop("_written")
        marked = written_once(marked, "round-panel")
        known = known or panel_counters(marked if carried else current, *scope, was=carried)
        if known.missing == 0:
            run.stopped = "no gaps left"
            break
        following = marked.drop("_changed", "_had", "_stood")
        changed = following.drop("_id_key", "_id_pair")
        if registry is not None and not round_passes(
            validate_round(changed, registry, variable, keys, value_cols=value_cols)
        ):
            run.panel, run.stopped = changed, "checks failed"
            break
        gained, after = count_round(known, marked if carried else current, marked, "_changed", *scope, was=carried)
        run.rounds.append({
            "round": number,
            "gained": gained,
            "missing_before": known.missing,
            "missing_after": after.missing,
            "fill_rate_before": known.fill_rate,
            "fill_rate_after": after.fill_rate,
        })
        run.panel, current, known = changed, following, after
        streak = streak + 1 if gained < min_gain else 0
        if streak >= patience:
            run.stopped = f"{streak} low-gain rounds"
            break
    return run
