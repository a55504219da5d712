"""Panels kept as a bucketed table: a patch moves its own rows, the panel stays in place.

A stored panel holds one row per key.  It is a Parquet table partitioned by a hash of the
key (``_part``) and bucketed and sorted by the key inside.  A patch is folded to its last
row per key, then meets the panel in a join for which only the patch is exchanged: the
scan of the panel is dealt by key already.  Only parts that hold a key of the patch are
read, and only these are replaced, by dynamic partition overwrite.  The joined rows lie
dealt by bucket, so they are written without another exchange.

Hot keys: the panel has one row per key, and a patch is folded with map-side combine, so
neither side of the join holds more than one row of a key.

Lost executors: parts are staged and moved at the end of the job.  A job that dies during
that move may leave some parts new and some old; running the same patch again ends in the
same panel, as each operator here writes what the patch says whatever stood before (only
the counts then tell of the second run).

Nulls: key cells go through the key's form and are kept as text, null as ``""``, so rows
without a key are one key that patches meet like any other.  Tables may be empty.  Columns
may have any names but ``_part``, ``_k0``, ``_k1`` and so on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evidencepanel.functions.text import all_of, has_text, raw, strip
from evidencepanel.operators.groups import ROW, need, pick_by
from evidencepanel.plans.session import written_once

PART = "_part"


@dataclass(frozen=True)
class StoredPanel:
    """A table name and its key: each column with the form under which it is compared.

    ``parts`` times ``buckets`` files are the unit of work: a patch replaces whole parts,
    and one task joins one bucket of all parts touched.  Both are fixed by ``store_panel``.
    """

    table: str
    keys: Mapping[str, Callable[[str], Column]] = field(default_factory=lambda: {"province": strip, "year": strip})
    parts: int = 64
    buckets: int = 200

    @property
    def names(self) -> list[str]:
        return [f"_k{i}" for i in range(len(self.keys))]

    def keyed(self, df: DataFrame) -> list[Column]:
        need(df, *self.keys)
        return [F.coalesce(form(k).cast("string"), F.lit("")).alias(n) for n, (k, form) in zip(self.names, self.keys.items())]

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.names), F.lit(self.parts)).cast("int").alias(PART)


def store_panel(panel: DataFrame, at: StoredPanel, path: str, order: str = ROW) -> None:
    """Creates the table from the last row per key.  ``path`` is a folder all executors reach."""
    need(panel, order)
    last = pick_by(panel.select(*at.keyed(panel), F.struct(*panel.columns).alias("_row_"), F.col(order).alias("_o")), at.names, "_o", last=True)
    rows = last.select(*at.names, "_row_.*", at.part())
    (
        rows.repartition(at.buckets, *at.names)
        .write.partitionBy(PART)
        .bucketBy(at.buckets, *at.names)
        .sortBy(*at.names)
        .option("path", path)
        .option("partitionOverwriteMode", "dynamic")
        .saveAsTable(at.table, format="parquet")
    )


def stored_rows(spark: SparkSession, at: StoredPanel) -> DataFrame:
    """The panel as it stands."""
    return spark.table(at.table).drop(*at.names, PART)


def touched_rows(spark: SparkSession, at: StoredPanel, patch: DataFrame, how: str, order: str = ROW) -> DataFrame:
    """Rows of all parts that the patch touches, each beside the patch's last row of its key.

    ``_old`` and ``_new`` are whole rows or null.  ``how`` is ``left`` (keys of the panel
    alone) or ``full``.  The numbers of the touched parts, at most ``parts``, go through
    the driver.
    """
    need(patch, order)
    keyed = patch.select(*at.keyed(patch), F.struct(*patch.columns).alias("_new"), F.col(order).alias("_o"))
    last = pick_by(keyed, at.names, "_o", last=True).drop("_o")
    last = written_once(last.select("*", at.part()), "patch")
    parts = [r[PART] for r in last.select(PART).distinct().collect()]
    whole = spark.table(at.table)
    cells = [c for c in whole.columns if c not in (*at.names, PART)]
    old = whole.where(F.col(PART).isin(parts)).select(
        *[F.col(n).alias(f"_o{n}") for n in at.names], F.col(PART).alias("_op"), F.struct(*cells).alias("_old")
    )
    # The merge hint keeps the bucketed scan: a broadcast patch would leave rows dealt by file.
    by_key = all_of(old[f"_o{n}"] == last[n] for n in at.names)
    met = old.join(last.hint("merge"), by_key, how)
    keys = [F.when(F.col("_old").isNotNull(), old[f"_o{n}"]).otherwise(last[n]).alias(n) for n in at.names]
    return met.select(*keys, "_old", "_new", F.coalesce("_op", last[PART]).alias(PART))


def _replace(rows: DataFrame, at: StoredPanel, cells: Mapping[str, Column], **counts: Column) -> dict[str, int]:
    """Writes the touched parts; the counts are taken on the way."""
    whole = rows.sparkSession.table(at.table)
    seen = Observation()
    counted = rows.observe(seen, *[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(n) for n, c in counts.items()])
    out = [F.col(c) if c in (*at.names, PART) else cells[c].alias(c) for c in whole.columns]
    counted.select(*out).write.insertInto(at.table, overwrite=True)
    return dict(seen.get)


def _cells(spark: SparkSession, at: StoredPanel) -> list[str]:
    return [c for c in spark.table(at.table).columns if c not in (*at.names, PART)]


def upsert_stored(new: DataFrame, at: StoredPanel, order: str = ROW) -> dict[str, int]:
    """New rows replace rows of the same key whole, or are added; columns they lack are null.

    Gives ``replaced`` and ``added``.
    """
    spark = new.sparkSession
    rows = touched_rows(spark, at, new, "full", order)
    given = F.col("_new").isNotNull()
    cells = {
        c: F.when(given, F.col("_new")[c] if c in new.columns else F.lit(None)).otherwise(F.col("_old")[c])
        for c in _cells(spark, at)
    }
    had = F.col("_old").isNotNull()
    return _replace(rows, at, cells, replaced=given & had, added=given & ~had)


def merge_stored(new: DataFrame, at: StoredPanel, cols: Sequence[str], order: str = ROW) -> dict[str, int]:
    """New cells overwrite those of the same key unless they are blank; no key is added.

    The whole last new row of a key counts; cells not written stay as they are, null
    included.  Gives ``cells_written``.
    """
    spark = new.sparkSession
    known = _cells(spark, at)
    need(stored_rows(spark, at), *cols)
    rows = touched_rows(spark, at, new, "left", order)
    writes = {c: F.coalesce(has_text(F.col("_new")[c]), F.lit(False)) for c in cols if c in new.columns}
    cells = {c: F.col("_old")[c] for c in known}
    cells |= {c: F.when(w, F.col("_new")[c]).otherwise(cells[c]) for c, w in writes.items()}
    written = sum((w.cast("int") for w in writes.values()), F.lit(0))
    return _replace(rows, at, cells, cells_written=written)


def overwrite_stored(
    new: DataFrame,
    at: StoredPanel,
    cols: Sequence[str],
    years: Sequence[str | int] = (),
    require: str | None = None,
    year_col: str = "year",
    order: str = ROW,
) -> dict[str, int]:
    """Copies columns from the last patch row of the key; ``years`` and ``require`` as in
    ``overwrite_columns``.  Gives ``updated``."""
    spark = new.sparkSession
    need(stored_rows(spark, at), *cols)
    rows = touched_rows(spark, at, new, "left", order)
    hit = F.col("_new").isNotNull()
    if years:
        hit &= strip(F.col("_old")[year_col]).isin([str(y) for y in years])
    if require:
        hit &= F.coalesce(has_text(F.col("_new")[require]), F.lit(False))
    cells = {c: F.col("_old")[c] for c in _cells(spark, at)}
    cells |= {c: F.when(hit, raw(F.col("_new")[c]) if c in new.columns else F.lit("")).otherwise(cells[c]) for c in cols}
    return _replace(rows, at, cells, updated=hit)
