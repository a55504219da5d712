"""Group-wise picks that stay safe when one group holds a large share of rows.

* one row per group: ``max_by`` / ``min_by`` aggregates, which combine on the
  map side, so a hot group reaches the reducer as one row per map task;
* first ``k`` rows per group: a ranking window under a ``<= k`` filter over what
  the same filter leaves of slices of each group;
* lookups against one row per key: ``same_key`` joins, whose hot keys the
  adaptive planner splits;
* numbering all rows: ranges sorted and written in parallel, plus the running size of
  the ranges before.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidencepanel.functions.text import all_of
from evidencepanel.plans.session import written_once

ROW = "_row"
SLICES = 64


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; table has {df.columns}")


def same_key(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """Join condition: the key pairs are equal.

    The adaptive planner splits a skewed partition only when both join inputs
    come straight from an exchange.  A side that was just folded to one row per
    key is already partitioned by that key and would be joined without one.  The
    added slot, which is 0 on both sides, is not part of that partitioning, so
    the (small, folded) side is exchanged again and hot keys of the other side
    can be split.  A side small enough to broadcast is broadcast as before.
    """
    pairs = list(pairs)
    left = F.pmod(F.xxhash64(*[a for a, _ in pairs]), F.lit(1))
    right = F.pmod(F.xxhash64(*[b for _, b in pairs]), F.lit(1))
    return all_of(a == b for a, b in pairs) & (left == right)


def never_broadcast(df: DataFrame) -> DataFrame:
    """The side of an equality join that is exchanged, whatever its size seems to be.

    The planner goes by the size of the files a side is read from.  Well packed columns, or
    rows made of them by ``explode`` and ``concat``, are many times that in memory, and a
    broadcast table passes through the driver.
    """
    return df.hint("merge")


def key_hash(keys: Sequence[str]) -> Column:
    """A leading group key that sorts fast.

    Picking whole rows is a sort aggregate.  Text keys often share their first
    characters, which makes sorting compare them in full; a hash in front tells
    nearly all rows apart by its own 8 bytes.
    """
    return F.xxhash64(*[F.col(k) for k in keys]).alias("_h")


def pick_by(df: DataFrame, keys: Sequence[str], order: Column | str, last: bool, extra: Sequence[Column] = ()) -> DataFrame:
    """One whole row per key: the one with the highest or lowest order value."""
    need(df, *keys)
    rest = [c for c in df.columns if c not in keys]
    choose = F.max_by if last else F.min_by
    picked = df.groupBy(key_hash(keys), *keys).agg(choose(F.struct(*rest), order).alias("_pick"), *extra)
    kept = [c for c in picked.columns if c not in ("_pick", "_h")]
    return picked.select(*kept, *[F.col("_pick")[c].alias(c) for c in rest])


def keep_last(df: DataFrame, keys: Sequence[str], order: Column | str = ROW) -> DataFrame:
    """Last row per key, whole."""
    return pick_by(df, keys, order, last=True).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Column | str = ROW) -> DataFrame:
    """First row per key, whole."""
    return pick_by(df, keys, order, last=False).select(*df.columns)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "_rank") -> DataFrame:
    """First ``k`` rows of every group in the given order, ranked from 1.

    Whatever ``k``, rows are first cut inside slices dealt by their place in the input:
    a row among the first ``k`` of its group is among the first ``k`` of its slice.  No
    column but the keys and the order is read for that, so any type may ride along.
    """
    need(df, *keys)
    sliced = df.withColumn("_slice", F.pmod(F.monotonically_increasing_id(), F.lit(SLICES)))
    inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
    cut = sliced.withColumn(rank, F.row_number().over(inner)).where(F.col(rank) <= k).drop("_slice")
    window = Window.partitionBy(*keys).orderBy(*order)
    return cut.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def number_rows(df: DataFrame, order: str, out: str = "_n", buckets: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 over the whole table by a unique numeric column.

    No task ever sees the whole table: rows are dealt by ranges of the order (as many as
    shuffle partitions, which are set by the size of the data), sorted there and written
    once below the shared folder.  The place of a row in its range is known as it is
    written; what lies before its range is a running sum over one row per range.
    """
    need(df, order)
    if buckets is None:
        buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 8)
    dealt = df.repartitionByRange(buckets, order).sortWithinPartitions(order)
    # The id is the number of the range and, in its lower 33 bits, the place in it.
    kept = written_once(dealt.withColumn("_range_place", F.monotonically_increasing_id()), "numbered")
    slot = F.shiftright("_range_place", 33)
    sizes = kept.groupBy(slot.alias("_slot")).count()
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    numbered = kept.join(offsets, slot == F.col("_slot"))
    place = F.col("_range_place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*df.columns, (place + F.col("_before") + 1).cast("bigint").alias(out))
