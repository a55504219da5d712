"""Patches that arrive as files: each micro-batch is one round on the panel.

What the patches say of a key is a streaming aggregate: the last row of every key, kept
in Spark's state store and given out in update mode, so a batch holds exactly the keys it
changed.  The panel itself is plain Parquet partitioned by key bucket.  A batch reads only
the buckets that its keys fall into and replaces them by dynamic partition overwrite; all
others stay untouched and unread.

Replacing partitions is not one atomic step.  A batch therefore writes the new buckets
beside the panel first, then its round metrics, and only then overwrites.  A batch that is
run again finds its metrics, takes the buckets written before and overwrites once more.

Layout below the state folder: ``panel/bucket=B``, ``next`` (buckets of the batch under
way), ``metrics/batch=N`` (-1 is the start), and the query's ``checkpoint``.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from evidencepanel.functions.text import has_text, raw, strip, to_int
from evidencepanel.operators.groups import ROW, key_hash, need

KEY = ("_e", "_y")
BUCKETS = 256
PIECE_ROWS = 100_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A batch writes what it changed in the store; whole copies are made between batches.
STORE = {PROVIDER: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def _at(state_dir: str, part: str) -> str:
    return f"{state_dir.rstrip('/')}/{part}"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def _piece(pieces: int) -> Column:
    """A part of a bucket, so that a bucket of any size is work for several tasks."""
    return F.pmod(F.hash(*KEY), F.lit(max(1, pieces)))


def _replace(rows: DataFrame, path: str, *by: str) -> None:
    """Replaces the partitions that ``rows`` holds, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _metrics(changes: DataFrame, batch_id: int, state_dir: str) -> None:
    _replace(changes.withColumn("batch", F.lit(batch_id).cast("bigint")), _at(state_dir, "metrics"), "batch")


def start_panel(panel: DataFrame, state_dir: str, value_col: str, buckets: int = BUCKETS) -> None:
    """The panel before the first patch: its last row per key; rows without entity or year go.

    ``buckets`` is fixed for the life of the state.  Tasks share a bucket where there are
    fewer buckets than cores.
    """
    need(panel, "province", "year", value_col, ROW)
    cols = panel.columns
    keyed = panel.select(*cols, strip("province").alias("_e"), F.coalesce(to_int("year"), F.lit(0)).alias("_y"))
    keyed = keyed.where((F.col("_e") != "") & (F.col("_y") != 0))
    last = keyed.groupBy(key_hash(KEY), *KEY).agg(F.max_by(F.struct(*cols), ROW).alias("_last"))
    rows = last.select(*KEY, "_last.*", F.lit(buckets).alias("_buckets")).withColumn("bucket", _bucket(buckets))
    pieces = ceil(2 * panel.sparkSession.sparkContext.defaultParallelism / buckets)
    rows.repartition("bucket", _piece(pieces)).write.mode("overwrite").partitionBy("bucket").parquet(_at(state_dir, "panel"))
    now = _panel(panel.sparkSession, state_dir)
    first = now.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(has_text(value_col), 1)).alias("filled_rows"))
    _metrics(first.withColumn("gained_keys", F.lit(0).cast("bigint")), -1, state_dir)


def _panel(spark: SparkSession, state_dir: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_at(state_dir, "panel"))


def _panel_columns(panel: DataFrame) -> list[str]:
    return [c for c in panel.columns if c not in (*KEY, "_buckets", "bucket")]


def last_rows(arriving: DataFrame, cols: list[str]) -> DataFrame:
    """The last row per key over all that has arrived: files in the order they were
    written (then by path), rows in the order of ``_row``.  A streaming aggregate."""
    given = [(F.col(c) if c in arriving.columns else F.lit(None).cast("string")).alias(c) for c in cols]
    order = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col(ROW)).alias("_order")
    keyed = arriving.select(*given, raw("province").alias("_e"), to_int("year").alias("_y"), order)
    return keyed.groupBy(*KEY).agg(F.max_by(F.struct(*cols), "_order").alias("_last")).select(*KEY, "_last.*")


def deliver(spark: SparkSession, changed: DataFrame, batch_id: int, state_dir: str, value_col: str) -> None:
    """Puts the changed keys (their last rows, one each) into the panel and writes the
    round's metrics.  Running a batch again has no further effect."""
    seen = spark.read.parquet(_at(state_dir, "metrics"))
    upcoming = _at(state_dir, "next")
    whole = _panel(spark, state_dir)
    if not seen.where(F.col("batch") == batch_id).isEmpty():
        # Buckets and metrics stand already; the state store wants its batch run all the same.
        changed.write.format("noop").mode("overwrite").save()
    else:
        cols = _panel_columns(whole)
        buckets = whole.select("_buckets").first()["_buckets"] if not whole.isEmpty() else BUCKETS
        delta = changed.withColumns({"_buckets": F.lit(buckets), "bucket": _bucket(buckets), "_new": F.lit(True)}).persist()
        earlier = seen.where(F.col("batch") < batch_id)
        rows_before, filled_before = (earlier.agg(F.max_by(c, "batch")).scalar() for c in ("rows", "filled_rows"))
        # At most one row per bucket reaches the driver, and the number of rows before.
        touched = delta.groupBy("bucket").count().collect()
        if not touched:
            return
        known = earlier.agg(F.max_by("rows", "batch")).first()[0] or 0
        pieces = ceil((known / buckets + max(r["count"] for r in touched)) / PIECE_ROWS)
        old = whole.where(F.col("bucket").isin([r["bucket"] for r in touched])).withColumn("_new", F.lit(False))
        rows = old.unionByName(delta).withColumn("_piece", _piece(pieces)).repartition("bucket", "_piece")
        keep = ["_buckets", *cols]
        # One exchange: rows dealt by bucket and piece are dealt by (bucket, piece, key) too.
        folded = rows.groupBy("bucket", "_piece", *KEY).agg(
            F.max_by(F.struct(*keep), "_new").alias("_last"),
            F.max(F.when(~F.col("_new"), has_text(value_col))).alias("_was"),
        )
        folded = folded.select(*KEY, "_last.*", "_was", "bucket")
        folded.write.mode("overwrite").partitionBy("bucket").parquet(upcoming)
        delta.unpersist()
        was, now = F.coalesce("_was", F.lit(False)), has_text(value_col)
        change = spark.read.parquet(upcoming).agg(
            F.count(F.when(F.col("_was").isNull(), 1)).alias("added"),
            F.count(F.when(now & ~was, 1)).alias("gained"),
            F.count(F.when(~now & was, 1)).alias("lost"),
        )
        after = change.select(
            (rows_before + F.col("added")).alias("rows"),
            (filled_before + F.col("gained") - F.col("lost")).alias("filled_rows"),
            F.col("gained").alias("gained_keys"),
        )
        _metrics(after, batch_id, state_dir)
    _replace(spark.read.parquet(upcoming).drop("_was"), _at(state_dir, "panel"), "bucket")


def stream_rounds(
    spark: SparkSession,
    source_dir: str,
    state_dir: str,
    schema: StructType,
    value_col: str,
    files_per_round: int = 1,
) -> StreamingQuery:
    """Upserts every waiting patch file into the panel, then stops.

    The last row of every key that a patch named lies in a RocksDB state store below the
    checkpoint; a restart goes on from there.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_round).parquet(source_dir)
    changed = last_rows(arriving.select("*", "_metadata"), _panel_columns(_panel(spark, state_dir)))

    def round_of(batch: DataFrame, batch_id: int) -> None:
        deliver(batch.sparkSession, batch, batch_id, state_dir, value_col)

    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        return (
            changed.writeStream.outputMode("update")
            .foreachBatch(round_of)
            .option("checkpointLocation", _at(state_dir, "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def round_history(spark: SparkSession, state_dir: str) -> DataFrame:
    """``batch, rows, filled_rows, gained_keys`` of every round; batch -1 is the start."""
    return spark.read.parquet(_at(state_dir, "metrics"))


def latest_panel(spark: SparkSession, state_dir: str) -> DataFrame:
    """The panel after the last round."""
    whole = _panel(spark, state_dir)
    return whole.select(*_panel_columns(whole))
