"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on; all are plain Spark configuration.
SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of byte code: let Spark
    # leave whole-stage generation for such plans instead of running interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # No call-site capture for every column expression built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, name: str = "evidencepanel") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small test data: keep all cores busy after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def missing_settings(spark: SparkSession) -> dict[str, str]:
    """Settings the operators count on that the session has otherwise."""
    return {k: v for k, v in SETTINGS.items() if str(spark.conf.get(k, "")).lower() != v.lower()}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the session's checkpoint folder.

    Read from the session.  Only a local session without one gets a temporary
    folder; on a cluster a missing setting is an error, since executors on other
    machines would not see a local folder.
    """
    known = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if known:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(known)
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="evidencepanel-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once: written below the shared folder and read back.

    For results that several outputs start from.  What is read back depends on shared
    files alone, so a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
