"""Session settings and the shared folder in which intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(name: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session (tests, a laptop) may fall back to a fresh temporary
    folder; a cluster without the setting is an error, because a folder on one
    machine would be lost with it.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"Set {CHECKPOINT_CONF} to a folder shared by all executors.")
    fallback = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    return fallback


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back; `options` are those of the Parquet writer.

    Used where a result feeds several jobs: the lineage is cut, a lost executor
    costs nothing, and later readers still get column pruning and filters.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Give every core a part of a scan that has fewer splits than there are cores.

    Meant for costly text projections over small inputs; an input with more splits
    than cores is returned as it is, so nothing is shuffled at scale.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
