"""Session settings, the shared working folder and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the jobs rely on to a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "rosterlake", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    The checkpoint folder, else a folder in the warehouse. A warehouse that is
    a local path is an error unless driver and executors are one machine.
    """
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or spark.sparkContext.getCheckpointDir())
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith("file:") or ":/" not in warehouse
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to storage that all executors share; "
                         f"the warehouse is the local path {warehouse}")
    return warehouse


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/rosterlake/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Used where one result feeds several later steps. The table survives the
    loss of any executor, is read column by column, and carries no lineage, so
    what was shuffled for it is of no more use and goes once it is written.
    """
    spark = df.sparkSession
    path = work_path(spark, "cut")
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    df = df.withColumns({c: df[c].cast("string") for c in untyped}) if untyped else df
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    # the schema is known, so no job reads it back from the files
    return spark.read.schema(df.schema).parquet(path)
