"""Weekly files folded into a panel as they land.

Every micro-batch keeps the latest week per provider and month; a late file
is harmless because an older week never replaces a newer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterlake.functions.dates import month_start
from rosterlake.plans.refresh import panel_keys
from rosterlake.session import cut

PANEL_WEEK = "week"


def weekly_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows (npi, week, value) of parquet files landing in ``folder``."""
    return spark.readStream.schema(schema).parquet(folder)


def upsert_weeks(batch: DataFrame, root: str, variable: str) -> None:
    """Merge one batch into the touched months only. The panel keeps the week
    a value came from."""
    spark = batch.sparkSession
    target = f"{root}/{variable}"
    new = batch.where(F.col(variable).isNotNull()).withColumn("month", month_start(PANEL_WEEK))
    cols = [*panel_keys(new.columns), PANEL_WEEK, variable]
    new = new.select(*cols)
    schema = new.schema
    try:
        old = spark.read.schema(schema).parquet(target)
        # the weeks of one batch touch few months; listed, they prune partitions
        months = [r[0] for r in new.select("month").distinct().collect()]
        old = old.where(F.col("month").isin(months))
        new = new.unionByName(old.select(*cols))
    except Exception as e:  # first batch: nothing stored yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    keys = panel_keys(cols)
    packed = F.struct(PANEL_WEEK, variable)
    folded = (new.groupBy(*keys).agg(F.max(packed).alias("__b"))
              .select(*keys, f"__b.{PANEL_WEEK}", f"__b.{variable}"))
    # written out first: the months being replaced are also being read
    (cut(folded).hint("rebalance", "month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(target))


def start(stream: DataFrame, root: str, variable: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed, then stop; run again for later files."""
    return (stream.writeStream.foreachBatch(lambda df, _: upsert_weeks(df, root, variable))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
