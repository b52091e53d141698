"""The crosswalk as a stored table, laid out for the joins that use it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterlake.operators.quality import require_one_to_one

BUCKETS = 64


def store_crosswalk(df: DataFrame, table: str, left: str = "samhsa_id", right: str = "npi",
                    buckets: int = BUCKETS) -> None:
    """Write a crosswalk that is one to one (an error if not), bucketed and
    sorted by the registry id: joins on it read the buckets as they lie and
    move only the other side. Choose ``buckets`` near the shuffle partitions
    of those joins."""
    pairs = df.select(left, right).distinct()
    require_one_to_one(pairs, left, right)
    (pairs.repartition(buckets, right).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, right).sortBy(right).saveAsTable(table))


def read_crosswalk(spark: SparkSession, table: str, left: str = "samhsa_id", right: str = "npi",
                   check: bool = False) -> DataFrame:
    """The stored pairs; ``check`` tests again that both sides are unique."""
    df = spark.table(table).select(left, right)
    if check:
        require_one_to_one(df, left, right)
    return df


def attach_crosswalk(df: DataFrame, stored: DataFrame, key: str = "npi", how: str = "inner") -> DataFrame:
    """Rows with their list id, by a join that leaves the stored side in place."""
    return df.join(stored.hint("merge"), key, how)
