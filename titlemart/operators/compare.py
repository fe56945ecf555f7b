"""Comparing what was offered with what was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with side and count on that side.

    Both sides are counted per key before the join, so repeated keys combine
    on the map side and the join sees each key once.
    """
    left = source.groupBy(key).agg(F.count(F.lit(1)).alias("in_source"))
    right = target.groupBy(key).agg(F.count(F.lit(1)).alias("in_target"))
    side = F.when(F.col("in_target").isNull(), "missing").otherwise("extra")
    return (
        left.withColumnRenamed(key, "__l")
        .join(right.withColumnRenamed(key, "__r"), F.col("__l").eqNullSafe(F.col("__r")), "full_outer")
        .where(F.col("in_source").isNull() | F.col("in_target").isNull())
        .select(
            F.when(F.col("in_source").isNull(), F.col("__r")).otherwise(F.col("__l")).alias(key),
            side.alias("side"),
            F.coalesce("in_source", "in_target").alias("rows"),
        )
    )


def same_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts and whether they agree."""
    n, none = F.count(F.lit(1)), F.lit(None).cast("bigint")
    counts = source.agg(n.alias("source_rows")).withColumn("target_rows", none)
    counts = counts.unionByName(
        target.agg(n.alias("target_rows")).withColumn("source_rows", none)
    )
    return counts.agg(
        F.max("source_rows").alias("source_rows"), F.max("target_rows").alias("target_rows")
    ).withColumn("agree", F.col("source_rows") == F.col("target_rows"))
