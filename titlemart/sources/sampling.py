"""Listing files, and a random sample of exactly n rows or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per file: path, name, length, time. Contents are not read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        "modificationTime",
    )


def exact_sample(df: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """The n rows with the smallest hash of (key, seed); the key should be unique.

    Rows without key, or with the same one, share a hash; which of them fill the
    sample up is then not fixed, but there are always exactly n rows.

    A count per hash range (65,536 of them at most, combined on the map side)
    shows in which range the n-th row falls. Lower ranges are taken without any sort;
    only the last range is sorted for its first rows. Raises if there are fewer
    than n rows.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)))
    marked = df.withColumn("__digest", digest).withColumn(
        "__range", F.conv(F.substring("__digest", 1, 4), 16, 10).cast("int")
    )
    counts = marked.groupBy("__range").count()
    upto = F.sum("count").over(Window.orderBy("__range"))
    cut = counts.withColumn("upto", upto).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(F.min(F.when(F.col("upto") >= n, F.col("__range"))), F.lit(0)).alias("last"),
        F.coalesce(F.max(F.when(F.col("upto") < n, F.col("upto"))), F.lit(0)).alias("taken"),
    ).first()
    if cut.total < n:
        raise ValueError(f"sample of {n} rows from a population of {cut.total}")
    inside = marked.where(F.col("__range") < cut.last)
    edge = marked.where(F.col("__range") == cut.last).orderBy("__digest", key).limit(n - cut.taken)
    return inside.unionByName(edge).drop("__digest", "__range")
