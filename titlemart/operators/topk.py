"""Best k rows per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.session import write_shared

# Fixed value: Spark's setting for the largest k that is limited on the map side.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
ACCURACY = 10_000  # of the histograms: one part in so many of a group's rows
SHARES = [i / 200 for i in range(201)]  # of a group at which its values are known


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    tie_break: Sequence[str],
    k: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """Rows with the k highest ``by`` per group, NULL last, ties by ``tie_break``
    descending. A group whose values are all NULL still gives rows.

    The ``row_number() <= k`` form lets Spark limit every group on the map side
    already, so a group that holds a third of all rows shuffles at most k rows
    per task. Spark does so up to a k that it is told; for a larger one, rows under a
    cut that at least k of their group reach are left out first (``above_cut``), and the rest is ranked by
    ranges, so that no task holds a group.
    """
    order = [F.col(c).desc_nulls_last() for c in (by, *tie_break)]
    name = rank or "__rank"
    if k > int(df.sparkSession.conf.get(GROUP_LIMIT)):
        best = _ranked_by_ranges(above_cut(df, keys, by, k), keys, order, name).where(F.col(name) <= k)
        return best if rank else best.drop(name)
    window = Window.partitionBy(*keys).orderBy(*order)
    best = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return best if rank else best.drop(name)


def above_cut(df: DataFrame, keys: Sequence[str], by: str, k: int) -> DataFrame:
    """Rows whose ``by`` reaches a value that at least k of their group reach, all rows of smaller groups.

    The value comes from a histogram per group, merged from those of the tasks: the quantile at k rows and
    twice the histogram's error. Only numbers, dates and times are cut. Groups of over k rows alone have
    a cut, at most one in k rows, so the cuts are broadcast; else all rows would be shuffled by group.
    """
    kind = df.schema[by].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df
    ordered = F.when(~F.isnan(by), F.col(by)) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(by)
    sizes = df.groupBy(*keys).agg(F.count(ordered).alias("__n"), F.percentile_approx(ordered, SHARES, ACCURACY).alias("__values"))
    # the highest listed share that leaves k rows and the histogram's error above it
    share = 1 - F.lit(float(k)) / F.col("__n") - 2 / ACCURACY
    place = F.floor(share * (len(SHARES) - 1)).cast("int")
    cut = F.when((F.col("__n") > k) & (place >= 1), F.get("__values", place))
    cuts = sizes.select(*[F.col(c).alias(f"__key{i}") for i, c in enumerate(keys)], cut.alias("__cut")).where("__cut is not null")
    same = [F.col(c).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(keys)]
    reached = F.col("__cut").isNull() | (F.col(by) >= F.col("__cut"))
    return df.join(F.broadcast(cuts), reduce(and_, same), "left").where(reached).select(*df.columns)


def _ranked_by_ranges(df: DataFrame, keys: Sequence[str], order: list, name: str) -> DataFrame:
    """Rows with their number in their group: sorted into files by range, a row's place in its file and the
    group's rows in the files before give it."""
    columns = df.columns
    ranges = [F.col(c).asc_nulls_first() for c in keys] + order
    stored = write_shared(df.repartitionByRange(*ranges).sortWithinPartitions(*ranges), "ranked")
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)-", 1).cast("int")
    placed = stored.select(*columns, part.alias("__part"), F.col("_metadata.row_index").alias("__at"))
    runs = placed.groupBy(*keys, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        *[F.col(c).alias(f"__key{i}") for i, c in enumerate(keys)], F.col("__part").alias("__of"), "__first", F.coalesce(before, F.lit(0)).alias("__before")
    )
    runs = write_shared(runs, "runs")  # a row per group and file
    same = [F.col(c).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(keys)]
    joined = placed.join(runs, reduce(and_, [*same, F.col("__part") == F.col("__of")]))
    return joined.select(*columns, (F.col("__before") + F.col("__at") - F.col("__first") + 1).cast("int").alias(name))


def top_k_lists(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    tie_break: Sequence[str],
    values: Sequence[str],
    k: int = 1,
    out: str = "best",
) -> DataFrame:
    """One array of structs per group, best first, at most k long."""
    best = top_k_per_group(df, keys, by, tie_break, k, rank="__rank")
    entry = F.struct("__rank", *values)
    ordered = F.sort_array(F.collect_list(entry))
    shaped = F.transform(ordered, lambda e: F.struct(*[e[v].alias(v) for v in values]))
    return best.groupBy(*keys).agg(shaped.alias(out))
