"""Data-quality checks: each reads one small row and raises, or passes."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from titlemart.sinks.tables import fingerprint


class CheckFailed(AssertionError):
    """A check did not hold; the message carries the numbers."""


def check_truthy(df: DataFrame) -> None:
    """Every value of the first row must be true in Python's sense."""
    row = df.first()
    if row is None:
        raise CheckFailed("the query gave no row")
    if not all(bool(v) for v in row):
        raise CheckFailed(f"falsy value in {row.asDict()}")


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: row count, distinct non-null keys, whether they agree."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys")
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once or are NULL, with their row counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | F.col(key).isNull())


def check_unique(df: DataFrame, key: str) -> None:
    """Each key once and never NULL; an empty table passes."""
    row = uniqueness(df, key).first()
    if not row.is_unique:
        raise CheckFailed(f"{row.n_rows} rows but {row.n_keys} values of {key}")


def check_written(df: DataFrame, key: str, written: Mapping[str, int]) -> None:
    """A table holds the rows that a load has seen itself write, each key once: one scan of the key for both."""
    seen = Observation()
    check_unique(df.observe(seen, *fingerprint(key)), key)
    found = {name: int(value or 0) for name, value in seen.get.items()}
    if found != dict(written):
        raise CheckFailed(f"written were {dict(written)}, the table has {found}")


def check_non_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise CheckFailed("the table has no rows")


def check_value(df: DataFrame, pass_value, tolerance: float | None = None) -> None:
    """Every value of the first row equals ``pass_value``, or lies within the
    relative tolerance of it. Numbers compare as numbers, all else as text."""
    row = df.first()
    if row is None:
        raise CheckFailed("the query gave no row")
    target = _number(pass_value)
    if target is None:
        good = all(str(v) == str(pass_value) for v in row)
    else:
        low, high = sorted(target * (1 + s * (tolerance or 0)) for s in (-1, 1))
        numbers = [_number(v) for v in row]
        good = all(v is not None and low <= v <= high for v in numbers)
    if not good:
        raise CheckFailed(f"{row.asDict()} is not {pass_value} (tolerance {tolerance})")


def _number(value) -> float | None:
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def interval_ratios(
    df: DataFrame,
    metrics: Mapping[str, float],
    day: str | date,
    date_filter_column: str = "ds",
    days_back: int = -7,
) -> DataFrame:
    """One row per metric: its value on a day and ``days_back`` earlier, and the
    larger over the smaller. ``metrics`` maps aggregate expressions to limits.

    The column holds dates or times. Both days come out of one scan with one grouped
    aggregation; the days are ranges of the stored column, which reach the files.
    """
    now = date.fromisoformat(str(day))
    then = now - timedelta(days=abs(days_back))
    names = [f"m{i}" for i in range(len(metrics))]
    kind = df.schema[date_filter_column].dataType

    def within(first: date) -> Column:
        low, high = (F.lit(d).cast(kind) for d in (first, first + timedelta(days=1)))
        return (F.col(date_filter_column) >= low) & (F.col(date_filter_column) < high)

    per_day = (
        df.where(within(now) | within(then))
        .groupBy(within(now).alias("is_now"))
        .agg(*[F.expr(m).cast("double").alias(n) for m, n in zip(metrics, names)])
    )
    entries = [
        F.struct(F.lit(m).alias("metric"), F.lit(float(limit)).alias("threshold"), F.col(n).alias("v"))
        for (m, limit), n in zip(metrics.items(), names)
    ]
    current = F.max(F.when(F.col("is_now"), F.col("e.v")))
    past = F.max(F.when(~F.col("is_now"), F.col("e.v")))
    low, high = F.least("current", "past"), F.greatest("current", "past")
    return (
        per_day.select("is_now", F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.metric", "e.threshold")
        .agg(current.alias("current"), past.alias("past"))
        .withColumn(
            "ratio",
            F.when(F.col("current").isNotNull() & F.col("past").isNotNull() & (low != 0), high / low),
        )
        .withColumn("passed", F.coalesce(F.col("ratio") < F.col("threshold"), F.lit(False)))
    )


def check_interval(df: DataFrame, metrics: Mapping[str, float], day, **options) -> None:
    rows = interval_ratios(df, metrics, day, **options).collect()
    failed = [r.asDict() for r in rows if not r.passed]
    if failed or len(rows) < len(metrics):
        raise CheckFailed(f"metrics out of bounds: {failed or 'no rows on either day'}")
