"""Parameters and user functions for SQL texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import PythonEvalType


# Spark's numbers for scalar and aggregate functions on Arrow or pandas batches.
VECTORISED = {
    PythonEvalType.SQL_SCALAR_PANDAS_UDF, PythonEvalType.SQL_SCALAR_PANDAS_ITER_UDF, PythonEvalType.SQL_GROUPED_AGG_PANDAS_UDF,
    PythonEvalType.SQL_SCALAR_ARROW_UDF, PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF, PythonEvalType.SQL_GROUPED_AGG_ARROW_UDF,
}


def run_sql(spark: SparkSession, text: str, parameters: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a query with named markers (``:name``) bound as typed values."""
    return spark.sql(text, args=dict(parameters or {}))


def for_each_parameter_set(df: DataFrame, sets: DataFrame, on: list[str]) -> DataFrame:
    """One query for many equality parameter sets: a join instead of a loop.

    ``sets`` holds one row per parameter set, further columns label the set.
    """
    return df.join(sets, on, "inner")


def attach_functions(
    spark: SparkSession,
    sql_functions: Iterable[str] = (),
    python_functions: Mapping[str, Callable] | None = None,
) -> None:
    """Make functions callable from SQL texts.

    ``sql_functions`` are bodies such as ``net(p double, d double) RETURNS
    double RETURN p * (1 - d)``; Catalyst inlines them. ``python_functions``, for what
    SQL cannot express, are made with ``arrow_udf`` or ``pandas_udf``; functions that would be
    called row by row are refused.
    """
    for name, function in (python_functions or {}).items():
        if getattr(function, "evalType", None) not in VECTORISED:
            raise ValueError(f"{name} would run row by row: make it with arrow_udf or pandas_udf")
    for body in sql_functions:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
    for name, function in (python_functions or {}).items():
        spark.udf.register(name, function)
