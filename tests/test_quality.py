import pytest

from titlemart.functions import cast_cell, for_each_parameter_set, iso_year, run_sql
from titlemart.quality import (
    CheckFailed,
    check_interval,
    check_non_empty,
    check_truthy,
    check_unique,
    check_value,
    interval_ratios,
    repeated_keys,
)
from pyspark.sql import functions as F


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_unique(spark):
    check_unique(ids(spark, 1, 2), "id")
    check_unique(ids(spark), "id")
    for bad in ((1, 1), (1, None)):
        with pytest.raises(CheckFailed):
            check_unique(ids(spark, *bad), "id")
    assert sorted(map(tuple, repeated_keys(ids(spark, 1, 1, 2, None), "id").collect()), key=repr) == [
        (1, 2), (None, 1)]


def test_non_empty(spark):
    check_non_empty(ids(spark, 1))
    with pytest.raises(CheckFailed):
        check_non_empty(ids(spark))


@pytest.mark.parametrize("query, good", [
    ("SELECT 1, true, 'x', array(1)", True), ("SELECT 1, 0", False), ("SELECT ''", False),
    ("SELECT array()", False), ("SELECT false", False), ("SELECT NULL", False),
    ("SELECT 1 WHERE false", False),
])
def test_truthy(spark, query, good):
    if good:
        check_truthy(spark.sql(query))
    else:
        with pytest.raises(CheckFailed):
            check_truthy(spark.sql(query))


def test_value(spark):
    check_value(spark.sql("SELECT 5"), 5)
    check_value(spark.sql("SELECT 5.4, 4.6"), 5, tolerance=0.1)
    check_value(spark.sql("SELECT -5.4"), -5, tolerance=0.1)
    check_value(spark.sql("SELECT 5L, 5.0"), "5")
    check_value(spark.sql("SELECT 'done'"), "done")
    for query, value, tolerance in (("SELECT 5", 6, None), ("SELECT 'x'", "y", None), ("SELECT 5.6", 5, 0.1), ("SELECT NULL", 5, 0.1)):
        with pytest.raises(CheckFailed):
            check_value(spark.sql(query), value, tolerance)


def test_interval(spark):
    df = spark.sql(
        "SELECT date'2024-01-08' AS ds, v FROM VALUES (1), (2) t(v) "
        "UNION ALL SELECT date'2024-01-15', v FROM VALUES (1), (2), (3) t(v)")
    check_interval(df, {"count(*)": 1.6, "sum(v)": 2.1}, "2024-01-15")
    with pytest.raises(CheckFailed, match="count"):
        check_interval(df, {"count(*)": 1.5}, "2024-01-15")
    with pytest.raises(CheckFailed):
        check_interval(df, {"count(*)": 1.5}, "2024-03-01")
    (row,) = interval_ratios(df, {"sum(v)": 3.0}, "2024-01-15").collect()
    assert (row.current, row.past, row.ratio, row.passed) == (6.0, 3.0, 2.0, True)


def test_cells_and_parameters(spark):
    df = spark.createDataFrame([("7", "1.5e2", "true"), (None, None, None)], "a string, b string, c string")
    cells = df.select(cast_cell(F.col("a"), "integer"), cast_cell(F.col("b"), "timestamp"), cast_cell(F.col("c"), "BOOLEAN"))
    assert [tuple(r) for r in cells.collect()] == [(7, 150.0, True), (None, None, None)]
    with pytest.raises(Exception, match="not a boolean cell: yes"):
        df.select(cast_cell(F.lit("yes"), "BOOLEAN")).collect()
    tricky = "x' OR 1=1 -- \n"
    assert run_sql(spark, "SELECT :p AS p", {"p": tricky}).first().p == tricky
    sets = spark.createDataFrame([("s", 2)], "label string, id long")
    assert for_each_parameter_set(ids(spark, 1, 2), sets, ["id"]).first().label == "s"
    days = spark.sql("SELECT date'2016-01-02' AS d UNION ALL SELECT date'2018-12-31'")
    assert sorted(r[0] for r in days.select(iso_year(F.col("d"))).collect()) == [2015, 2019]


def test_interval_days_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = interval_ratios(events, {"count(*)": 2.0}, "2024-01-15", "ts")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(ts,2024-01-15T00:00),LessThan(ts,2024-01-16T00:00))" in plan
