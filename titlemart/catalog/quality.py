"""The checks, with the numbers they decide on as columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from titlemart.plans.marts import genres, media
from titlemart.plans.staging import staged_titles, star_table
from titlemart.session import shared_path
from titlemart.sinks import export_table
from titlemart.sources import load_table
from titlemart.quality import (
    CheckFailed,
    check_interval,
    check_non_empty,
    check_truthy,
    check_unique,
    check_value,
    check_written,
    interval_ratios,
    repeated_keys,
    uniqueness,
)

METRICS = {"count(*)": 1.5, "count(DISTINCT user_id)": 1.2, "max(value)": 1.01}


def _passes(check, *args, **options) -> bool:
    try:
        check(*args, **options)
    except CheckFailed:
        return False
    return True


def unique(spark, sf_dir):
    rows = uniqueness(media(staged_titles(spark, sf_dir)), "movie_id")
    passed = _passes(check_unique, media(staged_titles(spark, sf_dir)), "movie_id")
    return rows.withColumn("passed", F.lit(passed))


def recon_observed(spark, sf_dir):
    """A load compared with what it saw itself write, then with a row lost, and with one doubled in its place."""
    orders = star_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    files, table = shared_path(spark, "files"), shared_path(spark, "table")
    export_table(orders, files, "NEWLINE_DELIMITED_JSON")
    loaded = load_table(spark, table, files, orders.schema, "NEWLINE_DELIMITED_JSON", key="o_orderkey")
    first = loaded.rows.agg(F.min("o_orderkey")).first()[0]
    fewer = loaded.rows.where(F.col("o_orderkey") != first)
    other = fewer.union(orders.limit(1).select(F.lit(-1).cast(orders.schema["o_orderkey"].dataType), "o_totalprice"))
    passed = [_passes(check_written, rows, "o_orderkey", loaded.written) for rows in (loaded.rows, fewer, other)]
    flags = {name: F.lit(p) for name, p in zip(("passed", "passed_fewer", "passed_other"), passed)}
    return loaded.rows.agg(F.count("*").alias("n")).withColumns(flags).withColumn("n_written", F.lit(loaded.written["n_rows"]).cast("bigint"))


def unique_genres(spark, sf_dir):
    """Genre ids are not unique here: one id stands for several names."""
    dim = genres(staged_titles(spark, sf_dir))
    return uniqueness(dim, "id").withColumn("passed", F.lit(_passes(check_unique, dim, "id")))


def repeated(spark, sf_dir):
    return repeated_keys(star_table(spark, sf_dir, "orders"), "o_custkey")


def non_empty(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders")
    some = _passes(check_non_empty, orders)
    none = _passes(check_non_empty, orders.where("o_totalprice < 0"))
    return orders.agg(
        F.count(F.lit(1)).alias("n"), F.lit(some).alias("passed"), F.lit(none).alias("passed_empty")
    )


def truthy(spark, sf_dir):
    lines = star_table(spark, sf_dir, "lineitem")
    row = lines.agg(
        F.count(F.lit(1)).alias("n"), F.max("l_returnflag").alias("flag"),
        F.min("l_discount").alias("lowest"),
    )
    return row.withColumns(
        {"passed": F.lit(_passes(check_truthy, row)),
         "passed_part": F.lit(_passes(check_truthy, row.select("n", "flag")))}
    )


def value(spark, sf_dir):
    row = star_table(spark, sf_dir, "nation").agg(F.count(F.lit(1)).alias("n"))
    lines = star_table(spark, sf_dir, "lineitem").agg(F.avg("l_quantity").alias("q"))
    return row.withColumns(
        {"exact": F.lit(_passes(check_value, row, 25)),
         "off": F.lit(_passes(check_value, row, 24)),
         "near": F.lit(_passes(check_value, lines, 25.5, tolerance=0.1))}
    )


def interval(spark, sf_dir):
    events = star_table(spark, sf_dir, "events")
    passed = _passes(check_interval, events, METRICS, "2024-01-15", date_filter_column="ts")
    ratios = interval_ratios(events, METRICS, "2024-01-15", "ts")
    return ratios.withColumn("all_passed", F.lit(passed))


QUERIES = {
    "recon_observed": recon_observed,
    "check_unique": unique,
    "check_unique_fails": unique_genres,
    "check_repeated_keys": repeated,
    "check_nonempty": non_empty,
    "check_truthy": truthy,
    "check_value": value,
    "check_interval": interval,
}

ORACLES = {
    "recon_observed": """
SELECT count(*) AS n, true AS passed, false AS passed_fewer, false AS passed_other, count(*) AS n_written FROM orders""",
    "check_unique": """
SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
       count(*) = count(DISTINCT o_orderkey) AS is_unique,
       count(*) = count(DISTINCT o_orderkey) AS passed FROM orders""",
    "check_unique_fails": """
WITH d AS (SELECT DISTINCT nullif(p_size % 7, 0) AS id, p_type FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT count(*) AS n_rows, count(DISTINCT id) AS n_keys, count(*) = count(DISTINCT id) AS is_unique,
       count(*) = count(DISTINCT id) AS passed FROM d""",
    "check_repeated_keys": """
SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1 OR o_custkey IS NULL""",
    "check_nonempty": "SELECT count(*) AS n, true AS passed, false AS passed_empty FROM orders",
    "check_truthy": """
SELECT count(*) AS n, max(l_returnflag) AS flag, min(l_discount) AS lowest,
       min(l_discount) <> 0 AS passed, true AS passed_part FROM lineitem""",
    "check_value": """
SELECT count(*) AS n, count(*) = 25 AS exact, count(*) = 24 AS off,
       (SELECT avg(l_quantity) BETWEEN 22.95 AND 28.05 FROM lineitem) AS near FROM nation""",
    "check_interval": """
WITH m AS (
  SELECT CAST(ts AS DATE) = DATE '2024-01-15' AS is_now,
         unnest(['count(*)', 'count(DISTINCT user_id)', 'max(value)']) AS metric,
         unnest([1.5::DOUBLE, 1.2, 1.01]) AS threshold,
         unnest([count(*)::DOUBLE, count(DISTINCT user_id), max(value)]) AS v
  FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-15', DATE '2024-01-08') GROUP BY 1
), r AS (
  SELECT metric, threshold, max(v) FILTER (is_now) AS current, max(v) FILTER (NOT is_now) AS past
  FROM m GROUP BY 1, 2
)
SELECT *, greatest(current, past) / least(current, past) AS ratio,
       greatest(current, past) / least(current, past) < threshold AS passed,
       bool_and(greatest(current, past) / least(current, past) < threshold) OVER () AS all_passed
FROM r""",
}
