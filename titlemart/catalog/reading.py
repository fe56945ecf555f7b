"""Samples, pages, parameters, user functions and typed cells."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from titlemart.functions import attach_functions, cast_cell, for_each_parameter_set, run_sql
from titlemart.plans.staging import star_table
from titlemart.sinks import create_view
from titlemart.sources import exact_sample, read_page


def sample(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return exact_sample(orders, "o_orderkey", 1000, seed="7")


def sample_null_keys(spark, sf_dir):
    """A key that half of the rows lack: so many that some of those must be taken."""
    orders = star_table(spark, sf_dir, "orders")
    halved = orders.withColumn("key", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")))
    n = orders.count() * 4 // 5
    found = exact_sample(halved.select("key"), "key", n, seed="7")
    return found.agg(F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"))


def page_deep_text(spark, sf_dir):
    """A page far into a table ordered by a text key."""
    orders = star_table(spark, sf_dir, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("code"), "o_custkey"
    )
    return read_page(orders, "code", 50, start_index=1234)


def page_large(spark, sf_dir):
    """A page of more rows than one task may hold: from a tenth of the table on, two thirds of it."""
    lines = star_table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("qty"))
    keyed = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "qty")
    n = keyed.count()
    return read_page(keyed, "line", n * 2 // 3, start_index=n // 10)


def page_rest(spark, sf_dir):
    """Everything from a place on."""
    orders = star_table(spark, sf_dir, "orders")
    return read_page(orders, "o_orderkey", None, ["o_orderkey", "o_custkey"], start_index=700)


def page_by_start(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders")
    return read_page(orders, "o_orderkey", 50, ["o_orderkey", "o_custkey"], start_index=1000)


def page_by_token(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders")
    return read_page(orders, "o_orderkey", 50, ["o_orderkey", "o_orderdate"], page_token=700)


def param_filter(spark, sf_dir):
    star_table(spark, sf_dir, "orders").createOrReplaceTempView("orders_in")
    return run_sql(
        spark,
        "SELECT o_orderkey, o_totalprice FROM orders_in "
        "WHERE o_orderstatus = :status AND o_totalprice >= :floor",
        {"status": "F", "floor": 250000.0},
    )


def param_sets(spark, sf_dir):
    sets = spark.createDataFrame(
        [("first", "F", "1-URGENT"), ("second", "O", "5-LOW")],
        "set_name string, o_orderstatus string, o_orderpriority string",
    )
    orders = star_table(spark, sf_dir, "orders")
    found = for_each_parameter_set(orders, sets, ["o_orderstatus", "o_orderpriority"])
    return found.select("set_name", "o_orderkey", "o_totalprice")


def sql_function(spark, sf_dir):
    attach_functions(
        spark, ["net_price(price DOUBLE, off DOUBLE) RETURNS DOUBLE RETURN price * (1 - off)"]
    )
    star_table(spark, sf_dir, "lineitem").createOrReplaceTempView("lines_in")
    return run_sql(
        spark,
        "SELECT l_orderkey, l_linenumber, net_price(l_extendedprice, l_discount) AS net FROM lines_in",
    )


def arrow_function(spark, sf_dir):
    """A function on Arrow batches, called from SQL."""

    @F.arrow_udf("string")
    def initials(names: pa.Array) -> pa.Array:
        return pc.utf8_upper(pc.utf8_slice_codeunits(names, 0, 3))

    attach_functions(spark, python_functions={"initials": initials})
    star_table(spark, sf_dir, "customer").createOrReplaceTempView("customers_in")
    return run_sql(spark, "SELECT c_custkey, initials(c_mktsegment) AS segment FROM customers_in")


def typed_cells(spark, sf_dir):
    cells = star_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("a"),
        F.col("o_totalprice").cast("string").alias("b"),
        (F.col("o_orderstatus") == "F").cast("string").alias("c"),
        "o_orderpriority",
    )
    return cells.select(
        cast_cell(F.col("a"), "INTEGER").alias("order_id"),
        cast_cell(F.col("b"), "FLOAT").alias("price"),
        cast_cell(F.col("c"), "BOOLEAN").alias("finished"),
        cast_cell(F.col("o_orderpriority"), "STRING").alias("priority"),
        cast_cell(F.col("a"), "TIMESTAMP").alias("seconds"),
    )


def sql_view(spark, sf_dir):
    star_table(spark, sf_dir, "lineitem").createOrReplaceTempView("lines_in")
    view = create_view(
        spark, "flag_counts",
        "SELECT l_returnflag, count(*) AS n, max(l_shipdate) AS last_ship "
        "FROM lines_in GROUP BY l_returnflag",
    )
    return view.select("l_returnflag", "n", "last_ship")


QUERIES = {
    "exact_n_sample": sample,
    "exact_n_sample_null_keys": sample_null_keys,
    "paged_read": page_by_start,
    "paged_read_deep_text": page_deep_text,
    "paged_read_large": page_large,
    "paged_read_rest": page_rest,
    "paged_read_token": page_by_token,
    "param_filter": param_filter,
    "param_sets": param_sets,
    "sql_function": sql_function,
    "arrow_function": arrow_function,
    "typed_cells": typed_cells,
    "sql_view": sql_view,
}

ORACLES = {
    "exact_n_sample": """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '7'), o_orderkey LIMIT 1000""",
    "exact_n_sample_null_keys": """
WITH k AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS key FROM orders),
r AS (SELECT key FROM k ORDER BY md5(coalesce(CAST(key AS VARCHAR), '') || '7'), key NULLS FIRST
      LIMIT (SELECT count(*) * 4 // 5 FROM orders))
SELECT count(*) AS n, count(DISTINCT key) AS n_keys FROM r""",
    "paged_read_deep_text": """
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS code, o_custkey FROM orders ORDER BY code LIMIT 50 OFFSET 1234""",
    "paged_read_large": """
WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS line, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
SELECT line, qty FROM k ORDER BY line
LIMIT (SELECT count(*) * 2 // 3 FROM k) OFFSET (SELECT count(*) // 10 FROM k)""",
    "paged_read_rest": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey OFFSET 700",
    "paged_read": """
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 1000""",
    "paged_read_token": """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 50""",
    "param_filter": """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 250000.0""",
    "param_sets": """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS set_name,
       o_orderkey, o_totalprice
FROM orders WHERE (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
               OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')""",
    "sql_function": """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem""",
    "arrow_function": "SELECT c_custkey, upper(substr(c_mktsegment, 1, 3)) AS segment FROM customer",
    "typed_cells": """
SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderstatus = 'F' AS finished,
       o_orderpriority AS priority, CAST(o_orderkey AS DOUBLE) AS seconds FROM orders""",
    "sql_view": """
SELECT l_returnflag, count(*) AS n, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1""",
}
