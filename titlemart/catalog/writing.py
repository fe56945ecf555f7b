"""Tables written under every disposition and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.plans.staging import staged_titles, star_table
from titlemart.session import shared_path
from titlemart.sinks import copy_tables, create_empty_table, expire_partitions, export_table, read_table, write_table
from titlemart.sinks.tables import describe_table, table_exists


def _orders(spark, sf_dir):
    return star_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


def truncate_from_itself(spark, sf_dir):
    path = shared_path(spark, "table")
    write_table(_orders(spark, sf_dir), path)
    raised = read_table(spark, path).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_table(raised, path, "WRITE_TRUNCATE")
    return read_table(spark, path)


def append_evolve(spark, sf_dir):
    path = shared_path(spark, "table")
    orders = _orders(spark, sf_dir)
    write_table(orders.drop("o_totalprice"), path)
    write_table(orders, path, "WRITE_APPEND", schema_update_options=["ALLOW_FIELD_ADDITION"])
    return read_table(spark, path)


def append_retried(spark, sf_dir):
    """An append repeated under its load id adds nothing; under another it does."""
    path = shared_path(spark, "table")
    orders = _orders(spark, sf_dir)
    write_table(orders, path)
    for load_id in ("monday", "monday", "tuesday"):
        write_table(orders.where("o_orderstatus = 'P'"), path, "WRITE_APPEND", load_id=load_id)
    return read_table(spark, path).groupBy(*orders.columns).agg(F.count(F.lit(1)).alias("n"))


def write_empty(spark, sf_dir):
    path = shared_path(spark, "table")
    orders = _orders(spark, sf_dir)
    create_empty_table(spark, path, orders.schema)
    write_table(orders, path, "WRITE_EMPTY", "CREATE_NEVER")
    return read_table(spark, path)


def partition_overwrite(spark, sf_dir):
    """Events by day; one day is then replaced by its own rows, doubled in value."""
    path = shared_path(spark, "table")
    events = star_table(spark, sf_dir, "events").select("event_id", "ts", "value")
    write_table(events, path, partition_field="ts")
    day = read_table(spark, path, day="2024-01-15")
    write_table(
        day.withColumn("value", F.col("value") * 2), path, "WRITE_TRUNCATE", partition="2024-01-15"
    )
    return read_table(spark, path)


def partition_range(spark, sf_dir):
    path = shared_path(spark, "table")
    events = star_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    write_table(events, path, partition_field="ts")
    return read_table(spark, path, days=("2024-01-05", "2024-01-08"))


def partition_expiry(spark, sf_dir):
    """Days end five days after they began: reads leave them out, then their folders go."""
    path, as_of = shared_path(spark, "table"), datetime(2024, 1, 20, 12)
    events = star_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    write_table(events, path, partition_field="ts", partition_expiration_ms=5 * 86_400_000)
    live = read_table(spark, path, as_of=as_of)
    n, gone = live.count(), expire_partitions(spark, path, as_of)
    left = read_table(spark, path, as_of=datetime(2000, 1, 1))
    return left.withColumns({"n_live": F.lit(n).cast("bigint"), "n_gone": F.lit(gone).cast("bigint")})


def cluster_write(spark, sf_dir):
    path = shared_path(spark, "table")
    lines = star_table(spark, sf_dir, "lineitem")
    write_table(lines, path, cluster_fields=["l_returnflag", "l_suppkey"])
    return read_table(spark, path).where("l_returnflag = 'R'").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("last_ship")
    )


def copy_union(spark, sf_dir):
    first, second, both = (shared_path(spark, "table") for _ in range(3))
    orders = _orders(spark, sf_dir)
    write_table(orders.where("o_orderstatus = 'F'"), first)
    write_table(orders.where("o_orderstatus <> 'O'"), second)
    copy_tables(spark, [first, second], both)
    return read_table(spark, both)


def copy_partitioned(spark, sf_dir):
    """A copy keeps days and clusters: one of its days is read back, and its layout."""
    first, second = (shared_path(spark, "table") for _ in range(2))
    events = star_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    write_table(events, first, partition_field="ts", cluster_fields=["user_id"])
    copy_tables(spark, first, second)
    layout = describe_table(spark, second)[1]
    return read_table(spark, second, day="2024-01-15").withColumns(
        {"by_day": F.lit(layout["partition_field"]), "by": F.lit(",".join(layout["cluster_fields"]))}
    )


def relax_required(spark, sf_dir):
    """A required column becomes optional, so that rows without it may be added."""
    path = shared_path(spark, "table")
    orders = _orders(spark, sf_dir)
    required = orders.withColumn("o_totalprice", F.col("o_totalprice").alias("o_totalprice", metadata={"mode": "REQUIRED"}))
    write_table(required, path)
    write_table(orders.drop("o_totalprice"), path, "WRITE_APPEND", schema_update_options=["ALLOW_FIELD_RELAXATION"])
    return read_table(spark, path)


def create_never(spark, sf_dir):
    """A table that is not there may not be made; no rows are written."""
    path = shared_path(spark, "table")
    orders = _orders(spark, sf_dir)
    try:
        write_table(orders, path, create_disposition="CREATE_NEVER")
        refused = False
    except ValueError:
        refused = True
    return orders.agg(F.count("*").alias("n"), F.lit(refused).alias("refused"), F.lit(table_exists(spark, path)).alias("made"))


def export_csv(spark, sf_dir):
    """Nested titles to CSV; arrays become JSON text."""
    path = shared_path(spark, "export")
    titles = staged_titles(spark, sf_dir).select("id", "title", "spoken_languages", "release_date")
    export_table(titles, path, "CSV", field_delimiter="\t")
    layout = T.StructType.fromDDL("id bigint, title string, spoken_languages string, release_date date")
    read = spark.read.schema(layout).options(sep="\t", header=True, escape='"').csv(path)
    parsed = F.from_json("spoken_languages", titles.schema["spoken_languages"].dataType)
    return read.select("id", "title", "release_date", F.size(parsed).cast("bigint").alias("n_languages"))


def export_json(spark, sf_dir):
    path = shared_path(spark, "export")
    events = star_table(spark, sf_dir, "events")
    export_table(events, path, "NEWLINE_DELIMITED_JSON", compression="GZIP")
    return spark.read.schema(events.schema).json(path)


def export_parquet(spark, sf_dir):
    path = shared_path(spark, "export")
    export_table(star_table(spark, sf_dir, "part"), path, "PARQUET", compression="SNAPPY")
    return spark.read.parquet(path)


QUERIES = {
    "truncate_from_itself": truncate_from_itself,
    "append_evolve": append_evolve,
    "append_retried": append_retried,
    "write_empty": write_empty,
    "partition_overwrite": partition_overwrite,
    "partition_range": partition_range,
    "partition_expiry": partition_expiry,
    "cluster_write": cluster_write,
    "copy_union": copy_union,
    "copy_partitioned": copy_partitioned,
    "relax_required": relax_required,
    "create_never_refused": create_never,
    "export_csv": export_csv,
    "export_json": export_json,
    "export_parquet": export_parquet,
}

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"

ORACLES = {
    "truncate_from_itself": """
SELECT o_orderkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders""",
    "append_evolve": f"""
SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice, o_orderdate FROM orders
UNION ALL {_ORDERS}""",
    "append_retried": f"SELECT *, CASE o_orderstatus WHEN 'P' THEN 3 ELSE 1 END::BIGINT AS n FROM ({_ORDERS})",
    "write_empty": _ORDERS,
    "partition_overwrite": """
SELECT event_id, ts,
       CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN value * 2 ELSE value END AS value
FROM events""",
    "partition_range": """
SELECT event_id, ts, event_type FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'""",
    "partition_expiry": """
SELECT event_id, ts, event_type, count(*) OVER () AS n_live,
       (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15') AS n_gone
FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'""",
    "cluster_write": """
SELECT l_suppkey, count(*) AS n, max(l_shipdate) AS last_ship
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "copy_union": f"""
{_ORDERS} WHERE o_orderstatus = 'F' UNION ALL {_ORDERS} WHERE o_orderstatus <> 'O'""",
    "copy_partitioned": """
SELECT event_id, ts, user_id, 'ts' AS by_day, 'user_id' AS "by" FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "relax_required": f"""
{_ORDERS} UNION ALL SELECT o_orderkey, o_orderstatus, NULL, o_orderdate FROM orders""",
    "create_never_refused": "SELECT count(*) AS n, true AS refused, false AS made FROM orders",
    "export_csv": """
SELECT o_orderkey AS id, 'T' || o_orderkey AS title, CAST(o_orderdate AS DATE) AS release_date,
       count(DISTINCT n_regionkey) AS n_languages
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
GROUP BY ALL""",
    "export_json": "SELECT * FROM events",
    "export_parquet": "SELECT * FROM part",
}
