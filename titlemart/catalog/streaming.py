"""Rows of the given tables replayed as files and inserted by a stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column
from pyspark.sql import functions as F

from titlemart.plans.staging import star_table
from titlemart.session import shared_path
from titlemart.sinks import compact_table, create_empty_table, read_table
from titlemart.sinks.export import TIME_FORMAT
from titlemart.streaming import insert_stream, read_rejected


def _json(columns) -> Column:
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": TIME_FORMAT})


def _run(spark, df, line, **policy) -> str:
    """Write lines as files and let the stream put them all into a new table."""
    source, table, checkpoint = (shared_path(spark, n) for n in ("incoming", "inserted", "progress"))
    df.select(line.alias("value")).write.text(source)
    create_empty_table(spark, table, df.schema)
    insert_stream(spark, source, table, checkpoint, **policy).awaitTermination()
    return table


def _events(spark, sf_dir):
    return star_table(spark, sf_dir, "events")


def insert(spark, sf_dir):
    events = _events(spark, sf_dir)
    table = _run(spark, events, _json(events.columns))
    return read_table(spark, table)


def _spoilt(events) -> Column:
    line = _json(events.columns)
    extra = _json([*events.columns, F.lit(1).alias("zzz")])
    kind = F.col("event_type")
    return F.when(kind == "error", F.substring(line, 1, 15)).when(kind == "view", extra).otherwise(line)


def skip_invalid(spark, sf_dir):
    events = _events(spark, sf_dir)
    table = _run(spark, events, _spoilt(events), skip_invalid_rows=True)
    return read_table(spark, table)


def skip_invalid_ignore_unknown(spark, sf_dir):
    events = _events(spark, sf_dir)
    policy = {"skip_invalid_rows": True, "ignore_unknown_values": True}
    table = _run(spark, events, _spoilt(events), **policy)
    return read_table(spark, table)


def _by_request(spark, sf_dir, **policy) -> tuple[str, bool]:
    """One file per event type; that of errors holds a broken line for every even id."""
    source, table, checkpoint = (shared_path(spark, n) for n in ("incoming", "inserted", "progress"))
    events = _events(spark, sf_dir)
    line = _json(events.columns)
    broken = (F.col("event_type") == "error") & (F.col("event_id") % 2 == 0)
    lines = events.select(F.when(broken, F.substring(line, 1, 15)).otherwise(line).alias("value"), "event_type")
    lines.repartition("event_type").write.partitionBy("event_type").text(source)
    create_empty_table(spark, table, events.schema)
    query = insert_stream(spark, f"{source}/*", table, checkpoint, **policy)
    try:
        query.awaitTermination()
    except StreamingQueryException:
        return table, True
    return table, False


def refused_request(spark, sf_dir):
    table, _ = _by_request(spark, sf_dir, max_files_per_batch=2)
    return read_table(spark, table)


def refused_request_rows(spark, sf_dir):
    table, _ = _by_request(spark, sf_dir)
    return read_rejected(spark, table).groupBy(F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("_file").alias("n_files")
    )


def fail_on_error(spark, sf_dir):
    """The stream stops, with the good files of its batch stored and the bad one kept aside."""
    table, stopped = _by_request(spark, sf_dir, fail_on_error=True)
    return read_table(spark, table).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.lit(stopped).alias("stopped")
    )


def rejected_rows(spark, sf_dir):
    events = _events(spark, sf_dir)
    table = _run(spark, events, _spoilt(events), skip_invalid_rows=True)
    return read_rejected(spark, table).groupBy(F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


def compacted(spark, sf_dir):
    """Many batches into days and clusters, merged on the way and once more at the end."""
    source, table, checkpoint = (shared_path(spark, n) for n in ("incoming", "inserted", "progress"))
    events = _events(spark, sf_dir)
    events.select(_json(events.columns).alias("value")).repartition(8).write.text(source)
    create_empty_table(spark, table, events.schema, partition_field="ts", cluster_fields=["user_id"])
    insert_stream(spark, source, table, checkpoint, max_files_per_batch=2, compact_every=3).awaitTermination()
    merged = compact_table(spark, table, least=1)
    return read_table(spark, table).withColumn("merged_at_end", F.lit(merged))


QUERIES = {
    "stream_insert": insert,
    "stream_compacted": compacted,
    "stream_insert_skip_invalid": skip_invalid,
    "stream_insert_ignore_unknown": skip_invalid_ignore_unknown,
    "stream_rejected": rejected_rows,
    "stream_insert_refused": refused_request,
    "stream_refused_rows": refused_request_rows,
    "stream_fail_on_error": fail_on_error,
}

_COLUMNS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

ORACLES = {
    "stream_insert": _COLUMNS,
    "stream_compacted": "SELECT event_id, ts, user_id, event_type, value, props, 1 AS merged_at_end FROM events",
    "stream_insert_skip_invalid": f"{_COLUMNS} WHERE event_type NOT IN ('error', 'view')",
    "stream_insert_ignore_unknown": f"{_COLUMNS} WHERE event_type <> 'error'",
    "stream_insert_refused": f"{_COLUMNS} WHERE event_type <> 'error'",
    "stream_refused_rows": """
SELECT CASE event_id % 2 WHEN 0 THEN 'malformed' ELSE 'refused with its request' END AS reason,
       count(*) AS n, CAST(1 AS BIGINT) AS n_files FROM events WHERE event_type = 'error' GROUP BY 1""",
    "stream_fail_on_error": """
SELECT event_type, count(*) AS n, true AS stopped FROM events WHERE event_type <> 'error' GROUP BY 1""",
    "stream_rejected": """
SELECT CASE event_type WHEN 'error' THEN 'malformed' ELSE 'unknown field' END AS reason,
       count(*) AS n FROM events WHERE event_type IN ('error', 'view') GROUP BY 1""",
}
