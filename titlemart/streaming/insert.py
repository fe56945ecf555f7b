"""Append rows as they arrive, with policies for requests with invalid ones."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from titlemart.schema import BadRecordsError
from titlemart.session import scratch_scope, write_shared
from titlemart.sinks.tables import BATCH, compact_table, describe_table, put_batch
from titlemart.sources.parsing import parse_json_lines

FILE, TEXT = "_file", "_text"
REJECTED_SCHEMA = f"_reason string, _record string, {FILE} string, {BATCH} string"
WITH_ITS_REQUEST = "refused with its request"


def insert_stream(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    *,
    ignore_unknown_values: bool = False,
    skip_invalid_rows: bool = False,
    fail_on_error: bool = False,
    max_files_per_batch: int = 1000,
    every: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Follow a folder of JSON row files and append its rows to a table.

    A file is one request, whatever batch it comes in: with an invalid row in it
    nothing of it is stored, unless ``skip_invalid_rows``. Every row that is not stored
    is kept beside the table with its reason (``read_rejected``), valid rows of a refused
    file too; with ``fail_on_error`` a refused row also stops the stream. Rows are stored under
    the identity that the checkpoint gives the stream and the batch, so a replayed
    batch replaces its own rows, nothing is stored twice, and any number of
    streams may share a table. When ``compact_every`` batches lie in the table, they are merged into its
    own files (``compact_table``). Takes what is there and ends, or goes on looking ``every`` so
    often (as ``"1 minute"``).
    """
    schema, _ = describe_table(spark, table)
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_batch).text(source)
    lines = lines.select("value", F.col("value").alias(TEXT), F.col("_metadata.file_path").alias(FILE))

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = f"{_stream_id(session, checkpoint)}-{batch_id}"
        with scratch_scope(session):
            parsed = write_shared(parse_json_lines(batch, schema, ignore_unknown_values, [TEXT, FILE]), "batch")
            invalid = F.col("_reason").isNotNull()
            good, refused = parsed.where(~invalid), parsed.where(invalid)
            if not skip_invalid_rows:
                files = refused.select(FILE).distinct()
                with_request = F.lit(WITH_ITS_REQUEST).alias("_reason")
                beside = good.join(files, FILE, "left_semi").select(with_request, F.col(TEXT).alias("_record"), FILE)
                good = good.join(files, FILE, "left_anti")
                refused = refused.select("_reason", "_record", FILE).unionByName(beside)
            put_batch(good.select(*schema.names), table, name)
            if compact_every:
                compact_table(session, table, compact_every)
            refused = refused.select("_reason", "_record", FILE)
            if not refused.isEmpty():
                refused.write.mode("overwrite").parquet(f"{_rejected(table)}/{BATCH}={name}")
                if fail_on_error:
                    raise BadRecordsError(f"{refused.count()} rows refused in batch {name}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def read_rejected(spark: SparkSession, table: str) -> DataFrame:
    """Rows refused by streams into a table, with reason, file and batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_rejected(table))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], REJECTED_SCHEMA)
    return spark.read.schema(REJECTED_SCHEMA).parquet(_rejected(table))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark keeps in a checkpoint as long as that lives."""
    saved = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()
    return json.loads(saved.value)["id"]


def _rejected(table: str) -> str:
    return f"{table.rstrip('/')}__rejected"
