"""Small steps the operators share: shared tables and connected components."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemart.session import scratch_scope, shared_path, write_shared

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = str(Path(__file__).resolve().parents[2])

WHITE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
ROW = "row struct<doc_id: bigint, version: bigint>"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cut lineage that outlives executors."""
    return write_shared(df, label)


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` makes, as a table in the shared folder; the tables it stored on the way go."""
    path = shared_path(spark, label)
    with scratch_scope(spark):
        made = build()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def with_row(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with ``row``: the id and a hash of the text, the same each time it is read.

    Rows with one id and different texts differ in it; fully repeated rows share it and what is found in them.
    """
    return docs.withColumn("row", F.struct("doc_id", F.xxhash64("text").alias("version")))


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it lies (a cluster without it there gets --py-files).

    Where Arrow batches still have Spark's number of rows, they get fewer: a row is a document.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), ROOT]))
    return spark


def read_table(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``links(a, b)``: ``(node, component)``.

    Large-star and small-star steps in turn: every node's larger neighbours are
    hung on its smallest one, then its smaller ones; each step is a shuffle of at
    most as many links as there were, and a hub's neighbours spread over the tasks
    because only the minimum is aggregated per node. Ends when a round changes
    nothing; every round is stored.
    """
    edges = stored(_tidy(links), "edges")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b"), F.col("b"))).distinct()


def _tidy(links: DataFrame) -> DataFrame:
    """Each link once, larger node first."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _tidy(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _tidy(hung.union(low.select("a", F.col("m").alias("b"))))
