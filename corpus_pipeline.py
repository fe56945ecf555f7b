"""The corpus pipeline: five stages from raw documents to a mix of clean ones.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the
columns of ``docs``; the last one returns the mix, a row per copy in stream order.
Stages treat NULL text as empty. Where ids do not name one row each (NULL, or repeated), rows are
told apart by where they are stored, so decisions hold for the row they were made on: of copies, the one
with the smallest id stays, a row without id only if none has one, and one of fully repeated rows.
Columns of any name are carried in a struct, so none can clash.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlemart.llm import decontaminate, exact_dedup, minhash, mixing, quality
from titlemart.llm.tables import reachable, read_table, stored
from titlemart.session import delete_folder, scratch_scope, shared_path


ROWS_A_FILE = 1 << 38  # that a file may have where rows are numbered by file and place


def _placed(docs: DataFrame) -> DataFrame | None:
    """``row_`` (all columns of ``docs``), ``file_`` and ``place_``: where each row is stored, the same at each reading.

    None if ``docs`` are not read from Parquet files.
    """
    try:
        return docs.select(F.struct("*").alias("row_"), F.col("_metadata.file_path").alias("file_"), F.col("_metadata.row_index").alias("place_"))
    except AnalysisException:
        return None


def _keyed(docs: DataFrame) -> DataFrame:
    """``row_`` (all columns of ``docs``) and ``key_``, a number of its own for every row.

    The id where each id names one row; else the row's place in its file and the file's number, or a
    number stored with the rows if they are not read from files.
    """
    repeated = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if repeated.isEmpty():
        return docs.select(F.struct("*").alias("row_"), F.col("doc_id").cast("long").alias("key_"))
    placed = _placed(docs)
    if placed is None:
        return stored(docs.select(F.struct("*").alias("row_"), F.monotonically_increasing_id().alias("key_")), "numbered")
    files = placed.select("file_").distinct()
    numbers = stored(files.select("file_", F.row_number().over(W.orderBy("file_")).cast("long").alias("n_")), "files")
    return placed.join(numbers, "file_").select("row_", (F.col("n_") * ROWS_A_FILE + F.col("place_")).alias("key_"))


def _texts(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col("key_").alias("doc_id"), F.col("row_.text").alias("text"))


def _without(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose key is not in ``gone(gone_)``."""
    return keyed.join(gone, keyed["key_"] == gone["gone_"], "left_anti").select("row_.*")


def _one_of_each(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents without those of ``groups(key_, group_)`` but one: the smallest id, NULL last, then the smallest key."""
    members = stored(groups.join(keyed.select("key_", F.col("row_.doc_id").alias("id_")), "key_"), "members")
    rank = F.struct(F.col("id_").isNull(), F.col("id_"), F.col("key_"))
    keepers = members.groupBy("group_").agg(F.min(rank).alias("least_")).select(F.col("least_.key_").alias("key_"))
    gone = members.select("key_").join(keepers, "key_", "left_anti").select(F.col("key_").alias("gone_"))
    return _without(keyed, stored(gone, "gone"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject; fitted on the labelled ones among ``docs``."""
    reachable(spark)
    trees = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, trees).where("predicted = 1").select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    reachable(spark)
    keyed = _keyed(docs)
    found = exact_dedup.exact_duplicates(_texts(keyed)).where("group_size > 1")
    return _one_of_each(keyed, found.select(F.col("doc_id").alias("key_"), F.col("keep_id").alias("group_")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies (five words, 0.8), the one with the smallest id."""
    reachable(spark)
    keyed = _keyed(docs)
    found = stored(minhash.near_duplicates(_texts(keyed), k=5, percent=80).where("n_shingles > 0").select("doc_id", "component_id"), "classes")
    shared = found.groupBy("component_id").count().where("count > 1").select("component_id")
    groups = found.join(shared, "component_id", "left_semi")
    return _one_of_each(keyed, groups.select(F.col("doc_id").alias("key_"), F.col("component_id").alias("group_")))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    reachable(spark)
    keyed = _keyed(docs)
    found = decontaminate.contaminated(_texts(keyed), read_table(spark, sf_dir, "benchmark"))
    return _without(keyed, found.select(F.col("doc_id").alias("gone_")).distinct())


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in stream order: the columns of ``docs``, and ``mix_epoch``, ``mix_finish``, ``mix_words`` of each copy.

    Texts are read where they lie and joined with the copies by place, so no second copy of them is stored.
    """
    placed = _placed(docs)
    if placed is None:
        numbered = docs.select(F.struct("*").alias("row_"), F.lit("").alias("file_"), F.monotonically_increasing_id().alias("place_"))
        placed = stored(numbered, "to-mix")
    flat = placed.select("row_.doc_id", "row_.source", "row_.text", F.struct("file_", "place_").alias("key"))
    copies = mixing.weighted_fair_mix(flat, key="key").where("taken > 0")
    taken = stored(copies.select("row.file_", "row.place_", "sid", "ticket", F.struct("epoch", "finish", "taken").alias("mix_")), "copies")
    ordered = placed.join(taken, ["file_", "place_"]).orderBy("mix_.finish", "sid", "mix_.epoch", "ticket")
    return ordered.select("row_.*", F.col("mix_.epoch").alias("mix_epoch"), F.col("mix_.finish").alias("mix_finish"), F.col("mix_.taken").alias("mix_words"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", leak_stage),
    ("mixing sources to target weights", mix_stage),
]

# No SQL: the classifier, the sketches and the tiles have no counterpart in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next one reads it."""
    docs, kept = read_table(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        before, kept = kept, shared_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(kept)
        docs = spark.read.parquet(kept)
        if before:
            delete_folder(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
