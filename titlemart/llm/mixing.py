"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlemart.llm.tables import WORD, stored

WEIGHTS = (5, 2, 1)
MOST = 3  # times a document may be taken
SLICES = 4096  # of the shuffle order of one source, for running sums without one long sort


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, sid, source_size, target`` from ``sizes(source, size)``.

    Sources by code point, NULL last, take the weights in turn and share all words by
    weight; a target stops at ``most`` times its source's size and the excess is shared
    again. With sources in order of that cap per weight, the level at which the k-th one is
    still open is ``(total - caps before it) / (weights from it on)``; the highest of these is
    the final level. One row per source, so the windows are as small as that list.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = W.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    choices = F.array(*[F.lit(w) for w in weights])
    ranked = per_source.withColumn("sid", place).withColumn("weight", F.element_at(choices, (F.col("sid") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    open_from = everything.orderBy(F.col("cap") / F.col("weight"), "sid")
    ahead = F.coalesce(F.sum("cap").over(open_from.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(open_from.rowsBetween(0, W.unboundedFollowing))
    ranked = ranked.withColumn("level", (F.sum("source_size").over(everything) - ahead) / behind)
    level = F.max("level").over(everything)
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return ranked.select("source", "sid", "source_size", target.alias("target"))


def weighted_fair_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, key: str | None = None) -> DataFrame:
    """Copies of ``docs(doc_id, source, text)`` that the mix takes, as a stream by virtual time.

    Each source queues its documents in a hashed order, as often over (``epoch``) as its
    target needs. A copy's virtual finish time is the running number of its source's words
    divided by the source's target, which is its weight after the limit to ``most`` times its size. As in a
    fair queue that splits long packets, a copy that would overrun its source's target is served in two
    parts (``part`` 0 and 1). All parts are range-sorted by finish time, words are
    summed up range by range, and the stream is cut at the total budget, the sum of the targets in whole words. So each
    source falls short of its target by less than one word.

    Returns ``row, doc_id, source, sid, size, source_size, target, epoch, ticket, start, finish, part, words, taken``,
    with at least part 0 of epoch 0 of every row of ``docs`` (``taken`` 0 if it is beyond the cut);
    ``in_stream_order`` sorts them. ``row`` is the column ``key`` of ``docs``, or a number given here. NULL text has size 0; NULL is a source. The
    order is hashed from id and text, so rows without id are spread too; rows equal in both are served next to each
    other. Running sums of a source go slice by slice of that order, so a source with any share of the rows
    is spread over 4096 groups.
    """
    row = F.monotonically_increasing_id() if key is None else F.col(key)
    own = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    base = stored(docs.select(row.alias("row"), "doc_id", "source", size.alias("size"), own.alias("own")), "sizes")
    targets = stored(source_targets(base, weights, most), "targets")
    rounds = F.greatest(F.lit(1), F.ceil(F.try_divide("target", "source_size")).cast("int"))
    named = base.withColumnRenamed("source", "name")
    copies = (
        named.join(targets, F.col("name").eqNullSafe(F.col("source")))
        .drop("name")
        .withColumn("rounds", F.coalesce(F.least(rounds, F.lit(most)), F.lit(1)))
        .withColumn("epoch", F.explode(F.expr("sequence(0, rounds - 1)")))
        .withColumn("ticket", F.md5(F.concat_ws(":", "own", "epoch")))
        # rows without words may stand anywhere in the queue
        .withColumn("slice", F.when(F.col("size") > 0, F.conv(F.substring("ticket", 1, 3), 16, 10).cast("int")).otherwise(F.pmod(F.xxhash64("row"), F.lit(SLICES)).cast("int")))
    )
    slot = ["sid", "epoch", "slice"]
    sums = copies.groupBy(*slot).agg(F.sum("size").alias("slice_words"))
    before = F.coalesce(F.sum("slice_words").over(W.partitionBy("sid").orderBy("epoch", "slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(*slot, before.alias("offset"))
    within = F.sum("size").over(W.partitionBy(*slot).orderBy("ticket", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, 0))
    queued = copies.join(offsets, slot).withColumn("start", F.col("offset") + within - F.col("size"))

    first = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.floor("target").cast("long") - F.col("start")))
    finish = lambda words: ((F.col("start") + words) / F.when(F.col("target") > 0, F.col("target"))).alias("finish")
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.col("first").alias("words"), finish(F.col("first"))),
        F.struct(F.lit(1).alias("part"), (F.col("size") - F.col("first")).alias("words"), finish(F.col("size"))),
    )
    served = queued.withColumn("first", first).withColumn("p", F.explode(F.filter(parts, lambda p: (p["part"] == 0) | (p["words"] > 0))))
    served = served.select("row", "doc_id", "source", "sid", "size", "source_size", "target", "epoch", "ticket", "start", "p.finish", "p.part", "p.words")
    budget = targets.agg(F.sum(F.floor("target").cast("long"))).first()[0] or 0
    return _cut_at(served, ["finish", "part", "sid", "epoch", "ticket"], budget)


def _cut_at(parts: DataFrame, order: list[str], budget: int) -> DataFrame:
    """``parts`` with ``taken``: their ``words`` up to ``budget`` in the global order.

    They are sorted into files by range; the words of the ranges before, and those before in the same range, say
    where a part begins in the stream.
    """
    ranged = stored(parts.repartitionByRange(*order).sortWithinPartitions(*order), "by-finish")
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)-", 1).cast("int")
    placed = ranged.select(*parts.columns, number.alias("range_"), F.col("_metadata.row_index").alias("place_"))
    sums = placed.groupBy("range_").agg(F.sum("words").alias("range_words"))  # one row per range
    ahead = F.coalesce(F.sum("range_words").over(W.orderBy("range_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = sums.select("range_", ahead.alias("ahead_"))
    within = F.sum("words").over(W.partitionBy("range_").orderBy("place_").rowsBetween(W.unboundedPreceding, 0)) - F.col("words")
    left = F.lit(budget).cast("long") - F.col("ahead_") - F.col("within_")
    counted = placed.withColumn("within_", within).join(ahead, "range_")
    return counted.select(*parts.columns, F.least(F.col("words"), F.greatest(F.lit(0).cast("long"), left)).alias("taken"))


def in_stream_order(copies: DataFrame) -> DataFrame:
    """The taken copies, globally range-sorted by virtual finish time."""
    return copies.where("taken > 0").orderBy("finish", "part", "sid", "epoch", "ticket")


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken`` over all its copies."""
    copies = weighted_fair_mix(docs, weights, most)
    whole = copies.groupBy("row", "doc_id", "size", "source_size", "target").agg(F.sum("taken").alias("taken"))
    return whole.drop("row")


TAKEN_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS own,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w
), t AS (
  SELECT source, sid, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM l
), c AS (
  SELECT rid, doc_id, own, sid, size, source_size, target,
         unnest(range(greatest(1, least(3, coalesce(ceil(target / nullif(source_size, 0)), 1)))::BIGINT)) AS epoch
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, sum(size) OVER (PARTITION BY sid ORDER BY epoch, md5(own || ':' || epoch), doc_id, size, rid
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM c
)
SELECT doc_id, size, source_size, target, sum(least(size, greatest(0, floor(target)::BIGINT - start)))::BIGINT AS taken
FROM q GROUP BY rid, doc_id, size, source_size, target
"""
