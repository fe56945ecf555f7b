"""Ranked lexical search over an index whose documents are grouped by length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlemart.llm import text as tx
from titlemart.llm.tables import settled, stored

BLOCK_POSTINGS = 200_000  # of one stratum that are indexed together, about
FIRST_BLOCKS = 4  # of highest bound that an item visits first
SENT_TERMS = 4_000_000  # of all items that are sent to the tasks; beyond, they are joined by shuffle
EXACT = 1 << 52  # scores up to this are summed as doubles

IMPACT = "(1000000000 * {0}) div (1000 * {0} + 12 * m)"  # of a tf in stratum m
INDEX = "m long, piece int, term long, top long, docs array<int>, tfs array<long>, counts array<int>, ids array<long>"


def term_counts(texts: DataFrame, key: str, wanted: np.ndarray | None = None) -> DataFrame:
    """``key, id, n, terms, tfs`` of ``texts(key, id, text)``: terms by 64-bit hash, n all of them with repeats.

    Only A-Z are lower-cased. With ``wanted`` (sorted hashes), ``terms`` holds no others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, starts in tx.blocks(tx.texts_of(batch.column(2))):
                _, _, hashes, bounds = tx.words(tx.LOWER[data], starts, tx.ALNUM)
                doc = tx.owner(bounds, len(hashes))
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
                    hit = wanted[at] == hashes if len(wanted) else np.zeros(len(hashes), bool)
                    doc, hashes = doc[hit], hashes[hit]
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                new = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (hashes[1:] != hashes[:-1]))[: len(doc)])
                offsets = pa.array(np.searchsorted(doc[new], np.arange(end - first + 1)).astype(np.int32))
                counts = np.diff(np.append(new, len(doc)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        batch.column(1).slice(first, end - first),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(offsets, pa.array(tx.signed(hashes[new]))),
                        pa.ListArray.from_arrays(offsets, pa.array(counts)),
                    ],
                    names=[key, "id", "n", "terms", "tfs"],
                )

    return texts.select(key, F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"{key} long, id long, n long, terms array<long>, tfs array<long>"
    )


def _filtered(counted: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``counted`` with the terms of ``wanted(term)`` only, by a join."""
    each = counted.select(key, F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select(key, F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    kept = each.join(wanted, "term").groupBy(key).agg(F.collect_list(F.struct("term", "tf")).alias("t"))
    some = kept.select(key, F.col("t.term").alias("terms"), F.col("t.tf").alias("tfs"))
    none = F.expr("array()").cast("array<bigint>")
    joined = counted.drop("terms", "tfs").join(some, key, "left")
    return joined.select(key, "id", "n", F.coalesce("terms", none).alias("terms"), F.coalesce("tfs", none).alias("tfs"))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    """What one occurrence weighs in a document of normaliser ``m`` that has ``tf``."""
    return tf * 1_000_000_000 // (tf * 1000 + m * 12)


def _indexed(block: pa.Table) -> pa.Table:
    """The postings of one block of documents: a row per term, by falling tf, and one with the ids."""
    block = block.sort_by([("id", "ascending")])  # NULL last; so positions decide ties
    lists = block["terms"].combine_chunks()
    doc = np.repeat(np.arange(block.num_rows, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    terms, tfs = lists.flatten().to_numpy(), block["tfs"].combine_chunks().flatten().to_numpy()
    order = np.lexsort((doc, -tfs, terms))
    doc, terms, tfs = doc[order], terms[order], tfs[order]
    first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[: len(terms)])
    run = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1]))[: len(terms)])
    by_run = pa.array(np.append(np.searchsorted(run, first), len(run)).astype(np.int32))
    n = len(first)
    none = lambda kind: pa.nulls(1, pa.list_(kind))
    columns = {
        "m": pa.array(np.full(n + 1, block["m"][0].as_py())),
        "piece": pa.array(np.full(n + 1, block["piece"][0].as_py(), np.int32)),
        "term": pa.chunked_array([pa.array(terms[first], pa.int64()), pa.nulls(1, pa.int64())]),
        "top": pa.chunked_array([pa.array(tfs[first], pa.int64()), pa.nulls(1, pa.int64())]),
        "docs": pa.chunked_array([pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pa.array(doc, pa.int32())), none(pa.int32())]),
        "tfs": pa.chunked_array([pa.ListArray.from_arrays(by_run, pa.array(tfs[run], pa.int64())), none(pa.int64())]),
        "counts": pa.chunked_array([pa.ListArray.from_arrays(by_run, pa.array(np.diff(np.append(run, len(doc))).astype(np.int32))), none(pa.int32())]),
        "ids": pa.chunked_array([pa.nulls(n, pa.list_(pa.int64())), pa.array([block["id"].to_pylist()], pa.list_(pa.int64()))]),
    }
    return pa.table(columns)


def best_of_block(postings: pa.Table, visits: pa.Table, k: int) -> pa.Table:
    """The ``k`` best documents of a block for each visiting item, if they score ``least`` or more.

    Impacts are worked out once per tf of a term; an item's score adds them up over its terms' postings.
    """
    ids = postings.filter(pc.is_null(postings["term"]))["ids"][0].values if postings.num_rows else pa.array([], pa.int64())
    postings = postings.filter(pc.is_valid(postings["term"])).sort_by("term")
    out: dict[str, list] = {"item": [], "at": [], "score": []}
    if postings.num_rows and visits.num_rows:
        m = postings["m"][0].as_py()
        lists = postings["docs"].combine_chunks()
        docs, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        terms = postings["term"].to_numpy()
        worth = np.repeat(impact(postings["tfs"].combine_chunks().flatten().to_numpy(), m), postings["counts"].combine_chunks().flatten().to_numpy())
        for item, own, gains, least in zip(*(visits[c].to_pylist() for c in ("item", "terms", "gains", "least"))):
            own, gains = np.array(own, np.int64), np.array(gains, np.int64)
            at = np.minimum(np.searchsorted(terms, own), len(terms) - 1)
            here = terms[at] == own
            at, gains = at[here], gains[here]
            size = bounds[at + 1] - bounds[at]
            if not size.sum():
                continue
            picked = np.arange(size.sum()) + np.repeat(bounds[at] - np.append(0, size.cumsum()[:-1]), size)
            parts = np.repeat(gains, size) * worth[picked]
            if parts.sum() < EXACT:
                score = np.bincount(docs[picked], parts, len(ids)).astype(np.int64)
            else:
                score = np.zeros(len(ids), np.int64)
                np.add.at(score, docs[picked], parts)
            good = np.flatnonzero(score >= max(least, 1))
            if len(good) > k:
                good = good[score[good] >= np.partition(score[good], len(good) - k)[len(good) - k]]
            good = good[np.lexsort((good, -score[good]))][:k]
            out["item"] += [item] * len(good)
            out["at"] += good.tolist()
            out["score"] += score[good].tolist()
    found = ids.take(pa.array(out["at"], pa.int64()))
    return pa.table({"item": pa.array(out["item"], pa.int64()), "doc_id": found, "score": pa.array(out["score"], pa.int64())})


def _visited(index: DataFrame, visits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best documents ``item, doc_id, score`` of the blocks that ``visits(item, m, piece, least)`` names."""
    asked = visits.join(queries, "item").select("m", "piece", "item", "terms", "gains", "least")
    blocks = visits.select("m", "piece").distinct()
    named = index.join(blocks, ["m", "piece"], "left_semi")

    def run(postings: pa.Table, visitors: pa.Table) -> pa.Table:
        return best_of_block(postings, visitors, k)

    found = named.groupBy("m", "piece").cogroup(asked.groupBy("m", "piece")).applyInArrow(run, "item long, doc_id long, score long")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.select("item", "doc_id", "score", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best of ``docs(doc_id, text)`` for each of ``items(item_id, text)``: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters and digits and of any other characters beyond ASCII. N documents have
    a term, L terms in all; a term in df of them weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``, and a
    document of n terms has the normaliser ``m = 75 + 25 * n * N div L``. It scores the sum of weight times
    ``impact(tf, m)`` over the item's terms, repeats included; only scores above 0 count, and ties go
    to the smaller ``doc_id``, NULL last.

    Documents of equal m make a stratum, in blocks of bounded size by the row's hash. A block's bound for an
    item follows from the highest tf of each term in it. The FIRST_BLOCKS of highest bound are
    visited first; their k-th score then rules out all blocks bounded below it.

    NULL text has no terms; such a document is in no result and such an item has none. Every row is a
    document or an item of its own, repeated or NULL ids too. Other columns are ignored.
    Terms are told apart by 64-bit hashes.
    """
    return settled(docs.sparkSession, "ranked", lambda: _rank_documents(docs, items, k))


def _rank_documents(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    keyed = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").alias("id"), "text")
    asked = stored(term_counts(keyed, "item"), "items")
    wanted = asked.select(F.explode("terms").alias("term")).distinct()
    few = wanted.count() <= SENT_TERMS
    sent = np.sort(wanted.toArrow()["term"].to_numpy().view(np.uint64)) if few else None
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "text")
    counted = stored(term_counts(numbered, "row", sent), "terms")
    totals = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"]
    if not n_docs:
        return nothing
    if not few:
        counted = stored(_filtered(counted, "row", wanted), "wanted-terms")
    counted = counted.where(F.size("terms") > 0)

    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)) * 1000)
    each = asked.select("item", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    gains = stored(
        each.select("item", F.col("t.terms").alias("term"), F.col("t.tfs").alias("times")).join(df, "term").select("item", "term", (weight * F.col("times")).alias("gain")).where("gain > 0"), "gains"
    )
    queries = gains.groupBy("item").agg(F.collect_list(F.struct("term", "gain")).alias("t")).select("item", F.col("t.term").alias("terms"), F.col("t.gain").alias("gains"))

    in_strata = counted.withColumn("m", F.expr(f"100 - 25 + (25 * n * {n_docs}L) div {n_terms}L"))
    pieces = F.ceil(F.sum(F.size("terms").cast("long")) / BLOCK_POSTINGS).cast("int")
    strata = stored(in_strata.groupBy("m").agg(F.greatest(F.lit(1), pieces).alias("pieces")), "strata")
    placed = in_strata.join(strata, "m").select("m", F.pmod(F.xxhash64("row"), "pieces").cast("int").alias("piece"), "id", "terms", "tfs")
    index = stored(placed.groupBy("m", "piece").applyInArrow(_indexed, INDEX), "postings")

    highest = index.where("term is not null").select("m", "piece", "term", F.expr(IMPACT.format("top")).alias("most"))
    bounds = stored(highest.join(gains, "term").groupBy("item", "m", "piece").agg(F.sum(F.col("gain") * F.col("most")).alias("bound")), "bounds")
    order = F.row_number().over(W.partitionBy("item").orderBy(F.col("bound").desc(), "m", "piece"))
    first = stored(bounds.withColumn("place", order).where(F.col("place") <= FIRST_BLOCKS).drop("place"), "first-blocks")
    early = stored(_visited(index, first.select("item", "m", "piece", F.lit(1).cast("long").alias("least")), queries, k).drop("rank"), "first-found")
    reached = early.groupBy("item").agg(F.count("*").alias("found"), F.min("score").alias("kth")).where(F.col("found") == k).select("item", "kth")
    rest = bounds.join(first, ["item", "m", "piece"], "left_anti").join(reached, "item", "left").withColumn("least", F.coalesce("kth", F.lit(1).cast("long")))
    late = _visited(index, rest.where(F.col("bound") >= F.col("least")).select("item", "m", "piece", "least"), queries, k).drop("rank")
    ranked = _ranked(early.unionByName(late), k)
    return ranked.join(asked.select("item", F.col("id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")


RANKED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), i AS (
  SELECT row_number() OVER () AS iid, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark
), c AS (SELECT count(*)::BIGINT AS nd, sum(len(t))::BIGINT AS nt FROM d WHERE len(t) > 0
), q AS (SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(t) AS term FROM i) GROUP BY ALL
), p AS (
  SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), f AS (SELECT term, count(*) AS df FROM p GROUP BY term
), w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, c
), s AS (
  SELECT q.iid, q.item_id, p.rid, p.doc_id,
         sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (100 - 25 + (25 * p.n * nd) // nt))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
