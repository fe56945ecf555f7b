"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemart.llm import text as tx
from titlemart.llm.tables import settled, stored

TILE = 5  # words of the shortest tile, which is also the seed
COVER = 0.5  # share of a test item's words that tiles must cover
SENT_SEEDS = 4_000_000  # up to so many distinct seeds (32 MB) are sent to the tasks; more are joined by shuffle


def token_grams(texts: list[bytes], k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of k words at each word, where all k lie in the document.

    A word is a run of letters, digits and non-ASCII bytes; A-Z count as a-z. Returns
    ``first, end, hashes, document of each hash, word number in the document``, and words per document.
    """
    for first, end, data, starts in tx.blocks(texts):
        _, _, hashes, bounds = tx.words(tx.LOWER[data], starts, tx.ALNUM)
        n = np.maximum(np.diff(bounds) - k + 1, 0)
        doc = np.repeat(np.arange(end - first), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = bounds[doc] + place
        yield first, end, tx.span_hash(tx.prefix_hash(hashes), at, at + k), doc, place, np.diff(bounds)


def greedy_tiles(places: np.ndarray, grams: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Tiles ``(document word, item word, words)`` by running Karp-Rabin greedy string tiling.

    Both sides are sequences of hashes of k words: the document's where it has seeds
    (``places`` ascending), the item's without gaps. A search length s starts at the longest
    possible match and halves down to one gram. For each s, rolling hashes of s unmarked grams
    of the item are looked up from the document, matches are extended as far as both go
    on, and the longest are marked first; a tile also blocks the grams that overlap
    its words. What a longer tile has cut is found again with a smaller s.
    """
    text = grams.tolist()
    where = places.tolist()
    pattern = item.tolist()
    free_text, free_item = [True] * len(text), [True] * len(pattern)
    follows = [i + 1 < len(where) and where[i + 1] == where[i] + 1 for i in range(len(where))]
    tiles = []
    s = min(len(text), len(pattern))
    while s:
        while found := _matches(text, follows, free_text, pattern, free_item, s):
            marked = False
            for size, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
                if all(free_text[i : i + size]) and all(free_item[j : j + size]):
                    tiles.append((where[i], j, size + k - 1))
                    marked = True
                    _block(free_text, where, i, size, k)
                    lo, hi = max(0, j - k + 1), j + size + k - 1
                    free_item[lo:hi] = [False] * (min(hi, len(pattern)) - lo)
            if not marked:
                break
        s = s // 2
    return tiles


def _block(free: list[bool], where: list[int], i: int, size: int, k: int) -> None:
    lo, hi = where[i] - k + 1, where[i] + size + k - 2
    for step, at in ((-1, i - 1), (1, i)):
        while 0 <= at < len(where) and lo <= where[at] <= hi:
            free[at] = False
            at += step


def _rolling(values: list[int], goes_on: list[bool] | None, free: list[bool], s: int) -> Iterator[tuple[int, int]]:
    """``(hash, start)`` of every run of s free values, by a hash that rolls along."""
    base, prime = 1_000_003, (1 << 61) - 1
    top = pow(base, s - 1, prime)
    value, run = 0, 0
    for i, v in enumerate(values):
        if not free[i] or (i and goes_on is not None and not goes_on[i - 1]):
            value, run = 0, 0
        if not free[i]:
            continue
        if run == s:
            value = (value - values[i - s] * top) % prime
            run -= 1
        value = (value * base + v) % prime
        run += 1
        if run == s:
            yield value, i - s + 1


def _matches(text, follows, free_text, pattern, free_item, s) -> list[tuple[int, int, int]]:
    table: dict[int, list[int]] = {}
    for h, j in _rolling(pattern, None, free_item, s):
        table.setdefault(h, []).append(j)
    out, reached = [], {}
    for h, i in _rolling(text, follows, free_text, s):
        for j in table.get(h, ()):
            if reached.get(i - j, -1) > i:  # inside a match of this diagonal
                continue
            if text[i : i + s] != pattern[j : j + s]:
                continue
            size = s
            while (
                i + size < len(text) and j + size < len(pattern) and follows[i + size - 1]
                and free_text[i + size] and free_item[j + size] and text[i + size] == pattern[j + size]
            ):
                size += 1
            reached[i - j] = i + size
            out.append((size, i, j))
    return out


def item_grams(benchmark: DataFrame, k: int) -> DataFrame:
    """``item_id, item_words, grams`` of every item with k words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, hashes, doc, _, n in token_grams(tx.texts_of(batch.column(1)), k):
                offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=end - first)))).astype(np.int32)
                grams = pa.ListArray.from_arrays(offsets, tx.signed(hashes))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(n.astype(np.int64)), grams], names=["item_id", "item_words", "grams"])

    ready = benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return ready.mapInArrow(run, "item_id long, item_words long, grams array<long>").where(F.size("grams") > 0)


def seed_hits(docs: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """``doc_id, places, hits``: where a document's k words are a seed, in order of place.

    A checked number of seeds goes to the tasks as one sorted array; beyond that, all
    k-word hashes of the documents are joined with them. Both give the same rows.
    """
    spark = docs.sparkSession
    small = seeds.count() <= SENT_SEEDS
    table = np.sort(np.asarray(seeds.toArrow()["gram"])) if small else np.zeros(0, np.int64)
    sent = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for first, end, hashes, doc, place, _ in token_grams(tx.texts_of(batch.column(1)), k):
                grams = tx.signed(hashes)
                if small:
                    at = np.searchsorted(known, grams)
                    at[at == len(known)] = 0
                    good = np.flatnonzero(known[at] == grams) if len(known) else np.zeros(0, int)
                    grams, doc, place = grams[good], doc[good], place[good]
                own, counts = np.unique(doc, return_counts=True)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + own)), pa.ListArray.from_arrays(offsets, place.astype(np.int64)), pa.ListArray.from_arrays(offsets, grams)],
                    names=["doc_id", "places", "hits"],
                )

    ready = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = ready.mapInArrow(run, "doc_id long, places array<long>, hits array<long>")
    if small:
        return rows
    flat = rows.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", F.explode(F.arrays_zip("places", "hits")).alias("x"))
    kept = flat.select("doc_id", "row", "x.places", F.col("x.hits").alias("gram")).join(seeds, "gram", "left_semi")
    again = kept.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("places", "gram"))).alias("x"))
    return again.select("doc_id", F.col("x.places").alias("places"), F.col("x.gram").alias("hits"))


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = TILE, cover: float = COVER) -> DataFrame:
    """Pairs of ``docs(doc_id, text)`` and ``benchmark(item_id, text)`` with too much in common.

    A pair is reported if tiles of ``k`` words or more, in any order, cover at least the share
    ``cover`` of the item's words. Returns ``doc_id, item_id, item_words, covered, coverage, n_tiles,
    tiles`` with the tiles as ``(doc_word, item_word, words)``. Seeds are joined first; a pair goes
    on only if its seeds could reach that share at all. NULL and empty texts, items of under ``k``
    words and rows without id give no pair; of rows that repeat a ``doc_id`` the best match counts.
    """
    return settled(docs.sparkSession, "contaminated", lambda: _contaminated(docs, benchmark, k, cover))


def _contaminated(docs: DataFrame, benchmark: DataFrame, k: int, cover: float) -> DataFrame:
    items = stored(item_grams(benchmark, k), "items")
    seeds = items.select("item_id", "item_words", F.explode("grams").alias("gram"))
    hits = stored(seed_hits(docs, stored(seeds.select("gram").distinct(), "seeds"), k).withColumn("row", F.monotonically_increasing_id()), "hits")
    wanted = hits.select("row", F.explode(F.array_distinct("hits")).alias("gram"))
    per_item = seeds.groupBy("gram", "item_id", "item_words").agg(F.count("*").alias("n"))
    pairs = wanted.join(per_item, "gram").groupBy("row", "item_id", "item_words").agg(F.sum("n").alias("n"))
    pairs = pairs.where(F.col("n") * k >= F.col("item_words") * cover).select("row", "item_id")
    ready = pairs.join(hits, "row").join(items, "item_id").select("doc_id", "item_id", "item_words", "places", "hits", "grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles = []
            for places, hits_, grams in zip(*(batch.column(c).to_pylist() for c in ("places", "hits", "grams"))):
                tiles.append([{"doc_word": a, "item_word": b, "words": n} for a, b, n in greedy_tiles(np.array(places), np.array(hits_), np.array(grams), k)])
            covered = pa.array([sum(t["words"] for t in x) for x in tiles], pa.int64())
            kind = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "item_id", "item_words")), covered, pa.array(tiles, kind)], names=["doc_id", "item_id", "item_words", "covered", "tiles"])

    tiled = ready.mapInArrow(run, "doc_id long, item_id long, item_words long, covered long, tiles array<struct<doc_word: long, item_word: long, words: long>>")
    found = tiled.where(F.col("covered") >= F.col("item_words") * cover)
    best = found.groupBy("doc_id", "item_id", "item_words").agg(F.max(F.struct("covered", "tiles")).alias("best"))
    return best.select(
        "doc_id", "item_id", "item_words", "best.covered", (F.col("best.covered") / F.col("item_words")).alias("coverage"),
        F.size("best.tiles").cast("long").alias("n_tiles"), "best.tiles",
    )
