"""Near-duplicates by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.llm import text as tx
from titlemart.llm.tables import components, settled, stored

COORDINATES = 256  # of the sketch that is banded; a power of two
ROWS, BANDS = 5, 40
FINE = 1024  # coordinates, a byte each, by which members of a bucket are compared
NEAR, ROUGHLY = 4.5, 6.0  # standard errors below the threshold at which the fine sketch and its first COORDINATES drop a pair
LANE = 512  # bucket members that one task compares with as many others

SENT_IDS = 1_000_000  # of nodes in shared buckets that are sent to the tasks; beyond, their texts are joined by shuffle

PROFILE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("s1", T.LongType()),
        T.StructField("s2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def shingle_sets(texts: list[bytes], k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Sorted distinct hashes of the k-word shingles, documents end to end: ``(first, end, hashes, bounds)``.

    A-Z count as a-z. A text of fewer than k words has one shingle, its whole word
    sequence; one without words has none.
    """
    for first, end, data, starts in tx.blocks(texts):
        _, _, hashes, bounds = tx.words(tx.LOWER[data], starts)
        sums = tx.prefix_hash(hashes)
        n = np.diff(bounds)
        sets = []
        for lo, m in zip(bounds[:-1], n):
            at = np.arange(lo, lo + max(m - k + 1, min(m, 1)))
            sets.append(np.unique(tx.span_hash(sums, at, at + min(k, m))))
        sizes = np.cumsum([0, *map(len, sets)])
        yield first, end, np.concatenate(sets), sizes


def sketches(hashes: np.ndarray, bounds: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """One row of t values per document; empty sets keep the largest value.

    In round r every element falls into a hashed bin with the value (r, hash); from
    round t on, all elements fall into one bin per round. A bin keeps its minimum. Rounds
    end, document by document, once all bins are filled, so after 2t rounds at the
    latest every coordinate is.
    """
    docs = len(bounds) - 1
    out = np.full(docs * t, np.iinfo(np.uint64).max, np.uint64)
    doc = tx.owner(bounds, len(hashes))
    for r in range(2 * t):
        if not len(hashes):
            break
        x = tx.mix(hashes + np.uint64((r + 1) * tx.BASE % (1 << 64)))
        slot = (x & np.uint64(t - 1)).astype(np.int64) if r < t else r - t
        np.minimum.at(out, doc * t + slot, (x >> np.uint64(16)) | np.uint64(r << 48))
        open_ = (out.reshape(docs, t) == np.iinfo(np.uint64).max).any(axis=1)[doc]
        if not open_.all():
            hashes, doc = hashes[open_], doc[open_]
    return out.reshape(docs, t)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    used = sketch[:, : ROWS * BANDS].reshape(len(sketch), BANDS, ROWS)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sketch), 1))
    for i in range(ROWS):
        keys = tx.mix(keys * np.uint64(tx.BASE) + used[:, :, i])
    return keys


def _signature(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share."""
    sums = []
    for salt in (0x1234567, 0x89ABCDEF):
        run = np.concatenate(([np.uint64(0)], np.cumsum(tx.mix(hashes ^ np.uint64(salt)), dtype=np.uint64)))
        sums.append(tx.signed(run[bounds[1:]] - run[bounds[:-1]]))
    return sums[0], sums[1]


def profiles(docs: DataFrame, k: int) -> DataFrame:
    """Set size, 128-bit set signature and band keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, hashes, bounds in shingle_sets(tx.texts_of(batch.column(1)), k):
                s1, s2 = _signature(hashes, bounds)
                keys = tx.signed(band_keys(sketches(hashes, bounds)))
                offsets = np.arange(0, (end - first + 1) * BANDS, BANDS, dtype=np.int32)
                bands = pa.ListArray.from_arrays(offsets, keys.reshape(-1))
                size = np.diff(bounds).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids.slice(first, end - first), pa.array(size), pa.array(s1), pa.array(s2), bands], names=PROFILE.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PROFILE)


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Signature, sorted shingle hashes, band keys and fine sketch (one byte a value) of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, hashes, bounds in shingle_sets(tx.texts_of(batch.column(1)), k):
                s1, s2 = _signature(hashes, bounds)
                bands = band_keys(sketches(hashes, bounds))
                fine = tx.mix(sketches(hashes, bounds, FINE)).astype(np.uint8)
                sets = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(s1), pa.array(s2), *(tx.binary_list(x) for x in (sets, [r.tobytes() for r in bands], [r.tobytes() for r in fine]))],
                    names=["node", "s1", "s2", "hashes", "bands", "fine"],
                )

    return docs.mapInArrow(run, "node long, s1 long, s2 long, hashes binary, bands binary, fine binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = 0
                if 100 * len(x) >= percent * len(y):
                    at = np.searchsorted(y, x)
                    at[at == len(y)] = 0
                    both = int((y[at] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = sets.select("node", "hashes")
    both = (
        pairs.join(side.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
        .join(side.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return both.mapInArrow(run, "a long, b long")


def _near_pairs(lanes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket that lie in different components and whose sketches are near.

    Each group is two lanes of at most about LANE rows, or one lane with itself. A pair
    that shares several buckets comes from the first of them only, by its band keys.
    """
    want = percent / 100
    least = (want - NEAR * (want * (1 - want) / FINE) ** 0.5) * FINE
    roughly = (want - ROUGHLY * (want * (1 - want) / COORDINATES) ** 0.5) * COORDINATES

    def run(key, table):
        lane = np.asarray(table["lane"])
        left, right = (np.flatnonzero(lane == key[i].as_py()) for i in (1, 2))
        node, group, band = (np.asarray(table[c]) for c in ("node", "component", "band"))
        size = np.asarray(table["n"])
        bands = np.frombuffer(b"".join(table["bands"].to_pylist()), np.uint64).reshape(len(node), BANDS)
        fine = np.frombuffer(b"".join(table["fine"].to_pylist()), np.uint8).reshape(len(node), FINE)
        out_a, out_b = [], []
        for i in left:
            js = right if key[1] != key[2] else right[node[right] > node[i]]
            js = js[(group[js] != group[i]) & (100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i]))]
            js = js[np.count_nonzero(fine[js, :COORDINATES] == fine[i, :COORDINATES], axis=1) >= roughly]
            js = js[(bands[js] == bands[i]).argmax(axis=1) == band[i]]
            js = js[np.count_nonzero(fine[js] == fine[i], axis=1) >= least]
            out_a.append(np.minimum(node[js], node[i]))
            out_b.append(np.maximum(node[js], node[i]))
        none = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(out_a or none), "b": np.concatenate(out_b or none)})

    return lanes.groupBy("key", "lane_a", "lane_b").applyInArrow(run, "a long, b long")


def _in_lanes(placed: DataFrame) -> DataFrame:
    """Members ``key, node, component, ...`` of buckets with several components, once per pair of lanes they are compared in.

    The members of a bucket's largest component have lanes of their own, compared with those of the others only, never
    with each other: m members beside r others make (m + r) * ceil(r / LANE) + r * ceil(m / LANE) rows.
    """
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("m"))
    most = F.max(F.struct("m", (-F.col("component")).alias("c")))
    apart = sizes.groupBy("key").agg(most.alias("most"), F.sum("m").alias("all"), F.count("*").alias("kinds")).where("kinds > 1")
    lanes_of = lambda n: F.ceil(n / LANE).cast("int")
    apart = apart.select("key", (-F.col("most.c")).alias("largest"), lanes_of(F.col("most.m")).alias("own"), lanes_of(F.col("all") - F.col("most.m")).alias("others"))
    own = F.col("component") == F.col("largest")
    lane = F.when(own, F.pmod(F.xxhash64("node"), F.col("own"))).otherwise(F.col("own") + F.pmod(F.xxhash64("node"), F.col("others")))
    rows = placed.join(apart, "key").withColumn("lane", lane.cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.when(own, F.col("own")).otherwise(F.lit(0)), F.col("own") + F.col("others") - 1)))
    return rows.select(*placed.columns, "lane", F.least("lane", "other").alias("lane_a"), F.greatest("lane", "other").alias("lane_b"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Classes of near-equal texts of ``docs(doc_id, text)``.

    Two documents are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets of
    distinct k-word shingles. Returns ``doc_id, n_shingles, component_id, kept`` for
    every row: the component is the smallest ``doc_id`` reachable over links.

    Documents with equal sets are one node. Nodes are sketched (256 coordinates) and put
    into 40 band buckets of 5 coordinates: a pair at the threshold of 0.8 misses all of
    them once in 8 million, and more alike pairs less often. Then
    1. in each bucket, all members are verified against the most central one (whose
       buckets are largest in sum), which joins groups of copies with few pairs;
    2. members of a bucket that are still in different components are compared by
       finer sketches (1024 coordinates), in lanes of 512 (the largest component's with the others' only), and those less than 4.5 standard
       errors below the threshold are verified on their full sets. No pair of a bucket goes
       unexamined; one at the threshold is dropped here three times in a million.

    NULL text and texts without words have an empty set and no links. Rows without
    ``doc_id`` are returned with their size, without component, and kept. Rows that repeat a
    ``doc_id`` with another text share its node, which has the links of each of its texts.
    """
    return settled(docs.sparkSession, "near-duplicates", lambda: _near_duplicates(docs, k, percent))


def _near_duplicates(docs: DataFrame, k: int, percent: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = stored(profiles(docs, k), "profiles")
    leaders = base.where("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    own = F.col("doc_id") == F.col("node")
    members = stored(
        base.where("n > 0").join(leaders, ["s1", "s2"], "left").select("doc_id", "n", "s1", "s2", "node", F.when(own, F.col("bands")).alias("bands")),
        "members",
    )
    nodes = members.where("bands is not null")
    rows = nodes.select("node", "n", F.posexplode("bands").alias("band", "key")).distinct()
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(rows.join(sizes, "key"), "buckets")
    central = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    shared = stored(shared.join(central, "node"), "weighted")
    heads = shared.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("head")).select("key", F.col("head.node").alias("head"))
    stars = stored(
        shared.join(heads, "key").where("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct(),
        "stars",
    )
    wanted = shared.select(F.col("node").alias("doc_id")).distinct()
    known = nodes.select("node", "s1", "s2")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted
    sets = stored(_sets(docs.join(wanted, "doc_id", "left_semi"), k).join(known, ["node", "s1", "s2"], "left_semi").dropDuplicates(["node", "s1", "s2"]), "sets")
    links = stored(_verified(stars, sets, percent), "links")
    first = stored(components(links), "components")

    # what the stars left apart
    placed = shared.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lanes = _in_lanes(placed.select("key", "band", "node", "n", "component")).join(sets.select("node", "bands", "fine"), "node")
    near = stored(_near_pairs(lanes, percent), "near")
    more = stored(_verified(near, sets, percent), "more-links")
    final = components(links.union(more))
    placed_docs = members.select("doc_id", "n", "s1", "s2", "node").join(final, "node", "left")
    full = placed_docs.select("doc_id", "n", F.coalesce("component", "node").alias("component_id"))
    empty = base.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.union(empty).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
