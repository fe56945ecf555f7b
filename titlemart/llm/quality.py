"""Quality scores: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.llm import text as tx

FIT_ROWS = 20_000  # labelled documents that the trees are fitted on, at most
TREES, DEPTH, BINS, RATE, RIDGE = 60, 4, 64, 0.2, 1.0
LEAST_HESSIAN = 1.0

STATISTICS = (
    "bytes words lines upper lower digit space symbol bang pipe stop comma high "
    "word_bytes longest_word distinct_words distinct_pairs top_word long_words short_words "
    "distinct_lines line_words symbol_ends upper_starts"
).split()


def _classes() -> np.ndarray:
    """Class of every byte: upper, lower, digit, space, symbol, bang, pipe, stop, comma, high, other."""
    table = np.full(256, 10, np.uint8)
    for i, chars in enumerate((range(65, 91), range(97, 123), range(48, 58), tx.WHITE, b"#$%&*@^~<>=+_{}[]\\/", b"!?", b"|", b".", b",;:", range(128, 256))):
        table[list(chars)] = i
    return table


CLASSES = _classes()


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per document of a block; shares are of bytes or of words."""
    docs = len(starts) - 1
    sizes = np.diff(starts) - 1
    begin, end, hashes, bounds = tx.words(data, starts)
    n_words = np.diff(bounds)
    out = np.zeros((docs, len(STATISTICS)))
    per_byte = np.maximum(sizes, 1)
    out[:, 0], out[:, 1] = np.log1p(sizes), np.log1p(n_words)
    cell = np.repeat(np.arange(0, docs * 11, 11), np.diff(starts)) + CLASSES[data]
    counted = np.bincount(cell, minlength=docs * 11).reshape(docs, 11)
    counted[:, 3] -= 1  # the newline that closes a document is not its own
    out[:, 3:13] = counted[:, :10] / per_byte[:, None]
    newline = np.concatenate(([0], np.cumsum(data == 10, dtype=np.int32)))
    out[:, 2] = np.log1p(newline[starts[1:] - 1] - newline[starts[:-1]])
    length = end - begin
    symbol_end = (CLASSES[data[end - 1]] == 4) | (CLASSES[data[end - 1]] == 5)
    upper_start = CLASSES[data[begin]] == 0
    pairs = tx.mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
    line_of = newline[begin]
    for i in range(docs):
        a, b = bounds[i], bounds[i + 1]
        n = b - a
        if not n:
            continue
        own = length[a:b]
        counts = np.unique(hashes[a:b], return_counts=True)[1]
        lines = np.flatnonzero(np.diff(line_of[a:b], prepend=-1))
        sums = np.add.reduceat(hashes[a:b], lines)
        out[i, 13:] = (
            own.mean(),
            np.log1p(own.max()),
            len(counts) / n,
            len(np.unique(pairs[a : b - 1])) / max(n - 1, 1),
            counts.max() / n,
            (own > 12).mean(),
            (own < 3).mean(),
            len(np.unique(sums)) / len(lines),
            np.log1p(n / len(lines)),
            symbol_end[a:b].mean(),
            upper_start[a:b].mean(),
        )
    return out


@dataclass
class Trees:
    """Complete binary trees flattened into arrays: row t, node i has children 2i+1 and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, all rows and all trees level by level."""
        total = np.full(len(x), self.prior)
        if len(self.feature):
            tree = np.arange(len(self.feature))
            node = np.zeros((len(x), len(tree)), np.int64)
            row = np.arange(len(x))[:, None]
            for _ in range(DEPTH):
                right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total += self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted logistic trees; splits are found on histograms of BINS quantile bins.

    Without rows the score is 0.5; with one class only, the smoothed share of label 1.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    inner = 2**DEPTH - 1
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), prior)
    wide = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(wide)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(wide)], axis=1)
    score = np.full(len(y), prior)
    features, thresholds, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * wide + np.arange(wide)) * BINS + binned
            shape = (width, wide, BINS)
            g, h = (np.bincount(slot.ravel(), np.repeat(v, wide), width * wide * BINS).reshape(shape).cumsum(axis=2) for v in (gradient, hessian))
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(h < LEAST_HESSIAN) | (h_all - h < LEAST_HESSIAN)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for i, (at, most) in enumerate(zip(best, gain.reshape(width, -1).max(axis=1))):
                j, b = divmod(int(at), BINS)
                if most > 1e-9 and b < len(edges[j]):
                    feature[first + i], threshold[first + i] = j, edges[j][b]
            right = x[np.arange(len(y)), feature[node]] > threshold[node]
            node = 2 * node + 1 + right
        at = node - inner
        value = RATE * np.bincount(at, gradient, inner + 1) / (np.bincount(at, hessian, inner + 1) + RIDGE)
        score += value[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), prior)


def held_out(doc_id, folds: int = 5, fold: int = 0):
    """Whether crc32 of the id as text falls into the fold that nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame) -> Trees:
    """Trees fitted on up to FIT_ROWS labelled documents, those whose ids hash lowest.

    Only text enters; documents held out, without id, or with contradicting or NULL labels
    are not learnt from.
    """
    usable = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).select("doc_id", "quality")
    both = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, starts in tx.blocks(tx.texts_of(batch.column(1))):
                x = statistics(data, starts)
                rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), batch.column(2).slice(first, end - first).cast(pa.int32()), rows], names=["doc_id", "quality", "x"])

    sample = both.select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, quality int, x array<double>")
    table = sample.orderBy("doc_id").limit(FIT_ROWS).toArrow()
    x = np.array(table["x"].to_pylist(), float).reshape(-1, len(STATISTICS))
    return fit_trees(x, np.array(table["quality"].to_pylist(), float))


def score_quality(docs: DataFrame, trees: Trees, least: float = 0.3) -> DataFrame:
    """``row`` (all columns of ``docs``), ``score`` and ``predicted`` (1 if the score is ``least`` or more).

    Rows come back whole and in their own struct, so no column name can clash. NULL and
    empty texts are scored like any other, by their statistics.
    """
    carried = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [trees.score(statistics(data, starts)) for _, _, data, starts in tx.blocks(tx.texts_of(batch.column(1)))]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= least).astype(np.int32))], names=["row", "score", "predicted"])

    out = T.StructType([carried.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return carried.mapInArrow(run, out)
