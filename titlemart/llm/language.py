"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemart.llm import text as tx

ORDER = 4
SYMBOL_BITS = 6  # 64 symbols, so there are at most 2^24 grams at any size of the input
SYMBOLS = 1 << SYMBOL_BITS
DISCOUNT = 0.75
SHARPNESSES = (0.125, 0.25, 0.5, 1.0, 2.0, 4.0)
FINE = 1 << 30  # losses and entropies are summed as whole numbers of 1/FINE nat, so that the order of rows is of no account
BATCH_SYMBOLS = 1 << 20


@cache
def symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1-26 for a-z, 27-63 shared by the other letters."""
    table = np.zeros(0x110000, np.uint8)
    points = np.arange(0x110000, dtype=np.uint64)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    table[letter] = (27 + (points * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(SYMBOLS - 27))[letter]
    table[97:123] = np.arange(1, 27)
    return table


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the last ORDER symbols at each symbol, texts end to end, and their bounds.

    Texts are lower-cased; other characters than letters count as one blank per run; a
    text begins after blanks.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum([0, *map(len, lowered)])
    symbols = symbol_table()[points].astype(np.uint32)
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    first = bounds[:-1][np.diff(bounds) > 0]
    keep[first] = symbols[first] > 0  # a text begins after blanks, whatever ends the one before
    running = np.concatenate(([0], np.cumsum(keep)))
    symbols, bounds = symbols[keep], running[bounds]
    codes = symbols.copy()
    place = np.arange(len(symbols)) - np.repeat(bounds[:-1], np.diff(bounds))
    for back in range(1, ORDER):
        part = np.zeros_like(symbols)
        part[back:] = symbols[:-back] << np.uint32(SYMBOL_BITS * back)
        part[place < back] = 0
        codes |= part
    return codes, bounds


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_SYMBOLS or i + 1 == len(texts):
            yield first, i + 1
            first, size = i + 1, 0


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all of ``docs(lang, text)``, counted per task before the shuffle."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs) if x == lang and t]
                for a, b in _slices(own):
                    parts = seen.setdefault(lang, [])
                    parts.append(np.unique(grams_of(own[a:b])[0], return_counts=True))
                    if len(parts) > 16:
                        seen[lang] = [merged(parts)]
        for lang, parts in seen.items():
            grams, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Models:
    """All languages' models over one sorted array of gram codes.

    ``seen`` has a row per gram and a column per language of interpolated log
    probabilities; for other grams, ``back`` (log weight of the context of ORDER - 1
    symbols) and ``lower`` (log probability one order down) are added.
    """

    langs: list[str]
    grams: np.ndarray
    seen: np.ndarray
    back: np.ndarray
    lower: np.ndarray
    sharpness: float = 1.0
    limits: np.ndarray | None = None

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol under each language, and symbols of each text."""
        codes, bounds = grams_of(texts)
        n = np.diff(bounds)
        out = np.zeros((len(texts), len(self.langs)))
        if not len(codes) or not self.langs:
            return out, n
        at = np.searchsorted(self.grams, codes)
        at[at == len(self.grams)] = 0
        values = self.seen[at]
        new = np.flatnonzero(self.grams[at] != codes)
        values[new] = self.back[codes[new] >> SYMBOL_BITS] + self.lower[codes[new] & np.uint32(SYMBOLS ** (ORDER - 1) - 1)]
        full = np.flatnonzero(n)
        out[full] = -np.add.reduceat(values, bounds[:-1][full], axis=0, dtype=np.float64) / n[full, None]
        return out, n

    def confidence(self, entropy: np.ndarray, n: np.ndarray, sharpness: float | None = None) -> np.ndarray:
        x = -entropy * ((self.sharpness if sharpness is None else sharpness) * np.sqrt(n))[:, None]
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)


def build_models(counts: pa.Table) -> Models:
    """Interpolated Kneser-Ney models of the languages in ``counts(lang, gram, n)``."""
    langs = sorted(set(counts["lang"].to_pylist()))
    lang = np.searchsorted(np.array(langs), np.array(counts["lang"].to_pylist())) if langs else np.zeros(0, int)
    gram, n = np.asarray(counts["gram"]).astype(np.int64), np.asarray(counts["n"]).astype(np.float64)
    union = np.unique(gram)
    contexts = SYMBOLS ** (ORDER - 1)
    seen = np.zeros((len(union), len(langs)), np.float32)
    back = np.zeros((contexts, len(langs)), np.float32)
    lower = np.zeros((contexts, len(langs)), np.float32)
    for j in range(len(langs)):
        own, c = gram[lang == j], n[lang == j]
        # probabilities of the lower orders from continuation counts, dense
        p = np.full(SYMBOLS, 1 / SYMBOLS)
        for order in range(1, ORDER):
            kinds = np.unique(own & (SYMBOLS ** (order + 1) - 1))
            follow = np.bincount(kinds & (SYMBOLS**order - 1), minlength=SYMBOLS**order).reshape(-1, SYMBOLS).astype(float)
            total, types = follow.sum(axis=1, keepdims=True), (follow > 0).sum(axis=1, keepdims=True)
            weight = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1.0)
            shorter = p.reshape(1, -1) if order == 1 else p.reshape(-1, SYMBOLS)[np.arange(SYMBOLS ** (order - 1)) % SYMBOLS ** max(order - 2, 0)]
            p = (np.maximum(follow - DISCOUNT, 0) / np.maximum(total, 1) + weight * shorter).ravel()
        total = np.bincount(own >> SYMBOL_BITS, c, contexts)
        types = np.bincount(own >> SYMBOL_BITS, minlength=contexts)
        weight = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1.0)
        found = np.zeros(len(union))
        found[np.searchsorted(union, own)] = np.maximum(c - DISCOUNT, 0)
        context, tail = union >> SYMBOL_BITS, union & (contexts - 1)
        seen[:, j] = np.log(found / np.maximum(total[context], 1) + weight[context] * p[tail])
        back[:, j], lower[:, j] = np.log(weight), np.log(p)
    return Models(langs, union.astype(np.uint32), seen, back, lower)


def tally(models: Models, texts: list[str], langs: list[str]) -> np.ndarray:
    """Row per language of what ``calibrate`` needs: texts with a letter, entropy, its square, loss by sharpness."""
    out = np.zeros((len(models.langs), 3 + len(SHARPNESSES)), np.int64)
    entropy, n = models.entropies(texts)
    use = n > 0
    entropy, n, truth = entropy[use], n[use], np.searchsorted(np.array(models.langs), np.array(langs, str)[use])
    row = np.arange(len(n))
    own = entropy[row, truth]
    values = [np.ones(len(n)), own * FINE, own * own * FINE]
    for sharpness in SHARPNESSES:
        values.append(-np.log(np.maximum(models.confidence(entropy, n, sharpness)[row, truth], 1e-6)) * FINE)
    np.add.at(out, truth, np.rint(np.stack(values, axis=1)).astype(np.int64))
    return out


def calibrate(models: Models, tallies: np.ndarray) -> None:
    """Sharpness of the confidence and each language's entropy limit, from the sums of ``tally`` over labelled texts."""
    models.limits = np.full(len(models.langs), np.inf)
    losses = tallies[:, 3:].sum(axis=0)
    if not tallies[:, 0].any():
        return
    models.sharpness = SHARPNESSES[int(losses.argmin())]
    for j, (count, total, squares) in enumerate(tallies[:, :3]):
        if count > 1:
            mean = total / FINE / count
            models.limits[j] = mean + 4 * np.sqrt(max(squares / FINE / count - mean * mean, 0.0))


def fit_languages(docs: DataFrame) -> Models:
    """Models of every language in ``docs(lang, text)``, counted and calibrated on all rows.

    What reaches the driver is one count per gram and language, at most 2^24 grams at any
    size of the corpus, and one row of sums per language.
    """
    labelled = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    labelled = labelled.where("lang is not null and text is not null")
    models = build_models(gram_counts(labelled).toArrow())
    sent = docs.sparkSession.sparkContext.broadcast(models)
    width = 3 + len(SHARPNESSES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        total = np.zeros((len(m.langs), width), np.int64)
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _slices(texts):
                total += tally(m, texts[a:b], langs[a:b])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(m.langs)), pa.int32()), *[pa.array(c) for c in total.T]], names=["lang", *names])

    names = [f"s{i}" for i in range(width)]
    summed = labelled.mapInArrow(run, "lang int, " + ", ".join(f"{c} long" for c in names)).groupBy("lang").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names])
    tallies = np.zeros((len(models.langs), width))
    for lang, *sums in summed.collect():
        tallies[lang] = [float(x) for x in sums]
    calibrate(models, tallies)
    return models


def predict_languages(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` of every row of ``docs(doc_id, text)``.

    The language with the lowest cross-entropy per symbol; ``und`` with score 0 for NULL
    text and text without a letter, and where nothing was learnt. ``rejected`` tells that the
    entropy is over the limit calibrated for that language, so that it is likely none of
    those known. Ties go to the first language by name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array([*m.langs, "und"], object)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                entropy, n = m.entropies(texts[a:b])
                some = (n > 0) & (len(m.langs) > 0)
                best = np.where(some, entropy.argmin(axis=1) if m.langs else 0, len(m.langs))
                score, least = np.zeros(b - a), np.full(b - a, np.nan)
                if some.any():
                    score[some] = m.confidence(entropy[some], n[some]).max(axis=1)
                    least[some] = entropy[some].min(axis=1)
                limit = np.append(m.limits, -np.inf)[best]
                rejected = ~some | (np.nan_to_num(least) > limit)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(least, mask=~some), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ready.mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
