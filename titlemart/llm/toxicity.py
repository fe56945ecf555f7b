"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.llm.quality import held_out
from titlemart.llm.tables import stored

FIT_ROWS = 20_000  # labelled documents that the lexicon and its calibration are learnt from, at most
ENTRIES = 4_096  # of the lexicon, and as many exceptions, at most
SHORTEST, LONGEST = 3, 8  # letters of a stem; whole words have any length
SUPPORT = 3  # toxic documents that hold an entry, and at least a hundredth of them
WEIGHT = 1.0  # least log ratio of an entry's shares of toxic and of clean documents
STRONG = 3.0
HELD = 200_000  # candidates a task counts before it passes them on

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ɪ": "i", "ʀ": "r", "ꞵ": "b", "ո": "n", "օ": "o",
}
# Digits and signs that stand for letters inside words.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = "­​‌‍⁠﻿"

_LOOKS = str.maketrans(HOMOGLYPHS | dict.fromkeys(INVISIBLE, ""))
_SIGNS = str.maketrans(SUBSTITUTES)
_LOOK = re.compile(f"[{''.join(HOMOGLYPHS)}{INVISIBLE}]")
_SIGN = re.compile(f"[{re.escape(''.join(SUBSTITUTES))}]+")
_GAP = re.compile(r"[\W\d_]+")


def _letters(match: re.Match) -> str:
    """A run of signs as letters, if it begins or ends a word or lies within one."""
    run, text = match.group(), match.string
    before = match.start() > 0 and text[match.start() - 1].isalpha()
    after = match.end() < len(text) and text[match.end()].isalpha()
    if after and (before or run[0] not in "!|") or before and run.isdigit():
        return run.translate(_SIGNS)
    return run


def fold(text: str) -> str:
    """Lower-case words of ``text``, each between two blanks of its own, disguises undone.

    Compatibility forms, homoglyphs and invisible characters first, then signs that stand for
    letters; l counts as i, as 1 stands for both. Accents stay. Anything but letters parts words.
    """
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low)
        if _LOOK.search(low):
            low = low.translate(_LOOKS)
    words = _GAP.sub("  ", _SIGN.sub(_letters, low)).replace("l", "i").strip()
    return f" {words} " if words else ""


def _plain(words: str) -> str:
    """Folded words without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", words) if not unicodedata.combining(c))


def candidates(words: list[str]) -> set[str]:
    """Whole words and stems that begin one, a blank marking the border."""
    found = set()
    for word in set(words):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return found


@dataclass
class Lexicon:
    """Weights of entries and, at 0, of exceptions; scores are calibrated on five numbers of a text."""

    weights: dict[str, float]
    bias: float = 0.0
    slope: np.ndarray = field(default_factory=lambda: np.zeros(5))
    _finder: ahocorasick.Automaton | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_finder": None}

    def matches(self, folded: str) -> Iterator[tuple[int, str, float]]:
        """Leftmost, then longest entries and exceptions: ``(end, entry, weight)``, none overlapping."""
        if not self.weights:
            return
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._finder.add_word(entry, (entry, weight))
            self._finder.make_automaton()
        for end, (entry, weight) in self._finder.iter_long(folded):
            yield end, entry, weight

    def numbers(self, text: str | None) -> list[float]:
        """Weight and strong matches, each in all and per hundred words, and different strong entries."""
        folded = fold(text or "")
        if not folded:
            return [0.0] * 5
        found = [(entry, weight) for _, entry, weight in self.matches(folded) if weight]
        if not folded.isascii():  # accents put on a word of the lexicon
            marked = [w for w in folded.split() if not w.isascii()]
            bare = ((f" {_plain(w)} ", f" {w} ") for w in marked)
            found += [(b, self.weights[b]) for b, own in bare if b != own and self.weights.get(b) and own not in self.weights]
        size = folded.count("  ") + 1
        strong = [entry for entry, weight in found if weight >= STRONG]
        total = sum(weight for _, weight in found)
        return [math.log1p(x) for x in (total, 100 * total / size, len(strong), 100 * len(strong) / size, len(set(strong)))]

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        x = np.array([self.numbers(t) for t in texts]).reshape(-1, 5)
        return 1 / (1 + np.exp(-np.clip(x @ self.slope + self.bias, -60, 60)))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> tuple[float, np.ndarray]:
    """Bias and slopes of a logistic curve by Newton's method; with one class only, its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = math.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return bias, np.zeros(x.shape[1])
    design = np.column_stack([np.ones(len(y)), x])
    beta = np.zeros(design.shape[1])
    keep = np.diag([1e-6, *[ridge] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - keep @ beta
        step = np.linalg.solve((design.T * (p * (1 - p))) @ design + keep, gradient)
        beta += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), beta[1:]


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, half`` of up to FIT_ROWS labelled documents, those whose ids hash lowest, stored."""
    usable = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    agreed = usable.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["text", "toxic"])
    return stored(both.select("text", "toxic", F.pmod(F.xxhash64("text"), F.lit(2)).alias("half")), "labelled")


def _counted(sample: DataFrame, find) -> DataFrame:
    """``entry, toxic, clean``: documents of either kind for which ``find(folded text)`` names an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def passed_on() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            rows = [names, [counts[1][n] for n in names], [counts[0][n] for n in names]]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *(pa.array(r, pa.int64()) for r in rows[1:])], names=["entry", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[int(toxic == 1)].update(find(fold(text)))
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield passed_on()
        yield passed_on()

    parts = sample.select("text", "toxic").mapInArrow(run, "entry string, toxic long, clean long")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _ratio(toxic: int, clean: int):
    """Log of an entry's share of the toxic documents over its share of the clean ones."""
    return F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))


def _closed(rows: list) -> dict[str, float]:
    """Weights by entry; of a stem and its longer forms in the same documents, the longest stays."""
    weights: dict[str, float] = {}
    counts: dict[str, tuple] = {}
    for r in sorted(rows, key=lambda r: (-len(r["entry"]), r["entry"])):
        counts[r["entry"]] = (r["toxic"], r["clean"])
        weights[r["entry"]] = float(r["weight"])
    for entry, own in counts.items():
        for n in range(SHORTEST + 1, len(entry)):
            if counts.get(entry[:n]) == own:
                weights.pop(entry[:n], None)
    return weights


def fit_toxicity(docs: DataFrame, labels: DataFrame, exceptions: Iterable[str] = ()) -> Lexicon:
    """A lexicon learnt from ``docs(doc_id, text)`` by ``labels(doc_id, toxic)``.

    One half of the sample gives the entries: words and stems found in a share of the toxic
    documents several times their share of the clean ones; the log of that ratio is the weight. Words that such
    a stem begins, and pairs of neighbouring words with a match in one, are exceptions where they
    occur in clean documents and relatively less in toxic ones; phrases in ``exceptions`` are so too. The
    other half fits the scores. Only text enters, never language or source; documents held out,
    without id, or with contradicting or NULL labels are not learnt from. Without labels there are no
    entries and every score is 0.5.
    """
    sample = _labelled(docs, labels)
    words = sample.where("half = 0")
    n = words.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") != 1).alias("clean")).first()
    least = max(SUPPORT, math.ceil(0.01 * n["toxic"]))
    rated = _counted(words, lambda t: candidates(t.split())).withColumn("weight", _ratio(n["toxic"], n["clean"]))
    best = rated.where((F.col("toxic") >= least) & (F.col("weight") >= WEIGHT)).orderBy((F.col("weight") * F.col("toxic")).desc(), "entry")
    entries = Lexicon(_closed(best.limit(ENTRIES).collect()))

    def around(folded: str) -> set[str]:
        """Words and pairs of words that hold a match."""
        tokens, found = folded.split(), set()
        ends = np.cumsum([len(w) + 2 for w in tokens])
        for end, _, _ in entries.matches(folded):
            i = int(np.searchsorted(ends, end, "left"))
            found.add(f" {tokens[i]} ")
            found.update(f" {a}  {b} " for a, b in zip(tokens[max(i - 1, 0) : i + 1], tokens[max(i, 1) : i + 2]))
        return found

    near = _counted(words, around).withColumn("weight", _ratio(n["toxic"], n["clean"]))
    harmless = near.where((F.col("clean") >= SUPPORT) & (F.col("weight") < 0)).orderBy(F.col("clean").desc(), "entry").limit(ENTRIES)
    given = {fold(phrase) for phrase in exceptions} - {""}
    lexicon = Lexicon(entries.weights | {r["entry"]: 0.0 for r in harmless.collect()} | dict.fromkeys(given, 0.0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([lexicon.numbers(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, batch.column(1)], names=["x", "toxic"])

    table = sample.where("half = 1").select("text", "toxic").mapInArrow(measure, "x array<double>, toxic int").toArrow()
    x = np.array(table["x"].to_pylist(), float).reshape(-1, 5)
    order = np.lexsort(x.T)  # the same sums in any order of rows
    lexicon.bias, lexicon.slope = calibrate(x[order], np.array(table["toxic"].to_pylist(), float)[order])
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, least: float = 0.5) -> DataFrame:
    """``row`` (all columns of ``docs``), ``score`` and ``predicted`` (1 if the score is ``least`` or more).

    Every row is scored by its whole text; rows come back in their own struct, so no column name can
    clash. A NULL, empty or wordless text has no match and gets the score of such a text.
    """
    carried = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = lexicon.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= least).astype(np.int32))], names=["row", "score", "predicted"])

    out = T.StructType([carried.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return carried.mapInArrow(run, out)
