"""The lexicon: folding, matches against a plain search, its counts against brute force, held-out accuracy."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_frames import EDGES, frame, prose
from titlemart.llm import queries, toxicity
from titlemart.llm.toxicity import Lexicon, fold

WORDS = ["alpha", "bravo", "delta", "echo", "golf", "hotel", "tango", "vector"]


@pytest.mark.parametrize(
    "text, words",
    [
        ("You 1D10T!!", "you idiot"), ("a $cum", "a scum"), ("l0s3r, m0r0n", "ioser moron"), ("ѕtuріd", "stupid"), ("ｔｒａｓｈ", "trash"),
        ("tra​sh", "trash"), ("THE!! A!! of$$$", "the a of"), ("x | y || z", "x y z"), ("idi07", "idiot"), ("2021 - 7", ""), ("", ""),
        (" \t\n", ""), ("L|L", "iii"), ("é à", "é à"), ("!wow", "wow"), ("st!pid", "stipid"),
    ],
)
def test_fold(text, words):
    assert fold(text).split() == words.split()
    assert fold(text) == "".join(f" {w} " for w in words.split())


def test_matches_are_leftmost_longest():
    rng = random.Random(2)
    letters = lambda n: "".join(rng.choice("abi") for _ in range(n))
    for _ in range(300):
        entries = {rng.choice([" %s ", " %s", " %s  a "]) % letters(rng.randrange(1, 5)) for _ in range(rng.randrange(0, 12))}
        lexicon = Lexicon({e: float(i % 3) for i, e in enumerate(sorted(entries))})
        text = "".join(f" {letters(rng.randrange(1, 6))} " for _ in range(rng.randrange(0, 30)))
        # of all entries at a place the longest, then on from its end
        pattern = "|".join(map(re.escape, sorted(entries, key=len, reverse=True)))
        want = [(m.end() - 1, m.group(), lexicon.weights[m.group()]) for m in re.finditer(pattern, text)] if entries else []
        assert list(lexicon.matches(text)) == want


def labelled(rng, n=600):
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        words = [rng.choice(WORDS) + rng.choice("aeiou") for _ in range(rng.randrange(4, 60))]
        for _ in range(1 + len(words) // 15 if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["wretch", "wr3tch", "vermin", "grubling", "grublet"]))
        if not toxic and rng.random() < 0.06:
            words += ["vermin", "control"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def fit(spark, rows, labels, **more):
    docs = frame(spark, rows).withColumn("toxic", F.lit("clash"))
    return toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **more)


@pytest.fixture(scope="module")
def learnt(shared):
    rows, labels = labelled(random.Random(5))
    return rows, labels, fit(shared, rows, labels)


def half_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.text: r.half for r in df.select("text", F.pmod(F.xxhash64("text"), F.lit(2)).alias("half")).collect()}


def test_entries_against_brute_force(shared, learnt):
    rows, labels, lexicon = learnt
    label = {i: y for i, _, y in labels if zlib.crc32(str(i).encode()) % 5}
    texts = {(t, label[i]) for i, t in rows if i in label}
    half = half_of(shared, {t for t, _ in texts})
    used = [(t, y) for t, y in texts if half[t] == 0]
    n = [sum(y == k for _, y in used) for k in (0, 1)]
    counts = {}
    for t, y in used:
        words = set(fold(t).split())
        for c in {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in range(3, min(8, len(w)) + 1)}:
            counts.setdefault(c, [0, 0])[y] += 1
    least = max(3, math.ceil(n[1] / 100))
    weight = {c: math.log((b + 0.5) / (n[1] + 1)) - math.log((a + 0.5) / (n[0] + 1)) for c, (a, b) in counts.items()}
    wanted = {c for c, (a, b) in counts.items() if b >= least and weight[c] >= 1}
    longest = {c for c in wanted if not any(d != c and len(c) < len(d) and d.startswith(c) and counts[d] == counts[c] for d in wanted)}
    got = {e: w for e, w in lexicon.weights.items() if w}
    assert got.keys() == longest - {e for e, w in lexicon.weights.items() if not w}
    assert all(math.isclose(w, weight[e], abs_tol=1e-9) for e, w in got.items())
    assert " wretch " in got and " grub" in " ".join(got)


def test_exception_phrases(shared, learnt):
    rows, labels, lexicon = learnt
    assert lexicon.weights[" vermin  controi "] == 0
    assert lexicon.score(["alphaa vermin control bravoe"])[0] < 0.5 < lexicon.score(["alphaa vermin bravoe"])[0]
    given = fit(shared, rows, labels, exceptions=["wretch of the year", "  "])
    assert given.weights[" wretch  of  the  year "] == 0
    assert given.score(["Wr3tch of the YEAR"])[0] < 0.5 < given.score(["the year of the wretch"])[0]


def test_disguises_are_caught(learnt):
    _, _, lexicon = learnt
    plain, *others = lexicon.score(["alphaa wretch", "alphaa WRETCH", "alphaa wrеtсh", "alphaa wr3tch", "alphaa wre­tch", "alphaa wrétch"])
    assert plain > 0.5 and np.allclose(others, plain)


def test_length_counts(learnt):
    _, _, lexicon = learnt
    short, long_ = lexicon.score(["wretch", "wretch " + "alphaa " * 5_000])
    assert long_ < short


def test_calibration_finds_the_maximum():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] + 0.3)))).astype(float)
    bias, slope = toxicity.calibrate(x, y)
    loss = lambda b, s: np.log1p(np.exp(-(2 * y - 1) * (x @ s + b))).sum() + 0.05 * (s**2).sum()
    best = loss(bias, slope)
    for _ in range(50):
        assert best <= loss(bias + rng.normal() * 0.05, slope + rng.normal(size=3) * 0.05)


def test_held_out_labels_and_other_columns_are_not_learnt(shared, learnt):
    rows, labels, lexicon = learnt
    out = {i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    changed = [(i, q, 1 - y if i in out else y) for i, q, y in labels]
    again = fit(shared, rows, changed)
    assert again.weights == lexicon.weights and again.bias == lexicon.bias and (again.slope == lexicon.slope).all()


def test_odd_rows(shared, learnt):
    _, _, lexicon = learnt
    long_ = (8000, "alphaa " * 200_000 + "wretch " * 3_000)
    rows = [*EDGES, long_, (8001, "wretch"), (8001, "wretch")]
    got = toxicity.score_toxicity(frame(shared, rows).withColumn("predicted", F.lit("clash")), lexicon).collect()
    assert len(got) == len(rows) and {r.row.predicted for r in got} == {"clash"}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    blank = {r.score for r in got if not (r.row.text or "").strip()}
    assert len(blank) == 1
    assert [r.predicted for r in got if r.row.doc_id == 8001] == [1, 1]


def test_without_labels(shared):
    rows = [(1, "wretch"), (2, None)]
    for labels, low, high in (([], 0.5, 0.5), ([(1, 1, None), (None, 1, 1)], 0.5, 0.5), ([(1, 1, 1), (1, 1, 0)], 0.5, 0.5), ([(1, 0, 1)], 0.5, 1), ([(2, 0, 0)], 0, 0.5)):
        lexicon = fit(shared, rows, labels)
        got = toxicity.score_toxicity(frame(shared, rows), lexicon).collect()
        assert len(got) == 2 and all(low <= r.score <= high for r in got)
    assert toxicity.score_toxicity(frame(shared, rows).limit(0), lexicon).count() == 0


def test_many_labels_of_one_text(shared):
    rng = random.Random(9)
    rows, labels = labelled(rng, 200)
    copies = [(10_000 + i, "alphaa rumour " + " ".join(prose(random.Random(1), 30))) for i in range(300)]
    lexicon = fit(shared, rows + copies, labels + [(i, 0, 1) for i, _ in copies])
    assert " rumour " not in lexicon.weights  # one text, however often copied


def test_held_out_accuracy(shared):
    import pyarrow.dataset as ds

    sf = "/root/testdata/sf0.1"
    toxic = dict(zip(*(ds.dataset(f"{sf}/labels.parquet").to_table()[c].to_pylist() for c in ("doc_id", "toxic"))))
    got = [r for r in queries.op13_toxicity(shared, sf).collect()]
    assert len(got) == 10_000
    held = [(r.predicted, toxic[r.doc_id]) for r in got if r.held_out and r.doc_id in toxic]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.85
    assert sum(p for p, y in held if not y) / sum(1 - y for _, y in held) < 0.01
