"""Ranked search against a plain scan of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_frames import EDGES, frame
from titlemart.llm import lexical

TERM = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=20):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows if terms(t)]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c, n in docs:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((score, doc))
        found.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(item, rank, doc, score) for rank, (score, doc) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, items, k=20):
    wide = frame(spark, rows).withColumns({"n": F.lit("clash"), "term": F.lit(1), "id": F.lit(None).cast("string"), "item": F.lit(2)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit(5), "id": F.lit("x"), "item": F.lit("y")}).repartition(2)
    got = lexical.rank_documents(wide, asked, k)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(rng, n=400):
    word = lambda: f"w{min(int(rng.paretovariate(0.7)), 300)}"
    rows = []
    for i in range(n):
        kind = rng.random()
        words = [word() for _ in range(12 if kind < 0.4 else rng.randrange(1, 120))]
        rows.append((i, rng.choice([" ", "\n", ", "]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    rows += [(1000 + i, rows[3][1]) for i in range(90)]  # many equal scores
    rows += [(2000, " ".join(word() for _ in range(9_000))), *EDGES, (2001, "ÉCOLE w2 école"), (2002, "w3 école Straße-w4_w5")]
    rng.shuffle(rows)
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "!!"), (33, "notinany word"), (34, "W3 w3 w3 É École"), (34, "w4"), (None, "w5 w6"), (35, rows[3][1])]
    return rows, items


@pytest.mark.parametrize("postings, first, sent", [(1_000_000, 4, 4_000_000), (150, 2, 4_000_000), (150, 1, 0)])
def test_against_all_documents(shared, monkeypatch, postings, first, sent):
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical, "FIRST_BLOCKS", first)
    monkeypatch.setattr(lexical, "SENT_TERMS", sent)
    rows, items = corpus(random.Random(postings))
    assert run(shared, rows, items) == brute(rows, items)


def test_fewer_than_k_and_k_of_one(shared):
    rows, items = corpus(random.Random(3), 40)
    assert run(shared, rows, items, 1) == brute(rows, items, 1)
    assert run(shared, rows, items, 500) == brute(rows, items, 500)


@pytest.mark.parametrize("rows, items", [([], [(1, "w1")]), ([(1, "w1 w2")], []), ([(1, None), (2, " ")], [(1, "w1")]), ([(1, "w1")], [(1, "w1")])])
def test_few_rows(shared, rows, items):
    assert run(shared, rows, items) == brute(rows, items)


def test_blocks_under_the_bound_are_not_visited(shared, monkeypatch):
    """Long documents of one weak match are bounded below the best twenty short ones."""
    monkeypatch.setattr(lexical, "FIRST_BLOCKS", 1)
    seen = []
    plain = lexical._visited

    def visited(index, visits, queries, k):
        seen.append(visits.select("m").distinct().collect())
        return plain(index, visits, queries, k)

    monkeypatch.setattr(lexical, "_visited", visited)
    rows = [(i, "rare rare rare") for i in range(30)] + [(100 + i, "rare " + "other " * (500 + 100 * i)) for i in range(20)] + [(200 + i, "none") for i in range(60)]
    assert run(shared, rows, [(1, "rare")]) == brute(rows, [(1, "rare")])
    assert len(seen) == 2 and len(seen[0]) == 1 and not seen[1]


def test_scores_beyond_doubles():
    postings = lexical._indexed(
        pa.table({"id": [4, 7], "terms": [[1, 2], [1]], "tfs": [[3, 1], [10**6]], "m": [75, 75], "piece": pa.array([0, 0], pa.int32())})
    )
    gain = (1 << 41) + 1
    visits = pa.table({"item": [1], "terms": [[1, 2]], "gains": [[gain, gain]], "least": [1]})
    got = lexical.best_of_block(postings, visits, 5).to_pylist()
    worth = lambda tf: 10**9 * tf // (1000 * tf + 12 * 75)
    want = sorted([(gain * (worth(3) + worth(1)), 4), (gain * worth(10**6), 7)], reverse=True)
    assert [(r["score"], r["doc_id"]) for r in got] == want and want[0][0] > 1 << 53


def test_postings_by_tf():
    postings = lexical._indexed(pa.table({"id": [9, None, 2], "terms": [[5], [5, 6], [5, 6]], "tfs": [[2], [7, 1], [2, 1]], "m": [80] * 3, "piece": pa.array([1] * 3, pa.int32())}))
    rows = {r["term"]: r for r in postings.to_pylist()}
    assert rows[None]["ids"] == [2, 9, None]
    assert (rows[5]["top"], rows[5]["docs"], rows[5]["tfs"], rows[5]["counts"]) == (7, [2, 0, 1], [7, 2], [1, 2])
    assert (rows[6]["top"], rows[6]["docs"], rows[6]["tfs"], rows[6]["counts"]) == (1, [0, 2], [1], [2])
    assert np.array_equal(lexical.impact(np.array([1, 2]), 75), [10**9 // 1900, 2 * 10**9 // 2900])
