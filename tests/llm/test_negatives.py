"""Hard negatives against a search of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from titlemart.llm import hard_negatives as hn

OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, positives=5, negatives=3):
    usable = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    by = lambda pair: (-pair[0], pair[1] is None, pair[1] or 0)
    out = []
    for a, (anchor, v, label) in enumerate(usable):
        if not is_anchor(anchor):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, other) for b, (i, w, other) in enumerate(usable) if a != b]
        near = sorted(((s, i) for s, i, other in scored if other == label), key=by)[:positives]
        for p, positive in near:
            far = sorted(((s, i) for s, i, other in scored if other != label and 50 * p <= 100 * s <= 95 * p), key=by)
            out += [(anchor, positive, rank, i, p, s) for rank, (s, i) in enumerate(far[:negatives], 1)]
    return sorted(out, key=repr)


def run(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({"row": F.lit("clash"), "v": F.lit(1), "score": F.lit(2.0), "ask": F.lit(None).cast("string")}).repartition(3)
    got = hn.hard_negatives(df, F.col("vec_id") % 5 == 0).select(OUT).collect()
    return sorted((tuple(r) for r in got), key=repr)


def vectors(rng, n, wide, common=0.0):
    same = [rng.gauss(0, 0.2) for _ in range(wide)]
    pick = lambda: list(same) if rng.random() < common else [rng.gauss(0.1, 0.2) for _ in range(wide)]
    as_float = lambda v: [float(np.float32(x)) for x in v]
    return [(i, as_float(pick()), rng.choice([0, 0, 0, 0, 1, 2, 3])) for i in range(n)]


@pytest.mark.parametrize("wide, common, depth, rest", [(2, 0, 2, 0), (3, 0.4, 1, 0), (8, 0, 8, 4), (16, 0.3, 4, 4)])
def test_against_all_pairs(shared, monkeypatch, wide, common, depth, rest):
    monkeypatch.setattr(hn, "FIRST_DEPTH", depth)
    monkeypatch.setattr(hn, "REST", rest)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 60)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 20)
    rows = vectors(random.Random(wide), 240, wide, common)
    assert run(shared, rows) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(shared):
    rows = vectors(random.Random(3), 60, 4, 0.2)
    rows += [rows[5], rows[5], rows[10], (None, rows[7][1], 0), (None, rows[8][1], 1), (200, None, 0), (205, rows[0][1], None), (210, [], 0)]
    rows += [(215, [0.5, None, 1.0, 0.0], 0), (220, [float("nan"), 0.0, 0.0, 0.0], 0), (225, [float("inf"), 0.0, 0.0, 0.0], 1), (230, [0.0] * 4, 2), (231, [0.5, 0.25], 2)]
    rows += [(235, [300.0, -300.0, 0.5, 300.0], 1), (236, [300.0, -300.0, 0.5, 300.0], 0), (10, [0.1, 0.2, -0.3, 0.1], 2)]
    assert run(shared, rows) == brute(rows, lambda i: i is not None and i % 5 == 0)


@pytest.mark.parametrize("rows", [[], [(0, [0.5], 1)], [(1, [0.5], 1), (2, [0.5], 1)], [(0, None, None)]])
def test_few_rows(shared, rows):
    assert run(shared, rows) == []


def test_sorted_access_stops_early():
    """On few strong dimensions the threshold settles the windows before the lists end."""
    rng = np.random.default_rng(1)
    values = np.floor(rng.normal(0, 60, (20_000, 3)))
    anchor = np.array([200.0, -3.0, 0.0])
    lists, allowed = hn.sorted_lists(values), np.ones(len(values), bool)
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                looked.append(len(key))
            return super().__getitem__(key)

    (rows, scores), = hn.seek(lists, values.view(Counted), anchor, allowed, [(-(1 << 62), 1 << 62)], 5)
    true = values @ anchor
    best = np.lexsort((np.arange(len(true)), -true))[:5]
    assert rows.tolist() == best.tolist() and np.asarray(scores).tolist() == true[best].tolist()
    assert 0 < sum(looked) < 2_000


def test_large_components_stay_exact(shared):
    rows = [(5 * i, [2.0**17 + i, 2.0**17 - i, 1.0 + i], i % 2) for i in range(12)]
    assert run(shared, rows) == brute(rows, lambda i: True)


def test_query_reads_both_label_rules(shared):
    from titlemart.llm import queries

    got = queries.op11_hard_negatives(shared, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    assert got.count() > 0
