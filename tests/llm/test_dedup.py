"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_frames import frame
from titlemart.llm import exact_dedup, minhash, suffix_dedup, tables, text, window_dedup


def words(text_):
    return re.findall(r"[^\x20\x09-\x0D]+", text_ or "")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def brute_exact(rows):
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    out = []
    for d, t in norm:
        group = [x for x, y in norm if y == t]
        ids = [x for x in group if x is not None]
        keep = min(ids) if ids else None
        out.append((d, keep, len(group), d == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_duplicates(shared, corpus, monkeypatch):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 7)
    assert rows_of(exact_dedup.exact_duplicates(frame(shared, corpus)), *columns) == brute_exact(corpus)


def test_equal_fingerprints_of_different_texts_fall_apart(shared, corpus, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *c: F.length(c[0]).cast("long") % 7)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(exact_dedup.exact_duplicates(frame(shared, corpus)), *columns) == brute_exact(corpus)


@pytest.mark.parametrize("bits", [1, 3, 17, 40])
def test_golomb_round_trip(bits):
    values = np.unique(np.random.default_rng(bits).integers(0, 1 << (bits + 9), 800, dtype=np.uint64))
    code = exact_dedup.golomb_encode(values, bits)
    assert (exact_dedup.golomb_decode(code, len(values), bits) == values).all()
    assert len(exact_dedup.golomb_decode(b"", 0, bits)) == 0


def brute_near(rows, k, percent=80):
    sets = []
    for d, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        mates = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        component = min(mates) if d is not None else None
        out.append((d, len(sets[i]), component, d is None or d == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(shared, corpus, k):
    rows = [r for r in corpus if r[0] != 9008]  # an id with two texts is one node
    got = rows_of(minhash.near_duplicates(frame(shared, rows), k), "doc_id", "n_shingles", "component_id", "kept")
    assert [g for g in got if g[0] is not None] == [w for w in brute_near(rows, k) if w[0] is not None]
    assert [g[3] for g in got if g[0] is None] == [True, True]


def test_one_group_of_near_copies_in_several_lanes(shared, monkeypatch):
    monkeypatch.setattr(minhash, "LANE", 8)
    rng = random.Random(3)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = f"e{i}"
        rows.append((i, " ".join(own)))
    got = rows_of(minhash.near_duplicates(frame(shared, rows), 4), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_near(rows, 4)


def test_members_of_the_largest_component_meet_only_others(shared):
    """A bucket of many near copies with few outsiders makes rows in line with its members, and every pair across is met."""
    kinds = [0] * 6000 + [7001, 7002, 7002]
    rows = [(1, 0, i, 9, c) for i, c in enumerate(kinds)] + [(2, 0, i, 9, 0) for i in range(50)]
    placed = shared.createDataFrame(rows, "key long, band int, node long, n long, component long")
    lanes = minhash._in_lanes(placed).collect()
    assert len(lanes) == 6003 + 3 * -(-6000 // minhash.LANE) and {r.key for r in lanes} == {1}
    groups = {}
    for r in lanes:
        groups.setdefault((r.lane_a, r.lane_b), {}).setdefault(r.lane, set()).add(r.node)
    met = set()
    for (a, b), members in groups.items():
        left, right = members.get(a, ()), members.get(b, ())
        assert max(map(len, members.values())) < 2 * minhash.LANE
        met.update((min(x, y), max(x, y)) for x in left for y in right if kinds[x] != kinds[y])
    assert met == {(x, y) for y in range(6000, 6003) for x in range(y) if kinds[x] != kinds[y]}


def test_sketches_fill_every_coordinate_and_estimate():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    b = np.concatenate([a[:270], rng.integers(0, 1 << 62, 30, dtype=np.uint64)])
    one = a[:1]
    s = minhash.sketches(np.concatenate([a, b, one]), np.array([0, 300, 600, 601]))
    assert (s != np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - 270 / 330) < 0.12
    assert (minhash.sketches(np.zeros(0, np.uint64), np.array([0, 0])) == np.iinfo(np.uint64).max).all()


def test_components(shared):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 470)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for x in parent if any(x in link and link[0] != link[1] for link in links)}
    got = tables.components(shared.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want
    assert tables.components(shared.createDataFrame([], "a long, b long")).count() == 0


def brute_windows(rows, span):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - span + 1) if d is not None else ():
            key = tuple(w[i : i + span])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - span + 1) if d is not None else ():
            if first[tuple(w[i : i + span])] < d:
                gone |= set(range(i, i + span))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_windows(shared, corpus, monkeypatch, hot):
    monkeypatch.setattr(window_dedup, "HOT_STRINGS", hot)
    got = window_dedup.remove_repeated_windows(frame(shared, corpus), 30)
    want = brute_windows(corpus, 30)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert sum(w[2] for w in want) > 1000


def brute_strings(rows, span):
    counts = Counter()
    for d, t in rows:
        b = (t or "").encode()
        counts.update(b[i : i + span] for i in range(len(b) - span + 1) if d is not None)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1) if d is not None else ():
            if counts[b[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_strings(shared, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_STRINGS", hot)
    got = suffix_dedup.remove_repeated_strings(frame(shared, corpus), 150)
    want = brute_strings(corpus, 150)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert sum(w[3] for w in want) > 40


@pytest.mark.parametrize("hot", [1000, 2])
def test_one_id_with_different_long_texts(shared, monkeypatch, hot):
    """Repeats are cut from the row they are in, not from others with its id; a full copy of a row is cut like it."""
    monkeypatch.setattr(window_dedup, "HOT_STRINGS", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_STRINGS", hot)
    rng = random.Random(8)
    new = lambda n: [f"x{rng.randrange(10**6)}" for _ in range(n)]
    passage, other = new(60), new(50)
    texts = [new(20) + passage, new(90) + passage + new(9), new(40), new(120), other + new(30) + passage, other]
    rows = list(zip((1, 7, 7, 7, 8, 8, None), map(" ".join, [*texts, passage])))
    rows += [rows[1], rows[5]]
    got = rows_of(window_dedup.remove_repeated_windows(frame(shared, rows), 30), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_windows(rows, 30)
    got = rows_of(suffix_dedup.remove_repeated_strings(frame(shared, rows), 150), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_strings(rows, 150)


def test_deep_shallow_order():
    rng = random.Random(2)
    for _ in range(200):
        tails = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 90))) for _ in range(rng.randrange(1, 14))]
        strings = [b"x" * 60 + t for t in tails] + [b"x" * 60 + b"b" * 70 + t for t in tails]
        order = suffix_dedup.deep_shallow_order(strings, 20)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))


@pytest.mark.parametrize("remove", [
    exact_dedup.exact_duplicates, minhash.near_duplicates, window_dedup.remove_repeated_windows, suffix_dedup.remove_repeated_strings,
])
def test_empty_table(shared, remove):
    assert remove(frame(shared, [(1, "a")]).where("false")).count() == 0


def test_word_hashes_do_not_depend_on_the_block():
    texts = [b"alpha beta", b"", b"beta\tgamma  alpha", b"\n"]
    whole = [h for _, _, d, s in text.blocks(texts) for h in text.words(d, s)[2].tolist()]
    single = [h for _, _, d, s in text.blocks(texts, 1) for h in text.words(d, s)[2].tolist()]
    assert whole == single and whole[0] == whole[4] and whole[1] == whole[2]


def test_window_minimum_in_slices_equals_plain():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64)
    plain = [i + int(np.argmin(keys[i : i + 20] >> np.uint64(24))) for i in range(481)]
    assert text.window_minimum(keys, 20).tolist() == plain
