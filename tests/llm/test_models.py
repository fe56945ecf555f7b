"""Mixing, quality, language and the pipeline."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_frames import EDGES, frame, prose
from oracle import compare, connect
from titlemart.llm import language, mixing, quality, queries
from test_dedup import brute_exact, brute_near, words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_against_sql(shared, name, sf):
    assert compare(queries.QUERIES[name](shared, sf), connect(sf), queries.ORACLES[name]) is None


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(sizes.values())
    while True:
        level = rest / max(sum(weight[s] for s in open_), 1)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
        open_ -= over


def test_mix(shared):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "b", "b", "b", "c", "d", "é", None]), " ".join(prose(rng, rng.randrange(0, 90)))) for i in range(300)]
    rows += [(1000 + i, "tiny", "x y") for i in range(3)] + [(1, "empty", None), (None, "a", "no id here"), (7, "a", "again"), (7, "a", "again")]
    docs = shared.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))
    got = mixing.taken_words(docs).collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(words(t))
    target = brute_targets(sizes)
    copies = mixing.weighted_fair_mix(docs).collect()
    taken = defaultdict(int)
    for r in copies:
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes), (dict(taken), target)
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
    assert sum(r.taken for r in got) == sum(taken.values()) <= sum(sizes.values())
    order = [r.finish for r in mixing.in_stream_order(mixing.weighted_fair_mix(docs)).collect()]
    assert order == sorted(order) and order[-1] <= 1
    again = mixing.taken_words(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.taken_words(docs.where("false")).count() == 0


def test_mix_is_a_range_sort_cut_at_the_budget(shared, monkeypatch):
    rng = random.Random(8)
    rows = [(i if i % 3 else None, rng.choice("aabbbc"), " ".join(prose(rng, rng.randrange(0, 40)))) for i in range(400)]
    docs = shared.createDataFrame(rows, "doc_id long, source string, text string")
    ordered, cuts = [], []
    monkeypatch.setattr(mixing, "_cut_at", lambda parts, order, budget, cut=mixing._cut_at: ordered.append(parts) or cuts.append((order, budget)) or cut(parts, order, budget))
    got = mixing.weighted_fair_mix(docs).collect()
    (order, budget), left = cuts[0], cuts[0][1]
    assert order[0] == "finish" and "rangepartitioning(finish" in ordered[0].repartitionByRange(*order)._jdf.queryExecution().executedPlan().toString()
    for r in sorted(got, key=lambda r: [getattr(r, c) for c in order]):
        assert r.taken == min(r.words, left)
        left -= r.taken
    assert left == 0 and sum(r.taken for r in got) == budget
    # rows without id do not share a place in the queue
    assert len({r.ticket for r in got if r.doc_id is None and r.size}) > 100
    # any budget cuts there, inside a part too
    few = mixing._cut_at(ordered[0], order, 777).collect()
    assert sum(r.taken for r in few) == 777 and sum(0 < r.taken < r.words for r in few) <= 1


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.fit_trees(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    # one row through one tree, node by node
    for row in x[:20]:
        total = trees.prior
        for t in range(len(trees.feature)):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - (2**quality.DEPTH - 1)]
        assert abs(1 / (1 + math.exp(-total)) - trees.score(row[None])[0]) < 1e-9
    assert quality.fit_trees(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert quality.fit_trees(x[:8], np.ones(8)).score(x[:1])[0] == pytest.approx(0.9)


def test_quality_on_held_out_labels(shared):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in shared.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op6_quality(shared, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) > 0.97


def test_quality_does_not_look_at_the_held_out(shared, corpus):
    docs = frame(shared, corpus)
    labels = shared.createDataFrame([(i, i % 2, 0) for i in range(160)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit_quality(docs, labels), quality.fit_quality(docs, flipped)
    assert (one.threshold == two.threshold).all() and (one.leaf == two.leaf).all()
    scored = quality.score_quality(docs, one)
    assert scored.count() == len(corpus) and scored.select("row.*").columns == docs.columns
    assert quality.score_quality(docs.where("false"), quality.fit_quality(docs, labels.where("false"))).count() == 0


def test_language_on_held_out(shared):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in shared.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op9_language(shared, sf).collect()
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 100 and sum(held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(shared):
    docs = frame(shared, [(i, "the quick brown fox and the dog " * 3) for i in range(9)] + EDGES + [(77, "1234 !?")])
    german = docs.withColumn("lang", F.lit("de")).withColumn("text", F.lit("der schnelle braune Fuchs und der Hund"))
    models = language.fit_languages(docs.unionByName(german))
    got = defaultdict(list)
    for r in language.predict_languages(docs, models).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    assert got[0][0][0] == "en" and all(got[i] == [("und", 0.0)] for i in (9001, 9002, 9003, 77))
    assert language.predict_languages(docs.where("false"), models).count() == 0
    nothing = language.fit_languages(docs.where("false"))
    assert {r.lang_pred for r in language.predict_languages(docs, nothing).collect()} == {"und"}


def test_language_is_calibrated_on_every_row(shared):
    """Of 2,500 rows the last by hashed id, one odd text, counts like the others."""
    ids = [r.id for r in shared.range(2500).orderBy(F.xxhash64("id"), "id").collect()]
    texts = {i: "der schnelle braune Fuchs und der Hund" if i == ids[-1] else "the quick brown fox and the dog " * (1 + i % 3) for i in ids}
    rows = [(i, "en" if i % 2 else "xx", t) for i, t in texts.items()]
    models = language.fit_languages(shared.createDataFrame(rows, "doc_id long, lang string, text string"))
    entropy, n = models.entropies([t for *_, t in rows])
    truth = np.array([models.langs.index(x) for _, x, _ in rows])
    for j in range(2):
        own = entropy[truth == j, j]
        assert models.limits[j] == pytest.approx(own.mean() + 4 * own.std(), abs=1e-3)
    loss = lambda s: -np.log(np.maximum(models.confidence(entropy, n, s)[np.arange(len(n)), truth], 1e-6)).mean()
    assert loss(models.sharpness) == pytest.approx(min(map(loss, language.SHARPNESSES)), abs=1e-5)


def test_language_probabilities_sum_to_one():
    rng = random.Random(2)
    texts = {"xx": "abcab cab abba " * 40, "yy": "".join(rng.choice("abcdefgh ") for _ in range(500))}
    parts = [(k, *np.unique(language.grams_of([t])[0], return_counts=True)) for k, t in texts.items()]
    counts = pa.table({
        "lang": [k for k, g, _ in parts for _ in g], "gram": np.concatenate([g for _, g, _ in parts]).astype(np.int64),
        "n": np.concatenate([n for _, _, n in parts]),
    })
    m = language.build_models(counts)
    for context in (0, 1, 64 + 2, (64 + 2) * 64 + 3, 9 * 4096):
        for j in range(2):
            total = 0
            for symbol in range(64):
                code = context * 64 + symbol
                at = np.searchsorted(m.grams, code)
                known = at < len(m.grams) and m.grams[at] == code
                total += math.exp(m.seen[at, j] if known else m.back[context, j] + m.lower[code & (64**3 - 1), j])
            assert total == pytest.approx(1, abs=1e-4)


def test_pipeline_stage_by_stage(shared):
    documents = shared.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    docs, kept = documents, {r.doc_id: r.text for r in documents.collect()}
    items = shared.read.parquet(f"{SF}/benchmark.parquet").collect()
    trees = quality.fit_quality(documents, shared.read.parquet(f"{SF}/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        docs = stage(shared, docs, SF).checkpoint()
        rows = docs.collect()
        kept = {r.doc_id: r.text for r in rows}
        if name.startswith("mixing"):
            assert set(kept) <= set(before) and [r.mix_finish for r in rows] == sorted(r.mix_finish for r in rows)
            total = sum(len(words(t)) for t in before.values())
            assert total - 30 <= sum(r.mix_words for r in rows) <= total
            continue
        assert docs.columns == documents.columns and len(rows) == len(kept)
        listed = list(before.items())
        if name.startswith("quality"):
            scored = quality.score_quality(documents, trees).where("predicted = 1").select("row.doc_id").collect()
            want = {r.doc_id for r in scored}
        elif name.startswith("exact"):
            want = {d for d, _, _, keep, _ in brute_exact(listed) if keep}
        elif name.startswith("MinHash"):
            want = {d for d, _, _, keep in brute_near(listed, 5) if keep}
        else:
            leaks = {d for d, t in listed for i in items if " ".join(i.text.split()) in " ".join(t.split())}
            assert not leaks & set(kept)
            want = set(before) - leaks
        assert set(kept) == want, name


def test_pipeline_keeps_rows_without_id_and_survives_nothing(shared):
    docs = shared.createDataFrame(
        [(None, "no id but some words", "en", "s", 3), (1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for stages, frame_ in ((corpus_pipeline.STAGES[1:4], docs), (corpus_pipeline.STAGES, docs.where("false"))):
        for _, stage in stages:
            frame_ = stage(shared, frame_, SF).checkpoint()
        assert {r.doc_id for r in frame_.collect()} in ({None, 1}, set())


@pytest.mark.parametrize("in_files", [False, True])
def test_pipeline_decides_on_rows(shared, tmp_path, in_files):
    """NULL ids, repeated rows and one id with two texts: copies, near copies and leaks go, the rest stays."""
    rng = random.Random(12)
    new = lambda n: " ".join(f"y{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, d, e, f, g = (new(80) for _ in range(7))
    item = shared.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first().text
    rows = [
        (None, a), (None, a), (4, a), (9, a),  # the copy with the smallest id stays
        (None, b), (None, b + " end"), (None, b),  # one of those without id
        (5, c), (5, c), (5, c + " end"),  # a fully repeated row, and a near copy with its id
        (6, d), (6, e), (3, e),  # only one of the texts of id 6 is a copy
        (None, f), (8, f + " end"),
        (None, "before " + item), (7, item + " after"), (7, g),
    ]
    docs = shared.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("clash") for c in ("row_", "key_", "gone_", "group_", "file_", "place_", "mix_", "n_")})

    def put(df, name):
        if not in_files:
            return df.checkpoint()
        df.write.parquet(str(tmp_path / name))
        return shared.read.parquet(str(tmp_path / name))

    docs = put(docs.repartition(5), "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = put(stage(shared, docs, SF), name)
        assert out.columns == docs.columns
        kept[name], docs = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr), out
    mixed = corpus_pipeline.mix_stage(shared, docs, SF)
    assert mixed.columns == [*docs.columns, "mix_epoch", "mix_finish", "mix_words"]
    assert {(r.doc_id, r.text, r.key_) for r in mixed.collect()} == {(r.doc_id, r.text, "clash") for r in docs.collect()}
    final = kept.popitem()[1]
    b_kept = {t for i, t in final if i is None}
    assert len(b_kept) == 1 and b_kept < {b, b + " end"}
    c_kept = [t for i, t in final if i == 5]
    assert len(c_kept) == 1 and c_kept[0] in (c, c + " end")
    assert [x for x in final if x[0] not in (None, 5)] == sorted([(4, a), (3, e), (6, d), (8, f + " end"), (7, g)], key=repr)
    exact = kept["exact dedup"]
    assert sorted(exact, key=repr) == sorted([(4, a), (None, b), (None, b + " end"), (5, c), (5, c + " end"), (6, d), (3, e), *rows[13:]], key=repr)


def test_near_stage_keeps_one_of_repeated_rows(shared):
    docs = shared.createDataFrame([(1, "one two three four five six", "a"), (1, "one two three four five six", "b"), (None, " ", "c"), (None, " ", "d")], "doc_id long, text string, source string")
    assert [r.source for r in corpus_pipeline.near_stage(shared, docs, SF).orderBy("source").collect()] == ["a", "c", "d"]
