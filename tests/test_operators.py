"""Operators against brute force, and their plans."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from titlemart.operators import (
    collect_aligned,
    collect_distinct,
    distinct_lists,
    reconcile,
    same_count,
    top_k_per_group,
    unnest_product,
)
from titlemart.functions import attach_functions
from titlemart.operators import topk
from titlemart.operators.topk import GROUP_LIMIT
from titlemart.plans import marts
from titlemart.plans.staging import staged_titles

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, 1.0, 2.0, 3.0]), i)
        for i in range(2000)
    ]
    return rows, spark.createDataFrame(rows, "g string, v double, id long").repartition(8)


@pytest.mark.parametrize("k", [1, 3, 100, 1000])
def test_top_k(scored, k):
    rows, df = scored
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = {r for g in groups.values() for r in sorted(g, key=order, reverse=True)[:k]}
    got = [tuple(r) for r in top_k_per_group(df, ["g"], "v", ["id"], k).collect()]
    assert len(got) == len(want) and set(got) == want


def test_collect_distinct_keeps_null(scored):
    rows, df = scored
    got = {r.g: r.l for r in df.groupBy("g").agg(collect_distinct(F.col("v")).alias("l")).collect()}
    assert got["hot"] == [None, 1.0, 2.0, 3.0]


def test_distinct_lists_equal_the_exploded_product(spark):
    titles = staged_titles(spark, SF_DIR)
    arrays = {"k": "production_countries", "g": "genres", "c": "production_companies"}
    exploded = unnest_product(titles, arrays, ["id"]).groupBy("id").agg(
        *[collect_distinct(F.col(f"{a}.name")).alias(a) for a in arrays]
    )
    lists = distinct_lists(titles, "id", {a: f"{array}.name" for a, array in arrays.items()})
    assert lists.count() > 0
    assert exploded.exceptAll(lists).isEmpty() and lists.exceptAll(exploded).isEmpty()


def test_aligned_lists_and_rows_of_a_hot_group(spark):
    rows = [(None if i % 2 else 1, i, None if i % 3 else f"t{i}") for i in range(400)] + [(2, 1, "x")]
    df = spark.createDataFrame(rows, "k long, id long, name string")
    result = {r.k: r for r in collect_aligned(df, ["k"], {"ids": "id", "names": "name"}).collect()}
    assert len(result) == 3
    for k, r in result.items():
        assert list(zip(r.ids, r.names)) == sorted(((i, n) for g, i, n in rows if g == k), key=lambda p: p[0])
    long = collect_aligned(df, ["k"], {"the_id": "id", "the_name": "name"}, "rows")
    assert long.columns == ["k", "the_id", "the_name"] and "Exchange" not in plan(long)
    assert sorted(map(tuple, long.collect()), key=repr) == sorted(rows, key=repr)
    with pytest.raises(ValueError):
        collect_aligned(df, ["k"], {"ids": "id"}, "lists")


def test_large_k_is_limited_on_the_map_side_or_by_a_cut(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), (F.col("id") % 997).alias("v"), "id")
    spark.conf.set(GROUP_LIMIT, "1000")
    by_cut = top_k_per_group(rows, ["g"], "v", ["id"], 5000)
    spark.conf.set(GROUP_LIMIT, "5000")
    try:
        best = top_k_per_group(rows, ["g"], "v", ["id"], 5000)
        text = plan(best)
        assert text.count("WindowGroupLimit") == 2 and "Partial" in text and text.count("Exchange") == 1
        assert best.where("g = 'hot'").count() == 5000
        assert by_cut.exceptAll(best).isEmpty() and by_cut.count() == best.count()
    finally:
        spark.conf.unset(GROUP_LIMIT)


def test_reconcile(spark):
    source = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    target = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    assert sorted(tuple(r) for r in reconcile(source, target, "k").collect()) == [
        (2, "missing", 2), (3, "extra", 1)]
    assert tuple(same_count(source, target).first()) == (4, 3, False)


def test_ranking_is_limited_on_the_map_side(spark):
    titles = staged_titles(spark, SF_DIR).select("status", "id", "popularity")
    text = plan(top_k_per_group(titles, ["status"], "popularity", ["id"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_scans_read_only_what_a_mart_needs(spark):
    titles = staged_titles(spark, SF_DIR)
    text = plan(marts.company_portfolio(titles))
    assert "genres:array<struct<name:string>>" in text
    assert "logo_path" not in text and "overview" not in text
    assert "PushedFilters: [IsNotNull(genres)]" in plan(marts.genres(titles))


@pytest.mark.parametrize("k", [1, 30, 45, 500])
def test_any_k(spark, monkeypatch, k):
    """Beyond Spark's limit: ties, NULL and NaN values, NULL groups, one group of most rows."""
    rng = random.Random(k)
    value = lambda: rng.choice([None, float("nan"), 0.0, 1.0, 2.0, rng.random()])
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), value(), i) for i in range(2000)] + [("few", 1.0, -1), ("none", None, -2)]
    df = spark.createDataFrame(rows, "g string, v double, i long").repartition(6)
    spark.conf.set(topk.GROUP_LIMIT, "0")
    try:
        got = sorted((tuple(r) for r in topk.top_k_per_group(df, ["g"], "v", ["i"], k, rank="n").collect()), key=repr)
    finally:
        spark.conf.unset(topk.GROUP_LIMIT)
    order = lambda r: (r[1] is not None, r[1] is not None and math.isnan(r[1]), 0 if r[1] is None or math.isnan(r[1]) else r[1], r[2])
    want = []
    for g in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == g), key=order, reverse=True)[:k]
        want += [(*r, n) for n, r in enumerate(best, 1)]
    assert repr(got) == repr(sorted(want, key=repr))


def test_the_cut_leaves_k_rows_and_little_more(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.xxhash64("id").alias("v"), "id")
    kept = topk.above_cut(df, ["g"], "v", 50_000).count()
    assert 50_000 <= kept < 53_000
    assert topk.above_cut(df.withColumn("v", F.lit(1)), ["g"], "v", 50_000).count() == 200_000
    assert topk.above_cut(df.withColumn("v", F.col("v").cast("string")), ["g"], "v", 5).count() == 200_000
    plan = topk.above_cut(df, ["g"], "v", 50_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" in plan and "Window" not in plan
    best = topk.top_k_per_group(df, ["g"], "v", ["id"], 50_000, rank="n")
    assert "WindowExec" not in best._jdf.queryExecution().executedPlan().toString()
    assert best.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 50_000, 50_000)


def test_the_cut_moves_no_rows_by_group(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = topk.above_cut(df, ["g"], "v", 1000)
        assert "BroadcastHashJoin" in plan(cut) and "SortMergeJoin" not in plan(cut)
        assert all(1000 <= r["count"] < 1200 for r in cut.groupBy("g").count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_functions_on_batches_only(spark):
    doubled = F.pandas_udf(lambda v: v * 2, "long")
    attach_functions(spark, python_functions={"doubled": doubled})
    query = spark.sql("SELECT doubled(id) AS d FROM range(3)")
    assert [r.d for r in query.collect()] == [0, 2, 4]
    assert "ArrowEvalPython" in query._jdf.queryExecution().executedPlan().toString()
    for plain in (lambda v: v, F.udf(lambda v: v, "long")):
        with pytest.raises(ValueError, match="row by row"):
            attach_functions(spark, python_functions={"slow": plain})
