"""Staging from star tables: each order's lines are collected behind one shuffle."""

import re

from titlemart.plans import staging

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "R0")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N0", 0), (1, "N1", 9)]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "C1", 1, "X"), (1, "C1b", 0, "X")]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "S1", 0, 5000.0), (2, "S2", None, 1.0)]),
    "part": ("p_partkey long, p_type string, p_size int", [(1, "A", 3), (1, "B", 7), (2, "A", 3)]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(1, 1, "F", 1.0, None, "p"), (2, None, "O", 2.0, None, "p"), (None, 1, "P", 3.0, None, None)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_discount double, l_linenumber int, l_quantity double, l_extendedprice double",
        [(1, 1, 1, 0.1, 1, 2.0, 10.5), (1, 2, 2, 0.2, 2, 3.0, 20.5), (1, None, None, None, 3, 1.0, 1.0), (None, 2, 1, 0.5, 1, 1.0, 1.0)],
    ),
}


def _star(spark, folder):
    for name, (layout, rows) in TABLES.items():
        spark.createDataFrame(rows, layout).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_repeated_and_null_keys(spark, tmp_path):
    found = staging.titles_from_star(spark, _star(spark, tmp_path)).collect()
    assert sorted((r.id or 0, r.vote_count or 0, r.budget or 0, len(r.belongs_to_collection)) for r in found) == [
        (0, 0, 0, 1), (0, 0, 0, 1), (1, 4, 8, 1), (1, 4, 8, 1), (2, 0, 0, 0),
    ]
    one = next(r for r in found if r.id == 1)
    assert sorted((g.id or 0, g.name or "") for g in one.genres) == [(0, ""), (0, "B"), (3, "A")]
    assert [(c.id, c.name, c.origin_country) for c in one.production_companies] == [(1, "S1", "N0")]
    assert sorted(c.iso_3166_1 or "" for c in one.production_countries) == ["", "N0"]
    assert next(r for r in found if r.id == 2).genres == []


def test_lines_are_shuffled_before_they_are_collected_and_once(spark, tmp_path, monkeypatch):
    folder = _star(spark, tmp_path)
    monkeypatch.setattr(staging, "SHARE", 100)
    plan = staging.titles_from_star(spark, folder)._jdf.queryExecution().executedPlan().toString()
    by_order = re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L, (\d+)\), (\w+)", plan)
    assert [how for _, how in by_order] == ["REPARTITION_BY_NUM"]
    assert int(by_order[0][0]) > 16  # grows with the files
    assert plan.index("partial_collect_set") < plan.index("REPARTITION_BY_NUM")
