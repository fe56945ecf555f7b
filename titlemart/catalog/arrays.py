"""Unnesting, collecting, ranking and joining on the nested titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from titlemart.catalog.flat import FLAT
from titlemart.functions import first_element, iso_year
from titlemart.operators import (
    any_element_has,
    collect_aligned,
    collect_distinct,
    distinct_lists,
    reconcile,
    same_count,
    top_k_lists,
    top_k_per_group,
    unnest,
    unnest_product,
    unnest_structs,
)
from titlemart.operators.topk import GROUP_LIMIT
from titlemart.plans.staging import staged_titles, star_table

LISTS = {
    "countries": "production_countries.name",
    "genre_names": "genres.name",
    "companies": "production_companies.name",
}


def _scored(spark, sf_dir):
    return staged_titles(spark, sf_dir).select(
        F.explode("genres.name").alias("genres"), F.col("id").alias("movie_id"), "popularity"
    )


def unnest_languages(spark, sf_dir):
    languages = unnest(staged_titles(spark, sf_dir), "spoken_languages", "l", ["id"])
    return languages.select("id", F.col("l.iso_639_1").alias("code"), F.col("l.name").alias("name"))


def array_exists_filter(spark, sf_dir):
    titles = staged_titles(spark, sf_dir)
    return titles.where(any_element_has("genres", "id")).select("id", "title")


def two_array_product(spark, sf_dir):
    product = unnest_product(
        staged_titles(spark, sf_dir), {"c": "production_companies", "g": "genres"}, ["id"]
    )
    return product.groupBy(F.col("c.name").alias("company"), F.col("g.name").alias("genre")).agg(
        F.count("id").alias("n")
    )


def three_array_product(spark, sf_dir):
    arrays = {"k": "production_countries", "g": "genres", "c": "production_companies"}
    product = unnest_product(staged_titles(spark, sf_dir), arrays, ["id"])
    return product.groupBy(F.col("k.name").alias("country")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_titles")
    )


def top_k(spark, sf_dir):
    return top_k_per_group(
        _scored(spark, sf_dir), ["genres"], "popularity", ["movie_id"], k=3, rank="place"
    )


def top_k_many(spark, sf_dir):
    titles = staged_titles(spark, sf_dir).select("status", "id", "vote_average")
    return top_k_per_group(titles, ["status"], "vote_average", ["id"], k=200)


def top_k_array(spark, sf_dir):
    best = top_k_lists(
        _scored(spark, sf_dir), ["genres"], "popularity", ["movie_id"], ["movie_id", "popularity"], k=3
    )
    return best.select("genres", F.array_join("best.movie_id", ",").alias("movie_ids"))


def unnest_topk(spark, sf_dir):
    best = top_k_lists(
        _scored(spark, sf_dir), ["genres"], "popularity", ["movie_id"], ["movie_id", "popularity"], k=3
    )
    return unnest_structs(best, "best", ["genres"])


def distinct_values_keep_nulls(spark, sf_dir):
    ids = staged_titles(spark, sf_dir).select("status", F.explode("genres.id").alias("genre_id"))
    lists = ids.groupBy("status").agg(collect_distinct(F.col("genre_id")).alias("ids"))
    return lists.select(
        "status",
        first_element(F.col("ids")).isNull().alias("first_is_null"),
        F.array_join(F.col("ids").cast("array<string>"), ",", "-").alias("genre_ids"),
    )


def distinct_lists_per_title(spark, sf_dir):
    lists = distinct_lists(staged_titles(spark, sf_dir), "id", LISTS)
    return lists.select("id", *[F.array_join(c, ",").alias(c) for c in LISTS])


def aligned_lists(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    lists = collect_aligned(orders, ["o_custkey"], {"orders": "o_orderkey", "states": "status"})
    return lists.select(
        "o_custkey", F.array_join("orders", ",").alias("orders"),
        F.array_join("states", ",", "-").alias("states"),
    )


def aligned_rows(spark, sf_dir):
    orders = star_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return collect_aligned(orders, ["o_custkey"], {"order_id": "o_orderkey", "state": "status"}, "rows")


def top_k_5000(spark, sf_dir):
    """More per group than Spark limits on the map side unless it is told to."""
    spark.conf.set(GROUP_LIMIT, "5000")
    lines = star_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return top_k_per_group(lines, ["l_returnflag"], "l_extendedprice", ["l_orderkey", "l_linenumber"], k=5000)


def top_k_any(spark, sf_dir):
    """A k beyond any limit of Spark's, over a group with half of the rows."""
    lines = star_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    allowed = spark.conf.get(GROUP_LIMIT)
    spark.conf.set(GROUP_LIMIT, "1000")
    try:
        return top_k_per_group(lines, ["l_returnflag"], "l_quantity", ["l_orderkey", "l_linenumber"], k=2500, rank="place")
    finally:
        spark.conf.set(GROUP_LIMIT, allowed)


def iso_year_counts(spark, sf_dir):
    return staged_titles(spark, sf_dir).groupBy(iso_year(F.col("release_date")).alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("vote_average").alias("n_rated")
    )


def genre_totals(spark, sf_dir):
    rows = staged_titles(spark, sf_dir).select(
        F.explode("genres.id").alias("genre_id"), "id", "revenue", "vote_average",
        F.col("popularity").cast("decimal(18,2)").alias("popularity"),
    )
    return rows.groupBy("genre_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("id").alias("n_titles"),
        F.sum("revenue").alias("revenue"),
        (F.sum("popularity").cast("double") / F.count("popularity")).alias("avg_popularity"),
        F.max("vote_average").alias("best_vote"),
    )


def left_join_attrs(spark, sf_dir):
    titles = staged_titles(spark, sf_dir)
    companies = titles.select("id", F.explode("production_companies.name").alias("company"))
    names = titles.where(any_element_has("genres", "id")).select("id", "title", "status").distinct()
    return companies.join(names, "id", "left").select("id", "company", "title", "status")


def recon_full_outer(spark, sf_dir):
    lines = star_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    orders = star_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    return reconcile(orders, lines, "order_id").select("order_id", "side", F.col("rows").alias("n"))


def recon_counts(spark, sf_dir):
    """Orders against titles, which agree, and against orders with lines, which do not."""
    orders, lines = (star_table(spark, sf_dir, n) for n in ("orders", "lineitem"))
    with_lines = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_semi")
    titles = same_count(orders, staged_titles(spark, sf_dir)).withColumn("target", F.lit("titles"))
    return titles.unionByName(same_count(orders, with_lines).withColumn("target", F.lit("orders with lines")))


QUERIES = {
    "unnest_single": unnest_languages,
    "array_exists_filter": array_exists_filter,
    "two_array_product": two_array_product,
    "three_array_product": three_array_product,
    "top_k_per_group": top_k,
    "top_k_large": top_k_many,
    "top_k_array": top_k_array,
    "unnest_topk": unnest_topk,
    "distinct_values_keep_nulls": distinct_values_keep_nulls,
    "distinct_lists": distinct_lists_per_title,
    "aligned_lists": aligned_lists,
    "aligned_rows": aligned_rows,
    "top_k_5000": top_k_5000,
    "top_k_any": top_k_any,
    "iso_year_counts": iso_year_counts,
    "genre_totals": genre_totals,
    "left_join_attrs": left_join_attrs,
    "recon_full_outer": recon_full_outer,
    "recon_counts": recon_counts,
}

_RANKED = """, ranked AS (
  SELECT genre AS genres, id AS movie_id, popularity, CAST(row_number() OVER (
    PARTITION BY genre ORDER BY popularity DESC NULLS LAST, id DESC) AS INTEGER) AS place
  FROM title JOIN genre USING (id)
)"""

ORACLES = {
    "unnest_single": FLAT + """
SELECT l.id, language_code AS code, language AS name FROM language l JOIN title USING (id)""",
    "array_exists_filter": FLAT + """
SELECT id, title FROM title
WHERE EXISTS (SELECT 1 FROM genre g WHERE g.id = title.id AND genre_id IS NOT NULL)""",
    "two_array_product": FLAT + """
SELECT company, genre, count(id) AS n
FROM title JOIN company USING (id) JOIN genre USING (id) GROUP BY company, genre""",
    "three_array_product": FLAT + """
SELECT country, count(*) AS n, count(DISTINCT id) AS n_titles
FROM title JOIN country USING (id) JOIN genre USING (id) JOIN company USING (id) GROUP BY country""",
    "top_k_per_group": FLAT + _RANKED + """
SELECT genres, movie_id, popularity, place FROM ranked WHERE place <= 3""",
    "top_k_large": FLAT + """, ranked AS (
  SELECT status, id, vote_average, row_number() OVER (
    PARTITION BY status ORDER BY vote_average DESC NULLS LAST, id DESC) AS place FROM title
)
SELECT status, id, vote_average FROM ranked WHERE place <= 200""",
    "top_k_array": FLAT + _RANKED + """
SELECT genres, string_agg(CAST(movie_id AS VARCHAR), ',' ORDER BY place) AS movie_ids
FROM ranked WHERE place <= 3 GROUP BY genres""",
    "unnest_topk": FLAT + _RANKED + """
SELECT genres, movie_id, popularity FROM ranked WHERE place <= 3""",
    "distinct_values_keep_nulls": FLAT + """
SELECT status, bool_or(genre_id IS NULL) AS first_is_null,
       string_agg(DISTINCT coalesce(CAST(genre_id AS VARCHAR), '-'), ','
                  ORDER BY coalesce(CAST(genre_id AS VARCHAR), '-')) AS genre_ids
FROM title JOIN genre USING (id) GROUP BY status""",
    "distinct_lists": FLAT + """
SELECT id, string_agg(DISTINCT country, ',' ORDER BY country) AS countries,
       string_agg(DISTINCT genre, ',' ORDER BY genre) AS genre_names,
       string_agg(DISTINCT company, ',' ORDER BY company) AS companies
FROM title JOIN country USING (id) JOIN genre USING (id) JOIN company USING (id) GROUP BY id""",
    "aligned_lists": """
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS orders,
       string_agg(CASE WHEN o_orderstatus = 'P' THEN '-' ELSE o_orderstatus END, ','
                  ORDER BY o_orderkey) AS states
FROM orders GROUP BY o_custkey""",
    "iso_year_counts": FLAT + """
SELECT CAST(isoyear(release_date) AS INTEGER) AS year, count(*) AS n,
       count(vote_average) AS n_rated FROM title GROUP BY 1""",
    "genre_totals": FLAT + """
SELECT genre_id, count(*) AS n, count(DISTINCT id) AS n_titles,
       CAST(sum(revenue) AS BIGINT) AS revenue,
       CAST(sum(CAST(popularity AS DECIMAL(18,2))) AS DOUBLE) / count(popularity) AS avg_popularity,
       max(vote_average) AS best_vote
FROM title JOIN genre USING (id) GROUP BY genre_id""",
    "left_join_attrs": FLAT + """
SELECT c.id, company, n.title, n.status
FROM company c JOIN title USING (id)
LEFT JOIN (SELECT id, title, status FROM title
           WHERE id IN (SELECT id FROM genre WHERE genre_id IS NOT NULL)) n ON c.id = n.id""",
    "recon_full_outer": """
SELECT coalesce(o_orderkey, l_orderkey) AS order_id,
       CASE WHEN l_orderkey IS NULL THEN 'missing' ELSE 'extra' END AS side,
       coalesce(o.n, l.n) AS n
FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1) o
FULL JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey
WHERE o_orderkey IS NULL OR l_orderkey IS NULL""",
    "aligned_rows": """
SELECT o_custkey, o_orderkey AS order_id, nullif(o_orderstatus, 'P') AS state FROM orders""",
    "top_k_5000": """
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC) <= 5000""",
    "top_k_any": """
SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity, CAST(row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_quantity DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC) AS INTEGER) AS place
FROM lineitem QUALIFY place <= 2500""",
    "recon_counts": """
SELECT count(*) AS source_rows, count(*) AS target_rows, true AS agree, 'titles' AS target FROM orders
UNION ALL
SELECT count(*), count(*) FILTER (l), count(*) = count(*) FILTER (l), 'orders with lines'
FROM (SELECT o_orderkey IN (SELECT l_orderkey FROM lineitem) AS l FROM orders)""",
}
