"""The ten marts and the portfolio variants.

Fixed values: the names of marts and of their columns, two of them misspelt, are part of
the data model and stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemart.catalog.flat import FLAT
from titlemart.plans import build_marts, marts
from titlemart.plans.staging import staged_titles, titles_from_star
from titlemart.session import shared_path
from titlemart.sinks import read_table


def _mart(build, lists: tuple[str, ...] = ()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(staged_titles(spark, sf_dir))
        return out.withColumns({c: F.array_join(F.col(c), ",") for c in lists})

    return run


def _portfolio(build, movies: str | None):
    """Popularity as a decimal, so that its sum does not depend on row order."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        titles = staged_titles(spark, sf_dir)
        out = build(titles.withColumn("popularity", F.col("popularity").cast("decimal(18,2)")))
        if movies:
            out = out.withColumn("ph_movie", F.expr(movies))
        return out

    return run


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles_from_star(spark, sf_dir).select(
        "id", "title", "status", "release_date", "popularity", "vote_average", "vote_count",
        "runtime", "budget", "revenue", "overview", "video", "poster_path",
        F.size("genres").cast("bigint").alias("n_genres"),
        F.size("production_companies").cast("bigint").alias("n_companies"),
        F.size("production_countries").cast("bigint").alias("n_countries"),
        F.size("spoken_languages").cast("bigint").alias("n_languages"),
        F.size("belongs_to_collection").cast("bigint").alias("n_collections"),
    )


# What of each mart enters its content hash.
_CONTENT = {
    "movies_media": ["movie_id", "poster_image_url"],
    "movies_genres": ["id", "name"],
    "movies_collection_lists": ["collection_id", "movie_id"],
    "movies_most_fav_by_genre": ["genres", "movie_id", "movie_country"],
    "movies_most_fav_per_year": ["year", "movie_id", "genre_name", "ph_name"],
    "movies_popular_movie_by_genre": ["genres", "movie_id", "movie_country"],
    "movies_popular_released_per_year": ["year", "movie_id", "genre_name", "ph_name"],
    "movies_production_countries": ["country_code", "country_name"],
    "movies_spoken_language": ["iso_639_1", "name"],
    "production_companies_portofolio": ["ph_id", "ph_total_movie", "ph_movie"],
}


def all_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and check all marts; one row per mart with its size and a hash of its content."""
    titles = staged_titles(spark, sf_dir)
    built = build_marts(spark, titles, shared_path(spark, "marts"))

    def text(table: DataFrame, name: str):
        value = F.col(name)
        if name == "ph_movie":
            value = F.array_join("ph_movie.genres", ",")
        elif table.schema[name].dataType.typeName() == "array":
            value = F.array_join(value.cast("array<string>"), ",")
        return F.coalesce(value.cast("string"), F.lit("-"))

    sizes = []
    for b in built:
        table = read_table(spark, b.path)
        digest = F.md5(F.concat_ws("|", *[text(table, c) for c in _CONTENT[b.name]]))
        sizes.append(table.agg(
            F.lit(b.name).alias("mart"), F.count(F.lit(1)).alias("n"), F.lit(b.passed).alias("passed"),
            F.sum(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")).alias("content"),
        ))
    return reduce(DataFrame.unionByName, sizes)


QUERIES = {
    "staging_titles": staging,
    "media_urls": _mart(marts.media),
    "dim_genres": _mart(marts.genres),
    "dim_countries": _mart(marts.production_countries),
    "dim_languages": _mart(marts.spoken_languages),
    "collection_lists": _mart(marts.collection_lists, ("movie_id", "movie_title")),
    "fav_by_genre": _mart(marts.fav_by_genre),
    "popular_by_genre": _mart(marts.popular_by_genre),
    "fav_per_year": _mart(marts.fav_per_year, ("movie_country", "genre_name", "ph_name")),
    "popular_per_year": _mart(marts.popular_per_year, ("movie_country", "genre_name", "ph_name")),
    "company_portfolio": _portfolio(
        marts.company_portfolio, "array_join(transform(ph_movie, m -> m.genres), ',')"
    ),
    "company_portfolio_counts": _portfolio(
        lambda titles: marts.company_portfolio(titles, "counts"),
        "array_join(transform(ph_movie, m -> concat(m.genres, ':', m.n)), ',')",
    ),
    "company_portfolio_rows": lambda spark, sf_dir: marts.company_portfolio(staged_titles(spark, sf_dir), "rows"),
    "company_portfolio_dedup": _portfolio(marts.company_portfolio_dedup, None),
    "collection_members": lambda spark, sf_dir: marts.collection_lists(staged_titles(spark, sf_dir), "rows"),
    "build_all_marts": all_marts,
}

_URL = "'https://image.tmdb.org/t/p/original' ||"

_BEST_OF_GENRE = """, best AS (
  SELECT genre, t.*, row_number() OVER (
    PARTITION BY genre ORDER BY {value} DESC NULLS LAST, id DESC) AS place
  FROM title t JOIN genre USING (id)
), named AS (
  SELECT c.id, min(country) AS country
  FROM country c JOIN company USING (id) GROUP BY c.id
)
SELECT genre AS genres, title AS movie_title, id AS movie_id,
       CAST(isoyear(release_date) AS INTEGER) AS year, country AS movie_country, {columns}
FROM best LEFT JOIN named USING (id) WHERE place = 1"""

_BEST_OF_YEAR = """, best AS (
  SELECT t.*, CAST(isoyear(release_date) AS INTEGER) AS year, row_number() OVER (
    PARTITION BY isoyear(release_date) ORDER BY {value} DESC NULLS LAST, id DESC) AS place
  FROM title t WHERE status = 'Released' AND release_date IS NOT NULL
), named AS (
  SELECT c.id, string_agg(DISTINCT country, ',' ORDER BY country) AS movie_country,
         string_agg(DISTINCT genre, ',' ORDER BY genre) AS genre_name,
         string_agg(DISTINCT company, ',' ORDER BY company) AS ph_name
  FROM country c JOIN genre USING (id) JOIN company USING (id)
  WHERE c.id IN (SELECT id FROM best WHERE place = 1) GROUP BY c.id
)
SELECT year, id AS movie_id, title AS movie_title, {columns}, vote_count, release_date,
       movie_country, genre_name, ph_name, budget, revenue, runtime, overview
FROM best LEFT JOIN named USING (id) WHERE place = 1"""

_PORTFOLIO = """
SELECT company_id AS ph_id, company AS ph_name, origin AS ph_country, {movies}
       count(id) AS ph_total_movie,
       CAST(sum(CAST(popularity AS DECIMAL(18,2))) AS DOUBLE) / count(popularity)
         AS average_popularity_movie_score,
       CAST(sum(revenue) AS BIGINT) AS ph_total_revenue,
       CAST(sum(budget) AS BIGINT) AS ph_total_budget
FROM title JOIN company USING (id) {genre} GROUP BY ALL"""

ORACLES = {
    "staging_titles": FLAT + """
SELECT t.id, title, status, release_date, popularity, vote_average, vote_count, runtime, budget,
       revenue, overview, video, image_path AS poster_path,
       coalesce(g.n, 0) AS n_genres, coalesce(c.n, 0) AS n_companies,
       coalesce(k.n, 0) AS n_countries, coalesce(s.n, 0) AS n_languages,
       CAST(c_mktsegment <> 'MACHINERY' AS BIGINT) AS n_collections
FROM title t
LEFT JOIN (SELECT id, count(*) AS n FROM genre GROUP BY id) g ON t.id = g.id
LEFT JOIN (SELECT id, count(*) AS n FROM company GROUP BY id) c ON t.id = c.id
LEFT JOIN (SELECT id, count(*) AS n FROM country GROUP BY id) k ON t.id = k.id
LEFT JOIN (SELECT id, count(*) AS n FROM language GROUP BY id) s ON t.id = s.id""",
    "media_urls": FLAT + f"""
SELECT id AS movie_id, 'i' || id AS imdb_id, title AS movie_title, title AS orginal_movie_title,
       {_URL} image_path AS poster_image_url, {_URL} image_path AS backdrop_image_url, video
FROM title""",
    "dim_genres": FLAT + """
SELECT DISTINCT genre_id AS id, genre AS name FROM genre g
WHERE EXISTS (SELECT 1 FROM genre h WHERE h.id = g.id AND h.genre_id IS NOT NULL)""",
    "dim_countries": """
SELECT DISTINCT n_name AS country_name, 'N' || n_nationkey AS country_code
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
    "dim_languages": """
SELECT DISTINCT r_name AS name, CAST(r_regionkey AS VARCHAR) AS iso_639_1
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
    "collection_lists": f"""
SELECT c_custkey AS collection_id, c_name AS collection_name,
       string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS movie_id,
       string_agg('T' || o_orderkey, ',' ORDER BY o_orderkey) AS movie_title,
       CASE WHEN c_nationkey % 5 <> 0 THEN {_URL} '/c' || c_custkey || '.jpg' END AS poster_image_url,
       {_URL} '/c' || c_custkey || '-b.jpg' AS backdrop_image_url
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_custkey, c_name, c_nationkey""",
    "fav_by_genre": FLAT
    + _BEST_OF_GENRE.format(
        value="vote_average", columns="vote_average AS movie_vote_avg, vote_count"
    ),
    "popular_by_genre": FLAT
    + _BEST_OF_GENRE.format(value="popularity", columns="popularity AS movie_popularity"),
    "fav_per_year": FLAT
    + _BEST_OF_YEAR.format(value="vote_average", columns="vote_average AS movie_vote_avg"),
    "popular_per_year": FLAT
    + _BEST_OF_YEAR.format(
        value="popularity", columns="popularity AS movie_popularity, vote_average"
    ),
    "company_portfolio": FLAT
    + _PORTFOLIO.format(
        movies="string_agg(genre, ',' ORDER BY genre) AS ph_movie,", genre="JOIN genre USING (id)"
    ),
    "company_portfolio_counts": FLAT
    + """, entry AS (
  SELECT company_id AS ph_id, genre || ':' || count(*) AS entry
  FROM company JOIN genre USING (id) JOIN title USING (id) GROUP BY company_id, genre
), listed AS (
  SELECT ph_id, string_agg(entry, ',' ORDER BY entry) AS ph_movie FROM entry GROUP BY ph_id
), totals AS (""" + _PORTFOLIO.format(movies="", genre="JOIN genre USING (id)") + """
) SELECT * FROM totals JOIN listed USING (ph_id)""",
    "company_portfolio_dedup": FLAT + _PORTFOLIO.format(movies="", genre=""),
    "company_portfolio_rows": FLAT + """
SELECT company_id AS ph_id, company AS ph_name, origin AS ph_country, genre AS genres,
       count(id) AS ph_total_movie, CAST(sum(revenue) AS BIGINT) AS ph_total_revenue,
       CAST(sum(budget) AS BIGINT) AS ph_total_budget
FROM title JOIN company USING (id) JOIN genre USING (id) GROUP BY ALL""",
    "collection_members": f"""
SELECT c_custkey AS collection_id, c_name AS collection_name, o_orderkey AS movie_id,
       'T' || o_orderkey AS movie_title,
       CASE WHEN c_nationkey % 5 <> 0 THEN {_URL} '/c' || c_custkey || '.jpg' END AS poster_image_url,
       {_URL} '/c' || c_custkey || '-b.jpg' AS backdrop_image_url
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'MACHINERY'""",
}

_FROM = {
    "movies_media": ("media_urls", "count(*) = count(DISTINCT movie_id)"),
    "movies_genres": ("dim_genres", "count(*) = count(DISTINCT id)"),
    "movies_collection_lists": ("collection_lists", "count(*) = count(DISTINCT collection_id)"),
    "movies_most_fav_by_genre": ("fav_by_genre", "count(*) > 0"),
    "movies_most_fav_per_year": ("fav_per_year", "count(*) > 0"),
    "movies_popular_movie_by_genre": ("popular_by_genre", "count(*) > 0"),
    "movies_popular_released_per_year": ("popular_per_year", "count(*) > 0"),
    "movies_production_countries": ("dim_countries", "count(*) > 0"),
    "movies_spoken_language": ("dim_languages", "count(*) > 0"),
    "production_companies_portofolio": ("company_portfolio", "count(*) > 0"),
}


def _content_sql(mart: str) -> str:
    query, passed = _FROM[mart]
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in _CONTENT[mart])
    return f"""
SELECT '{mart}' AS mart, count(*) AS n, {passed} AS passed,
       CAST(sum(('0x' || substr(md5({text}), 1, 8))::BIGINT) AS BIGINT) AS content
FROM ({ORACLES[query]})"""


ORACLES["build_all_marts"] = " UNION ALL ".join(_content_sql(mart) for mart in _FROM)
