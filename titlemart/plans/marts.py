"""The ten ready-made marts; each takes the staging table of titles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlemart.functions.scalars import first_element, image_url, iso_year
from titlemart.operators.arrays import any_element_has, collect_aligned, unnest
from titlemart.operators.topk import top_k_per_group
from titlemart.session import write_shared

COUNTRIES = "production_countries.name"
COMPANIES = "production_companies.name"
GENRES = "genres.name"


def media(titles: DataFrame) -> DataFrame:
    """Image addresses and names per title, in id order.

    The partition number breaks ties, so a repeated id can be split over
    several range partitions of the sort.
    """
    return titles.select(
        F.col("id").alias("movie_id"),
        "imdb_id",
        F.col("title").alias("movie_title"),
        F.col("original_title").alias("orginal_movie_title"),
        image_url(F.col("poster_path")).alias("poster_image_url"),
        image_url(F.col("backdrop_path")).alias("backdrop_image_url"),
        "video",
    ).orderBy(F.col("movie_id").asc_nulls_first(), F.spark_partition_id())


def genres(titles: DataFrame) -> DataFrame:
    return _dimension(titles, "genres", "id", {"id": "id", "name": "name"})


def production_countries(titles: DataFrame) -> DataFrame:
    columns = {"country_name": "name", "country_code": "iso_3166_1"}
    return _dimension(titles, "production_countries", "iso_3166_1", columns)


def spoken_languages(titles: DataFrame) -> DataFrame:
    columns = {"name": "name", "iso_639_1": "iso_639_1"}
    return _dimension(titles, "spoken_languages", "iso_639_1", columns)


def collection_lists(titles: DataFrame, form: str = "list") -> DataFrame:
    """Collections with the ids and names of their titles, aligned, in id order.

    ``form="rows"`` gives a row per collection and title instead of lists.
    """
    members = unnest(
        titles, "belongs_to_collection", "c", [F.col("id").alias("movie_id")]
    ).select(
        F.col("c.id").alias("collection_id"),
        F.col("c.name").alias("collection_name"),
        "movie_id",
        image_url(F.col("c.poster_path")).alias("poster_image_url"),
        image_url(F.col("c.backdrop_path")).alias("backdrop_image_url"),
    ).distinct()
    names = titles.select(F.col("id").alias("movie_id"), "title").distinct()
    keys = ["collection_id", "collection_name", "poster_image_url", "backdrop_image_url"]
    lists = collect_aligned(
        members.join(names, "movie_id", "left"),
        keys,
        {"movie_id": "movie_id", "movie_title": "title"},
        form,
    )
    return lists.select(*keys[:2], "movie_id", "movie_title", *keys[2:])


def fav_by_genre(titles: DataFrame) -> DataFrame:
    """Title with the highest vote average of every genre."""
    best = _best_of_genre(titles, "vote_average", "movie_vote_avg")
    attributes = {"movie_title": F.col("title"), "year": _YEAR(), "vote_count": F.col("vote_count")}
    found = _with_attributes(titles, best, attributes, _BY_GENRE_LISTS)
    return found.select(
        "genres", "movie_title", "movie_id", "year",
        first_element(F.col("movie_country")).alias("movie_country"),
        "movie_vote_avg", "vote_count",
    ).orderBy(F.col("movie_id").desc_nulls_last())


def popular_by_genre(titles: DataFrame) -> DataFrame:
    """Title with the highest popularity of every genre."""
    best = _best_of_genre(titles, "popularity", "movie_popularity")
    attributes = {"movie_title": F.col("title"), "year": _YEAR()}
    found = _with_attributes(titles, best, attributes, _BY_GENRE_LISTS)
    return found.select(
        "genres", "movie_title", "movie_id", "year",
        first_element(F.col("movie_country")).alias("movie_country"),
        "movie_popularity",
    ).orderBy(F.col("movie_id").desc_nulls_last())


def fav_per_year(titles: DataFrame) -> DataFrame:
    """Released title with the highest vote average of every ISO year."""
    best = _best_of_year(titles, "vote_average", "movie_vote_avg")
    found = _with_attributes(titles, best, _year_attributes(), _PER_YEAR_LISTS)
    return found.select(
        "year", "movie_id", "movie_title", "movie_vote_avg", "vote_count", "release_date",
        *_PER_YEAR_LISTS, "budget", "revenue", "runtime", "overview",
    ).orderBy(F.col("year").desc_nulls_last())


def popular_per_year(titles: DataFrame) -> DataFrame:
    """Released title with the highest popularity of every ISO year."""
    best = _best_of_year(titles, "popularity", "movie_popularity")
    found = _with_attributes(titles, best, _year_attributes(), _PER_YEAR_LISTS)
    return found.select(
        "year", "movie_id", "movie_title", "movie_popularity", "release_date",
        *_PER_YEAR_LISTS, "budget", "revenue", "runtime", "overview",
        "vote_average", "vote_count",
    ).orderBy(F.col("year").desc_nulls_last())


# Mart, kind of group, value and its column; then the columns of the result.
BEST_OF = {
    "movies_most_fav_by_genre": ("genre", "vote_average", "movie_vote_avg"),
    "movies_popular_movie_by_genre": ("genre", "popularity", "movie_popularity"),
    "movies_most_fav_per_year": ("year", "vote_average", "movie_vote_avg"),
    "movies_popular_released_per_year": ("year", "popularity", "movie_popularity"),
}


def best_of(titles: DataFrame) -> dict[str, DataFrame]:
    """The four best-of marts by name, out of two scans of ``titles`` instead of two for each.

    Rows equal those of ``fav_by_genre``, ``popular_by_genre``, ``fav_per_year`` and ``popular_per_year``.
    One narrow pass finds the winners by both values of every genre and year, one wide pass the
    attributes and lists of the winners' ids; both are stored and small.
    """
    best = write_shared(winners(titles), "winners")
    found = write_shared(winner_details(titles, best), "details")
    built = {}
    for name, (kind, value, column) in BEST_OF.items():
        attributes = _BEST_COLUMNS[name]
        lists = _BY_GENRE_LISTS if kind == "genre" else _PER_YEAR_LISTS
        group = F.col("group_genre").alias("genres") if kind == "genre" else F.col("group_year").alias("year")
        chosen = best.where(F.col("kind") == kind).select(
            group, F.col(f"{value}_best")["id"].alias("movie_id"), F.col(f"{value}_best")["value"].alias(column)
        )

        def wanted(row: Column) -> Column:
            return F.struct(*[row[a].alias(a) for a in _BEST_COLUMNS[name]])

        rows = found.select(
            "movie_id", F.explode(F.array_distinct(F.transform("rows", wanted))).alias("row"),
            *[F.col(f"{kind}_{out}").alias(out) for out in lists],
        ).select("movie_id", "row.*", *lists)
        joined = chosen.join(rows, "movie_id", "left")
        if kind == "genre":
            joined = joined.select(
                "genres", "movie_title", "movie_id", "year",
                first_element(F.col("movie_country")).alias("movie_country"),
                column, *attributes[2:],
            ).orderBy(F.col("movie_id").desc_nulls_last())
        else:
            joined = joined.select(
                "year", "movie_id", "movie_title", column,
                *(["vote_count"] if value == "vote_average" else []), "release_date",
                *lists, "budget", "revenue", "runtime", "overview",
                *(["vote_average", "vote_count"] if value == "popularity" else []),
            ).orderBy(F.col("year").desc_nulls_last())
        built[name] = joined
    return built


def winners(titles: DataFrame) -> DataFrame:
    """The best title by vote average and by popularity of every genre and every ISO year of released titles.

    ``kind, group_genre, group_year`` and per value a struct of value and id. One scan: a title becomes
    a row per group it belongs to, and maxima of structs (NULL is least, then the highest id) are
    combined on the map side, so a group of any size shuffles one row per task.
    """
    year = F.when(F.col("status") == "Released", _YEAR())
    no_genre, no_year = F.lit(None).cast("string"), F.lit(None).cast("int")

    def group(kind: str, genre: Column, of_year: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), genre.alias("group_genre"), of_year.cast("int").alias("group_year"))

    genres_of = F.transform(F.coalesce(GENRES, F.array()), lambda g: group("genre", g, no_year))
    year_of = F.filter(F.array(group("year", no_genre, year)), lambda g: g["group_year"].isNotNull())
    members = titles.select(F.explode(F.concat(genres_of, year_of)).alias("g"), "id", *_VALUES).select("g.*", "id", *_VALUES)
    best = [F.max(F.struct(F.col(v).alias("value"), "id")).alias(f"{v}_best") for v in _VALUES]
    return members.groupBy("kind", "group_genre", "group_year").agg(*best)


def winner_details(titles: DataFrame, best: DataFrame) -> DataFrame:
    """Distinct attribute rows and name lists of the ids in ``best``, from one scan of ``titles``.

    The lists are those of the genre marts and of the year marts, which differ in the arrays that must not be empty.
    """
    ids = best.select(F.explode(F.array(*[F.col(f"{v}_best")["id"] for v in _VALUES])).alias("__id"))
    ids = ids.where(F.col("__id").isNotNull()).distinct()
    detail = titles.join(ids, F.col("id") == F.col("__id"), "left_semi")
    rows = F.struct(F.col("title").alias("movie_title"), _YEAR().alias("year"), *_PLAIN)
    lists = {"genre": _BY_GENRE_LISTS, "year": _PER_YEAR_LISTS}
    return detail.groupBy(F.col("id").alias("movie_id")).agg(
        F.collect_set(rows).alias("rows"),
        *[c.alias(f"{kind}_{out}") for kind, of in lists.items() for out, c in _name_lists(of).items()],
    )


def company_portfolio(titles: DataFrame, genre_form: str = "list") -> DataFrame:
    """Totals and genres per company, over the product companies x genres.

    As the product repeats a title once per genre, so do its count, revenue
    and budget. Rows are first combined per company and genre, which leaves a
    hot company as many rows as it has genres; only then are lists made. The
    caller chooses the form of ``ph_movie``: ``"list"`` repeats a genre once per title,
    which is one row's value and has to fit in a task; ``"counts"`` gives each genre once
    with its count, at any size; ``"rows"`` gives a row per company and genre, with
    the totals of that genre.
    """
    if genre_form not in ("list", "counts", "rows"):
        raise ValueError("genre_form is 'list', 'counts' or 'rows'")
    company = ["ph_id", "ph_name", "ph_country"]
    product = titles.select(
        "id", "popularity", "revenue", "budget",
        F.col(GENRES).alias("names"), F.explode("production_companies").alias("c"),
    ).select(
        F.col("c.id").alias("ph_id"),
        F.col("c.name").alias("ph_name"),
        F.col("c.origin_country").alias("ph_country"),
        "id", "popularity", "revenue", "budget", F.explode("names").alias("genres"),
    )
    per_genre = product.groupBy(*company, "genres").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("id").alias("n_id"),
        F.sum("popularity").alias("score"),
        F.count("popularity").alias("n_score"),
        F.sum("revenue").alias("revenue"),
        F.sum("budget").alias("budget"),
    )
    if genre_form == "rows":
        return per_genre.select(
            *company, "genres", F.col("n_id").alias("ph_total_movie"),
            F.col("revenue").alias("ph_total_revenue"), F.col("budget").alias("ph_total_budget"),
        )
    portfolio = per_genre.groupBy(*company).agg(
        F.sort_array(F.collect_list(F.struct("genres", "n"))).alias("ph_movie"),
        F.sum("n_id").alias("ph_total_movie"),
        (F.sum("score").cast("double") / F.sum("n_score")).alias("average_popularity_movie_score"),
        F.sum("revenue").alias("ph_total_revenue"),
        F.sum("budget").alias("ph_total_budget"),
    )
    ordered = portfolio.orderBy(
        F.col("average_popularity_movie_score").desc_nulls_last(), F.col("ph_id")
    )
    if genre_form == "counts":
        return ordered

    # Repeats are made after the sort, which so moves each genre once per row.
    def repeats(e: Column) -> Column:
        return F.array_repeat(F.struct(e["genres"].alias("genres")), e["n"].cast("int"))

    return ordered.withColumn("ph_movie", F.flatten(F.transform("ph_movie", repeats)))


def company_portfolio_dedup(titles: DataFrame) -> DataFrame:
    """The portfolio with every title counted once, whatever its genres."""
    company = ["ph_id", "ph_name", "ph_country"]
    per_title = titles.where(F.size(GENRES) > 0).select(
        "id", "popularity", "revenue", "budget",
        F.explode(F.array_distinct(F.transform(
            "production_companies",
            lambda c: F.struct(
                c["id"].alias("ph_id"), c["name"].alias("ph_name"),
                c["origin_country"].alias("ph_country"),
            ),
        ))).alias("c"),
    ).select("c.*", "id", "popularity", "revenue", "budget").distinct()
    totals = per_title.groupBy(*company).agg(
        F.countDistinct("id").alias("ph_total_movie"),
        (F.sum("popularity").cast("double") / F.count("popularity")).alias(
            "average_popularity_movie_score"
        ),
        F.sum("revenue").alias("ph_total_revenue"),
        F.sum("budget").alias("ph_total_budget"),
    )
    return totals.orderBy(F.col("average_popularity_movie_score").desc_nulls_last(), "ph_id")


_BY_GENRE_LISTS = {"movie_country": COUNTRIES, "ph_name": COMPANIES}
_PER_YEAR_LISTS = {"movie_country": COUNTRIES, "genre_name": GENRES, "ph_name": COMPANIES}


def _YEAR() -> Column:
    return iso_year(F.col("release_date"))


_VALUES = ["vote_average", "popularity"]
_PLAIN = [
    "original_language", "budget", "revenue", "runtime", "overview",
    "vote_average", "vote_count", "release_date",
]
_BEST_COLUMNS = {
    "movies_most_fav_by_genre": ["movie_title", "year", "vote_count"],
    "movies_popular_movie_by_genre": ["movie_title", "year"],
    "movies_most_fav_per_year": ["movie_title", *_PLAIN],
    "movies_popular_released_per_year": ["movie_title", *_PLAIN],
}


def _year_attributes() -> dict[str, Column]:
    return {"movie_title": F.col("title"), **{c: F.col(c) for c in _PLAIN}}


def _dimension(
    titles: DataFrame, array: str, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Distinct elements of an array, from rows with at least one non-null key."""
    entries = unnest(titles.where(any_element_has(array, key)), array, "e")
    renamed = entries.select(*[F.col(f"e.{f}").alias(out) for out, f in columns.items()])
    order = next(out for out, f in columns.items() if f == key)
    return renamed.distinct().orderBy(F.col(order).asc_nulls_first())


def _best_of_genre(titles: DataFrame, value: str, out: str) -> DataFrame:
    # explode(genres.name), not genres: the scan then reads the name only.
    scored = titles.select(
        F.explode("genres.name").alias("genres"),
        F.col("id").alias("movie_id"),
        F.col(value).alias(out),
    )
    return top_k_per_group(scored, ["genres"], out, ["movie_id"])


def _best_of_year(titles: DataFrame, value: str, out: str) -> DataFrame:
    # With one winner per year, equal rows need no distinct before the ranking.
    scored = titles.where(F.col("status") == "Released").select(
        _YEAR().alias("year"), F.col("id").alias("movie_id"), F.col(value).alias(out)
    )
    return top_k_per_group(scored.where(F.col("year").isNotNull()), ["year"], out, ["movie_id"])


def _with_attributes(
    titles: DataFrame,
    best: DataFrame,
    attributes: Mapping[str, Column],
    lists: Mapping[str, str],
) -> DataFrame:
    """Left-join attributes and name lists to the winners, by title id.

    Winners come first and attributes are fetched for them only: the wide scan
    is cut by a semi-join on the winners' ids. The winners are a written table,
    so Catalyst knows their size and broadcasts them when small, or shuffles.
    An id with several distinct attribute rows gives several result rows. Their
    attributes and lists come out of one aggregation per id; a list counts the
    rows in which no list is empty, as the product of the arrays does.
    """
    best = write_shared(best, "winners")
    ids = best.select(F.col("movie_id").alias("__id")).where(F.col("__id").isNotNull())
    detail = titles.join(ids, F.col("id") == F.col("__id"), "left_semi")
    found = detail.groupBy(F.col("id").alias("movie_id")).agg(
        F.collect_set(F.struct(*[c.alias(out) for out, c in attributes.items()])).alias("__rows"),
        *[c.alias(out) for out, c in _name_lists(lists).items()],
    )
    found = found.select("movie_id", F.explode("__rows").alias("__row"), *lists)
    return best.join(found.select("movie_id", "__row.*", *lists), "movie_id", "left")


def _name_lists(lists: Mapping[str, str]) -> dict[str, Column]:
    """Aggregates of the distinct names of each array, over the rows in which none of ``lists`` is empty."""
    filled = F.lit(True)
    for path in lists.values():
        filled = filled & (F.size(F.col(path)) > 0)

    def names(path: str) -> Column:
        wrapped = F.transform(F.col(path), lambda v: F.struct(v.alias("v")))
        distinct = F.array_distinct(F.flatten(F.collect_set(F.when(filled, wrapped))))
        return F.when(F.max(filled), F.sort_array(F.transform(distinct, lambda s: s["v"])))

    return {out: names(path) for out, path in lists.items()}
