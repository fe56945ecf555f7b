"""From title files to staging table to marts, with a check after every step."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from titlemart.plans import marts
from titlemart.quality.checks import CheckFailed, check_non_empty, check_unique, check_written
from titlemart.schema import titles_schema
from titlemart.session import scratch_scope
from titlemart.sinks.tables import read_table, write_table
from titlemart.sources.load import load_table
from titlemart.sources.sampling import exact_sample, list_files


class Mart(NamedTuple):
    build: Callable[[DataFrame], DataFrame]
    unique_key: str | None = None


# Table names and the checks that follow them.
MARTS = {
    "movies_media": Mart(marts.media, "movie_id"),
    "movies_genres": Mart(marts.genres, "id"),
    "movies_collection_lists": Mart(marts.collection_lists, "collection_id"),
    "movies_most_fav_by_genre": Mart(marts.fav_by_genre),
    "movies_most_fav_per_year": Mart(marts.fav_per_year),
    "movies_popular_movie_by_genre": Mart(marts.popular_by_genre),
    "movies_popular_released_per_year": Mart(marts.popular_per_year),
    "movies_production_countries": Mart(marts.production_countries),
    "movies_spoken_language": Mart(marts.spoken_languages),
    "production_companies_portofolio": Mart(marts.company_portfolio),
}


class Built(NamedTuple):
    name: str
    path: str
    passed: bool
    message: str


def build_marts(
    spark: SparkSession,
    titles: DataFrame,
    root: str,
    names: Iterable[str] | None = None,
    at_once: int = 10,
    raise_on_failure: bool = False,
    written: dict | None = None,
) -> list[Built]:
    """Write the marts below ``root``, replacing those that are there.

    The staging table's key is checked first and stops everything if it fails; so does a table with other rows than
    those ``written`` says (``check_written``).
    Marts do not depend on each other, so several are submitted at a time and
    share the cluster; a failed check does not stop the others. It is reported, or raised
    once all are written with ``raise_on_failure``. A mart's intermediate tables go when it is written.
    ``titles`` should be a stored table: every mart scans the columns it needs, the best-of marts
    together two times if there are several of them.
    """
    check_unique(titles, "id") if written is None else check_written(titles, "id", written)
    chosen = list(names or MARTS)

    several = len(marts.BEST_OF.keys() & chosen) > 1

    def build(name: str) -> Built:
        mart, path = MARTS[name], f"{root.rstrip('/')}/{name}"
        with scratch_scope(spark):
            built = together.result()[name] if several and name in marts.BEST_OF else mart.build(titles)
            write_table(built, path, "WRITE_TRUNCATE")
        table = read_table(spark, path)
        try:
            check_unique(table, mart.unique_key) if mart.unique_key else check_non_empty(table)
        except CheckFailed as failure:
            return Built(name, path, False, str(failure))
        return Built(name, path, True, "")

    with scratch_scope(spark), ThreadPoolExecutor(at_once) as pool:
        if several:  # submitted first, so it never waits for the marts that wait for it
            together = pool.submit(copy_context().run, marts.best_of, titles)
        built = list(pool.map(build, chosen))
    failed = [f"{b.name}: {b.message}" for b in built if not b.passed]
    if failed and raise_on_failure:
        raise CheckFailed("; ".join(failed))
    return built


def load_and_build(
    spark: SparkSession,
    pattern: str,
    root: str,
    n_files: int | None = None,
    seed: str = "0",
    **load_options,
) -> list[Built]:
    """Stage the titles of JSON files and build all marts from them.

    With ``n_files`` a seeded sample of exactly that many files is staged. The
    files are named to the reader, so their names pass through the driver; their
    contents do not. Raises if the load did not read as many files as were chosen, if the staged table has
    lost or doubled a row since it was parsed, or if a mart fails its check.
    """
    chosen = list_files(spark, pattern).select("path")
    if n_files is not None:
        chosen = exact_sample(chosen, "path", n_files, seed)
        paths = [r.path for r in chosen.toLocalIterator()]
        expected = len(paths)
    else:
        paths, expected = pattern, chosen.count()
    staging = f"{root.rstrip('/')}/raw_movies"
    loaded = load_table(
        spark, staging, paths, titles_schema(), "NEWLINE_DELIMITED_JSON",
        write_disposition="WRITE_TRUNCATE", key="id", **load_options,
    )
    if loaded.n_files != expected:
        raise CheckFailed(f"{expected} files chosen, {loaded.n_files} loaded")
    return build_marts(spark, read_table(spark, staging), root, raise_on_failure=True, written=loaded.written)
