"""Paged reads of a table in a stated order."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlemart.session import scratch_scope, write_shared

SMALL_PAGE = 10_000  # rows that one task may put together; a larger page is read between two keys


def read_page(
    df: DataFrame,
    key: str,
    max_results: int | None = None,
    selected_fields: str | Sequence[str] | None = None,
    page_token: Any = None,
    start_index: int = 0,
) -> DataFrame:
    """One page in order of a unique key; ``selected_fields`` may be one text
    with commas.

    ``page_token`` is the last key of the page before; the scan then prunes by
    ``key > token``. ``start_index`` counts rows from the beginning: the key at that
    place is looked up first, and the page is read from that key on, so no task
    ever skips rows. A page of over ``SMALL_PAGE`` rows ends at a key that is looked up with the
    first one, so it is a range of the table, sorted by ranges, and no task holds it whole.
    Without ``max_results`` the rest comes as a range-sorted whole.
    """
    if page_token is not None:
        df = df.where(F.col(key) > page_token)
    large = max_results is not None and max_results > SMALL_PAGE
    places = {start_index} if start_index > 0 else set()
    if large:
        places.add(start_index + max_results)
    if places:
        found = _keys_at(df, key, sorted(places))
        if start_index > 0:
            df = df.where(_from(key, found[start_index]) if start_index in found else F.lit(False))
        if large and start_index + max_results in found:
            df = df.where(~_from(key, found[start_index + max_results]))
    page = df.orderBy(F.col(key).asc_nulls_first())
    if max_results is not None and not large:
        page = page.limit(max_results)
    if isinstance(selected_fields, str):
        selected_fields = [f.strip() for f in selected_fields.split(",")]
    return page.select(*(selected_fields or df.columns))


def _from(key: str, value: Any) -> Column:
    """Condition for the rows that do not come before ``value``, NULL being first."""
    return F.lit(True) if value is None else F.col(key).isNotNull() & (F.col(key) >= F.lit(value))


def _keys_at(df: DataFrame, key: str, places: Sequence[int]) -> dict[int, Any]:
    """The key at each of the ascending ``places`` that the table has.

    The keys alone are sorted into files by range. Their row counts, one per file, show
    in which file a place lies, and its number there is a filter on the row index.
    """
    spark = df.sparkSession
    order = F.col(key).asc_nulls_first()
    found, before = {}, 0
    with scratch_scope(spark):
        keys = write_shared(df.select(key).repartitionByRange(order).sortWithinPartitions(order), "keys")
        placed = keys.select(key, "_metadata.file_path", "_metadata.row_index")
        files = placed.groupBy("file_path").agg(
            F.count("*").alias("n"), F.min(F.struct(F.col(key).isNotNull(), key)).alias("first")
        )
        for row in files.orderBy("first").toLocalIterator():
            for place in (p for p in places if before <= p < before + row.n):
                here = (F.col("file_path") == row.file_path) & (F.col("row_index") == place - before)
                found[place] = placed.where(here).first()[key]
            before += row.n
            if before > places[-1]:
                break
    return found
