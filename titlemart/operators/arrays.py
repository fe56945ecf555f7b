"""Flattening and collecting arrays of structs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_element_has(array: str, field: str) -> Column:
    """True if any element of the row's own array has a non-null field."""
    return F.exists(array, lambda e: e[field].isNotNull())


def unnest(df: DataFrame, array: str, alias: str, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Inner unnest: rows whose array is NULL or empty give no row."""
    return df.select(*keep, F.explode(array).alias(alias))


def unnest_product(
    df: DataFrame, arrays: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Per-row product of sibling arrays, ``{alias: array}``.

    Empty siblings drop the row before the first explode, not after it.
    """
    live = df.where(_all_filled(list(arrays.values())))
    for alias, array in arrays.items():
        live = live.withColumn(f"__{alias}", F.explode(array))
    return live.select(*keep, *[F.col(f"__{a}").alias(a) for a in arrays])


def unnest_structs(df: DataFrame, array: str, keep: Sequence[str] = ()) -> DataFrame:
    """Unnest an array of structs straight into its fields."""
    return df.select(*keep, F.inline(array))


def collect_distinct(value: Column) -> Column:
    """Aggregate: sorted distinct values, with NULL kept as an element.

    ``collect_set`` drops NULLs, so values travel inside a struct. It combines
    on the map side, so what is shuffled per task is at most the output list.
    """
    return F.sort_array(
        F.transform(F.collect_set(F.struct(value.alias("v"))), lambda s: s["v"])
    )


def distinct_lists(df: DataFrame, key: str, arrays: Mapping[str, str]) -> DataFrame:
    """Distinct values of several sibling arrays per key, ``{output: array}``.

    An array may be a field of an array of structs, as ``genres.name``. Equal
    to collecting distinct values over the product of the arrays: a row counts
    only if none of them is empty, and each list keeps NULL elements. The
    product itself is never made; the arrays are laid end to end and exploded
    once, which is linear in their sizes.
    """
    tagged = [
        F.transform(F.array_distinct(F.col(array)), _tag(out)) for out, array in arrays.items()
    ]
    rows = df.where(_all_filled(list(arrays.values()))).select(
        key, F.explode(F.concat(*tagged)).alias("e")
    )
    lists = [
        F.sort_array(
            F.transform(
                F.collect_set(F.when(F.col("e.kind") == out, F.struct("e.v"))),
                lambda s: s["v"],
            )
        ).alias(out)
        for out in arrays
    ]
    return rows.groupBy(key).agg(*lists)


def collect_aligned(
    df: DataFrame, keys: Sequence[str], items: Mapping[str, str], form: str = "list"
) -> DataFrame:
    """Several lists per group, aligned by position and sorted by the first.

    ``items`` maps output columns to value columns. All lists come from one list of
    structs, so NULLs keep their place. The caller chooses the form: ``"list"`` gives
    one row per group, whose lists are one row's value and have to fit in a task;
    ``"rows"`` gives a row per member, without any list or shuffle, for groups of any size.
    """
    if form not in ("list", "rows"):
        raise ValueError("form is 'list' or 'rows'")
    if form == "rows":
        return df.select(*keys, *[F.col(c).alias(out) for out, c in items.items()])
    entries = F.collect_list(F.struct(*[F.col(c).alias(o) for o, c in items.items()]))
    grouped = df.groupBy(*keys).agg(F.sort_array(entries).alias("__e"))
    return grouped.select(*keys, *[F.col(f"__e.{out}").alias(out) for out in items])


def _all_filled(arrays: Sequence[str]) -> Column:
    filled = F.lit(True)
    for array in arrays:
        filled = filled & (F.size(F.col(array)) > 0)
    return filled


def _tag(kind: str) -> Callable[[Column], Column]:
    return lambda value: F.struct(F.lit(kind).alias("kind"), value.alias("v"))
