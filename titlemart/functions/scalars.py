"""Scalar expressions used by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prefix of every image address.
IMAGE_PREFIX = "https://image.tmdb.org/t/p/original"


def image_url(path: Column) -> Column:
    """Full image address; stays NULL for a NULL path."""
    return F.concat(F.lit(IMAGE_PREFIX), path)


def iso_year(day: Column) -> Column:
    """Year of the ISO week: 2016-01-02 gives 2015, 2018-12-31 gives 2019."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def first_element(array: Column) -> Column:
    """First element, NULL for a NULL or empty array."""
    return F.get(array, F.lit(0))


def cast_cell(cell: Column, kind: str) -> Column:
    """Typed value of a string cell; text that does not fit raises.

    Timestamps are seconds since the epoch and come back as doubles. Booleans
    must be exactly ``true`` or ``false``.
    """
    kind = kind.upper()
    if kind == "INTEGER":
        return cell.cast("bigint")
    if kind in ("FLOAT", "TIMESTAMP"):
        return cell.cast("double")
    if kind == "BOOLEAN":
        complaint = F.concat(F.lit("not a boolean cell: "), cell)
        return (
            F.when(cell.isNull(), F.lit(None).cast("boolean"))
            .when(cell.isin("true", "false"), cell == "true")
            .otherwise(F.raise_error(complaint).cast("boolean"))
        )
    return cell
