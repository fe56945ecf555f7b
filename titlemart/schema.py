"""Typed nested schemas from JSON field lists, and the staging-table schema."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import types as T

# Field type names and the Spark types they stand for.
SCALAR_TYPES = {
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampNTZType(),
}

# The columns of the staging table.
TITLES_DDL = """
    adult boolean,
    backdrop_path string,
    belongs_to_collection array<struct<id: bigint, name: string, poster_path: string, backdrop_path: string>>,
    budget bigint,
    genres array<struct<id: bigint, name: string>>,
    homepage string,
    id bigint,
    imdb_id string,
    original_language string,
    original_title string,
    overview string,
    popularity double,
    poster_path string,
    production_companies array<struct<id: bigint, logo_path: string, name: string, origin_country: string>>,
    production_countries array<struct<iso_3166_1: string, name: string>>,
    release_date date,
    revenue bigint,
    runtime bigint,
    spoken_languages array<struct<iso_639_1: string, name: string>>,
    status string,
    tagline string,
    title string,
    video boolean,
    vote_average double,
    vote_count bigint
"""


def titles_schema() -> T.StructType:
    return T.StructType.fromDDL(TITLES_DDL)


def schema_from_fields(fields: Iterable[Mapping]) -> T.StructType:
    """Field dicts (name, type, mode, fields) to a StructType.

    REQUIRED is kept in the field metadata, since file sources read every
    column as nullable; the table writer enforces it.
    """
    return T.StructType([_field(f) for f in fields])


def schema_from_json(path: str | Path) -> T.StructType:
    return schema_from_fields(json.loads(Path(path).read_text()))


class BadRecordsError(ValueError):
    """More records were rejected than the budget allows."""


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("mode") == "REQUIRED"]


def _field(spec: Mapping) -> T.StructField:
    mode = (spec.get("mode") or "NULLABLE").upper()
    kind = spec["type"].upper()
    if kind in ("RECORD", "STRUCT"):
        dtype: T.DataType = schema_from_fields(spec["fields"])
    elif kind in SCALAR_TYPES:
        dtype = SCALAR_TYPES[kind]
    else:
        raise ValueError(f"unknown field type {spec['type']!r} for {spec['name']!r}")
    if mode == "REPEATED":
        dtype = T.ArrayType(dtype)
    elif mode not in ("NULLABLE", "REQUIRED"):
        raise ValueError(f"unknown field mode {spec['mode']!r} for {spec['name']!r}")
    metadata = {"mode": "REQUIRED"} if mode == "REQUIRED" else {}
    return T.StructField(spec["name"], dtype, mode != "REQUIRED", metadata)
