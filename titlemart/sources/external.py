"""Tables over files that stay where they are."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.schema import BadRecordsError
from titlemart.sources.load import checked, parsed_files

# Format names and the Spark source for each.
SOURCES = {"CSV": "csv", "NEWLINE_DELIMITED_JSON": "json", "PARQUET": "parquet", "AVRO": "avro"}


def create_external_table(
    spark: SparkSession,
    name: str,
    path: str | Sequence[str],
    source_format: str = "CSV",
    schema: T.StructType | Iterable[Mapping] | None = None,
    *,
    autodetect: bool = False,
    compression: str = "NONE",
    max_bad_records: int = 0,
    ignore_unknown_values: bool = False,
    **csv_options,
) -> DataFrame:
    """Register files under a name without moving them, and return them.

    Options are those of a load. Where Spark's own reader is strict in the way asked
    for, the name is a catalog table. A bad-record budget, the unknown-field policy of
    JSON, short rows, further leading rows and several paths need the parsers of a load, so then it
    is a view over them; bad records are counted once, here, and left out when queried.

    Gzip files are recognised by their ``.gz`` suffix. They cannot be split,
    so one file is one task; more files are the way to more parallelism.
    """
    source_format, compression = source_format.upper(), compression.upper()
    if source_format not in SOURCES:
        raise ValueError(f"{source_format} is not one of {', '.join(SOURCES)}")
    if compression not in ("NONE", "GZIP"):
        raise ValueError(f"{compression} is not one of NONE, GZIP")
    schema, source_format = checked(schema, source_format, autodetect, csv_options)
    csv = source_format == "CSV"
    json = source_format == "NEWLINE_DELIMITED_JSON"
    skip = csv_options.get("skip_leading_rows", 0)
    if (
        max_bad_records
        or not isinstance(path, str)
        or csv and (skip > 1 or ignore_unknown_values or csv_options.get("allow_jagged_rows"))
        or json and schema is not None and not ignore_unknown_values
        or not (csv or json) and schema is not None
    ):
        parsed, schema, _ = parsed_files(
            spark, path, schema, source_format, ignore_unknown_values, csv_options, lasting=True
        )
        bad = parsed.where(F.col("_reason").isNotNull()).count()
        if bad > max_bad_records:
            raise BadRecordsError(f"{bad} bad records, {max_bad_records} allowed")
        parsed.where(F.col("_reason").isNull()).select(*schema.names).createOrReplaceTempView(name)
        return spark.table(name)
    options = {}
    if csv:
        quote = csv_options.get("quote")
        options = {
            "sep": csv_options.get("field_delimiter", ","),
            "quote": '"' if quote is None else quote,
            "escape": '"' if quote is None else (quote or "\\"),
            "header": str(skip == 1),
            "multiLine": str(csv_options.get("allow_quoted_newlines", False)),
            "encoding": csv_options.get("encoding", "UTF-8"),
            "nullValue": csv_options.get("null_marker", ""),
            "mode": "FAILFAST",
        }
        if schema is None:
            options["inferSchema"] = "true"
    elif json:
        options = {"mode": "FAILFAST"}
    return spark.catalog.createTable(
        name, path=path, source=SOURCES[source_format], schema=schema, **options
    )
