"""Load files into rows or into a table under explicit policies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.schema import BadRecordsError, schema_from_fields
from titlemart.session import shared_path
from titlemart.sinks.tables import BAD, check_write_options, read_refused, read_table, write_parsed
from titlemart.sources.quoted import decoded
from titlemart.sources.parsing import parse_csv, parse_json_lines, parse_typed, skip_first_rows

FORMATS = ("CSV", "NEWLINE_DELIMITED_JSON", "PARQUET", "AVRO")
CSV_ONLY = ("field_delimiter", "quote", "skip_leading_rows", "allow_quoted_newlines",
            "allow_jagged_rows", "encoding", "null_marker")
UNREAD = "__unread_record"


class Loaded(NamedTuple):
    rows: DataFrame
    rejected: DataFrame
    rejected_count: int
    n_files: int
    written: dict = {}  # the ``fingerprint`` of what was written


def load_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | Iterable[Mapping] | None = None,
    source_format: str = "CSV",
    *,
    autodetect: bool = False,
    max_bad_records: int = 0,
    ignore_unknown_values: bool = False,
    **csv_options,
) -> Loaded:
    """Read files under a schema, or one that is detected.

    The text is parsed once, into a written table split into accepted and
    rejected records. The rejected ones are counted there and compared with
    the budget; they stay readable as ``rejected`` with their text and reason. The
    written copy goes with the ``scratch_scope`` it is made in; ``load_table`` needs none.
    """
    schema, source_format = checked(schema, source_format, autodetect, csv_options)
    parsed, schema, n_files = parsed_files(
        spark, paths, schema, source_format, ignore_unknown_values, csv_options
    )
    path = shared_path(spark, "load")
    parsed.withColumn(BAD, F.col("_reason").isNotNull()).write.partitionBy(BAD).parquet(path)
    layout = T.StructType(parsed.schema.fields + [T.StructField(BAD, T.BooleanType())])
    staged = spark.read.schema(layout).parquet(path)
    rejected = staged.where(BAD).select("_reason", "_record")
    count = rejected.count()
    if count > max_bad_records:
        sample = [f"{r._reason}: {r._record}" for r in rejected.limit(3).collect()]
        raise BadRecordsError(f"{count} bad records, {max_bad_records} allowed; {sample}")
    return Loaded(staged.where(~F.col(BAD)).select(*schema.names), rejected, count, n_files)


def load_table(
    spark: SparkSession,
    destination: str,
    paths: str | Sequence[str],
    schema: T.StructType | Iterable[Mapping] | None = None,
    source_format: str = "CSV",
    *,
    write_disposition: str = "WRITE_EMPTY",
    create_disposition: str = "CREATE_IF_NEEDED",
    schema_update_options: Iterable[str] = (),
    partition_field: str | None = None,
    partition: str | None = None,
    cluster_fields: Sequence[str] = (),
    autodetect: bool = False,
    max_bad_records: int = 0,
    ignore_unknown_values: bool = False,
    load_id: str | None = None,
    key: str | None = None,
    partition_expiration_ms: int | None = None,
    **csv_options,
) -> Loaded:
    """Load files into a table; the write options are those of ``write_table``.

    Records are parsed and written once, next to the table, and moved into it if the
    budget holds; a load that fails leaves nothing behind. Rejected records stay
    readable in the folder ``<destination>__load_rejected``. A load repeated under its
    ``load_id`` after it broke off is stored once, and so is one repeated after it succeeded.
    ``written`` of the result has the number of accepted rows and a sum of hashes of their
    ``key``, taken while they were written, for ``check_written``.
    """
    options = {
        "write_disposition": write_disposition,
        "create_disposition": create_disposition,
        "schema_update_options": schema_update_options,
        "partition_field": partition_field,
        "partition": partition,
        "cluster_fields": cluster_fields,
    }
    check_write_options(**options)
    parsed, schema, n_files = parsed_files(
        spark, paths, *checked(schema, source_format, autodetect, csv_options), ignore_unknown_values, csv_options
    )
    options["partition_expiration_ms"] = partition_expiration_ms
    count, folder, written = write_parsed(parsed, destination, schema, max_bad_records, load_id, key, **options)
    return Loaded(read_table(spark, destination), read_refused(spark, folder, count), count, n_files, written)


def checked(schema, source_format: str, autodetect: bool, csv_options: Mapping) -> tuple[T.StructType | None, str]:
    source_format = source_format.upper()
    if source_format not in FORMATS:
        raise ValueError(f"{source_format} is not one of {', '.join(FORMATS)}")
    if schema is None and not autodetect:
        raise ValueError("pass a schema or autodetect=True")
    unknown = set(csv_options) - set(CSV_ONLY)
    if unknown or (csv_options and source_format != "CSV"):
        raise ValueError(f"not an option of {source_format}: {sorted(unknown or csv_options)}")
    if schema is not None and not isinstance(schema, T.StructType):
        schema = schema_from_fields(schema)
    return schema, source_format


def parsed_files(spark, paths, schema, source_format, ignore_unknown_values, csv_options, lasting=False) -> tuple[DataFrame, T.StructType, int]:
    """Judged records of the files, their schema, and how many files are read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if source_format in ("PARQUET", "AVRO"):
        rows = spark.read.format(source_format.lower()).load(paths)
        schema = schema or rows.schema
        return parse_typed(rows, schema, ignore_unknown_values), schema, len(rows.inputFiles())
    lines = spark.read.text(paths)
    if source_format == "CSV":
        schema = schema or detect_csv(spark, paths, **csv_options)
        parsed = parse_csv(
            spark, paths, schema, ignore_unknown_values=ignore_unknown_values, lasting=lasting, **csv_options
        )
    else:
        schema = schema or detect_json(spark, paths)
        parsed = parse_json_lines(lines, schema, ignore_unknown_values)
    return parsed, schema, len(lines.inputFiles())


def detect_json(spark: SparkSession, paths: str | Sequence[str]) -> T.StructType:
    """Schema of JSON lines; lines that are no JSON have no say in it."""
    reader = spark.read.option("columnNameOfCorruptRecord", UNREAD)
    found = reader.json([paths] if isinstance(paths, str) else list(paths)).schema
    return T.StructType([f for f in found.fields if f.name != UNREAD])


def detect_csv(spark: SparkSession, paths: str | Sequence[str], **options) -> T.StructType:
    """Schema of CSV files. The last leading row that is skipped gives the names."""
    skip = options.get("skip_leading_rows", 0)
    quoted_newlines = options.get("allow_quoted_newlines", False)
    encoding = options.get("encoding", "UTF-8")
    reader = spark.read.option("inferSchema", True).options(
        sep=options.get("field_delimiter", ","),
        encoding=encoding,
        nullValue=options.get("null_marker", ""),
        multiLine=quoted_newlines,
        header=skip == 1,
        escape='"',
    )
    if options.get("quote") is not None:
        reader = reader.option("quote", options["quote"])
    paths = [paths] if isinstance(paths, str) else list(paths)
    if skip < 2:
        return reader.csv(paths).schema
    if quoted_newlines:
        raise ValueError("pass a schema: several leading rows and quoted newlines hide where rows begin")
    lines = spark.read.text(paths)
    header = spark.createDataFrame([skip_first_rows(lines, skip - 1).select(decoded(encoding)).first()], "value string")
    names = _csv_schema(spark, reader.option("header", True), header).names
    rest = skip_first_rows(lines, skip).select(decoded(encoding).alias("value")).where(F.length("value") > 0)
    kinds = _csv_schema(spark, reader.option("header", False), rest)
    return T.StructType([T.StructField(n, k.dataType) for n, k in zip(names, kinds.fields)])


def _csv_schema(spark, reader, lines):
    texts = getattr(lines._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(texts), spark).schema
