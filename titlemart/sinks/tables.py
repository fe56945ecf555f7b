"""Parquet tables with write dispositions, day partitions and clustering.

A table is a folder. Its schema, with REQUIRED marks and layout, is kept in a
small side file, so that neither an empty table nor a table with added columns
needs its data files opened to know its columns. Rows inserted by streams lie in
a folder inside it, one part per batch, and are read along with the others until
``compact_table`` merges them. Files are written beside the table and put into it by
``commits.commit``, so a write that breaks off changes nothing or is finished later.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlemart.schema import BadRecordsError, required_columns, schema_from_fields
from titlemart.session import delete_folder
from titlemart.sinks.commits import (
    COMMITS, LOADS, children, commit, data_files, exists, read_text, settle, write_text,
)

SIDE_FILE = "_table.json"
DAY = "_day"
INSERTED = "_inserted"
BATCH = "_batch"
MERGED = "_merged.json"
BAD = "_bad"
REFUSED = "_reason string, _record string"
WRITE = ("WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_EMPTY")
CREATE = ("CREATE_IF_NEEDED", "CREATE_NEVER")
SCHEMA_UPDATES = ("ALLOW_FIELD_ADDITION", "ALLOW_FIELD_RELAXATION")
MAX_CLUSTER_FIELDS = 4


def table_exists(spark: SparkSession, path: str) -> bool:
    settle(spark, path)
    return exists(spark, f"{path.rstrip('/')}/{SIDE_FILE}")


def read_table(
    spark: SparkSession, path: str, day: str | None = None, days: tuple[str, str] | None = None, as_of: datetime | None = None
) -> DataFrame:
    """The table's rows; ``day`` or an inclusive range ``days`` prunes partitions, and so does
    the table's expiration, judged now or ``as_of`` a time."""
    schema, layout = describe_table(spark, path)
    stored = T.StructType(list(schema.fields))
    if layout["partition_field"]:
        stored = stored.add(DAY, T.DateType())
    rows = spark.read.schema(stored).parquet(path)
    if _batches(spark, path):
        batches = T.StructType(stored.fields + [T.StructField(BATCH, T.StringType())])
        inserted = spark.read.schema(batches).parquet(f"{path.rstrip('/')}/{INSERTED}")
        rows = rows.unionByName(inserted.drop(BATCH))
    if day is not None:
        rows = rows.where(F.col(DAY) == F.lit(day).cast("date"))
    if days is not None:
        rows = rows.where(F.col(DAY).between(*[F.lit(d).cast("date") for d in days]))
    past = _last_expired(layout, as_of)
    if past is not None:
        rows = rows.where((F.col(DAY) > F.lit(past)) | F.col(DAY).isNull())
    return rows.select(*schema.names)


def _last_expired(layout: dict, as_of: datetime | None = None) -> date | None:
    """The last day whose begin (UTC) lies at least the table's expiration back."""
    if not layout["partition_field"] or layout.get("expiration_ms") is None:
        return None
    now = as_of or datetime.now(timezone.utc)
    return (now - timedelta(milliseconds=layout["expiration_ms"])).date()


def expire_partitions(spark: SparkSession, path: str, as_of: datetime | None = None) -> int:
    """Remove the folders of expired days, streamed rows of them too; returns how many.

    Reads leave them out as soon as they expire. No data file is read or written here.
    """
    _, layout = describe_table(spark, path)
    past, path = _last_expired(layout, as_of), path.rstrip("/")
    if past is None:
        return 0
    folders = [path, *[f"{path}/{INSERTED}/{b}" for b in _batches(spark, path)]]
    gone = [
        (folder, day)
        for folder in folders
        for day in children(spark, folder)
        if re.fullmatch(rf"{DAY}=\d{{4}}-\d\d-\d\d", day) and date.fromisoformat(day.removeprefix(f"{DAY}=")) <= past
    ]
    old = f"{_beside(path)}_old"
    commit(spark, path, [[(f"{folder}/{day}", f"{old}/{n}") for n, (folder, day) in enumerate(gone)]], [old])
    return len(gone)


def write_table(
    df: DataFrame,
    path: str,
    write_disposition: str = "WRITE_EMPTY",
    create_disposition: str = "CREATE_IF_NEEDED",
    schema_update_options: Iterable[str] = (),
    partition_field: str | None = None,
    partition: str | None = None,
    cluster_fields: Sequence[str] = (),
    load_id: str | None = None,
    partition_expiration_ms: int | None = None,
) -> None:
    """Store rows as a table.

    WRITE_TRUNCATE replaces, WRITE_APPEND adds, WRITE_EMPTY fails if the table
    has rows. ``partition_field`` splits the table by day of a date or time
    column; ``partition`` names one day, whose rows alone are replaced, added
    to or required to be absent. ``cluster_fields`` stores rows sorted by up to
    four columns. Days of the table expire ``partition_expiration_ms`` after they began.

    A write that raises leaves the table as it was. One whose process ended after its rows were written is
    finished when the table is next looked at; repeated under its ``load_id``, it adds nothing more.
    """
    spark = df.sparkSession
    if load_id is not None and _loaded(spark, path, load_id) is not None:
        return
    write = _planned(
        df, path, write_disposition, create_disposition, schema_update_options,
        partition_field, partition, cluster_fields, partition_expiration_ms,
    )
    rows = _guarded(df.select(*write.columns), write, partition)
    rows = _arranged(rows, write.partition_field, write.cluster_fields)
    beside = _beside(path)
    with _gone_on_error(spark, beside):
        _writer(rows, write.partition_field).parquet(beside)
    _put(spark, beside, path, write, partition, load_id, {})


def write_parsed(
    parsed: DataFrame, path: str, schema: T.StructType, max_bad_records: int = 0, load_id: str | None = None,
    key: str | None = None, **options
) -> tuple[int, str, dict]:
    """Store the good rows of a parsed frame (``schema``, ``_reason``, ``_record``), written once.

    Good and bad records are written side by side, next to the table. If more are
    bad than allowed, that folder goes and the table stays as it was; otherwise the good files are
    moved into the table, and the bad ones to a folder of their own, all or none. Returns
    how many were bad, that folder, and the ``fingerprint`` of the good rows' ``key`` as taken while they were
    written; for a ``load_id`` stored before, those of that load.
    """
    spark = parsed.sparkSession
    before = None if load_id is None else _loaded(spark, path, load_id)
    if before is not None:
        return before["bad"], before["kept"], before["written"]
    partition = options.get("partition")
    marked = [F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields]
    write = _planned(parsed.select(*marked), path, **options)
    good = F.col("_reason").isNull()
    rows = parsed.select(*write.columns, "_reason", "_record", (~good).alias(BAD))
    rows = _arranged(_guarded(rows, write, partition, good), write.partition_field, write.cluster_fields)
    parts = [BAD, DAY] if write.partition_field else [BAD]
    beside, seen = _beside(path), Observation()
    with _gone_on_error(spark, beside):
        rows.observe(seen, *fingerprint(key, ~F.col(BAD))).write.partitionBy(*parts).parquet(beside)
        refused = _refused(spark, f"{beside}/{BAD}=true")
        bad = refused.count()
        if bad > max_bad_records:
            sample = [f"{r._reason}: {r._record}" for r in refused.limit(3).collect()]
            raise BadRecordsError(f"{bad} bad records, {max_bad_records} allowed; {sample}")
    kept = f"{path.rstrip('/')}__load_rejected/{uuid.uuid4().hex[:12]}"
    apart = [(f"{beside}/{BAD}=true", kept)] if bad else []
    written = {name: int(value or 0) for name, value in seen.get.items()}
    result = {"bad": bad, "kept": kept, "written": written}
    _put(spark, f"{beside}/{BAD}=false", path, write, partition, load_id, result, apart, beside)
    return bad, kept, written


def fingerprint(key: str | None, only: Column | None = None) -> list[Column]:
    """Aggregates that tell sets of rows apart in any order: their number, and a sum over hashes of a key."""
    only = F.lit(True) if only is None else only
    hashed = F.xxhash64(F.col(key)) if key else F.lit(0).cast("bigint")
    return [F.count_if(only).alias("n_rows"), F.sum(F.when(only, hashed).cast("decimal(38,0)")).alias("key_sum")]


def read_refused(spark: SparkSession, folder: str, count: int) -> DataFrame:
    """Reason and text of the records that ``write_parsed`` refused."""
    return _refused(spark, folder) if count else spark.createDataFrame([], REFUSED)


def _refused(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(REFUSED).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], REFUSED)


class _Write(NamedTuple):
    columns: list[Column]
    schema: T.StructType
    partition_field: str | None
    cluster_fields: list[str]
    replaces: bool  # the whole table, or the day that is written
    expiration_ms: int | None = None


def _planned(
    df: DataFrame,
    path: str,
    write_disposition: str = "WRITE_EMPTY",
    create_disposition: str = "CREATE_IF_NEEDED",
    schema_update_options: Iterable[str] = (),
    partition_field: str | None = None,
    partition: str | None = None,
    cluster_fields: Sequence[str] = (),
    partition_expiration_ms: int | None = None,
) -> _Write:
    """What a write will do; raises if it may not be done."""
    options = check_write_options(
        write_disposition, create_disposition, schema_update_options,
        partition_field, partition, cluster_fields,
    )
    spark = df.sparkSession
    exists = table_exists(spark, path)
    if not exists and create_disposition == "CREATE_NEVER":
        raise ValueError(f"{path} does not exist and may not be created")
    if partition is not None and partition_field is None and not exists:
        raise ValueError("the first write of a day needs partition_field")

    if exists:
        schema, layout = describe_table(spark, path)
        if partition_field and partition_field != layout["partition_field"]:
            raise ValueError(f"{path} is partitioned by {layout['partition_field']}")
        held = read_table(spark, path, day=partition)
        if write_disposition == "WRITE_EMPTY" and not held.isEmpty():
            raise ValueError(f"{path} already holds rows")
        columns = [F.col(c) for c in df.columns]
        if write_disposition == "WRITE_TRUNCATE" and partition is None:
            schema = df.schema
        else:
            columns, schema = _fit(df, schema, options)
        partition_field = partition_field or layout["partition_field"]
        if partition is not None and not partition_field:
            raise ValueError(f"{path} is not partitioned by day")
        cluster_fields = list(cluster_fields) or layout["cluster_fields"]
        if partition_expiration_ms is None:
            partition_expiration_ms = layout.get("expiration_ms")
    else:
        columns, schema = [F.col(c) for c in df.columns], df.schema
    replaces = not exists or write_disposition == "WRITE_TRUNCATE"
    if partition_expiration_ms is not None and (not partition_field or partition_expiration_ms <= 0):
        raise ValueError("an expiration needs partition_field and a positive time")
    return _Write(columns, schema, partition_field, list(cluster_fields), replaces, partition_expiration_ms)


def _put(
    spark: SparkSession, folder: str, path: str, write: _Write, partition: str | None, load_id: str | None,
    result: dict, apart: list[tuple[str, str]] = [], scratch: str | None = None,  # noqa: B006
) -> None:
    """Put finished files into the table, or in the place of the table or of one of its days."""
    path, old = path.rstrip("/"), f"{folder}_old"
    out, into = [], list(apart)
    held = exists(spark, f"{path}/{SIDE_FILE}")
    described = _description(write)
    if write.replaces and (partition is None or not held):
        out = [(f"{path}/{n}", f"{old}/{n}") for n in children(spark, path) if n not in (COMMITS, LOADS, MERGED)]
        into += [(f"{folder}/{n}", f"{path}/{n}") for n in children(spark, folder) if n.startswith(f"{DAY}=") or not n.startswith(("_", "."))]
        held = False
    elif write.replaces:
        day = f"{DAY}={partition}"
        places = [day, *[f"{INSERTED}/{b}/{day}" for b in _batches(spark, path)]]
        out = [(f"{path}/{p}", f"{old}/{p}") for p in places if exists(spark, f"{path}/{p}")]
        into += [(f"{folder}/{day}", f"{path}/{day}")] if exists(spark, f"{folder}/{day}") else []
    else:
        into += [(f"{folder}/{f}", f"{path}/{f}") for f in data_files(spark, folder)]
    if not held or read_text(spark, f"{path}/{SIDE_FILE}") != described:
        write_text(spark, f"{folder}/{SIDE_FILE}", described)
        out += [(f"{path}/{SIDE_FILE}", f"{old}/{SIDE_FILE}")] if held else []
        into.append((f"{folder}/{SIDE_FILE}", f"{path}/{SIDE_FILE}"))
    if load_id is not None:
        name = f"{LOADS}/{_load_name(load_id)}"
        write_text(spark, f"{folder}/{name}", json.dumps({"id": load_id, "result": result}))
        into.append((f"{folder}/{name}", f"{path}/{name}"))
    commit(spark, path, [out, into], [scratch or folder, old])


def _load_name(load_id: str) -> str:
    return f"{hashlib.sha256(load_id.encode()).hexdigest()}.json"


def _loaded(spark: SparkSession, path: str, load_id: str) -> dict | None:
    """What the load of that id returned, if it is in the table."""
    settle(spark, path)
    name = f"{path.rstrip('/')}/{LOADS}/{_load_name(load_id)}"
    return json.loads(read_text(spark, name))["result"] if exists(spark, name) else None


@contextmanager
def _gone_on_error(spark: SparkSession, folder: str):
    """What is written beside the table goes if it cannot be used."""
    try:
        yield
    except BaseException:
        delete_folder(spark, folder)
        raise


def put_batch(rows: DataFrame, path: str, name: str) -> None:
    """Add one batch ``<stream>-<number>`` of streamed rows; a batch put twice is stored once, merged or not."""
    spark, path = rows.sparkSession, path.rstrip("/")
    _, layout = describe_table(spark, path)
    stream, _, number = name.rpartition("-")
    if int(number) <= _merged_up_to(spark, path).get(stream, -1):
        return
    if layout["partition_field"]:
        rows = rows.withColumn(DAY, F.to_date(layout["partition_field"]))
    beside, folder = _beside(path), f"{path}/{INSERTED}/{BATCH}={name}"
    with _gone_on_error(spark, beside):
        _writer(rows, layout["partition_field"]).parquet(beside)
    old = [(folder, f"{beside}_old")] if exists(spark, folder) else []
    commit(spark, path, [old, [(beside, folder)]], [f"{beside}_old"])


def compact_table(spark: SparkSession, path: str, least: int = 2) -> int:
    """Merge streamed batches into the table's own files, if there are ``least`` of them; returns how many.

    Their rows are laid out by the table's day and clusters, in files of Spark's advisory
    partition size. For each stream the highest merged batch is recorded, so a replay of one
    stores nothing. Batches that arrive meanwhile stay for the next time. Readers see the
    rows once, in either place. Fails, changing nothing, if a batch was replaced meanwhile.
    """
    schema, layout = describe_table(spark, path)
    path, batches = path.rstrip("/"), _batches(spark, path)
    if len(batches) < max(1, least):
        return 0
    held = {b: sorted(data_files(spark, f"{path}/{INSERTED}/{b}")) for b in batches}
    days = [T.StructField(DAY, T.DateType())] if layout["partition_field"] else []
    stored = T.StructType([*schema.fields, *days, T.StructField(BATCH, T.StringType())])
    folders = [f"{path}/{INSERTED}/{b}" for b in batches]
    rows = spark.read.schema(stored).option("basePath", f"{path}/{INSERTED}").parquet(*folders).drop(BATCH)
    arranged = _arranged(rows, layout["partition_field"], layout["cluster_fields"])
    if arranged is rows:
        arranged = rows.hint("rebalance")
    beside, marks = _beside(path), _merged_up_to(spark, path)
    with _gone_on_error(spark, beside):
        _writer(arranged, layout["partition_field"]).parquet(beside)
        for batch in batches:
            stream, _, number = batch.removeprefix(f"{BATCH}=").rpartition("-")
            marks[stream] = max(int(number), marks.get(stream, -1))
        write_text(spark, f"{beside}/{MERGED}", json.dumps(marks))
        if any(sorted(data_files(spark, f"{path}/{INSERTED}/{b}")) != held[b] for b in batches):
            raise ValueError(f"batches of {path} were replaced while they were merged")
    old = f"{beside}_old"
    out = [(f, f"{old}/{b}") for f, b in zip(folders, batches)]
    if exists(spark, f"{path}/{MERGED}"):
        out.append((f"{path}/{MERGED}", f"{old}/{MERGED}"))
    into = [(f"{beside}/{f}", f"{path}/{f}") for f in [MERGED, *data_files(spark, beside)]]
    commit(spark, path, [out, into], [beside, old])
    return len(batches)


def _batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of streamed batches that are not merged yet."""
    names = children(spark, f"{path.rstrip('/')}/{INSERTED}")
    return sorted(n for n in names if n.startswith(f"{BATCH}="))


def _merged_up_to(spark: SparkSession, path: str) -> dict[str, int]:
    name = f"{path.rstrip('/')}/{MERGED}"
    return json.loads(read_text(spark, name)) if exists(spark, name) else {}


def copy_tables(
    spark: SparkSession,
    sources: str | Sequence[str],
    destination: str,
    write_disposition: str = "WRITE_EMPTY",
    create_disposition: str = "CREATE_IF_NEEDED",
) -> None:
    """Copy one or several tables of the same columns into one, keeping repeats.

    A day partition and clustering that all sources share are kept.
    """
    sources = [sources] if isinstance(sources, str) else list(sources)
    rows = reduce(DataFrame.unionByName, [read_table(spark, s) for s in sources])
    layouts = [describe_table(spark, s)[1] for s in sources]
    shared = layouts[0] if all(x == layouts[0] for x in layouts) else {}
    if write_disposition != "WRITE_TRUNCATE" and table_exists(spark, destination):
        shared = {}  # rows that are added take the layout they find
    if "expiration_ms" in shared:
        shared = {**shared, "partition_expiration_ms": shared["expiration_ms"]}
        del shared["expiration_ms"]
    write_table(rows, destination, write_disposition, create_disposition, **shared)


def create_empty_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | Iterable[Mapping],
    partition_field: str | None = None,
    cluster_fields: Sequence[str] = (),
    partition_expiration_ms: int | None = None,
) -> None:
    if not isinstance(schema, T.StructType):
        schema = schema_from_fields(schema)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
    write_table(
        spark.createDataFrame([], nullable), path,
        partition_field=partition_field, cluster_fields=cluster_fields, partition_expiration_ms=partition_expiration_ms,
    )


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A view from a query text."""
    spark.sql(query).createOrReplaceTempView(name)
    return spark.table(name)


def check_write_options(
    write_disposition: str = "WRITE_EMPTY",
    create_disposition: str = "CREATE_IF_NEEDED",
    schema_update_options: Iterable[str] = (),
    partition_field: str | None = None,
    partition: str | None = None,
    cluster_fields: Sequence[str] = (),
) -> set[str]:
    if write_disposition not in WRITE:
        raise ValueError(f"{write_disposition} is not one of {', '.join(WRITE)}")
    if create_disposition not in CREATE:
        raise ValueError(f"{create_disposition} is not one of {', '.join(CREATE)}")
    options = set(schema_update_options or ())
    if options - set(SCHEMA_UPDATES):
        raise ValueError(f"{sorted(options)} may hold only {', '.join(SCHEMA_UPDATES)}")
    if options and write_disposition == "WRITE_EMPTY":
        raise ValueError("schema updates go only with WRITE_APPEND or WRITE_TRUNCATE")
    if len(cluster_fields) > MAX_CLUSTER_FIELDS:
        raise ValueError(f"at most {MAX_CLUSTER_FIELDS} cluster fields")
    if partition is not None:
        date.fromisoformat(partition)
    return options


def _merged(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The old type with the fields a new one adds inside its records; None if they disagree."""
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = _merged(old.elementType, new.elementType)
        return inner and T.ArrayType(inner)
    if not (isinstance(old, T.StructType) and isinstance(new, T.StructType)):
        return old if old == new else None
    offered = {f.name: f.dataType for f in new.fields}
    fields = []
    for field in old.fields:
        kind = _merged(field.dataType, offered.pop(field.name, field.dataType))
        if kind is None:
            return None
        fields.append(T.StructField(field.name, kind, True, field.metadata))
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in offered.items()])


def _as(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value brought to a merged type: fields it lacks are NULL."""
    if have == want:
        return value
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda e: _as(e, have.elementType, want.elementType))
    if not isinstance(want, T.StructType):
        return value.cast(want)
    held = {f.name: f.dataType for f in have.fields}
    parts = [
        (_as(value[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in want.fields
    ]
    return F.when(value.isNotNull(), F.struct(*parts))


def _plain(kind: T.DataType) -> str:
    """A type without its NULL marks, for comparison."""
    return kind.simpleString()


def _fit(df: DataFrame, schema: T.StructType, options: set[str]) -> tuple[list[Column], T.StructType]:
    """Columns that bring rows to a table's, which change only as allowed."""
    old = {f.name: f for f in schema.fields}
    new = {f.name: f for f in df.schema.fields}
    kinds = {n: _merged(old[n].dataType, new[n].dataType) for n in new if n in old}
    for name, kind in kinds.items():
        same = _plain(old[name].dataType) == _plain(new[name].dataType)
        if kind is None and same:
            kinds[name] = old[name].dataType
        elif kind is None:
            raise ValueError(f"column type differs from the table: {name}")
        elif _plain(kind) != _plain(old[name].dataType) and "ALLOW_FIELD_ADDITION" not in options:
            raise ValueError(f"fields not in the table: {name} is {_plain(new[name].dataType)}")
    added = [n for n in new if n not in old]
    if added and "ALLOW_FIELD_ADDITION" not in options:
        raise ValueError(f"columns not in the table: {added}")
    relax = "ALLOW_FIELD_RELAXATION" in options
    missing = [n for n in required_columns(schema) if n not in new]
    if missing and not relax:
        raise ValueError(f"required columns are missing: {missing}")
    fields = []
    for field in schema.fields:
        stays = field.metadata.get("mode") == "REQUIRED"
        offered = field.name in new and new[field.name].metadata.get("mode") == "REQUIRED"
        metadata = field.metadata if stays and (offered or not relax) else {}
        kind = kinds.get(field.name) or field.dataType
        fields.append(T.StructField(field.name, kind, True, metadata))
    fields += [T.StructField(n, new[n].dataType, True) for n in added]
    target = T.StructType(fields)
    columns = [
        _as(F.col(f.name), new[f.name].dataType, f.dataType).alias(f.name, metadata=f.metadata)
        if f.name in new else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    return columns, target


def _guarded(df: DataFrame, write: _Write, partition: str | None, only: Column | None = None) -> DataFrame:
    """Rows that raise while they are written if they break a REQUIRED mark or
    belong to another day than the one written; ``only`` says which rows count."""
    checks = [
        (F.col(c).isNull(), f"NULL in required column {c}") for c in required_columns(write.schema)
    ]
    if write.partition_field:
        df = df.withColumn(DAY, F.to_date(write.partition_field))
        if partition is not None:
            wrong = ~F.col(DAY).eqNullSafe(F.lit(partition).cast("date"))
            checks.append((wrong, f"row outside day {partition}"))
    for broken, message in checks:
        broken = broken if only is None else broken & only
        df = df.where(F.when(broken, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True))
    return df


def _arranged(df: DataFrame, partition_field: str | None, cluster: list[str]) -> DataFrame:
    """Lay rows out for writing, so that a hot day or value spans several tasks."""
    day = [DAY] if partition_field else []
    if cluster:
        # The row number parts equal cluster values over several ranges.
        spread = df.withColumn("__spread", F.monotonically_increasing_id())
        ranges = [*day, *cluster, "__spread"]
        return spread.repartitionByRange(*ranges).sortWithinPartitions(*day, *cluster).drop("__spread")
    if day:
        # REBALANCE gathers a day's rows, and AQE splits the days that are large.
        return df.hint("rebalance", F.col(DAY))
    return df


def _writer(rows: DataFrame, partition_field: str | None):
    return rows.write.partitionBy(DAY) if partition_field else rows.write


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}__next_{uuid.uuid4().hex[:12]}"


def describe_table(spark: SparkSession, path: str) -> tuple[T.StructType, dict]:
    """The table's schema and its partition and cluster columns."""
    if not table_exists(spark, path):
        raise ValueError(f"{path} is not a table")
    saved = json.loads(read_text(spark, f"{path.rstrip('/')}/{SIDE_FILE}"))
    return T.StructType.fromJson(saved["schema"]), saved["layout"]


def _description(write: _Write) -> str:
    nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in write.schema.fields])
    layout = {"partition_field": write.partition_field, "cluster_fields": write.cluster_fields}
    if write.expiration_ms is not None:
        layout["expiration_ms"] = write.expiration_ms
    return json.dumps({"schema": nullable.jsonValue(), "layout": layout})
