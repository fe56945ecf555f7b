"""Write dispositions, layout, schema changes, export and copy."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from titlemart.quality import CheckFailed, check_written
from titlemart.schema import schema_from_fields
from titlemart.sinks.tables import describe_table, put_batch
from titlemart.sources import load_table
from titlemart.sinks import (
    copy_tables,
    create_empty_table,
    create_view,
    expire_partitions,
    export_table,
    read_table,
    table_exists,
    write_table,
)


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "t")


def nums(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a long")


def got(spark, path, **options):
    return sorted(r[0] for r in read_table(spark, path, **options).collect())


def test_dispositions(spark, path):
    with pytest.raises(ValueError, match="may not be created"):
        write_table(nums(spark, 1), path, create_disposition="CREATE_NEVER")
    write_table(nums(spark, 1), path)
    with pytest.raises(ValueError, match="already holds rows"):
        write_table(nums(spark, 2), path)
    write_table(nums(spark, 2), path, "WRITE_APPEND", "CREATE_NEVER")
    assert got(spark, path) == [1, 2]
    write_table(read_table(spark, path).where("a > 1"), path, "WRITE_TRUNCATE")
    assert got(spark, path) == [2]
    for bad in ({"write_disposition": "X"}, {"create_disposition": "X"},
                {"schema_update_options": ["ALLOW_FIELD_ADDITION"]},
                {"write_disposition": "WRITE_APPEND", "schema_update_options": ["X"]},
                {"cluster_fields": list("abcde")}):
        with pytest.raises(ValueError):
            write_table(nums(spark, 3), path, **bad)
    assert got(spark, path) == [2]


def test_failed_replacement_leaves_the_table(spark, path):
    write_table(nums(spark, 1), path)
    broken = nums(spark, 2).select(F.raise_error(F.lit("boom")).cast("long").alias("a"))
    with pytest.raises(Exception, match="boom"):
        write_table(broken, path, "WRITE_TRUNCATE")
    assert got(spark, path) == [1]


def test_empty_table_then_write_empty(spark, path):
    fields = [{"name": "a", "type": "INT64", "mode": "REQUIRED"},
              {"name": "at", "type": "DATETIME"}]
    create_empty_table(spark, path, fields, partition_field="at", cluster_fields=["a"])
    assert table_exists(spark, path) and read_table(spark, path).count() == 0
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (None, None)], "a long, at timestamp_ntz")
    with pytest.raises(Exception, match="NULL in required column a"):
        write_table(rows, path)
    write_table(rows.where("a = 1"), path)
    assert got(spark, path, day="2024-01-01") == [1]


def days(spark, *pairs):
    return spark.createDataFrame([(a, dt.date.fromisoformat(d) if d else None) for a, d in pairs], "a long, d date")


def test_day_partitions(spark, path, tmp_path):
    write_table(days(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, None)), path, partition_field="d")
    assert (tmp_path / "t" / "_day=2024-01-02").exists()
    write_table(days(spark, (5, "2024-01-02")), path, "WRITE_TRUNCATE", partition="2024-01-02")
    assert got(spark, path) == [1, 3, 5]
    with pytest.raises(Exception, match="row outside day"):
        write_table(days(spark, (6, "2024-01-03")), path, "WRITE_TRUNCATE", partition="2024-01-02")
    with pytest.raises(ValueError, match="already holds rows"):
        write_table(days(spark, (6, "2024-01-02")), path, partition="2024-01-02")
    write_table(days(spark, (7, "2024-01-03")), path, partition="2024-01-03")
    own = read_table(spark, path, day="2024-01-03").withColumn("a", F.col("a") + 1)
    write_table(own, path, "WRITE_TRUNCATE", partition="2024-01-03")
    write_table(days(spark, (9, "2024-01-03")), path, "WRITE_APPEND", partition="2024-01-03")
    assert got(spark, path, days=("2024-01-02", "2024-01-03")) == [5, 8, 9]
    write_table(days(spark).where("false"), path, "WRITE_TRUNCATE", partition="2024-01-03")
    assert got(spark, path) == [1, 3, 5]
    scan = read_table(spark, path, day="2024-01-01")
    assert "PartitionFilters: [isnotnull(_day" in scan._jdf.queryExecution().executedPlan().toString()


def test_clustering_sorts_files(spark, path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id").repartition(8)
    write_table(df, path, cluster_fields=["k"])
    parts = spark.read.parquet(path).select("k", F.input_file_name().alias("f")).collect()
    files = {}
    for r in parts:
        files.setdefault(r.f, []).append(r.k)
    assert all(ks == sorted(ks) for ks in files.values()) and len(parts) == 1000


def test_schema_updates(spark, path):
    required = schema_from_fields(
        [{"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "b", "type": "STRING"}])
    create_empty_table(spark, path, required)
    wide = spark.createDataFrame([(1, "x", 2.5)], "a long, b string, c double")
    with pytest.raises(ValueError, match="not in the table"):
        write_table(wide, path, "WRITE_APPEND")
    with pytest.raises(ValueError, match="type differs"):
        write_table(wide.select(F.col("a").cast("string"), "b"), path, "WRITE_APPEND")
    with pytest.raises(ValueError, match="required columns are missing"):
        write_table(wide.select("b"), path, "WRITE_APPEND")
    write_table(wide.select("a"), path, "WRITE_APPEND")
    write_table(wide, path, "WRITE_APPEND", schema_update_options=["ALLOW_FIELD_ADDITION"])
    write_table(wide.select("b"), path, "WRITE_APPEND", schema_update_options=["ALLOW_FIELD_RELAXATION"])
    assert sorted(map(tuple, read_table(spark, path).collect()), key=repr) == sorted(
        [(1, None, None), (1, "x", 2.5), (None, "x", None)], key=repr)


def test_a_field_added_inside_records(spark, path):
    old = spark.createDataFrame([(1, (2,), [(3,)])], "a long, s struct<x: long>, l array<struct<x: long>>")
    new = spark.createDataFrame([(4, (5, "y"), [(6, "z")]), (7, None, None)], "a long, s struct<x: long, y: string>, l array<struct<x: long, y: string>>")
    write_table(old, path)
    with pytest.raises(ValueError, match="not in the table"):
        write_table(new, path, "WRITE_APPEND")
    write_table(new, path, "WRITE_APPEND", schema_update_options=["ALLOW_FIELD_ADDITION"])
    write_table(old, path, "WRITE_APPEND")
    rows = sorted(read_table(spark, path).collect(), key=lambda r: r.a)
    assert [r.a for r in rows] == [1, 1, 4, 7] and rows[2].s.y == "y" and rows[2].l[0].y == "z"
    assert rows[0].s.y is None and rows[0].l[0].x == 3 and rows[3].s is None


def test_clusters_beside_a_map(spark, path):
    df = spark.range(50).select((F.col("id") % 3).alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    write_table(df, path, cluster_fields=["k"])
    assert read_table(spark, path).count() == 50


def test_copy_keeps_the_layout(spark, tmp_path):
    one, two, other, both = (str(tmp_path / n) for n in ("one", "two", "other", "both"))
    write_table(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), one, partition_field="d", cluster_fields=["a"])
    copy_tables(spark, one, two)
    assert describe_table(spark, two)[1] == {"partition_field": "d", "cluster_fields": ["a"]}
    assert got(spark, two, day="2024-01-02") == [2]
    copy_tables(spark, one, two, "WRITE_APPEND")
    assert got(spark, two) == [1, 1, 2, 2]
    write_table(days(spark, (3, "2024-01-03")), other)
    copy_tables(spark, [one, other], both)
    assert describe_table(spark, both)[1]["partition_field"] is None and got(spark, both) == [1, 2, 3]


def test_copy_keeps_repeats(spark, tmp_path):
    one, two, both = (str(tmp_path / n) for n in ("one", "two", "both"))
    write_table(nums(spark, 1, 2), one)
    write_table(nums(spark, 2), two)
    copy_tables(spark, [one, two], both)
    assert got(spark, both) == [1, 2, 2]
    with pytest.raises(ValueError):
        copy_tables(spark, one, both)
    copy_tables(spark, one, both, "WRITE_TRUNCATE")
    assert got(spark, both) == [1, 2]


def test_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "x", y', ["p", "q"])], "a long, b string, c array<string>").coalesce(1)
    export_table(df, str(tmp_path / "csv"), "CSV", field_delimiter=";")
    (part,) = (tmp_path / "csv").glob("*.csv")
    assert part.read_text().splitlines()[0] == "a;b;c"
    export_table(df, str(tmp_path / "bare"), "CSV", print_header=False, compression="GZIP")
    assert list((tmp_path / "bare").glob("*.csv.gz"))
    export_table(df, str(tmp_path / "json"), "NEWLINE_DELIMITED_JSON")
    assert spark.read.schema(df.schema).json(str(tmp_path / "json")).first() == df.first()
    with pytest.raises(ValueError):
        export_table(df, str(tmp_path / "x"), "XLS")


def test_view(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert create_view(spark, "big_rows", "SELECT id FROM three_rows WHERE id > 0").count() == 2


def test_expiration(spark, path):
    def days(first, n):
        return spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in range(first, first + n)] + [(99, None)], "a long, d date")

    write_table(days(1, 6), path, partition_field="d", partition_expiration_ms=2 * 86_400_000)
    put_batch(days(3, 3), path, "s-0")
    at = lambda *time: sorted(r.a for r in read_table(spark, path, as_of=dt.datetime(2024, 1, *time)).collect())
    assert at(1) == [1, 2, 3, 3, 4, 4, 5, 5, 6, 99, 99]
    assert at(5, 23, 59) == [4, 4, 5, 5, 6, 99, 99] and at(6, 0) == [5, 5, 6, 99, 99]
    plan = read_table(spark, path, as_of=dt.datetime(2024, 1, 6))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((_day" in plan and "2024-01-04" in plan
    write_table(days(7, 1), path, "WRITE_APPEND")  # the expiration stays
    assert at(6, 0) == [5, 5, 6, 7, 99, 99, 99]
    assert expire_partitions(spark, path, dt.datetime(2024, 1, 6)) == 6  # days 1 to 4, and 3 and 4 of the stream
    assert at(1) == [5, 5, 6, 7, 99, 99, 99]
    assert expire_partitions(spark, path, dt.datetime(2024, 1, 6)) == 0
    assert sorted(r.a for r in read_table(spark, path).collect()) == [99, 99, 99]
    with pytest.raises(ValueError, match="expiration"):
        write_table(days(1, 1), path + "2", partition_expiration_ms=5)
    write_table(days(1, 1), path + "3", partition_field="d")
    assert expire_partitions(spark, path + "3") == 0


def test_what_a_load_wrote_is_what_the_table_holds(spark, path, tmp_path):
    (tmp_path / "in").write_text("\n".join([*(json.dumps({"a": i}) for i in range(50)), "{"]))
    loaded = load_table(spark, path, str(tmp_path / "in"), schema_from_fields([{"name": "a", "type": "INT64"}]), "NEWLINE_DELIMITED_JSON", max_bad_records=1, key="a", load_id="x")
    assert loaded.written["n_rows"] == 50
    check_written(loaded.rows, "a", loaded.written)
    changed = {
        "fewer": loaded.rows.where("a <> 7"), "other": loaded.rows.selectExpr("if(a = 7, 70, a) AS a"),
        "doubled": loaded.rows.union(loaded.rows.limit(1)), "none": loaded.rows.where("a < 0"),
    }
    for rows_ in changed.values():
        with pytest.raises(CheckFailed):
            check_written(rows_, "a", loaded.written)
    again = load_table(spark, path, str(tmp_path / "in"), schema_from_fields([{"name": "a", "type": "INT64"}]), "NEWLINE_DELIMITED_JSON", write_disposition="WRITE_APPEND", max_bad_records=1, key="a", load_id="x")
    assert again.written == loaded.written and again.rejected_count == 1
