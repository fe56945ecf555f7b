"""Loads of malformed and unusual files."""

import datetime as dt
import gzip
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from titlemart.catalog import loading
from titlemart.schema import required_columns, schema_from_fields, schema_from_json, titles_schema
from titlemart.session import shared_dir
from titlemart.sinks import read_table
from titlemart.sources.parsing import parse_csv, parse_json_lines
from titlemart.sources import paging
from titlemart.sources import (
    BadRecordsError,
    create_external_table,
    exact_sample,
    load_files,
    load_table,
    read_page,
)

JSON = "NEWLINE_DELIMITED_JSON"
THREE = "a long, b string, c long"


def three():
    return schema_from_fields(
        [{"name": "a", "type": "INT64"}, {"name": "b", "type": "STRING"}, {"name": "c", "type": "INT64"}]
    )


def put(folder, text, name="part.txt", encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding=encoding)
    return str(folder)


def rows(loaded):
    return sorted(map(tuple, loaded.rows.collect()), key=repr)


def reasons(loaded):
    return sorted(r._reason for r in loaded.rejected.collect())


def test_schema_from_fields(tmp_path):
    fields = [
        {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
        {"name": "g", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "n", "type": "FLOAT64"}]},
        {"name": "when", "type": "DATE"},
    ]
    (tmp_path / "s.json").write_text(json.dumps(fields))
    schema = schema_from_json(tmp_path / "s.json")
    assert schema.simpleString() == (
        "struct<id:bigint,tags:array<string>,g:array<struct<n:double>>,when:date>")
    assert required_columns(schema) == ["id"]
    with pytest.raises(ValueError):
        schema_from_fields([{"name": "x", "type": "GEOGRAPHY"}])


def test_json_leniency(spark, tmp_path):
    collection = {"id": 9, "name": "c", "poster_path": None, "backdrop_path": "/b"}
    lines = [
        {"id": 1, "revenue": "90", "release_date": "", "belongs_to_collection": collection,
         "genres": [{"id": "4", "name": "x"}, {"id": None, "name": None}], "adult": False},
        {"id": 2, "belongs_to_collection": None, "release_date": "2018-12-31", "vote_average": 7},
        {"id": 3, "belongs_to_collection": [collection]},
    ]
    path = put(tmp_path / "j", "\n".join(map(json.dumps, lines)) + "\n\n")
    loaded = load_files(spark, path, titles_schema(), JSON)
    one, two, three_ = sorted(loaded.rows.collect(), key=lambda r: r.id)
    assert (one.revenue, one.release_date, one.adult) == (90, None, False)
    assert one.belongs_to_collection[0].name == "c" and len(one.belongs_to_collection) == 1
    assert [tuple(g) for g in one.genres] == [(4, "x"), (None, None)]
    assert (two.belongs_to_collection, two.release_date, two.vote_average) == (None, dt.date(2018, 12, 31), 7.0)
    assert one.belongs_to_collection == three_.belongs_to_collection


def test_json_rejections(spark, tmp_path):
    lines = ['{"a":1,"b":"x","c":2}', '{"a":4,"b":', '{"a":"no","b":"x"}', "null", "7",
             '{"a":1,"zzz":2}', '{"a":"5","b":"kept"}']
    path = put(tmp_path / "j", "\n".join(lines))
    with pytest.raises(BadRecordsError, match="5 bad records, 4 allowed"):
        load_files(spark, path, three(), JSON, max_bad_records=4)
    strict = load_files(spark, path, three(), JSON, max_bad_records=5)
    assert rows(strict) == [(1, "x", 2), (5, "kept", None)]
    assert reasons(strict) == ["bad value", "malformed", "malformed", "malformed", "unknown field"]
    assert {r._record for r in strict.rejected.collect()} == {lines[i] for i in (1, 2, 3, 4, 5)}
    loose = load_files(spark, path, three(), JSON, max_bad_records=4, ignore_unknown_values=True)
    assert loose.rejected_count == 4 and (1, None, None) in rows(loose)


def test_json_unknown_nested_field(spark, tmp_path):
    schema = schema_from_fields(
        [{"name": "g", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "n", "type": "INT64"}]},
         {"name": "value", "type": "STRING"}])
    lines = ['{"g":[{"n":1},{"n":2,"extra":3}]}', '{"g":{"extra":3}}', '{"g":[{"n":1}],"value":"v"}']
    path = put(tmp_path / "j", "\n".join(lines))
    loaded = load_files(spark, path, schema, JSON, max_bad_records=2)
    assert reasons(loaded) == ["unknown field"] * 2
    assert [r.value for r in loaded.rows.collect()] == ["v"]
    assert load_files(spark, path, schema, JSON, ignore_unknown_values=True).rows.count() == 3


def test_json_unknown_field_two_levels_down(spark, tmp_path):
    inner = {"name": "h", "type": "RECORD", "fields": [{"name": "n", "type": "INT64"}]}
    schema = schema_from_fields(
        [{"name": "g", "type": "RECORD", "mode": "REPEATED", "fields": [inner]},
         {"name": "one", "type": "RECORD", "fields": [{"name": "n", "type": "INT64"}]}])
    good = ['{"g":[{"h":{"n":1}}]}', '{"g":{"h":{"n":"2"}},"one":{"n":"3"}}', '{"one":null}']
    bad = ['{"g":[{"h":{"n":1,"x":2}}]}', '{"g":{"h":{"x":2}}}', '{"one":{"n":1,"x":2}}']
    path = put(tmp_path / "j", "\n".join(good + bad))
    loaded = load_files(spark, path, schema, JSON, max_bad_records=3)
    assert {r._record for r in loaded.rejected.collect()} == set(bad)
    got = {(r.g[0].h.n if r.g else None, r.one.n if r.one else None) for r in loaded.rows.collect()}
    assert got == {(1, None), (2, 3), (None, None)}


def test_json_lenient_records_are_read_a_fixed_number_of_times(spark):
    """Each nested field adds a reading of its text and one of its keys, not further ones of the record."""
    def readings(n):
        objects = [{"name": f"g{i}", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "n", "type": "INT64"}]} for i in range(n)]
        parsed = parse_json_lines(spark.range(1).select(F.lit("{}").alias("value")).limit(1), schema_from_fields(objects))
        return parsed._jdf.queryExecution().analyzed().toString().count("from_json(")

    assert readings(5) - readings(1) == 4 * 2


def test_json_lenient_nested_fields(spark, tmp_path):
    """Nested fields of a lenient record, some of which the strict reading gives back to the letter."""
    part = lambda *fields: [{"name": n, "type": t} for n, t in fields]
    schema = schema_from_fields([
        {"name": "id", "type": "INT64"},
        {"name": "g", "type": "RECORD", "mode": "REPEATED", "fields": part(("n", "INT64"), ("x", "FLOAT64"))},
        {"name": "c", "type": "RECORD", "mode": "REPEATED", "fields": part(("a", "STRING"), ("b", "STRING"))},
        {"name": "w", "type": "RECORD", "fields": part(("t", "TIMESTAMP"),)},
    ])
    good = [
        '{"id":"1","g":[{"n":1,"x":1.0}],"c":[{"a":"p","b":"null"}]}',
        '{"id":"2","g":[{"x":1,"n":"3"}],"c":{"b":"q"}}',
        '{"id":"3","g":[],"c":[{}],"w":{"t":"2020-01-02T03:04:05.123456Z"}}',
        '{"id":"4","g":[{"n":1,"n":2}],"c":"[{\\"a\\":5}]"}',
        '{"id":"5","g":null,"c":[{"a":5}]}',
        '{"id":"6","c":[null]}',
    ]
    bad = ['{"id":"7","g":[1,{"g":[]}]}', '{"id":"8","g":[{"n":"u"}],"c":[]}']
    odd = ['{"id":"9","c":[{"a":"p","z":1}]}', '{"id":"10","g":{"n":1,"z":1}}']
    path = put(tmp_path / "j", "\n".join(good + bad + odd))
    loaded = load_files(spark, path, schema, JSON, max_bad_records=4)
    assert reasons(loaded) == ["bad value"] * 2 + ["unknown field"] * 2
    assert {r._record for r in loaded.rejected.collect()} == {*bad, *odd}
    plain = lambda entries: entries and [e and tuple(e) for e in entries]
    got = {r.id: (plain(r.g), plain(r.c), r.w and r.w.t.microsecond) for r in loaded.rows.collect()}
    assert got == {
        1: ([(1, 1.0)], [("p", "null")], None),
        2: ([(3, 1.0)], [(None, "q")], None),
        3: ([], [(None, None)], 123456),
        4: ([(2, None)], [("5", None)], None),
        5: (None, [("5", None)], None),
        6: (None, [None], None),
    }


CSV = '1|x|3\n2|z\n3|w|4|5\nbad|q|1\n|"quo|ted"|\n'


def test_csv_rejections(spark, tmp_path):
    path = put(tmp_path / "c", CSV)
    strict = load_files(spark, path, three(), field_delimiter="|", max_bad_records=3)
    assert rows(strict) == [(1, "x", 3), (None, "quo|ted", None)]
    assert reasons(strict) == ["bad value", "long row", "short row"]
    with pytest.raises(BadRecordsError):
        load_files(spark, path, three(), field_delimiter="|", max_bad_records=2)
    loose = load_files(
        spark, path, three(), field_delimiter="|", max_bad_records=1,
        allow_jagged_rows=True, ignore_unknown_values=True)
    assert rows(loose) == [(1, "x", 3), (2, "z", None), (3, "w", 4), (None, "quo|ted", None)]


def test_csv_record_lengths(spark, tmp_path):
    path = put(tmp_path / "c", "1||\n2|\n3||4|\n4|||\n|\n||\n")
    loaded = load_files(spark, path, three(), field_delimiter="|", max_bad_records=9)
    assert rows(loaded) == [(1, None, None), (None, None, None)]
    assert sorted(tuple(r) for r in loaded.rejected.collect()) == [
        ("long row", "3||4|"), ("long row", "4|||"), ("short row", "2|"), ("short row", "|")]
    text = schema_from_fields([{"name": n, "type": "STRING"} for n in "ab"])
    view = create_external_table(
        spark, "lengths", put(tmp_path / "d", "x,y\nz\n"), "CSV", text, max_bad_records=1)
    assert view.select("b").collect() == [("y",)]


def test_csv_quoted_newline_null_marker_encoding(spark, tmp_path):
    path = put(tmp_path / "c", '1,"x\ny",3\n2,NA,NA\n4,"say ""hi""",é\n'.replace("é", "5"))
    loaded = load_files(spark, path, three(), allow_quoted_newlines=True, null_marker="NA")
    assert rows(loaded) == [(1, "x\ny", 3), (2, None, None), (4, 'say "hi"', 5)]
    latin = put(tmp_path / "l", "1,é,3\n", encoding="latin-1")
    assert rows(load_files(spark, latin, three(), encoding="ISO-8859-1")) == [(1, "é", 3)]
    quoted = put(tmp_path / "q", "1,'a,b',3\n")
    assert rows(load_files(spark, quoted, three(), quote="'")) == [(1, "a,b", 3)]


@pytest.mark.parametrize("skip", [1, 2, 3])
@pytest.mark.parametrize("newlines", [False, True])
def test_leading_rows_of_every_file(spark, tmp_path, skip, newlines):
    folder = tmp_path / "c"
    for i in range(5):
        body = "".join(f"{i},r{j},{j}\n" for j in range(i))
        put(folder, "".join(f"h{k},,\n" for k in range(skip)) + body, f"p{i}.csv")
    loaded = load_files(
        spark, str(folder), three(), skip_leading_rows=skip, allow_quoted_newlines=newlines)
    assert rows(loaded) == sorted((i, f"r{j}", j) for i in range(5) for j in range(i))


def test_leading_rows_of_a_split_file(spark, tmp_path):
    path = put(tmp_path / "c", "h1\nh2\n" + "".join(f"{i},r,{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        loaded = load_files(spark, path, three(), skip_leading_rows=2)
        assert loaded.rows.count() == 5000
        short = put(tmp_path / "d", "x" * 100 + "\n" + "".join(f"{i},r,{i}\n" for i in range(5000)))
        with pytest.raises(Exception, match="run past the first part"):
            load_files(spark, short, three(), skip_leading_rows=3000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_leading_rows_go_without_python(spark, tmp_path):
    path = put(tmp_path / "c", "h1,,\nh2,,\n1,é,2\n", encoding="latin-1")
    parsed = parse_csv(spark, path, three(), skip_leading_rows=2, encoding="ISO-8859-1")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "SortMergeJoin" not in plan
    assert [r.b for r in parsed.collect()] == ["é"]


def test_gzip_equals_plain(spark, tmp_path):
    plain = put(tmp_path / "p", CSV)
    (tmp_path / "z").mkdir()
    with gzip.open(tmp_path / "z" / "part.csv.gz", "wt") as out:
        out.write(CSV)
    options = {"field_delimiter": "|", "max_bad_records": 3}
    assert rows(load_files(spark, plain, three(), **options)) == rows(
        load_files(spark, str(tmp_path / "z"), three(), **options))


def test_autodetect_and_guards(spark, tmp_path):
    path = put(tmp_path / "c", "n,d\n1,2.5\n2,x\n")
    detected = load_files(spark, path, autodetect=True, skip_leading_rows=1).rows
    assert detected.schema.simpleString() == "struct<n:int,d:string>"
    for bad in ({}, {"schema": three(), "source_format": "XML"},
                {"schema": three(), "source_format": JSON, "quote": "'"}):
        with pytest.raises(ValueError):
            load_files(spark, path, **bad)


def test_parquet_with_schema(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "x")], "a int, extra string").write.parquet(path)
    with pytest.raises(BadRecordsError):
        load_files(spark, path, three(), "PARQUET")
    assert rows(load_files(spark, path, three(), "PARQUET", ignore_unknown_values=True)) == [(1, None, None)]


def test_autodetect_with_policies(spark, tmp_path):
    lines = put(tmp_path / "j", '{"a":1,"b":"x"}\n{"a":2,"b":\n{"a":3}\n')
    loaded = load_files(spark, lines, None, JSON, autodetect=True, max_bad_records=1)
    assert loaded.rows.columns == ["a", "b"] and rows(loaded) == [(1, "x"), (3, None)]
    view = create_external_table(spark, "detected_json", lines, JSON, autodetect=True, max_bad_records=1)
    assert view.count() == 2
    headed = put(tmp_path / "c", "title line\nn,d\n1,2\n3,x\n")
    loaded = load_files(spark, headed, autodetect=True, skip_leading_rows=2)
    assert loaded.rows.schema.simpleString() == "struct<n:int,d:string>" and rows(loaded) == [(1, "2"), (3, "x")]
    view = create_external_table(spark, "detected_csv", headed, "CSV", autodetect=True, skip_leading_rows=2)
    assert sorted(map(tuple, view.collect())) == [(1, "2"), (3, "x")]


def test_external_paths_and_short_rows(spark, tmp_path):
    one, two = put(tmp_path / "a", "1|x|3\n2|y\n"), put(tmp_path / "b", "4|z|5\n")
    view = create_external_table(
        spark, "several", [one, two], "CSV", three(), field_delimiter="|", allow_jagged_rows=True)
    assert sorted(map(tuple, view.collect()), key=repr) == [(1, "x", 3), (2, "y", None), (4, "z", 5)]
    for name in "pq":
        spark.createDataFrame([(1, name)], "a long, b string").write.parquet(str(tmp_path / name))
    assert create_external_table(
        spark, "several_parquet", [str(tmp_path / n) for n in "pq"], "PARQUET", autodetect=True).count() == 2


def test_parquet_budget_and_required(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("1", "x"), ("no", "y"), (None, "z")], "a string, b string").write.parquet(path)
    required = [{"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "b", "type": "STRING"}]
    with pytest.raises(BadRecordsError, match="2 bad records, 1 allowed"):
        load_files(spark, path, required, "PARQUET", max_bad_records=1)
    loaded = load_files(spark, path, required, "PARQUET", max_bad_records=2)
    assert rows(loaded) == [(1, "x")] and reasons(loaded) == ["bad value", "no value for a"]


def test_a_load_leaves_nothing_behind(spark, tmp_path):
    from pathlib import Path

    from titlemart.session import scratch_scope, shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    inside = lambda: set(folder.iterdir()) if folder.exists() else set()
    path, table, before = put(tmp_path / "c", "1,x,3\nbad,y,4\n"), str(tmp_path / "out" / "t"), inside()
    with pytest.raises(BadRecordsError):
        load_table(spark, table, path, three())
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())
    loaded = load_table(spark, table, path, three(), max_bad_records=1)
    assert (loaded.rejected_count, loaded.n_files, reasons(loaded)) == (1, 1, ["bad value"])
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"t", "t__load_rejected"}
    with scratch_scope(spark):
        assert load_files(spark, path, three(), max_bad_records=1).rows.count() == 1
    assert inside() == before


def test_load_into_days_and_clusters(spark, tmp_path):
    schema = schema_from_fields([{"name": "a", "type": "INT64"}, {"name": "d", "type": "DATE"}])
    table = str(tmp_path / "t")
    first = put(tmp_path / "one", "1,2024-01-01\n2,2024-01-02\nx,2024-01-02\n")
    options = {"partition_field": "d", "cluster_fields": ["a"], "max_bad_records": 1}
    load_table(spark, table, first, schema, **options)
    load_table(spark, table, first, schema, write_disposition="WRITE_APPEND", **options)
    assert sorted(r.a for r in read_table(spark, table, day="2024-01-02").collect()) == [2, 2]
    day = put(tmp_path / "two", "7,2024-01-02\n")
    load_table(spark, table, day, schema, write_disposition="WRITE_TRUNCATE", partition="2024-01-02")
    assert sorted(r.a for r in read_table(spark, table).collect()) == [1, 1, 7]
    with pytest.raises(Exception, match="row outside day"):
        load_table(spark, table, day, schema, write_disposition="WRITE_TRUNCATE", partition="2024-01-01")
    assert sorted(r.a for r in read_table(spark, table).collect()) == [1, 1, 7]


def test_load_table(spark, tmp_path):
    path, table = put(tmp_path / "c", "1,x,3\n,y,4\n"), str(tmp_path / "t")
    load_table(spark, table, path, three())
    with pytest.raises(ValueError, match="already holds rows"):
        load_table(spark, table, path, three())
    load_table(spark, table, path, three(), write_disposition="WRITE_APPEND")
    assert read_table(spark, table).count() == 4
    required = [{"name": "a", "type": "INT64", "mode": "REQUIRED"},
                {"name": "b", "type": "STRING"}, {"name": "c", "type": "INT64"}]
    with pytest.raises(BadRecordsError, match="no value for a"):
        load_table(spark, str(tmp_path / "r"), path, required)
    load_table(spark, str(tmp_path / "r"), path, required, max_bad_records=1)
    assert read_table(spark, str(tmp_path / "r")).count() == 1


def test_external_tables(spark, tmp_path):
    path = put(tmp_path / "c", "a|b|c\n1|x|3\n2|y|4\n")
    table = create_external_table(
        spark, "outside_csv", path, "CSV", three(), skip_leading_rows=1, field_delimiter="|")
    assert table.count() == 2
    put(tmp_path / "c", "a|b|c\n5|z|6\n", "more.txt")
    spark.catalog.refreshTable("outside_csv")
    assert spark.sql("SELECT sum(a) FROM outside_csv").first()[0] == 8
    spark.sql("DROP TABLE outside_csv")
    assert (tmp_path / "c" / "part.txt").exists()

    bad = put(tmp_path / "b", "1|x|3\nno|y|4\n")
    view = create_external_table(
        spark, "outside_view", bad, "CSV", three(), field_delimiter="|", max_bad_records=1)
    assert [tuple(r) for r in view.collect()] == [(1, "x", 3)]
    strict = put(tmp_path / "j", '{"a":1,"q":2}\n')
    with pytest.raises(BadRecordsError):
        create_external_table(spark, "outside_json", strict, JSON, three())
    loose = create_external_table(
        spark, "outside_json", strict, JSON, three(), ignore_unknown_values=True)
    assert loose.count() == 1
    spark.sql("DROP TABLE outside_json")
    with pytest.raises(ValueError):
        create_external_table(spark, "x", path, "CSV", three(), compression="ZIP")


def test_exact_sample(spark):
    df = spark.range(5000)
    assert exact_sample(df.where("id < 0"), "id", 0).count() == 0
    one, again = (sorted(r.id for r in exact_sample(df, "id", 777, "s").collect()) for _ in range(2))
    assert one == again and len(set(one)) == 777
    assert one != sorted(r.id for r in exact_sample(df, "id", 777, "t").collect())
    assert exact_sample(df, "id", 5000).count() == 5000 and exact_sample(df, "id", 0).count() == 0
    with pytest.raises(ValueError):
        exact_sample(df, "id", 5001)
    half = df.limit(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("id"))
    for n in (1, 49, 50, 51, 80, 100):
        assert exact_sample(half, "id", n).count() == n


def test_pages(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "k").repartition(8)
    assert [r.k for r in read_page(df, "k", 3, start_index=10).collect()] == [30, 33, 36]
    assert [r.k for r in read_page(df, "k", 2, ["k"], page_token=36).collect()] == [39, 42]
    assert read_page(df, "k", 5, start_index=999).count() == 1
    assert read_page(df, "k").count() == 1000
    wide = df.withColumns({"x": df.k, "y": df.k})
    assert read_page(wide, "k", 1, "k, y").columns == ["k", "y"]
    for start in (1, 101, 500, 998, 1500):
        want = [k for k in range(0, 3000, 3)][start:start + 4]
        assert [r.k for r in read_page(df, "k", 4, start_index=start).collect()] == want
    text = df.select(F.col("k").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    places = [None, *sorted(str(k) for k in range(0, 3000, 3))]
    for start in (0, 1, 2, 333, 1000):
        assert [r.k for r in read_page(text, "k", 3, start_index=start).collect()] == places[start:start + 3]
        assert [r.k for r in read_page(text, "k", start_index=start).collect()] == places[start:]


def test_large_pages_are_ranges(spark, monkeypatch):
    """A page that ends at a looked-up key has the rows of one that ends at a count."""
    monkeypatch.setattr(paging, "SMALL_PAGE", 2)
    df = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k")).repartition(8)
    text = df.unionByName(spark.createDataFrame([(None,)], "k string"))
    places = [None, *sorted(str(k) for k in range(0, 3000, 3))]
    for start, size in ((0, 3), (0, 1001), (1, 500), (333, 5000), (998, 3), (1000, 3), (1001, 3), (5000, 3)):
        assert [r.k for r in read_page(text, "k", size, start_index=start).collect()] == places[start:start + size]
    token = places[700]
    assert [r.k for r in read_page(text, "k", 30, page_token=token).collect()] == places[701:731]
    assert [r.k for r in read_page(text, "k", 30, page_token=token, start_index=5).collect()] == places[706:736]
    assert read_page(text.where("false"), "k", 30).count() == 0


def test_pages_have_no_step_of_one_task(spark):
    df = spark.range(0, 50_000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(8)
    plan = lambda page: page._jdf.queryExecution().executedPlan().toString()
    rest = plan(read_page(df, "k", start_index=40_000))
    assert "SinglePartition" not in rest and "CollectLimit" not in rest and "offset" not in rest.lower()
    assert "TakeOrderedAndProject(limit=50," in plan(read_page(df, "k", 50, start_index=40_000))
    million = spark.range(0, 1_200_000, 1, 8).withColumnRenamed("id", "k")
    for start in (0, 100_000):
        large = read_page(million, "k", 1_000_000, start_index=start)
        text = plan(large)
        assert "TakeOrdered" not in text and "Limit" not in text and "SinglePartition" not in text
        assert large.agg(F.count("*"), F.min("k"), F.max("k")).first() == (1_000_000, start, start + 999_999)


def test_split_newlines_are_written_by_several_tasks(spark, tmp_path):
    """No task writes the whole table: each that reads a part of it writes a file below the heading."""
    rows = [(i, f'a "{i}"\nb, c', "en", None, i) for i in range(40)] + [(None, None, None, "s", None), (41, "", "", "", 0)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    made = _headed_files(spark)
    try:
        found = loading.csv_quoted_newlines_split(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    assert {r.n for r in found} == {42} and len(found) == 42
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert {r.text for r in found if r.doc_id is not None and r.doc_id < 40} == {digest(r[1]) for r in rows[:40]}
    assert len(_headed_files(spark) - made) > 1


def _headed_files(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    return {str(p) for p in folder.glob("*-*/part-*.txt")}
