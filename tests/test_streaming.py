import json

import pytest

from titlemart.schema import schema_from_fields
from titlemart.sinks import create_empty_table, read_table, write_table
from titlemart.streaming import insert_stream, read_rejected

GOOD, BAD, EXTRA = {"a": 1, "b": "x"}, '{"a":', {"a": 2, "zzz": 1}


@pytest.fixture()
def place(spark, tmp_path):
    schema = schema_from_fields([{"name": "a", "type": "INT64"}, {"name": "b", "type": "STRING"}])
    (tmp_path / "in").mkdir()

    session = spark

    class Place:
        spark = session
        table, progress = (str(tmp_path / n) for n in ("t", "c"))

        def put(self, name, *rows):
            lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
            (tmp_path / "in" / name).write_text("\n".join(lines))

        def run(self, **policy):
            query = insert_stream(
                spark, str(tmp_path / "in"), self.table, self.progress, **policy)
            query.awaitTermination()

        def rows(self):
            return sorted(r.a for r in read_table(spark, self.table).collect())

        def reasons(self):
            return sorted(r._reason for r in read_rejected(spark, self.table).collect())

    create_empty_table(spark, Place.table, schema)
    return Place()


def test_a_file_with_an_invalid_row_is_refused_whole(place):
    place.put("1", GOOD)
    place.run()
    place.put("2", {"a": 5}, BAD)
    place.run()
    place.put("3", {"a": 6})
    place.run()
    assert place.rows() == [1, 6] and place.reasons() == ["malformed", "refused with its request"]
    kept = {r._record for r in read_rejected(place.spark, place.table).collect()}
    assert kept == {BAD, json.dumps({"a": 5})}


@pytest.mark.parametrize("files", [1, 1000])
def test_a_request_is_a_file_whatever_the_batch(place, files):
    place.put("1", GOOD)
    place.put("2", {"a": 2}, BAD)
    place.put("3", {"a": 3})
    place.run(max_files_per_batch=files)
    assert place.rows() == [1, 3] and place.reasons() == ["malformed", "refused with its request"]


def test_streams_and_checkpoints_share_a_table(place, spark, tmp_path):
    place.put("1", GOOD)
    place.run()
    (tmp_path / "in2").mkdir()
    (tmp_path / "in2" / "x").write_text(json.dumps({"a": 2}))
    insert_stream(spark, str(tmp_path / "in2"), place.table, str(tmp_path / "c2")).awaitTermination()
    assert place.rows() == [1, 2]
    assert read_rejected(spark, place.table).isEmpty()


def test_stream_that_goes_on(place, spark, tmp_path):
    place.put("1", GOOD)
    query = insert_stream(
        spark, str(tmp_path / "in"), place.table, place.progress, every="0 seconds")
    try:
        query.processAllAvailable()
        place.put("2", {"a": 4})
        query.processAllAvailable()
    finally:
        query.stop()
    assert place.rows() == [1, 4]


def test_skip_invalid_rows(place):
    place.put("1", GOOD, BAD, EXTRA)
    place.run(skip_invalid_rows=True)
    assert place.rows() == [1] and place.reasons() == ["malformed", "unknown field"]


def test_ignore_unknown_values(place):
    place.put("1", GOOD, EXTRA)
    place.run(ignore_unknown_values=True)
    assert place.rows() == [1, 2]


def test_fail_on_error_then_replay_stores_nothing_twice(place):
    place.put("1", GOOD, BAD)
    for _ in range(2):  # the failed batch is replayed by the second run
        with pytest.raises(Exception, match="1 rows refused"):
            place.run(skip_invalid_rows=True, fail_on_error=True)
    assert place.rows() == [1] and place.reasons() == ["malformed"]


def test_streamed_rows_belong_to_the_table(spark, place):
    write_table(spark.createDataFrame([(9, "y")], "a long, b string"), place.table)
    place.put("1", GOOD)
    place.run()
    assert place.rows() == [1, 9]
    with pytest.raises(ValueError, match="already holds rows"):
        write_table(read_table(spark, place.table), place.table)
    write_table(read_table(spark, place.table).where("a = 1"), place.table, "WRITE_TRUNCATE")
    assert place.rows() == [1]


def test_streaming_into_days(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [{"a": i, "d": f"2024-01-0{i}"} for i in (1, 2)] + [{"d": "2024-01-03"}]
    (tmp_path / "in" / "1").write_text("\n".join(map(json.dumps, lines)))
    fields = [{"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "d", "type": "DATE"}]
    table = str(tmp_path / "t")
    create_empty_table(spark, table, fields, partition_field="d")
    insert_stream(
        spark, str(tmp_path / "in"), table, str(tmp_path / "c"), skip_invalid_rows=True
    ).awaitTermination()
    assert [r.a for r in read_table(spark, table, day="2024-01-02").collect()] == [2]
    assert [r._reason for r in read_rejected(spark, table).collect()] == ["no value for a"]
    seven = read_table(spark, table, day="2024-01-02").selectExpr("a + 5 AS a", "d")
    write_table(seven, table, "WRITE_TRUNCATE", partition="2024-01-02")
    assert sorted(r.a for r in read_table(spark, table).collect()) == [1, 7]
