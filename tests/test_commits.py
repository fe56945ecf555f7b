"""Writes that break off at any rename, and merging of streamed batches."""

import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from titlemart.sinks import compact_table, create_empty_table, read_table, write_table
from titlemart.sinks import commits
from titlemart.sinks.tables import INSERTED, describe_table, put_batch
from titlemart.sources import load_table
from titlemart.streaming import insert_stream

FIELDS = [{"name": "a", "type": "INT64"}, {"name": "d", "type": "DATE"}]


class Died(BaseException):
    """The process ends: nothing after it runs."""


@pytest.fixture()
def fail(monkeypatch):
    """Let the n-th rename raise, and ``also`` those after it."""
    plain, lock = commits.rename_once, threading.Lock()

    def at(n, error=OSError, also=0):
        count = [0]

        def rename(spark, source, target):
            with lock:
                count[0] += 1
                mine = count[0]
            if n <= mine <= n + also:
                raise error(f"rename {mine}")
            plain(spark, source, target)

        monkeypatch.setattr(commits, "rename_once", rename)
        monkeypatch.setattr(commits, "RENAMES_AT_ONCE", 1)

    at.never = lambda: monkeypatch.setattr(commits, "rename_once", plain)
    return at


def days(spark, first, n):
    return spark.range(first, first + n, 1, 3).select(F.col("id").alias("a"), F.expr("date_add(date'2024-01-01', cast(id % 4 as int))").alias("d"))


def rows(spark, table):
    return sorted(r.a for r in read_table(spark, table).collect())


def left_beside(table):
    return sorted(os.path.basename(p) for p in glob.glob(f"{table}__*") if os.listdir(p)) + os.listdir(f"{table}/_commits")


def append(spark, table, **more):
    write_table(days(spark, 100, 20), table, "WRITE_APPEND", **more)
    return list(range(8)) + list(range(100, 120))


def append_column(spark, table, **more):
    wide = days(spark, 100, 20).withColumn("e", F.lit("x"))
    write_table(wide, table, "WRITE_APPEND", schema_update_options=["ALLOW_FIELD_ADDITION"], **more)
    return list(range(8)) + list(range(100, 120))


def replace(spark, table, **more):
    write_table(days(spark, 100, 20), table, "WRITE_TRUNCATE", **more)
    return list(range(100, 120))


def replace_day(spark, table, **more):
    write_table(days(spark, 100, 20).where("d = '2024-01-02'"), table, "WRITE_TRUNCATE", partition="2024-01-02", **more)
    return [i for i in range(8) if i % 4 != 1] + [i for i in range(100, 120) if i % 4 == 1]


def load(spark, table, **more):
    path = f"{table}_in"
    if not os.path.exists(path):
        lines = days(spark, 100, 20).select(F.to_json(F.struct("a", "d")).alias("value"))
        lines.union(spark.createDataFrame([('{"a":',)], "value string")).write.text(path)
    schema = describe_table(spark, table)[0]
    loaded = load_table(spark, table, path, schema, "NEWLINE_DELIMITED_JSON", write_disposition="WRITE_APPEND", max_bad_records=1, **more)
    assert loaded.rejected_count == 1 and [r._record for r in loaded.rejected.collect()] == ['{"a":']
    return list(range(8)) + list(range(100, 120))


CHANGES = [append, append_column, replace, replace_day, load]


@pytest.fixture(params=[None, "d"])
def table(spark, tmp_path, request):
    path = str(tmp_path / "t")
    write_table(days(spark, 0, 8), path, partition_field=request.param)
    return path


def steps_of(spark, table, change, fail):
    """How many renames a change makes, found on a copy."""
    import shutil

    copy = f"{table}_copy"
    shutil.copytree(table, copy)
    seen = []
    plain = commits.rename_once
    commits.rename_once = lambda *a: (seen.append(a), plain(*a))
    try:
        change(spark, copy)
    finally:
        commits.rename_once = plain
    return len(seen)


def skip_unpartitioned(spark, table, change):
    if change is replace_day and not describe_table(spark, table)[1]["partition_field"]:
        pytest.skip("no days")


@pytest.mark.parametrize("change", CHANGES)
def test_an_error_leaves_the_table_as_it_was(spark, table, fail, change):
    skip_unpartitioned(spark, table, change)
    n = steps_of(spark, table, change, fail)
    columns = read_table(spark, table).columns
    for at in sorted({1, 2, n // 2 + 1, n}):
        fail(at)
        with pytest.raises(OSError, match="rename"):
            change(spark, table)
        fail.never()
        assert rows(spark, table) == list(range(8)) and read_table(spark, table).columns == columns
        assert not left_beside(table)
    change(spark, table)
    assert sorted(rows(spark, table)) == sorted(_expected(change))
    assert [n for n in left_beside(table) if "rejected" not in n] == []


def _expected(change):
    old, new = list(range(8)), list(range(100, 120))
    if change is replace:
        return new
    if change is replace_day:
        return [i for i in old if i % 4 != 1] + [i for i in new if i % 4 == 1]
    return old + new


@pytest.mark.parametrize("change", CHANGES)
def test_what_a_process_left_is_finished_and_a_retry_adds_nothing(spark, table, fail, change):
    skip_unpartitioned(spark, table, change)
    n = steps_of(spark, table, change, fail)
    fail(n // 2 + 1, Died)
    with pytest.raises(Died):
        change(spark, table, load_id="job 7/é")
    fail.never()
    assert len(os.listdir(f"{table}/_commits")) >= 1
    assert rows(spark, table) == sorted(_expected(change))
    change(spark, table, load_id="job 7/é")
    assert rows(spark, table) == sorted(_expected(change))
    assert [n for n in left_beside(table) if "rejected" not in n] == []
    if change is append:
        append(spark, table, load_id="another")
        assert len(rows(spark, table)) == 8 + 20 + 20


def test_an_undo_that_fails_is_made_good_later(spark, table, fail):
    fail(2, OSError, also=50)
    with pytest.raises(OSError):
        append(spark, table)
    assert os.listdir(f"{table}/_commits")
    with pytest.raises(OSError):  # nobody sees half of it
        read_table(spark, table)
    fail.never()
    assert rows(spark, table) == list(range(8)) and not left_beside(table)


def test_a_first_write_that_fails_leaves_no_table(spark, tmp_path, fail):
    path = str(tmp_path / "new")
    fail(2)
    with pytest.raises(OSError):
        write_table(days(spark, 0, 8), path)
    fail.never()
    from titlemart.sinks import table_exists

    assert not table_exists(spark, path)
    write_table(days(spark, 0, 8), path)
    assert rows(spark, path) == list(range(8))


def test_readers_may_finish_a_change_at_once(spark, table, fail):
    fail(2, Died)
    with pytest.raises(Died):
        append(spark, table)
    fail.never()
    errors = []

    def look():
        try:
            commits.settle(spark, table)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=look) for _ in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and len(rows(spark, table)) == 28


def many_batches(spark, table, n, day):
    """``n`` batches of two streams, as the stream writes them."""
    from titlemart.sinks.tables import BATCH, DAY

    df = days(spark, 1000, 3 * n).withColumn(BATCH, F.concat_ws("-", F.expr("if(a % 2 = 0, 's-1', 's-2')"), (F.col("a") - 1000).cast("int") % n))
    if day:
        df = df.withColumn(DAY, F.col("d"))
    df.coalesce(1).write.partitionBy(BATCH, *([DAY] if day else [])).parquet(f"{table}/{INSERTED}")
    return list(range(1000, 1000 + 3 * n))


def files(table):
    return [f for f in glob.glob(f"{table}/**/*.parquet", recursive=True)]


def test_compaction(spark, table):
    partitioned = describe_table(spark, table)[1]["partition_field"] is not None
    more = many_batches(spark, table, 500, partitioned)
    assert rows(spark, table) == list(range(8)) + more
    before = len(files(table))
    assert compact_table(spark, table, 10_000) == 0 and len(files(table)) == before > 500
    assert compact_table(spark, table) == 500
    assert rows(spark, table) == list(range(8)) + more
    assert len(files(table)) < 40 and not glob.glob(f"{table}/{INSERTED}/_batch*") and not left_beside(table)
    assert compact_table(spark, table) == 0
    assert json.load(open(f"{table}/_merged.json")) == {"s-1": 498, "s-2": 499}
    put_batch(days(spark, 5000, 1), table, "s-1-498")  # a replay
    assert rows(spark, table) == list(range(8)) + more
    put_batch(days(spark, 5000, 1), table, "s-1-499")
    put_batch(days(spark, 6000, 1), table, "s-3-0")
    assert rows(spark, table) == list(range(8)) + more + [5000, 6000]
    if partitioned:
        assert sorted(r.a for r in read_table(spark, table, day="2024-01-02").collect()) == [i for i in [*range(8), *more, 5000, 6000] if i % 4 == 1]


@pytest.mark.parametrize("error", [OSError, Died])
def test_compaction_that_breaks_off(spark, table, fail, error):
    more = many_batches(spark, table, 4, describe_table(spark, table)[1]["partition_field"] is not None)
    fail(3, error)
    with pytest.raises(error):
        compact_table(spark, table)
    fail.never()
    assert rows(spark, table) == list(range(8)) + more
    compact_table(spark, table)
    assert rows(spark, table) == list(range(8)) + more and not left_beside(table)


def test_compaction_keeps_clusters(spark, tmp_path):
    path = str(tmp_path / "t")
    create_empty_table(spark, path, FIELDS, cluster_fields=["a"])
    more = many_batches(spark, path, 30, False)
    compact_table(spark, path)
    assert rows(spark, path) == more
    for f in files(path):
        own = [r.a for r in spark.read.parquet(f).collect()]
        assert own == sorted(own)


def test_a_stream_compacts_as_it_goes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = str(tmp_path / "t")
    create_empty_table(spark, path, FIELDS, partition_field="d")
    for i in range(7):
        (tmp_path / "in" / str(i)).write_text(json.dumps({"a": i, "d": f"2024-01-0{i % 3 + 1}"}))
    insert_stream(spark, str(tmp_path / "in"), path, str(tmp_path / "c"), max_files_per_batch=1, compact_every=3).awaitTermination()
    assert rows(spark, path) == list(range(7)) and len(glob.glob(f"{path}/{INSERTED}/_batch=*")) == 1


def test_truncation_forgets_rows_but_not_what_was_merged(spark, table):
    many_batches(spark, table, 3, describe_table(spark, table)[1]["partition_field"] is not None)
    compact_table(spark, table)
    write_table(days(spark, 0, 2), table, "WRITE_TRUNCATE")
    put_batch(days(spark, 5000, 1), table, "s-2-1")
    assert rows(spark, table) == [0, 1]
