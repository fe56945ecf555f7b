"""CSV files with line breaks in quotes, split over tasks, against a reading of each file in one piece."""

import random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from titlemart.schema import schema_from_fields
from titlemart.sources import load_files
from titlemart.sources import quoted
from titlemart.sources.quoted import LineRule

TEXTS = schema_from_fields([{"name": n, "type": "STRING"} for n in "abc"])


def records_of(text, delimiter=",", quote='"'):
    """Records of a text, character by character."""
    out, record, state = [], "", "begin"  # of a field; plain, quoted, after a quote
    for c in text:
        if state != "quoted" and c == "\n":
            out.append(record.removesuffix("\r"))
            record, state = "", "begin"
            continue
        record += c
        if state == "begin":
            state = "quoted" if c == quote else "begin" if c == delimiter else "plain"
        elif state == "plain":
            state = "begin" if c == delimiter else "plain"
        elif state == "quoted":
            state = "after" if c == quote else "quoted"
        else:
            state = "quoted" if c == quote else "begin" if c == delimiter else "plain"
    return [r for r in [*out, record] if r]


def test_rule_of_a_line():
    rng = random.Random(1)
    for delimiter, quote in ((",", '"'), ("|", "'"), ("]", "^"), ("||", '"')):
        rule = LineRule(delimiter, quote)
        for _ in range(3000):
            line = "".join(rng.choice([quote, quote, delimiter, "x", " "]) for _ in range(rng.randrange(9)))
            if len(delimiter) == 1:
                for open_ in (False, True):
                    probe = (quote if open_ else "") + line + "\n"
                    ended = records_of(probe + "END", delimiter, quote)[-1:] == ["END"]
                    assert rule.open_after(line, open_) == (not ended), (line, open_)
    assert not LineRule("||", '"').open_after('"a|b"||c|"', False)


def text_of(rng, n, end="\n"):
    def field():
        if rng.random() < 0.3:
            return rng.choice(["x", "", "a b", 'it"s', " 'y'", "é" * 9])
        inner = "".join(rng.choice(["w", ",", '""', end, " ", "x,y"]) for _ in range(rng.randrange(0, 9)))
        return f'"{inner}"'

    return "".join(",".join(field() for _ in range(3)) + rng.choice([end, end, end * 2]) for _ in range(n))


def put(tmp_path, *texts):
    tmp_path.mkdir(exist_ok=True)
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.csv").write_text(text, newline="")
    return str(tmp_path)


@pytest.fixture()
def small_blocks(spark):
    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def in_blocks(lines, cuts, skip, batch):
    """What the two passes make of lines cut into blocks, all in this process."""
    edges = [0, *cuts, len(lines)]
    rows = [(at, line) for at, (a, b) in zip(edges, zip(edges, edges[1:])) for line in lines[a:b]]
    batches = [
        pa.RecordBatch.from_pydict({"value": [x for _, x in part], "file": ["f"] * len(part), "start": [at for at, _ in part]})
        for part in (rows[i : i + batch] for i in range(0, len(rows), batch))
    ]
    rule = LineRule(",", '"')
    survey = [r for b in quoted._survey(rule, '"', 1 << 20)(iter(batches)) for r in b.to_pylist()]
    blocks = [SimpleNamespace(**r, no_out=r["tail_out"] is None, no_in=r["tail_in"] is None, no_head=r["head"] is None) for r in survey]
    marks, skips, left_out = quoted.follow(blocks, skip)
    whole = [v for b in quoted._records(rule, '"', {m[:2] for m in marks}, skips, skip)(iter(batches)) for v in b["value"].to_pylist()]
    owners, parts = {m[:2]: m[2] for m in marks}, {}
    for b in blocks:
        inside = (b.file, b.start) in owners
        if inside:
            parts.setdefault(owners[b.file, b.start], []).append((b.start, b.head))
        if (b.open_in and b.begun_in) if inside else (b.open_out and b.begun_out):
            parts.setdefault(b.start, []).append((b.start, b.tail_in if inside else b.tail_out))
    kept = [o for o in parts if ("f", o) not in left_out]
    return whole + [quoted._unbroken("\n".join(t for _, t in sorted(parts[o]))) for o in kept]


def test_any_cuts():
    rng = random.Random(4)
    for i in range(400):
        text = text_of(rng, rng.randrange(0, 12), rng.choice(["\n", "\r\n"])) + rng.choice(["", 'a,"open\nx,y\n"",z\n', '"\n\n\n"\n', 'q,"w"junk\n'])
        lines = text.removesuffix("\n").split("\n") if text else []
        all_, record, rule, open_ = [], [], LineRule(",", '"'), False
        for line in lines:
            record.append(line)
            open_ = rule.open_after(line, open_)
            if not open_:
                all_.append(quoted._unbroken("\n".join(record)))
                record = []
        all_ += [quoted._unbroken("\n".join(record))] if record else []
        assert [r for r in all_ if r] == [r.replace("\r\n", "\n") for r in records_of(text + ("" if text.endswith("\n") else "\n"))] or "\r" in text or "open" in text
        for skip in (0, 1, 3):
            cuts = sorted(rng.sample(range(1, max(2, len(lines))), min(rng.randrange(0, 6), max(0, len(lines) - 1))))
            got = in_blocks(lines, cuts, skip, rng.choice([1, 2, 7, 1000]))
            assert sorted(got) == sorted(all_[skip:]), (text, cuts, skip)


def loaded(spark, path, **options):
    return sorted((tuple(r) for r in load_files(spark, path, TEXTS, allow_quoted_newlines=True, max_bad_records=10**6, **options).rows.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"skip_leading_rows": 1}, {"null_marker": "x"}, {"allow_jagged_rows": True}, {"encoding": "ISO-8859-1"}])
def test_same_rows_as_in_one_piece(spark, tmp_path, small_blocks, monkeypatch, options):
    path = put(tmp_path / "in", *[text_of(random.Random(i), 40, end) for i, end in enumerate(["\n", "\r\n", "\n"])])
    import titlemart.sources.parsing as parsing

    monkeypatch.setattr(parsing, "quoted_records", lambda *a: None)
    whole = loaded(spark, path, **options)
    monkeypatch.undo()
    small_blocks(600)
    assert loaded(spark, path, **options) == whole and len(whole) > 60


def test_one_file_is_several_tasks(spark, tmp_path, small_blocks):
    path = put(tmp_path / "in", text_of(random.Random(5), 400))
    small_blocks(2000)
    got = quoted.quoted_records(spark, path, ",", '"', "UTF-8", 0)
    assert got.rdd.getNumPartitions() > 4
    assert got.withColumn("p", F.spark_partition_id()).groupBy("p").count().count() > 4


def test_a_long_record_at_a_border(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(quoted, "LONG", 30)
    path = put(tmp_path / "in", 'a,"' + "x\n" * 500 + '",c\n' + "d,e,f\n" * 50)
    small_blocks(400)
    assert quoted.quoted_records(spark, path, ",", '"', "UTF-8", 0) is None
    assert loaded(spark, path) == sorted([("a", "x\n" * 500, "c"), *[("d", "e", "f")] * 50], key=repr)


def test_other_signs(spark, tmp_path, small_blocks):
    path = put(tmp_path / "in", "1|'a\n|b'|'q'\n2|'it''s'|'\n\n'\n" * 30)
    small_blocks(300)
    got = loaded(spark, path, field_delimiter="|", quote="'")
    assert got == sorted([("1", "a\n|b", "q"), ("2", "it's", "\n\n")] * 30, key=repr)


def test_no_quotes_and_no_files(spark, tmp_path, small_blocks):
    small_blocks(100)
    assert loaded(spark, put(tmp_path / "a", "x,y,z\n" * 40)) == [("x", "y", "z")] * 40
    assert loaded(spark, put(tmp_path / "b", "")) == []
