"""Records with line breaks in quotes, out of files that several tasks read.

Whether a line begins a record depends on all quotes before it. A first pass finds, for
every block of a file, how it ends for either way it may begin (outside or inside quotes), and the text of
the record that is open at its borders. The blocks are then followed in order, a few numbers
each, and a second pass puts lines together, each block knowing how it begins. Records that
cross a border are joined from the texts of the first pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemart.session import importable, write_shared

LONG = 1 << 20  # characters of a record at a block's border; with a longer one, files are read whole
BYTEWISE = re.compile("utf-?8|us-ascii|iso-?8859-.*|latin-?1|windows-125.|cp125.", re.I)  # a line break is a byte
SURVEY = (
    "file string, start long, open_out boolean, open_in boolean, begun_out long, begun_in long, "
    "tail_out string, tail_in string, head string"
)


def decoded(encoding: str) -> Column:
    """``value`` of a text reader, which takes bytes as they are, in its encoding."""
    value = F.col("value")
    return value if encoding.upper() in ("UTF-8", "UTF8") else F.decode(value.cast("binary"), encoding)


class LineRule:
    """What quotes do from the begin of a line on. A field is quoted if its first character is a quote, and a
    quote in it is doubled; what follows its closing quote belongs to it up to the delimiter."""

    def __init__(self, delimiter: str, quote: str):
        q, d = re.escape(quote), re.escape(delimiter)
        plain = f"(?:(?!{d}).)*+" if len(delimiter) > 1 else f"[^{d}]*+"
        rest = f"(?:[^{q}]|{q}{q})*+{q}{plain}"
        field = f"(?:{q}{rest}|(?!{q}){plain})"
        self._outside = re.compile(f"{field}(?:{d}{field})*+", re.S)
        self._inside = re.compile(f"{rest}(?:{d}{field})*+", re.S)

    def open_after(self, line: str, open_: bool) -> bool:
        """Whether a quoted field is open behind a line, given that one was before it."""
        return not (self._inside if open_ else self._outside).fullmatch(line)


class _Reading:
    """Lines of a block taken as begun outside or inside quotes."""

    def __init__(self, inside: bool):
        self.open, self.begun = inside, 0
        self.head: list[str] | None = None
        self.lines: list[str] = []  # of the record that is open or has just ended

    def plain(self, lines: list[str]) -> None:
        if self.open:
            self.lines += lines
        else:
            self.begun += len(lines)

    def quoted(self, line: str, rule: LineRule) -> list[str] | None:
        """The lines of the record that ends with this one, if one that began here does."""
        was = self.open
        self.open = rule.open_after(line, was)
        if not was:
            self.begun += 1
            self.lines = []
        self.lines.append(line)
        if self.open:
            return None
        if self.begun == 0:
            self.head, self.lines = self.lines, []
            return None
        return self.lines


def _text(lines: list[str] | None, most: int) -> str | None:
    """The lines as a text unless it is long."""
    if lines is None or sum(map(len, lines)) > most:
        return None
    return "\n".join(lines)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of batches by file and block, as they come."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        starts = batch.column("start").to_numpy()
        cuts = [0, *((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])).nonzero()[0] + 1, batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(int(a), int(b - a))
            yield part.column("file")[0].as_py(), int(starts[a]), part


def _walk(part: pa.RecordBatch, quote: str) -> Iterator[tuple[list[str], str | None]]:
    """Lines without quotes, and the line with one that follows them."""
    column = part.column("value")
    lines = column.to_pylist()
    done = 0
    for at in pc.indices_nonzero(pc.match_substring(column, quote)).to_pylist():
        yield lines[done:at], lines[at]
        done = at + 1
    yield lines[done:], None


def _survey(rule: LineRule, quote: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, out, in_, same = None, None, None, None

        def row() -> pa.RecordBatch:
            if same is not None:  # both readings have met; from there on they agree
                in_.begun += out.begun - same
                in_.open, in_.lines = out.open, out.lines
            if in_.begun == 0 and in_.open:
                in_.head, in_.lines = in_.lines, []
            values = [
                *where, out.open, in_.open, out.begun, in_.begun,
                _text(out.lines, most) if out.open else None, _text(in_.lines, most) if in_.open and in_.begun else None, _text(in_.head, most),
            ]
            names = [f.split()[0] for f in SURVEY.split(", ")]
            return pa.RecordBatch.from_pylist([dict(zip(names, values))], SURVEY_ARROW)

        for file, start, part in _runs(batches):
            if where != (file, start):
                if where is not None:
                    yield row()
                where, out, in_, same = (file, start), _Reading(False), _Reading(True), None
            for before, line in _walk(part, quote):
                for reading in (out, in_) if same is None else (out,):
                    reading.plain(before)
                    if line is not None:
                        reading.quoted(line, rule)
                if same is None and not out.open and not in_.open:
                    same = out.begun
        if where is not None:
            yield row()

    return run


SURVEY_ARROW = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[kind])
        for name, kind in (f.split() for f in SURVEY.split(", "))
    ]
)


def _records(rule: LineRule, quote: str, inside: set, skips: dict, skip: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, reading, drop = None, None, 0
        for file, start, part in _runs(batches):
            if where != (file, start):
                where, reading = (file, start), _Reading((file, start) in inside)
                drop = skips.get(where, skip if start == 0 else 0)
            whole: list[str] = []
            for before, line in _walk(part, quote):
                if not reading.open:
                    whole += before[max(0, drop - reading.begun) :]
                reading.plain(before)
                if line is not None:
                    done = reading.quoted(line, rule)
                    if done is not None and reading.begun > drop:
                        whole.append(done[0] if len(done) == 1 else "\n".join(done))
            yield pa.RecordBatch.from_arrays([pa.array([_unbroken(w) for w in whole], pa.string())], names=["value"])

    return run


def follow(blocks: Iterable, skip: int) -> tuple[list, dict, list] | None:
    """From the blocks of files in order: those that begin inside quotes, as ``(file, start, block in which the
    record began)``; records to skip in blocks where that isn't plain; border records to leave out. None if one is long."""
    marks, skips, left_out = [], {}, []
    file = None
    for r in blocks:
        if r.file != file:
            file, open_, owner, count = r.file, False, None, 0
        was = open_
        begun, open_ = (r.begun_in, r.open_in) if was else (r.begun_out, r.open_out)
        tail = open_ and begun > 0
        if was and r.no_head or tail and (r.no_in if was else r.no_out):
            return None
        if was:
            marks.append((file, r.start, owner))
        if count < skip and (r.start > 0 or begun < skip):
            skips[file, r.start] = skip - count
        count += begun
        if tail:
            owner = r.start
            if count <= skip:
                left_out.append((file, owner))
    return marks, skips, left_out


def _unbroken(record: str) -> str:
    """A record without its line's end; where that is ``\\r\\n``, such breaks inside it are ``\\n``."""
    return record[:-1].replace("\r\n", "\n") if record.endswith("\r") else record


def quoted_records(spark: SparkSession, paths, delimiter: str, quote: str, encoding: str, skip: int) -> DataFrame | None:
    """``value``, a record each, of CSV files whose quoted fields may hold line breaks, or None.

    The first ``skip`` records of each file are left out. Lines end in ``\\n`` or ``\\r\\n``; a record that ends
    in the latter has its inner breaks of that kind as ``\\n``. None for encodings of several bytes a sign,
    and if a record of over LONG characters crosses the border of two blocks.
    """
    if not BYTEWISE.fullmatch(encoding):
        return None
    importable(spark)
    rule = LineRule(delimiter, quote)
    lines = spark.read.option("lineSep", "\n").text(paths)
    lines = lines.select(decoded(encoding).alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    survey = write_shared(lines.mapInArrow(_survey(rule, quote, LONG), SURVEY), "survey")

    # a few numbers per block, one after the other, as Spark's own driver holds them per block too
    numbers = survey.select(
        "file", "start", "open_out", "open_in", "begun_out", "begun_in",
        F.col("tail_out").isNull().alias("no_out"), F.col("tail_in").isNull().alias("no_in"), F.col("head").isNull().alias("no_head"),
    )
    followed = follow(numbers.orderBy("file", "start").toLocalIterator(), skip)
    if followed is None:
        return None
    marks, skips, left_out = followed

    whole = lines.mapInArrow(_records(rule, quote, {m[:2] for m in marks}, skips, skip), "value string")
    marked = spark.createDataFrame(marks, "file string, start long, owner long")
    known = survey.join(marked, ["file", "start"], "left")
    inside = F.col("owner").isNotNull()
    tails = known.where(F.when(inside, F.col("open_in") & (F.col("begun_in") > 0)).otherwise(F.col("open_out") & (F.col("begun_out") > 0)))
    tails = tails.select("file", F.col("start").alias("owner"), "start", F.when(inside, F.col("tail_in")).otherwise(F.col("tail_out")).alias("text"))
    heads = known.where(inside).select("file", "owner", "start", F.col("head").alias("text"))
    dropped = spark.createDataFrame(left_out, "file string, owner long")
    parts = tails.unionByName(heads).join(dropped, ["file", "owner"], "left_anti").groupBy("file", "owner")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "\n")
    joined = parts.agg(text.alias("value"))
    unbroken = F.replace(F.expr("left(value, length(value) - 1)"), F.lit("\r\n"), F.lit("\n"))
    joined = joined.select(F.when(F.endswith("value", F.lit("\r")), unbroken).otherwise(F.col("value")).alias("value"))
    return whole.unionByName(joined)
