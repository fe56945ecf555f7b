"""Removal of repeated word windows by super-k-mer partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemart.llm import text as tx
from titlemart.llm.tables import ROW, settled, stored, with_row

GRAM = 10  # words of a minimiser
HOT_STRINGS = 1000  # different packed strings of a bucket above which they are cut into pieces
CHUNKS = (8, 1)  # windows of a piece, at the first cut and at the second

STRINGS = f"{ROW}, bucket long, before int, n int, lead long, whole long, words binary"


def _runs(texts: list[bytes], span: int):
    """Runs of windows with one minimiser, block by block."""
    gram = min(GRAM, span)
    for first, end, data, starts in tx.blocks(texts):
        begin, close, hashes, bounds = tx.words(data, starts)
        sums = tx.prefix_hash(hashes)
        at = np.arange(len(hashes))
        grams = tx.span_hash(sums, at, np.minimum(at + gram, len(hashes)))
        doc, anchor, lead, last = tx.anchored_runs(grams, bounds, span, gram)
        yield first, end, data, begin, close, bounds, sums, grams, doc, anchor, lead, last


def anchors(docs: DataFrame, span: int) -> DataFrame:
    """Minimisers of every row: ``(row, anchor)``, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, _, _, _, _, _, _, grams, doc, anchor, _, _ in _runs(tx.texts_of(batch.column(1)), span):
                seen = np.unique(np.stack([doc.astype(np.uint64), grams[anchor]]), axis=1) if len(doc) else np.zeros((2, 0), np.uint64)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(first + seen[0].astype(np.int64))), pa.array(tx.signed(seen[1]))], names=["row", "anchor"])

    return docs.select("row", "text").mapInArrow(run, f"{ROW}, anchor long")


def packed(docs: DataFrame, span: int) -> DataFrame:
    """Packed strings around the wanted minimisers of ``docs(row, text, wanted)``.

    A string holds a run of windows, its words joined by one space: ``bucket`` is the
    minimiser's hash, ``before`` the words of the string in front of it, ``lead`` the place
    of its first word in the document, and ``whole`` a hash of the string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0), batch.column(2).to_pylist()
            for first, _, data, begin, close, bounds, sums, grams, doc, anchor, lead, last in _runs(tx.texts_of(batch.column(1)), span):
                good = tx.wanted_runs(doc, grams[anchor], wanted[first:])
                doc, anchor, lead, last = doc[good], anchor[good], lead[good], last[good]
                raw = data.tobytes()
                strings = [b" ".join(raw[s:e].split()) for s, e in zip(begin[lead], close[last + span - 1])]
                whole = tx.span_hash(sums, lead, last + span)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(first + doc)),
                        pa.array(tx.signed(grams[anchor])),
                        pa.array((anchor - lead).astype(np.int32)),
                        pa.array((last - lead + 1).astype(np.int32)),
                        pa.array((lead - bounds[doc]).astype(np.int64)),
                        pa.array(tx.signed(whole)),
                        tx.binary_list(strings),
                    ],
                    names=["row", "bucket", "before", "n", "lead", "whole", "words"],
                )

    return docs.select("row", "text", "wanted").mapInArrow(run, STRINGS)


def repacked(strings: DataFrame, span: int, chunk: int) -> DataFrame:
    """Packed strings cut into pieces of up to ``chunk`` windows, with the core's hash as bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("words").to_pylist()
            before, n, lead, bucket = (np.asarray(batch.column(c)).astype(np.int64) for c in ("before", "n", "lead", "bucket"))
            data, starts = _laid(texts)
            begin, close, hashes, bounds = tx.words(data, starts)
            sums = tx.prefix_hash(hashes)
            row, number, step, windows, core, core_end = tx.pieces(before, n, span, chunk)
            at = bounds[row] + step
            end = at + windows + span - 1
            place = np.uint64(tx.BASE) * (number + 1).astype(np.uint64) ^ tx.mix(bucket[row].view(np.uint64))
            keys = tx.mix(tx.span_hash(sums, bounds[row] + core, bounds[row] + core_end) ^ place)
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(row)),
                    pa.array(tx.signed(keys)),
                    pa.array((before[row] - step).astype(np.int32)),
                    pa.array(windows.astype(np.int32)),
                    pa.array(lead[row] + step),
                    pa.array(tx.signed(tx.span_hash(sums, at, end))),
                    tx.binary_list([raw[s:e] for s, e in zip(begin[at], close[end - 1])]),
                ],
                names=["row", "bucket", "before", "n", "lead", "whole", "words"],
            )

    return strings.select("row", "bucket", "before", "n", "lead", "whole", "words").mapInArrow(run, STRINGS)


def sorted_windows(strings: DataFrame, span: int) -> DataFrame:
    """For every packed string, the windows that a smaller document has too.

    ``strings(bucket, before, n, whole, words, doc_id)`` are dealt by bucket and sorted by
    it; a task takes them as they come, keeping the last bucket of a batch for the next
    one. Within a bucket all windows are sorted by their offset to the minimiser and
    their words' hash; equal neighbours are one window, whose smallest document counts.
    Returns ``whole, bucket, before, n, doc_id, early``: ``early`` lists first and end window of
    each run that begins in a smaller document.
    """

    def buckets(table: pa.Table) -> pa.Table:
        n = np.asarray(table["n"]).astype(np.int64)
        _, _, hashes, bounds = tx.words(*_laid(table["words"].to_pylist()))
        sums = tx.prefix_hash(hashes)
        of = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = bounds[of] + step
        key = tx.span_hash(sums, at, at + span)
        place = np.asarray(table["before"])[of].astype(np.uint64) - step.astype(np.uint64)
        key = tx.mix(key ^ tx.mix(np.asarray(table["bucket"]).view(np.uint64)[of] * np.uint64(tx.BASE) + place))
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        lead = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        ids = np.asarray(table["doc_id"])
        least = np.minimum.reduceat(ids[of][order], lead)
        small = np.empty(len(key), np.int64)
        small[order] = np.repeat(least, np.diff(np.append(lead, len(key))))
        early = (small < ids[of]).astype(np.int8)
        runs, counts = tx.true_runs(early, of, step, len(n))
        offsets = np.concatenate(([0], np.cumsum(counts * 2))).astype(np.int32)
        return table.drop_columns(["words"]).append_column("early", pa.ListArray.from_arrays(offsets, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tx.bucket_groups(batches):
            yield from buckets(table).to_batches()

    dealt = strings.select("bucket", "before", "n", "whole", "doc_id", "words").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket long, before int, n int, whole long, doc_id long, early array<int>")


def _laid(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(strings) + 1, np.int64)
    np.cumsum([len(s) + 1 for s in strings], out=starts[1:])
    return np.frombuffer(b"\n".join([*strings, b""]), np.uint8), starts


def cut_words(docs: DataFrame, span: int) -> DataFrame:
    """Texts of ``docs(doc_id, text, runs)`` without the words that the windows ``runs`` cover.

    ``runs`` is an array of ``(from, to)`` window starts, end exclusive, in any order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for text, runs in zip(tx.texts_of(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                if runs:
                    cover = np.zeros(len(words) + 1, np.int64)
                    ends = np.array([(r["from"], r["to"] + span - 1) for r in runs])
                    np.add.at(cover, ends[:, 0], 1)
                    np.add.at(cover, ends[:, 1], -1)
                    stay = np.cumsum(cover)[:-1] == 0
                    kept = [w for w, s in zip(words, stay.tolist()) if s]
                else:
                    kept = words
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), tx.binary_list(kept_texts).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return docs.select("doc_id", "text", "runs").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )


def repeated_windows(docs: DataFrame, span: int = 50) -> DataFrame:
    """Window runs of ``docs(row, doc_id, text)`` whose words begin in a document with a smaller id too.

    1. The minimiser of a window (smallest hash of its 10-word grams) stands for it:
       ``(minimiser, document)`` rows say which minimisers occur in several documents.
    2. Only around those, consecutive windows of one minimiser are packed into a
       string; equal strings are combined before they travel to their bucket.
    3. Buckets sort their windows and find the smallest document of each.
    A minimiser with over ``HOT_STRINGS`` different strings would be one large bucket: its
    strings are cut into pieces of 8 windows, then, where that is not enough, of one,
    and dealt by what the windows of a piece have in common. Equal pieces are combined
    on the map side and different ones spread. Results are the same.

    Returns ``row, runs``, runs being ``(from, to)`` window starts, end exclusive.
    """
    marks = stored(anchors(docs.where("doc_id is not null"), span), "anchors")
    common = marks.groupBy("anchor").agg(F.min("row.doc_id").alias("lo"), F.max("row.doc_id").alias("hi")).where("lo < hi").select("anchor")
    lists = stored(marks.join(common, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("wanted")), "wanted")
    strings = stored(packed(docs.join(lists, "row"), span), "packed")
    parts = []
    for chunk in CHUNKS:
        shapes = strings.select("bucket", "whole", "before", "n").distinct()
        hot = stored(shapes.groupBy("bucket").count().where(F.col("count") > HOT_STRINGS).select("bucket"), "hot")
        if hot.isEmpty():
            break
        parts.append(_resolved(strings.join(hot, "bucket", "left_anti"), span))
        strings = stored(repacked(strings.join(hot, "bucket"), span, chunk), "repacked")
    found = _resolved(strings, span)
    for part in parts:
        found = found.union(part)
    return found.groupBy("row").agg(F.collect_set("run").alias("runs"))


def _resolved(strings: DataFrame, span: int) -> DataFrame:
    same = ["bucket", "before", "n", "whole"]
    once = strings.groupBy(*same).agg(F.min("row.doc_id").alias("doc_id"), F.first("words").alias("words"))
    early = sorted_windows(once, span).withColumnRenamed("doc_id", "least")
    placed = strings.select("row", "lead", *same).join(early, same)
    pairs = F.when(F.col("row.doc_id") > F.col("least"), F.array(F.lit(0), F.col("n"))).otherwise(F.col("early"))
    turns = placed.select("row", "lead", pairs.alias("ends")).where(F.size("ends") > 0)
    return turns.select(
        "row",
        F.explode(F.expr("transform(sequence(0, size(ends) - 1, 2), i -> struct(lead + ends[i] as `from`, lead + ends[i + 1] as `to`))")).alias("run"),
    )


def remove_repeated_windows(docs: DataFrame, span: int = 50) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` without the words of repeated windows.

    A word goes if a window of ``span`` words that covers it also starts in a document
    with a smaller ``doc_id``; all windows are judged on the input. Returns ``doc_id, n_words,
    n_removed, kept_sha256, kept_text``. NULL text is empty; rows without ``doc_id`` stay
    whole. Rows that repeat a ``doc_id`` are one document for the comparison, but each is cut
    where its own words are repeated.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = with_row(docs)
    runs = settled(docs.sparkSession, "runs", lambda: repeated_windows(docs, span))
    return cut_words(docs.join(runs, "row", "left"), span)
