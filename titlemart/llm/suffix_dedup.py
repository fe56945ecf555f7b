"""Removal of repeated byte strings by sorting sampled suffixes, deep and shallow."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemart.llm import text as tx
from titlemart.llm.tables import ROW, settled, stored, with_row

GRAM = 100  # bytes whose hash chooses the sampled suffixes
SYMBOL = 8  # bytes that multikey quicksort compares at a time
SHALLOW = 64  # depth at which blind tries take over
HOT_STRINGS = 1000  # different strings of a bucket above which they are cut into pieces
CHUNKS = (16, 1)  # windows of a piece, at the first cut and at the second
STRINGS = f"{ROW}, bucket long, before int, n int, lead long, whole long, bytes binary"
NAMES = ["row", "bucket", "before", "n", "lead", "whole", "bytes"]


# --- deep-shallow sorting -------------------------------------------------------------


def common(x: bytes, y: bytes) -> int:
    """Length of the longest common prefix."""
    m = min(len(x), len(y))
    differ = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
    return m - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], items: list[int]) -> list[int]:
    """``items`` in the order of their strings, by insertion into a blind trie.

    A node holds the depth at which its strings part and one child per byte there
    (-1: the string ends); the bytes on the way are not stored. An insertion walks
    blindly to a leaf, compares once with that leaf's string, and branches where the
    two part. A leaf is the list of items with one string.
    """
    root: list | tuple = [items[0]]
    for item in items[1:]:
        own = strings[item]
        node = root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(own[depth] if depth < len(own) else -1) or next(iter(children.values()))
        other = strings[node[0]]
        part = common(own, other)
        if part == len(own) == len(other):
            node.append(item)
            continue
        above, byte, node = None, 0, root
        while isinstance(node, tuple) and node[0] < part:
            above, byte = node, own[node[0]] if node[0] < len(own) else -1
            node = node[1][byte]
        edge = own[part] if part < len(own) else -1
        if isinstance(node, tuple) and node[0] == part:
            node[1][edge] = [item]
            continue
        split = (part, {(other[part] if part < len(other) else -1): node, edge: [item]})
        if above is None:
            root = split
        else:
            above[1][byte] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            out += node
    return out


def deep_shallow_order(strings: list[bytes], skip: int = 0) -> list[int]:
    """Numbers of ``strings`` in ascending order; all agree in their first ``skip`` bytes.

    Multikey quicksort splits by one symbol of 8 bytes at a time, three ways, down to
    ``SHALLOW`` bytes; groups that still agree there are ordered by a blind trie.
    """
    out: list[int] = []
    stack = [(list(range(len(strings))), skip)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2:
            out += items
            continue
        if depth >= skip + SHALLOW:
            out += blind_trie(strings, items)
            continue
        keys = [strings[i][depth : depth + SYMBOL] for i in items]
        pivot = keys[len(keys) // 2]
        equal = [i for i, k in zip(items, keys) if k == pivot]
        if len(equal) < len(items):
            stack.append(([i for i, k in zip(items, keys) if k > pivot], depth))
        ended = len(pivot) < SYMBOL  # these strings are the same
        stack.append((equal, skip + SHALLOW if ended else depth + SYMBOL))
        if len(equal) < len(items):
            stack.append(([i for i, k in zip(items, keys) if k < pivot], depth))
    return out


def _ranks(groups: list[list[int]], strings: list[bytes], skip: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each string in its group's order, groups end to end, and each rank's
    common prefix with the rank before (-1 at the start of a group)."""
    rank, prefix = np.empty(len(strings), np.int64), np.full(len(strings), -1, np.int64)
    at = 0
    for group in groups:
        own = [strings[i] for i in group]
        order = deep_shallow_order(own, skip)
        for j, i in enumerate(order):
            rank[group[i]] = at + j
            if j:
                prefix[at + j] = common(own[order[j - 1]], own[i])
        at += len(group)
    return rank, prefix


def repeated_steps(table: pa.Table, span: int, gram: int) -> np.ndarray:
    """Which windows of the packed strings start elsewhere too, string after string.

    The strings of a bucket contain the same gram. Those with equal gram bytes form a
    group, and both what follows (gram included) and, backwards, what precedes are sorted.
    Two windows at the same distance d from the gram are equal if the strings lie in one
    class of common prefixes of ``span - d`` bytes, and backwards of d bytes.
    """
    strings, bucket = table["bytes"].to_pylist(), table["bucket"].to_pylist()
    before, n, copies = (np.asarray(table[c]).astype(np.int64) for c in ("before", "n", "copies"))
    groups: dict[tuple, list[int]] = {}
    for i, (s, b, k) in enumerate(zip(strings, bucket, before.tolist())):
        groups.setdefault((b, s[k : k + gram]), []).append(i)
    first = np.cumsum(n) - n
    out = np.repeat(copies > 1, n)
    several = [g for g in groups.values() if len(g) > 1]
    rows = np.array([i for g in several for i in g], np.int64)
    if not len(rows):
        return out
    starts = np.cumsum([0, *map(len, several)])
    local = [list(range(a, b)) for a, b in zip(starts[:-1], starts[1:])]
    ahead = [strings[i][before[i] :] for i in rows]
    behind = [strings[i][: before[i]][::-1] for i in rows]
    rank_a, prefix_a = _ranks(local, ahead, gram)
    rank_b, prefix_b = _ranks(local, behind, 0)
    far, near = before[rows], before[rows] - n[rows] + 1
    for d in range(int(near.min()), int(far.max()) + 1):
        here = np.flatnonzero((near <= d) & (d <= far))
        if len(here) < 2:
            continue
        key = np.cumsum(prefix_a < span - d)[rank_a[here]] * (len(rows) + 1) + np.cumsum(prefix_b < d)[rank_b[here]]
        order = np.argsort(key, kind="stable")
        equal = np.diff(key[order]) == 0
        hit = here[order[np.append(equal, False) | np.append(False, equal)]]
        out[first[rows[hit]] + far[hit] - d] = True
    return out


# --- Spark steps ------------------------------------------------------------------------


def _runs(texts: list[bytes], span: int):
    gram = min(GRAM, span)
    for first, end, data, starts in tx.blocks(texts):
        sums = tx.prefix_hash(data)
        at = np.arange(len(data))
        grams = tx.span_hash(sums, at, np.minimum(at + gram, len(data)))
        # the closing newline of a document is no part of it
        doc, anchor, lead, last = tx.anchored_runs(grams, starts, span, gram)
        last = np.minimum(last, starts[1:][doc] - 1 - span)
        good = last >= lead
        yield first, end, data, starts, sums, grams, doc[good], anchor[good], lead[good], last[good]


def anchors(docs: DataFrame, span: int) -> DataFrame:
    """Sampled suffixes by the hash of their first bytes: ``(row, anchor, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, _, _, _, _, grams, doc, anchor, _, _ in _runs(tx.texts_of(batch.column(1)), span):
                at, own = np.unique(anchor, return_index=True)
                seen, counts = np.unique(np.stack([doc[own].astype(np.uint64), grams[at]]), axis=1, return_counts=True) if len(at) else (np.zeros((2, 0), np.uint64), np.zeros(0, int))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(first + seen[0].astype(np.int64))), pa.array(tx.signed(seen[1])), pa.array(counts.astype(np.int64))],
                    names=["row", "anchor", "n"],
                )

    return docs.select("row", "text").mapInArrow(run, f"{ROW}, anchor long, n long")


def packed(docs: DataFrame, span: int) -> DataFrame:
    """Byte strings around the wanted anchors of ``docs(row, text, wanted)``: runs of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0), batch.column(2).to_pylist()
            for first, _, data, starts, sums, grams, doc, anchor, lead, last in _runs(tx.texts_of(batch.column(1)), span):
                good = tx.wanted_runs(doc, grams[anchor], wanted[first:])
                doc, anchor, lead, last = doc[good], anchor[good], lead[good], last[good]
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(first + doc)),
                        pa.array(tx.signed(grams[anchor])),
                        pa.array((anchor - lead).astype(np.int32)),
                        pa.array((last - lead + 1).astype(np.int32)),
                        pa.array((lead - starts[doc]).astype(np.int64)),
                        pa.array(tx.signed(tx.span_hash(sums, lead, last + span))),
                        tx.binary_list([raw[a:b] for a, b in zip(lead, last + span)]),
                    ],
                    names=NAMES,
                )

    return docs.select("row", "text", "wanted").mapInArrow(run, STRINGS)


def repacked(strings: DataFrame, span: int, chunk: int) -> DataFrame:
    """Packed strings cut into pieces of up to ``chunk`` windows, with the core's hash as bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            before, n, lead, bucket = (np.asarray(batch.column(c)).astype(np.int64) for c in ("before", "n", "lead", "bucket"))
            starts = np.cumsum([0, *map(len, texts)])
            raw = b"".join(texts)
            sums = tx.prefix_hash(np.frombuffer(raw, np.uint8))
            row, number, step, windows, core, core_end = tx.pieces(before, n, span, chunk)
            at = starts[row] + step
            end = at + windows + span - 1
            place = np.uint64(tx.BASE) * (number + 1).astype(np.uint64) ^ tx.mix(bucket[row].view(np.uint64))
            keys = tx.mix(tx.span_hash(sums, starts[row] + core, starts[row] + core_end) ^ place)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(row)),
                    pa.array(tx.signed(keys)),
                    pa.array((before[row] - step).astype(np.int32)),
                    pa.array(windows.astype(np.int32)),
                    pa.array(lead[row] + step),
                    pa.array(tx.signed(tx.span_hash(sums, at, end))),
                    tx.binary_list([raw[a:b] for a, b in zip(at, end)]),
                ],
                names=NAMES,
            )

    return strings.select(*NAMES).mapInArrow(run, STRINGS)


def sorted_suffixes(strings: DataFrame, span: int) -> DataFrame:
    """Runs of repeated windows of ``strings(bucket, before, n, whole, copies, bytes)``, bucket by bucket."""
    gram = min(GRAM, span)

    def buckets(table: pa.Table) -> pa.Table:
        n = np.asarray(table["n"]).astype(np.int64)
        hit = repeated_steps(table, span, gram).astype(np.int8)
        of = np.repeat(np.arange(len(n)), n)
        runs, counts = tx.true_runs(hit, of, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), len(n))
        offsets = np.concatenate(([0], np.cumsum(counts * 2))).astype(np.int32)
        return table.drop_columns(["bytes", "copies"]).append_column("ends", pa.ListArray.from_arrays(offsets, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tx.bucket_groups(batches):
            yield from buckets(table).to_batches()

    dealt = strings.select("bucket", "before", "n", "whole", "copies", "bytes").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket long, before int, n int, whole long, ends array<int>")


def cut_bytes(docs: DataFrame, span: int) -> DataFrame:
    """Texts of ``docs(doc_id, text, runs)`` without the bytes that the windows ``runs`` cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, digests, texts = [], [], [], [], []
            for text, runs in zip(tx.texts_of(batch.column(1)), batch.column(2).to_pylist()):
                kept, spans = [], 0
                at = 0
                for lo, hi in sorted((r["from"], r["to"] + span - 1) for r in runs or []):
                    hi = min(hi, len(text))
                    if lo > at or not spans:
                        kept.append(text[at:lo])
                        spans += 1
                    at = max(at, hi)
                rest = b"".join([*kept, text[at:]])
                n_bytes.append(len(text))
                n_removed.append(len(text) - len(rest))
                n_spans.append(spans)
                digests.append(hashlib.sha256(rest).hexdigest())
                texts.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string()), tx.binary_list(texts)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return docs.select("doc_id", "text", "runs").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def repeated_strings(docs: DataFrame, span: int = 400) -> DataFrame:
    """Runs of window starts of ``docs(row, doc_id, text)`` whose bytes start elsewhere too.

    1. In every window of ``span`` bytes the gram of smallest hash is its anchor; only the
       suffixes at anchors are looked at, one in some 150 bytes. Counting their hashes
       says which anchors can have repeated windows at all.
    2. The surroundings of those travel as byte strings; equal ones are combined first.
    3. In each bucket the suffixes are sorted, shallow by multikey quicksort and deep by
       blind tries, and common prefixes tell which windows are equal, byte by byte.
    Large buckets are cut into pieces that are dealt by their common core.
    """
    marks = stored(anchors(docs.where("doc_id is not null"), span), "anchors")
    often = marks.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    lists = stored(marks.join(often, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("wanted")), "wanted")
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
    once = strings.groupBy(*same).agg(F.count("*").alias("copies"), F.first("bytes").alias("bytes"))
    placed = strings.select("row", "lead", *same).join(sorted_suffixes(once, span).where(F.size("ends") > 0), same)
    return placed.select(
        "row",
        F.explode(F.expr("transform(sequence(0, size(ends) - 1, 2), i -> struct(lead + ends[i] as `from`, lead + ends[i + 1] as `to`))")).alias("run"),
    )


def remove_repeated_strings(docs: DataFrame, span: int = 400) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` without bytes covered by a repeated string of ``span`` bytes.

    Strings are judged on the input; overlaps and repeats within a document count, and no
    string crosses documents. Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``
    (``kept`` the remaining bytes). NULL text is empty; rows without ``doc_id`` stay whole and
    are not compared. Rows that repeat a ``doc_id`` are compared and cut like others.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = with_row(docs)
    runs = settled(docs.sparkSession, "runs", lambda: repeated_strings(docs, span))
    return cut_bytes(docs.join(runs, "row", "left"), span)
