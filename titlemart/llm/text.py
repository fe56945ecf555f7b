"""Texts of an Arrow batch as byte blocks: words, span hashes, window minima.

All functions work on whole blocks of documents laid end to end, so their cost
is a few numpy passes per byte and their memory is bounded by the block (or by
the longest document).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[list(WHITE)] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of every text; NULL is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, bytes, starts)``: documents ``first..end`` laid end to end.

    A newline closes every document; ``starts`` holds the first byte of each one
    and, last, the length of the block.
    """
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= limit or i + 1 == len(texts):
            part = texts[first : i + 1]
            data = np.frombuffer(b"\n".join([*part, b""]), dtype=np.uint8)
            starts = np.zeros(len(part) + 1, np.int64)
            np.cumsum([len(t) + 1 for t in part], out=starts[1:])
            yield first, i + 1, data, starts
            first, size = i + 1, 0


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that any bits of them may be used."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        factor = np.full(max(n, BLOCK_BYTES + 4096), BASE if which == "up" else UNBASE, np.uint64)
        factor[0] = 1
        _powers[which] = np.multiply.accumulate(factor)
    return _powers[which]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which ``span_hash`` takes any span."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power("up", len(values))[: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the values in ``starts..ends``, wherever they lie."""
    return mix((sums[ends] - sums[starts]) * _power("down", len(sums))[starts])


def word_spans(data: np.ndarray, table: np.ndarray = _WORD_BYTE) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word (run of bytes that ``table`` names) of a block that ends in white space."""
    inside = table[data].view(np.int8)
    step = np.diff(inside, prepend=np.int8(0))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def words(data: np.ndarray, starts: np.ndarray, table: np.ndarray = _WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(word starts, word ends, word hashes, first word of each document and the end)``."""
    begin, end = word_spans(data, table)
    return begin, end, span_hash(prefix_hash(data), begin, end), np.searchsorted(begin, starts)


def owner(bounds: np.ndarray, n: int) -> np.ndarray:
    """Document of each of ``n`` items whose documents begin at ``bounds[:-1]``."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]


def window_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest key in each window of ``width`` keys, leftmost first.

    Keys are compared by their upper 40 bits; a block holds under 2^24 of them
    per slice, and longer inputs are done in overlapping slices.
    """
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    most = (1 << 24) - width
    if n > most:
        parts = [window_minimum(keys[i : i + most + width - 1], width) + i for i in range(0, n, most)]
        return np.concatenate(parts)
    low = np.uint64((1 << 24) - 1)
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def anchored_runs(hashes: np.ndarray, bounds: np.ndarray, span: int, gram: int):
    """Windows of ``span`` items that share a minimiser, as runs.

    ``hashes`` holds the hash of the ``gram`` items from each position on (of the
    block, positions that run over an end included), ``bounds`` the first item of
    each document and the end. Returns document, anchor position, first and last
    window start of every run. The anchor depends on the window's content only.
    """
    width = span - gram + 1
    anchor = window_minimum(hashes, width)
    doc = owner(bounds, int(bounds[-1]))
    n = len(doc) - span + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    good = np.flatnonzero(doc[:n] == doc[span - 1 : span - 1 + n])
    if not len(good):
        return good, good, good, good
    at = anchor[good]
    cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(good) != 1)) + 1
    lead, last = np.concatenate(([0], cut)), np.concatenate((cut - 1, [len(good) - 1]))
    return doc[good[lead]], at[lead], good[lead], good[last]


def pieces(before: np.ndarray, n: np.ndarray, span: int, chunk: int):
    """Cut runs of windows where the offset of window to minimiser passes a multiple of ``chunk``.

    A run has ``n`` windows, the first one ``before`` items in front of the minimiser. Returns,
    per piece: its run, number of its first window in the run, its windows, and first and
    end item (from the run's first item on) of the core, which all windows of any such
    piece contain. So equal windows always lie in pieces of equal cores.
    """
    low, high = (before - n + 1) // chunk, before // chunk
    count = high - low + 1
    run = np.repeat(np.arange(len(n)), count)
    index = high[run] - (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    far = np.minimum(before[run], index * chunk + chunk - 1)
    near = np.maximum(before[run] - n[run] + 1, index * chunk)
    core = before[run] - index * chunk
    return run, index, before[run] - far, far - near + 1, core, core - chunk + 1 + span


def wanted_runs(doc: np.ndarray, keys: np.ndarray, wanted: list[list[int]]) -> np.ndarray:
    """Which runs have a minimiser that their document's list names."""
    hit = np.zeros(len(doc), bool)
    cut = np.flatnonzero(np.diff(doc, prepend=-1))
    for lo, hi in zip(cut, [*cut[1:], len(doc)]):
        hit[lo:hi] = np.isin(keys[lo:hi], np.array(wanted[doc[lo]], np.int64).view(np.uint64))
    return np.flatnonzero(hit)


def true_runs(hit: np.ndarray, of: np.ndarray, step: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end step of each run of ones in ``hit``, flat, and runs per string."""
    edge_in = (hit == 1) & (np.append([0], hit[:-1]) == 0) | (hit == 1) & (step == 0)
    edge_out = (hit == 1) & (np.append(hit[1:], 0) == 0) | (hit == 1) & (np.append(step[1:], 0) == 0)
    starts, close = np.flatnonzero(edge_in), np.flatnonzero(edge_out)
    runs = np.stack([step[starts], step[close] + 1], axis=1).astype(np.int32).reshape(-1)
    return runs, np.bincount(of[starts], minlength=n)


def bucket_groups(batches: Iterator[pa.RecordBatch], key: str = "bucket") -> Iterator[pa.Table]:
    """Tables of whole groups out of batches sorted by ``key``; the last group of a batch waits."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or np.asarray(held[-1].column(key))[-1] != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)]).combine_chunks()
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def binary_list(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())
