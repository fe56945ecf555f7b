"""Exact deduplication by an exchange of Golomb-coded fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemart.llm.tables import WHITE_RUN, settled, stored

BLOCK_ROWS = 100_000


def golomb_encode(values: np.ndarray, bits: int) -> bytes:
    """Sorted distinct values as Rice-coded gaps: quotients in unary, ``bits`` low bits each."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    quotient = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1  # a one after as many zeros as the quotient
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    low = ((gaps[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(unary).tobytes() + np.packbits(low.reshape(-1)).tobytes()


def golomb_decode(code: bytes, n: int, bits: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    low_bytes = -(-n * bits // 8)
    raw = np.frombuffer(code, np.uint8)
    unary = np.unpackbits(raw[: len(raw) - low_bytes])
    ends = np.flatnonzero(unary)[:n]
    quotient = np.diff(ends, prepend=-1) - 1
    low = np.unpackbits(raw[len(raw) - low_bytes :])[: n * bits].reshape(n, bits).astype(np.uint64)
    rest = (low << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotient.astype(np.uint64) << np.uint64(bits)) + rest, dtype=np.uint64)


def _send(fingerprints: pd.DataFrame, owners: int) -> Iterator[tuple]:
    """What one block sends: its distinct fingerprints of each owner, sorted and coded."""
    h = np.unique(fingerprints["h"].to_numpy(np.int64).view(np.uint64))
    whose = (h >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)  # owners hold ranges of equal width
    cut = np.searchsorted(whose, np.arange(owners + 1, dtype=np.uint64))
    for o in np.flatnonzero(np.diff(cut)):
        part = h[cut[o] : cut[o + 1]]
        base = np.uint64((int(o) << 32) // owners << 32)
        bits = max(1, int(np.log2(max(2.0, 2.0**64 / owners / len(part)))))
        yield int(o), len(part), bits, golomb_encode(part - base, bits)


def sort_and_code(rows: DataFrame, owners: int) -> DataFrame:
    def run(key, pdf):
        sent = list(_send(pdf, owners))
        return pd.DataFrame({"block": key[0], "owner": [s[0] for s in sent], "n": [s[1] for s in sent], "bits": [s[2] for s in sent], "code": [s[3] for s in sent]})

    return rows.groupBy("block").applyInPandas(run, "block long, owner int, n int, bits int, code binary")


def answer_bitmaps(codes: DataFrame, owners: int) -> DataFrame:
    """Owners mark, for every block, which of its fingerprints other blocks hold too."""

    def run(key, pdf):
        base = np.uint64((int(key[0]) << 32) // owners << 32)
        lists = [golomb_decode(c, n, b) + base for c, n, b in zip(pdf["code"], pdf["n"], pdf["bits"])]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        shared = values[counts > 1]
        marks = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"block": pdf["block"], "owner": key[0], "n": pdf["n"], "bitmap": marks})

    return codes.groupBy("owner").applyInPandas(run, "block long, owner int, n int, bitmap binary")


def apply_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Fingerprints of each block that are suspects: marked by an owner, or twice in the block."""

    def run(key, own, marks):
        h, counts = np.unique(own["h"].to_numpy(np.int64).view(np.uint64), return_counts=True)
        marks = marks.sort_values("owner")
        bits = [np.unpackbits(np.frombuffer(b, np.uint8))[:n] for b, n in zip(marks["bitmap"], marks["n"])]
        hit = (np.concatenate(bits) == 1) if bits else np.zeros(len(h), bool)
        return pd.DataFrame({"h": h[hit | (counts > 1)].view(np.int64)})

    return rows.groupBy("block").cogroup(bitmaps.groupBy("block")).applyInPandas(run, "h long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Equal texts of ``docs(doc_id, text)``, white-space runs counting as one space.

    1. Every document gets a 64-bit fingerprint and the SHA-256 of its normalised
       text; this narrow table is stored. Blocks of its rows are the senders.
    2. Each block sends every owner (a range of fingerprints) its sorted distinct
       fingerprints, Golomb-coded; owners return one bit per fingerprint.
    3. Only texts with a suspect fingerprint are shuffled, combined on the map side,
       and compared byte by byte by grouping on the text itself. Texts that share
       nothing but a fingerprint fall apart here.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, a row for every row
    of ``docs``. NULL text is empty. A repeated ``doc_id`` counts as further rows; rows
    without ``doc_id`` count in their group, are never kept before one with an id, and
    are kept (``keep_id`` NULL) only if no row of the group has an id.
    """
    return settled(docs.sparkSession, "exact", lambda: _exact_duplicates(docs))


def _exact_duplicates(docs: DataFrame) -> DataFrame:
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE_RUN, " ")
    table = docs.select("doc_id", norm.alias("norm"))
    spread = F.monotonically_increasing_id()
    marked = stored(
        table.select("doc_id", F.xxhash64("norm").alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha"))
        .withColumn("block", F.shiftright(spread, 33) * 65_536 + F.floor(spread.bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK_ROWS)),
        "fingerprints",
    )
    rows = marked.select("block", "h")
    # an owner holds about a million fingerprints at most
    owners = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), marked.count() // 1_000_000)
    codes = stored(sort_and_code(rows, owners), "codes")
    suspects = stored(apply_bitmaps(rows, answer_bitmaps(codes, owners)).distinct(), "suspects")
    # byte verification: a group is a text, and its smallest id stays
    groups = (
        table.withColumn("h", F.xxhash64("norm"))
        .join(suspects, "h", "left_semi")
        .groupBy("norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.xxhash64("norm").alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    )
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    found = marked.join(groups, ["h", "sha"], "left")
    lone = F.col("group_size").isNull()
    keep = F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        sha,
    )
