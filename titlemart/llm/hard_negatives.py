"""Hard negatives of anchor vectors by Fagin's threshold algorithm."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlemart.llm.tables import settled, stored

BLOCK_ROWS = 8_192  # rows whose sorted lists are searched together
ANCHOR_ROWS = 1_024  # anchors sent to a block together
FIRST_DEPTH, DEEPER = 8, 4  # of the sorted access; a step goes DEEPER times as deep as the one before
REST = 4  # of a block's rows, one part may be shown by a step of sorted access; beyond, the lists can't save work
LIMIT = 1 << 26  # components count as this much at most, so a score of 2,048 of them fits a long
FOUND = "ask long, anchor_id long, floor long, vec_id long, score long"


def sorted_lists(values: np.ndarray) -> np.ndarray:
    """For every dimension, the rows by ascending component."""
    return np.ascontiguousarray(np.argsort(values, axis=0).T.astype(np.int32))


def seek(lists: np.ndarray, values: np.ndarray, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The ``k`` best allowed rows of each window of scores: ``(rows, scores)``, best first, ties by row number.

    Sorted access walks every list from the end at which the component's product with the
    anchor's is highest, so what no list has shown yet scores at most the threshold, the sum
    of those products at the depth reached. Rows seen are scored at once. A window ``(low, high)``
    is settled when the threshold lies below ``low`` or strictly below its k-th score. When the
    next step could show more than a REST-th of all rows, the rest is scored together instead.
    """
    n = len(values)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    least = min((low for low, _ in windows), default=0)
    waiting = allowed.copy()
    rows, scores = np.zeros(0, np.int64), np.zeros(0, values.dtype)
    depth, deeper = 0, min(n, FIRST_DEPTH)
    while True:
        rest = (deeper - depth) * (len(up) + len(down)) * REST > n or not (len(up) + len(down))
        if rest:
            new = np.flatnonzero(waiting)
            score = (values @ anchor)[new]
        else:
            shown = np.zeros(n, bool)
            shown[lists[up, n - deeper : n - depth]] = True
            shown[lists[down, depth:deeper]] = True
            new = np.flatnonzero(shown & waiting)
            waiting[new] = False
            score = values[new] @ anchor
        good = score >= least
        rows, scores = np.concatenate((rows, new[good])), np.concatenate((scores, score[good]))
        order = np.lexsort((rows, -scores))
        rows, scores = rows[order], scores[order]
        cuts = [(int(np.searchsorted(-scores, -high)), int(np.searchsorted(-scores, -low, "right"))) for low, high in windows]
        if rest or deeper == n:
            break
        depth, deeper = deeper, min(n, deeper * DEEPER)
        threshold = values[lists[up, n - depth], up] @ anchor[up] + values[lists[down, depth - 1], down] @ anchor[down]
        if all(threshold < low or (b - a >= k and threshold < scores[a + k - 1]) for (low, _), (a, b) in zip(windows, cuts)):
            break
    return [(rows[a : min(a + k, b)], scores[a : min(a + k, b)]) for a, b in cuts]


def _matrix(column: pa.ChunkedArray, wide: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _exact(values: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every sum of products stays exact in them, else as longs."""
    most = int(np.abs(values).max(initial=0)) * int(np.abs(anchors).max(initial=0)) * max(values.shape[1], 1)
    kind = np.float64 if most < 1 << 52 else np.int64
    return values.astype(kind), anchors.astype(kind)


def _search(rows: DataFrame, asks: DataFrame, blocks: int, groups: int, k: int, own_label: bool, low: int, high: int) -> DataFrame:
    """Best rows of every block for ``asks(ask, vec_id, label, v, scores)``, as FOUND.

    With ``own_label``, rows of the anchor's label other than itself; else those of other labels in
    the window that each of ``scores`` opens (``floor`` names it). Blocks of rows and groups of
    anchors are dealt by hash, every block meeting every group, whatever labels they have.
    """
    here = F.pmod(F.xxhash64("row"), F.lit(blocks))
    there = F.pmod(F.xxhash64("ask"), F.lit(groups))
    left = rows.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: here * groups + g)))
    right = asks.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * groups + there)))

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("ask", "anchor_id", "floor", "vec_id", "score")})
        own = own.sort_by([("vec_id", "ascending")])  # NULL last; so row numbers decide ties
        wide = max(pc.max(pc.list_value_length(t["v"])).as_py() for t in (own, asked))
        values, anchors = _exact(_matrix(own["v"], wide), _matrix(asked["v"], wide))
        labels, of = own["label"].to_numpy(), asked["label"].to_numpy()
        ids, keys = own["row"].to_numpy(), asked["ask"].to_numpy()
        whole = None if own_label else sorted_lists(values)
        parts: list[tuple[int, int | None, np.ndarray, np.ndarray]] = []
        scores_of = [None] * len(keys) if own_label else asked["scores"].to_pylist()
        for label in np.unique(of):
            same = labels == label
            at = np.flatnonzero(same) if own_label else np.arange(len(labels))
            if not len(at):
                continue
            part = values[at] if own_label else values
            lists = sorted_lists(part) if own_label else whole
            for i in np.flatnonzero(of == label):
                if own_label:
                    floors, windows, allowed = [None], [(-(1 << 62), 1 << 62)], ids[at] != keys[i]
                else:
                    floors = scores_of[i]
                    windows = [(-(-low * s // 100), high * s // 100) for s in floors]
                    allowed = ~same
                for floor, (found, score) in zip(floors, seek(lists, part, anchors[i], allowed, windows, k)):
                    if len(found):
                        parts.append((i, floor, at[found], score))
        n = [len(p[2]) for p in parts]
        ask = np.repeat([p[0] for p in parts], n).astype(np.int64)
        at = np.concatenate([np.zeros(0, np.int64), *(p[2] for p in parts)])
        return pa.table(
            {
                "ask": asked["ask"].take(pa.array(ask)),
                "anchor_id": asked["vec_id"].take(pa.array(ask)),
                "floor": pa.array([f for p, m in zip(parts, n) for f in [p[1]] * m], pa.int64()),
                "vec_id": own["vec_id"].take(pa.array(at)),
                "score": pa.array(np.concatenate([np.zeros(0), *(p[3] for p in parts)]).astype(np.int64)),
            }
        )

    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(run, FOUND)
    best = W.partitionBy("ask", "floor").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """Negatives of ``vectors(vec_id, embedding, label)`` that score ``low`` to ``high`` percent of a positive.

    Components become ``floor(scale * x)`` (at most LIMIT in size) and a score is the integer
    inner product with the anchor, a row for which ``anchor`` holds. Its positives are the
    ``positives`` best other rows of its label; for each of them the ``negatives`` best rows of other
    labels with ``low * positive <= 100 * score <= high * positive`` are returned:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Ties go to the smaller
    ``vec_id``, NULL last. A window around a negative score is empty.

    Rows with a NULL label, vector or component, or one that isn't finite, take no part. Repeated
    rows are rows of their own, and each other's positives. Of vectors of unequal length the
    shorter one counts as ending in zeros; an empty one scores 0. Labels are whole numbers. Columns
    beyond the three are ignored.

    Every block of rows is searched for every group of anchors, so the cells are many, of bounded size
    and alike whatever the labels; the best of each block are merged by rank on the map side.
    """
    return settled(vectors.sparkSession, "negatives", lambda: _hard_negatives(vectors, anchor, positives, negatives, low, high, scale))


def _hard_negatives(vectors: DataFrame, anchor: Column, positives: int, negatives: int, low: int, high: int, scale: int) -> DataFrame:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    usable = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    rows = stored(
        usable.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.transform("embedding", whole).alias("v"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        ),
        "vectors",
    )
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks, groups = -(-sizes["rows"] // BLOCK_ROWS) or 1, -(-sizes["anchors"] // ANCHOR_ROWS) or 1
    asks = stored(rows.where("anchor").select(F.col("row").alias("ask"), "vec_id", "label", "v"), "anchors")
    rows = rows.select("row", "vec_id", "label", "v")
    near = stored(_search(rows, asks, blocks, groups, positives, True, low, high).drop("rank", "floor"), "positives")
    opened = near.groupBy("ask").agg(F.collect_set("score").alias("scores"))
    far = _search(rows, asks.join(opened, "ask"), blocks, groups, negatives, False, low, high)
    named = near.select("ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("floor"), F.col("score").alias("positive_score"))
    return far.join(named, ["ask", "floor"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


NEGATIVES_SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum([z[1] * z[2] for z in list_zip(a.v, b.v)])::BIGINT AS score
  FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0
), pos AS (
  SELECT rid, anchor_id, vec_id AS positive_id, score,
         row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id ASC NULLS LAST) AS place
  FROM p WHERE same
), n AS (
  SELECT pos.anchor_id, pos.positive_id, pos.score AS positive_score, p.vec_id AS negative_id, p.score AS negative_score,
         row_number() OVER (PARTITION BY pos.rid, pos.place ORDER BY p.score DESC, p.vec_id ASC NULLS LAST) AS rank
  FROM pos JOIN p ON pos.rid = p.rid AND NOT p.same
       AND 50 * pos.score <= 100 * p.score AND 100 * p.score <= 95 * pos.score
  WHERE pos.place <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
