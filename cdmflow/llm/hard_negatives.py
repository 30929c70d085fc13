"""Hard negatives by a vertical scan of the vector columns (operator 11, BOND).

For each anchor the best rows of its label (positives) are found, then for each positive the best rows of other labels
whose score lies in a window under the positive's. Scores are integer inner products.

Rows are dealt into lanes of about ``LANE`` rows and anchors into packs of about ``PACK``; one task at a time meets
one lane and one pack (both bounded), so the work is spread however the labels are distributed. Inside, the lane's
columns are read in the order of the anchor's largest components. After every few columns the least and greatest
values of the columns still to come bound each row's score, and the bitmap of candidates shrinks: for positives to the
rows that can still reach the best five, for negatives to those whose bounds still meet a window and its best five.
The survivors' scores are complete, so windows resolve exactly. Lanes return their best five per anchor or per
(anchor, positive), which are ranked again over all lanes.

Rows without label or vector, or with a component that is null, not finite or beyond ``centroids.LIMIT`` after scaling
take no part. Vectors are only compared with vectors of their length. Repeated rows are rows of their own: each is a
candidate, each anchor row has its own result, and ties beyond score and id (null ids last) go by the row's place.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdmflow.llm.centroids import integer_vectors
from cdmflow.llm.common import stage

LANE, PACK, LEAST_LANES = 8192, 1024, 16
_STEP = 8


def vertical_scan(columns: np.ndarray, anchor: np.ndarray, rows: np.ndarray, still_possible: Callable) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the candidates that ``still_possible(lower, upper)`` keeps to the last column.

    ``columns`` is dimension x row; ``rows`` are the candidates' numbers."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = anchor[order, None] * np.stack([columns.min(axis=1), columns.max(axis=1)], axis=1)[order]
    gain_low = np.append(np.cumsum(ends.min(axis=1)[::-1])[::-1], 0)
    gain_high = np.append(np.cumsum(ends.max(axis=1)[::-1])[::-1], 0)
    score = np.zeros(len(rows), np.int64)
    for at in range(0, len(order), _STEP):
        dims = order[at:at + _STEP]
        score = score + anchor[dims] @ columns[np.ix_(dims, rows)]
        done = min(at + _STEP, len(order))
        alive = still_possible(score + gain_low[done], score + gain_high[done])
        if not alive.all():
            rows, score = rows[alive], score[alive]
        if not len(rows):
            break
    return rows, score


def _fifth(values: np.ndarray, k: int) -> int | None:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def can_be_best(k: int) -> Callable:
    """Rows whose upper bound reaches the k-th greatest lower bound."""
    def possible(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        floor = _fifth(lower, k)
        return np.ones(len(lower), bool) if floor is None else upper >= floor
    return possible


def can_be_in_windows(windows: list[tuple[int, int]], k: int) -> Callable:
    """Rows whose bounds meet a window, and there reach the k-th greatest lower bound of the rows surely inside."""
    def possible(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        alive = np.zeros(len(lower), bool)
        for low, high in windows:
            floor = _fifth(lower[(lower >= low) & (upper <= high)], k)
            alive |= (upper >= (low if floor is None else max(low, floor))) & (lower <= high)
        return alive
    return possible


def _groups(rows: pa.Table, anchors: pa.Table):
    """Per vector length: (rows, columns) of the lane and the anchors of that length with their vectors."""
    lengths, wanted = pc.list_value_length(rows.column("q")), pc.list_value_length(anchors.column("q"))
    for size in pc.unique(wanted).to_pylist():
        lane, pack = rows.filter(pc.equal(lengths, size)), anchors.filter(pc.equal(wanted, size))
        if lane.num_rows:
            matrix = [t.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, size) for t in (lane, pack)]
            yield lane, np.ascontiguousarray(matrix[0].T), pack, matrix[1]


def _best(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((at[rows], ids[rows], -score))[:k]
    return rows[order], score[order]


_IDLESS = np.int64((1 << 63) - 1)


def _plain(lane: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = lane.column("id").fill_null(int(_IDLESS)).to_numpy()
    return ids, lane.column("row").to_numpy(), lane.column("label").to_numpy()


def _positives(k: int) -> Callable:
    schema = pa.schema([("anchor", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def apply(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        made = [schema.empty_table()]
        for lane, columns, pack, vectors in _groups(rows, anchors):
            ids, at, label = _plain(lane)
            by_label = {v: np.flatnonzero(label == v) for v in np.unique(label)}
            for a, own, vector in zip(pack.column("row").to_pylist(), pack.column("label").to_pylist(), vectors):
                same = by_label.get(own, np.empty(0, np.int64))
                found, score = vertical_scan(columns, vector, same[at[same] != a], can_be_best(k))
                found, score = _best(found, score, ids, at, k)
                made.append(pa.table([pa.array(np.full(len(found), a, np.int64)), pa.array(at[found]), lane.column("id").take(pa.array(found)),
                                      pa.array(score)], schema=schema))
        return pa.concat_tables(made)
    return apply


def _negatives(k: int, percent: int) -> Callable:
    schema = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def apply(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        made = [schema.empty_table()]
        for lane, columns, pack, vectors in _groups(rows, anchors):
            ids, at, label = _plain(lane)
            others = {v: np.flatnonzero(label != v) for v in pack.column("label").unique().to_pylist()}
            for a, own, positives, vector in zip(pack.column("row").to_pylist(), pack.column("label").to_pylist(),
                                                 pack.column("positives").to_pylist(), vectors):
                windows = [(-(-percent * p["score"] // 100), p["score"]) for p in positives]
                found, score = vertical_scan(columns, vector, others[own], can_be_in_windows(windows, k))
                for p, (low, high) in zip(positives, windows):
                    inside = (score >= low) & (score <= high)
                    best, its = _best(found[inside], score[inside], ids, at, k)
                    made.append(pa.table([pa.array(np.full(len(best), a, np.int64)), pa.array(np.full(len(best), p["row"], np.int64)),
                                          pa.array(at[best]), lane.column("id").take(pa.array(best)), pa.array(its)], schema=schema))
        return pa.concat_tables(made)
    return apply


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, scale: int = 256, n_positives: int = 5, n_negatives: int = 5, percent: int = 80,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` (a condition over ``vectors``) holds.

    For each anchor the first ``n_positives`` other rows of its label, for each of these the first ``n_negatives``
    rows of other labels with ``percent`` % of the positive's score or more, and no more than it. Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score; the anchor and positive are rows, so equal ids
    can return several times. Other columns are not read.
    """
    usable = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                             integer_vectors(F.col(vector_col), scale).alias("q"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
              .filter("label IS NOT NULL AND q IS NOT NULL"))
    rows = stage(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    lanes, packs = max(LEAST_LANES, -(-n // LANE)), max(1, -(-n_anchors // PACK))

    def meet(asked: DataFrame, scan: Callable, returns: str) -> DataFrame:
        """Each lane with each pack of anchors. The anchors have columns row, label, q and whatever the scan reads."""
        dealt = (rows.select("row", "id", "label", "q", F.pmod(F.hash("row"), F.lit(lanes)).alias("lane"))
                 .withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))))
        spread = (asked.toDF(*asked.columns).withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(packs)).cast("int"))
                  .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))))
        return dealt.groupBy("lane", "pack").cogroup(spread.groupBy("lane", "pack")).applyInArrow(scan, returns)

    asked = rows.filter("is_anchor").select("row", "id", "label", "q")
    near = meet(asked.drop("id"), _positives(n_positives), "anchor long, row long, id long, score long")
    positives = stage(_first(near, ["anchor"], n_positives), "positives")
    lists = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("row", "score")).alias("positives"))  # n_positives at most
    with_lists = asked.join(lists, "row").select("row", "label", "q", "positives")
    found = _first(meet(with_lists, _negatives(n_negatives, percent), "anchor long, positive long, row long, id long, score long"),
                   ["anchor", "positive"], n_negatives)
    ids = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (found.select("anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(positives.select("anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                  ["anchor", "positive"])
            .join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
