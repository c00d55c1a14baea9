"""Hard negatives whose scores lie in a window under each positive's score.

The windows of one anchor overlap, so its positives' scores, their upper limits,
cut the scores into disjoint slots: a negative belongs to the lowest limit that is
not below it. Each block keeps the first k negatives of every slot, and so does
the merge. Going up from the lowest slot, a slot's negatives followed by what the
slots under it hold are, in order, all that a window of that limit can begin with;
its lower limit cuts the tail off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import saved
from tidemark.llm.vectors import against, as_long, exact_type, highest, matrix

POSITIVES = 5
NEGATIVES = 5
LOWEST = (80, 100)  # of the positive's score, as a fraction
AT_ONCE = 256  # anchors that share an array of scores

_NEAR = pa.schema([("anchor", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_SLOTTED = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _each_anchor(tile: pa.Table, block: pa.Table):
    """(place of the anchor in the tile, its scores over the block)."""
    rows = matrix(block.column("vector"))
    anchors = matrix(tile.column("vector"), rows.shape[1])
    rows = np.pad(rows, ((0, 0), (0, anchors.shape[1] - rows.shape[1])))
    kind = exact_type(rows, anchors, rows.shape[1])
    rows, anchors = rows.astype(kind), anchors.astype(kind)
    for start in range(0, len(anchors), AT_ONCE):
        for place, scores in enumerate(anchors[start : start + AT_ONCE] @ rows.T, start):
            yield place, as_long(scores)


def _positives(k: int):
    def compare(tile: pa.Table, block: pa.Table) -> pa.Table:
        if not len(tile) or not len(block):
            return _NEAR.empty_table()
        ids, labels = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
        own, own_label, number = (tile.column(c).to_numpy() for c in ("vec_id", "label", "anchor"))
        found = []
        for i, scores in _each_anchor(tile, block):
            same = np.flatnonzero((labels == own_label[i]) & (ids != own[i]))
            top = same[highest(scores[same], ids[same], k)]
            found.append((np.full(len(top), number[i]), ids[top], scores[top]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=_NEAR)

    return compare


def slot_of(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The slot of each score: the last of the falling `limits` that is not below
    it, or -1 above all."""
    return len(limits) - np.searchsorted(limits[::-1], scores, side="left") - 1


def _negatives(k: int):
    def compare(tile: pa.Table, block: pa.Table) -> pa.Table:
        if not len(tile) or not len(block):
            return _SLOTTED.empty_table()
        ids, labels = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
        own_label, number = (tile.column(c).to_numpy() for c in ("label", "anchor"))
        limits = tile.column("limits").to_pylist()
        found = [(np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))]
        for i, scores in _each_anchor(tile, block):
            slots = slot_of(scores, np.array(limits[i], dtype=np.int64))
            slots[labels == own_label[i]] = -1
            for slot in np.unique(slots[slots >= 0]):
                inside = np.flatnonzero(slots == slot)
                top = inside[highest(scores[inside], ids[inside], k)]
                found.append((np.full(len(top), number[i]), np.full(len(top), slot, np.int32), ids[top], scores[top]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=_SLOTTED)

    return compare


def mine(
    rows: DataFrame, is_anchor: Column | str, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: tuple[int, int] = LOWEST,
) -> DataFrame:
    """For each anchor and each of its first positives, the first negatives whose
    score is at most the positive's and at least that part of it: anchor_id,
    positive_id, rank from 1, negative_id, positive_score, negative_score.

    `rows` has vec_id, label and vector (whole numbers; the shorter of two vectors
    counts as filled with zeros). Anchors are rows for which `is_anchor` (over vec_id)
    holds; positives are rows of other ids with the anchor's label, negatives those
    with another label; higher inner products come first, ties by smaller vec_id. A
    negative positive score leaves an empty window. Rows with a null in any of the
    three are left out; a row that repeats counts once; an id on several rows gives
    each its own place. Scores beyond 64 bits are held at their ends. Without rows,
    anchors or positives the result is empty. Other columns are left aside.
    """
    rows = saved(rows.select("vec_id", "label", "vector").dropna().distinct())
    anchors = saved(rows.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()))
    by_score = [F.desc("score"), F.col("vec_id")]
    near = against(anchors, rows, "vector", _positives(positives), "anchor bigint, vec_id bigint, score bigint")
    first = Window.partitionBy("anchor").orderBy(*by_score)
    kept = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives)
    picks = saved(  # at most `positives` entries for each anchor, falling scores
        kept.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("picks"))
    )
    limited = saved(anchors.join(picks, "anchor").withColumn("limits", F.col("picks.score")).drop("picks"))
    slotted = against(limited, rows, "vector", _negatives(negatives), "anchor bigint, slot int, vec_id bigint, score bigint")
    in_slot = Window.partitionBy("anchor", "slot").orderBy(*by_score)
    # lower slots hold lower scores, so this order is that of the scores
    hits = F.array_sort(F.collect_list(F.struct("slot", "n", "vec_id", "score")))
    kept = slotted.withColumn("n", F.row_number().over(in_slot)).where(F.col("n") <= negatives)
    found = kept.groupBy("anchor").agg(hits.alias("hits"))
    low, whole = lowest
    exact = lambda c: c.cast("decimal(38,0)")
    return (
        anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
        .join(picks, "anchor")
        .join(found, "anchor")
        .select("anchor_id", "hits", F.posexplode("picks").alias("place", "positive"))
        .withColumn("suffix", F.slice(F.filter("hits", lambda h: h["slot"] >= F.col("place")), 1, negatives))
        .select("anchor_id", "positive", F.posexplode("suffix").alias("at", "negative"))
        .where(exact(F.col("negative.score")) * whole >= exact(F.col("positive.score")) * low)
        .where(F.col("negative.score") <= F.col("positive.score"))
        .select(
            "anchor_id",
            F.col("positive.vec_id").alias("positive_id"),
            (F.col("at") + 1).alias("rank"),
            F.col("negative.vec_id").alias("negative_id"),
            F.col("positive.score").alias("positive_score"),
            F.col("negative.score").alias("negative_score"),
        )
    )
