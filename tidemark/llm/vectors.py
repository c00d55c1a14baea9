"""Whole-number vectors, and a query set against all rows in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Rows of a tile of queries and of a block of rows, and components of either.
TILE_ROWS = 8192
BLOCK_ROWS = 2048
BLOCK_COMPONENTS = 1 << 21
PARTITIONS = 20_000


def finite(vector: Column) -> Column:
    """Whether a vector is there and has no null or non-finite component."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, in double precision. What does not fit
    64 bits is held at their ends."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def exact_type(left: np.ndarray, right: np.ndarray, terms: int) -> type:
    """A number type in which sums of `terms` products stay exact."""
    bound = max(1, terms)
    for a in (left, right):
        bound *= max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def as_long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit numbers; what does not fit is held at their ends."""
    if scores.dtype == object:
        held = [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores.ravel()]
        return np.array(held, dtype=np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


def matrix(lists: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of whole numbers, short ones filled with zeros up to the longest
    or to `width`."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    out = np.zeros((len(lists), max(width, int(lengths.max(initial=0)))), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = lists.flatten().to_numpy()
    return out


def highest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of whole scores, higher first, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], ~scores[some]))[:k]]


def _numbered(df: DataFrame, vector: str, name: str, most_rows: int) -> tuple[DataFrame, int]:
    """`df` with a block number by hash, and how many blocks there are."""
    rows, components = df.select(F.count("*"), F.coalesce(F.sum(F.size(vector)), F.lit(0))).first()
    blocks = max(1, -(-rows // most_rows), -(-components // BLOCK_COMPONENTS))
    return df.withColumn(name, F.pmod(F.xxhash64(*df.columns), F.lit(blocks)).cast("int")), blocks


def against(
    queries: DataFrame, rows: DataFrame, vector: str, compare: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """`compare(tile, block)` for each tile of queries and each block of rows.

    Rows are copied once for each tile and queries once for each block; a task
    holds one tile and one block, whatever the table's size. Both must be saved.
    """
    left, tiles = _numbered(queries, vector, "_tile", TILE_ROWS)
    right, blocks = _numbered(rows, vector, "_block", BLOCK_ROWS)
    left = left.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = right.withColumn("_tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    parts = min(tiles * blocks, PARTITIONS)
    left, right = (x.repartition(parts, "_tile", "_block").groupBy("_tile", "_block") for x in (left, right))
    return left.cogroup(right).applyInArrow(lambda a, b: compare(a.combine_chunks(), b.combine_chunks()), schema)
