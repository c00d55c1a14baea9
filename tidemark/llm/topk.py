"""Exact highest inner products by term-at-a-time accumulation.

Rows are sparse: terms and whole-number weights. Each block of rows becomes
postings, term by term. A few queries at a time hold a dense array of scores over
the block; each of their terms scatters its weighted postings into it, no term or
posting left out. The k highest of the array are partitioned off, and the blocks'
picks merge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import saved
from tidemark.llm.vectors import against, as_long, exact_type, finite, floored, highest

NEIGHBOURS = 10
SCALE = 1024
AT_ONCE = 64  # queries that share an array of scores

_HITS = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def sparse(vectors: DataFrame, scale: int = SCALE, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, terms and weights of dense vectors: the places of the components
    that floor(scale * x) leaves other than zero, and these numbers.

    Rows with a null id, or with a vector that is null or holds a null or
    non-finite component, are left out; an empty or zero vector has no terms.
    """
    good = vectors.where(F.col(id_column).isNotNull() & finite(F.col(vector)))
    weights = floored(F.col(vector), scale)
    pairs = F.filter(F.transform(weights, lambda w, i: F.struct(i.alias("term"), w.alias("weight"))), lambda p: p["weight"] != 0)
    return good.select(F.col(id_column).cast("bigint").alias("vec_id"), pairs.alias("p")).select(
        "vec_id", F.col("p.term").alias("terms"), F.col("p.weight").alias("weights")
    )


def _flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of each posting, by term, then row."""
    terms, weights = rows.column("terms").combine_chunks(), rows.column("weights").combine_chunks()
    owner = np.repeat(np.arange(len(rows)), np.diff(terms.offsets.to_numpy()))
    term, weight = terms.flatten().to_numpy(), weights.flatten().to_numpy()
    order = np.argsort(term, kind="stable")
    return owner[order], term[order], weight[order]


def accumulate(block: pa.Table, queries: pa.Table) -> np.ndarray:
    """Scores of all rows of a block for a few queries: rows x queries."""
    owner, term, weight = _flat(block)
    asked, asked_term, asked_weight = _flat(queries)
    longest = int(np.bincount(asked, minlength=1).max())
    kind = exact_type(weight, asked_weight, longest)
    weight, asked_weight = weight.astype(kind), asked_weight.astype(kind)
    scores = np.zeros((len(block), len(queries)), dtype=kind)
    wanted = np.unique(asked_term)
    cuts = np.searchsorted(asked_term, wanted), np.searchsorted(asked_term, wanted, side="right")
    runs = np.searchsorted(term, wanted), np.searchsorted(term, wanted, side="right")
    for lo, hi, start, stop in zip(*cuts, *runs):
        if start == stop:
            continue
        rows, columns = owner[start:stop], asked[lo:hi]
        part = weight[start:stop, None] * asked_weight[None, lo:hi]
        if len(rows) == len(block) and len(columns) == len(queries):
            scores += part
        elif len(columns) == len(queries):
            scores[rows] += part
        else:
            scores[np.ix_(rows, columns)] += part
    return as_long(scores)


def search(rows: DataFrame, is_query: Column | str, k: int = NEIGHBOURS) -> DataFrame:
    """The k highest inner products of each row for which `is_query` (over vec_id)
    holds, among the rows of other ids: query_id, rank from 1, vec_id, score.

    `rows` has vec_id, terms (distinct within a row) and whole-number weights;
    terms that only one side has count as zero, so rows without terms score 0 and
    take part. Ties go to the smaller vec_id. A row that repeats counts once; an id
    on several vectors gives each its own place, and its queries their own
    lists. Scores beyond 64 bits are held at their ends. Rows with a null vec_id
    are left out; without rows or queries the result is empty. Other columns are
    left aside.
    """
    rows = saved(rows.select("vec_id", "terms", "weights").where("vec_id is not null").distinct())
    queries = saved(rows.where(is_query).withColumn("query", F.monotonically_increasing_id()))

    def compare(tile: pa.Table, block: pa.Table) -> pa.Table:
        if not len(tile) or not len(block):
            return _HITS.empty_table()
        ids, own = block.column("vec_id").to_numpy(), tile.column("vec_id").to_numpy()
        number = tile.column("query").to_numpy()
        found: list[tuple[np.ndarray, ...]] = []
        for start in range(0, len(tile), AT_ONCE):
            scores = accumulate(block, tile.slice(start, AT_ONCE))
            for column in range(scores.shape[1]):
                others = np.flatnonzero(ids != own[start + column])
                near = scores[others, column]
                top = highest(near, ids[others], k)
                found.append((np.full(len(top), number[start + column]), ids[others[top]], near[top]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=_HITS)

    hits = against(queries, rows, "terms", compare, "query bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(queries.select("query", F.col("vec_id").alias("query_id")), "query").select(
        "query_id", "rank", "vec_id", "score"
    )
