"""Exact top-k search and hard negatives against plain loops."""

import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives, queries, topk, vectors

QUERY = "vec_id % 100 = 0"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_exact_topk"])
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, name, folder):
    sf = f"/root/testdata/{folder}"
    connection = duckdb.connect()
    for file in os.listdir(sf):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    cursor = connection.execute(queries.ORACLES[name])
    found = queries.QUERIES[name](spark, sf)
    assert sorted(d[0] for d in cursor.description) == sorted(found.columns)
    want = sorted(cursor.fetchall())
    assert want and sorted(map(tuple, found.select(*[d[0] for d in cursor.description]).collect())) == want


def made(seed, n, dims, values, labels):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(labels)), [int(v) for v in rng.integers(-values, values + 1, dims)]) for i in range(n)]


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.mark.parametrize("values", [1, 300, 1 << 29, 1 << 40])
def test_topk_in_small_blocks(spark, monkeypatch, values):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 60)
    monkeypatch.setattr(vectors, "TILE_ROWS", 3)
    monkeypatch.setattr(topk, "AT_ONCE", 2)
    rows = [(i * 10, [d for d, w in enumerate(v) if w], [w for w in v if w]) for i, _, v in made(3, 500, 6, values, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, terms array<int>, weights array<bigint>")
    found = {}
    for r in topk.search(df, QUERY, 7).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    dense = {i: dict(zip(t, w)) for i, t, w in rows}
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    for q in (i for i in dense if i % 100 == 0):
        scores = [(-clip(sum(w * dense[c].get(t, 0) for t, w in dense[q].items())), c) for c in dense if c != q]
        want = [(n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:7])]
        assert sorted(found[q]) == want
    assert len(found) == 50


def test_topk_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [-0.0004, 0.0]), (9, [1e30, 0.0])]
    rows += [(100 + i, [1.0, 0.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"score": F.lit(1), "terms": F.lit("x"), "query": F.lit(2)})
    out = [tuple(r) for r in topk.search(topk.sparse(df), QUERY).collect()]
    mine = sorted(r[1:] for r in out if r[0] == 0)
    assert mine == [(1, 9, (1 << 63) - 1), (2, 7, 1 << 20), *((3 + i, 100 + i, 1 << 20) for i in range(8))]
    assert {r[0] for r in out} == {0, 100}
    few = sorted(tuple(r) for r in topk.search(topk.sparse(df.where("vec_id in (0, 2, 3, 8)")), QUERY).collect())
    assert few == [(0, 1, 2, 0), (0, 2, 3, 0), (0, 3, 8, -1024)]
    assert topk.search(topk.sparse(df.limit(0)), QUERY).count() == 0


def plain_negatives(rows, k_pos, k_neg, low):
    out = []
    for a, label, v in rows:
        if a % 100:
            continue
        others = sorted((-score(v, w), i, other) for i, other, w in rows if i != a)
        for s, p, _ in [x for x in others if x[2] == label][:k_pos]:
            inside = [(n, t) for t, n, other in others if other != label and low * -s <= 100 * -t <= 100 * -s]
            out += [(a, p, r + 1, n, -s, -t) for r, (n, t) in enumerate(inside[:k_neg])]
    return out


@pytest.mark.parametrize("values,low", [(2, 80), (30, 0), (30, 80), (1 << 27, 80)])
def test_negatives_in_small_blocks(spark, monkeypatch, values, low):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 50)
    monkeypatch.setattr(vectors, "TILE_ROWS", 4)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    rows = [(i * 5, label, v) for i, label, v in made(values % 97, 400, 5, values, 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, label bigint, vector array<bigint>")
    found = sorted(tuple(r) for r in negatives.mine(df, QUERY, 4, 3, (low, 100)).collect())
    want = sorted(plain_negatives(rows, 4, 3, low))
    assert found == want and len({r[:2] for r in want}) > 10


def test_negatives_odd_rows(spark):
    rows = [(0, 1, [2, 0]), (0, 1, [2, 0]), (1, None, [1, 1]), (2, 1, None), (None, 1, [1, 1]), (3, 1, [2]), (4, 1, [2, 5, 7])]
    rows += [(10 + i, 2, [2, 1]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, label bigint, vector array<bigint>").withColumns({"anchor": F.lit(1), "slot": F.lit(2)})
    out = sorted(tuple(r) for r in negatives.mine(df, QUERY).collect())
    assert out == [(0, p, r + 1, 10 + r, 4, 4) for p in (3, 4) for r in range(5)]
    assert negatives.mine(df.limit(0), QUERY).count() == 0
    assert negatives.mine(df.where("label = 2"), QUERY).count() == 0  # no anchor
    assert negatives.mine(df.where("vec_id in (0, 10)"), QUERY).count() == 0  # no positive
    opposed = spark.createDataFrame([(0, 1, [1]), (1, 1, [-9]), (2, 2, [-8]), (3, 2, [-9])], df.select("vec_id", "label", "vector").schema)
    assert negatives.mine(opposed, QUERY).count() == 0  # a window under a negative score is empty


def test_slots_are_the_lowest_limit_not_below():
    limits = np.array([9, 7, 7, -2])
    assert negatives.slot_of(np.array([10, 9, 8, 7, 0, -2, -5]), limits).tolist() == [-1, 0, 0, 2, 2, 3, 3]


def test_rows_of_unlike_length_are_filled():
    lists = pa.chunked_array([pa.array([[9], [1, 2]], pa.list_(pa.int64())).slice(1), pa.array([[], [3]], pa.list_(pa.int64()))])
    assert vectors.matrix(lists, 3).tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]
