import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, sharding
from tidemark.llm.common import gapless_rank, saved


def check(rows, shards):
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < shards for r in rows)


def test_shards_are_near_equal(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    hot = docs.limit(1).crossJoin(spark.range(150).select(F.lit(1).alias("x"))).drop("x")
    docs = docs.union(hot)  # a third of all rows are the same row
    rows = sharding.shard(docs, 5).collect()
    check(rows, 5)
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(5)]
    longest = max(r["size"] for r in rows)
    assert max(sizes) - min(sizes) <= 4 * longest and sum(sizes) == sum(r["size"] for r in rows)
    expected = sorted((r.doc_id, len(r.text.encode()) + 16, zlib.crc32(r.text.encode())) for r in docs.collect())
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected


def plain_tree(items, shards, first=0):
    """items: (coordinates, bytes) by text; the shard of each."""
    if shards == 1 or not items:
        return {t: first for t in items}
    spread = [max(c[d] for c, _ in items.values()) // 2**30 - min(c[d] for c, _ in items.values()) // 2**30 for d in range(4)]
    d = spread.index(max(spread))
    at = {}
    for c, size in items.values():
        at[c[d]] = at.get(c[d], 0) + size
    wanted, upto, cut = sum(at.values()) * (shards // 2) // shards, 0, None
    for place in sorted(at):
        if upto + at[place] >= wanted:
            cut = place + (2 * (wanted - upto) >= at[place] or not upto)
            break
        upto += at[place]
    left = {t: i for t, i in items.items() if i[0][d] < cut}
    right = {t: i for t, i in items.items() if i[0][d] >= cut}
    return plain_tree(left, shards // 2, first) | plain_tree(right, shards - shards // 2, first + shards // 2)


def test_shards_are_those_of_a_plain_tree(spark, sf, monkeypatch):
    monkeypatch.setattr(sharding, "TOLERANCE", 0)
    monkeypatch.setattr(sharding, "BINS", 16)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    copies = docs.limit(20).withColumns({"doc_id": F.col("doc_id") + 1000, "source": F.lit("elsewhere"), "lang": F.lit(None).cast("string")})
    docs = docs.union(copies)
    made = sharding.coordinates(docs).collect()
    dimensions = ["d_id", "d_size", "d_source", "d_lang"]
    low = {d: min(r[d] for r in made) for d in dimensions}
    high = {d: max(r[d] for r in made) for d in dimensions}
    items = {}
    for r in made:
        items.setdefault((r.t_one, r.t_two), []).append(r)
    ties = spark.createDataFrame(list(items), "a bigint, b bigint").select("a", "b", F.xxhash64("a", "b", F.lit(0).cast("bigint")).alias("t")).collect()
    tie = {(r.a, r.b): r.t % 2**30 for r in ties}
    place = lambda v, d: int((v - low[d]) * (float(2**31 - 1) / float(high[d] - low[d]))) if high[d] > low[d] else 0
    plain = {
        key: ([(place(min(r[d] for r in group), d) << 30) + tie[key] for d in dimensions], sum(r["size"] for r in group))
        for key, group in items.items()
    }
    want = plain_tree(plain, 6)
    found = {r.doc_id: r.shard for r in sharding.shard(docs, 6).collect()}
    assert found == {r.doc_id: want[r.t_one, r.t_two] for r in made}
    assert len(set(want.values())) == 6


def test_equal_texts_stay_together(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 50)
    rows = [(i, f"text {i % 90}", "en" if i % 2 else "de", f"s{i % 5}") for i in range(900)]
    rows += [(1000 + i, "hot " * 40, "en", "s") for i in range(600)]  # more than a shard
    rows += [(2000 + i, "warm " * 8, "fr", f"s{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    shard_of = {r.doc_id: (r.shard, r["size"]) for r in sharding.shard(docs, 8).collect()}
    homes = {}
    for doc, text, *_ in rows:
        homes.setdefault(text, set()).add(shard_of[doc][0])
    assert all(len(h) == 1 for text, h in homes.items() if not text.startswith("hot"))
    assert len(homes["hot " * 40]) > 3
    sizes = [sum(size for s, size in shard_of.values() if s == i) for i in range(8)]
    assert max(sizes) < 1.3 * min(sizes)


def test_many_rows_balance(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("x"), (F.rand(3) * 200).cast("int")), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, "a").alias("source"), F.lit(None).cast("string").alias("lang"),
    )
    rows = sharding.shard(docs, 7).groupBy("shard").agg(F.sum("size").alias("b"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    sizes = [r.b for r in rows]
    assert len(sizes) == 7 and max(sizes) < 1.02 * min(sizes)
    assert all(r.m + 1 == r.n for r in rows)


def test_awkward_rows(spark, documents, awkward):
    docs = documents(awkward)
    rows = sharding.shard(docs, 4).collect()
    check(rows, 4)
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted((d or -1, len((t or "").encode()) + 16) for d, t in awkward)
    assert sharding.shard(docs.limit(0), 4).count() == 0


@pytest.mark.parametrize("per_bucket", [3, 1000])
def test_gapless_rank(spark, per_bucket):
    df = saved(spark.range(0, 500, 1, 7).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.lit(1).alias("_row")))
    rows = gapless_rank(df, ["k"], "r", per_bucket).collect()
    for k in {r.k for r in rows}:
        ranks = sorted(r.r for r in rows if r.k == k)
        assert ranks == list(range(len(ranks)))
    assert len(rows) == 500


def test_plan_is_native(spark, sf):
    plan = queries.op10_sharding(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
