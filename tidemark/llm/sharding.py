"""Shards of near equal bytes by k-d tree partitioning over row metadata.

DataFrame operations only. A node of the tree that is to become `s` shards is
cut at the weighted quantile s // 2 / s of the metadata dimension in which its
rows spread widest, so that all leaves reach the target bytes. All nodes of a
level are measured in one job and cut in the same jobs: bytes per (node, bin) are
summed before the shuffle, and the bin that holds the quantile is refined until
its bytes no longer matter. Rows with equal texts share one place in all
dimensions, so no cut parts them, unless they are more than a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import gapless_rank, saved

SHARDS = 40
ROW_BYTES = 16
BINS = 8192
# A cut may miss its quantile by this part of a shard's target bytes.
TOLERANCE = 0.002
# Low bits of a coordinate that tell texts with the same value apart, so that a
# cut can pass through a value that many rows share.
TIE_BITS = 30
VALUE_BITS = 31
# Equal texts of more than a shard are cut to parts of this share of one.
PART_OF_SHARD = 8
# Groups of so many rows are joined by broadcast; there are rows / HOT_ROWS at most.
HOT_ROWS = 100_000


@dataclass
class Node:
    """A node of the tree: how many shards it becomes, the first of them and its
    bytes, and once it is cut its dimension, cut and halves."""

    shards: int
    first: int
    bytes: int
    dimension: int = 0
    low: int = 0
    high: int = 0
    wanted: int = 0
    left: int = 0
    cut: int | None = None
    halves: tuple[Node, Node] | None = None

    def aim(self, extents: list[tuple[int, int]]) -> None:
        """Look for the cut along the dimension whose values spread widest among
        the node's rows, the first of equally wide ones."""
        spread = [(high >> TIE_BITS) - (low >> TIE_BITS) for low, high in extents]
        self.dimension = max(range(len(extents)), key=lambda d: spread[d])
        self.low, self.high = extents[self.dimension]
        self.wanted, self.left = self.bytes * (self.shards // 2) // self.shards, 0

    def split(self) -> None:
        half = self.shards // 2
        self.halves = (
            Node(half, self.first, self.left),
            Node(self.shards - half, self.first + half, self.bytes - self.left),
        )


def _coordinate(value, low, high, tie):
    """`value` scaled to VALUE_BITS between low and high, then TIE_BITS of a hash.
    A null counts as the lowest value."""
    scale = F.when(F.lit(high) > F.lit(low), F.lit(float(2**VALUE_BITS - 1)) / F.lit(float(high - low))).otherwise(F.lit(0.0))
    place = F.coalesce((value.cast("double") - F.lit(float(low))) * scale, F.lit(0.0)).cast("long")
    return F.shiftleft(place, TIE_BITS) + F.pmod(tie, F.lit(2**TIE_BITS))


def coordinates(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, two hashes of the text and the metadata dimensions
    of each row: the document's number, its length, its source and its language."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("t_one"),
        F.xxhash64(text, F.lit(1)).alias("t_two"),
        F.col("doc_id").cast("double").alias("d_id"),
        F.log2(F.octet_length(text) + F.lit(ROW_BYTES)).alias("d_size"),
        F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")).cast("double").alias("d_source"),
        F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")).cast("double").alias("d_lang"),
    )


_DIMENSIONS = ["d_id", "d_size", "d_source", "d_lang"]


def gathered(rows: DataFrame, target: float) -> DataFrame:
    """`rows` with the dimensions that equal texts share, the least of each, and
    `tie`, a hash that tells texts apart. Texts that together exceed `target` bytes
    are dealt into parts with ties of their own. `rows` must be saved."""
    key = ["t_one", "t_two"]
    groups = (
        rows.groupBy(*key)
        .agg(F.count("*").alias("n"), F.sum("size").alias("total"), *[F.min(d).alias(f"g_{d}") for d in _DIMENSIONS])
        .where("n > 1")
        .withColumn("parts", F.when(F.col("total") > target, F.ceil(F.col("total") * PART_OF_SHARD / F.lit(max(target, 1.0)))).otherwise(1))
    )
    groups = saved(groups.drop("total"))
    # a hot text by broadcast, so that no task gets all its rows
    hot = groups.where(F.col("n") >= HOT_ROWS).drop("n")
    cool = groups.where(F.col("n") < HOT_ROWS).drop("n")
    shared = [c for c in cool.columns if c not in key]
    with_hot = rows.join(F.broadcast(hot), key, "left")
    rest = with_hot.where("parts is null").drop(*shared).join(cool, key, "left")
    both = with_hot.where("parts is not null").unionByName(rest)
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("_row"), F.col("parts"))).otherwise(F.lit(0))
    alone = F.col("parts").isNull()
    return both.select(
        "doc_id", "size", "text_crc32", F.xxhash64(*key, part).alias("tie"),
        *[F.when(alone, F.col(d)).otherwise(F.col(f"g_{d}")).alias(d) for d in _DIMENSIONS],
    )


def _tree(node: Node, keys: list[str], value) -> Column:
    """One nested expression that walks a row down the tree."""
    if node.halves is None:
        return F.lit(value(node))
    left, right = node.halves
    return F.when(F.col(keys[node.dimension]) < node.cut, _tree(left, keys, value)).otherwise(_tree(right, keys, value))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.halves is None else [x for h in node.halves for x in _leaves(h)]


def _cut_level(rows: DataFrame, nodes: dict[int, Node], keys: list[str], tolerance: int) -> None:
    """Find the cut of every node: where the bytes to its left reach the wanted
    ones, give or take the tolerance. `rows` tell their node by its number."""
    open_nodes = dict(nodes)
    last = max(nodes)
    while open_nodes:
        width = {i: max(1, -(-(n.high - n.low + 1) // BINS)) for i, n in open_nodes.items()}

        def of(value, kind):
            return F.array(*[F.lit(value(i) if i in open_nodes else None).cast(kind) for i in range(last + 1)])[F.col("node")]

        x = F.array(*[F.col(k) for k in keys])[of(lambda i: open_nodes[i].dimension, "int")]
        place = rows.select("node", "size", (x - of(lambda i: open_nodes[i].low, "bigint")).alias("x"))
        sums = (
            place.select(
                F.when(F.col("x").between(0, of(lambda i: open_nodes[i].high - open_nodes[i].low, "bigint")), F.col("node")).alias("at"),
                F.floor(F.col("x") / of(lambda i: width[i], "bigint")).cast("int").alias("bin"),
                "size",
            )
            .groupBy("at", "bin")
            .agg(F.sum("size").alias("bytes"))
            .where("at is not null")
        )
        upto = Window.partitionBy("at").orderBy("bin")
        wanted = F.array(*[F.lit(open_nodes[i].wanted if i in open_nodes else None).cast("bigint") for i in range(last + 1)])
        hit = (
            sums.withColumn("upto", F.sum("bytes").over(upto))
            .where(F.col("upto") >= wanted[F.col("at")])
            .groupBy("at")
            .agg(F.min_by(F.struct("bin", "bytes", "upto"), "bin").alias("hit"))
            .select("at", "hit.*")
        )
        hits = {r["at"]: r for r in hit.collect()}  # one row per open node
        for i, node in list(open_nodes.items()):
            if i not in hits:
                node.cut, node.left = node.high + 1, node.bytes
            else:
                r = hits[i]
                before = r["upto"] - r["bytes"]
                low = node.low + r["bin"] * width[i]
                gap = node.wanted - before
                if gap <= tolerance:
                    node.cut, node.left = low, node.left + before
                elif r["bytes"] - gap <= tolerance:
                    node.cut, node.left = low + width[i], node.left + r["upto"]
                elif width[i] == 1:
                    # one place holds the quantile: it goes where more of it belongs
                    after = 2 * gap >= r["bytes"] or node.left + before == 0
                    node.cut, node.left = low + after, node.left + (r["upto"] if after else before)
                else:
                    node.wanted -= before
                    node.left += before
                    node.low, node.high = low, min(node.high, low + width[i] - 1)
                    continue
            del open_nodes[i]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, shard, slot.

    The law is bytes: shards hold near equal sums of `size`, the text's UTF-8
    bytes plus 16. Equal texts stay in one shard unless they exceed a shard's mean
    size. A null text has no bytes and counts as empty; null doc_id, source and
    lang count as lowest values; repeated rows are rows of one text; `slot` numbers
    the rows of a shard from 0. An empty table gives no rows. Other columns than
    doc_id, text, lang and source are left aside.
    """
    rows = saved(coordinates(docs).withColumn("_row", F.monotonically_increasing_id()))
    whole = rows.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        *[f(n).alias(f"{g}_{n}") for n in _DIMENSIONS for g, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    target = whole["bytes"] / shards
    rows = gathered(rows, target)
    for n in _DIMENSIONS:
        low, high = whole[f"lo_{n}"] or 0.0, whole[f"hi_{n}"] or 0.0
        rows = rows.withColumn(f"k_{n}", _coordinate(F.col(n), low, high, F.col("tie")))
    keys = [f"k_{n}" for n in _DIMENSIONS]
    rows = saved(rows.select("doc_id", "size", "text_crc32", *keys))
    tolerance = int(target * TOLERANCE)
    root = Node(shards, 0, whole["bytes"])
    while any(n.shards > 1 for n in _leaves(root)):
        leaves = _leaves(root)
        number = {id(n): i for i, n in enumerate(leaves)}
        level = rows.select("size", *keys, _tree(root, keys, lambda n: number[id(n)]).alias("node"))
        ends = [f(k).alias(f"{g}_{k}") for k in keys for g, f in (("lo", F.min), ("hi", F.max))]
        extents = {  # one row per node of the level, `shards` at most
            r["node"]: [(r[f"lo_{k}"], r[f"hi_{k}"]) for k in keys] for r in level.groupBy("node").agg(*ends).collect()
        }
        wide = {i: n for i, n in enumerate(leaves) if n.shards > 1}
        for i, n in wide.items():
            n.aim(extents.get(i, [(0, 0)] * len(keys)))
        _cut_level(level, wide, keys, tolerance)
        for n in wide.values():
            n.split()
    sharded = rows.select("doc_id", "size", "text_crc32", _tree(root, keys, lambda n: n.first).alias("shard"))
    return gapless_rank(saved(sharded), ["shard"], "slot")
