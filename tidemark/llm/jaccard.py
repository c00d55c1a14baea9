"""Documents whose word shingles are alike, by a MinHash LSH forest.

Each tree of the forest sorts documents by a path of min-hashes. Two documents
meet where their paths share a prefix; the prefix is shortened from the full
path until documents at the threshold meet in some tree with the target recall.
Documents that meet are verified exactly on their shingle sets.

Equal shingle sets are one class. A group that shares a prefix is cut into
blocks by its bytes and members; each pair of blocks is verified as matrix products in one
task, which returns counts and local components, never pairs. A pair counts in
the first tree where it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from tidemark.llm.common import bounded_batches, saved, slices, with_text_columns
from tidemark.llm.components import connected
from tidemark.llm.shingles import mixed, shingle_sets

SIMILARITY = (8, 10)  # as a fraction, so that the test is exact
RECALL = 0.999
TREES = 16
LONGEST_PREFIX = 8
BLOCK_BYTES = 2 << 20
# A pair of blocks is a matrix of at most about this number squared, whatever the texts' length.
BLOCK_MEMBERS = 4000
TILE_CELLS = 1 << 18  # cells compared at once


def prefix_length(similarity: float, trees: int = TREES, longest: int = LONGEST_PREFIX, recall: float = RECALL) -> int:
    """Shorten the prefix until a pair at the similarity meets in at least one
    tree with the wanted probability."""
    for depth in range(longest, 0, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    raise ValueError("too few trees for this recall")


def paths(shingles: np.ndarray, offsets: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """The prefix of each text's path in each tree, as one number per tree.
    Texts without shingles get zeros."""
    n = len(offsets) - 1
    rng = np.random.default_rng(2718)
    a = rng.integers(0, 2**31, trees * depth).astype(np.uint32) * 2 + 1
    b = rng.integers(0, 2**32, trees * depth).astype(np.uint32)
    some = np.diff(offsets) > 0
    starts = offsets[:-1][some]
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    labels = np.zeros((n, trees), dtype=np.uint64)
    if len(starts):
        for t in range(trees):
            label = np.full(len(starts), t, dtype=np.uint64)
            for d in range(depth):
                least = np.minimum.reduceat(low * a[t * depth + d] + b[t * depth + d], starts)
                label = mixed(label * np.uint64(0x9E3779B97F4A7C15) + least)
            labels[some, t] = label
    return labels


def _set_keys(shingles: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """16 bytes that stand for a shingle set, or None for an empty one."""
    ones = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles), dtype=np.uint64)])
    twos = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles ^ np.uint64(0x5555)), dtype=np.uint64)])
    pair = np.stack([ones[offsets[1:]] - ones[offsets[:-1]], twos[offsets[1:]] - twos[offsets[:-1]]], axis=1)
    return [pair[i].astype(">u8").tobytes() if offsets[i + 1] > offsets[i] else None for i in range(len(offsets) - 1)]


def text_key(text):
    """16 bytes that stand for a text; null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))


def _sketch(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    def make():
        def run(texts: pa.Array) -> list:
            shingles, offsets = shingle_sets(texts)
            labels = paths(shingles, offsets, trees, depth).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * trees), pa.array(labels.ravel()))
            return [pa.array(_set_keys(shingles, offsets), pa.binary()), pa.array(np.diff(offsets)), flat]

        return run

    fields = [StructField("node", BinaryType()), StructField("size", LongType()), StructField("labels", ArrayType(LongType()))]
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    return with_text_columns(keyed, "text", fields, make).drop("text")


def _verify(nodes: list[bytes], weights: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, across: bool, tree: int, similarity):
    """Links of each member and its local component's least node: of all pairs of
    one block, or `across` two blocks, told apart by side."""
    m = len(nodes)
    size = np.array([len(s) for s in sets])
    left = np.flatnonzero(sides == 0) if across else np.arange(m)
    right = np.flatnonzero(sides == 1) if across else left
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    if m == 2:
        common[:] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    elif common.size:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
        values, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[column] > 1
        number = np.cumsum(count > 1) - 1
        column, owner = number[column[shared]], owner[shared]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        step = max(256, (8 << 20) // (4 * m))
        total = int(column[-1]) + 1 if len(column) else 0
        cuts = np.searchsorted(column, np.arange(0, total + step, step))
        rows = max(1, TILE_CELLS // len(right))
        for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            part = np.zeros((m, min(step, total - i * step)), dtype=np.float32)
            part[owner[lo:hi], column[lo:hi] - i * step] = 1
            other = part[right].T
            for start in range(0, len(left), rows):
                common[start : start + rows] += part[left[start : start + rows]] @ other
    up, down = similarity
    tile = max(1, TILE_CELLS // max(1, len(right)))
    linked = np.zeros(common.shape, dtype=bool)
    for start in range(0, len(left), tile):
        at, some = left[start : start + tile], common[start : start + tile]
        union = size[at][:, None] + size[right][None, :] - some
        linked[start : start + tile] = some * down >= union * up
        if not across:
            linked[start : start + tile] &= at[:, None] < right[None, :]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for start in range(0, len(left), tile):
            a, b = np.nonzero(linked[start : start + tile])
            if len(a):
                yield left[start + a], right[b]

    links, met = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=bool)
    for a, b in pairs():
        met[a] = met[b] = True
        first = (labels[a] == labels[b]).argmax(axis=1) == tree
        np.add.at(links, a[first], weights[b[first]])
        np.add.at(links, b[first], weights[a[first]])
    by_name = np.argsort(np.array(nodes, dtype=object), kind="stable")
    least = np.empty(m, dtype=np.int64)
    least[by_name] = np.arange(m)
    before = None
    while before is None or (least != before).any():
        before = least.copy()
        for a, b in pairs():
            np.minimum.at(least, a, least[b])
            np.minimum.at(least, b, least[a])
    return np.flatnonzero(met), links, by_name[least]


def _verified(rows: DataFrame, similarity) -> DataFrame:
    """node, links and root, from member rows sorted by (tree, label, lo, hi)."""
    names = rows.columns

    def finish(run: list[pa.RecordBatch], out: list) -> None:
        t = pa.Table.from_batches(run).combine_chunks()
        nodes = t.column("node").to_pylist()
        if len(nodes) < 2:
            return
        raw = t.column("shingles").to_pylist()
        labels = np.array(t.column("labels").chunk(0).flatten()).reshape(len(nodes), -1)
        touched, links, root = _verify(
            nodes, t.column("weight").to_numpy(), labels, [np.frombuffer(r, "<u8") for r in raw],
            t.column("side").to_numpy(), t.column("lo")[0] != t.column("hi")[0], t.column("tree")[0].as_py(), similarity,
        )
        out.extend((nodes[i], int(links[i]), nodes[root[i]]) for i in touched)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = np.stack([batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("tree", "label", "lo", "hi")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)] if len(batch) else [0]
            out: list = []
            for start, stop in zip(cuts[:-1], cuts[1:]):
                now = tuple(keys[start])
                if held and now != key:
                    finish(held, out)
                    held = []
                key = now
                held.append(batch.slice(start, stop - start))
            yield _table(out)
        out = []
        if held:
            finish(held, out)
        yield _table(out)

    def _table(out: list) -> pa.RecordBatch:
        node, links, root = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(node, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())], names=["node", "links", "root"]
        )

    return rows.mapInArrow(run_all, "node binary, links bigint, root binary")


def join(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, text_key, class_id, class_key,
    n_links.

    n_links counts the other documents with a Jaccard similarity of five-word
    shingles of at least `similarity`, equal ones included; class_id is the least
    doc_id of the component these links make, class_key the text_key it stands
    on there, as one doc_id may stand on texts of several classes. Texts with equal shingle sets are
    alike; texts without words only equal each other, byte for byte; a null text
    links to nothing. Repeated rows are one document; rows with a null doc_id are
    left out; other columns are left aside; an empty table gives no rows.
    """
    depth = prefix_length(similarity[0] / similarity[1], trees, LONGEST_PREFIX, recall)
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    sketches = saved(
        _sketch(docs, trees, depth)
        # no words: a class of the text itself; a null text: of the document
        .withColumn(
            "node",
            F.coalesce(
                "node",
                F.concat(F.lit(b"t"), "text_key"),
                F.concat(F.lit(b"d"), F.col("doc_id").cast("string").cast("binary")),
            ),
        )
    )
    members = sketches.groupBy("doc_id", "text_key", "node", "size", "labels").agg(F.lit(1).alias("_one")).drop("_one")
    classes = saved(
        members.groupBy("node")
        .agg(
            F.count("*").alias("weight"),
            F.min(F.struct("doc_id", "text_key")).alias("rep"),
            F.first("labels").alias("labels"),
            F.first("size").alias("size"),
        )
    )
    met = classes.where("size > 0").select("node", "size", F.posexplode("labels").alias("tree", "label"))
    groups = (
        met.groupBy("tree", "label")
        .agg(
            F.count("*").alias("n"),
            F.sum("size").alias("total"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .where("n > 1")
    )
    # the same members often meet in several trees: the first will do
    groups = groups.groupBy("n", "x", "y").agg(F.min(F.struct("tree", "label", "total")).alias("g")).select("n", "g.*")
    # short texts have few bytes and many members
    blocks = F.ceil(F.greatest(F.col("total") * 8 / BLOCK_BYTES, F.col("n") / BLOCK_MEMBERS)).cast("int")
    taken = saved(
        met.join(groups, ["tree", "label"])
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
        .select("tree", "label", "node", "blocks", "block")
    )
    wanted = taken.select("node").distinct().join(classes, "node").select("node", "weight", "labels", "rep.*")

    def add_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                part = batch.slice(start, stop - start)
                shingles, offsets = shingle_sets(pc.fill_null(part.column(0), ""))
                sets = [shingles[offsets[i] : offsets[i + 1]].astype("<u8").tobytes() for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(sets, pa.binary())], names=["node", "weight", "labels", "shingles"])

    sets = (
        bounded_batches(docs)
        .withColumn("text_key", text_key(F.col("text")))
        .join(wanted, ["doc_id", "text_key"])
        .select("text", "node", "weight", "labels")
        .mapInArrow(add_sets, "node binary, weight bigint, labels array<bigint>, shingles binary")
    )
    pairs = (
        taken.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .withColumn("side", F.when(F.col("block") == F.col("other"), 0).otherwise((F.col("block") == F.col("hi")).cast("int")))
        .drop("blocks", "block", "other")
    )
    # between two blocks, side 0 is the lower one
    key = ["tree", "label", "lo", "hi"]
    rows = (
        pairs.join(sets.dropDuplicates(["node"]), "node")
        .repartition(*key)
        .sortWithinPartitions(*key)
    )
    found = saved(_verified(rows, similarity))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = classes.select("node", "weight", "rep").join(roots, "node", "left")
    grouped = named.withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("rep").alias("class"))
    final = (
        grouped.join(least, "root")
        .join(links, "node", "left")
        .select("node", F.col("class.doc_id").alias("class_id"), F.col("class.text_key").alias("class_key"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return members.select("doc_id", "text_key", "node").join(final, "node").select("doc_id", "text_key", "class_id", "class_key", "n_links")


def keep_first(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows of `docs` that stand for their class: one row for each class of
    `joined`, and every row with a null doc_id. All columns stay."""
    from pyspark.sql import Window

    from tidemark.llm.common import free_name

    key, number = free_name(docs, "_text_key"), free_name(docs, "_number")
    first = Window.partitionBy("doc_id", key).orderBy(F.lit(1))
    stay = joined.where((F.col("doc_id") == F.col("class_id")) & F.col("text_key").eqNullSafe(F.col("class_key"))).select(
        F.col("doc_id").alias("_stay_id"), F.coalesce("text_key", F.lit(b"")).alias("_stay_key")
    )
    keyed = docs.where("doc_id is not null").withColumn(key, F.coalesce(text_key(F.col("text")), F.lit(b"")))
    one = keyed.withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).drop(number)
    kept = one.join(stay, (F.col("doc_id") == F.col("_stay_id")) & (F.col(key) == F.col("_stay_key")), "left_semi")
    return kept.drop(key).union(docs.where("doc_id is null"))
