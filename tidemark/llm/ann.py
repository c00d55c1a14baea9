"""Nearest neighbours by inner product with balanced posting lists.

Centroids come from a balanced hierarchical clustering of a bounded sample and
are searched by a graph in memory. Each vector goes to the list of its nearest
centroid and, if it lies near a boundary, to further lists. A query reads the
lists whose centroids are within a ratio of its nearest one. Lists are read in
blocks, so none has to fit in a task. Inner product becomes distance by one more
component that gives all vectors the same length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import saved

NEIGHBOURS = 20
# The clustering sees at most so many vectors; every vector is indexed.
SAMPLE_ROWS = 20_000
# Mean rows of a list: about the root of their number, so that finding lists and
# reading them cost alike; never under LEAST_ROWS.
LEAST_ROWS = 32
MAX_LISTS = 4096
BLOCK_ROWS = 4096
LINKS = 16
REPLICAS = 6
REPLICA_RATIO = 1.15
# The probe ratio is set so that this part of the true neighbours of so many
# queries, found by brute force over all vectors, lies in the lists they read.
RECALL = 0.97
MEASURED_QUERIES = 64


@dataclass
class Index:
    """Centroids with their graph; `sizes` once the lists are filled."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    longest: float
    sizes: np.ndarray | None = None
    ratio: float = 1.0
    beam: int = 1


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of equal size: 2-means whose cut is the median."""
    a, b = points[rng.choice(len(points), 2, replace=False)]
    half = len(points) // 2
    for _ in range(6):
        side = points @ (a - b) - ((a @ a) - (b @ b)) / 2
        order = np.argsort(-side, kind="stable")
        a, b = points[order[:half]].mean(axis=0), points[order[half:]].mean(axis=0)
    return order[:half], order[half:]


def cluster(points: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of about `lists` balanced clusters."""
    rng = np.random.default_rng(seed)
    target = max(1, len(points) // max(1, lists))
    done, todo = [], [points]
    while todo:
        p = todo.pop()
        if len(p) <= max(1, int(target * 1.5)):
            done.append(p.mean(axis=0))
        else:
            left, right = _split(p, rng)
            todo += [p[left], p[right]]
    return np.array(done)


def build(points: np.ndarray, lists: int, longest: float) -> Index:
    """Cluster, then link each centroid to its nearest ones and back, in blocks."""
    centroids = cluster(points, lists)
    n = len(centroids)
    near = min(LINKS, n - 1)
    links: list[set[int]] = [set() for _ in range(n)]
    norms = (centroids**2).sum(axis=1)
    for start in range(0, n if near else 0, 1024):
        block = centroids[start : start + 1024]
        far = norms[None, :] - 2 * block @ centroids.T
        far[np.arange(len(block)), start + np.arange(len(block))] = np.inf
        for i, row in enumerate(np.argpartition(far, near - 1, axis=1)[:, :near]):
            for j in row.tolist():
                links[start + i].add(j)
                links[j].add(start + i)
    width = max(1, max((len(x) for x in links), default=1))
    width = min(width, 3 * LINKS)
    table = np.arange(n)[:, None].repeat(width, axis=1)
    for i, x in enumerate(links):
        x = sorted(x, key=lambda j: float(((centroids[i] - centroids[j]) ** 2).sum()))[:width]
        table[i, : len(x)] = x
    entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(int))
    return Index(centroids, table, entries, longest)


def nearest_lists(index: Index, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of the centroid graph for all points at once: list
    numbers and squared distances, nearest first; -1 where there are fewer."""
    c = index.centroids
    beam = min(beam, len(c))
    norms, own = (c**2).sum(axis=1), (points**2).sum(axis=1)
    every = np.arange(len(points))
    seen = np.zeros((len(points), len(c)), dtype=bool)

    def distance(ids: np.ndarray) -> np.ndarray:
        return np.maximum(own[:, None] + norms[ids] - 2 * np.einsum("qd,qkd->qk", points, c[ids]), 0)

    ids = np.broadcast_to(index.entries, (len(points), len(index.entries))).copy()
    far = distance(ids)
    seen[:, index.entries] = True
    done = np.zeros(ids.shape, dtype=bool)
    while True:
        order = np.argsort(far, axis=1, kind="stable")[:, :beam]
        ids, far, done = (np.take_along_axis(x, order, axis=1) for x in (ids, far, done))
        waiting = np.where(done | ~np.isfinite(far), np.inf, far)
        pick = waiting.argmin(axis=1)
        live = np.isfinite(waiting[every, pick])
        if not live.any():
            return np.where(np.isfinite(far), ids, -1), far
        done[every, pick] = True
        new = index.links[ids[every, pick]]
        fresh = ~seen[every[:, None], new] & live[:, None]
        # a neighbour listed twice counts once
        fresh &= np.concatenate([np.ones((len(new), 1), bool), np.diff(new, axis=1) != 0], axis=1)
        seen[every[:, None], new] |= live[:, None]
        ids = np.concatenate([ids, new], axis=1)
        far = np.concatenate([far, np.where(fresh, distance(new), np.inf)], axis=1)
        done = np.concatenate([done, ~fresh], axis=1)


def _replicas(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, list) pairs: the nearest list, and others about as near unless a
    chosen centroid is nearer to theirs than the point is."""
    ids, far = nearest_lists(index, points, 16)
    keep = (far <= far[:, :1] * REPLICA_RATIO**2) & (ids >= 0)
    keep[:, 0] = True
    for j in range(1, min(ids.shape[1], 16)):
        for i in range(j):
            between = ((index.centroids[ids[:, j]] - index.centroids[ids[:, i]]) ** 2).sum(axis=1)
            keep[:, j] &= ~(keep[:, i] & (between < far[:, j] * 0.5))
    keep &= np.cumsum(keep, axis=1) <= REPLICAS
    point, place = np.nonzero(keep)
    return point, ids[point, place]


def _probes(index: Index, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, list) pairs: lists within the distance ratio, and always enough
    to hold k vectors counted once per possible replica."""
    ids, far = nearest_lists(index, points, index.beam)
    held = np.where(ids >= 0, index.sizes[ids], 0)
    before = np.cumsum(held, axis=1) - held
    keep = far <= far[:, :1] * index.ratio**2 + 1e-12
    keep = (keep | (before < k * REPLICAS)) & (ids >= 0)
    query, place = np.nonzero(keep)
    return query, ids[query, place]


def _set_ratio(index: Index, points: np.ndarray, lists: dict[tuple[int, int], list[int]], k: int) -> None:
    """The ratio of distances up to which queries read lists, from the lists that
    hold the true neighbours: (query, neighbour) -> lists. The beam is as wide
    as the queries need at that ratio."""
    far = ((points**2).sum(axis=1)[:, None] + (index.centroids**2).sum(axis=1) - 2 * points @ index.centroids.T).clip(min=0)
    ratio = np.sqrt(far / np.maximum(far.min(axis=1, keepdims=True), 1e-30))
    needed = np.sort([ratio[q, held].min() for (q, _), held in lists.items()])
    if len(needed):
        index.ratio = float(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) * (1 + 1e-9)
    read = (ratio <= index.ratio).sum(axis=1).max(initial=1)
    # lists enough for k neighbours even if each stands in all of its replicas
    least = np.searchsorted(np.cumsum(np.sort(index.sizes)), k * REPLICAS) + 1
    index.beam = int(min(len(index.centroids), max(32, 1.25 * read, least)))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def valid_vectors(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """vec_id and embedding of the rows that take part: no null id, no null,
    empty or zero vector, no null or non-finite component; of vectors of unlike
    dimension, those of the commonest one."""
    good = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists("embedding", lambda x: x != 0)
    )
    common = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("embedding") == (common["n"] if common else 0))


def search(
    vectors: DataFrame, is_query, k: int = NEIGHBOURS, id_column: str = "vec_id", vector: str = "embedding",
    report: dict | None = None,
) -> DataFrame:
    """The k nearest found of each row for which `is_query` (over vec_id) holds:
    query_id, rank from 1, vec_id, score (inner product in double precision).

    Ties go to the smaller vec_id; a query's own id is no candidate. Equal vectors
    are one entry of the index with their k + 1 smallest ids, which is all that a
    top k can need. A row that repeats counts once. See `valid_vectors` for rows
    that take no part; without any the result is empty. Other columns are left aside.

    `report`, if given, is filled with the number of `lists`, of `postings` and of
    `asked` vectors, and with `share`, the mean part of all postings that these read.
    """
    spark = vectors.sparkSession
    good = saved(valid_vectors(vectors, id_column, vector).distinct())
    first = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = saved(
        good.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k + 1)
        .groupBy("embedding")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    total, longest = distinct.select(F.count("*"), F.max(length)).first()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], out)
    share = min(1.0, 1.5 * SAMPLE_ROWS / total)
    sample = distinct.where(F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    points = _matrix(sample.select("embedding").limit(SAMPLE_ROWS).toArrow().column(0))
    if not len(points):
        points = _matrix(distinct.select("embedding").limit(SAMPLE_ROWS).toArrow().column(0))

    def lengthened(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1, keepdims=True), 0))], axis=1)

    def aimed(x: np.ndarray) -> np.ndarray:
        x = x * (longest / np.sqrt((x**2).sum(axis=1, keepdims=True)))
        return np.concatenate([x, np.zeros((len(x), 1))], axis=1)

    rows = max(LEAST_ROWS, total**0.5)
    lists = int(min(MAX_LISTS, max(1, total // rows), max(1, len(points) // 4)))
    index = build(lengthened(points), lists, longest)
    shared = spark.sparkContext.broadcast(dict(vars(index)))  # at most MAX_LISTS centroids

    def spread(choose, turn):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, len(batch), 1024):
                    part = batch.slice(start, 1024)
                    row, to = choose(turn(_matrix(part.column(1))))
                    taken = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to.astype(np.int32)), *taken.columns], names=["list", *taken.schema.names]
                    )

        return run

    kind = distinct.schema["embedding"].dataType.simpleString()
    postings = saved(
        distinct.select("ids", "embedding").mapInArrow(
            spread(lambda x: _replicas(Index(**shared.value), x), lengthened),
            f"list int, ids {distinct.schema['ids'].dataType.simpleString()}, embedding {kind}",
        )
    )
    sizes = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # at most MAX_LISTS
    index.sizes = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])
    queries = good.where(is_query)
    asked = saved(queries.groupBy("embedding").agg(F.min("vec_id").alias("asked")))
    some = asked.orderBy(F.xxhash64("asked"), "asked").limit(MEASURED_QUERIES).toArrow()
    if some.num_rows:
        probe = _matrix(some.column("embedding"))
        own = some.column("asked").to_pylist()

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    scores = probe @ _matrix(batch.column(1)).T
                    top = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
                    query = np.repeat(np.arange(len(probe)), top.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), batch.column(0).take(pa.array(top.ravel())), pa.array(scores[query, top.ravel()])],
                        names=["query", "first", "score"],
                    )

        by_score = Window.partitionBy("query").orderBy(F.desc("score"), "first")
        true = (  # at most k + 1 rows for each measured query
            distinct.select(F.col("ids")[0].alias("first"), "embedding")
            .mapInArrow(nearest, f"query bigint, first {distinct.schema['ids'].dataType.elementType.simpleString()}, score double")
            .withColumn("_n", F.row_number().over(by_score))
            .where(F.col("_n") <= k + 1)
        )
        lists: dict[tuple[int, int], list[int]] = {}
        for r in postings.select("list", F.col("ids")[0].alias("first")).join(F.broadcast(true), "first").collect():
            if r["first"] != own[r["query"]]:
                lists.setdefault((r["query"], r["first"]), []).append(r["list"])
        _set_ratio(index, aimed(probe), lists, k + 1)
    filled = spark.sparkContext.broadcast(dict(vars(index)))
    probes = saved(
        asked.select("asked", "embedding").mapInArrow(
            spread(lambda x: _probes(Index(**filled.value), x, k + 1), aimed), f"list int, asked bigint, embedding {kind}"
        )
    )
    if report is not None:
        held = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}  # at most MAX_LISTS
        report["lists"], report["postings"] = len(index.centroids), int(index.sizes.sum())
        report["asked"] = asked.count()
        read = sum(n * int(index.sizes[i]) for i, n in held.items())
        report["share"] = read / max(1, report["asked"] * report["postings"])
    blocks = F.broadcast(  # one row per list
        postings.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    turns = F.broadcast(
        probes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("turns"))
    )
    left = (
        postings.join(turns, "list")
        .join(blocks, "list")
        .withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("blocks")).cast("int"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        .drop("blocks", "turns")
    )
    right = (
        probes.join(blocks, "list")
        .join(turns, "list")
        .withColumn("turn", F.pmod(F.xxhash64("asked"), F.col("turns")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .drop("blocks", "turns")
    )

    hit = pa.struct([("far", pa.float64()), ("vec_id", pa.int64())])

    def score(entries: pa.Table, wanted: pa.Table) -> pa.Table:
        """One row for each query of a block: its nearest there, as (score with
        its sign turned, vec_id), so that they sort nearest first."""
        schema = pa.schema([("asked", pa.int64()), ("hits", pa.list_(hit))])
        if not len(entries) or not len(wanted):
            return schema.empty_table()
        x, q = _matrix(entries.column("embedding")), _matrix(wanted.column("embedding"))
        ids = entries.column("ids").combine_chunks()
        counts = np.diff(ids.offsets.to_numpy())
        flat = ids.flatten().to_numpy()
        owner = np.repeat(np.arange(len(x)), counts)
        far, vec, cuts = [], [], [0]
        for start in range(0, len(q), 256):
            part = q[start : start + 256]
            scores = part @ x.T
            near = min(k + 1, len(x))
            # the (k+1)-th best vector bounds what can count; near ties stay in
            least = -np.partition(-scores, near - 1, axis=1)[:, near - 1]
            for one, row, low in zip(part, scores, least - 1e-9 * longest**2):
                chosen = np.flatnonzero((row >= low)[owner])
                # summed alike whatever block a vector is read in
                s, v = -(x[owner[chosen]] * one).sum(axis=1), flat[chosen]
                top = np.lexsort((v, s))[: k + 1]
                far.append(s[top])
                vec.append(v[top])
                cuts.append(cuts[-1] + len(top))
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(far)), pa.array(np.concatenate(vec))], fields=list(hit))
        hits = pa.ListArray.from_arrays(pa.array(np.array(cuts, dtype=np.int32)), pairs)
        return pa.Table.from_arrays([wanted.column("asked").combine_chunks(), hits], schema=schema)

    scored = left.groupBy("list", "block", "turn").cogroup(right.groupBy("list", "block", "turn"))
    # copies of a vector in several lists come out the same, and a vector stands in
    # REPLICAS lists at most, so this many hold k + 1 vectors; tasks cut to them
    # before rows move
    nearest_first = Window.partitionBy("asked").orderBy("hit")
    hits = (
        scored.applyInArrow(score, "asked bigint, hits array<struct<far: double, vec_id: bigint>>")
        .select("asked", F.explode("hits").alias("hit"))
        .withColumn("_n", F.row_number().over(nearest_first))
        .where(F.col("_n") <= (k + 1) * REPLICAS)
        .groupBy("asked")
        .agg(F.sort_array(F.collect_list("hit")).alias("hits"))
        .select("asked", F.slice(F.array_distinct("hits"), 1, k + 1).alias("hits"))
    )
    order = F.filter("hits", lambda h: h["vec_id"] != F.col("query_id"))
    return (
        queries.select(F.col("vec_id").alias("query_id"), "embedding")
        .join(asked, "embedding")
        .join(hits, "asked")
        .select("query_id", F.posexplode(F.slice(order, 1, k)).alias("at", "hit"))
        .select(
            F.col("query_id").cast("bigint"),
            (F.col("at") + 1).alias("rank"),
            F.col("hit.vec_id").cast("bigint").alias("vec_id"),
            (-F.col("hit.far")).alias("score"),
        )
    )
