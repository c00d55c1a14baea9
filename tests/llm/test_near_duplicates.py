import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard, queries
from tidemark.llm.components import connected
from tidemark.llm.shingles import shingle_sets


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """doc_id -> (class_id, n_links) over distinct (doc_id, text)."""
    rows = sorted({(d, t) for d, t in rows if d is not None}, key=str)
    sets = [shingles(t) for _, t in rows]
    near = defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (10 * len(a & b) >= 8 * len(a | b)) if a and b else (not a and not b and rows[i][1] is not None and rows[i][1] == rows[j][1]):
                near[i].add(j)
                near[j].add(i)
    seen, result = set(), {}
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, group = [i], set()
        while todo:
            u = todo.pop()
            if u not in group:
                group.add(u)
                todo += near[u]
        seen |= group
        first = min(rows[u][0] for u in group)
        for u in group:
            result[rows[u][0]] = (first, len(near[u]))
    return result


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def corpus(seed):
    """Copies, near copies around the threshold and a chain of them."""
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(60):
        base = words(rng, rng.randrange(3, 160))
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((n, " ".join(text)))
            n += 1
    chain = words(rng, 120)
    for i in range(25):
        rows.append((n, " ".join(chain)))
        chain = chain[3:] + words(rng, 3)
        n += 1
    return rows


@pytest.mark.parametrize("seed,block", [(1, 2 << 20), (2, 2000)])
def test_join_matches_all_pairs(spark, documents, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", block)
    rows = corpus(seed)
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(documents(rows)).collect()}
    assert found == brute(rows)


def test_many_short_texts_of_one_template(spark, documents, monkeypatch):
    largest = []

    def measured(rows, similarity):
        largest.append(rows.groupBy("tree", "label", "lo", "hi").count().agg(F.max("count")).first()[0])
        return verified(rows, similarity)

    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", measured)
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 500)
    n = 20_000
    rows = [(i, f"error 404 not found on server {i}") for i in range(n)]
    rows += [(n + i, f"alert the disk of host {i} is full now please call someone who can look after the big machine in the cellar") for i in range(3)]
    rows += [(n + 10 + i, f"Error 404, not found on server {i}") for i in range(5)]
    joined = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(documents(rows)).collect()}
    assert len(joined) == len(rows) and largest[0] <= 2 * 500 * 1.3
    assert all(joined[i] == (i, 0) for i in range(5, n + 3))
    assert all(joined[i] == joined[n + 10 + i] == (i, 1) for i in range(5))


def test_verify_needs_little_memory():
    m = 5000
    sets = [np.array(sorted({1, 2, 3, 4, 5, 6, 7, 8, 9, 100 + i // 2})[: 9 + (i % 100 < 2)], dtype=np.uint64) if i % 2 else np.array([10**6 + i, 1, 2], np.uint64) for i in range(m)]
    nodes = [b"%06d" % i for i in range(m)]
    rng = np.random.default_rng(0)
    labels, weights = rng.integers(0, 9, (m, 16)), np.ones(m, np.int64)
    labels[:, 0] = 1
    for across in (False, True):
        sides = np.arange(m) // 2 % 2 if across else np.zeros(m, np.int64)
        tracemalloc.start()
        touched, links, root = jaccard._verify(nodes, weights, labels, sets, sides, across, 0, (8, 10))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 350e6  # one matrix of floats and one of flags
        odd = np.arange(1, m, 2)
        assert list(touched) == list(odd) and set(root[odd]) == {1}
        same = [np.sum(sides[odd] == s) for s in sides[odd]]
        assert list(links[odd]) == [len(odd) - k if across else len(odd) - 1 for k in same]


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    joined = jaccard.join(docs)
    expected = brute(rows)
    assert {r.doc_id: (r.class_id, r.n_links) for r in joined.collect()} == expected
    kept = sorted(r.doc_id for r in jaccard.keep_first(docs, joined).collect())
    assert kept == sorted({c for c, _ in expected.values()})


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_gives_the_same(spark, sf):
    import duckdb

    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = con.execute(queries.ORACLES["op9_jaccard_join"]).fetchall()
    found = [tuple(r) for r in queries.op9_jaccard_join(spark, folder).collect()]
    assert sorted(found) == sorted(expected) and expected


def test_awkward_rows(spark, documents, awkward):
    rows = awkward + [(11, ""), (12, "one two three"), (13, "One, two THREE!"), (14, "..."), (15, "..."), (16, None)]
    docs = documents(rows)
    joined = jaccard.join(docs)
    assert {r.doc_id: (r.class_id, r.n_links) for r in joined.collect()} == brute(rows)
    kept = jaccard.keep_first(docs, joined)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 1, 7: 1, 8: 1, 9: 1, 12: 1, 14: 1, 16: 1})
    assert jaccard.join(docs.limit(0)).count() == 0


def test_an_id_on_several_texts(spark, documents):
    one, other, third = ("a b c d e f g h", "q r s t u v w x y", "k l m n o p")
    rows = [(1, one), (1, other), (1, None), (2, one), (3, other), (3, third), (4, third), (1, one)]
    docs = documents(rows)
    kept = [(r.doc_id, r.text) for r in jaccard.keep_first(docs, jaccard.join(docs)).collect()]
    assert sorted(kept, key=str) == sorted([(1, one), (1, other), (1, None), (3, third)], key=str)


def test_prefix_length_reaches_the_recall():
    depth = jaccard.prefix_length(0.8)
    assert 1 - (1 - 0.8**depth) ** jaccard.TREES >= jaccard.RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** jaccard.TREES
    with pytest.raises(ValueError):
        jaccard.prefix_length(0.01, trees=2)


def test_shingle_sets():
    texts = ["a b c d e f", "A, b! C d\ne f", "a b", "", "a b c d e a b c d e", "x1_y é"] + ["q w e r t y " * 30]
    flat, offsets = shingle_sets(pa.array(texts))
    sets = [tuple(flat[offsets[i] : offsets[i + 1]]) for i in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[0] == sets[1] and all(list(s) == sorted(set(s)) for s in sets)
    alone, _ = shingle_sets(pa.array(texts[4:5]))
    assert tuple(alone) == sets[4]


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    expected = {x: root(x) for a, b in edges for x in (a, b) if a != b}
    found = connected(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
