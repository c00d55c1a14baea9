"""Aligned tokens and counts against plain loops over whole texts."""

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import pytest

from tidemark.llm import alignment, queries

A = queries.tokenizer_file("byte_bpe_50k.json")
B = queries.tokenizer_file("piece_bpe_32k.model")
PARTS = ["the", "don't", "I'll", "'v", " ", "  ", "\n", "\n\n", "\t", " \n", "é", "12", "!!", "日本", "x", " a", " ", "　", "▁", "\x1c",
         "\x85", "<s>", "<|endoftext|>", "▁x", "\x00", "😀", "https://a.b/c", " ", "é", "﻿"]


@cache
def tokenizers():
    return alignment.Tokenizers(A, B)


def tokens(text):
    """(id, start, end) in bytes of both tokenizers over a blank and the whole text."""
    t = tokenizers()
    out = []
    for ids, (data, at) in ((t.a.encode(" " + text, add_special_tokens=False).ids, t.a_table), (t.b.encode(text), t.b_table)):
        raw = [data[at[i] : at[i + 1]].tobytes() for i in ids]
        if not text or b"".join(raw) != (" " + text).encode():
            return [], []
        ends = np.cumsum([len(r) for r in raw]).tolist()
        out.append([(i, e - len(r), e) for i, r, e in zip(ids, raw, ends)])
    return out


def plain(rows):
    linked, groups = [], []
    for _, text in rows:
        a, b = tokens(text or "")
        linked.append(fast_links(a, b) if len(a) > 60 else [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e])
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts = [[[], []] for _ in cuts]
        for side, run in enumerate((a, b)):
            g = 0
            for i, _, e in run:
                while e > cuts[g]:
                    g += 1
                parts[g][side].append(str(i))
        groups.append((len(a), len(b), len(cuts), ";".join("|".join(",".join(x) for x in p) for p in parts)))
    counts = Counter(p for links in linked for p in links)
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for (doc, _), links, (n_a, n_b, n_g, text) in zip(rows, linked, groups):
        sha = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((doc, n_a, n_b, n_g, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha))
    return out, counts


def fast_links(a, b):
    out, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_matches_whole_texts(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = queries.op13_tokenizer_alignment(spark, sf)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows)[0])


@pytest.mark.parametrize("seed", range(3))
def test_odd_texts_in_small_containers(spark, documents, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(alignment, "CONTAINER_BYTES", 2000)
    monkeypatch.setattr(alignment, "SLICE_BYTES", [40, 300, 4 << 20][seed])
    monkeypatch.setattr(alignment, "ROW_PAIRS", 7)
    monkeypatch.setattr(alignment, "ENCODE_AT_ONCE", 5)
    parts = PARTS if seed else [p for p in PARTS if "▁" not in p]
    rows = [(i, "".join(rng.choices(parts, k=rng.choice([0, 1, 2, 9, 60])))) for i in range(150)]
    rows += [(200 + i, " ".join(rng.choices(["the", "of", "don't", "日本", "a.b"], k=40))) for i in range(60)]
    docs = documents(rows).repartition(3)
    made = alignment.index(docs, A, B)
    want, counts = plain(rows)
    assert sorted(map(tuple, alignment.score(made).select(COLUMNS).collect())) == sorted(want)
    pairs = alignment.pair_counts(made).collect()
    assert {(r.a_id, r.b_id): r.links for r in pairs} == counts
    in_docs = Counter(p for row in rows for p in set(plain([row])[1]))
    assert {(r.a_id, r.b_id): r.documents for r in pairs} == in_docs
    assert made.select("container").distinct().count() > 3


def test_awkward_rows(spark, documents, awkward):
    rows = [*awkward, (10, "the cat " * 70_000 + "\n \nend "), (11, "▁ not kept")]
    found = alignment.align(documents(rows), A, B).collect()
    want = plain(rows)[0]
    assert ordered(map(tuple, found)) == ordered(want)
    assert [r[1:] for r in want if r[0] in (1, 2, 11)] == [(0, 0, 0, 0, 0, 0, "")] * 3
    assert alignment.align(documents(rows).limit(0), A, B).collect() == []


@pytest.mark.parametrize("size", [1, 9, 500])
def test_planes_keep_all_postings(size):
    rng = np.random.default_rng(size)
    chosen = np.sort(rng.choice(40 * size, min(40 * size, 6000), replace=False))
    code, doc = np.where(chosen < size, 0, chosen // size * 3), chosen % size
    times = rng.integers(1, 40, len(code)) ** rng.integers(1, 4, len(code))
    place, found = 0, {}
    for pairs, links, documents, planes, bits in alignment.encode_planes(code, doc, times, size):
        (entry, plain_bits), (few, member) = alignment.decode_planes(bits, len(pairs), planes, size)
        each = [(e, d) for e, row in zip(entry, plain_bits) for d in np.flatnonzero(np.unpackbits(row, count=size))]
        for e, d in [*each, *zip(few, member)]:
            key = (int(pairs[e % len(pairs)]), int(d))
            found[key] = found.get(key, 0) + (1 << int(e) // len(pairs))
        for p, n, k in zip(pairs, links, documents):
            assert n == times[code == p].sum() and k == (code == p).sum()
        place += len(pairs)
    assert found == {(int(c), int(d)): int(t) for c, d, t in zip(code, doc, times)}
    assert place == len(np.unique(code))
