import random

import pytest

from tidemark.llm import decontamination as dec
from tidemark.llm import queries


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (c != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def letters(text):
    return dec.normalised([text])[0][:-1].tolist()


def mutated(rng, text, n):
    text = list(text)
    for _ in range(n):
        i = rng.randrange(len(text))
        text[i : i + rng.choice([0, 1])] = rng.choice([[], ["q"], ["z"]])
    return "".join(text)


def some(rng, n):
    return "".join(rng.choice(["the ", "on", "ti", "er ", "Re", "é", "a. ", "7"]) for _ in range(n)).strip()


@pytest.mark.parametrize("seed,hits", [(1, 1 << 20), (2, 50)])
def test_matches_against_all_alignments(monkeypatch, seed, hits):
    monkeypatch.setattr(dec, "HITS_AT_ONCE", hits)
    rng = random.Random(seed)
    items = [some(rng, n) for n in (8, 15, 30, 30, 60, 120)] + ["the the the the the the the", "short", "", "..."]
    p = dec.passages(list(range(len(items))), items)
    texts = ["", "  ", *items, "the " * 200]
    for _ in range(120):
        texts.append(f"{some(rng, rng.randrange(50))} {mutated(rng, rng.choice(items[:6]), rng.randrange(9))}!! {some(rng, rng.randrange(40))}")
    for text, found in zip(texts, dec.matches(p, texts)):
        whole = letters(text)
        expected = {i: e for i, z in enumerate(p.letters) if (e := least_edits(z.tolist(), whole)) <= dec.budget(len(z))}
        assert {i: e for i, _, _, e in found} == expected
        for i, start, end, e in found:
            assert 0 <= start < end <= len(text)
            assert least_edits(p.letters[i].tolist(), letters(text[max(0, start - 1) : end + 1])) == e


def test_query_finds_passages(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: letters(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in docs.items() for i, z in items.items() if str(z)[1:-1] in str(letters(t))}
    found = {(r.doc_id, r.item_id): r.edits for r in queries.op7_decontamination(spark, sf).collect()}
    assert exact and exact == {k for k, e in found.items() if e == 0}


def test_awkward_rows(spark, documents, awkward):
    text = "Which planet of the many is the largest of them all, by far?"
    docs = documents([*awkward, (20, f"so: {text.upper()}"), (21, text[:-8]), (20, f"so: {text.upper()}")])
    bench = spark.createDataFrame([(1, text), (2, None), (None, "abc " * 9), (3, text), (4, "")], "item_id bigint, text string")
    found = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in dec.find(docs, bench).collect())
    assert found == sorted(2 * [(20, 1, 4, 4 + len(text) - 1, 0), (20, 3, 4, 4 + len(text) - 1, 0)])
    clean = dec.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(awkward) + 1
    assert dec.find(docs.limit(0), bench).count() == 0 and dec.find(docs, bench.limit(0)).count() == 0
    assert dec.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_a_large_benchmark_goes_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(dec, "PART_LETTERS", 60)
    texts = [f"passage number {i} with some words of its own {i * 7919}" for i in range(9)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = documents([(1, texts[2] + " x " + texts[7]), (2, "nothing here")])
    assert sorted((r.doc_id, r.item_id) for r in dec.find(docs, bench).where("edits = 0").collect()) == [(1, 2), (1, 7)]
