import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["the", "don't", "I'll", "'v", "e'", " ", "  ", "\n", "\t ", "é", "12", "3", "!!", "?", "日本", "x", " a"]


@pytest.fixture(scope="module")
def counts():
    return token_counts.PieceCounts(RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("seed", range(4))
def test_edits_match_a_full_count(counts, seed):
    rng = random.Random(seed)
    for _ in range(80):
        text = "".join(rng.choices(PARTS, k=rng.choice([0, 3, 50, 400, 1500])))
        tree = token_counts.CountTree(text, counts)
        for _ in range(rng.randrange(1, 8)):
            a = rng.randrange(len(text) + 2)
            b = a + rng.choice([0, 0, 1, 3, 10, 200])
            new = "".join(rng.choices(PARTS, k=rng.choice([0, 0, 1, 2, 9, 600])))
            text = text[: min(a, len(text))] + new + text[min(b, len(text)) :]
            tree.edit(a, b, new)
            assert tree.text() == text and tree.n_letters == len(text)
            assert tree.n_tokens == len(counts.encoding.encode_ordinary(text))


def test_only_touched_parts_are_encoded(counts):
    tree = token_counts.CountTree("some plain words here " * 5000, counts)
    tree.edit(40_000, 40_003, "abc")
    assert tree.encoded < 10


def edited(text, edits):
    for start, end, new in edits:
        a = min(max(start or 0, 0), len(text))
        text = text[:a] + (new or "") + text[min(max(end or 0, a), len(text)) :]
    return text


def test_query_matches_brute_force(spark, sf, counts):
    docs = queries.derived_edits(spark.read.parquet(f"{sf}/documents.parquet"))
    expected = {}
    for r in docs.collect():
        after = edited(r.text, [(e.start, e.end, e.text) for e in r.edits])
        expected[r.doc_id] = (len(counts.encoding.encode_ordinary(r.text)), 3, len(counts.encoding.encode_ordinary(after)))
    found = {r.doc_id: (r.n_tokens, r.n_edits, r.n_tokens_after) for r in queries.op4_token_counts(spark, sf).collect()}
    assert found == expected


def test_awkward_rows(spark, documents, awkward, counts):
    docs = documents(awkward)
    edits = spark.createDataFrame(
        [(1, 1, 0, 0, "new"), (4, 2, 10, 5, "x"), (4, 1, None, 3, None), (5, 1, 299_999, 999_999, "é"), (77, 1, 0, 0, "nobody")],
        "doc_id bigint, seq int, start int, end int, text string",
    )
    rows = token_counts.recount(token_counts.with_edits(docs, edits), RANKS, public_tokenizers.PATTERN).collect()
    changes = {1: [(0, 0, "new")], 4: [(None, 3, None), (10, 5, "x")], 5: [(299_999, 999_999, "é")]}
    expected = sorted((str(d), len(counts.encoding.encode_ordinary(edited(t or "", changes.get(d, []))))) for d, t in awkward)
    assert sorted((str(r.doc_id), r.n_tokens_after) for r in rows) == expected
    plain = token_counts.recount(docs.withColumn("edits", F.lit(None).cast("array<struct<start:int,end:int,text:string>>")), RANKS, public_tokenizers.PATTERN)
    assert plain.where("n_tokens = n_tokens_after and n_edits = 0").count() == len(awkward)
