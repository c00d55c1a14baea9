import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_ids_are_the_tokenizers(sf):
    import pyarrow.parquet as pq

    odd = ["", "  ", "it's I'M ß <|endoftext|>x", "İstanbul ΣΑΣ ǅ é 10,5%½ ﬁ x\x1cy\x0bz", 'don\'t?!?! "x"\'s _a_b ×÷ªµº', "日本語 ①", "a" * 5000]
    texts = pa.array(pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist() + odd)
    ids, offsets = packing.WordIds(PATH)(texts)
    full = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts.to_pylist()):
        assert full.encode(text, add_special_tokens=False).ids == ids[offsets[i] : offsets[i + 1]].tolist()


@pytest.mark.parametrize("n,top", [(1, 2048), (300, 2048), (5000, 2048), (4000, 40), (3000, 1)])
def test_plan_is_gapless_and_tight(n, top):
    rng = np.random.default_rng(n)
    lengths = np.minimum(top, np.maximum(1, rng.lognormal(np.log(top) * 0.8, 0.9, n).astype(int)))
    histogram = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)]))
    plan = packing.plan(histogram, top)
    held = defaultdict(list)
    for i, length in enumerate(plan["length"]):
        after = plan["rank"][i + 1] if i + 1 < len(plan["length"]) and plan["length"][i + 1] == length else histogram[length]
        for k in range(int(after - plan["rank"][i])):
            times = plan["times"][i]
            held[plan["sequence"][i] + k // times].append((plan["offset"][i] + k % times * length, length))
    assert sum(map(len, held.values())) == n
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(places, places[1:]))
        assert sum(b for _, b in places) <= top
    assert len(held) <= 1.02 * -(-lengths.sum() // top) + 2


def test_least_squares_nears_the_histogram():
    rng = np.random.default_rng(0)
    histogram = np.zeros(65, dtype=np.int64)
    histogram[1:] = rng.integers(50, 100, 64)
    columns = packing.patterns(np.arange(1, 65), 64)
    assert (columns.sum(axis=1) == 64).all() and len(np.unique(columns, axis=0)) == len(columns)
    x = packing.repeats(columns, histogram)
    used = np.bincount(columns.ravel(), weights=np.repeat(x, 3), minlength=65)
    assert (x >= 0).all() and np.abs(used - histogram)[1:].mean() < 0.2 * histogram[1:].mean()


def test_pack(spark, documents, awkward):
    docs = documents(awkward)
    rows = queries.packed(docs).collect()
    full = Tokenizer.from_file(PATH)
    expected = defaultdict(list)
    for doc_id, text in awkward:
        expected[doc_id].append([*full.encode(text or "", add_special_tokens=False).ids, 0])
    for doc_id, texts in expected.items():
        pieces = [ids[i : i + 2048] for ids in texts for i in range(0, len(ids), 2048)]
        found = [r for r in rows if r.doc_id == doc_id]
        crc = sorted(zlib.crc32(np.array(p, "<u4").tobytes()) for p in pieces)
        assert sorted(r.ids_crc32 for r in found) == crc
        assert all(r.start == 2048 * r.piece and 0 < r.length <= 2048 for r in found)
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for places in spans.values():
        places.sort()
        assert places[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(places, places[1:]))
    assert queries.packed(docs.limit(0)).count() == 0


def test_sequences_give_the_ids_back(spark, documents):
    random.seed(1)
    docs = documents([(i, " ".join(random.choices(["the", "of", "Straße", "x1"], k=random.randrange(40)))) for i in range(60)])
    pieces = packing.tokenize(docs, PATH, 32)
    packed = packing.pack(pieces, 32).persist()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
