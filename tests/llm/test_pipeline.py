from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import CLASHING
from tidemark.llm import decontamination, jaccard, pii, queries

SF = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, [set(r.doc_id for r in docs.collect())]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns
        ids.append({r.doc_id for r in docs.collect()})
    # each stage goes by its operator, over all its predecessor kept
    good = {r.doc_id for r in queries.op8_quality(spark, SF).collect() if r.predicted}
    assert ids[1] == good
    second = spark.read.parquet(f"{tmp_path}/0")
    assert ids[2] == {r.class_id for r in jaccard.join(second).collect()}
    third = spark.read.parquet(f"{tmp_path}/1")
    leaks = {r.doc_id for r in decontamination.find(third, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaks and ids[3] == ids[2] - leaks
    assert ids[4] == ids[3] and docs.where("n_chars <> length(text)").count() == 0
    left = pii.find(docs).collect()
    assert not [s for r in left for s in r.spans if s.kind in pii.BASE]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    full = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {r.doc_id: len(full.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    held = {}
    for r in packed:
        held[r.doc_id] = held.get(r.doc_id, 0) + r.length
    assert held == total


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 800


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mixed(spark, awkward):
    """Given documents among awkward rows, nulls in every column and clashing names."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(*r[:2], None, None, None) for r in awkward], docs.schema)
    return docs.unionByName(odd).withColumns({k: F.lit(v) for k, v in CLASHING.items()}).cache()


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_awkward_rows_in_every_stage(spark, mixed):
    """Stages take nulls, empty, long and repeated texts and keep columns they do not use."""
    before = rows_of(mixed)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, mixed, SMALL)
        assert out.columns == mixed.columns, name
        if name != "PII":
            after = rows_of(out)
            assert not after - before, name
            if name != "quality classifier":
                # texts without shingles are like no other; of repeated rows one stays
                odd = {r: n for r, n in after.items() if r[2] is None and r[3] is None}
                repeats = 1 if name == "n-gram Jaccard join" else 2
                assert sum(odd.values()) == 8 + repeats and max(odd.values()) == repeats, name
        else:
            masked = out.select("doc_id", "text", "n_chars").collect()
            assert len(masked) == sum(before.values())
            assert Counter(r.doc_id for r in masked) == Counter(r[0] for r in before.elements())
            assert all((r.text is None and r.n_chars is None) or r.n_chars == len(r.text) for r in masked)
    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, SMALL).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in before.elements())
    assert {r.length for r in packed if r.doc_id in (1, 2, 8)} >= {1}


def test_no_documents(spark, mixed):
    """No stage needs a row."""
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, mixed.limit(0), SMALL).count() == 0, name
