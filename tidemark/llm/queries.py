"""One query per operator over its whole table, with DuckDB SQL where SQL can
express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import (
    alignment,
    ann,
    decontamination,
    jaccard,
    langid,
    negatives,
    packing,
    pii,
    quality,
    sharding,
    token_counts,
    topk,
    toxicity,
)
from tidemark.llm.common import fold, table
from tidemark.llm.vectors import finite, floored


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(docs: DataFrame) -> DataFrame:
    """Documents to packed pieces, ids replaced by their checksum."""
    pieces = packing.tokenize(docs, tokenizer_file(), checksum=True)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = (fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT_FOLD).alias("held_out")
    predicted = (F.col("score") >= toxicity.TOXIC_SCORE).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", predicted)


def derived_edits(docs: DataFrame) -> DataFrame:
    """Three edits of each text, taken from the text itself: twenty letters a
    third of the way in put in upper case, the first dozen copied to the middle, and
    fifteen letters removed two thirds of the way in."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)

    def edit(start: Column, end: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("text"))

    third, half = F.floor(n / 3), F.floor(n / 2)
    return docs.withColumn(
        "edits",
        F.array(
            edit(third, third + 20, F.upper(F.substr(text, third + 1, F.lit(20)))),
            edit(half, half, F.substr(text, F.lit(1), F.lit(12))),
            edit(2 * third, 2 * third + 15, F.lit("")),
        ),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = derived_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_counts.recount(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    held_out = (fold("doc_id", langid.FOLDS) == langid.HELD_OUT_FOLD).alias("held_out")
    return langid.predict(docs.drop("lang"), model).select("doc_id", held_out, "lang_pred", "score", "rejected")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs).drop("text")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    count = [of(k) for k in pii.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *count,
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    held_out = (fold("doc_id", quality.FOLDS) == quality.HELD_OUT_FOLD).alias("held_out")
    predicted = (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted")
    return quality.score(docs, model).select("doc_id", held_out, "score", predicted)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.select("vec_id", turned.cast("bigint").alias("label"), floored(F.col("embedding"), 256).alias("vector"))
    return negatives.mine(whole, F.col("vec_id") % 100 == 0)


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(topk.sparse(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ann": op2_ann,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_language_id": op5_language_id,
    "op6_pii": op6_pii,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_sharding": op10_sharding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_topk": op12_exact_topk,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

# op9: all pairs that share a shingle, and components by transitive closure.
# op11, op12: all scores, then windows over them.
ORACLES: dict[str, str] = {
    "op9_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL),
w AS (SELECT doc_id, text, coalesce(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+'), []) AS w FROM d),
s AS (SELECT doc_id, text, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c, any_value(a.n + b.n) AS n
      FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT i, j FROM p WHERE 10 * c >= 8 * (n - c)
      UNION ALL SELECT a.doc_id, b.doc_id FROM s a JOIN s b ON a.text = b.text AND a.doc_id <> b.doc_id WHERE len(a.s) = 0),
r AS (SELECT doc_id, doc_id AS root FROM s UNION SELECT l.j, r.root FROM r JOIN l ON l.i = r.doc_id),
k AS (SELECT i, count(*) AS n FROM l GROUP BY i)
SELECT doc_id, min(root) AS class_id, coalesce(any_value(k.n), 0) AS n_links FROM r LEFT JOIN k ON r.doc_id = k.i GROUP BY doc_id""",
    "op11_hard_negatives": r"""
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) <= 5""",
    "op12_exact_topk": r"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
}
