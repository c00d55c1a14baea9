"""Language of documents by averaged hashed subword embeddings.

A text is the mean of the embeddings of its words' byte n-grams, hashed into a
fixed number of buckets, under a linear softmax; embeddings and softmax are
trained together by stochastic gradient descent in numpy. As both layers are
linear, each distinct word of a slice is scored once and a text adds its words
up. A temperature and a rejection threshold are set on rows kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from tidemark.llm.common import bounded_batches, fold, text_bytes, with_text_columns

FOLDS, HELD_OUT_FOLD = 3, 1
UNDETERMINED = "und"
BUCKETS = 1 << 14
DIMENSION = 16
GRAMS = (1, 2, 3, 4)
# At most so many documents of each language are used to fit, and fewer where all
# languages together would exceed the second figure; no language is left out.
FIT_ROWS = 600
FIT_TOTAL = 120_000
EPOCHS = 6
RATE = 0.5
# Accepted predictions should be right this often on the rows kept apart.
PRECISION = 0.98

_LETTER = r"\p{L}"
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket -> score per language
    temperature: float = 1.0
    threshold: float = 0.0


def _grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of each word between marks, and their owners."""
    data, offsets = text_bytes(pc.binary_join_element_wise("<", words, ">", ""))
    owner = np.repeat(np.arange(len(words)), np.diff(offsets))
    value = data.astype(np.uint64)
    hashed, owners = [], []
    code = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = code[: len(data) - n + 1] * np.uint64(257) + value[n - 1 :] + np.uint64(1)
        inside = owner[: len(code)] == owner[n - 1 :]
        if n in GRAMS:
            mixed = (code + np.uint64(n)) * _PRIME
            hashed.append((mixed >> np.uint64(64 - 14)).astype(np.int64)[inside])
            owners.append(owner[: len(code)][inside])
    if not hashed:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(hashed), np.concatenate(owners)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case runs of letters, their index in each text, and the
    owner of each occurrence."""
    split = pc.ascii_split_whitespace(texts)
    raw = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    cleaned = pc.replace_substring_regex(pc.utf8_lower(raw.dictionary), r"[^\p{L}\p{M}]+", "").dictionary_encode()
    index = cleaned.indices.to_numpy(zero_copy_only=False)[raw.indices.to_numpy(zero_copy_only=False)]
    return cleaned.dictionary, index.astype(np.int64), owner


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text, the buckets of its n-grams and how often each occurs."""
    words, index, owner = _words(texts)
    bucket, of_word = _grams(words)
    sizes = np.bincount(of_word, minlength=len(words))
    starts = np.cumsum(sizes) - sizes
    bucket = bucket[np.argsort(of_word, kind="stable")]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    result = []
    for i in range(len(texts)):
        w, n = np.unique(index[cuts[i] : cuts[i + 1]], return_counts=True)
        take = np.repeat(starts[w] - (np.cumsum(sizes[w]) - sizes[w]), sizes[w]) + np.arange(sizes[w].sum())
        count = np.bincount(bucket[take], weights=np.repeat(n, sizes[w]), minlength=1) if len(w) else np.zeros(1)
        used = np.flatnonzero(count)
        result.append((used.astype(np.int32), count[used]))
    return result


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Mean score per language of each text's n-grams."""
    words, index, owner = _words(texts)
    bucket, of_word = _grams(words)
    n = len(texts)
    grams = np.bincount(of_word, minlength=len(words)).astype(float)
    count = np.maximum(np.bincount(owner, weights=grams[index], minlength=n), 1)
    columns = []
    for j in range(len(model.languages)):
        per_word = np.bincount(of_word, weights=model.table[bucket, j], minlength=len(words))
        columns.append(np.bincount(owner, weights=per_word[index], minlength=n) / count)
    return np.stack(columns, axis=1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, languages: list[str], seed: int = 5) -> Model:
    """Stochastic gradient descent over one document at a time."""
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
    softmax = np.zeros((DIMENSION, len(languages)))
    steps = EPOCHS * max(1, len(examples))
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            used, count = examples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(used):
                continue
            share = (count / count.sum())[:, None]
            hidden = (embedding[used] * share).sum(axis=0)
            gap = _softmax((hidden @ softmax)[None, :])[0]
            gap[y[i]] -= 1
            back = softmax @ gap
            softmax -= rate * np.outer(hidden, gap)
            # a mean spreads the step thinly; the buckets' number makes up for it
            embedding[used] -= rate * min(len(used), 200) * share * back
    return Model(languages, embedding @ softmax)


def calibrate(model: Model, logits: np.ndarray, y: np.ndarray) -> None:
    """Temperature of least log loss, then the lowest confidence from which on
    predictions reach the wanted precision."""
    if not len(y):
        return
    losses = {}
    for t in np.geomspace(0.02, 5, 40):
        p = _softmax(logits / t)[np.arange(len(y)), y]
        losses[t] = -np.log(np.maximum(p, 1e-12)).mean()
    model.temperature = float(min(losses, key=losses.get))
    p = _softmax(logits / model.temperature)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = np.cumsum((p.argmax(axis=1) == y)[order]) / np.arange(1, len(y) + 1)
    enough = np.flatnonzero(right >= PRECISION)
    model.threshold = float(p.max(axis=1)[order][enough[-1]]) if len(enough) else 1.0


def fit(docs: DataFrame, limit: int = FIT_ROWS, total: int = FIT_TOTAL) -> Model | None:
    """Learn every language from at most `limit` of its documents and about `total` of
    all, outside the held-out fold; None if there is no language to learn. Null texts,
    languages and ids teach nothing; repeated rows count as often as they come. The
    model holds a number for each language and bucket, 128 KB a language."""
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.coalesce(fold("doc_id", FOLDS) != HELD_OUT_FOLD, F.lit(False))
    )
    found = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row for each language
    if not found:
        return None
    limit = max(1, min(limit, total // len(found)))
    # about `limit` rows of each language by hash, then exactly at most that many
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, max(1.3 * limit, limit + 30) / r["count"])) for r in found], "lang string, _share double")
    luck = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) / 1_000_000
    sample = known.join(F.broadcast(shares), "lang").where(luck < F.col("_share")).drop("_share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                ((used, count),) = bags(one.column(0))
                yield pa.RecordBatch.from_arrays(
                    [one.column(1), one.column(2), pa.array([used.tolist()], pa.list_(pa.int32())),
                     pa.array([count.astype(np.float32).tolist()], pa.list_(pa.float32()))],
                    names=["lang", "doc_id", "used", "count"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        bounded_batches(sample)
        .select("text", "lang", "doc_id")
        .mapInArrow(run, f"lang string, doc_id {kind}, used array<int>, count array<float>")
        .toArrow()  # bounded: rows per language and buckets per row
    )
    languages = [r["lang"] for r in found]
    code = {l: i for i, l in enumerate(languages)}
    order = np.lexsort((np.array([str(x) for x in rows.column("doc_id").to_pylist()]), np.zeros(rows.num_rows)))
    lang = rows.column("lang").to_pylist()
    used, count = rows.column("used").to_pylist(), rows.column("count").to_pylist()
    taken: dict[str, int] = {}
    examples, y, apart = [], [], []
    for i in order:
        n = taken[lang[i]] = taken.get(lang[i], 0) + 1
        if n <= limit:
            examples.append((np.array(used[i], dtype=np.int64), np.array(count[i], dtype=float)))
            y.append(code[lang[i]])
            apart.append(n % 5 == 0)
    y, apart = np.array(y, dtype=int), np.array(apart, dtype=bool)
    model = train([e for e, a in zip(examples, apart) if not a], y[~apart], languages)
    logits = np.array(
        [(model.table[u] * (c / max(c.sum(), 1))[:, None]).sum(axis=0) for (u, c), a in zip(examples, apart) if a]
    ).reshape(-1, len(languages))
    calibrate(model, logits, y[apart])
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with lang_pred, score (calibrated confidence) and rejected.

    A null text or one without a letter is `und` with score 0 and rejected, as
    is every text without a model. Rows and other columns stay; columns with
    those three names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")

    def make():
        def run(texts: pa.Array) -> list:
            letters = pc.match_substring_regex(texts, _LETTER).to_numpy(zero_copy_only=False)
            if model is None:
                return [[UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)]
            p = _softmax(scores(texts, model) / model.temperature)
            best, sure = p.argmax(axis=1), np.where(letters, p.max(axis=1), 0.0)
            names = np.where(letters, np.array(model.languages, dtype=object)[best], UNDETERMINED)
            return [names.tolist(), sure, ~letters | (sure < model.threshold)]

        return run

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    return with_text_columns(docs, "text", fields, make)
