import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import langid, quality, queries, toxicity
from tidemark.llm.features import NAMES, statistics

SF = "/root/testdata/sf0.01"


def held(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_held_out(spark, labels):
    rows = queries.op8_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    right = [r.predicted == labels[r.doc_id].quality for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(right) > 0.93


def test_toxicity_held_out(spark, labels):
    rows = queries.op3_toxicity(spark, SF).collect()
    assert all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = [r.predicted == labels[r.doc_id].toxic for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(right) > 0.85


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op5_language_id(spark, SF).collect()
    assert all(r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows) and len(rows) == len(lang)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.97


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return quality.fit(docs, labels), toxicity.fit(docs, labels), langid.fit(docs)


def test_awkward_rows(spark, documents, awkward, models):
    docs = documents(awkward)
    for made in (quality.score(docs, models[0]), toxicity.score(docs, models[1])):
        assert sorted(made.columns) == sorted(docs.columns)  # score is replaced
        rows = made.collect()
        assert len(rows) == len(awkward) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 7}) == 1
    found = {r.doc_id: r for r in langid.predict(docs, models[2]).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 and found[i].rejected for i in (1, 2, 3, 8))
    assert found[9].lang_pred != "und"
    empty = docs.limit(0)
    assert quality.score(empty, models[0]).count() + toxicity.score(empty, models[1]).count() + langid.predict(empty, models[2]).count() == 0


def test_nothing_to_learn_from(spark, documents, awkward):
    docs = documents(awkward, lang=None)
    none = spark.createDataFrame([(1, 1, None)], "doc_id bigint, quality int, toxic int")
    assert quality.fit(docs, none) is None and toxicity.fit(docs, none) is None and langid.fit(docs) is None
    assert quality.keep_good(docs, None).count() == len(awkward)
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_statistics():
    table = statistics(pa.array(["Aa aa aa\nbb!", "", "ONE!! ONE!!", "é"]))
    one = dict(zip(NAMES, table[0]))
    assert table.shape == (4, len(NAMES)) and not table[1].any() and np.isfinite(table).all()
    assert np.isclose(one["distinct_words"], 3 / 4) and np.isclose(one["repeated_next"], 1 / 4) and np.isclose(one["upper"], 1 / 12)
    assert dict(zip(NAMES, table[2]))["upper_words"] == 1


def test_isotonic_matches_a_plain_solution():
    rng = np.random.default_rng(1)
    x = rng.normal(size=60)
    y = (x + rng.normal(size=60) > 0).astype(float)
    knots, values = quality.isotonic(x, y)
    s = y[np.argsort(x)]
    # max over starts of min over ends of means
    best = [max(min(s[a : b + 1].mean() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    fitted = np.concatenate([np.full(sum(np.isclose(best, v)), v) for v in sorted(set(np.round(best, 12)))])
    assert np.allclose(sorted(best), fitted) and np.allclose(sorted(set(np.round(best, 9))), np.round(values, 9))
    assert (np.diff(knots) >= 0).all()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = np.random.default_rng(2)
    terms = [toxicity.Term(t, s) for t, s in (("idiot", False), ("scum", False), ("worthless", False), ("lowei", True), ("words", False))]
    machine = toxicity.Automaton(terms)
    words = ["", "idiot", "idit", "idioot", "scun", "worthlss", "wrthlss", "loweiter", "lowe", "wxrds", "sword"]
    for t in terms:
        for _ in range(150):
            w = list(t.text)
            for _ in range(rng.integers(0, 4)):
                i = int(rng.integers(0, len(w) + 1))
                w[i : i + int(rng.integers(0, 2))] = list("abcdeforstwxé"[int(rng.integers(0, 13))] * int(rng.integers(0, 2)))
            words.append("".join(w) + ("x" if rng.random() < 0.2 else ""))
    found, edits = machine.run(words)
    for word, n, e in zip(words, found, edits):
        options = [(0, i) for i, t in enumerate(terms) if t.stem and word.startswith(t.text)]
        options += [(edit_distance(word, t.text), i) for i, t in enumerate(terms) if not t.stem and edit_distance(word, t.text) <= t.edits]
        assert (e, n) == (min(options) if options else (-1, -1))


def test_every_telling_term_is_kept(spark):
    names = ["".join(chr(97 + (i * k) % 26) for k in (1, 3, 5, 7)) + f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    ones = spark.createDataFrame([*((n + "$", 30) for n in names), ("rare$", 3), ("both$", 30), ("most$", 30)], "term string, docs bigint")
    zeros = spark.createDataFrame([("both$", 60), ("most$", 2), ("clean$", 9)], "term string, docs bigint")
    found = {r.term: r.docs for r in toxicity.telling(ones, zeros, 500, 5000).collect()}
    assert found == {**{n + "$": 30 for n in names}, "most$": 30}
    terms = toxicity.choose_terms(found)
    assert sorted(t.text for t in terms) == sorted([*names, "most"])
    lexicon = toxicity.Lexicon(terms)
    number, edits = lexicon.run([t.text for t in terms] + ["zzzzzzzzzz"])
    assert list(number) == [*range(len(terms)), -1] and set(edits[:-1]) == {0}


def test_automaton_reads_other_scripts():
    terms = [toxicity.Term("мерзавец", False), toxicity.Term("дурак", True), toxicity.Term("ηλίθιος", False), toxicity.Term("बेवकूफ", False)]
    words = ["мерзавец", "мерзовец", "мерзавц", "мерзовиц", "дураками", "дурка", "ηλίθιος", "ηλίθιο", "बेवकूफ", "слово", "idiot", "𠀀𠀁"]
    found, edits = toxicity.Automaton(terms).run(words)
    assert list(found) == [0, 0, 0, -1, 1, -1, 2, 2, 3, -1, -1, -1]
    assert list(edits) == [0, 1, 1, -1, 0, -1, 0, 1, 0, -1, -1, -1]
    assert list(toxicity.Automaton([]).run(["a", "д"])[0]) == [-1, -1]


def test_documents_that_share_a_word_count_apart(spark):
    def text(i, mark):
        return f"0 - aaaaa {mark} " + " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + j)}x" for j in range(30))

    rows = [(i, text(i, "badword" if i < 40 else "fine"), float(i < 40)) for i in range(120)]
    rows += [(200 + i, text(0, "badword") + f" more{i}", 1.0) for i in range(9)]  # near copies of one text
    classed = toxicity.with_class(spark.createDataFrame(rows, "hash bigint, text string, y double")).cache()
    assert classed.count() == len(rows) and classed.select("class").distinct().count() == 120
    docs = {r.term: r.docs for r in toxicity._counted(classed.where("y = 1"), None).collect()}
    assert docs["badword$"] == 40 and docs["aaaaa$"] == 40
    assert {r.term: r.docs for r in toxicity._counted(classed.where("y = 0"), frozenset(["aaaaa$"])).collect()} == {"aaaaa$": 80}
    split = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], int(r[2])) for r in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(split, labels)
    assert [t.text for t in model.automaton.terms] == ["badword"]


def test_quotation_weighs_less():
    machine = toxicity.Automaton([toxicity.Term("idiot", False)])
    texts = pa.array(["you are an idiot now", 'a sign read "silly idiot here" today', "he said idiot once", "", "an idioot", 'an idiot and "idiot"'])
    found = toxicity.hits(texts, machine)
    assert [f and next(iter(f.values())) for f in found] == [1.0, toxicity.QUOTED, toxicity.REPORTED, {}, 1.0, 1.0]
    assert list(found[4]) == [(0, 1, 1)]


def test_grams_stay_inside_words():
    words = pa.array(["ab", "é", ""])
    bucket, owner = langid._grams(words)
    for i in range(3):
        alone = langid._grams(words.slice(i, 1))[0]
        assert sorted(alone) == sorted(bucket[owner == i])
    model = langid.Model(["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)))
    texts = pa.array(["Some words, some MORE words!", "x", "äö"])
    for (used, count), s in zip(langid.bags(texts), langid.scores(texts, model)):
        assert np.allclose((model.table[used] * count[:, None]).sum(axis=0) / count.sum(), s)


def test_no_language_is_left_out(spark, documents):
    """More languages than once fitted in, the rarest of one document; samples shrink."""
    word = lambda i: chr(0x4E00 + i % 50) + chr(0x4F00 + i // 50)
    rows = [(i * 3 + j, " ".join([word(i)] * 6), f"l{i:03d}", "s") for i in range(250) for j in range(3 if i else 30)]
    docs = documents(rows)
    model = langid.fit(docs)
    assert len(model.languages) == len({r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1}) > 200
    assert set(langid.fit(docs, total=500).languages) == set(model.languages)
