"""Toxicity by a learned lexicon that also catches misspelled terms.

Terms (whole words, or stems with free endings) are learned from labelled
documents. Levenshtein automata run over the lexicon's trie: both together become
one deterministic automaton, which reads all distinct words of a slice a letter
at a time. Words around a hit decide how far it counts: in quotation marks or
beside words of reporting it weighs less than in plain text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField

from tidemark.llm import jaccard
from tidemark.llm.common import bounded_batches, saved, slices, with_text_columns
from tidemark.llm.quality import training_rows

FOLDS, HELD_OUT_FOLD = 5, 0
TOXIC_SCORE = 0.5
FIT_ROWS = 20_000  # labelled documents used to fit, at most
PART_TERMS = 200  # in one automaton; a larger lexicon takes several
STEM_LETTERS = range(4, 11)
LEAST_SHARE = 0.004  # of the toxic documents that a term must be in
LEAST_DOCS = 4
PRECISION = 0.8
# How unlikely a term's share of toxic documents must be by chance.
CHANCE = 1e-6
ONE_EDIT, TWO_EDITS = 5, 9  # letters from which a whole word may hold so many edits
WINDOW = 6
QUOTED, REPORTED = 0.4, 0.6
PRIOR = {0: 0.6, 1: 0.55, 2: 0.5}
PRIOR_ROWS = 2.0
MANY = 3

_MARKS = "\"'“”„‟«»‹›‘’`"
# Words of reporting in the languages at hand; fixed, not learned.
_REPORTING = frozenset("said says wrote writes quoted quote word term called sagte schrieb wort zitat dit écrit mot dijo escribió palabra".split())


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool

    @property
    def edits(self) -> int:
        if self.stem:
            return 0
        return 2 if len(self.text) >= TWO_EDITS else 1 if len(self.text) >= ONE_EDIT else 0


class Automaton:
    """Words within the allowed edits of a term, as one transition table.

    Subset construction over (trie node, edits made): a state holds the fewest
    edits with which each node is reached, and the stems already complete.
    """

    def __init__(self, terms: list[Term]):
        self.terms = terms
        children: list[dict[str, int]] = [{}]
        ends: list[list[int]] = [[]]
        allowed = [0]
        for number, term in enumerate(terms):
            node = 0
            allowed[0] = max(allowed[0], term.edits)
            for letter in term.text:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    ends.append([])
                    allowed.append(0)
                node = children[node][letter]
                allowed[node] = max(allowed[node], term.edits)
            ends[node].append(number)
        letters = sorted({c for t in terms for c in t.text})
        self.letters = {ord(c): i + 1 for i, c in enumerate(letters)}  # 0: any other

        def closed(found: dict[int, int]) -> dict[int, int]:
            todo = list(found)
            while todo:  # a letter of the term left out
                node = todo.pop()
                for child in children[node].values():
                    edits = found[node] + 1
                    if edits <= allowed[child] and edits < found.get(child, 99):
                        found[child] = edits
                        todo.append(child)
            return found

        def freeze(found: dict[int, int], stems: frozenset) -> tuple:
            done = stems | {n for node, e in found.items() for n in ends[node] if terms[n].stem and e == 0}
            return frozenset(found.items()), done

        start = freeze(closed({0: 0}), frozenset())
        numbers, table, accepts = {start: 0}, [], []
        queue = [start]
        for state in queue:
            found, stems = dict(state[0]), state[1]
            hits = [(e, n) for node, e in found.items() for n in ends[node] if not terms[n].stem and e <= terms[n].edits]
            hits += [(0, n) for n in stems]
            accepts.append(min(hits) if hits else (-1, -1))
            row = []
            for letter in ["", *letters]:
                new: dict[int, int] = {}
                for node, e in found.items():
                    if letter in children[node]:
                        child = children[node][letter]
                        new[child] = min(e, new.get(child, 99))
                    if e + 1 <= allowed[node]:  # a letter too many
                        new[node] = min(e + 1, new.get(node, 99))
                    for child in children[node].values():  # another letter
                        if e + 1 <= allowed[child]:
                            new[child] = min(e + 1, new.get(child, 99))
                to = freeze(closed(new), stems)
                if to not in numbers:
                    numbers[to] = len(numbers)
                    queue.append(to)
                row.append(numbers[to])
            table.append(row)
        self.table = np.array(table, dtype=np.int32)
        self.edits, self.term = (np.array(x, dtype=np.int32) for x in zip(*accepts))
        dead = freeze({}, frozenset())
        self.dead = numbers.get(dead, -1)

    def run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Term number and edits of each word, -1 where none matches."""
        state = np.zeros(len(words), dtype=np.int32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lookup = np.zeros(max(self.letters, default=0) + 1, dtype=np.int32)
        for code, number in self.letters.items():
            lookup[code] = number
        letters = np.where(codes < len(lookup), lookup[np.minimum(codes, len(lookup) - 1)], 0)
        starts = np.cumsum(lengths) - lengths
        live = np.flatnonzero(lengths > 0)
        place = 0
        while len(live):
            state[live] = self.table[state[live], letters[starts[live] + place]]
            place += 1
            live = live[(lengths[live] > place) & (state[live] != self.dead)]
        return self.term[state], self.edits[state]


class Lexicon:
    """Any number of terms: automata of PART_TERMS each, whose states would
    multiply in a single one. A word goes to the term with the fewest edits, the
    first of these."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.parts = [Automaton(terms[i : i + PART_TERMS]) for i in range(0, len(terms), PART_TERMS)]

    def run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Term number and edits of each word, -1 where none matches."""
        term, edits = np.full(len(words), -1, dtype=np.int32), np.full(len(words), -1, dtype=np.int32)
        for number, part in enumerate(self.parts):
            t, e = part.run(words)
            better = (t >= 0) & ((term < 0) | (e < edits))
            term[better], edits[better] = t[better] + number * PART_TERMS, e[better]
        return term, edits


@dataclass
class Model:
    """The automata are built once, on the driver, and travel as tables."""

    automaton: Lexicon
    base: float = 0.1  # of texts without a hit
    weights: dict[tuple[int, int, int], float] = field(default_factory=dict)


def _words(texts: pa.Array) -> tuple[pa.Array, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Raw words of all texts, distinct cleaned words, the index of each word in
    them, its text, and where each text begins."""
    split = pc.ascii_split_whitespace(texts)
    raw = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    cleaned = pc.replace_substring_regex(pc.utf8_lower(raw.dictionary), r"[^\p{L}\p{M}]+", "").dictionary_encode()
    index = cleaned.indices.to_numpy(zero_copy_only=False)[raw.indices.to_numpy(zero_copy_only=False)]
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    return raw, cleaned.dictionary.to_pylist(), index.astype(np.int64), owner, offsets


def _context(raw: pa.DictionaryArray, at: int, low: int, high: int) -> float:
    """How far a hit at word `at` counts, by the words between low and high."""
    near = [raw[i].as_py() for i in range(max(low, at - WINDOW), min(high, at + WINDOW + 1))]
    here = min(at - low, WINDOW)
    word = near[here]
    opened = word[:1] in _MARKS and word != ""
    closed = bool(word) and word.rstrip(".,;:!?")[-1:] in tuple(_MARKS)
    for w in reversed(near[:here]):
        if w.rstrip(".,;:!?")[-1:] in tuple(_MARKS):
            break
        opened = opened or (w[:1] in _MARKS and w != "")
    for w in near[here + 1 :]:
        if w[:1] in _MARKS and w:
            break
        closed = closed or (w.rstrip(".,;:!?")[-1:] in tuple(_MARKS))
    if opened and closed:
        return QUOTED
    before = {w.lower().strip(".,;:!?()" + _MARKS) for w in near[max(0, here - 3) : here]}
    return REPORTED if before & _REPORTING else 1.0


Hits = dict[tuple[int, int, int], float]


def hits(texts: pa.Array, automaton: Automaton | Lexicon) -> list[Hits]:
    """Per text, the terms found as (term, edits, distinct words up to MANY),
    each with its strongest context."""
    raw, distinct, index, owner, offsets = _words(texts)
    term, edits = automaton.run(distinct)
    found: list[dict[tuple[int, int], dict[int, float]]] = [{} for _ in range(len(texts))]
    for at in np.flatnonzero(term[index] >= 0) if len(index) else ():
        t, w = int(owner[at]), int(index[at])
        words = found[t].setdefault((int(term[w]), int(edits[w])), {})
        if words.get(w, 0.0) < 1.0:
            words[w] = max(words.get(w, 0.0), _context(raw, int(at), int(offsets[t]), int(offsets[t + 1])))
    return [{(*k, min(len(w), MANY)): max(w.values()) for k, w in f.items()} for f in found]


def _terms_of(words: list[str]) -> set[str]:
    """Stems, stems of two distinct words or more (#) and whole words ($)."""
    stems: dict[str, int] = {}
    for w in words:
        for n in STEM_LETTERS:
            if n < len(w):
                stems[w[:n]] = stems.get(w[:n], 0) + 1
    return {*stems, *(s + "#" for s, n in stems.items() if n > 1), *(w + "$" for w in words)}


def _names(part: pa.RecordBatch) -> Iterator[set[str]]:
    """The terms of each text, as `_terms_of` names them."""
    _, distinct, index, owner, _ = _words(pc.fill_null(part.column(0), ""))
    cuts = np.searchsorted(owner, np.arange(len(part) + 1))
    for i in range(len(part)):
        words = np.unique(index[cuts[i] : cuts[i + 1]])
        yield _terms_of([distinct[w] for w in words if 4 <= len(distinct[w]) <= 40])


def with_class(rows: DataFrame) -> DataFrame:
    """`rows` of text, y and hash with class: the same number for copies and near
    copies of one text, as the Jaccard join finds them by their whole shingle sets."""
    rows = rows.withColumn("_unit", F.xxhash64("hash", "text"))
    classes = jaccard.join(rows.select(F.col("_unit").alias("doc_id"), "text"))
    return rows.join(classes.select(F.col("doc_id").alias("_unit"), F.col("class_id").alias("class")).distinct(), "_unit").drop("_unit")


def _counted(rows: DataFrame, wanted: frozenset[str] | None = None) -> DataFrame:
    """term, docs: how many documents hold a term, copies and near copies of one
    counted once. Their words all go together and would look like marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                part = batch.slice(start, stop - start)
                found = {
                    (t, key)
                    for held, key in zip(_names(part), part.column(1).to_pylist())
                    for t in (held if wanted is None else held & wanted)
                }
                terms, keys = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(keys, pa.int64())], names=["term", "class"])

    pairs = rows.select("text", "class").mapInArrow(run, "term string, class bigint").distinct()
    return pairs.groupBy("term").agg(F.count("*").alias("docs"))


def telling(ones: DataFrame, zeros: DataFrame, toxic: int, clean: int) -> DataFrame:
    """term, docs: the toxic documents of each term that marks such documents, from
    the (term, docs) of both labels."""
    base = toxic / (toxic + clean)
    one, none = F.col("docs"), F.coalesce("_none", F.lit(0))
    share = one / (one + none)
    # Chernoff's bound on finding such a share among so many documents
    rest = F.when(none > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    gain = (one + none) * (share * F.log(share / base) + rest)
    return (
        ones.where(one >= max(LEAST_DOCS, LEAST_SHARE * toxic))
        .join(zeros.select("term", F.col("docs").alias("_none")), "term", "left")
        .where((share >= PRECISION) & (share > base) & (gain >= float(-np.log(CHANCE))))
        .select("term", "docs")
    )


def choose_terms(counts: dict[str, int]) -> list[Term]:
    """Of nested terms the longest that still covers the shorter one's documents,
    as a whole word where it is one."""
    # a stem counts through one word or, if only that tells, through several
    most: dict[str, int] = {}
    for t in counts:
        name = t.rstrip("#")
        most[name] = max(most.get(name, 0), counts[t])
    roots: set[str] = set()
    chosen: list[tuple[int, Term]] = []
    by_name = sorted(most)
    for t in sorted(most, key=lambda t: (len(t), t)):
        if any(t[:n] in roots for n in range(1, len(t) + 1)):
            continue
        roots.add(t.rstrip("$"))
        longest = t
        for q in by_name[bisect_left(by_name, t) :]:
            if not q.startswith(t):
                break
            if most[q] >= 0.9 * most[t] and len(q) > len(longest):
                longest = q
        chosen.append((most[t], Term(longest.rstrip("$"), not longest.endswith("$"))))
    chosen.sort(key=lambda c: (-c[0], c[1].text))
    return [t for _, t in chosen]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = FIT_ROWS) -> Model | None:
    """The model, or None if there are no toxic or no clean labelled documents."""
    rows = saved(training_rows(bounded_batches(docs), labels, label, FOLDS, HELD_OUT_FOLD, limit).select("text", "y", "hash"))
    # terms are chosen on one part and weighed on the other, so that chance finds lose
    apart = F.pmod("hash", F.lit(5)) < 2
    choosing = saved(with_class(rows.where(~apart)).select("text", "y", "class"))
    weighing = rows.where(apart).select("text", "y")
    classes = {r["y"]: r["n"] for r in choosing.groupBy("y").agg(F.count_distinct("class").alias("n")).collect()}  # two rows
    toxic, clean = classes.get(1.0, 0), classes.get(0.0, 0)
    if not toxic or not clean:
        return None
    ones = saved(_counted(choosing.where("y = 1")).where(F.col("docs") >= max(LEAST_DOCS, LEAST_SHARE * toxic)))
    # a filter for the clean side: as each is in LEAST_SHARE of the toxic texts, no
    # more than the terms of 1 / LEAST_SHARE mean texts, whatever the rows
    wanted = frozenset(r["term"] for r in ones.select("term").collect())
    found = telling(ones, _counted(choosing.where("y = 0"), wanted), toxic, clean).collect()  # terms that pass
    model = Model(Lexicon(choose_terms({r["term"]: r["docs"] for r in found})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for start, stop in slices(batch.column(0)):
                part = batch.slice(start, stop - start)
                y = part.column(1).to_numpy(zero_copy_only=False)
                for i, found in enumerate(hits(pc.fill_null(part.column(0), ""), model.automaton)):
                    keys += [(*k, float(y[i])) for k in found] or [(-1, -1, -1, float(y[i]))]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)), pa.array([k[3] for k in keys], pa.float64())],
                names=["term", "edits", "words", "y"],
            )

    seen = (
        weighing.mapInArrow(run, "term int, edits int, words int, y double")
        .groupBy("term", "edits", "words", "y")
        .count()
        .collect()  # a few rows per term
    )
    table: dict[tuple[int, int, int], list[int]] = {}
    for r in seen:
        table.setdefault((r["term"], r["edits"], r["words"]), [0, 0])[int(r["y"])] += r["count"]
    zero, one = table.pop((-1, -1, -1), [0, 0])
    model.base = min(0.4, one / (zero + one)) if zero + one else 0.1
    for key, (zero, one) in table.items():
        model.weights[key] = (one + PRIOR[key[1]] * PRIOR_ROWS) / (zero + one + PRIOR_ROWS)
    return model


def score(docs: DataFrame, model: Model | None, out: str = "score") -> DataFrame:
    """`docs` with the probability that a text is toxic: the chance that at least
    one of its distinct hits counts. Null and empty texts have no hit and get the
    base rate; without a model every score is 0. Rows and other columns stay; a
    column named `out` is replaced."""
    docs = docs.drop(out)

    def make():
        if model is None:
            return lambda texts: [np.zeros(len(texts))]

        def run(texts: pa.Array) -> list:
            result = np.empty(len(texts))
            for i, found in enumerate(hits(texts, model.automaton)):
                left = 1.0 - model.base
                for key, context in found.items():
                    left *= 1.0 - context * model.weights.get(key, PRIOR[key[1]])
                result[i] = 1.0 - left
            return [result]

        return run

    return with_text_columns(docs, "text", [StructField(out, DoubleType())], make)
