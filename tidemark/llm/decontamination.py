"""Benchmark passages inside documents, with edits.

The q-gram lemma: where a passage of m letters occurs with at most k edits, at
least m - q + 1 - k q of its q-grams occur near one diagonal. Q-grams that
documents share with the benchmark are counted in overlapping diagonal bands;
bands that reach the bound are verified by banded alignment. Nothing that the
lemma could hold is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemark.llm.common import free_name, per_worker, with_text_columns

Q = 12
EDIT_RATE = 0.06
# Benchmark letters that go to every executor at once; a larger benchmark is
# gone through in parts.
PART_LETTERS = 8 << 20
FILTER_BITS = 22
HITS_AT_ONCE = 1 << 20
# A letter takes some eighty bytes while its q-grams are made.
SLICE_BYTES = 1 << 20

_GAP, _END = np.uint32(32), np.uint32(1)
_LOW = 0x3000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Letters and digits in lower case, 0 for what only separates."""
    table = np.zeros(_LOW, dtype=np.uint32)
    for code in range(_LOW):
        c = chr(code)
        if c.isalnum():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row as letters in lower case with one gap for any run of
    other characters; the place of each in its text; where each text begins. A
    mark stands after each text."""
    table = per_worker("letters", _letters)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    codes = np.frombuffer("\x01".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    low = np.where(codes < _LOW, table[np.minimum(codes, _LOW - 1)], codes)
    keep = low != 0
    keep[1:] |= keep[:-1]
    keep[ends - 1] = True
    out = np.where(low == 0, _GAP, low)
    out[ends - 1] = _END
    at = np.flatnonzero(keep)
    begin = np.searchsorted(at, starts)
    place = at - np.repeat(starts, np.diff(np.append(begin, len(at))))
    return out[at], place, begin


def grams(letters: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q letters from each place on."""
    x = letters.astype(np.uint64) + np.uint64(7)
    if len(x) < Q:
        return x[:0]
    power = [np.uint64(pow(int(_BASE), n, 1 << 64)) for n in range(5)]
    two = x[:-1] * power[1] + x[1:]
    four = two[:-2] * power[2] + two[2:]
    eight = four[:-4] * power[4] + four[4:]
    rolled = eight[: len(x) - Q + 1] * power[4] + four[8 : 8 + len(x) - Q + 1]
    return (rolled ^ (rolled >> np.uint64(29))) * _BASE


def budget(letters: int) -> int:
    """Edits allowed in a passage: a share of its letters, and few enough that
    the lemma's bound is at least one."""
    return max(0, min(int(EDIT_RATE * letters), (letters - Q) // Q))


@dataclass
class Passages:
    """Benchmark passages and their q-grams, sorted by hash."""

    ids: list
    letters: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray


def passages(ids: list, texts: list[str]) -> Passages:
    kept_ids, kept, hashes, item, place = [], [], [], [], []
    for i, text in zip(ids, texts):
        z, _, _ = normalised([text])
        z = z[:-1]
        if len(z) and z[0] == _GAP:
            z = z[1:]
        if len(z) and z[-1] == _GAP:
            z = z[:-1]
        if len(z) < Q:
            continue
        h = grams(z)
        hashes.append(h)
        item.append(np.full(len(h), len(kept)))
        place.append(np.arange(len(h)))
        kept.append(z)
        kept_ids.append(i)
    none = np.empty(0, np.int64)
    h = np.concatenate(hashes) if hashes else none.astype(np.uint64)
    order = np.argsort(h, kind="stable")
    seen = np.zeros(1 << FILTER_BITS, dtype=bool)
    seen[h >> np.uint64(64 - FILTER_BITS)] = True
    return Passages(kept_ids, kept, h[order], *(np.concatenate(x)[order] if x else none for x in (item, place)), seen)


def _bands(p: Passages, z: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(text, item, band) of the bands that hold enough q-grams. Band b of an item
    with k edits covers diagonals b (k + 1) to (b + 2) (k + 1)."""
    h = grams(z)
    at = np.flatnonzero(p.filter[h >> np.uint64(64 - FILTER_BITS)])
    left = np.searchsorted(p.hashes, h[at], side="left")
    many = np.searchsorted(p.hashes, h[at], side="right") - left
    at, left, many = at[many > 0], left[many > 0], many[many > 0]
    size = np.array([len(x) for x in p.letters])
    width = np.array([budget(n) + 1 for n in size])
    need = size - Q + 1 - (width - 1) * Q
    found: dict[tuple[int, int, int], int] = {}
    cuts = np.cumsum(many) // HITS_AT_ONCE
    for start, stop in zip(np.searchsorted(cuts, np.unique(cuts)), [*np.searchsorted(cuts, np.unique(cuts))[1:], len(at)]):
        a, l, m = at[start:stop], left[start:stop], many[start:stop]
        hit = np.repeat(l - (np.cumsum(m) - m), m) + np.arange(m.sum())
        item = p.item[hit]
        where = np.repeat(a, m)
        band = (where - p.place[hit]) // width[item]
        text = np.searchsorted(begin, where, side="right") - 1
        # a place and an offset of at most the whole slice: all fits one number
        keys = np.stack([np.concatenate([text, text]), np.concatenate([item, item]), np.concatenate([band, band - 1])])
        keys = keys[:, np.lexsort(keys[::-1])]
        new = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if keys.shape[1] else []
        counts = np.diff(np.append(new, keys.shape[1]))
        if len(np.unique(cuts)) == 1:
            enough = counts >= need[keys[1, new]] if len(new) else []
            return keys[:, new[enough]].T if len(new) else np.empty((0, 3), np.int64)
        for k, n in zip(keys[:, new].T.tolist(), counts.tolist()):
            found[tuple(k)] = found.get(tuple(k), 0) + n
    return np.array(sorted(k for k, n in found.items() if n >= need[k[1]]), dtype=np.int64).reshape(-1, 3)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """Least edits between `item` and any part of `text` whose path stays on the
    diagonals low to high (text place less item place), as (edits, start, end); the
    earliest end, then the latest start, of the least. None beyond `most` edits."""
    width = high - low + 1
    far = np.int64(1 << 40)
    column = np.arange(width)
    # edits and start travel as one number, so that the least edits win
    place = low + column
    cost = np.where((place >= 0) & (place <= len(text)), len(text) - place, far)
    unit = np.int64(1 << 20) if len(text) < 1 << 20 else np.int64(1 << 32)
    for i, letter in enumerate(item):
        t = i + low + column  # text letter taken on the diagonal
        inside = (t >= 0) & (t < len(text))
        same = np.zeros(width, dtype=bool)
        same[inside] = text[t[inside]] == letter
        across = np.where(inside, cost + np.where(same, 0, unit), far)
        skip = np.append(cost[1:], far) + unit  # an item letter that the text lacks
        skip = np.where((t + 1 >= 0) & (t < len(text) + 0) | (t + 1 <= len(text)) & (t + 1 >= 0), skip, far)
        best = np.minimum(across, skip)
        # letters of the text that the item lacks
        run = np.minimum.accumulate(best - column * unit) + column * unit
        cost = np.where((t + 1 >= 0) & (t + 1 <= len(text)), np.minimum(best, run), far)
    edits = cost // unit
    b = int(edits.argmin())
    if edits[b] > most:
        return None
    return int(edits[b]), len(text) - int(cost[b] % unit), len(item) + low + b


def matches(p: Passages, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """Per text, (item, start, end, edits) of the best place of each passage it
    holds: fewest edits, then the earliest. Places are code points."""
    z, place, begin = normalised(texts)
    ends = np.append(begin[1:], len(z)) - 1  # without the mark
    best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    for text, item, band in _bands(p, z, begin).tolist():
        letters = p.letters[item]
        k = budget(len(letters))
        now = best[text].get(item)
        if now and now[0] == 0:
            continue
        low, high = band * (k + 1) - k, (band + 2) * (k + 1) - 1 + k
        first, last = max(int(begin[text]), low), min(int(ends[text]), high + len(letters))
        part = z[first:last]
        raw, goal = part.tobytes(), letters.tobytes()
        exact = raw.find(goal)
        while exact > 0 and exact % 4:
            exact = raw.find(goal, exact + 1)
        if exact >= 0:
            found = (0, exact // 4, exact // 4 + len(letters))
        else:
            found = align(letters, part, low - first, high - first, k)
        if found and found[2] > found[1]:
            edits, s, e = found
            span = (edits, int(place[first + s]), int(place[first + e - 1]) + 1)
            if now is None or span < now:
                best[text][item] = span
    return [sorted((i, s, e, d) for i, (d, s, e) in b.items()) for b in best]


def with_matches(docs: DataFrame, benchmark: DataFrame, out: str = "matches") -> DataFrame:
    """`docs` with an array of (item_id, start, end, edits), one for each passage
    that the text holds, by item order of the benchmark.

    A passage occurs where its letters and digits, in lower case, occur with at
    most `budget` edits. Null texts hold nothing; passages that are null or have
    fewer than Q letters take no part; passages that repeat each count. Rows and
    other columns stay; a column named `out` is replaced. No shuffle.
    """
    known = benchmark.select("item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // PART_LETTERS) or 1
    span = StructType(
        [StructField("item_id", benchmark.schema["item_id"].dataType)]
        + [StructField(n, IntegerType()) for n in ("start", "end", "edits")]
    )
    docs = docs.drop(out)
    found = docs
    columns = []
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(ArrayType(span))
    for part in range(parts):
        # a part holds about PART_LETTERS letters
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        p = passages([r["item_id"] for r in rows], [r["text"] for r in rows])
        name = free_name(found, f"_matches_{part}")
        columns.append(name)

        def make(p=p):
            def run(texts: pa.Array) -> list:
                keys = ("item_id", "start", "end", "edits")
                return [
                    pa.array([[dict(zip(keys, (p.ids[m[0]], *m[1:]))) for m in found] for found in matches(p, texts.to_pylist())], kind)
                ]

            return run

        found = with_text_columns(found, "text", [StructField(name, ArrayType(span))], make, SLICE_BYTES)
    return found.withColumn(out, F.concat(*columns)).drop(*columns)


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits of each passage in each document; clean
    documents give no rows."""
    found = with_matches(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no passage of the benchmark."""
    name = free_name(docs, "_found")
    return with_matches(docs, benchmark, name).where(F.size(name) == 0).drop(name)
