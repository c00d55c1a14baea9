"""Word shingles of texts as sorted 64-bit hashes, with array operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import text_bytes

WORDS = 5
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base)]).astype(np.uint64).cumprod(dtype=np.uint64)[:n]


def _hash_each(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes and length."""
    data, offsets = text_bytes(strings)
    size = np.diff(offsets)
    power = _powers(_M1, int(size.max()) if len(size) else 0)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    terms = (data.astype(np.uint64) + np.uint64(1)) * power[place]
    upto = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    return mixed(upto[offsets[1:]] - upto[offsets[:-1]] + size.astype(np.uint64) * _M3)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-case words (runs of letters, digits and _) in a row,
    and the n + 1 offsets of the texts in them."""
    split = pc.ascii_split_whitespace(texts)
    raw = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    spaced = pc.replace_substring_regex(pc.utf8_lower(raw.dictionary), r"[^\p{L}\p{M}\p{N}_]+", " ")
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
    words = parts.flatten().dictionary_encode()
    empty = pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)
    hashed = _hash_each(words.dictionary)
    index = words.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(raw.dictionary)), np.diff(parts.offsets.to_numpy(zero_copy_only=False)))
    real = ~empty[index]
    of_raw, owner = hashed[index][real], owner[real]
    count = np.bincount(owner, minlength=len(raw.dictionary))
    start = np.cumsum(count) - count
    raw_index = raw.indices.to_numpy(zero_copy_only=False)
    sizes = count[raw_index]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    flat = of_raw[np.repeat(start[raw_index] - (ends - sizes), sizes) + np.arange(total)]
    return flat, np.concatenate([[0], ends]).astype(np.int64)[offsets]


def shingle_sets(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, in a row, and their offsets.

    A text of fewer than `n` words has one shingle of all its words; a text
    without words has none.
    """
    words, offsets = word_hashes(texts)
    count = np.diff(offsets)
    power = _powers(_M1 ^ _M2 | np.uint64(1), n)
    rolled = np.zeros(len(words), dtype=np.uint64)
    for j in range(n):
        end = len(words) - j
        if end > 0:
            rolled[:end] += words[j:] * power[j]
    owner = np.repeat(np.arange(len(texts)), count)
    full = np.arange(len(words)) + n <= np.repeat(offsets[1:], count)
    shingles, owner = rolled[full], owner[full]
    for i in np.flatnonzero((count > 0) & (count < n)):  # short texts
        own = words[offsets[i] : offsets[i + 1]]
        with np.errstate(over="ignore"):
            one = (own * power[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
        shingles, owner = np.append(shingles, one), np.append(owner, i)
    shingles = mixed(shingles)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[new], owner[new]
    return shingles, np.searchsorted(owner, np.arange(len(texts) + 1))
