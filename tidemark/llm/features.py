"""Document statistics, computed over whole texts with array operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import text_bytes

NAMES = (
    "log_words", "log_bytes", "word_bytes", "long_words", "upper", "digits", "symbols", "bars", "spaces", "high",
    "distinct_words", "repeated_next", "top_word", "symbol_ends", "upper_words", "log_lines", "distinct_lines",
    "line_words", "marks", "short_words",
)

_LOWER, _UPPER, _DIGIT, _SPACE, _MARK, _BAR, _SYMBOL, _HIGH = range(8)


def _classes() -> np.ndarray:
    kind = np.full(256, _SYMBOL, dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = _LOWER
    kind[ord("A") : ord("Z") + 1] = _UPPER
    kind[ord("0") : ord("9") + 1] = _DIGIT
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    kind[[ord(c) for c in ".,;:?!'\"-()"]] = _MARK
    kind[ord("|")] = _BAR
    kind[128:] = _HIGH
    return kind


_KINDS = _classes()


def _per_group(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the runs between offsets, 0 for empty runs."""
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _parts(split: pa.ListArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return split.flatten().dictionary_encode(), offsets - offsets[0]


def _distinct(index: np.ndarray, owner: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group, the number of distinct indexes and the count of the commonest."""
    if not len(index):
        return np.zeros(groups), np.zeros(groups)
    pair, count = np.unique(owner * (int(index.max()) + 1) + index, return_counts=True)
    group = pair // (int(index.max()) + 1)
    most = np.zeros(groups)
    np.maximum.at(most, group, count)
    return np.bincount(group, minlength=groups).astype(float), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text; an empty text has zeros."""
    n = len(texts)
    data, offsets = text_bytes(texts)
    kinds = _KINDS[data]
    size = np.diff(offsets).astype(float)
    share = [_per_group(kinds == k, offsets) / np.maximum(size, 1) for k in range(8)]

    words, word_offsets = _parts(pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts)))
    vocabulary = words.dictionary
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    v_bytes, v_offsets = text_bytes(vocabulary)
    v_kinds = _KINDS[v_bytes]
    v_size = np.diff(v_offsets)
    last = np.zeros(len(vocabulary), dtype=np.uint8)
    last[v_size > 0] = v_kinds[v_offsets[1:][v_size > 0] - 1]
    v_upper, v_lower = _per_group(v_kinds == _UPPER, v_offsets), _per_group(v_kinds == _LOWER, v_offsets)
    ends = (last == _BAR) | (last == _SYMBOL)
    flags = [v_size > 12, ends, (v_upper > 1) & (v_lower == 0), v_size <= 2]
    count = np.diff(word_offsets)
    owner = np.repeat(np.arange(n), count)
    words_n = np.maximum(count, 1).astype(float)
    same = np.zeros(len(index), dtype=bool)
    if len(index):
        same[1:] = (index[1:] == index[:-1]) & (owner[1:] == owner[:-1])
    distinct, top = _distinct(index, owner, n)
    of_words = [_per_group(f[index], word_offsets) / words_n for f in flags]

    lines, line_offsets = _parts(pc.split_pattern(texts, "\n"))
    line_index = lines.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_n = np.diff(line_offsets)
    line_distinct, _ = _distinct(line_index, np.repeat(np.arange(n), line_n), n)
    line_n = np.maximum(line_n, 1)

    columns = [
        np.log1p(count), np.log1p(size), _per_group(v_size[index], word_offsets) / words_n, of_words[0], share[_UPPER],
        share[_DIGIT], share[_SYMBOL], share[_BAR], share[_SPACE], share[_HIGH], distinct / words_n,
        _per_group(same, word_offsets) / words_n, top / words_n, of_words[1], of_words[2], np.log1p(line_n),
        line_distinct / line_n, np.log1p(count / line_n), share[_MARK], of_words[3],
    ]
    table = np.stack(columns, axis=1)
    table[size == 0] = 0
    return table
