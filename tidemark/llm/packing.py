"""Best-fit packing of tokenized documents by patterns of few lengths.

The histogram of piece lengths is small whatever the corpus: one entry per
length up to the sequence length. Patterns of at most three lengths that fill a
sequence are enumerated, non-negative least squares fits how often to repeat
each, the counts are rounded and clipped to the histogram, and what is left is
packed best-fit, longest first, also on the histogram. The outcome is a plan: for
each length, which ranks go to which sequence and offset. Rows only look their
rank up in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import MOST_BATCH_BYTES, bounded_batches, gapless_rank, per_worker, saved, slices

SEQUENCE_TOKENS = 2048
SEPARATOR_ID = 0
NNLS_STEPS = 150
# Word pieces that the tokenizer reads as one string.
PIECES_AT_ONCE = 2000
# Word pieces whose ids one worker remembers: so many of late, as many before them.
CACHE_PIECES = 50_000

# Printable ASCII and Latin-1 letters: here lower case, normal form and the
# letter class are the same for the tokenizer and for Arrow.
_PLAIN = r"^[!-~À-ÖØ-öø-ÿ]+$"
# The tokenizer's own split, limited to those characters.
_PIECES = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `flat` that begin at `starts`, in a row, and their ends."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)], ends


class WordIds:
    """Token ids of whole texts, word by word.

    The tokenizer never merges across white space, so a text's ids are its
    words' ids in a row. Distinct words of a slice are split into pieces, and each
    distinct piece is encoded once, if the worker does not remember it. Pieces go to
    the tokenizer many at a time, a line each; a token that ends a word ends its
    piece.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        # For pieces that are already lower case and split.
        self.inner = Tokenizer.from_file(path)
        self.inner.normalizer = None
        self.inner.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.inner.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.late: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        lines = ["\n".join(pieces[i : i + PIECES_AT_ONCE]) for i in range(0, len(pieces), PIECES_AT_ONCE)]
        ids = [np.array(e.ids, dtype="<u4") for e in self.inner.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        if len(ends) != len(pieces):
            raise ValueError("the tokenizer does not end each word with a token of its own")
        raw, cuts = flat.tobytes(), (ends * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.late) > CACHE_PIECES:
            self.before, self.late = self.late, {}
        late, before = self.late, self.before
        runs = [late.get(p) or before.get(p) for p in pieces]
        new = [i for i, run in enumerate(runs) if run is None]
        for i, run in zip(new, self._encoded([pieces[i] for i in new])):
            runs[i] = run
        late.update(zip(pieces, runs))
        return runs

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and how many each has."""
        plain = pc.and_(pc.match_substring_regex(words, _PLAIN), pc.invert(pc.match_substring(words, "<|")))
        plain = plain.to_numpy(zero_copy_only=False)
        lower = pc.utf8_lower(words.filter(pa.array(plain)))
        split = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(pc.replace_substring_regex(lower, _PIECES, r"\1 ")))
        pieces = split.flatten().dictionary_encode()
        raw = self._piece_ids(pieces.dictionary.to_pylist())
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
        index = pieces.indices.to_numpy(zero_copy_only=False)
        flat, ends = _gather(np.frombuffer(b"".join(raw), dtype="<u4"), (np.cumsum(lengths) - lengths)[index], lengths[index])
        cuts = np.concatenate([[0], ends])[np.diff(split.offsets.to_numpy(zero_copy_only=False)).cumsum()]
        other = [e.ids for e in self.full.encode_batch_fast(words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)]
        counts = np.empty(len(words), dtype=np.int64)
        counts[plain] = np.diff(cuts, prepend=0)
        counts[~plain] = [len(i) for i in other]
        starts = np.empty(len(words), dtype=np.int64)
        starts[plain] = np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts
        starts[~plain] = len(flat) + np.cumsum(counts[~plain]) - counts[~plain]
        flat = np.concatenate([flat, np.array([i for ids in other for i in ids], dtype="<u4")])
        return _gather(flat, starts, counts)[0], counts

    def __call__(self, texts: pa.Array, after: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the n + 1 offsets of the texts in them; `after`
        is an id that follows each text."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        flat, lengths = self._word_ids(words.dictionary)
        index = words.indices.to_numpy(zero_copy_only=False)
        word_offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        word_offsets -= word_offsets[0]
        if after is not None:
            index = np.insert(index, word_offsets[1:], len(lengths))
            word_offsets += np.arange(len(word_offsets))
            flat, lengths = np.append(flat, np.array([after], "<u4")), np.append(lengths, 1)
        ids, ends = _gather(flat, (np.cumsum(lengths) - lengths)[index], lengths[index])
        return ids, np.concatenate([[0], ends])[word_offsets]


def tokenize(docs: DataFrame, tokenizer: str, sequence_tokens: int = SEQUENCE_TOKENS, checksum: bool = False) -> DataFrame:
    """Pieces of at most `sequence_tokens` ids: doc_id, piece, start, length and
    ids as little-endian unsigned 32-bit numbers, or `ids_crc32`, their checksum,
    in place of them.

    A null text counts as empty: its one piece is the separator alone. Rows that
    repeat each give their own pieces; a null doc_id stays null. An empty table
    gives no pieces. Other columns than doc_id and text are left aside.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(("word ids", tokenizer), lambda: WordIds(tokenizer))
        for batch in batches:
            for begin, stop in slices(batch.column(1), MOST_BATCH_BYTES):
                part = batch.slice(begin, stop - begin)
                ids, offsets = encode(pc.fill_null(part.column(1), ""), SEPARATOR_ID)
                n = len(part)
                sizes = np.diff(offsets)
                pieces = -(-sizes // sequence_tokens)
                doc = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * sequence_tokens
                length = np.minimum(sizes[doc] - start, sequence_tokens)
                cuts = np.concatenate([[0], np.cumsum(length)]) * 4
                raw = ids.astype("<u4", copy=False).tobytes()
                if checksum:
                    view, ends = memoryview(raw), cuts.tolist()
                    last = pa.array([zlib.crc32(view[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())
                else:
                    buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)]
                    last = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), buffers).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        last,
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32" if checksum else "ids"],
                )
            pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, {'ids_crc32 bigint' if checksum else 'ids binary'}"
    )


def patterns(lengths: np.ndarray, total: int) -> np.ndarray:
    """Rows of three lengths in falling order, 0 for none, that add up to `total`.

    At most total squared / 12 rows.
    """
    present = np.zeros(total + 1, dtype=bool)
    present[lengths] = True
    present[0] = True
    found = []
    for a in sorted(set(int(x) for x in lengths), reverse=True):
        rest = total - a
        b = np.arange(-(-rest // 2), min(a, rest) + 1)
        b = b[present[b] & present[rest - b]]
        if len(b):
            found.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)


def repeats(columns: np.ndarray, histogram: np.ndarray, steps: int = NNLS_STEPS) -> np.ndarray:
    """Non-negative least squares: how often to use each pattern so that the
    lengths used come near the histogram. Accelerated projected gradient over
    the three entries of each column."""
    size = len(histogram)
    used = columns.ravel()
    rows = np.bincount(used, minlength=size)
    rows[0] = 0
    bound = 3.0 * max(1, int(rows.max()))
    target = histogram.astype(float).copy()
    target[0] = 0
    x = np.zeros(len(columns))
    y, t = x, 1.0
    for _ in range(steps):
        fit = np.bincount(used, weights=np.repeat(y, 3), minlength=size)
        gap = fit - target
        gap[0] = 0
        new = np.maximum(0.0, y - gap[columns].sum(axis=1) / bound)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def _rounded(columns: np.ndarray, x: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whole counts that keep the running total, then clipped so that no length
    is used more often than it occurs. Changes `left`."""
    whole = np.diff(np.floor(np.concatenate([[0.0], np.cumsum(x)]) + 1e-9)).astype(np.int64)
    for i in np.argsort(-whole, kind="stable"):
        n = int(whole[i])
        if n == 0:
            break
        lengths, times = np.unique(columns[i][columns[i] > 0], return_counts=True)
        n = int(min(n, (left[lengths] // times).min()))
        left[lengths] -= n * times
        whole[i] = n
    return whole


def _best_fit(left: np.ndarray, total: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over the histogram: groups of equal sequences, each
    as (how many, [(length, times), ...])."""
    open_groups: dict[int, list[list]] = {}
    spaces = np.zeros(total + 1, dtype=bool)

    def put(space: int, group: list) -> None:
        open_groups.setdefault(space, []).append(group)
        spaces[space] = True

    for length in range(total, 0, -1):
        count = int(left[length])
        while count:
            fitting = np.flatnonzero(spaces[length:])
            space = length + int(fitting[0]) if len(fitting) else total
            if len(fitting):
                group = open_groups[space].pop()
                if not open_groups[space]:
                    spaces[space] = False
            else:
                group = [-(-count // (total // length)), []]
            many, runs = group
            each = space // length
            full = min(many, count // each)
            if full:
                put(space - each * length, [full, [*runs, (length, each)]])
                count -= full * each
                many -= full
            if many and count and count < each:
                put(space - count * length, [1, [*runs, (length, count)]])
                count = 0
                many -= 1
            if many and runs:
                put(space, [many, runs])
    return [(many, runs) for groups in open_groups.values() for many, runs in groups if runs]


def plan(histogram: dict[int, int], total: int = SEQUENCE_TOKENS) -> dict[str, np.ndarray]:
    """For each length, runs of ranks: from `rank`, ranks go `times` to a
    sequence, the first into `sequence` at `offset`. Sorted by (length, rank).
    Its size depends on `total` alone, not on the corpus."""
    left = np.zeros(total + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    lengths = np.flatnonzero(left)
    columns = patterns(lengths, total)
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    if len(columns):
        whole = _rounded(columns, repeats(columns, left), left)
        for i in np.flatnonzero(whole):
            present, times = np.unique(columns[i][columns[i] > 0], return_counts=True)
            groups.append((int(whole[i]), list(zip(present.tolist(), times.tolist()))))
    groups += _best_fit(left, total)
    next_rank = np.zeros(total + 1, dtype=np.int64)
    rows, sequence = [], 0
    for many, runs in groups:
        offset = 0
        for length, times in runs:
            rows.append((length, int(next_rank[length]), sequence, times, offset))
            next_rank[length] += many * times
            offset += length * times
        sequence += many
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "times", "offset"), table.T))


def pack(pieces: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Put every piece into a sequence: all its columns, sequence_id and offset.

    `length` must lie between 1 and `sequence_tokens`. Equal lengths are
    interchangeable, so ties are broken by row order; repeated rows get a place
    each. An empty table gives no rows. Existing columns named sequence_id or
    offset are replaced.
    """
    pieces = saved(pieces.drop("sequence_id", "offset"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(n is None or not 0 < n <= sequence_tokens for n in histogram):
        raise ValueError(f"piece lengths must lie between 1 and {sequence_tokens}")
    made = pieces.sparkSession.sparkContext.broadcast(plan(histogram, sequence_tokens))
    ranked = gapless_rank(pieces, ["length"], "sequence_id")
    at, rank_at = ranked.columns.index("length"), ranked.columns.index("sequence_id")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = made.value
        keys = runs["length"] << 44 | runs["rank"]
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(rank_at).to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            inside = rank - runs["rank"][run]
            times = runs["times"][run]
            columns = list(batch.columns)
            columns[rank_at] = pa.array(runs["sequence"][run] + inside // times)
            columns.append(pa.array(runs["offset"][run] + inside % times * length))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "offset"])

    schema = StructType([*ranked.schema.fields, StructField("offset", LongType())])
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in a row: sequence_id, ids. At most the sequence
    length of ids is gathered for one."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
