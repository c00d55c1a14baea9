"""Tokens of two tokenizers aligned by their bytes, and how often ids are linked
across the corpus, from inverted bitmaps.

Two tokens are linked where their byte ranges overlap. A container is a run of
documents of bounded text. For each pair of linked ids it holds bitmaps over its
documents, one for each bit of the number of links a document has, gap-coded
where few documents are set, and compressed. The planes' union is the pair's
document bitmap; popcounts weighed by the planes' bits are its links. Containers
cover disjoint documents, so a pair's bitmap over the corpus is its containers'
side by side and popcounts add up without moving bits. Counts come back to
the containers, and each posting returns its pair's count to its document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import bounded_batches, per_worker, stored, text_bytes

# A container's text, and its documents, whose numbers must fit 16 bits.
CONTAINER_BYTES = 16 << 20
CONTAINER_DOCS = 65_535
# Text cut to units at once; a longer document is cut up at unit ends.
SLICE_BYTES = 4 << 20
ROW_PAIRS = 8192
CACHE_UNITS = 500_000
ENCODE_AT_ONCE = 20_000
PARTITIONS = 20_000

# A text is cut before a single blank or line end between other characters. No
# token of either tokenizer reaches across such a place, as no piece of the second has
# a blank after another character or a line end in it.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
# Texts with such a place are cut one by one.
_UNEVEN = rf"{_WHITE}[ \n]|[ \n]{_WHITE}|[ \n]$|^\n"


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    ones for themselves, the others in order from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places starts[i], ..., starts[i] + lengths[i] - 1 for each i, in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class Tokenizers:
    """Ids of both tokenizers for units of text, and the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            a_bytes[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁|\n", p) for p in pieces):
            raise ValueError("the second tokenizer has pieces that reach across units")
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_table, self.b_table = _table(a_bytes), _table(b_bytes)
        names = pa.array([str(i) for i in range(max(len(a_bytes), len(b_bytes)))])
        self.names, self.blank = names, self.b.piece_to_id("▁")

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Each unit begins with a blank, which the second tokenizer adds by
        itself, or with a line end, before which its blank is dropped."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return a, [ids[1:] if u[0] == "\n" and ids[:1] == [self.blank] else ids for u, ids in zip(units, b)]


def _same_bytes(ids: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which units' ids have just the unit's bytes."""
    flat, at = table
    lengths = np.diff(at)[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    size = np.diff(offsets)
    good = np.diff(ends) == size
    joined = flat[_runs(at[ids], lengths)]
    some = np.flatnonzero(good)
    differ = joined[_runs(ends[some], size[some])] != data[_runs(offsets[some], size[some])]
    good[some[np.repeat(np.arange(len(some)), size[some])[differ]]] = False
    return good


class Units:
    """What is known of each distinct unit: numbers of tokens, groups and links,
    whether both tokenizers keep its bytes, its groups as text, its linked pairs."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.good = np.empty(0, bool)
        self.sizes = np.empty((0, 4), np.int64)  # a, b, groups, links
        self.groups: list[pa.Array] = []
        self.codes: dict[int, int] = {}
        self.pair_of: list[int] = []
        self.links = np.empty(0, np.int32)
        self.link_ends = np.zeros(1, np.int64)

    def lookup(self, keys: list[str]) -> np.ndarray:
        """Numbers of units. A key leaves out a unit's leading blank where another
        character but white space follows."""
        number = self.number
        new = [k for k in dict.fromkeys(keys) if k not in number]
        for start in range(0, len(new), ENCODE_AT_ONCE):
            part = new[start : start + ENCODE_AT_ONCE]
            self._add([k if k[:1] in ("\n", " ") else " " + k for k in part])
            number.update(zip(part, range(len(number), len(number) + len(part))))
        return np.fromiter((number[k] for k in keys), dtype=np.int64, count=len(keys))

    def _add(self, units: list[str]) -> None:
        t = self.tokenizers
        a_lists, b_lists = t.encode(units)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a_lists, b_lists))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a_lists, b_lists))
        data, offsets = text_bytes(pa.array(units))
        good = _same_bytes(a, n_a, t.a_table, data, offsets) & _same_bytes(b, n_b, t.b_table, data, offsets)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = n_a * good, n_b * good
        # the good units' bytes lie in a row, and both kinds of tokens cover them
        a_size, b_size = np.diff(t.a_table[1])[a], np.diff(t.b_table[1])[b]
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        first = np.searchsorted(b_end, a_end - a_size, side="right")
        links = np.searchsorted(b_end - b_size, a_end, side="left") - first
        pairs = np.repeat(a, links) << 32 | b[_runs(first, links)]
        a_unit, b_unit = (np.repeat(np.arange(len(units)), n) for n in (n_a, n_b))
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        unit_of_group = a_unit[np.searchsorted(a_end, both)] if len(both) else np.empty(0, np.int64)
        count = lambda owner, weights=None: np.bincount(owner, weights, minlength=len(units)).astype(np.int64)
        n_links = count(a_unit, links)
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, count(unit_of_group), n_links], axis=1)])
        self.good = np.concatenate([self.good, good])
        # ";1,2|3;4|5": a mark before each id
        side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        group = np.concatenate([a_group, b_group])
        order = np.argsort(group * 2 + side, kind="stable")
        run = (group * 2 + side)[order]
        starts = np.ones(len(run), bool)
        starts[1:] = run[1:] != run[:-1]
        marks = pa.array([";", "|", ","]).take(pa.array(np.where(starts, run & 1, 2)))
        words = pc.binary_join_element_wise(marks, t.names.take(pa.array(np.concatenate([a, b])[order])), "")
        cuts = np.concatenate([[0], np.cumsum(n_a + n_b)]).astype(np.int32)
        self.groups.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), ""))
        distinct, back = np.unique(pairs, return_inverse=True)
        for pair in distinct.tolist():
            if pair not in self.codes:
                self.codes[pair] = len(self.pair_of)
                self.pair_of.append(pair)
        codes = np.fromiter((self.codes[p] for p in distinct.tolist()), np.int32, len(distinct))
        self.links = np.concatenate([self.links, codes[back]])
        self.link_ends = np.concatenate([self.link_ends, self.link_ends[-1] + np.cumsum(n_links)])

    def group_texts(self) -> pa.Array:
        self.groups = [pa.concat_arrays(self.groups)] if self.groups else [pa.array([], pa.string())]
        return self.groups[0]


def _summed(code: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by (code, doc), with the times of equal ones added."""
    key = code.astype(np.int64) << 16 | doc
    order = np.argsort(key)
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    times = np.add.reduceat(times, first) if len(first) else times
    return key[first] >> 16, key[first] & 0xFFFF, times


def segments(text: str, most: int) -> list[str]:
    """A long text cut before blanks or line ends where units may end."""
    out, start = [], 0
    while len(text) - start > most:
        cut = _CUT.search(text, start + most)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


class Container:
    """Documents of bounded text: their rows, and their pairs' bitmaps."""

    def __init__(self, units: Units):
        self.units = units
        if len(units.number) > CACHE_UNITS:
            units.clear()

    def _keys(self, texts: list[str], uneven: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit numbers of all texts in a row, and the n + 1 offsets between them.
        Texts begin with a blank or a line end."""
        counts = np.zeros(len(texts), dtype=np.int64)
        even = [t[1:] for t, u in zip(texts, uneven) if not u]
        split = pc.split_pattern(pc.replace_substring(pa.array(even, pa.large_string()), "\n", " \n"), " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten().dictionary_encode()
        number = self.units.lookup(words.dictionary.to_pylist()) if len(words) else np.empty(0, np.int64)
        flat = number[words.indices.to_numpy(zero_copy_only=False)]
        counts[~uneven] = np.diff(ends)
        other = []
        for i in np.flatnonzero(uneven):
            keys = [u[1:] if u[0] == " " and not u[1:2].isspace() else u for u in _CUT.split(texts[i])]
            other.append(self.units.lookup(keys))
            counts[i] = len(keys)
        starts = np.empty(len(texts), dtype=np.int64)
        starts[~uneven] = ends[:-1]
        starts[uneven] = len(flat) + np.cumsum(counts[uneven]) - counts[uneven]
        flat = np.concatenate([flat, *other])
        return flat[_runs(starts, counts)], np.concatenate([[0], np.cumsum(counts)])

    def run(self, texts: list[str]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each document n_a, n_b, n_groups and n_links, and the digest of its
        groups; and its postings as pair codes, documents and numbers of links."""
        units = self.units
        sizes = np.zeros((len(texts), 4), dtype=np.int64)
        good = np.array([bool(t) for t in texts], dtype=bool)
        hashes = [hashlib.sha256() for _ in texts]
        begun = np.zeros(len(texts), dtype=bool)
        parts = [(np.empty(0, np.int64),) * 3]
        for docs, pieces, uneven in self._slices(texts):
            flat, cuts = self._keys(pieces, uneven)
            owner = np.repeat(docs, np.diff(cuts))
            for column in range(4):
                np.add.at(sizes[:, column], docs, np.add.reduceat(units.sizes[flat, column], cuts[:-1]))
            good[owner[~units.good[flat]]] = False
            words = units.group_texts().take(pa.array(flat))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), words), "")
            data, at = text_bytes(joined)
            view = memoryview(np.ascontiguousarray(data))
            for doc, lo, hi in zip(docs.tolist(), at[:-1].tolist(), at[1:].tolist()):
                if hi > lo:  # the mark before the first id goes
                    hashes[doc].update(view[lo if begun[doc] else lo + 1 : hi])
                    begun[doc] = True
            key = np.sort(owner << 40 | flat)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            times = np.diff(np.append(first, len(key)))
            doc, unit = key[first] >> 40, key[first] & ((1 << 40) - 1)
            starts, lengths = units.link_ends[unit], np.diff(units.link_ends)[unit]
            parts.append(_summed(units.links[_runs(starts, lengths)], np.repeat(doc, lengths), np.repeat(times, lengths)))
        code, doc, times = _summed(*(np.concatenate(x) for x in zip(*parts)))
        keep = good[doc]
        sizes[~good] = 0
        digests = [h.hexdigest() if g else "" for h, g in zip(hashes, good)]
        return sizes, digests, (code[keep], doc[keep], times[keep])

    @staticmethod
    def _slices(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
        """Documents, parts of them and whether these need the slow cut, at most
        about SLICE_BYTES at once."""
        docs: list[int] = []
        pieces: list[str] = []
        held = 0

        def out():
            uneven = pc.match_substring_regex(pa.array(pieces, pa.large_string()), _UNEVEN)
            return np.array(docs, dtype=np.int64), pieces, uneven.to_numpy(zero_copy_only=False)

        for i, text in enumerate(texts):
            for piece in segments(" " + text, SLICE_BYTES) if text else ():
                docs.append(i)
                pieces.append(piece)
                held += len(piece)
                if held >= SLICE_BYTES:
                    yield out()
                    docs, pieces, held = [], [], 0
        if docs:
            yield out()


def encode_planes(code: np.ndarray, doc: np.ndarray, times: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, bytes]]:
    """Postings sorted by (code, doc) as rows of at most ROW_PAIRS pairs: their
    codes, links and documents, the number of planes, and the bits.

    The bits are, plane by plane and pair by pair, how many documents are set;
    then the pairs with at least one document in 16 set as plain bits, then the
    others as gaps, all low bytes before all high ones; compressed.
    """
    if not len(code):
        return
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    ends = np.append(first[1:], len(code))
    for start in range(0, len(first), ROW_PAIRS):
        lo, hi = first[start], ends[min(start + ROW_PAIRS, len(first)) - 1]
        pairs = code[first[start : start + ROW_PAIRS]]
        pair = np.repeat(np.arange(len(pairs)), (ends - first)[start : start + ROW_PAIRS])
        d, m = doc[lo:hi], times[lo:hi]
        planes = int(m.max()).bit_length()
        entry, member = [], []
        for plane in range(planes):
            set_ = (m >> plane & 1).astype(bool)
            entry.append(pair[set_] + plane * len(pairs))
            member.append(d[set_])
        entry, member = np.concatenate(entry), np.concatenate(member)
        members = np.bincount(entry, minlength=planes * len(pairs))
        dense = members * 16 >= size
        packed = []
        number = np.cumsum(dense) - 1
        some = dense[entry]
        row, column = number[entry[some]], member[some]
        for at in range(0, int(dense.sum()), 256):
            inside = slice(*np.searchsorted(row, [at, at + 256]))
            bits = np.zeros((min(256, int(dense.sum()) - at), size), dtype=bool)
            bits[row[inside] - at, column[inside]] = True
            packed.append(np.packbits(bits, axis=1).tobytes())
        entry, member = entry[~some], member[~some]
        gaps = np.diff(member, prepend=0)
        begin = np.concatenate([[True], entry[1:] != entry[:-1]]) if len(entry) else np.empty(0, bool)
        gaps[begin] = member[begin]
        raw = b"".join([
            members.astype("<u2").tobytes(), *packed, (gaps & 255).astype(np.uint8).tobytes(), (gaps >> 8).astype(np.uint8).tobytes()
        ])
        bits = len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)
        by_plane = members.reshape(planes, len(pairs))
        links = (by_plane << np.arange(planes)[:, None]).sum(axis=0)
        # the union of a pair's planes has each of its postings once
        yield pairs, links, np.bincount(pair, minlength=len(pairs)), planes, bits


def decode_planes(bits: bytes, n_pairs: int, planes: int, size: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(entry, bitmap) of the plain ones and (entry, document) of the others; the
    entry of a pair's plane is plane * n_pairs + pair."""
    raw = np.frombuffer(pa.decompress(bits[8:], int.from_bytes(bits[:8], "little"), codec="zstd"), dtype=np.uint8)
    members = raw[: 2 * planes * n_pairs].view("<u2").astype(np.int64)
    dense = members * 16 >= size
    width = -(-size // 8)
    at = 2 * planes * n_pairs
    plain = raw[at : at + int(dense.sum()) * width].reshape(-1, width)
    at += plain.size
    entry = np.repeat(np.flatnonzero(~dense), members[~dense])
    gaps = raw[at : at + len(entry)].astype(np.int64) | raw[at + len(entry) :].astype(np.int64) << 8
    upto = np.cumsum(gaps)
    begin = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]])) if len(entry) else np.empty(0, np.int64)
    base = (upto - gaps)[begin]
    return (np.flatnonzero(dense), plain), (entry, upto - np.repeat(base, np.diff(np.append(begin, len(entry)))))


_DOCUMENT = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_RUN = ["pairs", "links", "documents", "planes", "size", "bits"]


def index(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Containers of the inverted index, as a stored table of two kinds of rows.

    A document: container, place in it, doc_id, n_a, n_b, n_groups, n_links and
    groups_sha256. A run of pairs: container, place of its first pair in it, pairs
    (first id * 2^32 + second id), links and documents of each, planes, bits and
    `size`, the container's documents. Texts that are null or empty, or that a
    tokenizer does not keep byte for byte, have no tokens: zeros and ''. Rows that
    repeat are documents of their own; an empty table gives no rows. Other columns
    than doc_id and text are left aside.
    """
    kind = docs.schema["doc_id"].dataType
    schema = (
        f"container bigint, place bigint, doc_id {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs array<bigint>, links array<bigint>, documents array<int>, planes int, size int, bits binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = per_worker(("aligned units", a_path, b_path), lambda: Units(Tokenizers(a_path, b_path)))
        task = TaskContext.get().partitionId() << 32
        done = 0
        ids: list[pa.Array] = []
        texts: list[str] = []
        held = 0

        def batch(ids_: pa.Array, columns: list) -> pa.RecordBatch:
            n = len(columns[1])
            filled = [pa.array(c, t) if c is not None else pa.nulls(n, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays([*filled[:2], ids_, *filled[2:]], names=names)

        def finish() -> Iterator[pa.RecordBatch]:
            container, n = task + done, len(texts)
            sizes, digests, (code, doc, times) = Container(units).run(texts)
            yield batch(
                pa.concat_arrays(ids), [np.full(n, container), np.arange(n), *sizes.T, digests, None, None, None, None, None, None]
            )
            of = np.array(units.pair_of, dtype=np.int64)
            place = 0
            for pairs, links, documents, planes, bits in encode_planes(code, doc, times, n):
                row = [[container], [place], *[None] * 5, [of[pairs]], [links], [documents.astype(np.int32)], [planes], [n], [bits]]
                yield batch(pa.nulls(1, ids[0].type), row)
                place += len(pairs)
            pa.default_memory_pool().release_unused()

        for b in batches:
            lengths = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            taken = b.column(1).to_pylist()
            start = 0
            for i, n in enumerate(lengths):
                if i > start or texts:
                    if held + n > CONTAINER_BYTES or len(texts) + i - start >= CONTAINER_DOCS:
                        ids.append(b.column(0).slice(start, i - start))
                        texts.extend(t or "" for t in taken[start:i])
                        yield from finish()
                        done, ids, texts, held, start = done + 1, [], [], 0, i
                held += n
            ids.append(b.column(0).slice(start))
            texts.extend(t or "" for t in taken[start:])
        if texts:
            yield from finish()

    types = [*[pa.int64()] * 6, pa.string(), *[pa.list_(pa.int64())] * 2, pa.list_(pa.int32()), *[pa.int32()] * 2, pa.binary()]
    names = ["container", "place", "doc_id", *_DOCUMENT, *_RUN]
    return stored(bounded_batches(docs).select("doc_id", "text").mapInArrow(run, schema))


def _each_pair(made: DataFrame, *columns: str) -> DataFrame:
    """One row for each container and pair."""
    runs = made.where("pairs is not null")
    return runs.select("container", "place", F.inline(F.arrays_zip("pairs", *columns))).withColumnRenamed("pairs", "pair")


def pair_counts(made: DataFrame) -> DataFrame:
    """How many links and documents each pair of ids has: a_id, b_id, links, documents."""
    counts = _each_pair(made, "links", "documents").groupBy("pair").agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))
    return counts.select(_first(F.col("pair")).alias("a_id"), _second(F.col("pair")).alias("b_id"), "links", "documents")


def _first(pair: Column) -> Column:
    return F.shiftright(pair, 32).cast("int")


def _second(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def score(made: DataFrame) -> DataFrame:
    """The documents of an index with n_best, how many of their links have the
    highest count of their second id, and count_sum, the counts of all their links
    added: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    # at most as many rows as the second tokenizer has ids
    highest = pair_counts(made).groupBy("b_id").agg(F.max("links").alias("highest"))
    runs = made.where("pairs is not null").select("container", "place", "pairs", "links")
    each = runs.select("container", F.posexplode(F.arrays_zip("pairs", "links")).alias("at", "p"), "place").select(
        "container", (F.col("place") + F.col("at")).alias("place"), "p.pairs", "p.links"
    )
    # a pair has one row for each container, of a few bytes
    counted = each.select("container", "place", _second(F.col("pairs")).alias("b_id"), F.sum("links").over(Window.partitionBy("pairs")).alias("count"))
    known = counted.join(F.broadcast(highest), "b_id").select(F.col("container").alias("of"), "place", "count", (F.col("count") == F.col("highest")).alias("best"))
    kind = made.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    names = ["doc_id", *_DOCUMENT[:-1], "n_best", "count_sum", "groups_sha256"]

    def give_back(rows: pa.Table, scores: pa.Table) -> pa.Table:
        """Each posting returns its pair's count to its document."""
        is_doc = pc.is_null(rows.column("pairs"))
        documents, runs = rows.filter(is_doc), rows.filter(pc.invert(is_doc))
        place = scores.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = scores.column("count").to_numpy(), scores.column("best").to_numpy(zero_copy_only=False)
        sums = np.zeros((2, len(documents)), dtype=np.int64)
        for r in range(len(runs)):
            n = len(runs.column("pairs")[r])
            at, planes, size = (runs.column(c)[r].as_py() for c in ("place", "planes", "size"))
            (entry, plain), (few, doc) = decode_planes(runs.column("bits")[r].as_py(), n, planes, size)
            for total, value in zip(sums, (count, best)):
                weight = (value[at : at + n][None, :] << np.arange(planes)[:, None]).ravel()
                np.add.at(total, doc, weight[few])
                for start in range(0, len(entry), 64):
                    bits = np.unpackbits(plain[start : start + 64], axis=1, count=size)
                    total += weight[entry[start : start + 64]] @ bits.astype(np.int64)
        mine = documents.column("place").to_numpy()
        columns = {c: documents.column(c) for c in names if c in documents.column_names}
        return pa.table({c: columns[c] if c in columns else sums[0 if c == "count_sum" else 1][mine] for c in names})

    containers = made.select("container").distinct().count()
    parts = max(1, min(containers, PARTITIONS))
    left = made.drop("links", "documents").repartition(parts, "container").groupBy("container")
    right = known.repartition(parts, "of").groupBy("of")
    return left.cogroup(right).applyInArrow(give_back, out)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each document's tokens, groups and links, and how common its links are in
    the corpus; see `index` and `score`."""
    return score(index(docs, a_path, b_path))
