"""Token counts of documents that are kept up to date under edits.

A document is a list of pre-tokens in leaves, with the letters and tokens of each
subtree summed in a segment tree. An edit finds its leaves by their letters, the
text from a little before it is split again until a boundary falls on an old one,
and only what lies between is encoded anew; sums change along the paths up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import bounded_batches, per_worker, slices

LEAF_PIECES = 64
# The split looks at most so many letters past a pre-token's end.
LOOK_AHEAD = 3
CACHE_PIECES = 200_000


class PieceCounts(dict):
    """How many tokens each pre-token has; encoded when first asked for."""

    def __init__(self, ranks_file: str, pattern: str):
        import base64

        import regex
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern)
        self.encoded = 0

    def __missing__(self, piece: str) -> int:
        if len(self) > CACHE_PIECES:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n

    def pieces(self, text: str) -> list[str]:
        return self.split.findall(text)


class CountTree:
    """One document's pre-tokens with sums of letters and tokens."""

    def __init__(self, text: str, counts: PieceCounts):
        self.counts = counts
        self.encoded = 0
        self._plant(counts.pieces(text))

    def _plant(self, pieces: list[str]) -> None:
        self.leaves = [pieces[i : i + LEAF_PIECES] for i in range(0, len(pieces), LEAF_PIECES)] or [[]]
        self.base = 1
        while self.base < len(self.leaves):
            self.base *= 2
        self.letters, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, leaf in enumerate(self.leaves):
            self._fill(i)
        for i in range(self.base - 1, 0, -1):
            self._sum(i)

    def _fill(self, leaf: int) -> None:
        pieces = self.leaves[leaf]
        self.letters[self.base + leaf] = sum(map(len, pieces))
        self.tokens[self.base + leaf] = sum(map(self.counts.__getitem__, pieces))

    def _sum(self, node: int) -> None:
        self.letters[node] = self.letters[2 * node] + self.letters[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_letters(self) -> int:
        return self.letters[1]

    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the letter at `place`, and where it begins."""
        node, begin = 1, 0
        while node < self.base:
            node *= 2
            if place >= begin + self.letters[node] and self.letters[node + 1]:
                begin += self.letters[node]
                node += 1
        return min(node - self.base, len(self.leaves) - 1), begin

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the letters from `start` to `end`, both cut to the text."""
        start = min(max(start, 0), self.n_letters)
        end = min(max(end, start), self.n_letters)
        first, begin = self._find(max(0, start - LOOK_AHEAD))
        # pre-tokens that end LOOK_AHEAD letters before the edit stay as they are
        head = 0
        at = begin
        pieces = self.leaves[first]
        while head < len(pieces) and at + len(pieces[head]) <= start - LOOK_AHEAD:
            at += len(pieces[head])
            head += 1
        old = pieces[head:]
        last = first
        reach = at + sum(map(len, old))
        while reach < end and last + 1 < len(self.leaves):
            last += 1
            old = old + self.leaves[last]
            reach += sum(map(len, self.leaves[last]))
        while True:
            # the new text from `at` to as far as leaves were taken
            now = "".join(old)
            now = now[: start - at] + new + now[end - at :]
            shift = len(new) - (end - start)
            split = self.counts.pieces(now)
            at_end = last + 1 == len(self.leaves)
            bounds, p = {}, at
            for i, piece in enumerate(old):
                if p >= end:
                    bounds[p + shift] = i
                p += len(piece)
            p, meet = at, None
            for i, piece in enumerate(split):
                # a boundary of both splits beyond the edit; what the split could
                # still see must have been taken
                if p in bounds and p >= start + len(new) and (at_end or p + LOOK_AHEAD < at + len(now)):
                    meet = i, bounds[p]
                    break
                p += len(piece)
            if meet or at_end:
                break
            last += 1
            old = old + self.leaves[last]
        fresh, rest = (split[: meet[0]], old[meet[1] :]) if meet else (split, [])
        self.encoded += len(fresh)
        whole = pieces[:head] + fresh + rest
        if len(whole) > 4 * LEAF_PIECES * (last - first + 1):
            self.leaves[first : last + 1] = [whole]
            self._plant([p for leaf in self.leaves for p in leaf])
            return
        per = -(-len(whole) // (last - first + 1)) if whole else 0
        for i in range(first, last + 1):
            k = (i - first) * per
            self.leaves[i] = whole[k : k + per] if per else []
            self._fill(i)
        low, high = (self.base + first) // 2, (self.base + last) // 2
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low // 2, high // 2


def recount(docs: DataFrame, ranks_file: str, pattern: str, edits: str = "edits") -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, n_pieces, n_encoded of each row.

    `edits` names an array of (start, end, text): code points of the text as the
    edits before left it; places beyond the text are cut to it, a null place counts
    as the start, a null text as empty. A null text of a document counts as empty, a null array as no
    edits. n_encoded counts the pre-tokens encoded for the edits. Rows that
    repeat are counted each; other columns are left aside.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = per_worker(("piece counts", ranks_file, pattern), lambda: PieceCounts(ranks_file, pattern))
        for batch in batches:
            for begin, stop in slices(batch.column(1)):
                part = batch.slice(begin, stop - begin)
                rows = []
                for text, changes in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    tree = CountTree(text or "", counts)
                    before, pieces = tree.n_tokens, sum(map(len, tree.leaves))
                    changes = changes or []
                    apply(tree, ((c["start"], c["end"], c["text"]) for c in changes if c))
                    rows.append((before, len(changes), tree.n_tokens, pieces, tree.encoded))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], names=["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_pieces", "n_encoded"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded_batches(docs).select("doc_id", "text", edits).mapInArrow(
        run,
        f"doc_id {kind}, n_tokens bigint, n_edits bigint, n_tokens_after bigint, n_pieces bigint, n_encoded bigint",
    )


def apply(tree: CountTree, edits: Iterable[tuple[int | None, int | None, str | None]]) -> None:
    for start, end, text in edits:
        tree.edit(start or 0, end or 0, text or "")


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """`docs` with the edits of each document gathered in the order of `seq`.
    edits: doc_id, seq, start, end, text; those of no document are left aside. One
    document's edits are gathered in one place."""
    listed = edits.groupBy("doc_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("seq", "start", "end", "text"))),
            lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["text"].alias("text")),
        ).alias("edits")
    )
    return docs.drop("edits").join(listed, "doc_id", "left")
