"""Decode packed MySQL rows, many events at a time.

A row body is a run of values whose lengths are only known by reading it, so
built-in expressions cannot split it. The decoder takes Arrow batches and
works over all events of a batch whose tables have the same columns. One walk
over null bitmaps and length prefixes finds where each row starts; then every
step is a numpy operation on whole vectors of read positions, column by column,
so neither many tables nor long events cost more per row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T
from pyspark.sql.types import StructType

from tidemark.functions.charsets import is_foreign, transcoded
from tidemark.functions.names import DELETES, SINK_TYPES, UPDATES, WITH_EXTRAS
from tidemark.operators.binaryjson import json_texts
from tidemark.operators.tablemap import ColumnDef, TableMap, parse_table_map

VALUE = "STRUCT<u64: DECIMAL(20,0), i64: BIGINT, f64: DOUBLE, str: STRING, bytes: BINARY>"
COLUMNS = f"ARRAY<STRUCT<name: STRING, is_nullable: BOOLEAN, column_type: STRING, type_name: STRING, value: {VALUE}>>"

# Bodies decoded in one go; bounds the memory of a step, not the input.
CHUNK_BYTES = 4 << 20

_U64 = pa.decimal128(20, 0)
_VALUE = pa.struct([("u64", _U64), ("i64", pa.int64()), ("f64", pa.float64()), ("str", pa.string()), ("bytes", pa.binary())])
_COL = pa.struct([("name", pa.string()), ("is_nullable", pa.bool_()), ("column_type", pa.string()),
                  ("type_name", pa.string()), ("value", _VALUE)])

CUT, COUNT, EMPTY = "row event cut short", "column count differs from the table map", "row image without columns"


def _uint(data: np.ndarray, at: np.ndarray, size: int, big: bool = False) -> np.ndarray:
    value = np.zeros(len(at), np.uint64)
    for i in range(size):
        shift = 8 * (size - 1 - i if big else i)
        value |= data[at + i].astype(np.uint64) << np.uint64(shift)
    return value


def _signed(value: np.ndarray, size: int) -> np.ndarray:
    spare = np.int64(64 - 8 * size)
    return (value.astype(np.int64) << spare) >> spare


def _put_digits(text: np.ndarray, at: int, value: np.ndarray, digits: int) -> None:
    for i in reversed(range(digits)):
        text[:, at + i] = 48 + value % 10
        value = value // 10


# Bytes that hold a group of 0 to 9 decimal digits.
_DIGIT_BYTES = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]


def _decimal_groups(precision: int, scale: int) -> tuple[list[int], list[int]]:
    """Digits per group: whole part (short group first) and fraction (last)."""
    whole = precision - scale
    lead, tail = whole % 9, scale % 9
    return ([lead] if lead else []) + [9] * (whole // 9), [9] * (scale // 9) + ([tail] if tail else [])


def _decimal_width(col: ColumnDef) -> int:
    whole, fraction = _decimal_groups(col.precision, col.scale)
    return sum(_DIGIT_BYTES[d] for d in whole + fraction)


# Each text decoder returns an ASCII matrix and, per row, where its text starts.


def _decimal_text(data, at, col):
    whole, fraction = _decimal_groups(col.precision, col.scale)
    raw = data[at[:, None] + np.arange(_decimal_width(col))]
    negative = raw[:, 0] < 0x80
    raw[:, 0] ^= 0x80
    raw[negative] ^= 0xFF
    digits = max(col.precision - col.scale, 1)
    text = np.full((len(at), 1 + digits + (1 + col.scale if col.scale else 0)), 48, np.uint8)
    read, write = 0, 1 if whole else 2
    for group, d in enumerate(whole + fraction):
        if group == len(whole):
            text[:, write] = ord(".")
            write += 1
        value = np.zeros(len(at), np.int64)
        for i in range(_DIGIT_BYTES[d]):
            value = value << 8 | raw[:, read + i]
        read += _DIGIT_BYTES[d]
        _put_digits(text, write, value, d)
        write += d
    leading = text[:, 1:digits] == 48
    zeros = np.where(leading.all(axis=1), digits - 1, np.argmin(leading, axis=1) if digits > 1 else 0)
    start = 1 + zeros - negative
    text[np.flatnonzero(negative), start[negative]] = ord("-")
    return text, start


def _date_text(data, at, col):
    packed = _uint(data, at, 3).astype(np.int64)
    text = np.full((len(at), 10), ord("-"), np.uint8)
    for place, part, digits in ((0, packed >> 9, 4), (5, packed >> 5 & 15, 2), (8, packed & 31, 2)):
        _put_digits(text, place, part, digits)
    return text, np.zeros(len(at), np.int64)


def _datetime_text(data, at, col):
    packed = _uint(data, at, 8).astype(np.int64)
    text = np.tile(np.frombuffer(b"0000-00-00 00:00:00", np.uint8), (len(at), 1))
    for place, scale, digits in ((0, 10**10, 4), (5, 10**8, 2), (8, 10**6, 2), (11, 10**4, 2), (14, 100, 2), (17, 1, 2)):
        _put_digits(text, place, packed // scale, digits)
    return text, np.zeros(len(at), np.int64)


def _time_text(data, at, col):
    packed = _signed(_uint(data, at, 3), 3)
    size = np.abs(packed)
    text = np.tile(np.frombuffer(b"-000:00:00", np.uint8), (len(at), 1))
    for place, part, digits in ((1, size // 10_000, 3), (5, size // 100, 2), (8, size, 2)):
        _put_digits(text, place, part, digits)
    start = 1 + (text[:, 1] == 48).astype(np.int64) - (packed < 0)
    text[np.flatnonzero(packed < 0), start[packed < 0]] = ord("-")
    return text, start


def _fraction_bytes(col: ColumnDef) -> int:
    return (col.scale + 1) // 2


def _put_fraction(text: np.ndarray, at: int, fraction: np.ndarray, col: ColumnDef) -> None:
    """``.`` and the fraction, which is stored as whole bytes of two digits."""
    if col.scale:
        text[:, at] = ord(".")
        _put_digits(text, at + 1, fraction // 10 ** (2 * _fraction_bytes(col) - col.scale), col.scale)


def _template(rows: int, text: str, col: ColumnDef, tail: str = "") -> np.ndarray:
    """Rows of ``text``, room for a fraction and ``tail``."""
    whole = text + "0" * (1 + col.scale if col.scale else 0) + tail
    return np.tile(np.frombuffer(whole.encode(), np.uint8), (rows, 1))


def _datetime2_text(data, at, col):
    packed = _uint(data, at, 5, big=True).astype(np.int64) - (1 << 39)
    months = packed >> 22
    text = _template(len(at), "0000-00-00 00:00:00", col)
    parts = ((0, months // 13, 4), (5, months % 13, 2), (8, packed >> 17 & 31, 2),
             (11, packed >> 12 & 31, 2), (14, packed >> 6 & 63, 2), (17, packed & 63, 2))
    for place, part, digits in parts:
        _put_digits(text, place, part, digits)
    _put_fraction(text, 19, _uint(data, at + 5, _fraction_bytes(col), big=True).astype(np.int64), col)
    return text, np.zeros(len(at), np.int64)


def _time2_text(data, at, col):
    extra = _fraction_bytes(col)
    packed = _uint(data, at, 3 + extra, big=True).astype(np.int64) - (1 << 23 + 8 * extra)
    size = np.abs(packed)
    whole = size >> 8 * extra
    text = _template(len(at), "-000:00:00", col)
    for place, part, digits in ((1, whole >> 12 & 0x3FF, 3), (5, whole >> 6 & 63, 2), (8, whole & 63, 2)):
        _put_digits(text, place, part, digits)
    _put_fraction(text, 10, size & (1 << 8 * extra) - 1, col)
    start = 1 + (text[:, 1] == 48).astype(np.int64) - (packed < 0)
    text[np.flatnonzero(packed < 0), start[packed < 0]] = ord("-")
    return text, start


def _timestamp2_text(data, at, col):
    """Server time is UTC, and says so. Zero is the zero date, which has no zone."""
    seconds = _uint(data, at, 4, big=True).astype(np.int64)
    plain = np.datetime_as_string(seconds.astype("datetime64[s]"))
    text = _template(len(at), "0000-00-00 00:00:00", col, "+00:00")
    text[:, :19] = np.char.encode(np.char.replace(plain, "T", " "), "ascii").view(np.uint8).reshape(len(at), -1)
    _put_fraction(text, 19, _uint(data, at + 4, _fraction_bytes(col), big=True).astype(np.int64), col)
    zero = seconds == 0
    text[zero, 6:] = text[zero, :-6]  # without the zone, at the end of its place
    text[zero, 6:25] = np.frombuffer(b"0000-00-00 00:00:00", np.uint8)
    return text, np.where(zero, 6, 0)


def _enum_name(index: int, col: ColumnDef) -> str:
    """0 is the empty value of a failed insert."""
    if not index or not col.values:
        return str(index) if index else ""
    return col.values[index - 1] if index <= len(col.values) else str(index)


def _set_names(mask: int, col: ColumnDef) -> str:
    if not col.values:
        return str(mask)
    return ",".join(v for i, v in enumerate(col.values) if mask >> i & 1)


_NAMED = {"enum": _enum_name, "set": _set_names}
_TEXT = {"datetime2": _datetime2_text, "time2": _time2_text, "timestamp2": _timestamp2_text, "decimal": _decimal_text, "date": _date_text, "datetime": _datetime_text, "time": _time_text}
_PREFIXED = ("string", "blob", "json")
_FRACTIONAL = {"datetime2": 5, "timestamp2": 4, "time2": 3}  # bytes before the fraction
_FIXED_BYTES = {"date": 3, "datetime": 8, "time": 3, "year": 1, "timestamp": 4}


def _number_bits(data, at, col: ColumnDef) -> np.ndarray:
    """A numeric value as 64 raw bits: i64, u64 or f64 by its definition."""
    if col.definition == "i64":
        return _signed(_uint(data, at, col.pack_length), col.pack_length).view(np.uint64)
    if col.definition == "f64":
        raw = data[at[:, None] + np.arange(col.pack_length)]
        return raw.view("<f4" if col.pack_length == 4 else "<f8").ravel().astype(np.float64).view(np.uint64)
    if col.definition == "u64":
        return _uint(data, at, col.pack_length, big=col.type_name.startswith("bit"))
    if col.definition == "year":
        year = _uint(data, at, 1)
        return np.where(year == 0, year, year + np.uint64(1900))
    return _uint(data, at, 4)  # timestamp: seconds since 1970


class _Image:
    """Decoded values of one image (before or after) of a set of rows."""

    def __init__(self, rows: int, cols: int):
        self.null = np.ones((rows, cols), bool)
        self.bits = np.zeros((rows, cols), np.uint64)
        self.start = np.zeros((rows, cols), np.int64)
        self.size = np.zeros((rows, cols), np.int64)

    def column(self, j: int) -> _Image:
        one = _Image(0, 0)
        for name in ("null", "bits", "start", "size"):
            setattr(one, name, getattr(self, name)[:, j : j + 1])
        return one


class _Group:
    """Events of one operation and one list of columns out of one chunk, their
    bytes gathered next to each other."""

    def __init__(self, data: np.ndarray, pos: np.ndarray, end: np.ndarray, columns: tuple[ColumnDef, ...]):
        self.data, self.pos, self.end, self.columns = data, pos, end, columns
        self.scratch, self.scratch_at = [], len(data)
        self.error = np.full(len(pos), None, object)

    def fail(self, events: np.ndarray, why: str) -> None:
        self.error[events] = why
        self.pos[events] = self.end[events]

    def open(self, extras: bool, images: int) -> np.ndarray:
        """Read the event header; leaves ``pos`` at the first row. Which columns
        each image of an event has: events x images x columns."""
        events = np.arange(len(self.pos))
        width = (len(self.columns) + 7) // 8
        self._skip(events, 8)
        if extras:
            ok = self._fitting(events, 2)
            self._skip(ok, _uint(self.data, self.pos[ok], 2).astype(np.int64), from_start=True)
        ok = self._fitting(self._good(), 1)
        first = self.data[self.pos[ok]].astype(np.int64)
        for mark, size in ((0, 1), (0xFC, 3), (0xFD, 4), (0xFE, 9)):
            sel = ok[first == mark] if mark else ok[first < 0xFC]
            sel = self._fitting(sel, size)
            count = _uint(self.data, self.pos[sel] + (size > 1), max(size - 1, 1)).astype(np.int64)
            self.fail(sel[count != len(self.columns)], COUNT)
            self._skip(sel[count == len(self.columns)], size)
        self.fail(ok[first == 0xFF], COUNT)
        present = np.ones((len(self.pos), images, len(self.columns)), bool)
        for i in range(images):
            ok = self._fitting(self._good(), width)
            present[ok, i] = self._bitmap(self.pos[ok], self.columns)
            self._skip(ok, width)
        if len(self.columns):
            self.fail(self._good()[~present[self._good()].any(axis=2).all(axis=1)], EMPTY)
        return present

    def _good(self) -> np.ndarray:
        return np.flatnonzero(self.error == None)  # noqa: E711

    def _fitting(self, events: np.ndarray, size) -> np.ndarray:
        fits = self.pos[events] + size <= self.end[events]
        if not fits.all():
            self.fail(events[~fits], CUT)
            events = events[fits]
        return events

    def _skip(self, events: np.ndarray, size, from_start: bool = False) -> None:
        fits = self.pos[events] + size <= self.end[events]
        self.pos[events[fits]] += size[fits] if from_start else size
        self.fail(events[~fits], CUT)

    def _bitmap(self, at: np.ndarray, columns: tuple[ColumnDef, ...]) -> np.ndarray:
        raw = self.data[at[:, None] + np.arange((len(columns) + 7) // 8)]
        return np.unpackbits(raw, axis=1, bitorder="little")[:, : len(columns)].astype(bool)

    def _steps(self, columns: tuple[ColumnDef, ...], bitmap: int) -> list[tuple[int, int]]:
        """How to pass a row with these nulls: fixed bytes, then the size of a
        length prefix (0 at the end)."""
        steps, fixed = [], 0
        for j, col in enumerate(columns):
            if col.is_nullable and bitmap >> j & 1:
                continue
            if col.definition in _PREFIXED:
                steps.append((fixed, col.pack_length))
                fixed = 0
            else:
                fixed += self._width(col)
        return [*steps, (fixed, 0)]

    def row_starts(self, layouts: list[tuple[ColumnDef, ...]], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Event, number within it and start of every image of every whole row of
        the chosen events, whose images have these columns. Events whose last row
        is cut fail as a whole."""
        raw = self.data.tobytes()
        images = len(layouts)
        widths = [(len(columns) + 7) // 8 for columns in layouts]
        plans: list[dict[bytes, list[tuple[int, int]]]] = [{} for _ in layouts]
        events, counts, starts, cut = [], [], [], []
        for event in chosen.tolist():
            at, end = int(self.pos[event]), int(self.end[event])
            before, image = len(starts), 0
            while at < end and widths[image]:
                starts.append(at)
                bits = raw[at : at + widths[image]]
                plan = plans[image].get(bits)
                if plan is None:
                    plan = plans[image][bits] = self._steps(layouts[image], int.from_bytes(bits, "little"))
                at += widths[image]
                image = (image + 1) % images
                for fixed, prefix in plan:
                    at += fixed
                    if prefix:
                        # a prefix beyond the event reads a stranger's bytes, but
                        # only moves further past the end
                        at += prefix + int.from_bytes(raw[at : at + prefix], "little")
            if at != end or (len(starts) - before) % images:
                del starts[before:]
                cut.append(event)
            else:
                events.append(event)
                counts.append(len(starts) - before)
        if cut:
            self.fail(np.array(cut), CUT)
        counts = np.array(counts, np.int64)
        number = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(np.array(events, np.int64), counts), number, np.array(starts, np.int64)

    def read(self, pos: np.ndarray, columns: tuple[ColumnDef, ...]) -> _Image:
        """The images that start at ``pos``, column by column."""
        image = _Image(len(pos), len(columns))
        image.null = self._bitmap(pos, columns) & np.array([c.is_nullable for c in columns], bool)
        pos = pos + (len(columns) + 7) // 8
        for j, col in enumerate(columns):
            rows = np.flatnonzero(~image.null[:, j])
            if not len(rows):
                continue
            at = pos[rows]
            if col.definition in _PREFIXED:
                size = _uint(self.data, at, col.pack_length).astype(np.int64)
                at = at + col.pack_length
                image.start[rows, j], image.size[rows, j] = at, size
            else:
                size = self._width(col)
                if col.definition in _NAMED:
                    self._add_named(image, rows, j, _uint(self.data, at, size), col)
                elif col.definition in _TEXT:
                    self._add_text(image, rows, j, *_TEXT[col.definition](self.data, at, col))
                else:
                    image.bits[rows, j] = _number_bits(self.data, at, col)
            pos[rows] = at + size
        return image

    @staticmethod
    def _width(col: ColumnDef) -> int:
        if col.definition == "decimal":
            return _decimal_width(col)
        if col.definition in _FRACTIONAL:
            return _FRACTIONAL[col.definition] + _fraction_bytes(col)
        return _FIXED_BYTES.get(col.definition) or col.pack_length

    def _add_named(self, image: _Image, rows, j: int, raw: np.ndarray, col: ColumnDef) -> None:
        distinct, which = np.unique(raw, return_inverse=True)
        names = [_NAMED[col.definition](int(v), col).encode() for v in distinct]
        size = np.array([len(n) for n in names], np.int64)
        image.start[rows, j] = self.scratch_at + (np.cumsum(size) - size)[which]
        image.size[rows, j] = size[which]
        self.scratch.append(np.frombuffer(b"".join(names), np.uint8))
        self.scratch_at += int(size.sum())

    def _add_text(self, image: _Image, rows, j: int, text: np.ndarray, start: np.ndarray) -> None:
        step = text.shape[1]
        image.start[rows, j] = self.scratch_at + np.arange(len(rows)) * step + start
        image.size[rows, j] = step - start
        self.scratch.append(text.ravel())
        self.scratch_at += text.size


def _bitmap_buffer(valid: np.ndarray) -> pa.Buffer:
    return pa.py_buffer(np.packbits(valid, bitorder="little"))


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Binary array of ``data[start:start + size]``, null where not valid."""
    size = np.where(valid, size, 0)
    ends = np.cumsum(size)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    where = np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return pa.Array.from_buffers(
        pa.binary(), len(size), [_bitmap_buffer(valid), pa.py_buffer(offsets), pa.py_buffer(data[where])]
    )


def _utf8_or_bytes(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values as strings, and which of them are not UTF-8. Only stretches
    that hold such a value are looked at one by one."""
    try:
        return text.cast(pa.string()), np.zeros(len(text), bool)
    except pa.ArrowInvalid:
        if len(text) > 512:
            half = len(text) // 2
            (a, x), (b, y) = _utf8_or_bytes(text[:half]), _utf8_or_bytes(text[half:])
            return pa.concat_arrays([a, b]), np.concatenate([x, y])
        broken = np.zeros(len(text), bool)
        values = text.to_pylist()
        for i, v in enumerate(values):
            try:
                values[i] = v if v is None else v.decode("utf-8")
            except UnicodeDecodeError:
                values[i], broken[i] = None, True
        return pa.array(values, pa.string()), broken


@dataclass(frozen=True)
class Forms:
    """How values leave the decoder: JSON as stored, character columns as stored, and
    TEXT columns as text."""

    raw_json: bool = False
    raw_text: bool = False
    texts: bool = False

    def column_type(self, col: ColumnDef) -> str:
        """TEXT is told from BLOB by its charset."""
        is_text = self.texts and col.definition == "blob" and col.charset not in (None, "binary")
        return "String" if is_text else SINK_TYPES[col.definition]


def _foreign_texts(columns, image: _Image, data: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Cells (row by row) of the columns ``which``, their values transcoded column by
    column, and those that hold what their charset does not."""
    cells, texts, broken = [np.zeros(0, np.int64)], [pa.nulls(0, pa.string())], [np.zeros(0, np.int64)]
    for j in np.flatnonzero(which):
        rows = np.flatnonzero(~image.null[:, j])
        stored = _slices(data, image.start[rows, j], image.size[rows, j], np.ones(len(rows), bool))
        text, unread = transcoded(stored, columns[j].charset)
        cells.append(rows * len(columns) + j)
        texts.append(text)
        broken.append(cells[-1][unread])
    return np.concatenate(cells), pa.concat_arrays(texts), np.concatenate(broken)


def _put(text: pa.Array, cells: np.ndarray, found: pa.Array) -> pa.Array:
    """``text`` with the ``found`` values in these cells, which are null in it."""
    place, mine = np.zeros(len(text), np.int64), np.zeros(len(text), bool)
    place[cells], mine[cells] = np.arange(len(cells)), True
    return pc.coalesce(text, found.take(pa.array(place, mask=~mine)))


def _values(columns: tuple[ColumnDef, ...], image: _Image, data: np.ndarray, forms: Forms = Forms()) -> pa.Array:
    """Value structs, row by row, of the given columns of an image. What cannot be
    read as text stays bytes."""
    kinds = np.array([forms.column_type(c) for c in columns])
    present = ~image.null

    def cells(mask):
        return (present & mask).ravel()

    bits = np.ascontiguousarray(image.bits).ravel()
    stamped = np.array([c.definition == "timestamp2" for c in columns])
    is_u64 = (kinds == "U64") | (kinds == "Timestamp") & ~stamped
    wide = np.zeros((len(bits), 2), np.uint64)
    wide[:, 0] = bits
    u64 = pa.Array.from_buffers(_U64, len(bits), [_bitmap_buffer(cells(is_u64)), pa.py_buffer(wide)])
    i64 = pa.Array.from_buffers(pa.int64(), len(bits), [_bitmap_buffer(cells(kinds == "I64")), pa.py_buffer(bits)])
    f64 = pa.Array.from_buffers(pa.float64(), len(bits), [_bitmap_buffer(cells(kinds == "F64")), pa.py_buffer(bits)])
    start, size = image.start.ravel(), image.size.ravel()
    binary = np.array([c.is_binary or forms.raw_text and c.definition == "string" for c in columns], bool)
    foreign = np.array([is_foreign(c.charset) for c in columns], bool) & (kinds == "String") & ~binary
    is_text = (np.isin(kinds, ["String", "Decimal", "Date", "Time"]) | stamped) & ~binary & ~foreign
    text, broken = _utf8_or_bytes(_slices(data, start, size, cells(is_text)))
    is_raw = cells((kinds == "Bytes") | binary & (kinds != "Json")) | broken
    if foreign.any():
        where, found, unread = _foreign_texts(columns, image, data, foreign)
        text = _put(text, where, found)
        is_raw[unread] = True
    json = np.flatnonzero(cells(kinds == "Json"))
    if len(json) and not forms.raw_json:
        found, unread = json_texts(data, start[json], size[json])
        text = _put(text, json, found)
        json = json[unread]
    is_raw[json] = True
    raw = _slices(data, start, size, is_raw)
    return pa.StructArray.from_arrays([u64, i64, f64, text, raw], fields=list(_VALUE))


def _columns_array(columns: tuple[ColumnDef, ...], image: _Image, data: np.ndarray, forms: Forms) -> pa.Array:
    """List of column structs per row."""
    rows, count = image.null.shape
    tile = pa.array(np.tile(np.arange(count, dtype=np.int32), rows))
    fixed = [
        pa.array([c.name for c in columns], pa.string()),
        pa.array([c.is_nullable for c in columns], pa.bool_()),
        pa.array([forms.column_type(c) for c in columns], pa.string()),
        pa.array([c.type_name for c in columns], pa.string()),
    ]
    arrays = [a.take(tile) for a in fixed] + [_values(columns, image, data, forms)]
    cols = pa.StructArray.from_arrays(arrays, fields=list(_COL))
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * count), cols)


class _Envelope:
    """Both images whole, as arrays of column structs."""

    names = ["columns", "identity"]
    types = [pa.list_(_COL)] * 2

    def __init__(self, forms: Forms):
        self.forms = forms

    def wants(self, op: str) -> bool:
        return True

    def arrays(self, op: str, layouts: list[tuple[ColumnDef, ...]], images: list[_Image], data: np.ndarray) -> list[pa.Array]:
        built = [_columns_array(columns, image, data, self.forms) for columns, image in zip(layouts, images)]
        nothing = pa.nulls(len(images[0].null), self.types[0])
        return [built[-1] if op != "delete" else nothing, built[0] if op != "insert" else nothing]


class _Flat:
    """Chosen columns of one image, a value struct each, null if absent."""

    def __init__(self, wanted: list[str], image: str, raw: list[str] | tuple = (), texts: list[str] | tuple = ()):
        self.wanted, self.image = wanted, image
        self.forms = {n: Forms(raw_json=n in raw, raw_text=n in raw, texts=n in texts) for n in wanted}
        self.names = [f"_{i}" for i in range(len(wanted))]
        self.types = [_VALUE] * len(wanted)

    def wants(self, op: str) -> bool:
        return op != ("delete" if self.image == "columns" else "insert")

    def arrays(self, op: str, layouts: list[tuple[ColumnDef, ...]], images: list[_Image], data: np.ndarray) -> list[pa.Array]:
        image, columns = (images[-1], layouts[-1]) if self.image == "columns" else (images[0], layouts[0])
        at = {c.name: j for j, c in enumerate(columns)}
        rows = len(image.null)
        return [
            _values((columns[at[n]],), image.column(at[n]), data, self.forms[n]) if n in at else pa.nulls(rows, _VALUE)
            for n in self.wanted
        ]


@dataclass
class _Events:
    """Rows of a batch that decode together, with the names of their tables."""

    batch: pa.RecordBatch
    keep: list[str]
    layout: _Envelope | _Flat
    rows: np.ndarray
    op: str
    schemas: pa.Array
    tables: pa.Array

    def result(self, which: np.ndarray, row_no, arrays, error) -> pa.RecordBatch:
        at = pa.array(which)
        rows = pa.array(self.rows[which])
        columns = [self.batch.column(k).take(rows) for k in self.keep] + [
            pa.array(row_no, pa.int32()), pa.nulls(len(which), pa.string()).fill_null(self.op),
            self.schemas.take(at), self.tables.take(at), *arrays, pa.array(error, pa.string()),
        ]
        names = [*self.keep, "row_no", "op", "schema", "table", *self.layout.names, "error"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def unusable(self, which: np.ndarray, why: list[str]) -> pa.RecordBatch:
        n = len(which)
        return self.result(which, np.zeros(n, np.int32), [pa.nulls(n, t) for t in self.layout.types], why)


def _decode_group(group: _Group, events: _Events, extras: bool) -> Iterator[pa.RecordBatch]:
    every = np.arange(len(events.rows))
    unknown = [f"{c.name} ({c.type_name})" for c in group.columns if c.definition is None]
    if unknown:
        yield events.unusable(every, ["unsupported column type: " + ", ".join(unknown)] * len(every))
        return
    images = 2 if events.op == "update" else 1
    present = group.open(extras, images)
    # images may leave columns out; events whose images have the same ones go together
    good = group._good()
    packed = np.packbits(present[good].reshape(len(good), images * len(group.columns)), axis=1)
    shapes, which = np.unique(packed, axis=0, return_inverse=True) if len(good) else (packed, np.empty(0, np.int64))
    found = []
    for shape in range(len(shapes)):
        chosen = good[which.ravel() == shape]
        layouts = [tuple(c for c, there in zip(group.columns, present[chosen[0], i]) if there) for i in range(images)]
        found.append((layouts, *group.row_starts(layouts, chosen)))
    bad = np.flatnonzero(group.error != None)  # noqa: E711
    if len(bad):
        yield events.unusable(bad, group.error[bad].tolist())
    if not events.layout.wants(events.op):
        return
    for layouts, of_event, number, starts in found:
        if not len(starts):
            continue
        whole = [group.read(starts[i::images], layouts[i]) for i in range(images)]
        text = np.concatenate([group.data, *group.scratch]) if group.scratch else group.data
        arrays = events.layout.arrays(events.op, layouts, whole, text)
        rows = of_event[::images]
        yield events.result(rows, number[::images] // images, arrays, pa.nulls(len(rows), pa.string()))


def _op(event_type: int) -> str:
    return "update" if event_type in UPDATES else "delete" if event_type in DELETES else "insert"


def _body_bytes(body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the offsets of its values, whichever
    width of offsets the session asks of Arrow."""
    wide = pa.types.is_large_binary(body.type)
    offsets = np.frombuffer(body.buffers()[1], np.int64 if wide else np.int32)
    raw = body.buffers()[2]
    whole = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return whole, offsets[body.offset : body.offset + len(body) + 1].astype(np.int64)


def _parsed(body: bytes, parsed: dict[bytes, TableMap | str]) -> TableMap | str:
    """A table map, or why it cannot be read; each distinct body once per task."""
    if body not in parsed:
        try:
            parsed[body] = parse_table_map(body)
        except ValueError as e:
            parsed[body] = str(e)
    return parsed[body]


def _decode_batch(
    batch: pa.RecordBatch, keep: list[str], layout: _Envelope | _Flat, parsed: dict[bytes, TableMap | str]
) -> Iterator[pa.RecordBatch]:
    whole, offsets = _body_bytes(batch.column("body"))
    coded = batch.column("table_map").dictionary_encode()
    maps = [_parsed(m, parsed) for m in coded.dictionary.to_pylist()]
    named = [m if isinstance(m, TableMap) else None for m in maps]
    code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    # tables with equal columns decode together; what cannot be read, by reason
    alike: dict[object, int] = {}
    kinds = [alike.setdefault(m.columns if isinstance(m, TableMap) else m, len(alike)) for m in maps]
    kind = np.array([*kinds, -1], np.int64)[code]
    types = batch.column("event_type").to_numpy(zero_copy_only=False)
    # 0 insert, 1 update, 2 delete; events of one shape decode together.
    shape = np.isin(types, UPDATES) + 2 * np.isin(types, DELETES) + 3 * np.isin(types, WITH_EXTRAS)
    chunk = (offsets[:-1] - offsets[0]) // CHUNK_BYTES
    order = np.lexsort((shape, kind, chunk))
    key = np.stack([chunk, kind, shape], axis=1)[order]
    cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
    schemas = pa.array([*(m and m.schema for m in named), None], pa.string())
    tables = pa.array([*(m and m.table for m in named), None], pa.string())
    for rows in np.split(order, cuts) if len(order) else ():
        event_type, which = int(types[rows[0]]), int(code[rows[0]])
        at = pa.array(np.where(code[rows] < 0, len(maps), code[rows]))
        events = _Events(batch, keep, layout, rows, _op(event_type), schemas.take(at), tables.take(at))
        table = maps[which] if which >= 0 else "no table map before the row event"
        if isinstance(table, str):
            yield events.unusable(np.arange(len(rows)), [table] * len(rows))
            continue
        size = offsets[rows + 1] - offsets[rows]
        ends = np.cumsum(size)
        data = whole[np.repeat(offsets[rows] - (ends - size), size) + np.arange(ends[-1])]
        yield from _decode_group(_Group(data, ends - size, ends, table.columns), events, event_type in WITH_EXTRAS)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join small batches, so that each table has many events per step."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _decoded(row_events: DataFrame, layout: _Envelope | _Flat, spark_types: list[T.DataType]) -> DataFrame:
    keep = [c for c in row_events.columns if c not in ("event_type", "body", "table_map", "op")]
    schema = StructType([row_events.schema[c] for c in keep]).add("row_no", T.IntegerType())
    for name in ("op", "schema", "table"):
        schema = schema.add(name, T.StringType())
    for name, kind in zip(layout.names, spark_types):
        schema = schema.add(name, kind)
    schema = schema.add("error", T.StringType())

    def decode(batches):
        parsed = {}  # table maps seen by this task
        for batch in _merged(batches):
            yield from _decode_batch(batch, keep, layout, parsed)

    return row_events.select(*keep, "event_type", "body", "table_map").mapInArrow(decode, schema)


def decode_rows(row_events: DataFrame, raw_json: bool = False, texts: bool = False) -> DataFrame:
    """Row events with their table map, as one row per changed row.

    Input needs ``event_type, body, table_map``; all other columns pass through.
    Adds ``row_no`` within the event, ``op``, names, the after image as
    ``columns``, the before image as ``identity`` (columns that an image leaves out
    are not in it, unlike nulls), and ``error``: an event that
    cannot be decoded gives one row with the reason and no images. JSON columns
    arrive as text, or as stored with ``raw_json``. Character columns are read by
    their charset; TEXT columns stay bytes unless ``texts``.
    """
    return _decoded(row_events, _Envelope(Forms(raw_json=raw_json, texts=texts)), [T.DataType.fromDDL(COLUMNS)] * 2)


def decode_columns(
    row_events: DataFrame, wanted: list[str], image: str = "columns", raw: list[str] | None = None, texts: list[str] | None = None
) -> DataFrame:
    """As ``decode_rows``, but only the ``wanted`` columns of one image leave
    the decoder, as values ``_0, _1, ...``: a tenth of the data to hand over
    when one table is read. JSON and character columns named in ``raw`` stay as
    stored; TEXT columns named in ``texts`` are text."""
    return _decoded(row_events, _Flat(wanted, image, raw or (), texts or ()), [T.DataType.fromDDL(VALUE)] * len(wanted))
