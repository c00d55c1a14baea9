"""Text in the character sets of the server, whole columns at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Collation ids of each character set.
COLLATIONS = {
    "big5": [1, 84], "dec8": [3, 69], "cp850": [4, 80], "hp8": [6, 72], "koi8r": [7, 74],
    "latin1": [5, 8, 15, 31, 47, 48, 49, 94], "latin2": [2, 9, 21, 27, 77], "swe7": [10, 82], "ascii": [11, 65],
    "ujis": [12, 91], "sjis": [13, 88], "hebrew": [16, 71], "tis620": [18, 89], "euckr": [19, 85],
    "koi8u": [22, 75], "gb2312": [24, 86], "greek": [25, 70], "cp1250": [26, 34, 44, 66, 99], "gbk": [28, 87],
    "latin5": [30, 78], "armscii8": [32, 64], "utf8": [33, 76, 83, *range(192, 216), 223],
    "ucs2": [35, 90, *range(128, 152), 159], "cp866": [36, 68], "keybcs2": [37, 73], "macce": [38, 43],
    "macroman": [39, 53], "cp852": [40, 81], "latin7": [20, 41, 42, 79], "utf8mb4": [45, 46, *range(224, 248), *range(255, 324)],
    "cp1251": [14, 23, 50, 51, 52], "utf16": [54, 55, *range(101, 125)], "utf16le": [56, 62],
    "cp1256": [57, 67], "cp1257": [29, 58, 59], "utf32": [60, 61, *range(160, 184)], "binary": [63],
    "geostd8": [92, 93], "cp932": [95, 96], "eucjpms": [97, 98], "gb18030": [248, 249, 250],
}
CHARSET_OF = {i: name for name, ids in COLLATIONS.items() for i in ids}

# Codecs. Sets without one stay bytes.
SINGLE_BYTE = {
    "cp850": "cp850", "hp8": "hp-roman8", "koi8r": "koi8-r", "latin1": "cp1252", "latin2": "iso8859-2",
    "hebrew": "iso8859-8", "tis620": "tis-620", "koi8u": "koi8-u", "greek": "iso8859-7", "cp1250": "cp1250",
    "latin5": "iso8859-9", "cp866": "cp866", "macce": "mac-latin2", "macroman": "mac-roman", "cp852": "cp852",
    "latin7": "iso8859-13", "cp1251": "cp1251", "cp1256": "cp1256", "cp1257": "cp1257",
}
MULTI_BYTE = {
    "big5": "big5", "ujis": "euc-jp", "sjis": "shift-jis", "euckr": "euc-kr", "gb2312": "gb2312", "gbk": "gbk",
    "ucs2": "utf-16-be", "utf16": "utf-16-be", "utf16le": "utf-16-le", "utf32": "utf-32-be", "cp932": "cp932",
    "eucjpms": "euc-jp", "gb18030": "gb18030",
}
UTF8 = {"utf8", "utf8mb4", "ascii"}
WITHOUT_CODEC = {"dec8", "swe7", "armscii8", "keybcs2", "geostd8"}


def is_foreign(charset: str | None) -> bool:
    """Text that must be transcoded; without a known set it is tried as UTF-8."""
    return charset in SINGLE_BYTE or charset in MULTI_BYTE or charset in WITHOUT_CODEC


_TABLES: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _byte_table(codec: str) -> tuple[np.ndarray, np.ndarray]:
    """Per byte the size of its UTF-8 form, 0 where it has none, and that form."""
    if codec in _TABLES:
        return _TABLES[codec]
    size, form = np.zeros(256, np.int64), np.zeros((256, 3), np.uint8)
    for b in range(256):
        try:
            encoded = bytes([b]).decode(codec).encode()
        except UnicodeDecodeError:
            # the server keeps the gaps of this set as control characters
            encoded = chr(b).encode() if codec == "cp1252" else b""
        size[b] = len(encoded)
        form[b, : len(encoded)] = list(encoded)
    _TABLES[codec] = size, form
    return size, form


def _offsets_and_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def _by_table(values: pa.Array, codec: str) -> tuple[pa.Array, np.ndarray]:
    size, form = _byte_table(codec)
    offsets, data = _offsets_and_bytes(values)
    width = size[data]
    ends = np.concatenate([[0], np.cumsum(width)])
    gaps = np.concatenate([[0], np.cumsum(width == 0)])
    broken = gaps[offsets[1:]] > gaps[offsets[:-1]]
    out = np.empty(ends[-1], np.uint8)
    for i in range(form.shape[1]):
        has = width > i
        out[ends[:-1][has] + i] = form[data[has], i]
    present = ~broken & values.is_valid().to_numpy(zero_copy_only=False)
    valid = pa.py_buffer(np.packbits(present, bitorder="little"))
    text = pa.Array.from_buffers(pa.string(), len(values), [valid, pa.py_buffer(ends[offsets].astype(np.int32)), pa.py_buffer(out)])
    return text, broken


def _by_value(values: pa.Array, codec: str) -> tuple[pa.Array, np.ndarray]:
    """Each distinct value once."""
    coded = values.dictionary_encode()
    found = []
    for v in coded.dictionary.to_pylist():
        try:
            found.append(v.decode(codec))
        except UnicodeDecodeError:
            found.append(None)
    text = pa.array(found, pa.string()).take(coded.indices)
    return text, (values.is_valid().to_numpy(zero_copy_only=False) & ~text.is_valid().to_numpy(zero_copy_only=False))


def transcoded(values: pa.Array, charset: str) -> tuple[pa.Array, np.ndarray]:
    """Binary values of a foreign character set as strings, and which of them hold
    what the set does not; those are null. Sets without a codec leave all values so."""
    if charset in SINGLE_BYTE:
        return _by_table(values, SINGLE_BYTE[charset])
    if charset in MULTI_BYTE:
        return _by_value(values, MULTI_BYTE[charset])
    return pa.nulls(len(values), pa.string()), values.is_valid().to_numpy(zero_copy_only=False)


def text_of(value: bytes, charset: str | None) -> str:
    """One value, with replacement marks for what cannot be read."""
    codec = SINGLE_BYTE.get(charset) or MULTI_BYTE.get(charset) or "utf-8"
    return value.decode(codec, "replace")
