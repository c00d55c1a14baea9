"""Integer and text access into BINARY columns.

Everything here is a built-in expression. Positions are 1-based, as in
``substring``, and may be an int or a Column. Callers check lengths first:
``substring`` past the end gives an empty binary rather than an error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _at(pos, offset: int):
    return pos + offset if offset else pos


def slice_bytes(data: Column, pos, length) -> Column:
    if isinstance(pos, int) and isinstance(length, int):
        return F.substring(data, pos, length)
    as_col = lambda v: F.lit(v) if isinstance(v, int) else v.cast("int")
    return F.substring(data, as_col(pos), as_col(length))


def byte_is(data: Column, pos, *values: int) -> Column:
    """True when the byte is one of ``values``; no integer conversion."""
    return slice_bytes(data, pos, 1).isin([F.lit(bytes([v])) for v in values])


def _big_endian_hex(data: Column, pos, size: int, little: bool) -> Column:
    if not little or size == 1:
        return F.hex(slice_bytes(data, pos, size))
    parts = [slice_bytes(data, _at(pos, i), 1) for i in reversed(range(size))]
    return F.hex(F.concat(*parts))


def int_be(data: Column, pos, size: int = 8) -> Column:
    """Big-endian integer as BIGINT; eight bytes are read as signed."""
    return F.conv(_big_endian_hex(data, pos, size, False), 16, -10).cast("bigint")


def int_le(data: Column, pos, size: int) -> Column:
    """Little-endian integer as BIGINT; below eight bytes it is unsigned."""
    return F.conv(_big_endian_hex(data, pos, size, True), 16, -10).cast("bigint")


def uint64_le(data: Column, pos) -> Column:
    """Little-endian u64, which only DECIMAL(20,0) can hold."""
    return F.conv(_big_endian_hex(data, pos, 8, True), 16, 10).cast("decimal(20,0)")


def length_encoded(data: Column, pos) -> Column:
    """Length-encoded integer as ``struct(value, width)``; null on 0xFF."""
    first = int_le(data, pos, 1)
    after = _at(pos, 1)
    value = (
        F.when(first == 0xFC, int_le(data, after, 2).cast("decimal(20,0)"))
        .when(first == 0xFD, int_le(data, after, 3).cast("decimal(20,0)"))
        .when(first == 0xFE, uint64_le(data, after))
        .when(first < 0xFC, first.cast("decimal(20,0)"))
    )
    width = F.when(first == 0xFC, 3).when(first == 0xFD, 4).when(first == 0xFE, 9).when(first < 0xFC, 1)
    return F.struct(value.alias("value"), width.alias("width"))


def utf8(data: Column) -> Column:
    """The bytes as text; null where they are not UTF-8."""
    return F.try_validate_utf8(data.cast("string"))
