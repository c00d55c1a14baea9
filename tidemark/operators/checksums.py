"""Checksums of binlog packets, as each file's format description asks for them.

The last five bytes of a format description are the algorithm of its file and its
own checksum. The algorithms are states like table maps, so a file may change it;
every packet is looked up by the as-of join and verified by built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import names
from tidemark.functions.bytes import byte_is, int_le, slice_bytes, utf8
from tidemark.operators import asof, binlog

# Algorithm codes, and the first server version that knows them.
OFF, CRC32 = 0, 1
FIRST_VERSION = (5, 6, 1)
NONE = -1  # stands for a server that knows no checksums
WIDTH = 4
DIFFERS = "checksum differs"


def _differs(packet: Column) -> Column:
    """The checksum covers all but itself and the OK byte."""
    size = F.length(packet)
    return F.crc32(slice_bytes(packet, 2, size - 1 - WIDTH)) != int_le(packet, size - WIDTH + 1, WIDTH)


def _is_format(packet: Column) -> Column:
    return byte_is(packet, 1, 0x00) & byte_is(packet, 6, names.FORMAT_DESCRIPTION)


def _declared(packet: Column) -> Column:
    """What a format description says: an algorithm, or ``NONE``."""
    size = F.length(packet)
    version = F.regexp_extract_all(utf8(slice_bytes(packet, binlog.BODY_AT + 2, 50)), F.lit(r"^(\d+)\.(\d+)\.(\d+)"), F.lit(0))
    parts = F.transform(F.split(F.get(version, F.lit(0)), r"\."), lambda x: x.cast("int"))
    knows = F.coalesce(parts >= F.array(*map(F.lit, FIRST_VERSION)), F.lit(False))
    code = int_le(packet, size - WIDTH, 1).cast("int")
    return F.when(knows & code.isin(OFF, CRC32), code).otherwise(NONE)


def algorithms(capture: DataFrame) -> asof.Intervals:
    """The algorithm in force per source and ``seq``. A format description that fails
    its own checksum says nothing."""
    packet = F.col("packet")
    formats = capture.filter(_is_format(packet) & (F.length(packet) >= binlog.BODY_AT + 56))
    said = formats.select("source", "seq", "packet", _declared(packet).alias("algorithm"))
    sound = said.filter((F.col("algorithm") != CRC32) | ~_differs(packet)).select("source", "seq", "algorithm")
    points = asof.change_points(sound, ["source"], "algorithm")
    return asof.measured(asof.intervals(points, ["source"], ["algorithm"]), ["source"], ["algorithm"])


def with_checksums(capture: DataFrame, found: asof.Intervals) -> DataFrame:
    """Packets with ``checksum_len``, the bytes of their checksum, and ``error``.

    Format descriptions of servers that know checksums have one in any case. Before
    the first of them a packet has one if it matches. Packets that no header can be
    read from keep that reason and are taken to have none.
    """
    packet = F.col("packet")
    broken = binlog._packet_error(0)
    own = _is_format(packet)
    declared = F.when(own, _declared(packet)).otherwise(F.col("algorithm"))
    length = (
        F.when(broken.isNotNull(), 0)
        .when(declared == CRC32, WIDTH)
        .when(own & (declared == OFF), WIDTH)
        .when(declared.isNull() & (F.length(packet) >= binlog.BODY_AT - 1 + WIDTH) & ~_differs(packet), WIDTH)
        .otherwise(0)
    )
    wrong = (declared == CRC32) & ((F.length(packet) < binlog.BODY_AT - 1 + WIDTH) | _differs(packet))
    error = F.coalesce(broken, F.when(wrong, DIFFERS))
    joined = asof.asof_join(capture, found)
    return joined.withColumn("checksum_len", length).withColumn("error", error).drop("algorithm")


def _without(packet: Column) -> Column:
    """The packet less its checksum, with the size in its header set right."""
    size = F.length(packet)
    big = F.unhex(F.lpad(F.hex((size - 1 - WIDTH).cast("bigint")), 8, "0"))
    little = F.concat(*[slice_bytes(big, i, 1) for i in (4, 3, 2, 1)])
    return F.concat(slice_bytes(packet, 1, 10), little, slice_bytes(packet, 15, size - WIDTH - 14))


def plain_packets(capture: DataFrame, found: asof.Intervals | None = None, on_error: str = "fail") -> DataFrame:
    """The capture with checksums verified and taken off, so that all else reads it
    without knowing of them. A packet whose checksum differs stops a ``fail`` run and
    is left out by ``skip``; packets without a readable header stay as they are, for
    the decoders to name."""
    found = algorithms(capture) if found is None else found
    marked = with_checksums(capture, found)
    bad = F.col("error").eqNullSafe(F.lit(DIFFERS))
    if on_error == "fail":
        marked = marked.filter(F.when(bad, F.raise_error(F.lit(DIFFERS)).cast("boolean")).otherwise(True))
    elif on_error == "skip":
        marked = marked.filter(~bad)
    else:
        raise ValueError(f"on_error must be fail or skip, not {on_error!r}")
    return marked.select(
        "source", "seq", F.when(F.col("checksum_len") == WIDTH, _without(F.col("packet"))).otherwise(F.col("packet")).alias("packet")
    )


def damaged(capture: DataFrame, found: asof.Intervals | None = None) -> DataFrame:
    """Packets whose checksum differs, in the shape of ``packet_quarantine``."""
    found = algorithms(capture) if found is None else found
    marked = with_checksums(capture, found)
    return marked.filter(F.col("error") == DIFFERS).select("source", "seq", "error", "packet")
