"""Compressed transactions: one packet that holds all events of a transaction.

The events inside are whole but for the OK byte, a checksum and a position of their
own. They become packets of the capture before anything else looks at it, so table
maps, marks and rows among them are found like all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import names
from tidemark.functions.bytes import byte_is
from tidemark.operators import binlog
from tidemark.operators.tablemap import _Cursor

HEADER = 19
BATCH_BYTES = 4 << 20
CAPTURE = "source STRING, seq BIGINT, packet BINARY"
PAYLOAD = names.EVENT_CODE["TRANSACTION_PAYLOAD_EVENT"]
# Fields ahead of the payload, and kinds of compression.
END, COMPRESSION = 0, 2
ZSTD, PLAIN = 0, 255


def _is_payload() -> Column:
    """Sound packets of this type; others keep the reason why they are not."""
    return byte_is(F.col("packet"), 1, 0x00) & byte_is(F.col("packet"), 6, PAYLOAD) & (F.length("packet") >= binlog.BODY_AT)


def _events(packet: bytes) -> Iterator[bytes]:
    """The packets of the events inside, at the position of the packet around them.
    Decompressed as a stream, so memory holds one event. ValueError where it is damaged."""
    if len(packet) - 1 != int.from_bytes(packet[10:14], "little"):
        raise ValueError("packet cut short")
    c = _Cursor(packet)
    c.take(1 + HEADER)
    compression = ZSTD
    while (kind := c.lenc()) != END:
        value = _Cursor(c.take(c.lenc()))
        if kind == COMPRESSION:
            compression = value.lenc()
    if compression not in (ZSTD, PLAIN):
        raise ValueError(f"unknown compression {compression}")
    stream = pa.BufferReader(packet[c.at :])
    if compression == ZSTD:
        stream = pa.CompressedInputStream(stream, "zstd")
    while header := stream.read(HEADER):
        size = int.from_bytes(header[9:13], "little")
        body = stream.read(size - HEADER) if size > HEADER else b""
        if len(header) < HEADER or size < HEADER or HEADER + len(body) != size:
            raise ValueError("payload cut short")
        yield b"\0" + header[:13] + packet[14:18] + header[17:] + body


def _count(packet: bytes) -> int | None:
    """Events inside, null where the payload cannot be read."""
    try:
        return sum(1 for _ in _events(packet))
    except (ValueError, OSError):  # Arrow reports damaged streams as OSError
        return None


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_count(p.as_py()) for p in batch.column("packet")]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["events"])


def stride(capture: DataFrame) -> int:
    """The power of two that holds the events of the largest payload, at least 1. One
    read of the capture and one pass over the payloads; nothing but the maximum
    reaches the driver."""
    most = capture.filter(_is_payload()).select("packet").mapInArrow(_counted, "events BIGINT").agg(F.max("events")).first()[0]
    return 1 << (max(most or 1, 1) - 1).bit_length()


def unpacked(capture: DataFrame, step: int | None = None) -> DataFrame:
    """The capture with the events of compressed transactions in their place.

    ``seq`` becomes ``seq * step`` plus the event's number in its packet, so that order
    holds; ``seq div step`` leads back. ``step`` is measured (see ``stride``) unless
    given; streams give one for all batches. A payload with more events than that
    raises, as does a ``seq`` that no longer fits. A payload that cannot be read stays as
    it is, and goes to quarantine as row changes that are not decoded. Packets must have
    no checksums (see ``plain_packets``).
    """
    step = stride(capture) if step is None else step

    def unpack(batches):
        for batch in batches:
            rows = ([], [], [])
            size = 0

            def flush():
                out = pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names=["source", "seq", "packet"]
                )
                for column in rows:
                    column.clear()
                return out

            for i in range(batch.num_rows):
                source, seq, packet = (batch.column(n)[i].as_py() for n in ("source", "seq", "packet"))
                count = _count(packet)  # all of it, before any of it is handed over
                if count is not None and count > step:
                    raise ValueError(f"{count} events in a payload, more than the step of {step}")
                for number, event in enumerate([packet] if count is None else _events(packet)):
                    for column, value in zip(rows, (source, seq * step + number, event)):
                        column.append(value)
                    size += len(event)
                    if size >= BATCH_BYTES:
                        yield flush()
                        size = 0
            yield flush()

    columns = ["source", "seq", "packet"]
    inside = capture.filter(_is_payload()).select(*columns).mapInArrow(unpack, CAPTURE)
    others = capture.filter(~F.coalesce(_is_payload(), F.lit(False)))
    return others.select("source", (F.col("seq") * F.lit(step).cast("bigint")).alias("seq"), "packet").unionByName(inside)
