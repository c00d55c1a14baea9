"""Small captures, built by hand."""

from __future__ import annotations

import capture_fixtures as fx

CAPTURE = "source STRING, seq BIGINT, packet BINARY"


def capture(spark, *packets, source="s", start=0):
    return spark.createDataFrame([(source, start + i, p) for i, p in enumerate(packets)], CAPTURE)


def table_map(columns, table_id=1, table="t", **options):
    return fx.packet(fx.TABLE_MAP, fx.table_map_body(table_id, "db", table, columns, **options))


def inserts(columns, *rows, table_id=1, version=2):
    images = [fx.row_bytes(columns, r) for r in rows]
    return fx.packet(fx.ROW_TYPES["I"][version], fx.rows_body(table_id, version, columns, images))


def updates(columns, *pairs, table_id=1, version=2):
    images = [fx.row_bytes(columns, r) for pair in pairs for r in pair]
    return fx.packet(fx.ROW_TYPES["U"][version], fx.rows_body(table_id, version, columns, images, True))


def deletes(columns, *rows, table_id=1, version=2):
    images = [fx.row_bytes(columns, r) for r in rows]
    return fx.packet(fx.ROW_TYPES["D"][version], fx.rows_body(table_id, version, columns, images))


def member(cell):
    """The one member set in a value, None for a null."""
    found = [v for v in cell.value.asDict().values() if v is not None]
    assert len(found) <= 1
    return bytes(found[0]) if found and isinstance(found[0], bytearray) else (found[0] if found else None)


def as_dict(image):
    return {c.name: member(c) for c in image}
