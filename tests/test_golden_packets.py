"""Packets recorded from a server, with the values they are known to hold."""

import datetime
import decimal

import pytest

from tidemark.operators import binlog
from tidemark.plans import mysql

# Recorded packet bytes.
ROTATE = b"\x00" + bytes(4) + b"\x04\x01\0\0\0\x2d\0\0\0\0\0\0\0\x20\0\x96" + bytes(7) + b"shopify-bin.000005"
STAMP = b"\xfc\x5a\x5d\x5d"
TABLE_MAP = (
    b"\0" + STAMP + b"\x13\x01\0\0\0\x32\0\0\0\x49\x01\0\0\0\0\x2d\x0a\0\0\0\0\x01\0\x04pets\0\x04cats\0"
    b"\x04\x03\x0f\x0f\x0a\x04\x58\x02\x58\x02\x00"
)
INSERT = (
    b"\0" + STAMP + b"\x1e\x01\0\0\0\x37\0\0\0\x80\x01\0\0\0\0\x2d\x0a\0\0\0\0\x01\0\x02\0\x04\xff\xf0\x04"
    b"\0\0\0\x07\0Charlie\x05\0River\xb5\xc0\x0f"
)
XID = b"\0" + STAMP + b"\x10\x01\0\0\0\x1b\0\0\0\x9b\x01\0\0\0\0\x72\x0e" + bytes(6)
QUERY = (
    b"\0" + STAMP + b"\x02\x01\0\0\0\x44\0\0\0\x17\x01\0\0\x08\0\x3b\x18\0\0\0\0\0\0\x04\0\0\x1a\0\0\0\0\0\0\x01\0\0\0\x40"
    b"\0\0\0\0\x06\x03std\x04\x21\0\x21\0\x2d\0pets\0BEGIN"
)
ANONYMOUS_GTID = (
    b"\0" + STAMP + b"\x22\x01\0\0\0\x3d\0\0\0\xd3\0\0\0\0\0\x01" + bytes(24) + b"\x02" + bytes(8) + b"\x01" + bytes(7)
)
FORMAT_DESCRIPTION = (
    b"\0\xf2\x43\x5d\x5d\x0f\x01\0\0\0\x77" + bytes(9) + b"\x04\x005.7.18-16-log" + bytes(41)
    + b"\x13\x38\x0d\0\x08\0\x12\0\x04\x04\x04\x04\x12\0\0\x5f\0\x04\x1a\x08\0\0\0\x08\x08\x08\x02\0\0\0\x0a\x0a\x0a\x2a\x2a"
    b"\0\x12\x34\0\0\xc2\x36\x0c\xdf"
)
ALL = [ROTATE, FORMAT_DESCRIPTION, ANONYMOUS_GTID, QUERY, TABLE_MAP, INSERT, XID]


@pytest.fixture(scope="module")
def capture(spark):
    return spark.createDataFrame([("s", i, p) for i, p in enumerate(ALL)], "source STRING, seq BIGINT, packet BINARY")


def test_headers(capture):
    rows = binlog.with_names(binlog.headers(capture)).orderBy("seq").collect()
    assert [r.event_type for r in rows] == [4, 15, 34, 2, 19, 30, 16]
    assert [r.log_position for r in rows] == [0, 0, 211, 279, 329, 384, 411]
    assert [r.flags for r in rows] == [32, 0, 0, 8, 0, 0, 0]
    assert {r.server_id for r in rows} == {1}
    assert rows[4].event_time == datetime.datetime(2019, 8, 21, 14, 53, 48)
    assert rows[3].route == "not_supported" and rows[2].route == "anonymous_gtid"


def test_simple_events(capture):
    rotate = binlog.rotates(capture).first()
    assert (rotate.next_log_position, rotate.next_log_file) == (150, "shopify-bin.000005")
    assert binlog.xids(capture).first().xid == decimal.Decimal(3698)
    format_ = binlog.format_descriptions(capture).first()
    assert (format_.version, format_.server_version, format_.create_timestamp) == (4, "5.7.18-16-log", 0)
    assert format_.event_header_length == 19
    marker = binlog.gtid_markers(capture).first()
    assert marker.marker == "anonymous_gtid" and len(marker.body) == 42
    head = binlog.row_event_headers(capture).first()
    assert (head.op, head.table_id, head.flags, head.extras_length, head.column_count) == ("insert", 2605, 1, 0, 4)


def test_insert_row(capture):
    event = mysql.row_events(capture).first()
    assert (event.op, event.schema, event.table) == ("insert", "pets", "cats")
    assert event.cursor.file == "shopify-bin.000005" and event.cursor.pos == 384
    assert [c.name for c in event["columns"]] == ["c0", "c1", "c2", "c3"]
    values = [c.value for c in event["columns"]]
    assert [values[0].i64, values[1].str, values[2].str, values[3].str] == [4, "Charlie", "River", "2016-05-21"]
    assert [c.column_type for c in event["columns"]] == ["I64", "String", "String", "Date"]
    assert event.identity is None


def test_checksum_is_cut_off(spark):
    sized = lambda p: p[:10] + (len(p) + 3).to_bytes(4, "little") + p[14:] + b"\xaa\xbb\xcc\xdd"
    packets = [("s", i, sized(p)) for i, p in enumerate([ROTATE, TABLE_MAP, INSERT, XID])]
    capture = spark.createDataFrame(packets, "source STRING, seq BIGINT, packet BINARY")
    event = mysql.row_events(capture, checksum_len=4).first()
    assert event["columns"][1].value.str == "Charlie" and event.cursor.file == "shopify-bin.000005"
    assert {bytes(r.checksum) for r in binlog.headers(capture, checksum_len=4).collect()} == {b"\xaa\xbb\xcc\xdd"}
