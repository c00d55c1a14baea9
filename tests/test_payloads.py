import pytest

import capture_fixtures as fx
from tests.helpers import capture, inserts, table_map
from tidemark.operators import payloads
from tidemark.plans import mysql

COLUMNS = [("k", "bigint", False)]


def events(*rows):
    return [table_map(COLUMNS), inserts(COLUMNS, *[[r] for r in rows])]


def test_events_take_the_place_of_their_packet(spark):
    first, second = events(1, 2), events(3)
    c = capture(spark, fx.payload(first, position=70), *second, fx.payload(second * 2, zstd=False), start=-1)
    assert payloads.stride(c) == 4
    found = payloads.unpacked(c).orderBy("seq").collect()
    assert [r.seq for r in found] == [-4, -3, 0, 4, 8, 9, 10, 11]
    assert [bytes(r.packet) for r in found[2:]] == second * 3
    assert bytes(found[1].packet) == first[1][:14 + 0] + (70).to_bytes(4, "little") + first[1][18:]
    rows = mysql.row_events(payloads.unpacked(c)).orderBy("seq", "row_no").collect()
    assert [(r["columns"][0].value.i64, r.cursor.pos) for r in rows] == [(1, 70), (2, 70), (3, 0), (3, 0), (3, 0)]


def test_damaged_payloads_stay(spark):
    good = fx.payload(events(1), zstd=True)
    plain = fx.payload(events(1), zstd=False)
    bad = [
        fx.packet(40, good[20:-4]), fx.packet(40, plain[20:-4]), fx.packet(40, b""), fx.packet(40, b"\2\1\7\0" + good[20:]),
        good[:-3], fx.packet(40, b"\0" + bytes(19)),
    ]
    c = capture(spark, *bad, None, b"", b"\xff")
    assert payloads.stride(c) == 1
    found = payloads.unpacked(c).orderBy("seq").collect()
    assert [None if r.packet is None else bytes(r.packet) for r in found] == [*bad, None, b"", b"\xff"]
    reasons = [r.error for r in mysql.quarantined(payloads.unpacked(c)).orderBy("seq").collect()]
    assert reasons[:4] == ["row changes not decoded"] * 4 and reasons[4] == "packet cut short" and len(reasons) == 9


def test_empty_and_too_small_a_step(spark):
    c = capture(spark, fx.payload([]), fx.payload(events(1)))
    assert [r.seq for r in payloads.unpacked(c, 8).orderBy("seq").collect()] == [8, 9]
    with pytest.raises(Exception, match="more than the step"):
        payloads.unpacked(c, 1).collect()
    assert payloads.stride(c.limit(0)) == 1 and payloads.unpacked(c.limit(0)).count() == 0


def test_large_payload_leaves_in_parts(spark, monkeypatch):
    monkeypatch.setattr(payloads, "BATCH_BYTES", 100)
    c = capture(spark, fx.payload(events(*range(50)) * 20))
    assert mysql.row_events(payloads.unpacked(c)).count() == 1000
