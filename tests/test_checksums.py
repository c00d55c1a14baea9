import struct

import pytest

import capture_fixtures as fx
from tests.helpers import capture
from tidemark.operators import binlog, checksums


def seal(kind, body, **header):
    return fx.sealed(fx.packet(kind, body, checksum=b"\0" * 4, **header))


def description(algorithm, version=b"8.0.36"):
    return seal(fx.FORMAT, struct.pack("<H50sIB", 4, version, 0, 19) + bytes(range(41)) + bytes([algorithm]))


XID = struct.pack("<Q", 7)


def marked(spark, *packets):
    c = capture(spark, *packets)
    rows = checksums.with_checksums(c, checksums.algorithms(c)).orderBy("seq").collect()
    return [(r.checksum_len, r.error) for r in rows]


def test_algorithm_changes_with_the_file(spark):
    good, plain = seal(fx.XID, XID), fx.packet(fx.XID, XID)
    bad = good[:25] + b"!" + good[26:]
    found = marked(spark, good, plain, description(1), good, bad, description(0), plain, bad, description(1), plain)
    assert found == [
        (4, None), (0, None), (4, None), (4, None), (4, checksums.DIFFERS), (4, None), (0, None), (0, None), (4, None), (4, checksums.DIFFERS)
    ]


def test_server_without_checksums(spark):
    old = fx.packet(fx.FORMAT, struct.pack("<H50sIB", 4, b"5.5.62-log", 0, 19) + bytes(27))
    assert marked(spark, old, fx.packet(fx.XID, XID)) == [(0, None)] * 2
    assert marked(spark, description(1, b"10.6.12-MariaDB"), fx.packet(fx.XID, XID))[1] == (4, checksums.DIFFERS)


def test_damaged_description_says_nothing(spark):
    bad = description(1)
    bad = bad[:30] + b"!" + bad[31:]
    found = marked(spark, description(0), bad, fx.packet(fx.XID, XID))
    assert found == [(4, None), (4, checksums.DIFFERS), (0, None)]


def test_unreadable_packets_keep_their_reason(spark):
    found = marked(spark, description(1), b"", None, b"\xff\x01", seal(fx.XID, XID)[:-2], fx.packet(fx.XID, b""))
    assert found[1:] == [
        (0, "empty packet"), (0, "empty packet"), (0, "server error packet"), (0, "packet cut short"), (4, checksums.DIFFERS)
    ]


def test_plain_packets_read_as_without_checksums(spark):
    good = seal(fx.XID, XID, timestamp=5, position=9)
    c = capture(spark, description(1), good, good[:25] + b"!" + good[26:], fx.rotate("bin.2"))
    packets = checksums.plain_packets(c, on_error="skip")
    assert bytes(packets.filter("seq = 1").first().packet) == fx.packet(fx.XID, XID, timestamp=5, position=9)
    assert [int(r.xid) for r in binlog.xids(packets).collect()] == [7]
    assert binlog.packet_quarantine(packets).count() == 0
    assert [(r.seq, r.error) for r in checksums.damaged(c).orderBy("seq").collect()] == [(2, checksums.DIFFERS), (3, checksums.DIFFERS)]
    with pytest.raises(Exception, match=checksums.DIFFERS):
        checksums.plain_packets(c).collect()
    with pytest.raises(ValueError):
        checksums.plain_packets(c, on_error="keep")
    assert checksums.plain_packets(c.limit(0)).count() == 0
