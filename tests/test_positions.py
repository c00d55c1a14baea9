import pytest
from pyspark.sql import functions as F

import capture_fixtures as fx
from tests.helpers import capture
from tidemark.functions import positions as text
from tidemark.operators import asof, binlog, positions
from tidemark.plans import mysql
from tidemark.sources import captures

BIG = 4 + (1 << 32)


def xid(position):
    return fx.packet(fx.XID, b"\1" + b"\0" * 7, 1, position)


def two_files(spark):
    """File 1 ends with a rotate at 800; file 2 is announced and begins."""
    return capture(
        spark, fx.rotate("bin.000001"), xid(400), xid(700), fx.last_rotate("bin.000002", 1, 800),
        fx.rotate("bin.000002", BIG), xid(450), xid(900),
    )


@pytest.fixture
def located(spark):
    packets = two_files(spark)
    state = mysql.log_state(packets)
    return packets, state, asof.with_log_file(binlog.headers(packets), state.files)


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_the_last_rotate_belongs_to_its_file(located):
    _, _, events = located
    labels = {r.seq: (r.log_file, r.log_position) for r in events.collect()}
    assert labels[3] == ("bin.000001", 800) and labels[2] == ("bin.000001", 700)
    assert labels[4] == ("bin.000002", 0) and labels[5] == ("bin.000002", 450)


@pytest.mark.parametrize("cursor,after", [(("bin.000001", 700), [3, 4, 5, 6]), (("bin.000001", 800), [4, 5, 6]), (("bin.000002", 450), [6])])
def test_cursors_split_the_log(located, cursor, after):
    packets, state, events = located
    later = positions.after_binlog_cursor(events, {"s": cursor})
    until = positions.until_binlog_cursor(events, {"s": cursor})
    assert seqs(later) == after and sorted(seqs(until) + after) == list(range(7))
    kept = seqs(positions.packets_after(packets, state.files.df, {"s": cursor}))
    assert set(after) <= set(kept) and set(seqs(until)) <= set(seqs(positions.packets_until(packets, state.files.df, {"s": cursor})))


def test_other_sources_are_kept(located):
    packets, state, events = located
    none = {"other": ("bin.000009", 1)}
    assert positions.packets_after(packets, state.files.df, none).count() == 7
    assert positions.packets_until(packets, state.files.df, none).count() == 7
    assert positions.after_binlog_cursor(events, none).count() == 7


def test_bounds_reach_the_scan(spark, located, tmp_path):
    packets, state, _ = located
    packets.write.parquet(f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/c")
    cursor = {"s": ("bin.000002", 1)}
    for bounded in (
        positions.packets_after(stored, state.files.df, cursor),
        positions.packets_until(stored, state.files.df, {"s": ("bin.000001", 1)}),
    ):
        events = asof.with_log_file(binlog.headers(bounded), state.files)
        plan = events._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "PushedFilters" in line and "packet" in line]
        assert scans and all("seq" in line.split("PushedFilters")[1] for line in scans)


def test_latest_cursor_reads_further_back(spark, monkeypatch):
    monkeypatch.setattr(positions, "TAIL", 1)
    packets = two_files(spark).union(capture(spark, fx.rotate("z.000009"), *[xid(i) for i in range(1, 40)], source="t"))
    packets = packets.union(capture(spark, xid(5), source="u"))
    found = {tuple(r) for r in positions.latest_binlog_cursor(packets).collect()}
    assert found == {("s", "bin.000002", 900), ("t", "z.000009", 39), ("u", None, 5)}
    assert positions.latest_binlog_cursor(packets.limit(0)).count() == 0


def test_wide_values(spark):
    row = spark.range(1).select(
        text.parse_binlog_cursor(F.lit("bin.000001/99999999999")).alias("c"),
        text.parse_wal_cursor(F.lit("123456/1F")).alias("w"),
        text.parse_binlog_cursor(F.lit("bin.000001/99999999999999999999")).alias("bad"),
    ).first()
    assert row.c.log_position == 99999999999 and (row.w.tid, row.w.lsn) == (123456, 31) and row.bad is None
    rotates = binlog.rotates(two_files(spark)).collect()
    assert {r.seq: r.next_log_position for r in rotates} == {0: 4, 3: 4, 4: BIG}


@pytest.mark.parametrize("bits", [(20, 32), (3, 6)])
def test_positions_unwrap_in_log_order(spark, monkeypatch, bits):
    """Files of several times 4 GiB, one that ends in the upper half, short ones."""
    import random

    rng = random.Random(5)
    monkeypatch.setattr(asof, "COLLAPSE_BITS", bits)
    packets, want, seq = [], [], 0
    for number, size in enumerate([9 << 30, 3 << 30, 1 << 20, 13 << 30, 5 << 30]):
        packets.append((seq, fx.rotate(f"bin.{number:06d}")))
        want.append((seq, 0))
        at = 4
        while at < size:
            seq += rng.choice([1, 1, 7])
            at += rng.choice([100, 1 << 20, 200 << 20, 900 << 20])
            packets.append((seq, fx.packet(fx.XID, b"\0" * 8, 1, at % (1 << 32) or 1)))
            want.append((seq, at if at % (1 << 32) else at + 1))
        seq += 1
    capture = spark.createDataFrame([("s", s, p) for s, p in packets], captures.BINLOG_CAPTURE).repartition(4)
    state = mysql.log_state(capture, long_files=True)
    found = positions.with_full_position(binlog.headers(capture), state.epochs).orderBy("seq")
    assert [(r.seq, r.log_position) for r in found.collect()] == want
