"""Interval sets against sets of numbers."""

import random

import pytest
from pyspark.sql import functions as F

import capture_fixtures as fx
from tests.test_captures import tables
from tidemark.operators import binlog, gtids
from tidemark.sources import captures


def numbers(df):
    return {(r.server_uuid, n) for r in df.collect() for n in range(r.lo, r.hi)}


def normal(df):
    """No two intervals of a server overlap or touch."""
    rows = sorted((r.server_uuid, r.lo, r.hi) for r in df.collect())
    return all(lo < hi for _, lo, hi in rows) and all(a[0] != b[0] or a[2] < b[1] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("seed,bits", [(0, 16), (1, 3)])
def test_set_operations(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(gtids, "RANGE_BITS", bits)
    rng = random.Random(seed)

    def made():
        rows = []
        for _ in range(60):
            lo = rng.randrange(1, 400)
            rows.append((rng.choice("ab"), lo, lo + rng.choice([0, 1, 1, 2, 9, 40])))
        return spark.createDataFrame(rows, gtids.SET)

    a, b = made(), made()
    left, right = gtids.merged(a), gtids.merged(b)
    assert numbers(left) == numbers(a) and normal(left)
    whole, rest = gtids.union(left, right), gtids.subtract(left, right)
    assert numbers(whole) == numbers(a) | numbers(b) and normal(whole)
    assert numbers(rest) == numbers(a) - numbers(b) and normal(rest)
    rows = spark.createDataFrame([(s, n, 7) for s in "abc" for n in range(1, 450)], "server_uuid string, gno bigint, seq bigint")
    found = gtids.in_set(rows, left).collect()
    assert {(r.server_uuid, r.gno) for r in found if r.in_set} == numbers(a) and len(found) == 3 * 449 and {r.seq for r in found} == {7}


def test_sets_as_text(spark):
    found = gtids.parse_set(spark, "AA:1-3:4:9,\n bb:5-5 , aa:10")
    assert sorted(map(tuple, found.collect())) == [("aa", 1, 5), ("aa", 9, 11), ("bb", 5, 6)]
    assert gtids.parse_set(spark, "").collect() == []


def test_cut_and_empty_bodies(spark):
    good = fx.previous_gtids_body({0: [(1, 5)], 2: [(1, 2), (9, 12)]})
    packets = [fx.packet(35, b) for b in (good, good[:-1], good[:30], fx.previous_gtids_body({}), b"\xff" * 8, good + b"x")] + [fx.packet(33, b"\0" * 20)]
    capture = spark.createDataFrame([("s", i, p) for i, p in enumerate(packets)], captures.BINLOG_CAPTURE)
    found = sorted((r.seq, r.server_uuid[:2], r.lo, r.hi) for r in gtids.previous_gtids(capture).collect())
    assert found == [(0, "01", 1, 5), (0, "03", 1, 2), (0, "03", 9, 12)]
    assert gtids.gtids(capture).collect() == []
    assert gtids.gtid_progress(capture).collect() == []


def test_ids_before_an_order():
    """The same, an interval at a time."""
    number = lambda k: fx.gtid_of(k)[1]
    for k in (5000, 10000, 54_000_000):
        blocks = range(0, k, 1500)
        for s, found in fx._ids_before(k).items():
            assert found.tolist() == [[number(max(b, s) + (s - b) % 3), (min(b + 1500, k) - 1 - s) // 3 + 2 + b // 1500 * 10] for b in blocks]
    assert fx._ids_before(0) == {}


def test_marks_and_ids_come_from_one_read(spark, tmp_path):
    """Events, marks, and the count of both: no packet is read more than three times."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = fx.gtid_capture(spark, tables(tmp_path, list(range(60)))).collect()
    capture = spark.createDataFrame(made, captures.BINLOG_CAPTURE).mapInArrow(counted, captures.BINLOG_CAPTURE)
    events = binlog.headers(capture).select("source", "seq", F.lit(0).alias("row_no"))
    have = gtids.parse_set(spark, "01010101-0101-0101-0101-010101010101:1-5")
    found = {r.seq for r in gtids.gtid_resume(events, capture, have, places=capture).collect()}
    # order 0 is anonymous
    assert found == {r.seq for r in made} - {k * 10 + slot for k in (3, 6, 9, 12) for slot in (3, 4, 5, 6)}
    assert seen.value <= 3 * len(made)
