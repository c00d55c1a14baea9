import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof


def history(seed, keys=6, length=400):
    """Random states per key, many repeated, some flapping, with gaps in seq."""
    rng = random.Random(seed)
    states, seq = [], 0
    current = {}
    for _ in range(length):
        seq += rng.choice([1, 1, 1, 2, 5, 40])
        key = 0 if rng.random() < 0.4 else rng.randrange(keys)
        if rng.random() < 0.2 or key not in current:
            current[key] = rng.choice("ABC")
        states.append(("s", key, seq, current[key].encode()))
    events = [("s", rng.randrange(keys + 1), q) for q in range(0, seq + 50)]
    return states, events


def brute_change_points(states):
    last, points = {}, set()
    for source, key, seq, state in sorted(states, key=lambda s: s[2]):
        if last.get(key) != state:
            points.add((key, seq, state))
        last[key] = state
    return points


@pytest.mark.parametrize("seed,bits", [(1, (20, 32)), (2, (3, 5)), (3, (1, 2, 4)), (4, (6,))])
def test_change_points(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(asof, "COLLAPSE_BITS", bits)
    states, _ = history(seed)
    df = spark.createDataFrame(states, "source STRING, table_id BIGINT, seq BIGINT, state BINARY").repartition(5)
    points = asof.change_points(df, ["source", "table_id"], "state").collect()
    assert {(p.table_id, p.seq, bytes(p.state)) for p in points} == brute_change_points(states)
    assert len(points) == len(brute_change_points(states))


@pytest.mark.parametrize("shuffle", [False, True])
@pytest.mark.parametrize("seed", [5, 6])
def test_asof_join(spark, shuffle, seed):
    states, events = history(seed)
    df = spark.createDataFrame(states, "source STRING, table_id BIGINT, seq BIGINT, state BINARY")
    keys = ["source", "table_id"]
    iv = asof.measured(asof.intervals(asof.change_points(df, keys, "state"), keys, ["state"]), keys, ["state"])
    left = spark.createDataFrame(events, "source STRING, table_id BIGINT, seq BIGINT")
    joined = asof.asof_join(left, iv, shuffle)
    assert joined.columns == ["source", "table_id", "seq", "state"]
    found = {(r.table_id, r.seq): r.state and bytes(r.state) for r in joined.collect()}
    assert len(found) == len(events)
    for _, key, seq in events:
        before = [s for s in states if s[1] == key and s[2] <= seq]
        assert found[(key, seq)] == (max(before, key=lambda s: s[2])[3] if before else None)


def test_size_check_picks_the_shuffled_join(spark, monkeypatch):
    states, events = history(7)
    df = spark.createDataFrame(states, "source STRING, table_id BIGINT, seq BIGINT, state BINARY")
    keys = ["source", "table_id"]
    iv = asof.measured(asof.intervals(asof.change_points(df, keys, "state"), keys, ["state"]), keys, ["state"])
    left = spark.createDataFrame(events, "source STRING, table_id BIGINT, seq BIGINT")
    assert iv.fits_broadcast
    monkeypatch.setattr(asof, "BROADCAST_ROWS", 10)
    assert not iv.fits_broadcast
    plain, shuffled = (asof.asof_join(left, iv, s) for s in (False, None))
    assert sorted(map(str, plain.collect())) == sorted(map(str, shuffled.collect()))
    assert "BroadcastExchange" not in shuffled._jdf.queryExecution().optimizedPlan().toString()
    # a dense source next to one with far larger positions: buckets fit each
    rows = [("s", 1, q, bytes([q % 251])) for q in range(1, 1001)] + [("t", 1, q * 10**12, bytes([q % 251])) for q in range(1, 1001)]
    two = spark.createDataFrame(rows, "source STRING, table_id BIGINT, seq BIGINT, state BINARY")
    wide = asof.measured(asof.intervals(two, keys, ["state"]), keys, ["state"])
    assert wide.past.groupBy(*keys, "_bucket").count().agg(F.max("count")).first()[0] <= 4
    assert wide.past.count() <= 3 * len(rows)
    at = two.select("source", "table_id", F.col("seq"), F.col("state").alias("own"))
    assert asof.asof_join(at, wide, True).filter("own = state").count() == len(rows)


def test_row_events_are_not_shuffled(spark, sf):
    import capture_fixtures as fx
    from tidemark.plans import mysql

    capture = fx.binlog_capture(spark, sf)
    packets = capture.select("source", "seq", "packet")
    state = mysql.log_state(packets)
    frozen = spark.createDataFrame([("s", 1, b"x")], "source STRING, seq BIGINT, packet BINARY")
    plan = mysql.located_row_events(frozen, state)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main.replace("BroadcastExchange", "")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_states_that_alternate_slowly_are_not_sorted(spark, monkeypatch):
    """Versions of a table take turns every 100,000 seq: the aggregate alone finds where."""
    sorted_within = []
    drop = asof._drop_repeats

    def recorded(states, keys, value, within=None):
        sorted_within.append(str(within))
        return drop(states, keys, value, within)

    monkeypatch.setattr(asof, "_drop_repeats", recorded)
    states = spark.range(0, 2_000_000, 100).selectExpr("'s' AS source", "id AS seq", "id div 100000 % 2 AS state")
    points = asof.change_points(states, ["source"], "state").collect()
    assert sorted(r.seq for r in points) == list(range(0, 2_000_000, 100_000))
    assert not any(str(asof._bucket(asof.COLLAPSE_BITS[0])) == w for w in sorted_within)
