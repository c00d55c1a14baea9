"""Transactions against a plain walk over the log, in small buckets and in a stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import capture_fixtures as fx
from tests.test_streaming import cut, finish
from tidemark.operators import asof, pgoutput, transactions, wal
from tidemark.plans import mysql, postgres
from tidemark.sources import captures
from tidemark.streaming import jobs

EVENT = "source string, seq bigint, row_no int, payload string"


def plain(events, marks):
    out = []
    for source in {e[0] for e in events}:
        log = sorted([(e[1], e[2], e) for e in events if e[0] == source] + [(m[1], 0, m) for m in marks if m[0] == source], key=lambda x: x[:2])
        for i, (_, _, e) in enumerate(log):
            if len(e) != 4:
                continue
            before = [m for _, _, m in log[:i] if len(m) == 5]
            after = [m for _, _, m in log[i + 1 :] if len(m) == 5]
            if not before or before[-1][2] != "begin":
                out.append((*e, None, None, None, None, None, "outside"))
                continue
            start = before[-1]
            number = sum(1 for s, _, x in log[:i] if len(x) == 4 and s > start[1])
            end = after[0] if after else None
            state = "open" if end is None else {"commit": "committed", "rollback": "rolled back", "begin": "unfinished"}[end[2]]
            done = state in ("committed", "rolled back")
            name = start[3] or (end[3] if done else None)
            out.append((*e, start[1], name, number, end[1] if done else None, end[4] if done else None, state))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,bucket", [(0, 3), (1, 20), (2, 1000), (3, 1)])
def test_against_a_plain_walk(spark, seed, bucket):
    rng = random.Random(seed)
    events, marks = [], []
    for source in ("a", "b", "none"):
        seq = 0
        for _ in range(150):
            seq += rng.choice([1, 1, 2, 50])
            kind = rng.choice(["row"] * 6 + ["begin", "commit", "begin", "commit", "rollback"])
            if kind == "row":
                events += [(source, seq, n, f"{seq}.{n}") for n in range(rng.choice([1, 1, 4, 30]))]
            elif source != "none":
                marks.append((source, seq, kind, rng.choice([None, f"x{seq}"]), dt.datetime(2020, 1, 1) + dt.timedelta(seconds=seq)))
    found = transactions.with_transactions(
        spark.createDataFrame(events, EVENT).repartition(5), spark.createDataFrame(marks, transactions.MARK).repartition(3), bucket
    )
    assert sorted(map(tuple, found.collect()), key=str) == plain(events, marks)
    assert {"committed", "rolled back", "unfinished", "outside"} <= {r.txn_state for r in found.collect()}


def test_empty(spark):
    events, marks = spark.createDataFrame([], EVENT), spark.createDataFrame([], transactions.MARK)
    assert transactions.with_transactions(events, marks).columns == ["source", "seq", "row_no", "payload", *transactions.PLACE]
    assert transactions.with_transactions(events, marks).collect() == []


def test_ends_of_binlog_transactions(spark):
    text = lambda q: b"\0" * 8 + b"\1" + b"\0" * 4 + b"s\0" + q
    packets = [fx.packet(34, b"x"), fx.packet(2, text(b"BEGIN")), fx.packet(2, text(b"ROLLBACK")), fx.packet(33, b"x"), fx.packet(2, text(b"COMMIT")),
               fx.packet(2, text(b"UNCOMMIT")), fx.packet(16, (1 << 64) .__sub__(1).to_bytes(8, "little"))]
    capture = spark.createDataFrame([("s", i, p) for i, p in enumerate(packets)], captures.BINLOG_CAPTURE)
    marks = transactions.binlog_marks(capture).orderBy("seq").collect()
    assert [(m.seq, m.mark, m.id) for m in marks] == [
        (0, "begin", None), (2, "rollback", None), (3, "begin", None), (4, "commit", None), (6, "commit", str((1 << 64) - 1))
    ]


def flat(df):
    return sorted(map(tuple, df.select("source", "seq", "row_no", "op", F.to_json(F.struct("columns")), *transactions.PLACE).collect()), key=str)


def test_mysql_stream_holds_open_transactions_back(spark, sf, tmp_path):
    packets = fx.binlog_capture(spark, sf).filter("source = 'my_orders' AND seq < 2988").cache()  # ends before a commit
    cut(packets, f"{tmp_path}/in", 7)  # at places inside transactions
    stream = captures.read_binlog_capture(spark, f"{tmp_path}/in", streaming=True, maxFilesPerTrigger=1)
    finish(jobs.run_mysql(stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True, transactions=True))
    whole = mysql.transactions(packets).cache()
    assert flat(spark.read.parquet(f"{tmp_path}/out/events")) == flat(transactions.committed(whole))
    held = spark.read.parquet(f"{tmp_path}/out/held").filter("batch_id = 6").collect()
    assert {r.seq for r in held} == {r.seq for r in whole.filter("txn_state = 'open'").collect()} != set()


def test_pgoutput_stream_equals_batch(spark, sf, tmp_path):
    raw = fx.pgoutput_capture(spark, sf, bad=True).filter(f"source = 'pg_orders' AND seq < 16777216 + 1024 * 1300 + 100").cache()
    cut(raw, f"{tmp_path}/in", 5)
    stream = captures.pgoutput_frames(captures.read_binlog_capture(spark, f"{tmp_path}/in", streaming=True, maxFilesPerTrigger=1))
    finish(jobs.run_pgoutput(stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True, transactions=True))
    decoded = pgoutput.decode_pgoutput(captures.pgoutput_frames(raw), on_error="keep").cache()
    whole = postgres.transactions(decoded.filter("error IS NULL"))
    assert flat(spark.read.parquet(f"{tmp_path}/out/events")) == flat(transactions.committed(whole))
    bad = {(r.seq, r.error) for r in spark.read.parquet(f"{tmp_path}/out/quarantine").collect()}
    assert bad == {(r.seq, r.error) for r in decoded.filter("error IS NOT NULL").collect()} != set()


def test_wal2json_and_pgoutput_agree(spark, sf):
    """The same changes by both plugins; values sent as unchanged have no column."""
    changes = lambda df: sorted(map(tuple, df.filter("source = 'pg_orders'").select(
        "seq", "op", F.array_sort(F.transform("columns", lambda c: F.struct(c["name"], c["column_type"], c["value"]["i64"]))).cast("string"),
        F.transform("identity", lambda c: F.struct(c["name"], c["value"]["i64"])).cast("string"),
    ).filter("op <> 'update' OR (seq - 16777216) % 10240 <> 128").collect()))
    mine = postgres.pgoutput_row_events(captures.pgoutput_frames(fx.pgoutput_capture(spark, sf)))
    theirs = postgres.row_events(fx.wal_capture(spark, sf))
    assert changes(mine) == changes(theirs)
    assert wal.decode_wal(fx.wal_capture(spark, sf)).columns[-1] == "action_kind"

def test_rows_are_not_kept(spark, monkeypatch):
    """Only what stands for a range of rows is written, also with long transactions."""
    events = [("a", seq, n, "x") for seq in range(1, 800) if seq % 100 for n in range(2)]
    marks = [("a", seq, "begin" if seq % 200 == 0 else "commit", None, None) for seq in range(0, 801, 100)]
    marks = [m for m in marks if m[1] not in (100, 200, 300)]
    kept, materialise = [], asof.materialise
    monkeypatch.setattr(asof, "materialise", lambda df: kept.append(df.count()) or materialise(df))
    found = transactions.with_transactions(spark.createDataFrame(events, EVENT), spark.createDataFrame(marks, transactions.MARK), 50)
    assert sorted(map(tuple, found.collect()), key=str) == plain(events, marks)
    assert kept and max(kept) < len(events) / 10


def test_rows_move_with_what_is_asked_for(spark, sf, tmp_path):
    fx.pgoutput_capture(spark, sf).write.parquet(f"{tmp_path}/in")
    frames = captures.pgoutput_frames(captures.read_binlog_capture(spark, f"{tmp_path}/in"))
    found = postgres.transactions(pgoutput.decode_pgoutput(frames), ["public.orders"], frames).select("seq", *transactions.PLACE)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "is_nullable" not in plan


def test_relation_messages_are_kept_once(spark):
    """A relation that goes to and fro has many intervals, and two messages."""
    columns = lambda turn: [(f"column_{i}", 25, -1, 0) for i in (range(200), range(199, -1, -1))[turn]]
    messages = [fx.pg_frame(fx.pg_relation(9, "s", "t", columns(i % 2)), i, i, 0) for i in range(60)]
    frames = captures.pgoutput_frames(spark.createDataFrame([("p", i, m) for i, m in enumerate(messages)], captures.BINLOG_CAPTURE))
    found = pgoutput.relations(pgoutput.relation_states(frames))
    assert (found.rows, found.value_rows) == (60, 2) and found.bytes < 60 * 200
    assert [r.state for r in pgoutput.open_relations(found).collect()] == [messages[-1][25:]]
