import datetime
import json

import pytest
from pyspark.sql import functions as F

import capture_fixtures as fx
from tests.helpers import as_dict
from tidemark.functions import positions as pos
from tidemark.operators import envelope, positions, wal
from tidemark.plans import postgres
from tidemark.sources import captures


def frames(spark, *messages, kind="w", source="pg"):
    rows = [(source, i, kind, 100 * i, 100 * i + 50, 0, None, None, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, captures.WAL_CAPTURE)


def users(key, name=None):
    columns = [{"name": "id", "type": "integer", "value": key}]
    return columns if name is None else columns + [{"name": "name", "type": "character varying(255)", "value": name}]


STATEMENTS = [
    {"action": "B"}, {"action": "T", "schema": "public", "table": "users"}, {"action": "C"},
    {"action": "I", "schema": "public", "table": "users", "columns": users(1, "bob")},
    {"action": "I", "schema": "public", "table": "users", "columns": users(2, "yan")},
    {"action": "D", "schema": "public", "table": "users", "identity": users(2)},
    {"action": "U", "schema": "public", "table": "users", "columns": users(1, "chad"), "identity": users(1)},
    {"action": "M", "transactional": False, "prefix": "p", "content": "c"},
]


def test_integration_statements(spark):
    events = postgres.row_events(frames(spark, *STATEMENTS)).orderBy("seq").collect()
    assert [e.op for e in events] == ["insert", "insert", "delete", "update"]
    assert as_dict(events[0]["columns"]) == {"id": 1, "name": "bob"} and events[0].identity is None
    assert events[2]["columns"] is None and as_dict(events[2].identity) == {"id": 2}
    assert as_dict(events[3]["columns"]) == {"id": 1, "name": "chad"} and as_dict(events[3].identity) == {"id": 1}
    assert [(c.column_type, c.type_name) for c in events[0]["columns"]] == [("I64", "integer"), ("String", "character varying(255)")]
    assert events[0].cursor.pos == 300 and events[0].event_time == datetime.datetime(2000, 1, 1)


def test_values_by_type(spark):
    cells = {
        "big": ("numeric(38,18)", "12345678901234567890.123456789012345678"), "f": ("double precision", "2.5"), "n": ("bigint", "null"),
        "ok": ("boolean", "true"), "day": ("date", '"2024-02-29"'), "at": ("timestamp(3) without time zone", '"2024-02-29 10:11:12.5"'),
        "raw": ("bytea", '"\\\\x00ff"'), "doc": ("jsonb", '"{\\"a\\": 1}"'), "list": ("integer[]", '"{1,2}"'), "clock": ("time without time zone", '"23:59:58"'),
    }
    columns = ",".join(f'{{"name":"{n}","type":"{t}","value":{v}}}' for n, (t, v) in cells.items())
    capture = frames(spark, '{"action":"I","schema":"s","table":"t","columns":[%s]}' % columns)
    events = postgres.row_events(capture)
    found = as_dict(events.first()["columns"])
    assert found["big"] == cells["big"][1] and found["f"] == 2.5 and found["n"] is None and found["ok"] == "true"
    assert found["raw"] == b"\x00\xff" and found["doc"] == '{"a": 1}' and found["list"] == "{1,2}"
    kinds = {c.name: c.column_type for c in events.first()["columns"]}
    assert kinds == {"big": "Decimal", "f": "F64", "n": "I64", "ok": "String", "day": "Date", "at": "Timestamp", "raw": "Bytes",
                     "doc": "Json", "list": "String", "clock": "Time"}
    flat = envelope.typed_view(events, "s.t", "big DECIMAL(38,18), ok BOOLEAN, day DATE, at TIMESTAMP_NTZ, clock INTERVAL DAY TO SECOND").first()
    assert str(flat.big) == cells["big"][1] and flat.ok is True and flat.day == datetime.date(2024, 2, 29)
    assert flat["at"] == datetime.datetime(2024, 2, 29, 10, 11, 12, 500000) and flat.clock == datetime.timedelta(hours=23, minutes=59, seconds=58)


BAD = {
    "{bad": "malformed JSON", '{"action":"Z"}': "unknown action Z", "{}": "missing action",
    '{"action":"I","schema":"s","table":"t"}': "missing columns", '{"action":"I","columns":[]}': "missing schema or table",
    '{"action":"D","schema":"s","table":"t"}': "missing identity", '{"action":"M","prefix":"p"}': "missing message fields",
    '{"action":"I","schema":"s","table":"t","columns":[{"name":"x"}]}': "column without name or type",
}


def test_bad_messages(spark):
    capture = frames(spark, *BAD, *STATEMENTS)
    assert {r.message: r.error for r in wal.wal_quarantine(capture).collect()} == BAD
    assert postgres.row_events(capture, on_error="skip").count() == 4
    assert wal.decode_wal(capture, "keep").filter("error IS NOT NULL").count() == len(BAD)
    with pytest.raises(Exception, match="malformed JSON"):
        postgres.row_events(frames(spark, "{bad")).collect()
    assert wal.wal_quarantine(frames(spark, "x", kind="?")).first().error == "unknown frame"


def test_message_is_parsed_once(spark):
    plan = postgres.row_events(frames(spark, *STATEMENTS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "Join" not in plan and "Aggregate" not in plan


def test_raw_frames(spark):
    body = b"w" + (5).to_bytes(8, "big") + (9).to_bytes(8, "big") + (-1).to_bytes(8, "big", signed=True) + b'{"action":"B"}'
    alive = b"k" + (2**63 - 1).to_bytes(8, "big") + (7).to_bytes(8, "big") + b"\1"
    raw = spark.createDataFrame([("s", i, p) for i, p in enumerate([body, alive, body[:9], b"?", b""])], "source STRING, seq BIGINT, packet BINARY")
    rows = captures.wal_frames(raw).orderBy("seq").collect()
    assert (rows[0].kind, rows[0].start_lsn, rows[0].end_lsn, rows[0].clock_us, rows[0].message) == ("w", 5, 9, -1, '{"action":"B"}')
    assert (rows[1].kind, rows[1].end_lsn, rows[1].must_reply) == ("k", 2**63 - 1, True)
    assert [r.kind for r in rows[2:]] == [None] * 3


def test_text_that_is_not_utf8_is_set_aside(spark):
    frame = b"w" + bytes(24) + b'{"action":"\xff"}'
    raw = spark.createDataFrame([("s", 1, frame)], "source STRING, seq BIGINT, packet BINARY")
    assert wal.wal_quarantine(captures.wal_frames(raw)).first().error == "malformed JSON"


def test_readers(spark, tmp_path):
    capture = frames(spark, *STATEMENTS)
    for fmt in ("parquet", "json"):
        capture.write.format(fmt).save(f"{tmp_path}/{fmt}")
        assert postgres.row_events(captures.read_wal_capture(spark, f"{tmp_path}/{fmt}", fmt)).count() == 4
    capture.select("message").write.text(f"{tmp_path}/text")
    assert postgres.row_events(captures.read_wal_capture(spark, f"{tmp_path}/text", "text")).count() == 4
    packets = spark.createDataFrame([("s", 1, b"\0\xff")], captures.BINLOG_CAPTURE)
    packets.write.json(f"{tmp_path}/binlog")
    assert bytes(captures.read_binlog_capture(spark, f"{tmp_path}/binlog", "json").first().packet) == b"\0\xff"
    records = spark.createDataFrame([(b"src", b"\0\1", 3, 41)], "key BINARY, value BINARY, partition INT, offset BIGINT")
    row = captures.from_kafka(records).first()
    assert (row.source, row.seq, bytes(row.packet)) == ("src", 41, b"\0\1")


def test_resume_filters_reach_the_scan(spark, tmp_path):
    frames(spark, *STATEMENTS).write.parquet(f"{tmp_path}/wal")
    capture = captures.read_wal_capture(spark, f"{tmp_path}/wal").filter("kind = 'w'")
    events = postgres.row_events(positions.wal_resume(capture, {"pg": 400}))
    assert events.count() == 3
    assert postgres.row_events(positions.wal_until(positions.wal_resume(capture, {"pg": 400}), {"pg": 500})).count() == 2
    assert postgres.row_events(positions.wal_resume(capture, {"other": 400})).count() == 4
    plan = events._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(kind,w)" in pushed and "GreaterThanOrEqual(start_lsn,400)" in pushed


def test_cursors(spark):
    texts = ["1/16B3748", "-1/FFFFFFFFFFFFFFFF", "300/1", "9999999999/1", "x/1", "1", "1/xyz"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = [r[0] and tuple(r[0]) for r in df.select(pos.parse_wal_cursor(F.col("t"))).collect()]
    assert rows == [(1, 0x16B3748), (-1, -1), (300, 1), None, None, None, None]
    back = df.limit(1).select(pos.format_wal_cursor(F.lit(1), F.lit(0x16B3748).cast("bigint")), pos.format_lsn(F.lit(0x16_0B374D)), pos.parse_lsn(F.lit("16/B374D848")))
    assert tuple(back.first()) == ("1/16B3748", "0/160B374D", 0x16_B374D848)
    texts = ["bin.000007/4", "bin.000007/4294967296", "bin.000007/99999999999999999999", "bin.000007", "bin/x"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = [r[0] and tuple(r[0]) for r in df.select(pos.parse_binlog_cursor(F.col("t"))).collect()]
    assert rows == [("bin.000007", 4), ("bin.000007", 1 << 32), None, None, None]


def test_progress_and_timeline(spark):
    rows = [("s", 1, "w", 10, 20, 0, None, None, '{"action":"B"}'), ("s", 2, "w", 12, 20, 0, None, None, '{"action":"C"}'),
            ("s", 3, "t", None, 30, 0, None, 4, None), ("s", 4, "k", None, 44, 0, True, None, None),
            ("s", 5, "w", 40, 50, 0, None, None, '{"action":"B"}')]
    capture = spark.createDataFrame(rows, captures.WAL_CAPTURE)
    assert tuple(positions.wal_progress(wal.decode_wal(capture)).first()) == ("s", 4, 50, 13, 5)
    assert tuple(positions.wal_timeline(capture).first()) == ("s", 4, 50)
    assert tuple(positions.latest_wal_cursor(capture).first()) == ("s", 50)


def test_clock(spark):
    df = spark.createDataFrame([(0,), (-1,), (86_400_000_001,)], "us BIGINT")
    found = [r[0] for r in df.select(pos.pg_clock(F.col("us"))).collect()]
    assert found == [datetime.datetime(2000, 1, 1), datetime.datetime(1999, 12, 31, 23, 59, 59, 999999), datetime.datetime(2000, 1, 2, 0, 0, 0, 1)]


def test_table_rows_equal_the_typed_view(spark, sf):
    capture = fx.wal_capture(spark, sf, bad=True)
    ddl = "o_orderkey BIGINT, o_custkey INT, o_orderstatus STRING, total STRING, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, absent DATE"
    for image in ("columns", "identity"):
        slow = envelope.typed_view(postgres.row_events(capture, on_error="skip"), "public.orders", ddl, image)
        fast = postgres.table_rows(capture, "public.orders", ddl, image, on_error="skip")
        assert slow.schema.simpleString() == fast.schema.simpleString()
        assert sorted(map(str, slow.collect())) == sorted(map(str, fast.collect()))


def test_kafka_sources_over_partitions(spark):
    schema = "key BINARY, topic STRING, partition INT, offset BIGINT, value BINARY"
    rows = [(b"a", "t", 0, 1, b"x"), (b"a", "t", 1, 1, b"y"), (b"b", "t", 1, 2, b"z"), (b"b", "t", 1, 3, b"z"), (None, "t", 0, 4, b"n")]
    records = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in captures.spread_sources(records).collect()] == [("a", 2)]
    apart = captures.from_kafka(records, by_partition=True).orderBy("source", "seq").collect()
    assert [(r.source, r.seq) for r in apart] == [(None, 4), ("a@t/0", 1), ("a@t/1", 1), ("b@t/1", 2), ("b@t/1", 3)]
    assert captures.spread_sources(records.limit(0)).count() == 0
