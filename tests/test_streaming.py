"""A capture cut into files and streamed gives what the batch plan gives."""

import json

import pytest
from pyspark.sql import functions as F

import capture_fixtures as fx
from tests.helpers import capture, inserts, table_map
from tidemark.operators import envelope, wal
from tidemark.plans import mysql, postgres
from tidemark.sources import captures
from tidemark.streaming import jobs, sinks


def cut(df, folder, slices):
    """Write slices of a capture as files that arrive one after the other."""
    import time

    bounds = [df.agg(F.min("seq"), F.max("seq")).first()][0]
    step = (bounds[1] - bounds[0]) // slices + 1
    for i in range(slices):
        low = bounds[0] + i * step
        df.filter((F.col("seq") >= low) & (F.col("seq") < low + step)).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def flat(events):
    return sorted(map(tuple, events.select(
        "source", "seq", "row_no", "op", "schema", "table", F.to_json(F.struct("columns")).alias("c"),
        F.to_json(F.struct("identity")).alias("i"), F.col("cursor.file").alias("f"), F.col("cursor.pos").alias("p"),
    ).collect()), key=str)


def finish(query):
    assert query.awaitTermination(240)
    assert query.exception() is None


def test_mysql_stream_equals_batch(spark, sf, tmp_path):
    packets = fx.binlog_capture(spark, sf, bad=True).filter("source = 'my_orders' AND seq < 6000").cache()
    cut(packets, f"{tmp_path}/in", 4)
    stream = captures.read_binlog_capture(spark, f"{tmp_path}/in", streaming=True, maxFilesPerTrigger=1)
    out = f"{tmp_path}/out"
    finish(jobs.run_mysql(stream, out, f"{tmp_path}/cp", available_now=True))
    state = mysql.log_state(packets)
    assert flat(spark.read.parquet(f"{out}/events")) == flat(mysql.row_events(packets, state, on_error="skip"))
    mine = {(r.seq, r.error) for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert mine == {(r.seq, r.error) for r in mysql.quarantined(packets, state).collect()}
    progress = spark.read.parquet(f"{out}/progress").orderBy("batch_id").collect()
    assert len(progress) == 4 and {p.log_file for p in progress} == {"binlog.000000"}
    assert [p.log_position for p in progress] == sorted(p.log_position for p in progress)
    # More data under the same checkpoint: the carried state still serves.
    columns = fx.ORDERS_A
    late = fx.packet(30, fx.rows_body(100, 2, columns, [fx.row_bytes(columns, [1, 2, "O", 5, 6, 20200101000000, 1, 2, 3, 4, None])]))
    capture(spark, late, source="my_orders", start=7000).write.mode("append").parquet(f"{tmp_path}/in")
    finish(jobs.run_mysql(stream, out, f"{tmp_path}/cp", available_now=True))
    [event] = spark.read.parquet(f"{out}/events").filter("seq = 7000").collect()
    assert event.table == "orders" and event.cursor.file == "binlog.000000"


def test_carried_state_stays_level(spark, tmp_path):
    """Each file opens ten tables under new ids; only the open file's are carried."""
    columns = [("id", "int", False)]
    seq = 0
    for number in range(6):
        packets = [fx.rotate(f"bin.{number:06d}")]
        for t in range(10):
            table_id = number * 10 + t
            packets += [table_map(columns, table_id, f"t{t}"), inserts(columns, [number], table_id=table_id)]
        packets.append(fx.last_rotate(f"bin.{number + 1:06d}", 1, 900))
        capture(spark, *packets, start=seq).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        seq += len(packets)
    stream = captures.read_binlog_capture(spark, f"{tmp_path}/in", streaming=True, maxFilesPerTrigger=1)
    finish(jobs.run_mysql(stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True))
    sizes = spark.read.parquet(f"{tmp_path}/out/state").groupBy("batch_id").count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) <= 11
    events = spark.read.parquet(f"{tmp_path}/out/events")
    assert events.count() == 60 and events.select("cursor.file").distinct().count() == 6


def test_row_event_before_its_table_map_is_set_aside(spark, tmp_path):
    columns = [("id", "int", False)]
    capture(spark, inserts(columns, [1])).write.parquet(f"{tmp_path}/in")
    stream = captures.read_binlog_capture(spark, f"{tmp_path}/in", streaming=True)
    finish(jobs.run_mysql(stream, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True))
    assert spark.read.parquet(f"{tmp_path}/out/quarantine").first().error == "no table map before the row event"


def test_postgres_stream_equals_batch(spark, sf, tmp_path):
    frames = fx.wal_capture(spark, sf, bad=True).filter("source = 'pg_orders' AND seq < 17200000").cache()
    cut(frames, f"{tmp_path}/in", 3)
    stream = captures.read_wal_capture(spark, f"{tmp_path}/in", streaming=True, maxFilesPerTrigger=1)
    out = f"{tmp_path}/out"
    finish(jobs.run_postgres(stream, out, f"{tmp_path}/cp", tables=["public.orders"], available_now=True))
    assert flat(spark.read.parquet(f"{out}/events")) == flat(postgres.row_events(frames, on_error="skip"))
    assert spark.read.parquet(f"{out}/quarantine").count() == wal.wal_quarantine(frames).count() > 0
    reported = [r.reported_lsn for r in spark.read.parquet(f"{out}/progress").orderBy("batch_id").collect()]
    assert len(reported) == 3 and reported == sorted(reported)


@pytest.mark.parametrize("fmt", ["parquet", "json", "console"])
def test_event_stream_sinks(spark, sf, tmp_path, fmt):
    frames = fx.wal_capture(spark, sf).filter("seq < 16800000")
    frames.write.parquet(f"{tmp_path}/in")
    stream = captures.read_wal_capture(spark, f"{tmp_path}/in", streaming=True)
    options = {} if fmt == "console" else {"path": f"{tmp_path}/out"}
    finish(sinks.stream_events(postgres.row_events(stream), fmt, f"{tmp_path}/cp", available_now=True, **options))
    if fmt == "parquet":
        assert spark.read.parquet(f"{tmp_path}/out").count() == postgres.row_events(frames).count()


def test_batch_sinks(spark, sf, tmp_path):
    events = postgres.row_events(fx.wal_capture(spark, sf).filter("seq < 16800000"))
    sinks.write_events(events, f"{tmp_path}/events")
    assert spark.read.parquet(f"{tmp_path}/events").groupBy("schema", "table").count().count() == 2
    sinks.write_payload(events, "json", path=f"{tmp_path}/payload")
    row = spark.read.json(f"{tmp_path}/payload").first()
    assert set(json.loads(row.key)) == {"schema", "table"} and json.loads(row.value)["op"]
    keys = spark.createDataFrame([("public", "orders", ["o_orderkey"])], "schema string, table string, key_columns array<string>")
    sinks.write_payload(events, "json", keys, path=f"{tmp_path}/keyed")
    found = [json.loads(r.key) for r in spark.read.json(f"{tmp_path}/keyed").collect()]
    assert {"key" in f for f in found if f["table"] == "orders"} == {True}
    assert len({str(f) for f in found if f["table"] == "orders"}) > 10
    assert {"key" in f for f in found if f["table"] == "customer"} == {False}


def test_a_changed_key_leaves_a_tombstone(spark):
    columns = [("id", "int", False), ("x", "int", True)]
    image = lambda i, x: fx.row_bytes(columns, [i, x])
    packets = [
        table_map(columns), inserts(columns, [1, 5]),
        fx.packet(31, fx.rows_body(1, 2, columns, [image(1, 5), image(2, 5)], True)),
        fx.packet(31, fx.partial_rows_body(1, columns, [[{"id": 2}], [{"x": 6}]])),
        fx.packet(32, fx.rows_body(1, 2, columns, [image(2, 6)])),
    ]
    keys = spark.createDataFrame([("db", "t", ["id"])], "schema string, table string, key_columns array<string>")
    payload = envelope.kafka_payload(mysql.row_events(capture(spark, *packets)), keys).collect()
    found = sorted((json.loads(r.value)["seq"] if r.value else -1, json.loads(r.key)["key"], json.loads(r.value)["op"] if r.value else None) for r in payload)
    assert found == [(-1, ["1"], None), (1, ["1"], "insert"), (2, ["2"], "update"), (3, ["2"], "update"), (4, ["2"], "delete")]
