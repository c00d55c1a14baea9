"""Captures made from the tables: whole columns give the packets that single values
give, keys of any size have one, and a query makes its capture once."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import capture_fixtures as fx
import query_suite
from tests.test_queries import ordered

# around a second of microseconds, JSON's bits for hours and those for microseconds
KEYS = [0, 7, 999_999, 1_000_000, 1_000_001, (3600 << 10) - 1, 3600 << 10, 8_999_999, (1 << 24) - 1, 1 << 24, 33_000_000, 53_999_999]


def tables(folder, keys):
    """Orders of these keys and one customer, as the driver lays them."""
    n = len(keys)
    day = [dt.datetime(1995, 3, 1 + i % 28) for i in range(n)]
    pq.write_table(pa.table({
        "o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array([i * 37 for i in range(n)], pa.int64()),
        "o_orderstatus": ["OFP"[i % 3] for i in range(n)], "o_totalprice": pa.array([1000.25 + i for i in range(n)], pa.float64()),
        "o_orderdate": pa.array(day, pa.timestamp("us")), "o_orderpriority": ["1-URGENT", "5-LOW"][:1] * n,
    }), f"{folder}/orders.parquet")
    pq.write_table(pa.table({
        "c_custkey": pa.array([0, 17], pa.int64()), "c_name": ["a", None], "c_nationkey": pa.array([3, 24], pa.int64()),
        "c_acctbal": pa.array([-1.5, None], pa.float64()), "c_mktsegment": ["AUTOMOBILE", None],
    }), f"{folder}/customer.parquet")
    return str(folder)


def expected(folder, name, columns):
    connection = duckdb.connect()
    for table in ("orders", "customer"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()


@pytest.mark.parametrize("name", ["binlog_json", "binlog_fractions", "binlog_enum_set", "binlog_inserts", "binlog_payload", "binlog_partial_images"])
def test_large_keys(spark, tmp_path, name):
    folder = tables(tmp_path, KEYS)
    df = entry.queries()[name](spark, folder)
    if name == "binlog_inserts":
        df = df.filter("source = 'my_orders'")
    rows = [r for r in expected(folder, name, df.columns) if name != "binlog_inserts" or r[0] == "my_orders"]
    assert ordered([tuple(r) for r in df.collect()]) == ordered(rows)


COLUMNS = [
    ("a", "bigint", False), ("b", "ubigint", True), ("c", "char(1)", True), ("d", "decimal(15,2)", True), ("e", "decimal(10,4)", True),
    ("f", "varchar(300)", True), ("g", "text", True), ("h", "smallint", True), ("i", "date", True), ("j", "decimal(25,12)", True), ("k", "double", True),
]
ROWS = [
    [1, 2, "O", 12345, -3125000, "long", "text", -5, 7, 10**14 + 3, 2.5],
    [-(1 << 62), 0, None, -1, 0, None, None, None, 0, -1, None],
    [0, 1 << 40, "é"[:1], 10**14, 625, "x" * 290, "", 32767, 1 << 20, 0, -0.25],
]


def test_row_column_is_row_bytes():
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    values = [pa.array([r[j] for r in ROWS], kinds[j]) for j in range(len(COLUMNS))]
    assert fx.row_column(COLUMNS, values).to_pylist() == [fx.row_bytes(COLUMNS, r) for r in ROWS]


def test_packet_column_is_packet():
    bodies = [b"", b"body", b"x" * 300]
    found = fx.packet_column(np.array([16, 30, 19]), pa.array(bodies), np.array([1, 2, 3]), np.array([0, 9, 1 << 31]), 8)
    assert found.to_pylist() == [fx.packet(k, b, t, p, 8) for k, b, t, p in zip((16, 30, 19), bodies, (1, 2, 3), (0, 9, 1 << 31))]


def test_column_values_that_do_not_fit_raise():
    with pytest.raises(OverflowError):
        fx.value_column("smallint", np.array([1 << 16]))
    with pytest.raises(ValueError):
        fx._whole(pa.array([1, None]))


@pytest.mark.parametrize("name, capture", [
    ("binlog_decimals", "binlog_capture"), ("packet_quarantine", "binlog_capture"), ("mysql_transactions", "binlog_capture"), ("kafka_payload", "binlog_capture"),
    ("latest_cursor", "binlog_capture"), ("binlog_json", "kinds_capture"), ("binlog_payload", "payload_capture"), ("binlog_partial_images", "partial_capture"),
    ("pgoutput_transactions", "pgoutput_capture"), ("gtid_resume", "gtid_capture"), ("pg_transactions", "wal_capture"),
])
def test_capture_is_made_once(spark, tmp_path, monkeypatch, name, capture):
    folder = tables(tmp_path, list(range(60)))
    made = spark.sparkContext.accumulator(0)
    make = getattr(fx, capture)

    def counted(*args, **kw):
        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        df = make(*args, **kw)
        return df.mapInArrow(count, df.schema)

    bad = {"bad": True} if name == "packet_quarantine" else {}
    rows = make(spark, folder, **bad).count()
    monkeypatch.setattr(query_suite.fixtures, capture, counted)
    entry.queries()[name](spark, folder).collect()
    assert made.value == rows


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["pgoutput_row_events", "binlog_partial_images"])
def test_images_come_from_one_decode(spark, tmp_path, name):
    folder = tables(tmp_path, list(range(60)))
    assert plan(entry.queries()[name](spark, folder)).count("MapInArrow") == 1


def test_records_are_read_once(spark, tmp_path):
    folder = tables(tmp_path, list(range(60)))
    text = plan(entry.queries()["kafka_payload"](spark, folder))
    assert text.count("from_json(StructField(source") == 1 and "get_json_object" not in text


def test_views_decode_their_own_table(spark, tmp_path):
    folder = tables(tmp_path, list(range(60)))
    assert plan(entry.queries()["binlog_inserts"](spark, folder)).count("wanted") >= 2


@pytest.mark.parametrize("name, module, decode", [
    ("pgoutput_transactions", "pgoutput_operator", "decode_pgoutput"), ("pg_transactions", "wal", "decode_wal"),
])
def test_transactions_decode_once(spark, tmp_path, monkeypatch, name, module, decode):
    folder = tables(tmp_path, list(range(60)))
    seen, operator = spark.sparkContext.accumulator(0), getattr(query_suite, module)
    once = getattr(operator, decode)

    def counted(*args):
        df = once(*args)
        where = F.udf(lambda seq: seen.add(1) or seq, "bigint").asNondeterministic()
        return df.withColumn("seq", where("seq"))

    frames = {"pg_transactions": fx.wal_capture, "pgoutput_transactions": fx.pgoutput_capture}[name](spark, folder).count()
    monkeypatch.setattr(operator, decode, counted)
    rows = entry.queries()[name](spark, folder).collect()
    # a truncate is one row for each of its tables
    assert rows and seen.value < 1.5 * frames


def test_event_queries_compile_their_checks(spark, tmp_path):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    entry.queries()["binlog_headers"](spark, tables(tmp_path, list(range(3))))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_big_packets_are_packets():
    keys, stamp = [0, 1431, 4999, 9999], 7
    at = lambda k: (k % 5000 + 1) * fx.BIG_STEP
    want = {k * 3 + 1: fx.packet(fx.XID, k.to_bytes(8, "little"), stamp, at(k) % (1 << 32)) for k in keys}
    want |= {0: fx.rotate("binlog.000000")}
    want |= {k * 3 + 2: fx.last_rotate(f"binlog.{k // 5000 + 1:06d}", stamp, (at(k) + 50) % (1 << 32)) for k in (4999, 9999)}
    found = fx._big_packets(pa.RecordBatch.from_pydict({"k": keys, "epoch": [stamp] * len(keys)}))
    assert dict(zip(found["seq"].to_pylist(), found["packet"].to_pylist())) == want

def test_documents_are_json_bytes():
    """Whole columns of JSON give what single documents give, at every size of number."""
    keys = [*KEYS, -5, 1, 130, 255, 299, 32_767, 32_768, 65_535, 65_536, 2_147_413_648, (1 << 32) - 1, 1 << 32, 1 << 40]
    cents = [0, 7, -1, 99, 100, 12_345, -987_654_321, 10**14, 10**17, *range(1, len(keys) - 8)]
    at = [dt.datetime(1992 + i % 7, 1 + i % 12, 1 + i % 28, i % 24, i % 60, i % 60) for i in range(len(keys))]
    priority = [None if i % 4 == 3 else "é" * (i * 40) for i in range(len(keys))]
    status = ["O" if i % 5 else None for i in range(len(keys))]
    batch = pa.RecordBatch.from_pydict({
        "k": keys, "cents": cents, "at": pa.array(at, pa.timestamp("us")), "o_orderstatus": pa.array(status, pa.string()), "o_orderpriority": pa.array(priority, pa.string()),
    })
    rows = [SimpleNamespace(**r | {"at": pd.Timestamp(r["at"])}) for r in batch.to_pylist()]
    for wide in (False, True):
        assert fx.order_documents(batch, wide).to_pylist() == [fx.json_bytes(fx.order_document(r), wide) for r in rows]


def test_kinds_are_row_bytes():
    at = [dt.datetime(1995, 3, 1 + i % 28, i % 24, i % 60, i % 60) for i in range(40)]
    keys = list(range(0, 4000, 100))
    batch = pa.RecordBatch.from_pydict({
        "k": keys, "epoch": [1_000_000 + k for k in keys], "cents": [k + 5 for k in keys], "at": pa.array(at, pa.timestamp("us")),
        "o_orderstatus": ["O"] * 40, "o_orderpriority": ["5-LOW"] * 40,
    })
    found = dict(zip(*(c.to_pylist() for c in fx._kinds_packets(batch, b"table").columns[1:])))
    for r in batch.to_pylist():
        k, micros, stamp = r["k"], r["k"] % 1000 * 1000 + 7, r["epoch"] if r["k"] % 3 else 0
        document = fx.json_bytes(fx.order_document(SimpleNamespace(**r | {"at": pd.Timestamp(r["at"])})), k % 5 == 0) if k % 13 else None
        row = fx.row_bytes(fx.KINDS, [
            k, document, k % 3, k % 8, fx.datetime2_bytes(r["at"].replace(microsecond=micros), 6), fx.timestamp2_bytes(stamp, micros if stamp else 0, 3),
            fx.time2_bytes(k % 2 == 1, k % 800, k % 60, 59, micros, 2), stamp,
        ])
        assert found[k * 2 + 1] == fx.packet(fx.TABLE_MAP, b"table", r["epoch"], 100)
        assert found[k * 2 + 2] == fx.packet(30, fx.rows_body(7, 2, fx.KINDS, [row]), r["epoch"], 200)


def test_captures_of_kinds_are_made_by_whole_columns(spark, tmp_path):
    made = plan(fx.kinds_capture(spark, tables(tmp_path, [1])))
    assert "MapInArrow" in made and "MapInPandas" not in made
