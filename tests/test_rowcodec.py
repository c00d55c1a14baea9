import datetime
import random
from decimal import Decimal

import numpy as np
import pytest

import capture_fixtures as fx
import query_suite as suite
from tests.helpers import as_dict, capture, deletes, inserts, table_map, updates
from tidemark.operators import envelope, tablemap
from tidemark.plans import mysql

# The 33-column table of the integration tests, and a row of it.
USERS = [
    ("id", "int", False), ("name", "varchar(255)", True), ("a", "tinyint", True), ("b", "utinyint", True),
    ("c", "smallint", True), ("d", "usmallint", True), ("e", "mediumint", True), ("f", "umediumint", True),
    ("g", "int", True), ("h", "uint", True), ("i", "bigint", False), ("j", "ubigint", True),
    ("k", "float", True), ("l", "double", True), ("m", "bit64", True), ("n", "char(3)", True), ("o", "varchar(3)", True),
    ("p", "char(3)", True), ("q", "varchar(3)", True), ("r", "blob1", True), ("s", "blob1", True), ("t", "text", True),
    ("u", "text", True), ("v", "blob3", True), ("w", "blob3", True), ("x", "blob4", True), ("y", "blob4", True),
    ("z", "json", True), ("aa", "year", True), ("ab", "date", True), ("ac", "int", True), ("ad", "int", False), ("ae", "char(800)", True),
]


def user(key, name):
    return [key, name, -128, 255, -32768, 65535, -8388608, 16777215, -2147483648, 4294967295, -9223372036854775808,
            18446744073709551615, 3.14, 3.14, 0b10000001, "a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k", "l",
            b"\0\1\0", 124, 1 | 1 << 5 | 2024 << 9, None, 123, "m"]


def events_of(spark, *packets, **options):
    return mysql.row_events(capture(spark, *packets), **options).orderBy("seq", "row_no").collect()


def test_integration_table(spark):
    t = table_map(USERS, table="Users")
    events = events_of(
        spark, t, inserts(USERS, user(1, "bob")), t, inserts(USERS, user(2, "pat")), t,
        inserts(USERS, user(3, "lel"), user(4, "kek")), t, deletes(USERS, user(2, "pat")), t,
        updates(USERS, (user(1, "bob"), user(1, "chad"))),
    )
    assert [(e.op, e.row_no) for e in events] == [
        ("insert", 0), ("insert", 0), ("insert", 0), ("insert", 1), ("delete", 0), ("update", 0)
    ]
    row = as_dict(events[0]["columns"])
    assert (row["id"], row["name"], row["ac"], row["ad"], row["ae"]) == (1, "bob", None, 123, "m")
    assert [row[c] for c in "abcdefghi"] == [-128, 255, -32768, 65535, -8388608, 16777215, -2147483648, 4294967295, -(2**63)]
    assert row["j"] == Decimal(2**64 - 1) and row["m"] == Decimal(129)
    assert row["k"] == float(np.float32(3.14)) and row["l"] == 3.14
    assert [row[c] for c in "nopq"] == ["a", "b", "c", "d"]
    assert b"".join(row[c] for c in "rstuvwxy") == b"efghijkl"
    assert row["z"] == b"\0\1\0" and row["aa"] == Decimal(2024) and row["ab"] == "2024-01-01"
    assert as_dict(events[3]["columns"])["name"] == "kek"
    assert events[4]["columns"] is None and as_dict(events[4].identity)["name"] == "pat"
    assert as_dict(events[5].identity)["name"] == "bob" and as_dict(events[5]["columns"])["name"] == "chad"
    kinds = {c.name: (c.column_type, c.is_nullable) for c in events[0]["columns"]}
    assert kinds["id"] == ("I64", False) and kinds["b"] == ("U64", True) and kinds["z"][0] == "Json" and kinds["r"][0] == "Bytes"


@pytest.mark.parametrize("precision,scale", [(1, 0), (5, 5), (9, 0), (10, 0), (10, 4), (15, 2), (18, 9), (20, 11), (38, 18), (65, 30)])
def test_decimals(spark, precision, scale):
    columns = [("d", f"decimal({precision},{scale})", True)]
    rng = random.Random(precision)
    top = 10**precision - 1
    digits = [0, 1, -1, top, -top] + [rng.randint(-top, top) for _ in range(20)]
    events = events_of(spark, table_map(columns), inserts(columns, *[[d] for d in digits]))
    sign = lambda d: "-" if d < 0 else ""
    whole = lambda d: str(abs(d) // 10**scale)
    text = lambda d: sign(d) + whole(d) + ("." + str(abs(d) % 10**scale).zfill(scale) if scale else "")
    assert [as_dict(e["columns"])["d"] for e in events] == [text(d) for d in digits]


def test_temporals(spark):
    columns = [("d", "date", True), ("dt", "datetime", True), ("t", "time", True), ("y", "year", True), ("ts", "timestamp", True)]
    rows = [
        [31 | 12 << 5 | 1999 << 9, 19991231235958, 235958, 99, 4294967295],
        [0, 0, 0, 0, 0],
        [0 | 5 << 5 | 2020 << 9, 20200500101112, -8385959, 1, 1],
        [None] * 5,
    ]
    capture_ = capture(spark, table_map(columns), inserts(columns, *rows))
    found = [as_dict(e["columns"]) for e in mysql.row_events(capture_).orderBy("row_no").collect()]
    assert found[0] == {"d": "1999-12-31", "dt": "1999-12-31 23:59:58", "t": "23:59:58", "y": 1999, "ts": 4294967295}
    assert found[1] == {"d": "0000-00-00", "dt": "0000-00-00 00:00:00", "t": "00:00:00", "y": 0, "ts": 0}
    assert found[2]["d"] == "2020-05-00" and found[2]["t"] == "-838:59:59"
    assert set(found[3].values()) == {None}
    flat = envelope.typed_view(
        mysql.row_events(capture_), "db.t", "d DATE, dt TIMESTAMP_NTZ, t INTERVAL DAY TO SECOND, y INT, ts TIMESTAMP, absent STRING"
    ).orderBy("row_no").collect()
    assert (flat[0].d, flat[0].dt) == (datetime.date(1999, 12, 31), datetime.datetime(1999, 12, 31, 23, 59, 58))
    assert flat[1].d is None and flat[2].dt is None and flat[0].absent is None
    assert flat[2].t == -datetime.timedelta(hours=838, minutes=59, seconds=59) and flat[0].y == 1999


@pytest.mark.parametrize("image", ["columns", "identity"])
def test_table_rows_equal_the_typed_view(spark, sf, image):
    c = fx.binlog_capture(spark, sf, bad=True).cache()
    state = mysql.log_state(c)
    for table, ddl in (("shop.orders", suite.ORDER_DDL + ", absent INT"), ("crm.customer", suite.CUSTOMER_DDL)):
        events = mysql.row_events(c, state, on_error="skip")
        slow = envelope.typed_view(events, table, ddl, image)
        fast = mysql.table_rows(c, table, ddl, image, state, on_error="skip")
        assert slow.schema.simpleString() == fast.schema.simpleString()
        assert sorted(map(str, slow.collect())) == sorted(map(str, fast.collect()))


def test_strings_that_are_not_utf8(spark):
    columns = [("p", "char(2)", True), ("q", "varchar(300)", True)]
    found = [as_dict(e["columns"]) for e in events_of(
        spark, table_map(columns), inserts(columns, [b"\xff\xfe", "é" * 140], ["ok", ""], [b"\xc3", None]))]
    assert found == [{"p": b"\xff\xfe", "q": "é" * 140}, {"p": "ok", "q": ""}, {"p": b"\xc3", "q": None}]


def test_signedness_runs_over_all_numeric_columns(spark):
    columns = [("a", "uint", True), ("f", "float", True), ("d", "decimal(4,1)", True), ("b", "int", True), ("c", "ubigint", True)]
    [event] = events_of(spark, table_map(columns), inserts(columns, [2**32 - 1, 0.5, 15, -1, 2**64 - 1]))
    assert as_dict(event["columns"]) == {"a": 2**32 - 1, "f": 0.5, "d": "1.5", "b": -1, "c": 2**64 - 1}


def test_many_columns_and_versions(spark):
    columns = [(f"c{i}", "int" if i % 3 else "varchar(20)", True) for i in range(300)]
    row = [None if i % 7 == 0 else (i if i % 3 else str(i)) for i in range(300)]
    for version in (0, 1, 2):
        [event] = events_of(spark, table_map(columns), inserts(columns, row, version=version))
        assert as_dict(event["columns"]) == dict(zip([c[0] for c in columns], row))


def test_unsupported_types_are_set_aside(spark):
    for kind in ("null",):
        columns = [("id", "int", False), ("x", kind, True)]
        body = fx.rows_body(1, 2, columns, [b"\0\1\0\0\0\1"])
        c = capture(spark, table_map(columns), fx.packet(30, body))
        assert mysql.row_events(c, on_error="skip").count() == 0
        [bad] = mysql.quarantined(c).collect()
        assert bad.error.startswith("unsupported column type: x (")
        with pytest.raises(Exception, match="unsupported column type"):
            mysql.row_events(c).collect()


def test_partial_images_and_wrong_counts(spark):
    columns = [("id", "int", False), ("x", "int", True)]
    full = fx.rows_body(1, 2, columns, [fx.row_bytes(columns, [1, 2])])
    partial = fx.partial_rows_body(1, columns, [[{"x": 7}, {"x": None}]])
    longer = full.replace(b"\x02\x03", b"\x02\x01", 1)  # says less than it holds
    nothing = full.replace(b"\x02\x03", b"\x02\x00", 1)
    other = fx.rows_body(1, 2, columns + [("y", "int", True)], [b"\0" * 13])
    update = fx.partial_rows_body(1, columns, [[{"id": 4}], [{"x": 9}]])
    c = capture(spark, table_map(columns), *[fx.packet(30, b) for b in (partial, longer, nothing, other, full)], fx.packet(31, update))
    cells = lambda image: image and [(x.name, x.value and x.value.i64) for x in image]
    rows = sorted((r.seq, r.row_no, cells(r["columns"]), cells(r.identity)) for r in mysql.row_events(c, on_error="skip").collect())
    assert rows == [
        (1, 0, [("x", 7)], None), (1, 1, [("x", None)], None), (5, 0, [("id", 1), ("x", 2)], None), (6, 0, [("x", 9)], [("id", 4)])
    ]
    errors = {r.seq: r.error for r in mysql.quarantined(c).collect()}
    assert errors == {2: "row event cut short", 3: "row image without columns", 4: "column count differs from the table map"}
    flat = mysql.table_rows(c, "db.t", "id INT, x INT", on_error="skip").select("seq", "id", "x").collect()
    assert sorted(map(tuple, flat), key=str) == [(1, None, 7), (1, None, None), (5, 1, 2), (6, None, 9)]


def test_rows_cut_anywhere_never_decode(spark):
    columns = [("id", "int", False), ("s", "varchar(300)", True), ("d", "decimal(12,3)", True), ("t", "text", True), ("y", "year", True)]
    body = fx.rows_body(1, 2, columns, [fx.row_bytes(columns, [7, "seven", 12345, "text", 100])])
    empty = len(body) - len(fx.row_bytes(columns, [7, "seven", 12345, "text", 100]))
    packets = [fx.packet(30, body[:n]) for n in range(len(body) + 1)]
    c = capture(spark, table_map(columns), *packets)
    rows = mysql.decoded_rows(c, on_error="keep").select("seq", "error").collect()
    good = [r.seq for r in rows if r.error is None]
    assert good == [len(body) + 1]
    assert {r.seq for r in rows} == set(range(1, len(body) + 2)) - {empty + 1}  # a body without rows gives none


def test_one_bad_row_fails_the_whole_event(spark):
    columns = [("id", "int", False), ("s", "varchar(9)", True)]
    rows = [fx.row_bytes(columns, [i, "x" * i]) for i in range(1, 6)]
    c = capture(spark, table_map(columns), fx.packet(30, fx.rows_body(1, 2, columns, rows)[:-1]), inserts(columns, [9, "ok"]))
    events = mysql.row_events(c, on_error="skip").collect()
    assert [as_dict(e["columns"])["id"] for e in events] == [9]
    assert [r.error for r in mysql.quarantined(c).collect()] == ["row event cut short"]


def test_schema_changes_under_one_table_id(spark):
    a = [("id", "int", False), ("x", "varchar(10)", True)]
    b = [("x", "varchar(400)", True), ("id", "bigint", False)]
    events = events_of(
        spark, inserts(a, [0, "early"]), table_map(a), inserts(a, [1, "one"]), table_map(b), inserts(b, ["two", 2]),
        inserts(b, ["three", 3]), table_map(a), inserts(a, [4, "four"]), on_error="skip",
    )
    assert [as_dict(e["columns"]) for e in events] == [
        {"id": 1, "x": "one"}, {"id": 2, "x": "two"}, {"id": 3, "x": "three"}, {"id": 4, "x": "four"}
    ]


def test_table_filter_happens_before_decoding(spark):
    good, bad = [("id", "int", False)], [("e", "null", True)]
    c = capture(
        spark, table_map(good, 1, "wanted"), inserts(good, [1]), table_map(bad, 2, "other"),
        fx.packet(30, fx.rows_body(2, 2, bad, [b"\0\1"])),
    )
    assert mysql.row_events(c, tables=["db.want*"]).count() == 1


def test_catalog(spark):
    columns = [("id", "int", False), ("s", "varchar(9)", True), ("e", "enum", True)]
    strings = lambda *values: fx.lenc(len(values)) + b"".join(fx.lenc(len(v)) + v for v in values)
    field = lambda code, value: bytes([code]) + fx.lenc(len(value)) + value
    extra = (
        field(3, bytes([33, 8])) + field(5, strings(b"p", b"q") + strings(b"r")) + field(6, strings(b"x", b"yy"))
        + field(7, bytes([1, 2])) + field(9, bytes([0, 4, 1, 0])) + field(10, fx.lenc(255) + bytes([1, 63])) + field(11, bytes([8]))
        + field(12, b"\xff")
    )
    state = mysql.log_state(capture(spark, fx.rotate("bin.000007"), table_map(columns, extra=extra, key=(0, 1), charset=33)))
    row = tablemap.schema_catalog(state.maps, state.files).first()
    assert (row.schema, row.table, row.log_file, row.primary_key) == ("db", "t", "bin.000007", [0, 1])
    assert row.default_charset.charset == 33 and row.column_charsets == [33, 8]
    assert row.set_values == [["p", "q"], ["r"]] and row.enum_values == [["x", "yy"]]
    assert row.geometry_types == [1, 2] and [tuple(p) for p in row.primary_key_prefixes] == [(0, 4), (1, 0)]
    assert row.enum_set_default_charset.charset == 255 and row.enum_set_column_charsets == [8]
    assert [(c.name, c.definition, c.type_name) for c in row["columns"]][2] == ("e", "enum", "enum")


def test_workers_need_no_copy_of_the_package(spark, tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle
    from tidemark.operators import pgoutput, rowcodec

    def decode(batches):
        for batch in merged(batches):
            yield from decode_batch(batch, [], layout, {})

    merged, decode_batch, layout = rowcodec._merged, rowcodec._decode_batch, rowcodec._Flat(["x"], "columns")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    for i, fn in enumerate([decode, tablemap._parse_batches, pgoutput._decoder(['tag'])]):
        (tmp_path / f"{i}.pkl").write_bytes(cloudpickle.dumps(fn))
        code = f"import pickle; list(pickle.load(open('{tmp_path}/{i}.pkl', 'rb'))(iter([])))"
        subprocess.run([sys.executable, "-c", code], cwd="/", check=True, timeout=120)


def test_large_arrow_offsets(spark):
    columns = [("id", "int", False), ("s", "varchar(300)", True)]
    c = capture(spark, table_map(columns), *[inserts(columns, [i, "x" * i]) for i in range(5)])
    for large in ("true", "false"):
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", large)
        try:
            found = [as_dict(e["columns"]) for e in mysql.row_events(c, on_error="skip").orderBy("seq").collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
        assert found == [{"id": i, "s": "x" * i} for i in range(5)]


def test_binary_columns_are_bytes_in_every_row(spark):
    columns = [("p", "char(2)", True), ("q", "varchar(300)", True), ("t", "text", True)]
    rows = [[b"\xff\xfe", b"ok", b"x"], [b"ok", None, b"y"]]
    found = [as_dict(e["columns"]) for e in events_of(spark, table_map(columns, charset=63), inserts(columns, *rows))]
    assert found == [{"p": b"\xff\xfe", "q": b"ok", "t": b"x"}, {"p": b"ok", "q": None, "t": b"y"}]
    overrides = fx.lenc(33) + fx.lenc(1) + fx.lenc(63)  # only the second of the character columns
    extra = bytes([2]) + fx.lenc(len(overrides)) + overrides
    found = [as_dict(e["columns"]) for e in events_of(spark, table_map(columns, extra=extra), inserts(columns, ["ok", b"ok", b"x"]))]
    assert found == [{"p": "ok", "q": b"ok", "t": b"x"}]


def test_many_tables_and_long_events_decode_alike(spark):
    columns = [("id", "int", False), ("s", "varchar(300)", True), ("d", "decimal(12,3)", True)]
    rng = random.Random(4)
    rows = [[i, None if rng.random() < 0.3 else "é" * rng.randrange(120), rng.randrange(10**9)] for i in range(300)]
    maps = [table_map(columns, table_id=t, table=f"t{t}") for t in range(40)]
    single = [inserts(columns, r, table_id=i % 40) for i, r in enumerate(rows)]
    one = events_of(spark, table_map(columns), inserts(columns, *rows))
    many = events_of(spark, *maps, *single)
    assert [as_dict(e["columns"]) for e in one] == [as_dict(e["columns"]) for e in many]
    assert [e.row_no for e in one] == list(range(300)) and [e.table for e in many] == [f"t{i % 40}" for i in range(300)]


@pytest.mark.parametrize("scale", range(7))
def test_fractional_temporals(spark, scale):
    columns = [("dt", f"datetime2({scale})", True), ("ts", f"timestamp2({scale})", True), ("t", f"time2({scale})", True), ("id", "int", False)]
    at = datetime.datetime(2024, 2, 29, 23, 59, 58, 123456)
    micros = 123456 // 10 ** (6 - scale) * 10 ** (6 - scale)
    stamp = int(at.replace(tzinfo=datetime.timezone.utc).timestamp())
    rows = [
        [fx.datetime2_bytes(at.replace(microsecond=micros), scale), fx.timestamp2_bytes(stamp, micros, scale), fx.time2_bytes(False, 1, 2, 3, micros, scale), 1],
        [fx.datetime2_bytes(at.replace(microsecond=0, year=1004), scale), fx.timestamp2_bytes(0, 0, scale), fx.time2_bytes(True, 838, 59, 59, micros, scale), 2],
        [None, None, None, 3],
    ]
    capture_ = capture(spark, table_map(columns), inserts(columns, *rows))
    found = [as_dict(e["columns"]) for e in mysql.row_events(capture_).orderBy("row_no").collect()]
    part, none = (f".{micros:06d}"[: scale + 1], "." + "0" * scale) if scale else ("", "")
    assert found[0] == {"dt": "2024-02-29 23:59:58" + part, "ts": f"2024-02-29 23:59:58{part}+00:00", "t": "01:02:03" + part, "id": 1}
    assert found[1] == {"dt": "1004-02-29 23:59:58" + none, "ts": "0000-00-00 00:00:00" + none, "t": "-838:59:59" + part, "id": 2}
    assert found[2] == {"dt": None, "ts": None, "t": None, "id": 3}
    flat = mysql.table_rows(capture_, "db.t", "id INT, dt TIMESTAMP_NTZ, ts TIMESTAMP, t INTERVAL DAY TO SECOND").orderBy("id")
    first, second, _ = flat.selectExpr("dt", "CAST(ts AS STRING) ts", "t").collect()
    assert first.dt == at.replace(microsecond=micros) and first.ts.startswith("2024-02-29 23:59:58")
    assert first.t == datetime.timedelta(hours=1, minutes=2, seconds=3, microseconds=micros)
    assert second.t == -datetime.timedelta(hours=838, minutes=59, seconds=59, microseconds=micros)


def test_enum_set_and_geometry(spark):
    columns = [("e", "enum", True), ("w", "enum2", True), ("s", "set", True), ("g", "geometry", True)]
    strings = lambda *values: fx.lenc(len(values)) + b"".join(fx.lenc(len(v)) + v for v in values)
    field = lambda code, value: bytes([code]) + fx.lenc(len(value)) + value
    extra = field(5, strings(b"a", b"b", "\u00e9".encode())) + field(6, strings(b"x", b"yy") + strings(b"p", b"q"))
    rows = [[1, 2, 5, b"\0\1"], [2, 0, 0, None], [None, 9, 7, b""]]
    events = events_of(spark, table_map(columns, extra=extra), inserts(columns, *rows))
    assert [as_dict(e["columns"]) for e in events] == [
        {"e": "x", "w": "q", "s": "a,\u00e9", "g": b"\0\1"}, {"e": "yy", "w": "", "s": "", "g": None}, {"e": None, "w": "9", "s": "a,b,\u00e9", "g": b""}
    ]
    unnamed = events_of(spark, table_map(columns), inserts(columns, *rows))
    assert [as_dict(e["columns"])["e"] for e in unnamed] == ["1", "2", None]


@pytest.mark.parametrize("shape", list(fx.SHAPES))
def test_bench_shapes_hold_the_same_rows(spark, sf, shape):
    rows = mysql.row_events(fx.shape_capture(spark, sf, shape)).collect()
    assert len(rows) == 1500 and len({r.table for r in rows}) == fx.SHAPES[shape][0]
    assert {as_dict(r["columns"])["name"] for r in rows} == {f"order {k}" for k in range(1500)}
