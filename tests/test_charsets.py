import numpy as np
import pyarrow as pa
import pytest

import capture_fixtures as fx
from tests.helpers import as_dict, capture, inserts, table_map
from tidemark.functions import charsets
from tidemark.plans import mysql


def field(code, value):
    return bytes([code]) + fx.lenc(len(value)) + value


def column_charsets(*ids):
    return field(3, b"".join(map(fx.lenc, ids)))


def decoded(spark, columns, rows, ids, **options):
    packets = table_map(columns, extra=column_charsets(*ids)), inserts(columns, *rows)
    return mysql.row_events(capture(spark, *packets), **options).orderBy("row_no").collect()


@pytest.mark.parametrize("charset", [*charsets.SINGLE_BYTE, *charsets.MULTI_BYTE])
def test_whole_columns_equal_single_values(charset):
    codec = charsets.SINGLE_BYTE.get(charset) or charsets.MULTI_BYTE[charset]
    rng = np.random.default_rng(5)
    values = [None, b"", *(bytes(rng.integers(0, 256, n % 9, np.uint8)) for n in range(300))]
    values += [chr(c).encode(codec, "ignore") for c in (0x41, 0xE9, 0x17C, 0x416, 0x3A9, 0x4E2D, 0xAC00)] * 2
    text, broken = charsets.transcoded(pa.array(values, pa.binary())[1:], charset)

    def one(v):
        try:
            return v.decode(codec)
        except UnicodeDecodeError:
            if codec != "cp1252":
                return None
            return "".join(bytes([b]).decode(codec) if b not in b"\x81\x8d\x8f\x90\x9d" else chr(b) for b in v)

    expected = [one(v) for v in values[1:]]
    assert text.to_pylist() == expected
    assert broken.tolist() == [e is None for e in expected]


def test_every_listed_charset_has_its_way():
    named = set(charsets.COLLATIONS) - {"binary"}
    assert named == set(charsets.SINGLE_BYTE) | set(charsets.MULTI_BYTE) | charsets.UTF8 | charsets.WITHOUT_CODEC
    assert sum(len(ids) for ids in charsets.COLLATIONS.values()) == len(charsets.CHARSET_OF)
    assert charsets.transcoded(pa.array([b"x", None], pa.binary()), "swe7")[1].tolist() == [True, False]


def test_unreadable_text_stays_bytes(spark):
    columns = [("a", "varchar(20)", True), ("b", "varchar(20)", True), ("c", "varchar(20)", True), ("n", "int", True)]
    rows = [[b"\xc3\xa9", b"\xff", b"ok", 1], [b"\xe9", "中".encode("gbk"), b"\xe9", None], [None, None, None, 3]]
    found = [as_dict(e["columns"]) for e in decoded(spark, columns, rows, [8, 28, 255])]
    assert found[0] == {"a": "Ã©", "b": b"\xff", "c": "ok", "n": 1}  # latin1 is not guessed to be UTF-8
    assert found[1] == {"a": "é", "b": "中", "c": b"\xe9", "n": None}
    assert found[2] == {"a": None, "b": None, "c": None, "n": 3}


def test_text_is_told_from_blob_where_asked(spark):
    columns = [("t", "text", True), ("b", "text", True), ("u", "text", True)]
    row = [[b"caf\xe9"] * 2 + ["é".encode()]]
    plain = decoded(spark, columns, row, [8, 63, 255])[0]["columns"]
    assert [(c.column_type, bytes(c.value.bytes)) for c in plain] == [("Bytes", b"caf\xe9")] * 2 + [("Bytes", "é".encode())]
    texts = decoded(spark, columns, row, [8, 63, 255], texts=True)[0]["columns"]
    assert [(c.column_type, c.value.str) for c in texts] == [("String", "café"), ("Bytes", None), ("String", "é")]
    unknown = mysql.row_events(capture(spark, table_map(columns, full=False), inserts(columns, *row)), texts=True).first()["columns"]
    assert {c.column_type for c in unknown} == {"Bytes"}


def test_names_of_choices_in_their_charset(spark):
    columns = [("e", "enum", True), ("x", "set", True), ("f", "enum", True)]
    one = lambda *names: fx.lenc(len(names)) + b"".join(fx.lenc(len(n)) + n for n in names)
    extra = field(5, one(b"\xe4", b"b")) + field(6, one("é".encode("utf-8")) + one("中".encode("gbk")))
    extra += field(11, b"".join(map(fx.lenc, (255, 8, 28))))
    found = mysql.row_events(capture(spark, table_map(columns, extra=extra), inserts(columns, [1, 3, 1]))).first()
    assert as_dict(found["columns"]) == {"e": "é", "x": "ä,b", "f": "中"}
