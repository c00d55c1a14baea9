"""Fixed code tables of the two log formats, and lookups on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Binlog event types by code, 0 to 42.
EVENT_TYPES = """
UNKNOWN_EVENT START_EVENT_V3 QUERY_EVENT STOP_EVENT ROTATE_EVENT INTVAR_EVENT
LOAD_EVENT SLAVE_EVENT CREATE_FILE_EVENT APPEND_BLOCK_EVENT EXEC_LOAD_EVENT
DELETE_FILE_EVENT NEW_LOAD_EVENT RAND_EVENT USER_VAR_EVENT
FORMAT_DESCRIPTION_EVENT XID_EVENT BEGIN_LOAD_QUERY_EVENT
EXECUTE_LOAD_QUERY_EVENT TABLE_MAP_EVENT WRITE_ROWS_EVENTV0
UPDATE_ROWS_EVENTV0 DELETE_ROWS_EVENTV0 WRITE_ROWS_EVENTV1
UPDATE_ROWS_EVENTV1 DELETE_ROWS_EVENTV1 INCIDENT_EVENT HEARTBEAT_EVENT
IGNORABLE_EVENT ROWS_QUERY_EVENT WRITE_ROWS_EVENTV2 UPDATE_ROWS_EVENTV2
DELETE_ROWS_EVENTV2 GTID_EVENT ANONYMOUS_GTID_EVENT PREVIOUS_GTIDS_EVENT
TRANSACTION_CONTEXT_EVENT VIEW_CHANGE_EVENT XA_PREPARE_LOG_EVENT
PARTIAL_UPDATE_ROWS_EVENT TRANSACTION_PAYLOAD_EVENT HEARTBEAT_LOG_EVENT_V2
GTID_TAGGED_LOG_EVENT
""".split()

# Character set id, name, default collation.
CHARSETS = """
1 big5 big5_chinese_ci
3 dec8 dec8_swedish_ci
4 cp850 cp850_general_ci
6 hp8 hp8_english_ci
7 koi8r koi8r_general_ci
8 latin1 latin1_swedish_ci
9 latin2 latin2_general_ci
10 swe7 swe7_swedish_ci
11 ascii ascii_general_ci
12 ujis ujis_japanese_ci
13 sjis sjis_japanese_ci
16 hebrew hebrew_general_ci
18 tis620 tis620_thai_ci
19 euckr euckr_korean_ci
22 koi8u koi8u_general_ci
24 gb2312 gb2312_chinese_ci
25 greek greek_general_ci
26 cp1250 cp1250_general_ci
28 gbk gbk_chinese_ci
30 latin5 latin5_turkish_ci
32 armscii8 armscii8_general_ci
33 utf8 utf8_general_ci
35 ucs2 ucs2_general_ci
36 cp866 cp866_general_ci
37 keybcs2 keybcs2_general_ci
38 macce macce_general_ci
39 macroman macroman_general_ci
40 cp852 cp852_general_ci
41 latin7 latin7_general_ci
54 utf16 utf16_general_ci
56 utf16le utf16le_general_ci
57 cp1256 cp1256_general_ci
59 cp1257 cp1257_general_ci
60 utf32 utf32_general_ci
63 binary binary
83 cp1251 cp1251_general_ci
92 geostd8 geostd8_general_ci
95 cp932 cp932_japanese_ci
97 eucjpms eucjpms_japanese_ci
248 gb18030 gb18030_chinese_ci
255 utf8mb4 utf8mb4_0900_ai_ci
"""

# wal2json action codes.
WAL_ACTIONS = {
    "M": "message", "T": "truncate", "B": "begin", "C": "commit",
    "I": "insert", "U": "update", "D": "delete",
}

# Column definition to row-event column type.
SINK_TYPES = {
    "u64": "U64", "i64": "I64", "f64": "F64", "decimal": "Decimal",
    "json": "Json", "string": "String", "blob": "Bytes",
    "date": "Date", "datetime": "Date", "year": "U64", "time": "Time", "timestamp": "Timestamp",
    "datetime2": "Date", "time2": "Time", "timestamp2": "Timestamp", "enum": "String", "set": "String",
}

EVENT_CODE = {name: code for code, name in enumerate(EVENT_TYPES)}

TABLE_MAP = EVENT_CODE["TABLE_MAP_EVENT"]
ROTATE = EVENT_CODE["ROTATE_EVENT"]
FORMAT_DESCRIPTION = EVENT_CODE["FORMAT_DESCRIPTION_EVENT"]
XID = EVENT_CODE["XID_EVENT"]
QUERY = EVENT_CODE["QUERY_EVENT"]
GTID = EVENT_CODE["GTID_EVENT"]
ANONYMOUS_GTID = EVENT_CODE["ANONYMOUS_GTID_EVENT"]
PREVIOUS_GTIDS = EVENT_CODE["PREVIOUS_GTIDS_EVENT"]


def _versions(verb: str) -> list[int]:
    return [EVENT_CODE[f"{verb}_ROWS_EVENTV{v}"] for v in (0, 1, 2)]


INSERTS, UPDATES, DELETES = _versions("WRITE"), _versions("UPDATE"), _versions("DELETE")
ROW_EVENTS = INSERTS + UPDATES + DELETES
# Events that hold row changes in a form that is not decoded.
UNDECODED_CHANGES = [EVENT_CODE["PARTIAL_UPDATE_ROWS_EVENT"], EVENT_CODE["TRANSACTION_PAYLOAD_EVENT"]]
WITH_EXTRAS = [versions[2] for versions in (INSERTS, UPDATES, DELETES)]


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def event_name(code: Column) -> Column:
    """Name of a binlog event type; null when the code is unknown."""
    names = F.array(*[F.lit(n) for n in EVENT_TYPES])
    return F.when(code.between(0, len(EVENT_TYPES) - 1), F.get(names, code.cast("int")))


def event_route(code: Column) -> Column:
    """The decoder a type goes to, ``not_supported`` where there is none."""
    routes = [
        ("table_map", [TABLE_MAP]), ("rotate", [ROTATE]),
        ("format_description", [FORMAT_DESCRIPTION]),
        ("insert", INSERTS), ("update", UPDATES), ("delete", DELETES),
        ("xid", [XID]), ("gtid", [GTID]), ("previous_gtids", [PREVIOUS_GTIDS]),
        ("anonymous_gtid", [ANONYMOUS_GTID]),
    ]
    name, codes = routes[0]
    chain = reduce(
        lambda acc, r: acc.when(code.isin(r[1]), r[0]), routes[1:], F.when(code.isin(codes), name)
    )
    return chain.when(event_name(code).isNotNull(), "not_supported")


def action_kind(action: Column) -> Column:
    """Kind of a wal2json action; null when the code is unknown."""
    return literal_map(WAL_ACTIONS)[action]


def sink_type(definition: Column) -> Column:
    return literal_map(SINK_TYPES)[definition]


def charsets(spark: SparkSession) -> DataFrame:
    """``charset_id, charset, collation``: 41 fixed rows."""
    rows = [line.split() for line in CHARSETS.strip().splitlines()]
    return spark.createDataFrame(
        [(int(i), name, collation) for i, name, collation in rows],
        "charset_id INT, charset STRING, collation STRING",
    )


def with_charset(df: DataFrame, id_column: str) -> DataFrame:
    """Add charset and collation by id; the broadcast side has 41 rows."""
    table = charsets(df.sparkSession).withColumnRenamed("charset_id", id_column)
    return df.join(F.broadcast(table), id_column, "left")
