"""Every operator as a query over the driver tables, with its oracle.

The Spark side turns the tables into captures and decodes them again; the SQL
side computes the expected rows straight from the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import capture_fixtures as fixtures
from tidemark.functions import names, positions, temporals
from tidemark.functions.bytes import length_encoded
from tidemark.operators import asof, binlog, checksums, envelope, gtids as gtid_operator, payloads, pgoutput as pgoutput_operator, positions as progress, tablemap, timelines, transactions as txn, wal
from tidemark.plans import mysql, postgres
from tidemark.sources import captures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# --- SQL building blocks: what the captures hold, computed from the tables ---

ORDERS = """
o AS (SELECT *, o_orderkey AS k, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS t,
             16777216 + 1024 * o_orderkey AS base FROM orders)"""

WAL = ORDERS + """,
f AS (SELECT 'pg_orders' AS source, k, t, base, base + u.off AS seq, u.kind, u.action,
             CASE WHEN u.kind = 'w' THEN base + u.off END AS start_lsn, base + 512 AS end_lsn,
             CAST(epoch(t) AS BIGINT) * 1000000 - 946684800000000 AS clock_us
      FROM o, (VALUES (0, 'w', 'B'), (64, 'w', 'I'), (128, 'w', 'U'), (192, 'w', 'D'), (256, 'w', 'C'), (320, 'k', NULL),
                      (384, 'w', 'M'), (400, 'w', 'T'), (448, 't', NULL)) u(off, kind, action)
      WHERE u.off IN (0, 64, 256) OR (u.off = 128 AND k % 5 = 0) OR (u.off = 192 AND k % 7 = 0) OR (u.off = 320 AND k % 100 = 0)
         OR (u.off = 384 AND k % 50 = 0) OR (u.off = 400 AND k % 1000 = 0) OR (u.off = 448 AND k % 2500 = 0)
      UNION ALL
      SELECT 'pg_crm', c_custkey, TIMESTAMP '2000-01-01', NULL, 4096 + 64 * c_custkey, 'w', 'I', 4096 + 64 * c_custkey,
             4128 + 64 * c_custkey, 0 FROM customer)"""

BINLOG = ORDERS + """,
v AS (SELECT *, k // 5000 AS file_no, CASE k % 4 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 2 END AS version,
             CAST(epoch(t) AS BIGINT) AS stamp FROM o),
g AS (SELECT DISTINCT c_custkey // 16 AS g FROM customer),
e AS (SELECT 'my_orders' AS source, k * 20 + u.slot AS seq, u.slot, k, t, version, file_no,
             printf('binlog.%06d', file_no) AS log_file,
             CASE u.slot WHEN 0 THEN 0 ELSE 200 + (k % 5000) * 1000 + u.slot * 50 END AS log_position,
             CASE u.slot WHEN 0 THEN 0 ELSE stamp END AS stamp,
             CASE WHEN u.slot IN (6, 8, 10) THEN u.type + 3 * version + CASE version WHEN 2 THEN 4 ELSE 0 END
                  WHEN u.slot = 3 THEN 33 + k % 2 ELSE u.type END AS type
      FROM v, (VALUES (0, 4), (1, 15), (2, 35), (3, 33), (4, 2), (5, 19), (6, 20), (7, 19), (8, 21), (9, 19), (10, 22), (11, 16), (18, 4))
           u(slot, type)
      WHERE u.slot IN (3, 5, 6, 11) OR (u.slot <= 2 AND k % 5000 = 0) OR (u.slot = 4 AND k % 50 = 0)
         OR (u.slot IN (7, 8) AND k % 5 = 0) OR (u.slot IN (9, 10) AND k % 7 = 0)
         OR (u.slot = 18 AND k % 5000 = 4999)),
ev AS (SELECT source, seq, slot, k, type, log_file, stamp,
              CASE slot WHEN 18 THEN printf('binlog.%06d', file_no + 1) ELSE log_file END AS next_file,
              CASE WHEN slot = 0 AND file_no % 2 = 1 THEN 4294967300 ELSE 4 END AS next_pos,
              CASE WHEN slot = 1 THEN 0 ELSE log_position END AS log_position FROM e
       UNION ALL SELECT 'my_crm', 0, 0, NULL, 4, 'crm-bin.000001', 0, 'crm-bin.000001', 4, 0
       UNION ALL SELECT 'my_crm', g * 10 + u.slot + 1, u.slot + 20, g, u.type, 'crm-bin.000001', 1000000000, NULL, NULL, u.pos
                 FROM g, (VALUES (0, 19, 300), (1, 30, 400), (2, 16, 500)) u(slot, type, pos))"""

OP = "CASE WHEN type IN (20, 23, 30) THEN 'insert' WHEN type IN (21, 24, 31) THEN 'update' WHEN type IN (22, 25, 32) THEN 'delete' END"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"
MONEY = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)"
# Expected names, written out apart from the library's tables.
CHARSET_VALUES = """
    (1, 'big5', 'big5_chinese_ci'), (3, 'dec8', 'dec8_swedish_ci'), (4, 'cp850', 'cp850_general_ci'),
    (6, 'hp8', 'hp8_english_ci'), (7, 'koi8r', 'koi8r_general_ci'), (8, 'latin1', 'latin1_swedish_ci'),
    (9, 'latin2', 'latin2_general_ci'), (10, 'swe7', 'swe7_swedish_ci'), (11, 'ascii', 'ascii_general_ci'),
    (12, 'ujis', 'ujis_japanese_ci'), (13, 'sjis', 'sjis_japanese_ci'), (16, 'hebrew', 'hebrew_general_ci'),
    (18, 'tis620', 'tis620_thai_ci'), (19, 'euckr', 'euckr_korean_ci'), (22, 'koi8u', 'koi8u_general_ci'),
    (24, 'gb2312', 'gb2312_chinese_ci'), (25, 'greek', 'greek_general_ci'), (26, 'cp1250', 'cp1250_general_ci'),
    (28, 'gbk', 'gbk_chinese_ci'), (30, 'latin5', 'latin5_turkish_ci'), (32, 'armscii8', 'armscii8_general_ci'),
    (33, 'utf8', 'utf8_general_ci'), (35, 'ucs2', 'ucs2_general_ci'), (36, 'cp866', 'cp866_general_ci'),
    (37, 'keybcs2', 'keybcs2_general_ci'), (38, 'macce', 'macce_general_ci'), (39, 'macroman', 'macroman_general_ci'),
    (40, 'cp852', 'cp852_general_ci'), (41, 'latin7', 'latin7_general_ci'), (54, 'utf16', 'utf16_general_ci'),
    (56, 'utf16le', 'utf16le_general_ci'), (57, 'cp1256', 'cp1256_general_ci'), (59, 'cp1257', 'cp1257_general_ci'),
    (60, 'utf32', 'utf32_general_ci'), (63, 'binary', 'binary'), (83, 'cp1251', 'cp1251_general_ci'),
    (92, 'geostd8', 'geostd8_general_ci'), (95, 'cp932', 'cp932_japanese_ci'), (97, 'eucjpms', 'eucjpms_japanese_ci'),
    (248, 'gb18030', 'gb18030_chinese_ci'), (255, 'utf8mb4', 'utf8mb4_0900_ai_ci')"""
TYPE_VALUES = """
    (0, 'UNKNOWN_EVENT'), (1, 'START_EVENT_V3'), (2, 'QUERY_EVENT'), (3, 'STOP_EVENT'),
    (4, 'ROTATE_EVENT'), (5, 'INTVAR_EVENT'), (6, 'LOAD_EVENT'), (7, 'SLAVE_EVENT'),
    (8, 'CREATE_FILE_EVENT'), (9, 'APPEND_BLOCK_EVENT'), (10, 'EXEC_LOAD_EVENT'), (11, 'DELETE_FILE_EVENT'),
    (12, 'NEW_LOAD_EVENT'), (13, 'RAND_EVENT'), (14, 'USER_VAR_EVENT'), (15, 'FORMAT_DESCRIPTION_EVENT'),
    (16, 'XID_EVENT'), (17, 'BEGIN_LOAD_QUERY_EVENT'), (18, 'EXECUTE_LOAD_QUERY_EVENT'), (19, 'TABLE_MAP_EVENT'),
    (20, 'WRITE_ROWS_EVENTV0'), (21, 'UPDATE_ROWS_EVENTV0'), (22, 'DELETE_ROWS_EVENTV0'), (23, 'WRITE_ROWS_EVENTV1'),
    (24, 'UPDATE_ROWS_EVENTV1'), (25, 'DELETE_ROWS_EVENTV1'), (26, 'INCIDENT_EVENT'), (27, 'HEARTBEAT_EVENT'),
    (28, 'IGNORABLE_EVENT'), (29, 'ROWS_QUERY_EVENT'), (30, 'WRITE_ROWS_EVENTV2'), (31, 'UPDATE_ROWS_EVENTV2'),
    (32, 'DELETE_ROWS_EVENTV2'), (33, 'GTID_EVENT'), (34, 'ANONYMOUS_GTID_EVENT'), (35, 'PREVIOUS_GTIDS_EVENT')"""


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def text_time(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: beside the session's checkpoints,
    or else in its warehouse."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return f"{folder or spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"


def landed(capture: DataFrame, read=captures.read_binlog_capture) -> DataFrame:
    """A capture written once and read as what it is to the library, a file that lies
    there: its readers go over it several times, and would make it anew each time."""
    path = scratch(capture.sparkSession, "capture")
    capture.write.parquet(path)
    return read(capture.sparkSession, path)


def each_image(events: DataFrame, *keep: str) -> DataFrame:
    """Both images of every event as rows ``*keep, image, cells``, from one read."""
    one = lambda c: F.struct(F.lit(c).alias("image"), F.col(c).alias("cells"))
    return events.select(*keep, F.inline(F.array(one("columns"), one("identity")))).filter("cells IS NOT NULL")


def binlog_state(spark: SparkSession, sf: str):
    capture = landed(fixtures.binlog_capture(spark, sf))
    return capture, mysql.log_state(capture)


# --- sources and positions ---------------------------------------------------


@query("wal_scan", f"WITH {WAL} SELECT source, seq, kind, start_lsn, end_lsn, clock_us, "
       "CASE WHEN kind = 'k' THEN k % 200 = 0 END AS must_reply FROM f")
def wal_scan(spark, sf):
    path = scratch(spark, "wal")
    fixtures.wal_capture(spark, sf).write.json(path)
    return captures.read_wal_capture(spark, path, "json").select(
        "source", "seq", "kind", "start_lsn", "end_lsn", "clock_us", "must_reply"
    )


@query("binlog_scan", f"WITH {BINLOG} SELECT source, seq, CASE WHEN slot = 0 THEN 32 WHEN slot = 4 THEN 8 ELSE 0 END AS flags FROM ev")
def binlog_scan(spark, sf):
    path = scratch(spark, "binlog")
    fixtures.binlog_capture(spark, sf).write.parquet(path)
    return binlog.headers(captures.read_binlog_capture(spark, path)).select("source", "seq", "flags")


@query("wal_resume", f"WITH {WAL} SELECT source, seq, start_lsn FROM f "
       "WHERE source <> 'pg_orders' OR COALESCE(start_lsn, end_lsn) >= 16777216 + 1024 * 700 + 64")
def wal_resume(spark, sf):
    cursor = 16777216 + 1024 * 700 + 64
    return progress.wal_resume(fixtures.wal_capture(spark, sf), {"pg_orders": cursor}).select("source", "seq", "start_lsn")


BIG = f"""
b AS (SELECT 'my_big' AS source, k * 3 + slot AS seq, printf('binlog.%06d', k // 5000) AS log_file, CASE slot WHEN 1 THEN 16 ELSE 4 END AS event_type,
             CASE slot WHEN 0 THEN 0 ELSE (k % 5000 + 1) * CAST({fixtures.BIG_STEP} AS BIGINT) + CASE slot WHEN 2 THEN 50 ELSE 0 END END AS log_position
      FROM o, (VALUES (0), (1), (2)) u(slot) WHERE slot = 1 OR (slot = 0 AND k % 5000 = 0) OR (slot = 2 AND k % 5000 = 4999))"""


@query("binlog_resume", f"WITH {BINLOG}, {BIG} SELECT source, seq, log_file, log_position, type AS event_type FROM ev "
       "WHERE source <> 'my_orders' OR log_file > 'binlog.000000' OR log_position > 700550 "
       "UNION ALL SELECT source, seq, log_file, log_position, event_type FROM b WHERE log_file > 'binlog.000000' OR log_position > 4300000000")
def binlog_resume(spark, sf):
    """From a position in each source, one of them past 4 GiB of its file."""
    both = landed(fixtures.binlog_capture(spark, sf).unionByName(fixtures.big_capture(spark, sf)))
    state = mysql.log_state(both, long_files=True)
    cursors = {"my_orders": ("binlog.000000", 700550), "my_big": ("binlog.000000", 4_300_000_000)}
    packets = progress.packets_after(both, state.files.df, cursors)
    located = progress.with_full_position(asof.with_log_file(binlog.headers(packets), state.files), state.epochs)
    return progress.after_binlog_cursor(located, cursors).select("source", "seq", "log_file", "log_position", "event_type")


@query("latest_cursor", f"""WITH {WAL} SELECT source, CAST(NULL AS VARCHAR) AS log_file, max(end_lsn) AS position FROM f GROUP BY source
       UNION ALL SELECT 'my_orders', printf('binlog.%06d', (max(k) + 1) // 5000),
              CASE max(k) % 5000 WHEN 4999 THEN 4 ELSE 200 + (max(k) % 5000) * 1000 + 550 END FROM o
       UNION ALL SELECT 'my_crm', 'crm-bin.000001', 500""")
def latest_cursor(spark, sf):
    pg = progress.latest_wal_cursor(fixtures.wal_capture(spark, sf))
    my = progress.latest_binlog_cursor(landed(fixtures.binlog_capture(spark, sf)))
    return pg.select("source", F.lit(None).cast("string").alias("log_file"), F.col("lsn").alias("position")).unionByName(
        my.select("source", "log_file", F.col("log_position").alias("position"))
    )


@query("until_cursor", f"""WITH {WAL} SELECT source, seq FROM f WHERE source <> 'pg_orders' OR COALESCE(start_lsn, end_lsn) <= 16777216 + 1024 * 900
       UNION ALL SELECT source, seq FROM (WITH {BINLOG} SELECT * FROM ev)
       WHERE source <> 'my_orders' OR (log_file = 'binlog.000000' AND log_position <= 400500)
       UNION ALL SELECT source, seq FROM (WITH {ORDERS}, {BIG} SELECT * FROM b) WHERE log_file = 'binlog.000000' AND log_position <= 4400000000""")
def until_cursor(spark, sf):
    target = 16777216 + 1024 * 900
    frames = progress.wal_until(fixtures.wal_capture(spark, sf), {"pg_orders": target}).select("source", "seq")
    both = landed(fixtures.binlog_capture(spark, sf).unionByName(fixtures.big_capture(spark, sf)))
    state = mysql.log_state(both, long_files=True)
    targets = {"my_orders": ("binlog.000000", 400500), "my_big": ("binlog.000000", 4_400_000_000)}
    packets = progress.packets_until(both, state.files.df, targets)
    located = progress.with_full_position(asof.with_log_file(binlog.headers(packets), state.files), state.epochs)
    packets = progress.until_binlog_cursor(located, targets)
    return frames.unionByName(packets.select("source", "seq"))


# --- PostgreSQL ----------------------------------------------------------------


@query("wal_frames", f"WITH {WAL} SELECT source, seq, kind, start_lsn, end_lsn, clock_us, "
       "CASE WHEN kind = 'k' THEN k % 200 = 0 END AS must_reply, action FROM f WHERE kind <> 't'")
def wal_frames(spark, sf):
    frames = captures.wal_frames(fixtures.raw_frames(fixtures.wal_capture(spark, sf)))
    return frames.select("source", "seq", "kind", "start_lsn", "end_lsn", "clock_us", "must_reply",
                         F.get_json_object("message", "$.action").alias("action"))


@query("wal2json_decode", f"""WITH {WAL} SELECT source, seq, action,
       CASE WHEN source = 'pg_crm' THEN 'crm' WHEN action = 'T' THEN 'public' WHEN action IN ('I', 'U', 'D') THEN 'public' END AS "schema",
       CASE WHEN source = 'pg_crm' THEN 'customer' WHEN action = 'T' THEN 'scratch' WHEN action IN ('I', 'U', 'D') THEN 'orders' END AS "table",
       CAST(CASE WHEN source = 'pg_crm' THEN 4 WHEN action IN ('I', 'U') THEN 6 ELSE 0 END AS INTEGER) AS n_columns,
       CAST(CASE WHEN action IN ('U', 'D') THEN 1 ELSE 0 END AS INTEGER) AS n_identity,
       CASE WHEN action = 'M' THEN 'hb' END AS prefix, CASE WHEN action = 'M' THEN CAST(k AS VARCHAR) END AS content
       FROM f""")
def wal2json_decode(spark, sf):
    return wal.decode_wal(fixtures.wal_capture(spark, sf)).select(
        "source", "seq", "action", "schema", "table",
        F.coalesce(F.size("columns"), F.lit(0)).alias("n_columns"),
        F.coalesce(F.size("identity"), F.lit(0)).alias("n_identity"), "prefix", "content",
    )


@query("wal_actions", f"""WITH {WAL} SELECT source, CASE action WHEN 'M' THEN 'message' WHEN 'T' THEN 'truncate' WHEN 'B' THEN 'begin'
       WHEN 'C' THEN 'commit' WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' WHEN 'D' THEN 'delete' END AS action_kind,
       count(*) AS n FROM f WHERE action IS NOT NULL GROUP BY ALL""")
def wal_actions(spark, sf):
    decoded = wal.decode_wal(fixtures.wal_capture(spark, sf)).filter("kind = 'w'")
    return decoded.groupBy("source", "action_kind").agg(F.count("*").alias("n"))


@query("wal_columns", f"""WITH {WAL} SELECT f.source, f.seq, f.action, c.name, c.type,
       CASE c.name WHEN 'o_orderkey' THEN CAST(f.k AS VARCHAR) WHEN 'o_custkey' THEN CAST(o.o_custkey AS VARCHAR)
            WHEN 'o_orderstatus' THEN CASE f.action WHEN 'U' THEN 'X' ELSE o.o_orderstatus END
            WHEN 'total' THEN {MONEY}
            WHEN 'o_orderdate' THEN {STAMP.format('o.t')}
            ELSE CASE WHEN f.k % 11 <> 0 THEN o.o_orderpriority END END AS value
       FROM f JOIN o ON f.k = o.k AND f.source = 'pg_orders' AND f.action IN ('I', 'U'),
       (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'text'), ('total', 'numeric(15,2)'),
               ('o_orderdate', 'timestamp without time zone'), ('o_orderpriority', 'text')) c(name, type)
       UNION ALL SELECT 'pg_crm', 4096 + 64 * c_custkey, 'I', c.name, c.type,
       CASE c.name WHEN 'c_custkey' THEN CAST(c_custkey AS VARCHAR) WHEN 'c_name' THEN c_name
            WHEN 'c_acctbal' THEN CAST(c_acctbal AS VARCHAR) ELSE CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END END
       FROM customer, (VALUES ('c_custkey', 'bigint'), ('c_name', 'character varying(25)'), ('c_acctbal', 'double precision'),
                              ('c_vip', 'boolean')) c(name, type)""")
def wal_columns(spark, sf):
    changes = wal.column_changes(wal.decode_wal(fixtures.wal_capture(spark, sf)))
    # a double's text depends on who prints it: 17.0 and 17 are the same
    number = F.when(F.col("type") == "double precision", F.col("value").cast("double").cast("string"))
    return changes.select(
        "source", "seq", F.upper(F.substring("action_kind", 1, 1)).alias("action"), "name", "type",
        F.coalesce(number, "value").alias("value"),
    )


@query("wal_quarantine", f"""WITH {ORDERS} SELECT base + 416 AS seq, 'malformed JSON' AS error FROM o WHERE k % 997 = 0
       UNION ALL SELECT base + 420, 'unknown action Z' FROM o WHERE k % 499 = 0
       UNION ALL SELECT base + 424, 'missing columns' FROM o WHERE k % 251 = 0""")
def wal_quarantine(spark, sf):
    return wal.wal_quarantine(fixtures.wal_capture(spark, sf, bad=True)).select("seq", "error")


@query("wal_numerics", f"""WITH {ORDERS} SELECT base + 64 AS seq, {MONEY} AS total FROM o
       UNION ALL SELECT base + 128, {MONEY} FROM o WHERE k % 5 = 0 UNION ALL SELECT base + 428, repeat('1', 45) || '.25' FROM o WHERE k % 307 = 0""")
def wal_numerics(spark, sf):
    """Numerics as the server printed them, last zeros and sixty digits included."""
    events = postgres.row_events(fixtures.wal_capture(spark, sf, bad=True), ["public.orders"], "skip").filter("op <> 'delete'")
    total = F.get(F.filter("columns", lambda c: c["name"] == "total"), F.lit(0))["value"]["str"]
    return events.select("seq", total.alias("total"))


@query("wal_clock", f"WITH {WAL} SELECT source, seq, {STAMP.format('t')} AS event_time FROM f")
def wal_clock(spark, sf):
    capture = fixtures.wal_capture(spark, sf)
    return capture.select("source", "seq", text_time(positions.pg_clock(F.col("clock_us"))).alias("event_time"))


@query("lsn_parse", f"WITH {WAL} SELECT source, seq, CAST(seq % 100000 AS INTEGER) AS tid, end_lsn AS lsn, end_lsn * 1000003 AS wide_lsn FROM f")
def lsn_parse(spark, sf):
    capture = fixtures.wal_capture(spark, sf)
    tid = F.col("seq") % 100_000
    wide = F.col("end_lsn") * 1000003
    texts = capture.select(
        "source",
        "seq",
        F.format_string("%d/%X", tid, F.col("end_lsn")).alias("cursor"),
        F.format_string("%X/%08X", F.shiftright(wide, 32), wide.bitwiseAND(F.lit(0xFFFFFFFF))).alias("lsn_text"),
    )
    cursor = positions.parse_wal_cursor(F.col("cursor"))
    return texts.select(
        "source", "seq", cursor["tid"].alias("tid"), cursor["lsn"].alias("lsn"),
        positions.parse_lsn(F.col("lsn_text")).alias("wide_lsn"),
    )


@query("lsn_format", f"""WITH {WAL} SELECT source, seq, printf('%d/%X', seq % 100000, end_lsn) AS cursor,
       printf('%X/%X', end_lsn * 1000003 // 4294967296, end_lsn * 1000003 % 4294967296) AS lsn_text FROM f""")
def lsn_format(spark, sf):
    capture = fixtures.wal_capture(spark, sf)
    tid = F.col("seq") % 100_000
    return capture.select(
        "source", "seq", positions.format_wal_cursor(tid, F.col("end_lsn")).alias("cursor"),
        positions.format_lsn(F.col("end_lsn") * 1000003).alias("lsn_text"),
    )


@query("wal_progress", f"""WITH {WAL} SELECT source, CASE WHEN source = 'pg_orders' THEN CAST(1 + max(k) // 2500 AS INTEGER) END AS tid,
       max(end_lsn) AS reported_lsn, max(CASE WHEN action = 'C' THEN start_lsn END) + 1 AS safe_lsn, count(*) AS events FROM f GROUP BY source""")
def wal_progress(spark, sf):
    return progress.wal_progress(wal.decode_wal(fixtures.wal_capture(spark, sf)))


@query("wal_timeline", f"""WITH {WAL} SELECT source, CAST(CASE source WHEN 'pg_orders' THEN 1 + max(k) // 2500 ELSE 1 END AS INTEGER) AS tid,
       max(end_lsn) AS lsn FROM f GROUP BY source""")
def wal_timeline(spark, sf):
    return progress.wal_timeline(fixtures.wal_capture(spark, sf))


BRANCH = f"""n AS (SELECT k, k // 300 AS n, 16777216 + 1024 * (k - 10 * (k // 300) - 310 * (k // 900)) AS base FROM o),
fork AS (SELECT n, base AS lsn FROM n WHERE k % 300 = 0 AND n > 0),
line AS (SELECT n.n, (SELECT min(lsn) FROM fork WHERE fork.n > n.n) AS until_lsn FROM (SELECT DISTINCT n FROM n) n),
b AS (SELECT source, k * 5 + slot AS seq, kind, CAST(n + 1 AS INTEGER) AS tid, until_lsn, CASE WHEN kind = 'w' THEN base + off ELSE base + 512 * (slot // 4) END AS lsn
      FROM n JOIN line USING (n), (VALUES (0, 't', 0), (1, 'w', 0), (2, 'w', 64), (3, 'w', 256), (4, 'k', 0)) u(slot, kind, off),
           (VALUES ('pg_ha'), ('pg_hb')) s(source) WHERE kind = 'w' OR (slot = 0 AND k % 300 = 0 AND n > 0) OR (slot = 4 AND k % 100 = 0)),
branch AS (SELECT *, kind = 'w' AND coalesce(lsn >= until_lsn, false) AS abandoned FROM b)"""


@query("wal_branch", f"WITH {ORDERS}, {BRANCH} SELECT source, seq, tid, until_lsn, abandoned FROM branch")
def wal_branch(spark, sf):
    """Each frame's timeline, and whether a failover left it behind."""
    capture = fixtures.branch_capture(spark, sf)
    return timelines.with_timeline(capture, timelines.timelines(capture)).select("source", "seq", "tid", "until_lsn", "abandoned")


@query("wal_branch_resume", f"""WITH {ORDERS}, {BRANCH} SELECT source, seq, kind FROM branch WHERE NOT abandoned
       AND lsn >= CASE source WHEN 'pg_ha' THEN 16777216 + 1024 * 400 + 64 ELSE (SELECT min(lsn) FROM fork WHERE n > 2) END""")
def wal_branch_resume(spark, sf):
    """From a position on the present branch, two switches back, and from one past
    the fork where its timeline was left."""
    cursors = {"pg_ha": (2, 16777216 + 1024 * 400 + 64), "pg_hb": (3, 16777216 + 1024 * 700)}
    return timelines.branch_resume(fixtures.branch_capture(spark, sf), cursors).select("source", "seq", "kind")


@query("pg_row_events", f"""WITH {WAL} SELECT source, seq,
       CASE action WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' ELSE 'delete' END AS op,
       CASE source WHEN 'pg_crm' THEN 'crm' ELSE 'public' END AS "schema", CASE source WHEN 'pg_crm' THEN 'customer' ELSE 'orders' END AS "table",
       CASE action WHEN 'D' THEN NULL ELSE k END AS first_value, CASE WHEN action <> 'I' THEN k END AS identity_value,
       {STAMP.format('t')} AS event_time FROM f WHERE action IN ('I', 'U', 'D')""")
def pg_row_events(spark, sf):
    return postgres.row_events(fixtures.wal_capture(spark, sf)).select(
        "source", "seq", "op", "schema", "table", F.col("columns")[0]["value"]["i64"].alias("first_value"),
        F.col("identity")[0]["value"]["i64"].alias("identity_value"), text_time("event_time").alias("event_time"),
    )


def pgoutput(spark, sf, bad=False):
    return captures.pgoutput_frames(landed(fixtures.pgoutput_capture(spark, sf, bad)))


PGOUTPUT = WAL + """,
po AS (SELECT source, k, t, seq, kind, action, start_lsn, end_lsn FROM f WHERE kind = 'w' AND action IN ('B', 'I', 'U', 'D', 'C', 'M', 'T')),
pp AS (SELECT source, k, t, seq, action, CASE WHEN source = 'pg_crm' THEN 'crm' WHEN action IN ('I', 'U', 'D', 'T') THEN 'public' END AS s,
              CASE WHEN source = 'pg_crm' THEN 'customer' WHEN action IN ('I', 'U', 'D', 'T') THEN 'orders' END AS tb FROM po
       UNION ALL SELECT source, k, t, seq, action, 'public', 'scratch' FROM po WHERE action = 'T'
       UNION ALL SELECT 'pg_orders', k, t, base + u.off, NULL, NULL, NULL FROM o, (VALUES (60), (61)) u(off) WHERE k % 500 = 0
       UNION ALL SELECT 'pg_crm', NULL, NULL, 1, NULL, NULL, NULL)"""


@query("pgoutput_decode", f"""WITH {PGOUTPUT} SELECT source, seq, action, s AS "schema", tb AS "table",
       CAST(CASE WHEN source = 'pg_crm' THEN CASE action WHEN 'I' THEN 4 ELSE 0 END WHEN action = 'I' THEN 6
            WHEN action = 'U' THEN CASE WHEN k % 10 = 0 THEN 5 ELSE 6 END ELSE 0 END AS INTEGER) AS n_columns,
       CAST(CASE WHEN action IN ('U', 'D') THEN 1 ELSE 0 END AS INTEGER) AS n_identity, CASE WHEN action = 'M' THEN 'hb' END AS prefix,
       CASE WHEN action = 'M' THEN CAST(k AS VARCHAR) END AS content, CASE WHEN action = 'B' THEN k END AS xid,
       CASE WHEN action IN ('B', 'C') THEN {STAMP.format('t')} END AS commit_time FROM pp""")
def pgoutput_decode(spark, sf):
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return pgoutput_operator.decode_pgoutput(pgoutput(spark, sf)).select(
        "source", "seq", "action", "schema", "table", size("columns").alias("n_columns"), size("identity").alias("n_identity"),
        "prefix", "content", "xid", text_time("commit_time").alias("commit_time"),
    )


@query("pgoutput_row_events", f"""WITH {WAL}, c AS (
       SELECT f.source, f.seq, f.action, c.image, c.name, c.type, c.kind,
       CASE c.name WHEN 'o_orderkey' THEN CAST(f.k AS VARCHAR) WHEN 'o_custkey' THEN CAST(o.o_custkey AS VARCHAR)
            WHEN 'o_orderstatus' THEN CASE f.action WHEN 'U' THEN 'X' ELSE o.o_orderstatus END
            WHEN 'total' THEN {MONEY} WHEN 'o_orderdate' THEN {STAMP.format('o.t')}
            ELSE CASE WHEN f.k % 11 <> 0 THEN o.o_orderpriority END END AS value
       FROM f JOIN o ON f.k = o.k AND f.source = 'pg_orders' AND f.action IN ('I', 'U', 'D'),
       (VALUES ('columns', 'o_orderkey', 'bigint', 'I64'), ('columns', 'o_custkey', 'bigint', 'I64'), ('columns', 'o_orderstatus', 'text', 'String'),
               ('columns', 'total', 'numeric(15,2)', 'Decimal'), ('columns', 'o_orderdate', 'timestamp without time zone', 'Timestamp'),
               ('columns', 'o_orderpriority', 'text', 'String'), ('identity', 'o_orderkey', 'bigint', 'I64')) c(image, name, type, kind)
       WHERE CASE c.image WHEN 'columns' THEN f.action <> 'D' AND NOT (f.action = 'U' AND f.k % 10 = 0 AND c.name = 'o_orderpriority') ELSE f.action <> 'I' END
       UNION ALL SELECT 'pg_crm', 4096 + 64 * c_custkey, 'I', 'columns', c.name, c.type, c.kind,
       CASE c.name WHEN 'c_custkey' THEN CAST(c_custkey AS VARCHAR) WHEN 'c_name' THEN c_name
            WHEN 'c_acctbal' THEN CAST(c_acctbal AS VARCHAR) ELSE CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END END
       FROM customer, (VALUES ('c_custkey', 'bigint', 'I64'), ('c_name', 'character varying(25)', 'String'), ('c_acctbal', 'double precision', 'F64'),
                              ('c_vip', 'boolean', 'String')) c(name, type, kind))
       SELECT source, seq, CASE action WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' ELSE 'delete' END AS op, image, name, type, kind, value FROM c""")
def pgoutput_row_events(spark, sf):
    """Every value of every image; equal to the wal2json events but for values sent
    as unchanged, which have no column."""
    events = postgres.pgoutput_row_events(pgoutput(spark, sf))
    cells = each_image(events, "source", "seq", "op").select("source", "seq", "op", "image", F.inline("cells"))
    v = F.col("value")
    text = F.coalesce(v["str"], v["i64"].cast("string"), v["f64"].cast("string"))
    return cells.select(
        "source", "seq", "op", "image", "name", F.col("type_name").alias("type"), F.col("column_type").alias("kind"), text.alias("value")
    )


@query("pgoutput_quarantine", f"""WITH {ORDERS} SELECT base + 416 AS seq, 'message cut short' AS error FROM o WHERE k % 997 = 0
       UNION ALL SELECT base + 420, 'unknown message 5A' FROM o WHERE k % 499 = 0
       UNION ALL SELECT base + 424, 'no relation before the row message' FROM o WHERE k % 251 = 0
       UNION ALL SELECT base + 428, 'column count differs from the relation' FROM o WHERE k % 307 = 0""")
def pgoutput_quarantine(spark, sf):
    decoded = pgoutput_operator.decode_pgoutput(pgoutput(spark, sf, bad=True), on_error="keep")
    return decoded.filter("error IS NOT NULL").select("seq", "error")


TXN = ("txn_seq, txn_id, row_number() OVER (PARTITION BY source, txn_seq ORDER BY seq, row_no) - 1 AS txn_row, commit_seq, commit_time, txn_state")


def flat_transactions(events):
    return events.select("source", "seq", "row_no", "op", *txn.PLACE).withColumn("commit_time", text_time("commit_time"))


@query("pg_transactions", f"""WITH {WAL}, r AS (SELECT source, seq, 0 AS row_no, CASE action WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' ELSE 'delete' END AS op,
       base AS txn_seq, CAST(NULL AS VARCHAR) AS txn_id, base + 256 AS commit_seq, {STAMP.format('t')} AS commit_time, 'committed' AS txn_state
       FROM f WHERE action IN ('I', 'U', 'D') AND source = 'pg_orders')
       SELECT source, seq, row_no, op, {TXN} FROM r
       UNION ALL SELECT 'pg_crm', 4096 + 64 * c_custkey, 0, 'insert', NULL, NULL, NULL, NULL, NULL, 'outside' FROM customer""")
def pg_transactions(spark, sf):
    capture = landed(fixtures.wal_capture(spark, sf), captures.read_wal_capture)
    return flat_transactions(postgres.transactions(wal.decode_wal(capture), frames=capture))


@query("pgoutput_transactions", f"""WITH {WAL}, r AS (SELECT source, seq, 0 AS row_no, CASE action WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' ELSE 'delete' END AS op,
       base AS txn_seq, CAST(k AS VARCHAR) AS txn_id, base + 256 AS commit_seq, {STAMP.format('t')} AS commit_time, 'committed' AS txn_state
       FROM f WHERE action IN ('I', 'U', 'D') AND source = 'pg_orders')
       SELECT source, seq, row_no, op, {TXN} FROM r""")
def pgoutput_transactions(spark, sf):
    frames = pgoutput(spark, sf)
    decoded = pgoutput_operator.decode_pgoutput(frames)
    return flat_transactions(txn.committed(postgres.transactions(decoded, ["public.orders"], frames)))


# --- MySQL: headers and simple events ------------------------------------------


@query("binlog_headers", f"WITH {BINLOG} SELECT source, seq, stamp AS timestamp, type AS event_type, 1 AS server_id, log_position FROM ev")
def binlog_headers(spark, sf):
    return binlog.headers(fixtures.binlog_capture(spark, sf)).select(
        "source", "seq", "timestamp", "event_type", "server_id", "log_position"
    )


@query("binlog_types", f"WITH {BINLOG} SELECT source, name AS event_name, count(*) AS n FROM ev JOIN (VALUES {TYPE_VALUES}) t(code, name) ON type = code GROUP BY ALL")
def binlog_types(spark, sf):
    named = binlog.with_names(binlog.headers(fixtures.binlog_capture(spark, sf)))
    return named.groupBy("source", "event_name").agg(F.count("*").alias("n"))


@query("binlog_routing", f"""WITH {BINLOG} SELECT source, seq, CASE type WHEN 19 THEN 'table_map' WHEN 4 THEN 'rotate' WHEN 15 THEN 'format_description'
       WHEN 16 THEN 'xid' WHEN 33 THEN 'gtid' WHEN 34 THEN 'anonymous_gtid' WHEN 35 THEN 'previous_gtids' WHEN 2 THEN 'not_supported'
       ELSE {OP} END AS route FROM ev""")
def binlog_routing(spark, sf):
    return binlog.with_names(binlog.headers(fixtures.binlog_capture(spark, sf))).select("source", "seq", "route")


@query("binlog_rotate", f"WITH {BINLOG} SELECT source, seq, CAST(next_pos AS BIGINT) AS next_log_position, next_file AS next_log_file FROM ev WHERE type = 4")
def binlog_rotate(spark, sf):
    return binlog.rotates(fixtures.binlog_capture(spark, sf)).select("source", "seq", "next_log_position", "next_log_file")


@query("binlog_format_desc", f"""WITH {BINLOG} SELECT source, seq, 4 AS version, '8.0.36-fixture' AS server_version, stamp AS create_timestamp,
       19 AS event_header_length, 38 AS n_header_lengths FROM ev WHERE type = 15""")
def binlog_format_desc(spark, sf):
    found = binlog.format_descriptions(fixtures.binlog_capture(spark, sf))
    return found.withColumn("n_header_lengths", F.length("event_type_header_lengths")).drop("event_type_header_lengths")


SUMS = """
c AS (SELECT k, k // 400 AS n, slot, k * 5 + slot AS seq FROM o, (VALUES (0), (1), (2), (3), (4)) u(slot) WHERE slot > 1 OR k % 400 = 0)"""


@query("binlog_checksums", f"""WITH {ORDERS}, {SUMS} SELECT seq, CASE WHEN slot = 1 OR (n % 2 = 0) = (slot > 0) OR n = 0 THEN 4 ELSE 0 END AS checksum_len,
       CASE WHEN slot = 3 AND n % 2 = 0 AND k % 97 = 0 THEN 'checksum differs' END AS error FROM c""")
def binlog_checksums(spark, sf):
    """Every packet verified by the algorithm of its file."""
    capture = fixtures.checksum_capture(spark, sf)
    return checksums.with_checksums(capture, checksums.algorithms(capture)).select("seq", "checksum_len", "error")


@query("binlog_checked_rows", f"""WITH {ORDERS} SELECT k, CASE WHEN k % 97 = 0 THEN '?' ELSE o_orderstatus END AS status, printf('binlog.%06d', k // 400) AS log_file
       FROM o WHERE k % 97 <> 0 OR k // 400 % 2 = 1""")
def binlog_checked_rows(spark, sf):
    """Rows decoded once checksums are verified and taken off; a file without them
    lets damage through."""
    packets = checksums.plain_packets(fixtures.checksum_capture(spark, sf), on_error="skip")
    rows = mysql.table_rows(packets, "shop.sums", "k BIGINT, status STRING")
    return rows.select("k", "status", F.col("cursor.file").alias("log_file"))


@query("binlog_xid", f"""WITH {BINLOG} SELECT source, seq, CAST(CASE WHEN source = 'my_orders' THEN k
       ELSE least(16, (SELECT count(*) FROM customer) - 16 * k) END AS VARCHAR) AS xid FROM ev WHERE type = 16""")
def binlog_xid(spark, sf):
    found = binlog.xids(fixtures.binlog_capture(spark, sf))
    return found.select("source", "seq", F.col("xid").cast("string").alias("xid"))


@query("binlog_gtid_markers", f"""WITH {BINLOG} SELECT seq, CASE type WHEN 33 THEN 'gtid' WHEN 34 THEN 'anonymous_gtid' ELSE 'previous_gtids' END AS marker,
       CASE WHEN type = 34 THEN CAST(8 AS INTEGER) END AS body_length FROM ev WHERE type IN (33, 34, 35)""")
def binlog_gtid_markers(spark, sf):
    found = binlog.gtid_markers(fixtures.binlog_capture(spark, sf))
    return found.select("seq", "marker", F.length("body").alias("body_length"))


@query("row_event_headers", f"""WITH {BINLOG} SELECT source, seq, {OP} AS op, CAST(CASE source WHEN 'my_crm' THEN 101 ELSE 100 END AS BIGINT) AS table_id,
       1 AS flags, CASE WHEN type >= 30 THEN 0 END AS extras_length, 11 AS column_count FROM ev WHERE {OP} IS NOT NULL""")
def row_event_headers(spark, sf):
    return binlog.row_event_headers(fixtures.binlog_capture(spark, sf))


@query("lenc_uint", f"""WITH {ORDERS}, n AS (SELECT k, CASE k % 4 WHEN 0 THEN k % 251 WHEN 1 THEN k % 65536 WHEN 2 THEN 70000 + k ELSE 5000000000 + k END AS v FROM o)
       SELECT k, v AS value, CASE WHEN v < 251 THEN 1 WHEN v < 65536 THEN 3 WHEN v < 16777216 THEN 4 ELSE 9 END AS width FROM n""")
def lenc_uint(spark, sf):
    k = F.col("k")
    v = F.when(k % 4 == 0, k % 251).when(k % 4 == 1, k % 65536).when(k % 4 == 2, k + 70000).otherwise(k + 5000000000)
    byte = lambda c: F.unhex(F.lpad(F.hex(c), 2, "0"))
    little = lambda n: F.concat(*[byte(F.shiftright("v", 8 * i).bitwiseAND(F.lit(255))) for i in range(n)])
    packed = (
        F.when(F.col("v") < 251, little(1)).when(F.col("v") < 1 << 16, F.concat(F.lit(b"\xfc"), little(2)))
        .when(F.col("v") < 1 << 24, F.concat(F.lit(b"\xfd"), little(3))).otherwise(F.concat(F.lit(b"\xfe"), little(8)))
    )
    orders = fixtures.orders(spark, sf).select("k", v.alias("v")).select("k", packed.alias("packed"))
    found = length_encoded(F.col("packed"), 1)
    return orders.select("k", found["value"].cast("bigint").alias("value"), found["width"].alias("width"))


@query("binlog_cursor_parse", f"""WITH {ORDERS} SELECT k, 'bin.' || CAST(999990 + k AS VARCHAR) AS log_file, k * 100000000 AS log_position, 999990 + k AS file_no,
       'bin.' || CAST(999990 + k AS VARCHAR) || '/' || CAST(k * 100000000 AS VARCHAR) AS printed,
       (999990 + k, k * 100000000) > (1000000, 1000000000) AS past_cursor FROM o""")
def binlog_cursor_parse(spark, sf):
    k = F.col("k")
    texts = fixtures.orders(spark, sf).select("k", F.format_string("bin.%06d/%d", k + 999990, k * 100_000_000).alias("text"))
    c = positions.parse_binlog_cursor(F.col("text"))
    order = positions.binlog_order(c["log_file"], c["log_position"])
    limit = positions.binlog_order(F.lit("bin.1000000"), F.lit(1_000_000_000).cast("bigint"))
    return texts.select(
        "k", c["log_file"].alias("log_file"), c["log_position"].alias("log_position"), order["file_no"].alias("file_no"),
        positions.format_binlog_cursor(c["log_file"], c["log_position"]).alias("printed"), (order > limit).alias("past_cursor"),
    )


GTIDS = ORDERS + """,
q AS (SELECT k, CASE k % 3 WHEN 0 THEN '01010101-0101-0101-0101-010101010101' WHEN 1 THEN '02020202-0202-0202-0202-020202020202'
                ELSE '03030303-0303-0303-0303-030303030303' END AS server_uuid, k // 3 + 1 + k // 1500 * 10 AS gno FROM o)"""
ISLANDS = "SELECT {0}, min(gno) AS lo, max(gno) + 1 AS hi FROM (SELECT *, gno - row_number() OVER (PARTITION BY {0} ORDER BY gno) AS i FROM {1}) GROUP BY {0}, i"


@query("binlog_gtids", f"""WITH {GTIDS} SELECT 'gtid' AS kind, k * 10 + 3 AS seq, server_uuid, gno AS lo, gno + 1 AS hi, k AS last_committed FROM q WHERE k % 90 <> 0
       UNION ALL SELECT 'previous', f.k * 10 + 2, s.server_uuid, s.lo, s.hi, NULL FROM (SELECT k FROM o WHERE k % 5000 = 0 AND k > 0) f,
       LATERAL ({ISLANDS.format('server_uuid', '(SELECT * FROM q WHERE q.k < f.k)')}) s""")
def binlog_gtids(spark, sf):
    capture = landed(fixtures.gtid_capture(spark, sf))
    one = gtid_operator.gtids(capture).select(
        F.lit("gtid").alias("kind"), "seq", "server_uuid", F.col("gno").alias("lo"), (F.col("gno") + 1).alias("hi"), "last_committed"
    )
    sets = gtid_operator.previous_gtids(capture).select(
        F.lit("previous").alias("kind"), "seq", "server_uuid", "lo", "hi", F.lit(None).cast("bigint").alias("last_committed")
    )
    return one.unionByName(sets)


@query("gtid_resume", f"""WITH {GTIDS}, p AS (SELECT k, k * 10 + slot AS seq, slot FROM o, (VALUES (0), (2), (3), (4), (5), (6)) u(slot) WHERE slot > 2 OR k % 5000 = 0)
       SELECT p.seq FROM p JOIN q USING (k) WHERE slot < 3 OR k % 90 = 0
       OR NOT (server_uuid LIKE '01%' AND (gno BETWEEN 1 AND 100 OR gno BETWEEN 105 AND 300) OR server_uuid LIKE '03%' AND gno BETWEEN 50 AND 400)""")
def gtid_resume(spark, sf):
    """Packets of transactions that a replica with a set of gaps does not have yet."""
    capture = landed(fixtures.gtid_capture(spark, sf))
    have = "01010101-0101-0101-0101-010101010101:1-100:105-300, 03030303-0303-0303-0303-030303030303:50-200:201-400"
    packets = binlog.headers(capture).select("source", "seq", F.lit(0).alias("row_no"))
    return gtid_operator.gtid_resume(packets, capture, gtid_operator.parse_set(spark, have), places=capture).select("seq")


@query("gtid_progress", f"""WITH {GTIDS}, d AS (SELECT server_uuid, gno FROM q WHERE k % 40 <> 0 AND k % 90 <> 0 UNION SELECT server_uuid, range FROM (SELECT DISTINCT server_uuid FROM q), range(1, 51))
       SELECT 'my_gtids' AS source, * FROM ({ISLANDS.format('server_uuid', 'd')})""")
def gtid_progress(spark, sf):
    """The executed set after the capture, on top of an earlier one."""
    before = spark.createDataFrame([("my_gtids", "-".join([f"0{i}" * 4, *[f"0{i}" * 2] * 3, f"0{i}" * 6]), 1, 51) for i in (1, 2, 3)], "source STRING, " + gtid_operator.SET)
    return gtid_operator.gtid_progress(landed(fixtures.gtid_capture(spark, sf)), before)


# --- MySQL: catalog and association --------------------------------------------

VERSIONS = """
ver AS (SELECT DISTINCT 'my_orders' AS source, CAST(100 AS BIGINT) AS table_id, file_no * 100000 + 5 AS seq, file_no % 2 AS b, log_file,
               'shop' AS s, 'orders' AS tb FROM e
        UNION ALL SELECT 'my_crm', 101, 1, 2, 'crm-bin.000001', 'crm', 'customer')"""

COLUMN_VALUES = ", ".join(
    f"({b}, {i}, '{n}', '{t}', {str(null).lower()})"
    for b, columns in enumerate((fixtures.ORDERS_A, fixtures.ORDERS_B, fixtures.CUSTOMER))
    for i, (n, t, null) in enumerate(columns)
)
DEFINITIONS = """
d(type, definition, type_name, pack, column_type) AS (VALUES ('bigint', 'i64', 'bigint', 8, 'I64'), ('ubigint', 'u64', 'bigint unsigned', 8, 'U64'),
  ('uint', 'u64', 'int unsigned', 4, 'U64'), ('smallint', 'i64', 'smallint', 2, 'I64'), ('float', 'f64', 'float', 4, 'F64'),
  ('double', 'f64', 'double', 8, 'F64'), ('char(1)', 'string', 'char(1)', 1, 'String'), ('char(2)', 'string', 'char(2)', 1, 'String'),
  ('decimal(15,2)', 'decimal', 'decimal(15,2)', NULL, 'Decimal'), ('decimal(10,4)', 'decimal', 'decimal(10,4)', NULL, 'Decimal'),
  ('datetime', 'datetime', 'datetime', NULL, 'Date'), ('date', 'date', 'date', NULL, 'Date'), ('time', 'time', 'time', NULL, 'Time'),
  ('year', 'year', 'year', NULL, 'U64'), ('timestamp', 'timestamp', 'timestamp', NULL, 'Timestamp'), ('varchar(15)', 'string', 'varchar(15)', 1, 'String'),
  ('varchar(300)', 'string', 'varchar(300)', 2, 'String'), ('varchar(25)', 'string', 'varchar(25)', 1, 'String'), ('text', 'blob', 'blob', 2, 'Bytes'),
  ('bit64', 'u64', 'bit(64)', 8, 'U64'), ('json', 'json', 'json', 4, 'Json'))"""


@query("schema_catalog", f"""WITH {BINLOG}, {VERSIONS} SELECT source, table_id, seq, s AS "schema", tb AS "table", log_file,
       11 AS n_columns, CASE b WHEN 0 THEN 'o_orderpriority' WHEN 1 THEN 'o_ts' ELSE 'c_json' END AS last_column, 0 AS key_column FROM ver""")
def schema_catalog(spark, sf):
    _, state = binlog_state(spark, sf)
    return tablemap.schema_catalog(state.maps, state.files).select(
        "source", "table_id", "seq", "schema", "table", "log_file", F.size("columns").alias("n_columns"),
        F.col("columns")[10]["name"].alias("last_column"), F.col("primary_key")[0].alias("key_column"),
    )


@query("catalog_metadata", f"""WITH {BINLOG}, {VERSIONS} SELECT source, seq, 1 AS flags, CASE b WHEN 2 THEN '44' ELSE '40' END AS signedness,
       255 AS default_charset, 1 AS key_length FROM ver""")
def catalog_metadata(spark, sf):
    _, state = binlog_state(spark, sf)
    return tablemap.schema_catalog(state.maps).select(
        "source", "seq", "flags", F.hex("signedness").alias("signedness"),
        F.col("default_charset.charset").alias("default_charset"), F.size("primary_key").alias("key_length"),
    )


@query("catalog_columns", f"""WITH {BINLOG}, {VERSIONS}, {DEFINITIONS} SELECT source, seq, c.i AS position, c.name, c.nullable AS is_nullable,
       d.definition, d.type_name, d.pack AS pack_length FROM ver JOIN (VALUES {COLUMN_VALUES}) c(b, i, name, type, nullable) USING (b) JOIN d ON c.type = d.type""")
def catalog_columns(spark, sf):
    _, state = binlog_state(spark, sf)
    return tablemap.catalog_columns(tablemap.schema_catalog(state.maps)).select(
        "source", "seq", "position", "name", "is_nullable", "definition", "type_name", "pack_length"
    )


@query("type_map", f"""WITH {BINLOG}, {VERSIONS}, {DEFINITIONS} SELECT source, seq, c.name, d.column_type
       FROM ver JOIN (VALUES {COLUMN_VALUES}) c(b, i, name, type, nullable) USING (b) JOIN d ON c.type = d.type""")
def type_map(spark, sf):
    _, state = binlog_state(spark, sf)
    columns = tablemap.catalog_columns(tablemap.schema_catalog(state.maps))
    return columns.select("source", "seq", "name", names.sink_type(F.col("definition")).alias("column_type"))


@query("charset_names", f"""SELECT CAST(c_custkey % 256 AS INTEGER) AS charset_id, charset, "collation", count(*) AS n
       FROM customer LEFT JOIN (VALUES {CHARSET_VALUES}) t(id, charset, "collation") ON c_custkey % 256 = id GROUP BY ALL""")
def charset_names(spark, sf):
    ids = spark.read.parquet(f"{sf}/customer.parquet").select((F.col("c_custkey") % 256).cast("int").alias("charset_id"))
    counted = ids.groupBy("charset_id").agg(F.count("*").alias("n"))
    return names.with_charset(counted, "charset_id").select("charset_id", "charset", "collation", "n")


@query("asof_table_map", f"""WITH {BINLOG} SELECT source, seq, {OP} AS op, CASE source WHEN 'my_crm' THEN 'crm' ELSE 'shop' END AS "schema",
       CASE source WHEN 'my_crm' THEN 'customer' ELSE 'orders' END AS "table",
       CASE source WHEN 'my_crm' THEN 1 ELSE k // 5000 * 100000 + 5 END AS map_seq FROM ev WHERE {OP} IS NOT NULL""")
def asof_table_map(spark, sf):
    capture, state = binlog_state(spark, sf)
    events = asof.with_table_map(binlog.row_events(capture), binlog.named_maps(state.maps))
    return events.select("source", "seq", "op", "schema", "table", "map_seq")


@query("asof_large_state", f"""WITH {ORDERS}, s AS (SELECT 'dense' AS source, o_custkey AS table_id, k * 3 AS seq, o_orderstatus AS v FROM o
       UNION ALL SELECT 'wide', o_custkey, k * 3000000000, o_orderpriority FROM o),
       e AS (SELECT source, table_id, seq + u.d AS seq FROM s, (VALUES (0), (1)) u(d)
       UNION ALL SELECT source, table_id, 0 FROM s GROUP BY ALL HAVING min(seq) > 0)
       SELECT e.source, e.table_id, e.seq, s.v AS state FROM e ASOF LEFT JOIN s
       ON e.source = s.source AND e.table_id = s.table_id AND e.seq >= s.seq""")
def asof_large_state(spark, sf):
    """As many keys as customers, many intervals each, over two scales of seq: the
    join that shuffles."""
    orders = fixtures.orders(spark, sf)

    def states(source, scale, state):
        return orders.select(
            F.lit(source).alias("source"), F.col("o_custkey").alias("table_id"),
            (F.col("k") * scale).alias("seq"), F.encode(state, "UTF-8").alias("state"),
        )

    both = states("dense", 3, "o_orderstatus").unionByName(states("wide", 3_000_000_000, "o_orderpriority"))
    keys = ["source", "table_id"]
    iv = asof.measured(asof.intervals(asof.change_points(both, keys, "state"), keys, ["state"]), keys, ["state"])
    events = both.select(*keys, F.explode(F.array("seq", F.col("seq") + 1)).alias("seq"))
    early = both.groupBy(*keys).agg(F.min("seq").alias("first")).filter("first > 0").select(*keys, F.lit(0).cast("bigint").alias("seq"))
    return asof.asof_join(events.unionByName(early), iv, shuffle=True).withColumn("state", F.col("state").cast("string"))


@query("log_file_asof", f"WITH {BINLOG} SELECT source, seq, type AS event_type, log_file FROM ev")
def log_file_asof(spark, sf):
    capture, state = binlog_state(spark, sf)
    return asof.with_log_file(binlog.headers(capture), state.files).select("source", "seq", "event_type", "log_file")


@query("binlog_progress", f"""WITH {BINLOG} SELECT source, max(CASE WHEN type = 4 THEN next_file END) AS log_file,
       max_by(CASE type WHEN 4 THEN next_pos ELSE log_position END, seq) AS log_position,
       max_by(CASE type WHEN 4 THEN next_pos ELSE log_position END, seq) AS safe_log_position, (SELECT count(*) FROM ev x WHERE x.source = ev.source) AS events
       FROM ev WHERE type IN (16, 4) GROUP BY source""")
def binlog_progress(spark, sf):
    events = binlog.with_rotate_fields(binlog.headers(fixtures.binlog_capture(spark, sf)))
    return progress.binlog_progress(events)


# --- MySQL: rows ----------------------------------------------------------------

ORDER_ROWS = f"""WITH {BINLOG}, r AS (SELECT ev.source, ev.seq, ev.type, ev.log_file, ev.log_position, {OP} AS op, o.* FROM ev JOIN o USING (k)
      WHERE ev.source = 'my_orders' AND {OP} IS NOT NULL)"""
ORDER_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, total DECIMAL(15,2), o_delta DECIMAL(10,4), o_orderdate TIMESTAMP_NTZ, "
    "o_date DATE, o_time INTERVAL DAY TO SECOND, o_year INT, o_ts TIMESTAMP, o_orderpriority STRING"
)
CUSTOMER_DDL = (
    "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_acctbal DOUBLE, c_signed INT, c_half DOUBLE, c_mktsegment STRING, "
    "c_bit BIGINT, c_big DECIMAL(20,0), c_raw BINARY, c_json BINARY"
)


def order_rows(spark, sf, op: str | None = None, image: str = "columns"):
    events = mysql.row_events(landed(fixtures.binlog_capture(spark, sf)), tables=["shop.orders"])
    return envelope.typed_view(events if op is None else events.filter(F.col("op") == op), "shop.orders", ORDER_DDL, image)


def customer_rows(spark, sf):
    events = mysql.row_events(landed(fixtures.binlog_capture(spark, sf)), tables=["crm.customer"])
    return envelope.typed_view(events, "crm.customer", CUSTOMER_DDL)


def flat_orders(df):
    return df.select("seq", "o_orderkey", "o_custkey", "o_orderstatus", F.col("total").cast("string").alias("total"), "o_orderpriority")


ORDER_FLAT = "o_orderkey, o_custkey, {}, " + MONEY + " AS total, CASE WHEN k % 11 <> 0 THEN o_orderpriority END AS o_orderpriority"


@query("binlog_inserts", f"""{ORDER_ROWS} SELECT 'my_orders' AS source, seq, 0 AS row_no, o_orderkey AS key, o_custkey AS other, o_orderstatus AS status,
       {MONEY} AS amount, CASE WHEN k % 11 <> 0 THEN o_orderpriority END AS label FROM r WHERE op = 'insert'
       UNION ALL SELECT 'my_crm', c_custkey // 16 * 10 + 2, CAST(c_custkey % 16 AS INTEGER), c_custkey, CAST(c_nationkey AS BIGINT), c_mktsegment,
       CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR), c_name FROM customer""")
def binlog_inserts(spark, sf):
    """Every inserted row of both tables, single rows and many to an event."""
    packets, state = binlog_state(spark, sf)
    # each view decodes the rows of its table alone
    inserts = lambda table: mysql.row_events(packets, state, tables=[table]).filter("op = 'insert'")
    views = [
        envelope.typed_view(inserts("shop.orders"), "shop.orders", ORDER_DDL).selectExpr(
            "source", "seq", "row_no", "o_orderkey AS key", "o_custkey AS other", "o_orderstatus AS status",
            "CAST(total AS STRING) AS amount", "o_orderpriority AS label",
        ),
        envelope.typed_view(inserts("crm.customer"), "crm.customer", CUSTOMER_DDL).selectExpr(
            "source", "seq", "row_no", "c_custkey AS key", "c_nationkey AS other", "c_mktsegment AS status",
            "CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS STRING) AS amount", "c_name AS label",
        ),
    ]
    return views[0].unionByName(views[1])


@query("binlog_updates", f"""{ORDER_ROWS} SELECT seq, {ORDER_FLAT.format("'X' AS o_orderstatus")}, o_orderstatus AS before_status FROM r WHERE op = 'update'""")
def binlog_updates(spark, sf):
    events = mysql.row_events(landed(fixtures.binlog_capture(spark, sf)), tables=["shop.orders"]).filter("op = 'update'")
    before = F.get(F.filter("identity", lambda c: c["name"] == "o_orderstatus"), F.lit(0))["value"]["str"]
    after = envelope.typed_view(events.withColumn("event_time", before), "shop.orders", ORDER_DDL)
    return after.select("seq", "o_orderkey", "o_custkey", "o_orderstatus", F.col("total").cast("string").alias("total"),
                        "o_orderpriority", F.col("event_time").alias("before_status"))


@query("binlog_deletes", f"{ORDER_ROWS} SELECT seq, {ORDER_FLAT.format('o_orderstatus')} FROM r WHERE op = 'delete'")
def binlog_deletes(spark, sf):
    return flat_orders(order_rows(spark, sf, "delete", "identity"))


@query("binlog_nulls", f"{ORDER_ROWS} SELECT seq, op, 'o_orderpriority' AS name FROM r WHERE k % 11 = 0 AND op <> 'delete'")
def binlog_nulls(spark, sf):
    events = mysql.row_events(landed(fixtures.binlog_capture(spark, sf)))
    cells = events.select("seq", "op", F.inline("columns"))
    empty = F.coalesce(*[F.col(f"value.{m}").cast("string") for m in ("u64", "i64", "f64", "str", "bytes")]).isNull()
    return cells.filter(empty).select("seq", "op", "name")


@query("binlog_numbers", """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, -c_nationkey - 1 AS c_signed, CAST(c_nationkey / 2 AS DOUBLE) AS c_half,
       c_custkey AS c_bit, CAST(18446744073709551615::HUGEINT - c_custkey AS VARCHAR) AS c_big FROM customer""")
def binlog_numbers(spark, sf):
    return customer_rows(spark, sf).select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_signed", "c_half", "c_bit", F.col("c_big").cast("string").alias("c_big")
    )


@query("binlog_strings", """SELECT c_custkey, c_name, c_mktsegment, printf('FF%02X', c_custkey % 256) AS c_raw,
       '00' || hex(CAST(c_custkey AS VARCHAR)) AS c_json FROM customer""")
def binlog_strings(spark, sf):
    return customer_rows(spark, sf).select(
        "c_custkey", "c_name", "c_mktsegment", F.hex("c_raw").alias("c_raw"), F.hex("c_json").alias("c_json")
    )


@query("binlog_decimals", f"{ORDER_ROWS} SELECT seq, {MONEY} AS total, CAST(CAST((o_custkey - 500) / 16.0 AS DECIMAL(10,4)) AS VARCHAR) AS o_delta FROM r WHERE op <> 'delete'")
def binlog_decimals(spark, sf):
    return order_rows(spark, sf).select(
        "seq", F.col("total").cast("string").alias("total"), F.col("o_delta").cast("string").alias("o_delta")
    )


@query("mysql_temporals", f"""{ORDER_ROWS} SELECT seq, {STAMP.format('t')} AS o_orderdate, strftime(t, '%Y-%m-%d') AS o_date, o_orderkey * 37 % 86400 AS o_time,
       CAST(year(t) AS INTEGER) AS o_year, {STAMP.format('t')} AS o_ts, {STAMP.format('t')} AS event_time FROM r WHERE op <> 'delete'""")
def mysql_temporals(spark, sf):
    seconds = F.expr("CAST(CAST(o_time AS INTERVAL SECOND) AS DECIMAL(18,6))").cast("bigint")
    return order_rows(spark, sf).select(
        "seq", text_time("o_orderdate").alias("o_orderdate"), F.col("o_date").cast("string").alias("o_date"),
        seconds.alias("o_time"), "o_year", text_time("o_ts").alias("o_ts"), text_time("event_time").alias("event_time"),
    )


def kinds(spark, sf):
    capture = landed(fixtures.kinds_capture(spark, sf))
    return capture, mysql.log_state(capture)


@query("binlog_json", rf"""WITH {ORDERS}, x AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END AS p FROM o)
       SELECT k, CASE WHEN k % 13 <> 0 THEN '{{"f": ' || CAST(k / 2 AS VARCHAR) || ', "k": ' || k || ', "n": null, "s": "é\"' || o_orderstatus || '\"\n", "at": "'
       || {STAMP.format('t')} || printf('.%06d", "no": false, "ok": ', k) || (k % 2 = 0) || ', "big": ' || (9223372036854775808::HUGEINT + k)
       || ', "day": "' || strftime(t, '%Y-%m-%d') || '", "i32": ' || (70000 + k) || ', "neg": ' || (-k) || ', "raw": "base64:type252:'
       || base64(from_hex(printf('%02X', k % 256))) || '", "gone": "' || CASE WHEN k > 0 THEN '-' ELSE '' END || printf('%02d:%02d:%02d.000000", "list": [', k // 3600, k // 60 % 60, k % 60)
       || (k % 7) || ', [' || p || '], {{"d": {{"e": [], "long": "' || repeat('x', CAST(k % 300 AS BIGINT)) || '"}}}}], "total": ' || {MONEY} || '}}' END AS doc,
       CASE WHEN k % 13 <> 0 THEN k % 7 END AS first, CASE WHEN k % 13 <> 0 THEN CASE WHEN k % 5 = 0 THEN '01' ELSE '00' END END AS form FROM x""")
def binlog_json(spark, sf):
    """The text of each document, a value reached through a VARIANT, and the first
    byte of its stored form."""
    capture, state = kinds(spark, sf)
    table = lambda ddl: mysql.table_rows(capture, "shop.kinds", ddl, state=state)
    rows = table("k BIGINT, doc STRING")
    paths = table("k BIGINT, doc VARIANT").select("k", F.variant_get("doc", "$.list[0]", "bigint").alias("first"))
    raw = table("k BIGINT, doc BINARY").select("k", F.hex(F.substring("doc", 1, 1)).alias("form"))
    return rows.select("k", "doc").join(paths, "k").join(raw, "k")


TEXT_VALUES = ", ".join(f"('{name}', '{phrase}')" for name, _, _, phrase in fixtures.CHARSET_TEXTS)


@query("binlog_charsets", f"""WITH {ORDERS} SELECT k, name, phrase || o_orderpriority AS value FROM o, (VALUES {TEXT_VALUES}) t(name, phrase) WHERE k % 17 <> 0
       UNION ALL SELECT k, 'size', CASE WHEN k % 2 = 0 THEN 'klein' ELSE 'größer' END FROM o
       UNION ALL SELECT k, 'raw', '636166E9' FROM o UNION ALL SELECT k, 'utf32_raw', '0001F4E6' || regexp_replace(hex(encode(o_orderpriority)), '(..)', '000000\\1', 'g') FROM o WHERE k % 17 <> 0""")
def binlog_charsets(spark, sf):
    """Text of every column by its charset, a BLOB as it is, and text as stored where
    it is asked for as BINARY."""
    capture = landed(fixtures.charset_capture(spark, sf))
    state = mysql.log_state(capture)
    texts = [name for name, *_ in fixtures.CHARSET_TEXTS] + ["size"]
    rows = mysql.table_rows(capture, "shop.texts", ", ".join(["k BIGINT", *(f"{n} STRING" for n in texts), "raw BINARY"]), state=state)
    stored = mysql.table_rows(capture, "shop.texts", "k BIGINT, utf32 BINARY", state=state).select("k", F.lit("utf32_raw").alias("name"), F.hex("utf32").alias("value"))
    cells = rows.withColumn("raw", F.hex("raw")).unpivot("k", [*texts, "raw"], "name", "value")
    return cells.unionByName(stored).filter("value IS NOT NULL")


@query("binlog_partial_images", f"""WITH {ORDERS}, r AS (SELECT k * 10 + slot AS seq, row_no, k, op, slot, o_orderstatus AS s, {MONEY} AS t, '-' || {MONEY} AS neg, o_custkey AS c
       FROM o, (VALUES (2, 0, 'insert'), (2, 1, 'insert'), (3, 0, 'update'), (4, 0, 'update'), (5, 0, 'delete')) u(slot, row_no, op))
       SELECT seq, row_no, op, 'columns' AS image, CASE WHEN slot = 2 THEN 'k=' || (k + row_no * 1000000) || ',status=' || s || ',total=' || t || ',cust=' || CASE row_no WHEN 0 THEN c::VARCHAR ELSE 'null' END
            WHEN slot = 4 THEN 'k=' || k || ',status=Z,total=' || t || ',cust=' || c WHEN k % 2 = 1 THEN 'status=null' ELSE 'total=' || neg || ',note=n' || k END AS cells
       FROM r WHERE op <> 'delete'
       UNION ALL SELECT seq, row_no, op, 'identity', CASE WHEN slot = 4 THEN 'k=' || k || ',status=' || s || ',total=' || t || ',cust=' || c ELSE 'k=' || k END FROM r WHERE op <> 'insert'""")
def binlog_partial_images(spark, sf):
    """What each image holds: a column that is left out is not there, a null one is."""
    events = mysql.row_events(landed(fixtures.partial_capture(spark, sf)))
    v = lambda c: F.coalesce(c["value"]["str"], c["value"]["i64"].cast("string"), F.decode(c["value"]["bytes"], "UTF-8"), F.lit("null"))
    cells = F.array_join(F.transform("cells", lambda c: F.concat(c["name"], F.lit("="), v(c))), ",")
    return each_image(events, "seq", "row_no", "op").withColumn("cells", cells)


@query("binlog_payload", f"""WITH {ORDERS}, r AS (SELECT k, o_orderstatus AS s, k % 3 = 0 AS packed, op FROM o, (VALUES ('insert'), ('update')) u(op)
       WHERE (op = 'insert' OR (k % 3 = 0 AND k % 7 = 0)) AND k % 33 <> 0)
       SELECT k * 4 + CASE WHEN packed THEN 1 ELSE 2 END AS seq, op, k, CASE op WHEN 'update' THEN 'X' ELSE s END AS status, CASE WHEN packed THEN 100 * k + 50 ELSE 0 END AS log_position,
       CAST(k AS VARCHAR) AS txn_id, CASE op WHEN 'update' THEN 1 ELSE 0 END AS txn_row, 'committed' AS txn_state, NULL AS error FROM r
       UNION ALL SELECT k * 4 + 1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'row changes not decoded' FROM o WHERE k % 33 = 0""")
def binlog_payload(spark, sf):
    """Rows of compressed and plain transactions with their place, and payloads that
    cannot be read."""
    capture = landed(fixtures.payload_capture(spark, sf))
    step = payloads.stride(capture)
    packets = landed(payloads.unpacked(capture, step))
    state = mysql.log_state(packets, long_files=True)
    value = lambda i, m: F.col("columns")[i]["value"][m]
    rows = mysql.transactions(packets, state, on_error="skip").select(
        F.expr(f"seq div {step}").alias("seq"), "op", value(0, "i64").alias("k"), value(1, "str").alias("status"), F.col("cursor.pos").alias("log_position"),
        "txn_id", "txn_row", "txn_state",
    )
    lost = mysql.quarantined(packets, state).select(F.expr(f"seq div {step}").alias("seq"), "error")
    return rows.unionByName(lost, allowMissingColumns=True)


@query("binlog_enum_set", f"""WITH {ORDERS} SELECT k, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'small' ELSE 'large' END AS size,
       array_to_string(list_filter([CASE WHEN k % 2 = 1 THEN 'red' END, CASE WHEN k // 2 % 2 = 1 THEN 'green' END, CASE WHEN k // 4 % 2 = 1 THEN 'blue' END],
                                   lambda x: x IS NOT NULL), ',') AS tags FROM o""")
def binlog_enum_set(spark, sf):
    capture, state = kinds(spark, sf)
    return mysql.table_rows(capture, "shop.kinds", "k BIGINT, size STRING, tags STRING", state=state).select("k", "size", "tags")


@query("binlog_fractions", f"""WITH {ORDERS} SELECT k, {STAMP.format('t')} || printf('.%06d', k % 1000 * 1000 + 7) AS at6,
       CASE WHEN k % 3 <> 0 THEN {STAMP.format('t')} || printf('.%03d', k % 1000) END AS ts3, CASE WHEN k % 3 <> 0 THEN {STAMP.format('t')} END AS old_ts,
       CASE WHEN k % 2 = 1 THEN -1 ELSE 1 END * (CAST(k % 800 * 3600 + k % 60 * 60 + 59 AS BIGINT) * 100 + k % 1000 // 10) AS t2,
       CASE WHEN k % 3 = 0 THEN '0000-00-00 00:00:00.000' ELSE {STAMP.format('t')} || printf('.%03d+00:00', k % 1000) END AS ts3_text FROM o""")
def binlog_fractions(spark, sf):
    """Times with fractions, typed; a zero timestamp is null, and its text is kept."""
    capture, state = kinds(spark, sf)
    ddl = "k BIGINT, at6 TIMESTAMP_NTZ, ts3 TIMESTAMP, t2 INTERVAL DAY TO SECOND, old_ts TIMESTAMP"
    rows = mysql.table_rows(capture, "shop.kinds", ddl, state=state)
    hundredths = F.expr("CAST(CAST(CAST(t2 AS INTERVAL SECOND) AS DECIMAL(18,6)) * 100 AS BIGINT)")
    events = mysql.row_events(capture, state).select(
        F.col("columns")[0]["value"]["i64"].alias("k"), F.col("columns")[5]["value"]["str"].alias("ts3_text")
    )
    return rows.select(
        "k", F.date_format("at6", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at6"), F.date_format("ts3", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts3"),
        text_time("old_ts").alias("old_ts"), hundredths.alias("t2"),
    ).join(events, "k")


@query("temporal_functions", f"""WITH {ORDERS} SELECT k, strftime(t, '%Y-%m-%d') AS d, {STAMP.format('t')} AS dt, k * 37 % 86400 AS tm,
       CAST(year(t) AS INTEGER) AS y, {STAMP.format('t')} AS ts FROM o""")
def temporal_functions(spark, sf):
    at = F.col("at")
    date = F.year(at) * 512 + F.month(at) * 32 + F.dayofmonth(at)
    clock = F.hour(at) * 10000 + F.minute(at) * 100 + F.second(at)
    digits = (F.year(at) * 10000 + F.month(at) * 100 + F.dayofmonth(at)).cast("bigint") * 1000000 + clock
    packed = fixtures.orders(spark, sf).select(
        "k", date.cast("bigint").alias("d"), digits.alias("dt"), clock.cast("bigint").alias("tm"), (F.year(at) - 1900).alias("y"), F.col("epoch").alias("ts")
    )
    seconds = F.expr("CAST(CAST(tm AS INTERVAL SECOND) AS DECIMAL(18,6))").cast("bigint")
    return packed.select(
        "k", temporals.to_date(F.col("d")).cast("string").alias("d"), text_time(temporals.to_datetime(F.col("dt"))).alias("dt"),
        temporals.to_interval(F.col("tm")).alias("tm"), temporals.to_year(F.col("y")).alias("y"),
        text_time(temporals.to_timestamp(F.col("ts"))).alias("ts"),
    ).withColumn("tm", seconds)


# --- row events -------------------------------------------------------------------

MY_EVENTS = f"""WITH {BINLOG}, m AS (
   SELECT source, seq, {OP} AS op, 'shop' AS s, 'orders' AS tb, 0 AS row_no, 11 AS n, log_file, log_position, k FROM ev WHERE source = 'my_orders' AND {OP} IS NOT NULL
   UNION ALL SELECT 'my_crm', c_custkey // 16 * 10 + 2, 'insert', 'crm', 'customer', CAST(c_custkey % 16 AS INTEGER), 11, 'crm-bin.000001', 400, c_custkey FROM customer)"""
IMAGES = "CAST(CASE WHEN op = 'delete' THEN 0 ELSE n END AS INTEGER) AS n_columns, CAST(CASE WHEN op = 'insert' THEN 0 ELSE {} END AS INTEGER) AS n_identity"


def image_sizes(df, *extra):
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return df.select("source", "seq", "row_no", "op", "schema", "table", size("columns").alias("n_columns"), size("identity").alias("n_identity"), *extra)


@query("mysql_row_events", f"""{MY_EVENTS} SELECT source, seq, row_no, op, s AS "schema", tb AS "table", {IMAGES.format('n')},
       log_file, log_position, k AS first_value FROM m""")
def mysql_row_events(spark, sf):
    first = F.coalesce(F.col("columns")[0]["value"]["i64"], F.col("identity")[0]["value"]["i64"])
    return image_sizes(mysql.row_events(landed(fixtures.binlog_capture(spark, sf))), F.col("cursor.file").alias("log_file"),
                       F.col("cursor.pos").alias("log_position"), first.alias("first_value"))


@query("mysql_transactions", f"""{MY_EVENTS}, r AS (SELECT source, seq, row_no, op, k * 20 + 3 AS txn_seq, CAST(k AS VARCHAR) AS txn_id, k * 20 + 11 AS commit_seq,
       {STAMP.format('(SELECT t FROM o WHERE o.k = m.k)')} AS commit_time, 'committed' AS txn_state FROM m WHERE source = 'my_orders')
       SELECT source, seq, row_no, op, {TXN} FROM r
       UNION ALL SELECT source, seq, row_no, op, NULL, NULL, NULL, NULL, NULL, 'outside' FROM m WHERE source = 'my_crm'""")
def mysql_transactions(spark, sf):
    return flat_transactions(mysql.transactions(landed(fixtures.binlog_capture(spark, sf))))


@query("update_images", f"""{ORDER_ROWS} SELECT 'my_orders' AS source, k, o_orderstatus AS before, 'X' AS after FROM r WHERE op = 'update'
       UNION ALL SELECT 'pg_orders', k, NULL, 'X' FROM o WHERE k % 5 = 0""")
def update_images(spark, sf):
    pick = lambda image, name: F.get(F.filter(image, lambda c: c["name"] == name), F.lit(0))["value"]
    events = unified(spark, sf).filter("op = 'update'")
    return events.select("source", pick("identity", "o_orderkey")["i64"].alias("k"),
                         pick("identity", "o_orderstatus")["str"].alias("before"), pick("columns", "o_orderstatus")["str"].alias("after"))


def unified(spark, sf, tables=None, packets=None, state=None):
    packets = packets or landed(fixtures.binlog_capture(spark, sf))
    return envelope.unify(
        postgres.row_events(fixtures.wal_capture(spark, sf), tables), mysql.row_events(packets, state, tables=tables)
    )


PG_EVENTS = """pg AS (
   SELECT 'pg_orders' AS source, base + u.off AS seq, u.op, 'public' AS s, 'orders' AS tb, 0 AS row_no, 6 AS n, 1 AS n_key FROM o,
          (VALUES (64, 'insert'), (128, 'update'), (192, 'delete')) u(off, op) WHERE u.off = 64 OR (u.off = 128 AND k % 5 = 0) OR (u.off = 192 AND k % 7 = 0)
   UNION ALL SELECT 'pg_crm', 4096 + 64 * c_custkey, 'insert', 'crm', 'customer', 0, 4, 1 FROM customer)"""


@query("unified_events", f"""{MY_EVENTS}, {PG_EVENTS} SELECT source, seq, row_no, op, s AS "schema", tb AS "table", {IMAGES.format('n')} FROM m
       UNION ALL SELECT source, seq, row_no, op, s, tb, {IMAGES.format('n_key')} FROM pg""")
def unified_events(spark, sf):
    return image_sizes(unified(spark, sf))


@query("table_filter", f"""{MY_EVENTS}, {PG_EVENTS} SELECT source, seq, row_no, s AS "schema", tb AS "table" FROM m WHERE s = 'crm'
       UNION ALL SELECT source, seq, row_no, s, tb FROM pg WHERE s = 'crm'""")
def table_filter(spark, sf):
    return unified(spark, sf, ["crm.*", "public.nothing"]).select("source", "seq", "row_no", "schema", "table")


@query("row_events_only", f"""{MY_EVENTS}, {PG_EVENTS} SELECT source, op, count(*) AS n FROM (SELECT source, op FROM m UNION ALL SELECT source, op FROM pg) GROUP BY ALL""")
def row_events_only(spark, sf):
    return unified(spark, sf).groupBy("source", "op").agg(F.count("*").alias("n"))


@query("mysql_table_rows", f"""{ORDER_ROWS} SELECT seq, op, {ORDER_FLAT.format("CASE op WHEN 'update' THEN 'X' ELSE o_orderstatus END AS o_orderstatus")}
       FROM r WHERE op <> 'delete'""")
def mysql_table_rows(spark, sf):
    rows = mysql.table_rows(landed(fixtures.binlog_capture(spark, sf)), "shop.orders", ORDER_DDL)
    return rows.select("seq", "op", "o_orderkey", "o_custkey", "o_orderstatus", F.col("total").cast("string").alias("total"), "o_orderpriority")


@query("pg_table_rows", f"""WITH {WAL}, c AS (SELECT seq, source, action, k FROM f) SELECT c.seq, o.o_custkey, {MONEY} AS total,
       CASE c.action WHEN 'U' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM c JOIN o USING (k) WHERE c.source = 'pg_orders' AND c.action IN ('I', 'U')""")
def pg_table_rows(spark, sf):
    rows = postgres.table_rows(fixtures.wal_capture(spark, sf), "public.orders", "o_custkey BIGINT, total DECIMAL(15,2), o_orderstatus STRING")
    return rows.select("seq", "o_custkey", F.col("total").cast("string").alias("total"), "o_orderstatus")


@query("typed_view", f"""WITH {ORDERS} SELECT k AS o_orderkey, o_custkey, o_orderstatus, {MONEY} AS total, {STAMP.format('t')} AS o_orderdate,
       CASE WHEN k % 11 <> 0 THEN o_orderpriority END AS o_orderpriority FROM o""")
def typed_view(spark, sf):
    events = postgres.row_events(fixtures.wal_capture(spark, sf)).filter("op = 'insert'")
    flat = envelope.typed_view(
        events, "public.orders",
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, total DECIMAL(15,2), o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    )
    return flat.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("total").cast("string").alias("total"),
                       text_time("o_orderdate").alias("o_orderdate"), "o_orderpriority")


@query("packet_quarantine", f"""WITH {ORDERS} SELECT k * 20 + 12 AS seq, 'packet cut short' AS error FROM o WHERE k % 997 = 0
       UNION ALL SELECT k * 20 + 13, 'server error packet' FROM o WHERE k % 499 = 0
       UNION ALL SELECT k * 20 + 14, 'unknown event type 99' FROM o WHERE k % 251 = 0
       UNION ALL SELECT k * 20 + 15, 'row event cut short' FROM o WHERE k % 101 = 0
       UNION ALL SELECT k * 20 + 16, 'no table map before the row event' FROM o WHERE k % 103 = 0
       UNION ALL SELECT k * 20 + 17, 'row changes not decoded' FROM o WHERE k % 211 = 0""")
def packet_quarantine(spark, sf):
    return mysql.quarantined(landed(fixtures.binlog_capture(spark, sf, bad=True))).select("seq", "error")


@query("kafka_payload", f"""{MY_EVENTS}, {PG_EVENTS}, a AS (SELECT source, seq, row_no, op, s, tb, k FROM m
       UNION ALL SELECT source, seq, row_no, op, s, tb, CASE s WHEN 'crm' THEN (seq - 4096) // 64 ELSE (seq - 16777216) // 1024 END FROM pg)
       SELECT '{{"schema":"' || s || '","table":"' || tb || '","key":["' || k || '"]}}' AS key, source, CAST(seq AS VARCHAR) AS seq, CAST(row_no AS VARCHAR) AS row_no, op,
       CASE WHEN op <> 'delete' THEN CASE s WHEN 'crm' THEN 'c_custkey' ELSE 'o_orderkey' END END AS first_column FROM a""")
def kafka_payload(spark, sf):
    """The fields of each record, its value read once."""
    packets, state = binlog_state(spark, sf)
    keys = tablemap.primary_keys(tablemap.schema_catalog(state.maps))
    keys = keys.union(spark.createDataFrame([("public", "orders", ["o_orderkey"])], keys.schema))
    fields = F.from_json("value", "source STRING, seq STRING, row_no STRING, op STRING, columns ARRAY<STRUCT<name: STRING>>")
    records = envelope.kafka_payload(unified(spark, sf, packets=packets, state=state), keys).select("key", fields.alias("v"))
    return records.select("key", "v.source", "v.seq", "v.row_no", "v.op", F.get("v.columns", F.lit(0))["name"].alias("first_column"))
