"""Log positions as columns: PostgreSQL LSNs and MySQL file/position pairs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: seconds from 1970-01-01 to the PostgreSQL epoch, 2000-01-01.
PG_EPOCH_SECONDS = 946_684_800


def pg_clock(clock_us: Column) -> Column:
    """Server clock (microseconds since 2000-01-01) as TIMESTAMP."""
    return F.timestamp_micros(clock_us + F.lit(PG_EPOCH_SECONDS * 1_000_000))


def parse_wal_cursor(text: Column) -> Column:
    """``<timeline>/<hex lsn>`` as ``struct(tid, lsn)``; null if malformed."""
    ok = text.rlike(r"^-?[0-9]{1,10}/[0-9A-Fa-f]{1,16}$")
    tid = F.split_part(text, F.lit("/"), F.lit(1)).try_cast("int")
    lsn = F.conv(F.split_part(text, F.lit("/"), F.lit(2)), 16, -10).cast("bigint")
    return F.when(ok & tid.isNotNull(), F.struct(tid.alias("tid"), lsn.alias("lsn")))


def format_wal_cursor(tid: Column, lsn: Column) -> Column:
    return F.concat_ws("/", tid.cast("string"), F.hex(lsn))


def parse_lsn(text: Column) -> Column:
    """An LSN as the server prints it, two hex halves, as BIGINT."""
    ok = text.rlike(r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    half = lambda n: F.conv(F.split_part(text, F.lit("/"), F.lit(n)), 16, 10).cast("bigint")
    return F.when(ok, F.shiftleft(half(1), 32).bitwiseOR(half(2)))


def format_lsn(lsn: Column) -> Column:
    wide = lsn.cast("bigint")
    high = F.shiftrightunsigned(wide, 32)
    low = wide.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.concat_ws("/", F.hex(high), F.hex(low))


def parse_binlog_cursor(text: Column) -> Column:
    """``<file>/<position>`` as ``struct(log_file, log_position)``; null if malformed."""
    ok = text.rlike(r"^[^/]*/[0-9]{1,19}$")
    file = F.split_part(text, F.lit("/"), F.lit(1))
    position = F.split_part(text, F.lit("/"), F.lit(2)).try_cast("bigint")
    return F.when(
        ok & position.isNotNull(),
        F.struct(file.alias("log_file"), position.alias("log_position")),
    )


def format_binlog_cursor(log_file: Column, log_position: Column) -> Column:
    return F.concat_ws("/", log_file, log_position.cast("string"))


def file_number(log_file: Column) -> Column:
    """Numeric suffix of a binlog file name: ``bin.1000000`` follows ``bin.999999``."""
    return F.regexp_extract(log_file, r"\.([0-9]+)$", 1).try_cast("bigint")


def binlog_order(log_file: Column, log_position: Column) -> Column:
    """Struct that compares in log order."""
    return F.struct(file_number(log_file).alias("file_no"), log_position.alias("log_position"))
