"""MySQL: binlog capture to row events.

Two reads of the capture. The first keeps only table maps and rotates and
shrinks them to change points; the second takes the row events through two
broadcast lookups into the row decoder. Row events are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators import asof, binlog
from tidemark.operators.envelope import mysql_row_events, table_matches, typed_columns, with_cursor
from tidemark.operators.errors import apply_on_error, quarantine
from tidemark.operators.positions import position_epochs, with_full_position
from tidemark.operators.rowcodec import decode_columns, decode_rows
from tidemark.operators.transactions import binlog_marks, with_transactions

# Fewer bytes than most rows have: how many rows a packet may hold.
ROW_BYTES = 64


@dataclass
class LogState:
    """What a row event needs from events before it."""

    maps: asof.Intervals
    files: asof.Intervals
    epochs: asof.Intervals | None = None


def log_state(capture: DataFrame, checksum_len: int = 0, long_files: bool = False) -> LogState:
    """``long_files`` reads all headers once more, so that positions in files over
    4 GiB come out whole."""
    state = LogState(*asof.log_state_intervals(binlog.log_states(capture, checksum_len)))
    return replace(state, epochs=position_epochs(capture, state.files, checksum_len)) if long_files else state


def _wanted_maps(maps: asof.Intervals, tables: list[str]) -> asof.Intervals:
    """Table map intervals with a ``wanted`` flag, set once per distinct map."""
    flag = table_matches(F.col("schema"), F.col("table"), tables)
    values = binlog.named_maps(maps).values.withColumn("wanted", flag).drop("schema", "table")
    return replace(maps, values=values, value_columns=(*maps.value_columns, "wanted"))


def located_row_events(
    capture: DataFrame, state: LogState, tables: list[str] | None = None,
    on_error: str = "skip", checksum_len: int = 0,
) -> DataFrame:
    """Row events with table map and log file, still packed.

    Unwanted tables are dropped here, by the names in the table map, so their
    rows are never decoded; events without a table map stay for quarantine.
    """
    events = binlog.row_events(capture, on_error, checksum_len)
    if tables:
        events = asof.with_table_map(events, _wanted_maps(state.maps, tables))
        events = events.filter(F.col("table_map").isNull() | F.col("wanted")).drop("wanted")
    else:
        events = asof.with_table_map(events, state.maps)
    events = with_full_position(events, state.epochs) if state.epochs else events
    return asof.with_log_file(events, state.files)


def decoded_rows(
    capture: DataFrame, state: LogState | None = None, tables: list[str] | None = None,
    on_error: str = "fail", checksum_len: int = 0, raw_json: bool = False, texts: bool = False,
) -> DataFrame:
    state = state or log_state(capture, checksum_len)
    packets = "fail" if on_error == "fail" else "skip"
    packed = located_row_events(capture, state, tables, packets, checksum_len).drop("table_id", "map_seq")
    return apply_on_error(decode_rows(packed, raw_json, texts), on_error)


def table_rows(
    capture: DataFrame, table: str, ddl: str, image: str = "columns", state: LogState | None = None,
    on_error: str = "fail", checksum_len: int = 0,
) -> DataFrame:
    """One table's rows with flat typed columns: ``typed_view`` of its row
    events, without building the row events. A JSON column comes as text, as a
    VARIANT or, asked for as BINARY, as it is stored; so do character columns, whose
    text is read by their charset."""
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error must be fail or skip")
    state = state or log_state(capture, checksum_len)
    wanted = T.StructType.fromDDL(ddl)
    packed = located_row_events(capture, state, [table], on_error, checksum_len).drop("table_id", "map_seq")
    raw = [f.name for f in wanted if isinstance(f.dataType, T.BinaryType)]
    texts = [f.name for f in wanted if isinstance(f.dataType, T.StringType)]
    rows = apply_on_error(decode_columns(packed, wanted.names, image, raw, texts), on_error)
    return typed_columns(with_cursor(rows), wanted)


def quarantined(
    capture: DataFrame, state: LogState | None = None, tables: list[str] | None = None, checksum_len: int = 0
) -> DataFrame:
    """What a ``skip`` run leaves out: unreadable packets, row changes of a kind
    that is not decoded and row events that cannot be, with the reason; ``source, seq`` lead to the packet."""
    state = state or log_state(capture, checksum_len)
    rows = decoded_rows(capture, state, tables, "keep", checksum_len)
    failed = quarantine(rows).select("source", "seq", "error")
    return binlog.packet_quarantine(capture, checksum_len, changes=True).drop("packet").unionByName(failed)


def row_events(
    capture: DataFrame, state: LogState | None = None, tables: list[str] | None = None,
    on_error: str = "fail", checksum_len: int = 0, raw_json: bool = False, texts: bool = False,
) -> DataFrame:
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error must be fail or skip")
    return mysql_row_events(decoded_rows(capture, state, tables, on_error, checksum_len, raw_json, texts))


def transactions(
    capture: DataFrame, state: LogState | None = None, tables: list[str] | None = None,
    on_error: str = "fail", checksum_len: int = 0,
) -> DataFrame:
    """Row events with their transaction; see ``with_transactions``. With ``tables``,
    rows are numbered among those of the wanted tables."""
    rows = F.greatest(F.lit(1), F.expr(f"length(packet) div {ROW_BYTES}"))
    places = capture.select("source", "seq", rows.alias("rows"))
    events = row_events(capture, state, tables, on_error, checksum_len)
    return with_transactions(events, binlog_marks(capture, checksum_len), places=places)
