"""MySQL binlog packets: headers and the events that need no row decoding.

All of it is built-in expressions inside whole-stage codegen. A packet is one
OK byte, a 19-byte little-endian header, and the event body.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import names
from tidemark.functions.bytes import byte_is, int_le, length_encoded, slice_bytes, uint64_le, utf8
from tidemark.operators.asof import FILE_STATE, Intervals

BODY_AT = 21  # position of the body in the packet


def _packet_error(checksum_len: int, changes: bool = False) -> Column:
    """Why a packet cannot be read; with ``changes``, also why its row changes
    cannot, although its header can."""
    p = F.col("packet")
    unread = byte_is(p, 6, *names.UNDECODED_CHANGES) & F.lit(changes)
    size = F.length(p)
    return (
        F.when(p.isNull() | (size == 0), "empty packet")
        .when(byte_is(p, 1, 0xFF), "server error packet")
        .when(~byte_is(p, 1, 0x00), "not an event packet")
        .when(size < BODY_AT - 1 + checksum_len, "packet shorter than its header")
        .when(int_le(p, 11, 4) != size - 1, "packet cut short")
        .when(int_le(p, 6, 1) >= len(names.EVENT_TYPES),
              F.concat(F.lit("unknown event type "), int_le(p, 6, 1).cast("string")))
        .when(unread, "row changes not decoded")
    )


def _body(checksum_len: int) -> Column:
    return slice_bytes(F.col("packet"), BODY_AT, F.length("packet") - (BODY_AT - 1 + checksum_len))


def _is_type(*types: int) -> Column:
    return byte_is(F.col("packet"), 1, 0x00) & byte_is(F.col("packet"), 6, *types)


def packet_quarantine(capture: DataFrame, checksum_len: int = 0, changes: bool = False) -> DataFrame:
    """Packets no header can be read from, with the reason; with ``changes``, also
    packets whose row changes have no decoder."""
    return capture.select(
        "source", "seq", _packet_error(checksum_len, changes).alias("error"), "packet"
    ).filter(F.col("error").isNotNull())


def _fields(checksum_len: int) -> dict[str, Column]:
    p = F.col("packet")
    return {
        "timestamp": int_le(p, 2, 4),
        "event_time": F.timestamp_seconds(int_le(p, 2, 4)),
        "event_type": int_le(p, 6, 1).cast("int"),
        "server_id": int_le(p, 7, 4),
        "log_position": int_le(p, 15, 4),
        "flags": int_le(p, 19, 2).cast("int"),
        "body": _body(checksum_len),
        "checksum": slice_bytes(p, F.length(p) - checksum_len + 1, F.lit(checksum_len)),
    }


def headers(
    capture: DataFrame, on_error: str = "fail", checksum_len: int = 0, types: list[int] | None = None,
    changes: bool = False,
) -> DataFrame:
    """Event header fields, the body and the checksum bytes.

    ``types`` keeps only these event types, told apart by one byte before
    anything is decoded. With ``fail``, an unreadable packet stops the run
    whatever its type; the check and the choice of types are one filter, as
    stacked filters would each evaluate the check again. With ``changes``, row
    changes that no decoder reads are errors too.
    """
    error, fields = _packet_error(checksum_len, changes), _fields(checksum_len)
    wanted = F.lit(True) if types is None else _is_type(*types)
    if on_error == "keep":
        marked = capture.filter(wanted).withColumn("error", error)
        usable = F.col("error").isNull()
        columns = [F.when(usable, value).alias(name) for name, value in fields.items()]
        return marked.select("source", "seq", *columns, "error")
    if on_error == "skip":
        readable = capture.filter(wanted & error.isNull())
    elif on_error == "fail":
        stop = F.raise_error(error).cast("boolean")
        readable = capture.filter(F.when(error.isNull(), wanted).otherwise(stop))
    else:
        raise ValueError(f"on_error must be fail, skip or keep, not {on_error!r}")
    return readable.select("source", "seq", *[value.alias(name) for name, value in fields.items()])


def with_names(events: DataFrame) -> DataFrame:
    """Add the type's name and the decoder it is routed to."""
    return events.withColumn("event_name", names.event_name(F.col("event_type"))).withColumn(
        "route", names.event_route(F.col("event_type"))
    )


def with_rotate_fields(events: DataFrame) -> DataFrame:
    """Add ``next_log_position`` and ``next_log_file``; null on every event that
    is not a rotate."""
    is_rotate = F.col("event_type") == names.ROTATE
    body = F.col("body")
    return events.withColumn("next_log_position", F.when(is_rotate, int_le(body, 1, 8))).withColumn(
        "next_log_file", F.when(is_rotate, utf8(slice_bytes(body, 9, F.length(body) - 8)))
    )


def rotates(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    events = headers(capture, "skip", checksum_len, [names.ROTATE])
    return with_rotate_fields(events).select(
        "source", "seq", "timestamp", "log_position", "next_log_position", "next_log_file"
    )


def format_descriptions(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """Binlog version, server version (50 null-padded bytes), creation time and
    header lengths."""
    events = headers(capture, "skip", checksum_len, [names.FORMAT_DESCRIPTION])
    body = F.col("body")
    return events.filter(F.length(body) >= 57).select(
        "source",
        "seq",
        int_le(body, 1, 2).cast("int").alias("version"),
        F.rtrim(utf8(slice_bytes(body, 3, 50)), F.lit("\0")).alias("server_version"),
        int_le(body, 53, 4).alias("create_timestamp"),
        int_le(body, 57, 1).cast("int").alias("event_header_length"),
        slice_bytes(body, 58, F.length(body) - 57).alias("event_type_header_lengths"),
    )


def xids(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    events = headers(capture, "skip", checksum_len, [names.XID])
    return events.filter(F.length("body") >= 8).select(
        "source", "seq", "log_position", uint64_le(F.col("body"), 1).alias("xid")
    )


def gtid_markers(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """Gtid and previous-gtids markers, whose body is dropped, and anonymous
    gtids, whose body is kept raw."""
    kinds = (names.GTID, names.ANONYMOUS_GTID, names.PREVIOUS_GTIDS)
    events = headers(capture, "skip", checksum_len, list(kinds))
    return with_names(events).select(
        "source", "seq", "log_position", F.col("route").alias("marker"),
        F.when(F.col("event_type") == names.ANONYMOUS_GTID, F.col("body")).alias("body"),
    )


def row_op(event_type: Column) -> Column:
    return (
        F.when(event_type.isin(names.INSERTS), "insert")
        .when(event_type.isin(names.UPDATES), "update")
        .when(event_type.isin(names.DELETES), "delete")
    )


def table_id(body: Column) -> Column:
    """First field of a table map and of every row event."""
    return int_le(body, 1, 6)


def row_events(capture: DataFrame, on_error: str = "skip", checksum_len: int = 0) -> DataFrame:
    """Row events with op and table id; the rows stay packed in ``body``.

    With ``fail``, any unreadable packet stops the run, whatever its type, and so
    do row changes in a form that is not decoded."""
    events = headers(capture, on_error, checksum_len, names.ROW_EVENTS, changes=True)
    return events.select(
        "source", "seq", "event_time", "log_position", "event_type",
        row_op(F.col("event_type")).alias("op"),
        table_id(F.col("body")).alias("table_id"),
        "body",
    )


def row_event_headers(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """Table id, flags, size of the extra data (second version only) and
    column count of every row event."""
    body = F.col("body")
    extras = F.when(F.col("event_type").isin(names.WITH_EXTRAS), int_le(body, 9, 2) - 2)
    count_at = F.coalesce(F.col("extras_length") + 2, F.lit(0)) + 9
    return (
        row_events(capture, checksum_len=checksum_len)
        .withColumn("extras_length", extras)
        .select(
            "source", "seq", "op", "table_id",
            int_le(body, 7, 2).cast("int").alias("flags"),
            F.col("extras_length").cast("int").alias("extras_length"),
            length_encoded(body, count_at)["value"].cast("int").alias("column_count"),
        )
    )


def log_states(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """What later events depend on, as ``source, table_id, seq, state``: table
    map bodies, and under table id ``FILE_STATE`` the file names of rotates.

    A rotate with a position of its own ends its file and still belongs to it, so
    the next file starts one after it; one without is sent ahead of a file."""
    events = headers(capture, "skip", checksum_len, [names.TABLE_MAP, names.ROTATE])
    body, is_rotate = F.col("body"), F.col("event_type") == names.ROTATE
    ends_file = is_rotate & (F.col("log_position") > 0)
    return events.select(
        "source",
        F.when(is_rotate, F.lit(FILE_STATE).cast("bigint")).otherwise(table_id(body)).alias("table_id"),
        (F.col("seq") + ends_file.cast("bigint")).alias("seq"),
        F.when(is_rotate, slice_bytes(body, 9, F.length(body) - 8)).otherwise(body).alias("state"),
    )


def table_map_names(body: Column) -> Column:
    """``struct(schema, table)`` straight from a table map body."""
    schema_len = int_le(body, 9, 1)
    table_at = schema_len + 11  # past the name and its null byte
    table_len = length_encoded(body, table_at)
    return F.struct(
        utf8(slice_bytes(body, 10, schema_len)).alias("schema"),
        utf8(slice_bytes(body, table_at + table_len["width"], table_len["value"])).alias("table"),
    )


def named_maps(maps: Intervals) -> Intervals:
    """Table map intervals with ``schema`` and ``table``, read once per distinct
    map instead of once per event."""
    found = table_map_names(F.col("table_map"))
    values = maps.values.withColumn("schema", found["schema"]).withColumn("table", found["table"])
    # the names are part of the map, so twice its size is a bound
    columns = (*maps.value_columns, "schema", "table")
    return replace(maps, values=values, value_columns=columns, value_bytes=2 * maps.value_bytes)
