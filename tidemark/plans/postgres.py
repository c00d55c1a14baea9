"""PostgreSQL: WAL capture to row events. Narrow from scan to result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators import asof, pgoutput, wal
from tidemark.operators.envelope import filter_tables, pg_event_rows, pg_row_events, pg_text_value, typed_columns
from tidemark.operators.pgoutput import decode_pgoutput
from tidemark.operators.transactions import wal_marks, with_transactions
from tidemark.operators.wal import decode_wal


def pgoutput_row_events(
    frames: DataFrame, tables: list[str] | None = None, on_error: str = "fail", found: asof.Intervals | None = None
) -> DataFrame:
    """Row events from frames of the server's own output plugin
    (``captures.pgoutput_frames``); the same as ``row_events`` of wal2json messages
    of the same changes. Two reads: relation messages, then row messages."""
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error must be fail or skip")
    events = pg_row_events(decode_pgoutput(frames, found, on_error))
    return filter_tables(events, tables) if tables else events


def row_events(capture: DataFrame, tables: list[str] | None = None, on_error: str = "fail") -> DataFrame:
    """Works on batch and streaming captures alike."""
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error must be fail or skip")
    events = pg_row_events(decode_wal(capture, on_error))
    return filter_tables(events, tables) if tables else events


def table_rows(
    capture: DataFrame, table: str, ddl: str, image: str = "columns", on_error: str = "fail"
) -> DataFrame:
    """One table's rows with flat typed columns: ``typed_view`` of its row
    events, without building the row events. Each wanted value is read once,
    as text, and cast to its type."""
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error must be fail or skip")
    wanted = T.StructType.fromDDL(ddl)
    decoded = filter_tables(pg_event_rows(decode_wal(capture, on_error)), [table])
    rows = decoded.filter(F.col("op") != ("delete" if image == "columns" else "insert"))
    entry = lambda c: F.struct(c["name"].alias("key"), F.struct(c["type"].alias("type"), c["value"].alias("value")).alias("value"))
    by_name = rows.withColumn("_by_name", F.map_from_entries(F.transform(image, entry)))
    found = by_name.select(
        *[c for c in rows.columns if c not in ("columns", "identity")],
        *[F.try_element_at("_by_name", F.lit(f.name)).alias(f"_{i}") for i, f in enumerate(wanted.fields)],
    )
    for i in range(len(wanted)):
        found = found.withColumn(f"_{i}", pg_text_value(F.col(f"_{i}")))
    return typed_columns(found, wanted)


def mark_messages(frames: DataFrame) -> DataFrame:
    """Begin and commit messages of frames of either plugin."""
    return pgoutput.mark_messages(frames) if "body" in frames.columns else wal.mark_messages(frames)


def transactions(decoded: DataFrame, tables: list[str] | None = None, frames: DataFrame | None = None) -> DataFrame:
    """Row events of decoded messages (``decode_wal`` or ``decode_pgoutput``) with
    their transaction; see ``with_transactions``. With the ``frames`` they were decoded
    from, marks are read from these, and nothing is decoded to be counted."""
    events = pg_row_events(decoded)
    events = filter_tables(events, tables) if tables else events
    if frames is None:
        return with_transactions(events, wal_marks(decoded))
    return with_transactions(events, wal_marks(mark_messages(frames)), places=frames.filter("kind = 'w'").select("source", "seq"))
