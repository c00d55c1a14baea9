"""PostgreSQL wal2json messages: parse, classify, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import action_kind
from tidemark.functions.positions import pg_clock
from tidemark.operators.errors import apply_on_error

_COLUMNS = "ARRAY<STRUCT<name: STRING, type: STRING, value: VARIANT>>"
# A number that is parsed loses its last zeros, and its digits beyond 38. Those of
# type numeric are put in quotes first, so that their literal text stays. Quotes
# inside a JSON string are escaped, so no string can look like this.
_NUMERIC = r'("type"\s*:\s*"numeric(?:\([0-9, ]*\))?"\s*,\s*"value"\s*:\s*)(-?[0-9][0-9.eE+-]*)'
MESSAGE = (
    f"action STRING, `schema` STRING, `table` STRING, columns {_COLUMNS}, identity {_COLUMNS}, "
    "transactional BOOLEAN, prefix STRING, content STRING, malformed STRING"
)


def _parsed(message: Column) -> Column:
    exact = F.when(message.contains('"numeric'), F.regexp_replace(message, _NUMERIC, '$1"$2"')).otherwise(message)
    return F.from_json(exact, MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"})


def _message_error(m: Column) -> Column:
    """Why a parsed message cannot be used; null when it can."""
    action = m["action"]
    missing = lambda *names: F.greatest(*[m[n].isNull() for n in names])
    unnamed = lambda c: F.exists(F.coalesce(m[c], F.array()), lambda x: x["name"].isNull() | x["type"].isNull())
    return (
        F.when(m.isNull() | m["malformed"].isNotNull(), "malformed JSON")
        .when(action.isNull(), "missing action")
        .when(action_kind(action).isNull(), F.concat(F.lit("unknown action "), action))
        .when(action.isin("I", "U", "D", "T") & missing("schema", "table"), "missing schema or table")
        .when(action.isin("I", "U") & m["columns"].isNull(), "missing columns")
        .when(action.isin("U", "D") & m["identity"].isNull(), "missing identity")
        .when((action == "M") & missing("transactional", "prefix", "content"), "missing message fields")
        .when(unnamed("columns") | unnamed("identity"), "column without name or type")
    )


def _with_message(capture: DataFrame) -> DataFrame:
    """Add the parsed message ``m`` and ``error``.

    The one-element explode keeps filters on parsed fields above the parse:
    pushed below it, each mention of a field would parse the message again.
    Filters on the capture's own columns still reach the scan.
    """
    is_data = F.col("kind") == "w"
    known = F.coalesce(F.col("kind").isin("w", "k", "t"), F.lit(False))
    parsed = F.when(is_data, _parsed(F.col("message")))
    m = F.col("m")
    return capture.select("*", F.explode_outer(F.array(parsed)).alias("m")).withColumn(
        "error", F.when(~known, "unknown frame").when(is_data, _message_error(m))
    )


def parsed_frames(capture: DataFrame) -> DataFrame:
    """Frames with their parsed message, to be decoded and set aside from one parse."""
    return _with_message(capture)


def decode_wal(capture: DataFrame, on_error: str = "fail") -> DataFrame:
    """Capture rows with the parsed message spread out.

    Adds ``event_time``, ``action_kind`` and the message fields; keepalive and
    timeline rows pass through with null fields. Bad messages follow
    ``on_error``; ``keep`` adds an ``error`` column. Narrow throughout, so it
    runs the same on a stream.
    """
    return decoded_frames(_with_message(capture), on_error)


def decoded_frames(parsed: DataFrame, on_error: str = "fail") -> DataFrame:
    """``decode_wal`` of ``parsed_frames``."""
    decoded = parsed.select(
        "source", "seq", "kind", "start_lsn", "end_lsn", "clock_us",
        pg_clock(F.col("clock_us")).alias("event_time"),
        "must_reply", "timeline",
        *[F.col(f"m.{c}").alias(c) for c in ("action", "schema", "table", "columns", "identity",
                                              "transactional", "prefix", "content")],
        action_kind(F.col("m.action")).alias("action_kind"),
        "error",
    )
    return apply_on_error(decoded, on_error)


def mark_messages(capture: DataFrame) -> DataFrame:
    """Begin and commit messages with what marks a transaction, from a parse of their
    action alone: ``source, seq, event_time, action, action_kind``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = F.from_json("message", "action STRING, malformed STRING", options)
    m = capture.filter("kind = 'w'").select("source", "seq", "clock_us", F.explode(F.array(parsed)).alias("m"))
    action = F.col("m.action")
    return m.filter(F.col("m.malformed").isNull() & action.isin("B", "C")).select(
        "source", "seq", pg_clock(F.col("clock_us")).alias("event_time"), action.alias("action"), action_kind(action).alias("action_kind")
    )


def wal_quarantine(capture: DataFrame) -> DataFrame:
    """Bad frames with their reason and the untouched message."""
    return quarantined_frames(_with_message(capture))


def quarantined_frames(parsed: DataFrame) -> DataFrame:
    """``wal_quarantine`` of ``parsed_frames``."""
    return parsed.filter(F.col("error").isNotNull()).select(
        "source", "seq", "kind", "start_lsn", "end_lsn", "error", "message"
    )


def column_changes(decoded: DataFrame, image: str = "columns") -> DataFrame:
    """One row per column of an image: name, type name and value as text."""
    keep = ["source", "seq", "action_kind", "schema", "table"]
    return decoded.select(*keep, F.inline(image)).select(
        *keep, "name", "type", F.col("value").cast("string").alias("value")
    )
