"""Global transaction ids of MySQL: one by one, as sets, and resuming by a set.

A set is a table of intervals ``server_uuid, lo, hi`` of transaction numbers, ``hi``
exclusive, any two of a server apart. Sets are as long as they have gaps, not as
long as the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import names
from tidemark.functions.bytes import int_le, slice_bytes
from tidemark.operators import asof, binlog
from tidemark.operators.transactions import MARK_TYPES, binlog_mark, with_transactions

SET = "server_uuid STRING, lo BIGINT, hi BIGINT"
# log2 of the numbers merged in one group at first
RANGE_BITS = 16


def _uuid(raw: Column) -> Column:
    text = F.lower(F.hex(raw))
    part = lambda start, length: F.substring(text, start, length)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def _has_gtid() -> Column:
    return (F.col("event_type") == names.GTID) & (F.length("body") >= 25)


def _gtid() -> tuple[Column, Column]:
    """Server and number from the body of a gtid event."""
    body = F.col("body")
    return _uuid(slice_bytes(body, 2, 16)), int_le(body, 18, 8)


def gtids(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """``source, seq, log_position, server_uuid, gno, last_committed, sequence_number``
    of every gtid event. The last two are null where the event does not carry the
    order of its group commit."""
    body = F.col("body")
    events = binlog.headers(capture, "skip", checksum_len, [names.GTID]).filter(_has_gtid())
    server_uuid, gno = _gtid()
    ordered = (F.length(body) >= 42) & (slice_bytes(body, 26, 1) == F.lit(b"\2"))
    return events.select(
        "source", "seq", "log_position", server_uuid.alias("server_uuid"), gno.alias("gno"),
        F.when(ordered, int_le(body, 27, 8)).alias("last_committed"),
        F.when(ordered, int_le(body, 35, 8)).alias("sequence_number"),
    )


def previous_gtids(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """The set that each file starts from: ``source, seq, server_uuid, lo, hi``. A
    server's intervals follow its id and their count, so the next server's place is
    known only after it; a fold walks over them. A cut event gives no rows."""
    body = F.col("body")
    events = binlog.headers(capture, "skip", checksum_len, [names.PREVIOUS_GTIDS]).filter(F.length(body) >= 8)
    room = (F.length(body) - 8) / 24  # servers take 24 bytes and more
    servers = F.least(int_le(body, 1, 8), F.floor(room)).cast("int")

    def step(walked: Column, _: Column) -> Column:
        at = walked["at"]
        # a cut event may tell any number here; its walk then misses the end
        many = F.least(F.greatest(int_le(body, at + 16, 8), F.lit(0)), F.length(body))
        return F.struct(
            (at + 24 + 16 * many).alias("at"),
            F.concat(walked["found"], F.array(at)).alias("found"),
        )

    start = F.struct(F.lit(9).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("found"))
    walk = F.aggregate(F.when(servers > 0, F.sequence(F.lit(1), servers)).otherwise(F.array().cast("array<int>")), start, step)
    whole = events.select("source", "seq", "body", walk.alias("walk")).filter(F.col("walk.at") == F.length("body") + 1)
    server = whole.select("source", "seq", "body", F.explode("walk.found").alias("at")).withColumn("many", int_le(body, F.col("at") + 16, 8))
    each = server.filter("many > 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("many") - 1)))
    place = F.col("at") + 24 + 16 * F.col("i")
    return each.select(
        "source", "seq", _uuid(slice_bytes(body, F.col("at"), 16)).alias("server_uuid"),
        int_le(body, place, 8).alias("lo"), int_le(body, place + 8, 8).alias("hi"),
    )


def parse_set(spark: SparkSession, text: str) -> DataFrame:
    """A set as the server prints it, ``uuid:1-5:7,uuid:3``, ends inclusive."""
    rows = []
    for server in filter(None, (part.strip() for part in text.replace("\n", "").split(","))):
        uuid, *ranges = server.split(":")
        for r in ranges:
            lo, _, hi = r.partition("-")
            rows.append((uuid.strip().lower(), int(lo), int(hi or lo) + 1))
    return merged(spark.createDataFrame(rows, SET))


def _islands(parts: DataFrame, groups: list[str], out: list[str]) -> DataFrame:
    """Intervals of each group that overlap or touch, joined."""
    order = Window.partitionBy(*groups).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    number = F.sum((F.coalesce(F.col("lo") > reach, F.lit(True))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = parts.withColumn("_island", number)
    return marked.groupBy(*groups, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(*out, "lo", "hi")


def merged(intervals: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A set of any intervals ``*keys, lo, hi`` (``server_uuid`` is the key of a set).
    Numbers that lie close merge first, in ranges of their own; one row for each range
    and gap is left to merge along the whole key."""
    keys = keys or ["server_uuid"]
    ranges = intervals.filter("hi > lo").withColumn("_range", F.shiftright("lo", RANGE_BITS))
    near = _islands(ranges, [*keys, "_range"], keys)
    return _islands(near, keys, keys)


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return merged(a.unionByName(b))


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """What of set ``a`` is not in set ``b``: a sweep over the ends of both."""
    ends = lambda df, name, other: df.select(
        "server_uuid", F.inline(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")), F.struct(F.col("hi").alias("at"), F.lit(-1).alias("step"))))
    ).select("server_uuid", "at", F.col("step").alias(name), F.lit(0).alias(other))
    both = ends(a, "in_a", "in_b").unionByName(ends(b, "in_b", "in_a"))
    points = both.groupBy("server_uuid", "at").agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
    order = Window.partitionBy("server_uuid").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = points.select(
        "server_uuid", F.col("at").alias("lo"), F.lead("at").over(order).alias("hi"),
        F.sum("in_a").over(upto).alias("a"), F.sum("in_b").over(upto).alias("b"),
    )
    return merged(swept.filter("a > 0 AND b = 0 AND hi IS NOT NULL").select("server_uuid", "lo", "hi"))


def in_set(rows: DataFrame, gtid_set: DataFrame, flag: str = "in_set") -> DataFrame:
    """``rows`` (``server_uuid, gno, ...``) with whether their id is in the set: the
    last interval that starts at or before it is looked up as-of, then its end."""
    keys = ["server_uuid"]
    starts = asof.materialise(gtid_set.select(*keys, "lo", "hi", F.col("hi").alias("_end")))
    found = asof.asof_join(rows.withColumn("_seq", F.col("seq")).withColumn("seq", F.col("gno")), asof.measured(starts, keys, ["_end"]))
    inside = F.coalesce(F.col("gno") < F.col("_end"), F.lit(False))
    return found.withColumn(flag, inside).withColumn("seq", F.col("_seq")).drop("_seq", "_end")


def _with_gtid(events: DataFrame, capture: DataFrame, checksum_len: int, places: DataFrame | None = None) -> DataFrame:
    """Events with the ``server_uuid`` and ``gno`` of their transaction and its state;
    the gtid event itself belongs to it, as does the mark that ends it. Marks and ids
    come from one read of the capture."""
    server_uuid, gno = _gtid()
    named = F.when(_has_gtid(), F.concat_ws(":", server_uuid, gno.cast("string")))
    mark, _ = binlog_mark()
    begins = F.col("mark") == "begin"
    events_of = binlog.headers(capture, "skip", checksum_len, MARK_TYPES)
    marks = events_of.select("source", "seq", mark.alias("mark"), named.alias("id"), F.col("event_time").alias("at")).filter("mark IS NOT NULL")
    # a begin has its own id, ends none; an event stands right after a begin and right before an end of the same seq
    # kept, as they are gone over twice and their ids are made for them
    marks = asof.materialise(marks.withColumn("seq", F.col("seq") * 2 + F.when(begins, -1).otherwise(1)))
    if places is not None:
        around = F.explode(F.array(F.col("seq") * 2 - 1, F.col("seq") * 2 + 1))
        places = places.select("source", around.alias("seq"))
    placed = with_transactions(events.withColumn("seq", F.col("seq") * 2), marks, places=places)
    parts = F.split("txn_id", ":")
    return placed.withColumn("seq", F.expr("seq div 2")).withColumn("server_uuid", F.get(parts, 0)).withColumn("gno", F.get(parts, 1).cast("bigint"))


def gtid_resume(
    events: DataFrame, capture: DataFrame, executed: DataFrame, checksum_len: int = 0, places: DataFrame | None = None,
) -> DataFrame:
    """``events`` (``source, seq, row_no, ...`` of ``capture``) whose transaction is not
    in the executed set: what a replica that has it would still ask for. Events
    outside transactions and of anonymous ones stay, as no set can name them. ``places``
    (``source, seq`` of at least all events; the capture, where a packet is one event)
    saves making the events once more to count them."""
    marked = in_set(_with_gtid(events, capture, checksum_len, places), executed, "_executed")
    return marked.filter(~F.col("_executed")).select(*events.columns)


def gtid_progress(capture: DataFrame, before: DataFrame | None = None, checksum_len: int = 0) -> DataFrame:
    """The executed set after the batch, per source: ``source, server_uuid, lo, hi``.
    Committed transactions count, with the set ``before`` (same columns)."""
    ids = gtids(capture, checksum_len).withColumn("row_no", F.lit(0))
    done = _with_gtid(ids.select("source", "seq", "row_no"), capture, checksum_len, capture).filter("txn_state = 'committed'")
    mine = done.select("source", "server_uuid", F.col("gno").alias("lo"), (F.col("gno") + 1).alias("hi"))
    return merged(mine if before is None else mine.unionByName(before), ["source", "server_uuid"])
