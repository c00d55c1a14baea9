"""Where to start, where to stop, and how far a batch got."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.names import DELETES, ROTATE, TABLE_MAP, UPDATES, XID
from tidemark.functions.positions import binlog_order, file_number
from tidemark.operators import asof, binlog

# seq read back from the end of a source at first.
TAIL = 1 << 12


def _any(conditions):
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _frames_where(capture: DataFrame, bounds: dict[str, int], compare) -> DataFrame:
    """Frames whose start (end, where a frame has no start) compares to their
    source's bound; sources without a bound are kept whole. Only comparisons a
    parquet scan can take over."""
    start, end = F.col("start_lsn"), F.col("end_lsn")
    mine = [
        (F.col("source") == source) & (compare(start, lsn) | (start.isNull() & compare(end, lsn)))
        for source, lsn in bounds.items()
    ]
    return capture.filter(_any(mine) | ~F.col("source").isin(list(bounds)))


def wal_resume(capture: DataFrame, cursors: dict[str, int]) -> DataFrame:
    """Frames from each source's first unhandled LSN on."""
    return _frames_where(capture, cursors, lambda at, lsn: at >= lsn)


def wal_until(capture: DataFrame, targets: dict[str, int]) -> DataFrame:
    """Frames up to and including each source's target LSN."""
    return _frames_where(capture, targets, lambda at, lsn: at <= lsn)


def latest_wal_cursor(capture: DataFrame) -> DataFrame:
    """The current end of each source: where a run without a cursor starts."""
    return capture.groupBy("source").agg(F.max("end_lsn").alias("lsn"))


def wal_progress(decoded: DataFrame) -> DataFrame:
    """Position per source after the batch, as one partial aggregate.

    ``reported_lsn`` follows the last data, keepalive or timeline row.
    ``safe_lsn`` is one past the start of the last commit: all before it is
    handled, and an inclusive resume from it repeats nothing.
    """
    committed = F.when(F.col("action_kind") == "commit", F.col("start_lsn"))
    switched = F.when(F.col("kind") == "t", F.col("seq"))
    return decoded.groupBy("source").agg(
        F.max_by("timeline", switched).alias("tid"),
        F.max_by("end_lsn", "seq").alias("reported_lsn"),
        (F.max(committed) + 1).alias("safe_lsn"),
        F.count("*").alias("events"),
    )


def wal_timeline(capture: DataFrame, initial_tid: int = 1) -> DataFrame:
    """Timeline and LSN per source after every switch seen."""
    switched = F.when(F.col("kind") == "t", F.col("seq"))
    return capture.groupBy("source").agg(
        F.coalesce(F.max_by("timeline", switched), F.lit(initial_tid)).alias("tid"),
        F.max_by("end_lsn", "seq").alias("lsn"),
    )


def _seq_bounds(files: DataFrame, cursors: dict[str, tuple[str, int]], compare) -> dict[str, int]:
    """Per named source, the first ``seq`` of the file intervals whose number
    compares to the cursor's; one small aggregate over all of them."""
    mine = [
        F.when((F.col("source") == source) & compare(file_number(F.col("log_file")), file_number(F.lit(log_file))), True)
        for source, (log_file, _) in cursors.items()
    ]
    if not mine:
        return {}
    found = files.filter(F.coalesce(*mine, F.lit(False))).groupBy("source").agg(F.min("lo").alias("lo")).collect()
    return {r["source"]: r["lo"] for r in found}


def packets_after(capture: DataFrame, files: DataFrame, cursors: dict[str, tuple[str, int]]) -> DataFrame:
    """Packets of each source from the start of its cursor's file on, by ``seq``
    bounds that a scan takes over. ``files`` are the materialised file intervals;
    ``after_binlog_cursor`` then compares positions."""
    bounds = _seq_bounds(files, cursors, lambda number, target: number >= target)
    mine = [(F.col("source") == source) & (F.col("seq") >= lo) for source, lo in bounds.items()]
    return capture.filter(_any(mine) | ~F.col("source").isin(list(cursors)))


def packets_until(capture: DataFrame, files: DataFrame, targets: dict[str, tuple[str, int]]) -> DataFrame:
    """Packets of each source up to the end of its target's file, likewise."""
    bounds = _seq_bounds(files, targets, lambda number, target: number > target)
    mine = [
        (F.col("source") == source) & (F.col("seq") < bounds[source]) if source in bounds else F.col("source") == source
        for source in targets
    ]
    return capture.filter(_any(mine) | ~F.col("source").isin(list(targets)))


def after_binlog_cursor(events: DataFrame, cursors: dict[str, tuple[str, int]]) -> DataFrame:
    """Events past ``(file, position)`` per source; ``events`` carry ``log_file``
    (see ``with_log_file``). A header position is the event's end, so the
    comparison is strict. Files over 4 GiB need ``with_full_position`` first. ``packets_after`` keeps older packets from being read."""
    keep = [
        (F.col("source") == source) & (_event_end() > _target(log_file, position))
        for source, (log_file, position) in cursors.items()
    ]
    return events.filter(_any(keep) | ~F.col("source").isin(list(cursors)))


def until_binlog_cursor(events: DataFrame, targets: dict[str, tuple[str, int]]) -> DataFrame:
    """Events up to and including ``(file, position)`` per source; ``events``
    carry ``log_file``. ``packets_until`` keeps later packets from being read."""
    keep = [
        (F.col("source") == source) & (_event_end() <= _target(log_file, position))
        for source, (log_file, position) in targets.items()
    ]
    return events.filter(_any(keep) | ~F.col("source").isin(list(targets)))


def position_epochs(capture: DataFrame, files: asof.Intervals, checksum_len: int = 0) -> asof.Intervals:
    """How often the 32-bit header positions of a file have wrapped, by ``seq``.

    Positions grow through a file, so the upper half of their range and the lower
    one take turns, 2 GiB each: a wrap is a turn to the lower half. The turns are
    change points like those of table maps, found by an aggregate per ``seq`` range;
    only they and the file starts are then ordered along a source.
    """
    heads = binlog.headers(capture, "skip", checksum_len).filter("log_position > 0")
    halves = heads.select("source", "seq", F.shiftright("log_position", 31).cast("int").alias("half"))
    turns = asof.change_points(halves, ["source"], "half")
    starts = files.df.select("source", F.col("lo").alias("seq"), F.lit(None).cast("int").alias("half"))
    along = Window.partitionBy("source").orderBy("seq", F.col("half").asc_nulls_first())
    started = F.col("half").isNull().cast("int")
    both = turns.unionByName(starts).withColumn("file", F.sum(started).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy("source", "file").orderBy("seq", F.col("half").asc_nulls_first())
    wrapped = (F.col("half") == 0) & (F.lag("half").over(inside) == 1)
    counted = both.withColumn("wrap", F.coalesce(wrapped, F.lit(False)).cast("bigint")).withColumn(
        "epoch", F.sum("wrap").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    # a file's start and its first turn may share a seq
    points = counted.groupBy("source", "seq").agg(F.max_by("epoch", "half").alias("epoch"), F.max("epoch").alias("most"))
    points = points.select("source", "seq", F.coalesce("epoch", "most").alias("epoch"))
    return asof.measured(asof.intervals(points, ["source"], ["epoch"]), ["source"], ["epoch"])


def with_full_position(events: DataFrame, epochs: asof.Intervals) -> DataFrame:
    """``events`` with ``log_position`` as it would be without the 32-bit limit.
    Events without a position of their own keep 0."""
    wide = F.col("log_position") + F.shiftleft(F.coalesce("epoch", F.lit(0)).cast("bigint"), 32)
    placed = asof.asof_join(events, epochs).withColumn("log_position", F.when(F.col("log_position") > 0, wide).otherwise(F.col("log_position")))
    return placed.drop("epoch")


def _event_end():
    return binlog_order(F.col("log_file"), F.col("log_position"))


def _target(log_file: str, position: int):
    return binlog_order(F.lit(log_file), F.lit(position).cast("bigint"))


def _advances():
    return ~F.col("event_type").isin([TABLE_MAP] + UPDATES + DELETES)


def binlog_progress(events: DataFrame) -> DataFrame:
    """Cursor per source after the batch, as one partial aggregate.

    ``events`` are headers with the rotate fields. The cursor moves on every
    event but table maps, updates and deletes, and a rotate sets both parts.
    ``safe_*`` is the cursor at the last commit or rotate, which never falls
    between a table map and its rows.
    """
    rotates = F.col("event_type") == ROTATE
    position = F.when(rotates, F.col("next_log_position")).otherwise(F.col("log_position"))
    moved = F.when(_advances(), F.col("seq"))
    safe = F.when(F.col("event_type").isin(XID, ROTATE), F.col("seq"))
    return events.groupBy("source").agg(
        F.max_by("next_log_file", F.when(rotates, F.col("seq"))).alias("log_file"),
        F.max_by(position, moved).alias("log_position"),
        F.max_by(position, safe).alias("safe_log_position"),
        F.count("*").alias("events"),
    )


def latest_binlog_cursor(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """File and end position of the last event of each source.

    The ends of the sources come from two narrow columns. Only their tails are
    then read, further back where a tail holds no rotate to name the file.
    """
    ends = capture.groupBy("source").agg(F.min("seq").alias("first"), F.max("seq").alias("last")).collect()
    found = None
    reach, open_ends = TAIL, {r["source"]: (r["first"], r["last"]) for r in ends if r["last"] is not None}
    while open_ends:
        tails = [(F.col("source") == s) & (F.col("seq") > last - reach) for s, (_, last) in open_ends.items()]
        events = binlog.with_rotate_fields(binlog.headers(capture.filter(_any(tails)), "skip", checksum_len))
        rotates = F.col("event_type") == ROTATE
        position = F.when(rotates, F.col("next_log_position")).otherwise(F.col("log_position"))
        rows = events.groupBy("source").agg(
            F.max_by("next_log_file", F.when(rotates, F.col("seq"))).alias("log_file"),
            F.max_by(position, "seq").alias("log_position"),
        ).collect()
        # a source is done once its file is known or all of it was read
        whole = {s for s, (first, last) in open_ends.items() if first > last - reach}
        done = [tuple(r) for r in rows if r["log_file"] is not None or r["source"] in whole]
        found = [*(found or []), *done]
        open_ends = {s: e for s, e in open_ends.items() if s not in whole and s not in {d[0] for d in done}}
        reach *= 16
    return capture.sparkSession.createDataFrame(found or [], "source STRING, log_file STRING, log_position BIGINT")
