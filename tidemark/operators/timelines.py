"""Timelines of a PostgreSQL source: which frames belong to its present history.

A failover forks the log: the new timeline goes on from the fork, and what the old
one wrote past it never happened there. A later fork can lie before earlier ones
and then takes them along. So a frame is abandoned if any later switch of its source
forks at or before it; the least of the later forks is kept for each stretch of
``seq`` and looked up by the as-of join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators import asof
from tidemark.operators.positions import wal_resume

LINES = "source STRING, seq BIGINT, tid INT, from_lsn BIGINT, until_lsn BIGINT, before INT, live BOOLEAN"


def timelines(capture: DataFrame, initial_tid: int = 1) -> DataFrame:
    """One row for each stretch of a source on one timeline, materialised: ``LINES``.

    ``from_lsn`` is where it forked off ``before`` (null for the first stretch) and
    ``until_lsn`` the least fork after it, null on the present timeline. A stretch
    whose whole log was left is not ``live``. Timeline rows that repeat the timeline
    in force are no switch. A switch row without an LSN raises: its fork is unknown.
    """
    fork = F.coalesce("end_lsn", F.raise_error(F.lit("timeline row without an LSN")).cast("bigint"))
    switches = capture.filter("kind = 't'").select("source", "seq", F.col("timeline").alias("tid"), fork.alias("from_lsn"))
    starts = capture.groupBy("source").agg((F.min("seq") - 1).alias("seq")).select(
        "source", "seq", F.lit(initial_tid).alias("tid"), F.lit(None).cast("bigint").alias("from_lsn")
    )
    # one row for each failover of a source
    up = Window.partitionBy("source").orderBy("seq")
    later = Window.partitionBy("source").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    turns = (
        switches.unionByName(starts)
        .withColumn("before", F.lag("tid").over(up))
        .filter("from_lsn IS NULL OR NOT before <=> tid")
    )
    lines = turns.withColumn("until_lsn", F.min("from_lsn").over(later))
    live = F.col("until_lsn").isNull() | F.col("from_lsn").isNull() | (F.col("from_lsn") < F.col("until_lsn"))
    return asof.materialise(lines.select("source", "seq", "tid", "from_lsn", "until_lsn", "before", live.alias("live")))


def line_intervals(lines: DataFrame) -> asof.Intervals:
    """The stretches as intervals of ``seq`` for the as-of join."""
    payload = ["tid", "until_lsn"]
    return asof.measured(asof.intervals(lines, ["source"], payload), ["source"], payload)


def with_timeline(frames: DataFrame, lines: DataFrame) -> DataFrame:
    """Frames with their ``tid``, its ``until_lsn`` and ``abandoned``: data at or past
    the fork where its timeline was left. Keepalives and timeline rows hold no data
    and are never abandoned.

    A transaction that the fork cuts loses its commit and so is unfinished when
    transactions are put together.
    """
    at = F.coalesce("start_lsn", "end_lsn")
    lost = (F.col("kind") == "w") & F.coalesce(at >= F.col("until_lsn"), F.lit(False))
    return asof.asof_join(frames, line_intervals(lines)).withColumn("abandoned", lost)


def present_frames(capture: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """The capture without abandoned frames, in its own schema."""
    lines = timelines(capture) if lines is None else lines
    return with_timeline(capture, lines).filter("NOT abandoned").select(*capture.columns)


def abandoned_frames(capture: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """What ``present_frames`` leaves out, with the timeline and where it was left."""
    lines = timelines(capture) if lines is None else lines
    return with_timeline(capture, lines).filter("abandoned").drop("abandoned")


def branch_points(lines: DataFrame, cursors: dict[str, tuple[int, int]]) -> dict[str, int]:
    """Per source of ``(tid, lsn)`` cursors, where the cursor's branch and the present
    one part or the cursor itself, whichever comes first. A cursor past that point has
    handled changes that never happened. A timeline that the source never was on
    raises. Reads one row for each cursor."""
    if not cursors:
        return {}
    spark = lines.sparkSession
    wanted = spark.createDataFrame([(s, t) for s, (t, _) in cursors.items()], "source STRING, tid INT")
    found = lines.join(F.broadcast(wanted), ["source", "tid"]).groupBy("source").agg(F.max_by("until_lsn", "seq").alias("until"))
    until = {r["source"]: r["until"] for r in found.collect()}
    missing = sorted(set(cursors) - set(until))
    if missing:
        raise ValueError(f"timeline of the cursor not in the capture: {', '.join(missing)}")
    return {s: lsn if until[s] is None else min(lsn, until[s]) for s, (_, lsn) in cursors.items()}


def branch_resume(capture: DataFrame, cursors: dict[str, tuple[int, int]], lines: DataFrame | None = None) -> DataFrame:
    """Frames of the present branch from each source's ``(tid, lsn)`` cursor on. A
    cursor past its fork goes back to it. The bounds reach the scan."""
    lines = timelines(capture) if lines is None else lines
    return present_frames(wal_resume(capture, branch_points(lines, cursors)), lines)
