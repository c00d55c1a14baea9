"""Row events put together to transactions.

A log holds transactions one after the other: a begin mark, rows, an end mark. Each
row belongs to the mark before it and ends with the one after it. Rows are dealt
into buckets of ``seq`` with a bounded mean number of rows, which begin with a mark
wherever there is one, and ordered inside; what lies beyond a bucket comes from the
marks, which are few columns, and for long transactions from counts. So neither a source
nor a long transaction is ever one task, and no row is kept on disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import names
from tidemark.functions.bytes import slice_bytes, uint64_le
from tidemark.operators import asof, binlog

BUCKET_ROWS = 100_000
MARK = "source STRING, seq BIGINT, mark STRING, id STRING, at TIMESTAMP"
PLACE = ["txn_seq", "txn_id", "txn_row", "commit_seq", "commit_time", "txn_state"]


def wal_mark(decoded: DataFrame) -> Column:
    """A begin or commit message as ``struct(mark, seq, id, at)``; null on others. The
    id is the transaction's xid where the plugin sends it."""
    has = lambda name: name in decoded.columns
    xid = F.col("xid").cast("string") if has("xid") else F.lit(None).cast("string")
    at = F.coalesce("commit_time", "event_time") if has("commit_time") else F.col("event_time")
    return F.when(F.col("action").isin("B", "C"), F.struct(F.col("action_kind").alias("mark"), "seq", xid.alias("id"), at.alias("at")))


def wal_marks(decoded: DataFrame) -> DataFrame:
    """Begin and commit marks of decoded WAL messages of either plugin."""
    marks = decoded.select("source", wal_mark(decoded).alias("m")).filter("m IS NOT NULL")
    return marks.select("source", "m.seq", "m.mark", "m.id", "m.at")


def _says(word: str) -> Column:
    """A query event whose text is this word; the text follows a null byte."""
    tail = b"\0" + word.encode()
    is_query = F.col("event_type") == names.QUERY
    return is_query & (slice_bytes(F.col("body"), F.length("body") - len(tail) + 1, len(tail)) == F.lit(tail))


MARK_TYPES = [names.GTID, names.ANONYMOUS_GTID, names.XID, names.QUERY]


def binlog_mark() -> tuple[Column, Column]:
    """The mark that an event is, null on others, and the xid that ends a transaction."""
    is_xid = (F.col("event_type") == names.XID) & (F.length("body") >= 8)
    mark = (
        F.when(F.col("event_type").isin(names.GTID, names.ANONYMOUS_GTID), "begin")
        .when(is_xid | _says("COMMIT"), "commit")
        .when(_says("ROLLBACK"), "rollback")
    )
    return mark, F.when(is_xid, uint64_le(F.col("body"), 1)).cast("string")


def binlog_marks(capture: DataFrame, checksum_len: int = 0) -> DataFrame:
    """Gtid events begin a transaction; an xid event or a COMMIT ends it, as does a
    ROLLBACK. The id is the xid."""
    events = binlog.headers(capture, "skip", checksum_len, MARK_TYPES)
    mark, xid = binlog_mark()
    return events.select("source", "seq", mark.alias("mark"), xid.alias("id"), F.col("event_time").alias("at")).filter("mark IS NOT NULL")


def _small(df: DataFrame) -> DataFrame:
    """A materialised table, sent to every executor where it has few rows."""
    few = df.limit(asof.BROADCAST_ROWS + 1).count() <= asof.BROADCAST_ROWS
    return F.broadcast(df) if few else df


def _ranges(places: DataFrame, bucket_rows: int) -> DataFrame:
    """Equal ranges of ``seq``, as many for each source as its places need: ``source,
    _lo, _width, _count``. A place may stand for several ``rows``."""
    rows = F.sum("rows") if "rows" in places.columns else F.count("*")
    extent = places.filter("seq IS NOT NULL").groupBy("source").agg(F.min("seq").alias("_lo"), F.max("seq").alias("_hi"), rows.alias("_n"))
    count = F.ceil(F.col("_n") / F.lit(bucket_rows))
    width = F.ceil((F.col("_hi") - F.col("_lo")) / count + 1)
    return asof.materialise(extent.select("source", "_lo", width.cast("bigint").alias("_width"), count.cast("bigint").alias("_count")))


def _in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    at = F.floor((F.col("seq") - F.col("_lo")) / F.col("_width"))
    place = F.greatest(F.lit(0), F.least(at, F.col("_count") - 1))
    return rows.join(_small(ranges), "source").withColumn("_range", F.when(F.col("seq").isNotNull(), place)).drop("_lo", "_width", "_count")


def _joints(marks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each range with its first and last mark, the last one before it (``_carry``, in
    the range ``_from``), the next one after it (``_follow``) and the bucket of the rows
    ahead of its first mark (``_lead``). Those join the bucket of the range before, which
    its marks begin, so that rows are numbered inside; where that range has no marks, and
    a transaction goes through all of it, they are one of their own (``_alone``)."""
    mark = F.struct("mark", "seq", "id", "at")
    own = _in_ranges(marks, ranges).groupBy("source", "_range").agg(F.min_by(mark, "seq").alias("_first"), F.max_by(mark, "seq").alias("_last"))
    every = ranges.select("source", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_count") - 1)).alias("_range"))
    # one row for each range
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("source").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    joints = (
        every.join(own, ["source", "_range"], "left")
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(before))
        .withColumn("_from", F.last(F.when(F.col("_first").isNotNull(), F.col("_range")), ignorenulls=True).over(before))
        .withColumn("_follow", F.last("_first", ignorenulls=True).over(after))
        .withColumn("_alone", ~F.coalesce(F.col("_from") == F.col("_range") - 1, F.lit(False)))
    )
    return asof.materialise(joints.withColumn("_lead", F.when(F.col("_alone"), 2 * F.col("_range") - 1).otherwise(2 * F.col("_range") - 2)))


def _bucketed(rows: DataFrame, ranges: DataFrame, joints: DataFrame) -> DataFrame:
    """Rows with ``_bucket``, which begins with a mark or is ``_alone``."""
    lookup = joints.select("source", "_range", F.col("_first.seq").alias("_starts"), "_lead")
    found = _in_ranges(rows, ranges).join(_small(lookup), ["source", "_range"])
    bucket = F.when(F.col("seq") >= F.col("_starts"), 2 * F.col("_range")).otherwise(F.col("_lead"))
    return found.withColumn("_bucket", bucket).drop("_range", "_starts", "_lead")


def _carried(events: DataFrame, ranges: DataFrame, joints: DataFrame) -> DataFrame:
    """What each bucket takes from others: the mark it begins under, the rows since
    that one and the mark after it. Only the rows of transactions that are longer than
    a range are counted for it."""
    opened = joints.filter(F.col("_first").isNotNull()).select(
        "source", (2 * F.col("_range")).alias("_bucket"), F.lit(None).cast(joints.schema["_carry"].dataType).alias("_carry"), "_follow"
    )
    alone = joints.filter("_alone").select("source", F.col("_lead").alias("_bucket"), "_carry", F.coalesce("_first", "_follow").alias("_follow"))
    carried = opened.unionByName(alone)
    long = joints.filter("_alone AND _carry.mark = 'begin'")
    if long.isEmpty():
        return carried.withColumn("_carry_rows", F.lit(0).cast("bigint"))
    begun = long.select("source", "_from", (2 * F.col("_from")).alias("_bucket"), F.col("_carry.seq").alias("_after")).distinct()
    parts = begun.unionByName(long.select("source", "_from", F.col("_lead").alias("_bucket"), F.lit(None).cast("bigint").alias("_after")))
    inside = _bucketed(events.select("source", "seq"), ranges, joints).join(_small(asof.materialise(parts)), ["source", "_bucket"])
    counts = inside.filter("_after IS NULL OR seq >= _after").groupBy("source", "_bucket").agg(F.count("*").alias("_n"))
    since = Window.partitionBy("source", "_from").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.join(counts, ["source", "_bucket"], "left").withColumn("_carry_rows", F.sum(F.coalesce("_n", F.lit(0))).over(since))
    summed = summed.filter("_after IS NULL").select("source", "_bucket", "_carry_rows")
    return carried.join(summed, ["source", "_bucket"], "left")


def with_transactions(events: DataFrame, marks: DataFrame, bucket_rows: int = BUCKET_ROWS, places: DataFrame | None = None) -> DataFrame:
    """``events`` (``source, seq, row_no, ...``) with the transaction of each row.

    ``txn_seq`` is the ``seq`` of its begin mark, ``txn_id`` its id, ``txn_row`` the
    row's number in it from 0, ``commit_seq`` and ``commit_time`` those of its end,
    and ``txn_state`` one of committed, rolled back, open (no end mark yet),
    unfinished (the next one begins first) and outside (null ``txn_seq``). A source
    without marks has all rows outside.

    Marks are gone over first, to see where buckets may begin; then rows move once, with
    those of their columns that are asked for, and nothing of them is kept.
    ``places`` (``source, seq`` of at least all of both, and ``rows`` where one stands
    for several) tells how many there are; without it, events are made once more for that.
    """
    if places is None:
        places = events.select("source", "seq").unionByName(marks.select("source", "seq"))
    ranges = _ranges(places, bucket_rows)
    joints = _joints(marks, ranges)
    carried = asof.materialise(_carried(events, ranges, joints))
    is_row = F.col("_is_row")
    rows = events.withColumn("_row_no", F.col("row_no")).withColumn("_is_row", F.lit(True))
    only_marks = marks.select("source", "seq", F.lit(0).alias("_row_no"), F.lit(False).alias("_is_row"), F.struct("mark", "seq", "id", "at").alias("_mark"))
    both = _bucketed(rows.unionByName(only_marks, allowMissingColumns=True), ranges, joints)
    up = Window.partitionBy("source", "_bucket").orderBy("seq", "_row_no", "_is_row")
    upto = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the same rows backwards: frames that reach to the end cost a pass for each row
    down = Window.partitionBy("source", "_bucket").orderBy(F.desc("seq"), F.desc("_row_no"), F.desc("_is_row"))
    from_here = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        both.withColumn("_next", F.last("_mark", ignorenulls=True).over(from_here))
        .withColumn("_rows", F.sum(is_row.cast("bigint")).over(upto))
        .withColumn("_before", F.last("_mark", ignorenulls=True).over(upto))
        .withColumn("_rows_at", F.last(F.when(~is_row, F.col("_rows")), ignorenulls=True).over(upto))
    )
    # far fewer than rows, which need not move for them
    found = placed.filter(is_row).join(_small(carried), ["source", "_bucket"])
    own = F.col("_before").isNotNull()
    begin, end = F.coalesce("_before", "_carry"), F.coalesce("_next", "_follow")
    number = F.when(own, F.col("_rows") - F.col("_rows_at")).otherwise(F.col("_rows") + F.coalesce("_carry_rows", F.lit(0))) - 1
    inside = F.coalesce(F.col("_begin.mark") == "begin", F.lit(False))
    ended = inside & F.col("_end.mark").isin("commit", "rollback")
    state = (
        F.when(~inside, "outside").when(F.col("_end").isNull(), "open").when(F.col("_end.mark") == "commit", "committed")
        .when(F.col("_end.mark") == "rollback", "rolled back").otherwise("unfinished")
    )
    return found.withColumn("_begin", begin).withColumn("_end", end).withColumn("_number", number).select(
        *events.columns,
        F.when(inside, F.col("_begin.seq")).alias("txn_seq"),
        F.when(inside, F.coalesce("_begin.id", F.when(ended, F.col("_end.id")))).alias("txn_id"),
        F.when(inside, F.col("_number")).alias("txn_row"),
        F.when(ended, F.col("_end.seq")).alias("commit_seq"),
        F.when(ended, F.col("_end.at")).alias("commit_time"),
        state.alias("txn_state"),
    )


def committed(events: DataFrame) -> DataFrame:
    """Rows of committed transactions and rows outside any; rolled-back and
    unfinished ones are left out, open ones held back."""
    return events.filter(F.col("txn_state").isin("committed", "outside"))


def held(events: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of open transactions, without their place, to go on with later."""
    return events.filter("txn_state = 'open'").select(*columns)


def open_marks(marks: DataFrame) -> DataFrame:
    """The begin mark of each source's open transaction."""
    last = marks.groupBy("source").agg(F.max_by(F.struct("seq", "mark", "id", "at"), "seq").alias("m"))
    return last.select("source", "m.seq", "m.mark", "m.id", "m.at").filter("mark = 'begin'")
