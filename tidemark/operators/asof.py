"""As-of association: each event takes the latest state set before it.

The states (table maps, rotates) repeat endlessly in a log, so they are first
reduced to their change points; events are then matched to the intervals
between change points without being sorted or windowed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.bytes import utf8

# Bounds for sending intervals to every executor; beyond either, the join
# shuffles on (keys, bucket) instead.
BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 500_000

# log2 of the seq ranges over which repeats are collapsed, smallest first. The first
# should hold many states but few changes: a range that goes back to an earlier value
# is read again and sorted.
COLLAPSE_BITS = (16, 24, 32)

# Buckets without intervals over which a shuffled join spreads settled events.
SPREAD = 4096

# Stands for a payload kept apart from its intervals.
DIGEST = "_digest"
TABLE_ID_BYTES = 6


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the session names; without one, kept by
    the executors and computed again if one is lost."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            return df.persist()
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def _bucket(bits: int):
    return F.shiftright("seq", bits)


def _drop_repeats(states: DataFrame, keys: list[str], value: str, within=None) -> DataFrame:
    """Keep a state only if it differs from the one before it."""
    groups = keys if within is None else keys + ["_within"]
    framed = states if within is None else states.withColumn("_within", within)
    w = Window.partitionBy(*groups).orderBy("seq")
    before = framed.withColumn("_before", F.lag(value).over(w)).withColumn("_n", F.row_number().over(w))
    changed = (F.col("_n") == 1) | ~F.col("_before").eqNullSafe(F.col(value))
    return before.filter(changed).select(*keys, "seq", value)


def change_points(states: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of ``keys, seq, value`` where ``value`` changes along ``seq``.

    Pass one is an aggregate with map-side combine: per short ``seq`` range
    and distinct value, its first and last ``seq``. Where those spans do not
    overlap their starts are the change points, which is nearly always. Only
    ranges with overlapping spans (A, B, A) are read again and ordered row by
    row, each at most ``2**COLLAPSE_BITS[0]`` wide, so no hot key is ever one
    task. The survivors are then collapsed over wider ranges, then per key.
    """
    bits = COLLAPSE_BITS[0]
    spans = states.groupBy(*keys, _bucket(bits).alias("_b"), value).agg(
        F.min("seq").alias("seq"), F.max("seq").alias("_last")
    )
    ordered = Window.partitionBy(*keys, "_b").orderBy("seq")
    whole = Window.partitionBy(*keys, "_b")
    overlap = F.coalesce(F.max("_last").over(ordered.rowsBetween(Window.unboundedPreceding, -1)) >= F.col("seq"), F.lit(False))
    marked = materialise(
        spans.withColumn("_overlap", overlap).withColumn("_mixed", F.max("_overlap").over(whole))
    )
    mixed = marked.filter("_mixed").select(*keys, "_b").distinct()
    points = marked.filter("NOT _mixed").select(*keys, "seq", value)
    if not mixed.isEmpty():
        again = states.withColumn("_b", _bucket(bits)).join(mixed, keys + ["_b"], "left_semi")
        points = points.unionByName(_drop_repeats(again.drop("_b"), keys, value, _bucket(bits)))
    for bits in COLLAPSE_BITS[1:]:
        points = _drop_repeats(points, keys, value, _bucket(bits))
    return _drop_repeats(points, keys, value)


@dataclass
class Intervals:
    """Materialised intervals ``keys, lo, hi, <payload>``; ``hi`` is null on the
    open last one. The sizes are measured and decide how they are joined.

    A large payload is kept once per distinct value: the intervals then carry its
    ``DIGEST`` and ``values`` leads from that to the ``value_columns``.
    """

    df: DataFrame
    keys: list[str]
    payload: list[str]
    rows: int
    closed: int
    bytes: int
    values: DataFrame | None = None
    value_columns: tuple[str, ...] = ()
    value_rows: int = 0
    value_bytes: int = 0

    @property
    def fits_broadcast(self) -> bool:
        # Two copies of a closed interval can span a bucket border.
        return 3 * self.rows <= BROADCAST_ROWS and 3 * self.bytes <= BROADCAST_BYTES

    @property
    def values_fit_broadcast(self) -> bool:
        return self.value_rows <= BROADCAST_ROWS and self.value_bytes <= BROADCAST_BYTES

    @property
    def columns(self) -> list[str]:
        """What the as-of join adds."""
        return [*self.value_columns, *(c for c in self.payload if c != DIGEST)]

    def whole(self) -> DataFrame:
        """The intervals with their values in place of digests."""
        if self.values is None:
            return self.df
        hint = F.broadcast if self.values_fit_broadcast else lambda df: df
        return self.df.join(hint(self.values), DIGEST, "left").drop(DIGEST)

    @cached_property
    def tails(self) -> DataFrame:
        """Per key its open interval, and the bits to drop from ``seq`` so that a
        bucket is about as wide as the key's mean closed interval."""
        span = F.sum((F.col("hi") - F.col("lo")).cast("double"))
        ratio = F.greatest(F.lit(1.0), span / F.greatest(F.count("hi"), F.lit(1)))
        return materialise(
            self.df.groupBy(*self.keys).agg(
                F.max("lo").alias("_open"),
                F.max_by(F.struct(*self.payload), "lo").alias("_tail"),
                F.coalesce(F.ceil(F.log2(ratio)).cast("int"), F.lit(0)).alias("_shift"),
            )
        )

    @cached_property
    def past(self) -> DataFrame:
        """The closed intervals, once per bucket they touch: about two buckets
        each on average, as a key's buckets are as many as its intervals."""
        shr = lambda c: F.expr(f"shiftright({c}, _shift)")
        closed = self.df.filter("hi IS NOT NULL").join(self.tails.select(*self.keys, "_shift"), self.keys)
        return materialise(
            closed.withColumn("_bucket", F.explode(F.sequence(shr("lo"), shr("hi - 1")))).select(
                *self.keys, "_bucket", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.struct(*self.payload).alias("_past")
            )
        )


def intervals(points: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Change points as intervals ``keys, lo, hi, <payload>``, materialised."""
    w = Window.partitionBy(*keys).orderBy("seq")
    return materialise(
        points.select(*keys, F.col("seq").alias("lo"), F.lead("seq").over(w).alias("hi"), *payload)
    )


def _width(columns: list[str]):
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(64))


def measured(df: DataFrame, keys: list[str], payload: list[str]) -> Intervals:
    """Intervals with the sizes that decide how they are joined."""
    rows, closed, size = df.agg(F.count("*"), F.count("hi"), F.coalesce(F.sum(_width(payload)), F.lit(0))).first()
    return Intervals(df, keys, payload, rows, closed, size)


def with_values(iv: Intervals, values: DataFrame) -> Intervals:
    """Intervals of digests with the values they stand for, measured."""
    columns = [c for c in values.columns if c != DIGEST]
    rows, size = values.agg(F.count("*"), F.coalesce(F.sum(_width(columns)), F.lit(0))).first()
    return replace(iv, values=values, value_columns=tuple(columns), value_rows=rows, value_bytes=size)


def _found(events: DataFrame, iv: Intervals, shuffle: bool) -> DataFrame:
    """Events with ``_state``, the payload in force. One lookup finds a key's open
    interval; events before it do a second one in the bucket of their seq, whose
    width is set per key, so neither a dense key nor a long one is scanned through.

    Both lookups are broadcast, or else both shuffle. A shuffled bucket holds
    a few intervals' events, and events that the first lookup settled are spread
    over buckets that match nothing.
    """
    hint = (lambda df: df) if shuffle else F.broadcast
    out = events.join(hint(iv.tails), iv.keys, "left")
    settled = F.col("_open").isNull() | (F.col("seq") >= F.col("_open"))
    state = F.when(F.col("seq") >= F.col("_open"), F.col("_tail"))
    if not iv.closed:
        return out.withColumn("_state", state).drop("_open", "_tail", "_shift")
    nowhere = -1 - F.pmod(F.xxhash64("seq"), F.lit(SPREAD)) if shuffle else F.lit(None).cast("bigint")
    out = out.withColumn("_bucket", F.when(settled, nowhere).otherwise(F.expr("shiftright(seq, _shift)")))
    e, c = out.alias("e"), hint(iv.past).alias("c")
    match = [F.col(f"e.{k}") == F.col(f"c.{k}") for k in iv.keys + ["_bucket"]]
    joined = e.join(c, [*match, F.col("e.seq") >= F.col("c._lo"), F.col("e.seq") < F.col("c._hi")], "left")
    found = F.coalesce(F.when(F.col("e.seq") >= F.col("e._open"), F.col("e._tail")), F.col("c._past"))
    return joined.select("e.*", found.alias("_state")).drop("_open", "_tail", "_shift", "_bucket")


def asof_join(events: DataFrame, iv: Intervals, shuffle: bool | None = None) -> DataFrame:
    """Left as-of join on ``iv.keys`` and ``seq``: adds ``iv.columns``, null where
    no state came before. ``shuffle`` overrides the measured choice."""
    use_shuffle = not iv.fits_broadcast if shuffle is None else shuffle
    joined = _found(events, iv, use_shuffle).select("*", *[F.col(f"_state.{c}").alias(c) for c in iv.payload]).drop("_state")
    if iv.values is None:
        return joined
    values = F.broadcast(iv.values) if iv.values_fit_broadcast else iv.values
    return joined.join(values, DIGEST, "left").select(*events.columns, *iv.columns)


FILE_STATE = -1  # stands in for the table id on log file intervals


def log_state_intervals(states: DataFrame) -> tuple[Intervals, Intervals]:
    """Which table map was in force per source and table id, and which binlog
    file per source. ``states`` holds both (see ``binlog.log_states``).

    Table maps go by a digest of what follows their table id, as a server repeats
    a map before each statement and gives a reopened table a new id. Their bodies
    are kept once per digest.
    """
    keys = ["source", "table_id"]
    is_file = F.col("table_id") == FILE_STATE
    digest = F.unhex(F.md5(F.substring("state", TABLE_ID_BYTES + 1, 1 << 30)))
    points = change_points(states.withColumn("state", F.when(is_file, F.col("state")).otherwise(digest)), keys, "state")
    df = intervals(points, keys, ["state"])
    bodies = materialise(states.filter(~is_file).groupBy(digest.alias(DIGEST)).agg(F.min("state").alias("table_map")))
    maps = df.filter(~is_file).select(*keys, "lo", "hi", F.col("state").alias(DIGEST), F.col("lo").alias("map_seq"))
    files = df.filter(is_file).select("source", "lo", "hi", utf8(F.col("state")).alias("log_file"))
    return with_values(measured(maps, keys, [DIGEST, "map_seq"]), bodies), measured(files, ["source"], ["log_file"])


def open_states(maps: Intervals, files: Intervals) -> DataFrame:
    """The states still in force, in the shape of ``states`` above, without table
    maps from before the open file of their source."""
    opened = files.df.filter("hi IS NULL").select("source", F.col("lo").alias("_opened"))
    now = (
        maps.whole()
        .filter("hi IS NULL")
        .join(opened, "source", "left")
        .filter(F.col("_opened").isNull() | (F.col("lo") >= F.col("_opened")))
        .select("source", "table_id", F.col("lo").alias("seq"), F.col("table_map").alias("state"))
    )
    file = files.df.filter("hi IS NULL").select(
        "source", F.lit(FILE_STATE).cast("bigint").alias("table_id"), F.col("lo").alias("seq"), F.encode("log_file", "UTF-8").alias("state")
    )
    return now.unionByName(file)


def with_table_map(row_events: DataFrame, maps: Intervals, shuffle: bool | None = None) -> DataFrame:
    """Row events with the table map body in force; null goes to quarantine."""
    return asof_join(row_events, maps, shuffle)


def with_log_file(events: DataFrame, files: Intervals, shuffle: bool | None = None) -> DataFrame:
    """Events with the name of the file they are in."""
    return asof_join(events, files, shuffle)
