"""Captured log messages as DataFrames, batch or streaming.

Something else lands the captures. ``seq`` is the arrival order per source and
must be assigned by the capture: file order does not survive a parallel scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.bytes import byte_is, int_be, slice_bytes, utf8

WAL_CAPTURE = (
    "source STRING, seq BIGINT, kind STRING, start_lsn BIGINT, end_lsn BIGINT, "
    "clock_us BIGINT, must_reply BOOLEAN, timeline INT, message STRING"
)
BINLOG_CAPTURE = "source STRING, seq BIGINT, packet BINARY"


def _read(spark: SparkSession, path: str, fmt: str, schema: str, streaming: bool, options: dict) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format(fmt).schema(schema).options(**options).load(path)


def read_wal_capture(
    spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False, **options
) -> DataFrame:
    """WAL frames from parquet or json files with the fixed capture schema, or
    from text files holding one wal2json message per line (no positions)."""
    if fmt != "text":
        return _read(spark, path, fmt, WAL_CAPTURE, streaming, options)
    lines = _read(spark, path, "text", "value STRING", streaming, options)
    empty = {"seq": "bigint", "start_lsn": "bigint", "end_lsn": "bigint", "clock_us": "bigint",
             "must_reply": "boolean", "timeline": "int"}
    return lines.select(
        F.lit("text").alias("source"),
        *[F.lit(None).cast(empty[c]).alias(c) if c in empty else F.lit("w").alias(c)
          for c in ("seq", "kind", "start_lsn", "end_lsn", "clock_us", "must_reply", "timeline")],
        F.col("value").alias("message"),
    )


def read_binlog_capture(
    spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False, **options
) -> DataFrame:
    """Binlog packets from parquet, or from json with base64 packets."""
    return _read(spark, path, fmt, BINLOG_CAPTURE, streaming, options)


def from_kafka(records: DataFrame, by_partition: bool = False) -> DataFrame:
    """``source, seq, packet`` from Kafka records.

    The record key names the source and the offset is its order, which holds within
    one partition only. A source that is written to several must be told apart by
    ``by_partition``: then ``source`` is ``key@topic/partition``, and each partition
    has an order, table maps and positions of its own. ``spread_sources`` finds such
    sources.
    """
    key = F.col("key").cast("string")
    place = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    return records.select(
        (F.concat(key, F.lit("@"), place) if by_partition else key).alias("source"),
        F.col("offset").cast("bigint").alias("seq"),
        F.col("value").alias("packet"),
    )


def spread_sources(records: DataFrame) -> DataFrame:
    """``source, partitions`` of sources that span several partitions, whose offsets
    give no order: empty if ``from_kafka`` may go by key alone. One partial aggregate
    on three narrow columns."""
    places = records.groupBy(F.col("key").cast("string").alias("source"), "topic", "partition").agg(F.lit(1).alias("_one"))
    return places.groupBy("source").agg(F.count("*").alias("partitions")).filter("partitions > 1")


def read_kafka(spark: SparkSession, streaming: bool = True, by_partition: bool = False, **options) -> DataFrame:
    """Kafka topic of raw packets. Needs Spark's Kafka package on the class path;
    ``startingOffsets=latest`` starts at the current end. A batch whose sources span
    partitions raises unless ``by_partition``; streams cannot look ahead and go by it
    where that may be."""
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**options).load()
    if not streaming and not by_partition:
        spread = spread_sources(records).select("source").limit(5).collect()
        if spread:
            raise ValueError(f"sources in several partitions: {', '.join(str(r['source']) for r in spread)}")
    return from_kafka(records, by_partition)


def wal_frames(frames: DataFrame) -> DataFrame:
    """Raw CopyData bodies (``source, seq, packet``) as the WAL capture schema.

    'w' carries start, end, clock and JSON; 'k' carries end, clock and the
    reply flag; integers are big-endian. Other or cut frames get kind null.
    """
    return _frames(frames, lambda payload: utf8(payload).alias("message"))


def pgoutput_frames(frames: DataFrame) -> DataFrame:
    """As ``wal_frames``, where the server's own output plugin wrote the payload:
    binary ``body`` in place of ``message``."""
    return _frames(frames, lambda payload: payload.alias("body"))


def _frames(frames: DataFrame, payload) -> DataFrame:
    p = F.col("packet")
    data = byte_is(p, 1, ord("w")) & (F.length(p) > 25)
    alive = byte_is(p, 1, ord("k")) & (F.length(p) == 18)
    return frames.select(
        "source",
        "seq",
        F.when(data, "w").when(alive, "k").alias("kind"),
        F.when(data, int_be(p, 2)).alias("start_lsn"),
        F.when(data, int_be(p, 10)).when(alive, int_be(p, 2)).alias("end_lsn"),
        F.when(data, int_be(p, 18)).when(alive, int_be(p, 10)).alias("clock_us"),
        F.when(alive, byte_is(p, 18, 1)).alias("must_reply"),
        F.lit(None).cast("int").alias("timeline"),
        payload(F.when(data, slice_bytes(p, 26, F.length(p) - 25))),
    )
