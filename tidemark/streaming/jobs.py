"""Captures as streams: row events, progress and carried state per micro-batch.

Every batch writes to a folder of its own under ``out``, named by its id and
overwritten when Spark replays the batch after a failure, so events appear
once:

    events/batch_id=N      row events
    quarantine/batch_id=N  what could not be decoded, with the reason
    progress/batch_id=N    position per source after the batch
    state/batch_id=N       table maps and files, or relations, still in force
    held/batch_id=N        with transactions: rows of those still open
    marks/batch_id=N       with transactions: their begin marks

With ``transactions``, events appear with their transaction once it has ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import asof, binlog, pgoutput, positions, transactions as txn, wal
from tidemark.operators.envelope import filter_tables, mysql_row_events, pg_row_events
from tidemark.operators.errors import apply_on_error, quarantine
from tidemark.plans import mysql

STATE = "source STRING, table_id BIGINT, seq BIGINT, state BINARY"
REPORT_EVERY = "10 seconds"


def _save(df: DataFrame, out: str, kind: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{out}/{kind}/batch_id={batch_id}")


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keeps a batch's rows for its several outputs, and lets go whatever happens."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def _save_events(events: DataFrame, marks: DataFrame | None, out: str, batch_id: int) -> None:
    """Events as they come or, given marks, those whose transaction has ended; the
    rest waits, with what earlier batches left waiting."""
    if marks is None:
        return _save(events, out, "events", batch_id)
    if batch_id:
        read = events.sparkSession.read
        events = events.unionByName(read.schema(events.schema).parquet(f"{out}/held/batch_id={batch_id - 1}"))
        marks = marks.unionByName(read.schema(txn.MARK).parquet(f"{out}/marks/batch_id={batch_id - 1}"))
    with _kept(txn.with_transactions(events, marks)) as placed:
        _save(txn.committed(placed), out, "events", batch_id)
        _save(txn.held(placed, events.columns), out, "held", batch_id)
        _save(txn.open_marks(marks), out, "marks", batch_id)


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool, every: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def run_postgres(
    frames: DataFrame, out: str, checkpoint: str, tables: list[str] | None = None,
    available_now: bool = False, every: str = REPORT_EVERY, transactions: bool = False,
) -> StreamingQuery:
    """WAL frames to row events. ``available_now`` stops when caught up."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(wal.parsed_frames(batch)) as parsed:
            decoded = wal.decoded_frames(parsed, "keep")
            events = pg_row_events(apply_on_error(decoded, "skip"))
            wanted = filter_tables(events, tables) if tables else events
            _save_events(wanted, txn.wal_marks(decoded) if transactions else None, out, batch_id)
            _save(wal.quarantined_frames(parsed), out, "quarantine", batch_id)
            _save(positions.wal_progress(decoded), out, "progress", batch_id)

    return _start(frames, handle, checkpoint, available_now, every)


def run_pgoutput(
    frames: DataFrame, out: str, checkpoint: str, tables: list[str] | None = None,
    available_now: bool = False, every: str = REPORT_EVERY, transactions: bool = False,
) -> StreamingQuery:
    """Frames of the server's own plugin (``captures.pgoutput_frames``) to row events.

    The relations in force at the end of a batch are saved and read by the next
    one: one row for each relation of a source. Batches must arrive in ``seq``
    order per source."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            states = pgoutput.relation_states(batch)
            if batch_id:
                before = batch.sparkSession.read.schema(STATE).parquet(f"{out}/state/batch_id={batch_id - 1}")
                states = states.unionByName(before.select(*states.columns))
            found = pgoutput.relations(states)
            _save(pgoutput.open_relations(found), out, "state", batch_id)
            with _kept(pgoutput.decode_pgoutput(batch, found, "keep")) as decoded:
                events = pg_row_events(apply_on_error(decoded, "skip"))
                wanted = filter_tables(events, tables) if tables else events
                _save_events(wanted, txn.wal_marks(decoded) if transactions else None, out, batch_id)
                _save(quarantine(decoded).select("source", "seq", "error"), out, "quarantine", batch_id)
                _save(positions.wal_progress(decoded), out, "progress", batch_id)

    return _start(frames, handle, checkpoint, available_now, every)


def run_mysql(
    packets: DataFrame, out: str, checkpoint: str, tables: list[str] | None = None,
    available_now: bool = False, every: str = REPORT_EVERY, checksum_len: int = 0, transactions: bool = False,
) -> StreamingQuery:
    """Binlog packets to row events.

    The table maps and files in force at the end of a batch are saved and read
    by the next one, where they take part as ordinary earlier states; no key is
    ever handled by a single task. A server repeats a table's map in every file
    before its rows, so maps older than the open file are not carried and the
    state does not grow. Batches must arrive in ``seq`` order per
    source: a row event older than the carried state finds no table map and
    goes to quarantine.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            decode(batch, batch_id)

    def decode(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = binlog.log_states(batch, checksum_len)
        if batch_id:
            before = spark.read.schema(STATE).parquet(f"{out}/state/batch_id={batch_id - 1}")
            states = states.unionByName(before)
        state = mysql.LogState(*asof.log_state_intervals(states))
        _save(asof.open_states(state.maps, state.files), out, "state", batch_id)
        with _kept(mysql.decoded_rows(batch, state, tables, "keep", checksum_len)) as rows:
            marks = txn.binlog_marks(batch, checksum_len) if transactions else None
            _save_events(mysql_row_events(apply_on_error(rows, "skip")), marks, out, batch_id)
            bad_rows = quarantine(rows).select("source", "seq", "error")
            bad_packets = binlog.packet_quarantine(batch, checksum_len, changes=True).drop("packet")
            _save(bad_packets.unionByName(bad_rows), out, "quarantine", batch_id)
        heads = binlog.with_rotate_fields(binlog.headers(batch, "skip", checksum_len))
        files = state.files.df.filter("hi IS NULL").select("source", F.col("log_file").alias("open_file"))
        progress = positions.binlog_progress(heads).join(files, "source", "left")
        _save(progress.withColumn("log_file", F.col("open_file")).drop("open_file"), out, "progress", batch_id)

    return _start(packets, handle, checkpoint, available_now, every)
