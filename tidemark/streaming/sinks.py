"""Where row events go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.envelope import kafka_payload


def stream_events(events: DataFrame, fmt: str, checkpoint: str, available_now: bool = False, **options) -> StreamingQuery:
    """A streaming row-event DataFrame to ``console``, ``parquet``, ``json`` or
    any other sink Spark knows."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    return (
        events.writeStream.format(fmt).options(checkpointLocation=checkpoint, **options).trigger(**trigger).start()
    )


def write_events(events: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Batch row events to files, one folder per table."""
    events.write.partitionBy("schema", "table").format(fmt).save(path)


def write_payload(events: DataFrame, fmt: str = "kafka", keys: DataFrame | None = None, **options) -> None:
    """Batch row events as key and value (see ``kafka_payload``). ``kafka`` needs Spark's Kafka package
    on the class path; any file format takes the same two columns."""
    kafka_payload(events, keys).write.format(fmt).options(**options).save()
