"""Helpers the operators of this package share."""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

# Text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 4 << 20
# Text that Spark hands to a worker at once.
MOST_BATCH_BYTES = 8 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _set_checkpoint_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names. Only a local session may go
    without the setting; it gets a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows and their order inside a partition are fixed
    afterwards."""
    _set_checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet beside the checkpoints and read again: smaller than
    a checkpoint, but rows come in any order."""
    place = f"{_set_checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def bounded_batches(df: DataFrame) -> DataFrame:
    """`df`, with the session's Arrow batches bounded by MOST_BATCH_BYTES, as ten
    thousand long texts in one batch would fill a worker."""
    conf = df.sparkSession.conf
    if int(re.sub(r"\D", "", conf.get(BATCH_BYTES)) or 0) > MOST_BATCH_BYTES:
        conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))
    return df


def fold(column: str, folds: int):
    """Fold of an id: crc32 of its decimal text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes of text, or of one row."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    start, n = 0, len(lengths)
    while start < n:
        base = ends[start] - lengths[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, min(stop, n)
        start = stop


def with_text_columns(
    docs: DataFrame, text: str, fields: list[StructField], make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """All columns of `docs` and new ones computed from its text column.

    `make` is called once per task and gives a function from a slice of texts
    (null as empty) to one array per field. No shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for start, stop in slices(batch.column(text), slice_bytes):
                part = batch.slice(start, stop - start)
                texts = pc.fill_null(part.column(text), "")
                made = [pa.array(a).cast(t) for a, t in zip(fn(texts), types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *names])
            pa.default_memory_pool().release_unused()

    return bounded_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and the n + 1 offsets between them."""
    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def per_worker(key: object, make: Callable[[], object]) -> object:
    """`make()`, kept for the other tasks of the same Python worker. Functions of
    this package travel with the task, so their own globals are new each time."""
    store = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def gapless_rank(df: DataFrame, keys: list[str], out: str, rows_per_bucket: int = 100_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    `df` must be saved, so that its row order is fixed. A group is split into
    buckets of about `rows_per_bucket` rows; each bucket is numbered by itself
    and starts where the ones before it end, so no group has to fit in a task.
    The number of distinct groups must be bounded.
    """
    row, buckets, bucket, first = (free_name(df, n) for n in ("_row", "_buckets", "_bucket", "_first"))
    numbered = df.withColumn(row, F.monotonically_increasing_id())
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(rows_per_bucket)).cast("long").alias(buckets))
    split = numbered.join(F.broadcast(sizes), keys).withColumn(
        bucket, F.pmod(F.xxhash64(row), F.col(buckets)).cast("int")
    )
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        split.groupBy(*keys, bucket)
        .agg(F.count("*").alias(first))
        .withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(row)
    return (
        split.join(starts, [*keys, bucket])
        .withColumn(out, F.col(first) + F.row_number().over(inside) - 1)
        .drop(row, buckets, bucket, first)
    )
