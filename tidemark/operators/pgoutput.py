"""PostgreSQL messages of the server's own output plugin.

Row messages name their table by a relation id; relation messages sent in-band
say what it stands for, so row messages are joined as-of to the relation in force,
like binlog events to table maps. A tuple frames itself: each column is a mark
(null, unchanged, text) and, for text, a length. The decoder steps over all
events of one relation at once, column by column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.bytes import int_be, slice_bytes, utf8
from tidemark.functions.names import action_kind
from tidemark.functions.positions import pg_clock
from tidemark.operators import asof
from tidemark.operators.errors import apply_on_error
from tidemark.operators.rowcodec import _body_bytes, _slices

COLUMNS = "ARRAY<STRUCT<name: STRING, type: STRING, value: STRING>>"
KEYS = ["source", "table_id"]
MESSAGES = "BCRYOIUDTM"
CUT, UNRELATED = "message cut short", "no relation before the row message"

# Type names by object id, and those whose modifier is a length.
TYPE_NAMES = {
    16: "boolean", 17: "bytea", 18: '"char"', 19: "name", 20: "bigint", 21: "smallint", 23: "integer", 25: "text", 26: "oid",
    114: "json", 142: "xml", 600: "point", 650: "cidr", 700: "real", 701: "double precision", 790: "money", 829: "macaddr",
    869: "inet", 1000: "boolean[]", 1005: "smallint[]", 1007: "integer[]", 1009: "text[]", 1016: "bigint[]", 1021: "real[]",
    1022: "double precision[]", 1042: "character", 1043: "character varying", 1082: "date", 1083: "time without time zone",
    1114: "timestamp without time zone", 1184: "timestamp with time zone", 1186: "interval", 1231: "numeric[]",
    1266: "time with time zone", 1560: "bit", 1562: "bit varying", 1700: "numeric", 2950: "uuid", 3802: "jsonb",
}
WITH_LENGTH = {1042: 4, 1043: 4, 1560: 0, 1562: 0}  # what the modifier adds to it
BOOLEAN = "boolean"


def type_name(oid: int, modifier: int) -> str:
    """A type as the server prints it; ``type 12345`` for one it would have to look up."""
    name = TYPE_NAMES.get(oid, f"type {oid}")
    if modifier < 0:
        return name
    if oid in WITH_LENGTH:
        return f"{name}({modifier - WITH_LENGTH[oid]})"
    if oid == 1700:
        return f"{name}({modifier - 4 >> 16},{modifier - 4 & 0xFFFF})"
    if oid in (1083, 1114, 1184, 1266):
        head, tail = name.split(" ", 1)
        return f"{head}({modifier}) {tail}"
    return name


@dataclass(frozen=True)
class Relation:
    schema: str
    table: str
    names: tuple[str, ...]
    types: tuple[str, ...]
    key: tuple[bool, ...]


def parse_relation(body: bytes) -> Relation:
    """A relation message. Raises ValueError when it is cut short."""
    at = 5

    def text() -> str:
        nonlocal at
        end = body.index(b"\0", at)
        found, at = body[at:end].decode(), end + 1
        return found

    def number(size: int, signed: bool = False) -> int:
        nonlocal at
        if at + size > len(body):
            raise ValueError("relation cut short")
        at += size
        return int.from_bytes(body[at - size : at], "big", signed=signed)

    schema, table = text() or "pg_catalog", text()
    number(1)  # how the old row is sent
    columns = []
    for _ in range(number(2)):
        flags, name = number(1), text()
        columns.append((name, type_name(number(4), number(4, signed=True)), bool(flags & 1)))
    return Relation(schema, table, *(tuple(c) for c in zip(*columns))) if columns else Relation(schema, table, (), (), ())


def relation_states(frames: DataFrame) -> DataFrame:
    """What later row messages depend on: ``source, table_id, seq, state``, the state
    being a relation message."""
    body = F.col("body")
    mine = frames.filter((F.col("kind") == "w") & (slice_bytes(body, 1, 1) == F.lit(b"R")))
    return mine.select("source", int_be(body, 2, 4).alias("table_id"), "seq", body.alias("state"))


def relations(states: DataFrame) -> asof.Intervals:
    """Which relation message was in force per source and relation id. Messages are
    kept once, by digest, as a server sends the same ones again and again."""
    digest = F.unhex(F.md5("state"))
    points = asof.change_points(states.withColumn("state", digest), KEYS, "state").withColumnRenamed("state", asof.DIGEST)
    bodies = asof.materialise(states.groupBy(digest.alias(asof.DIGEST)).agg(F.min("state").alias("state")))
    return asof.with_values(asof.measured(asof.intervals(points, KEYS, [asof.DIGEST]), KEYS, [asof.DIGEST]), bodies)


def open_relations(iv: asof.Intervals) -> DataFrame:
    """The relations in force at the end, in the shape of ``relation_states``: one
    row for each relation of a source."""
    return iv.whole().filter("hi IS NULL").select(*KEYS, F.col("lo").alias("seq"), "state")


def _native(frames: DataFrame) -> DataFrame:
    """Fields of the messages that need no relation; one row for each table of a
    truncate."""
    body = F.col("body")
    is_data = F.col("kind") == "w"
    tag = F.when(is_data, slice_bytes(body, 1, 1).cast("string"))
    size = F.length(body)
    is_ = lambda letters: F.col("tag").isin(*letters)
    least = F.when(is_("B"), 21).when(is_("C"), 26).when(is_("IUD"), 8).when(is_("RYOT"), 6).when(is_("M"), 15)
    tables = int_be(body, 2, 4)
    prefix = F.substring_index(slice_bytes(body, 11, size).cast("string"), "\0", 1)
    after = F.octet_length(prefix) + 12  # past the null byte
    known = F.coalesce(F.col("kind").isin("w", "k", "t"), F.lit(False))
    error = (
        F.when(~known, "unknown frame")
        .when(is_data & ~F.coalesce(is_(MESSAGES), F.lit(False)), F.concat(F.lit("unknown message "), F.coalesce(F.hex(slice_bytes(body, 1, 1)), F.lit(""))))
        .when(is_data & (size < least), CUT)
        .when(is_("T") & (size != 6 + 4 * tables), CUT)
        .when(is_("M") & (size != after + 3 + int_be(body, after, 4)), CUT)
    )
    at = lambda i: (7 + 4 * i).cast("int")
    ids = F.when(is_("IUD"), F.array(int_be(body, 2, 4))).when(
        is_("T") & (size == 6 + 4 * tables) & (tables > 0),
        F.transform(F.sequence(F.lit(0), (tables - 1).cast("int")), lambda i: int_be(body, at(i), 4)),
    )
    # messages without a table are spread over ids that no relation has
    ids = F.coalesce(F.when(F.col("error").isNull(), ids), F.array(-1 - F.pmod(F.xxhash64("seq"), F.lit(asof.SPREAD))))
    stamp = F.when(is_("B"), int_be(body, 10)).when(is_("C"), int_be(body, 19))
    return frames.withColumn("tag", tag).withColumn("error", error).withColumn("ids", ids).select(
        "source", "seq", "kind", "start_lsn", "end_lsn", "clock_us", pg_clock(F.col("clock_us")).alias("event_time"),
        "must_reply", "timeline", "tag", "error",
        F.when(is_("M"), slice_bytes(body, 2, 1) == F.lit(b"\1")).alias("transactional"),
        F.when(is_("M"), prefix).alias("prefix"),
        F.when(is_("M"), utf8(slice_bytes(body, after + 4, size))).alias("content"),
        F.when(is_("B"), int_be(body, 18, 4)).alias("xid"),
        F.when(is_("B"), int_be(body, 2)).when(is_("C"), int_be(body, 3)).alias("commit_lsn"),
        pg_clock(stamp).alias("commit_time"),
        F.when(is_("IUD"), body).alias("row"), "ids",
    ).withColumnRenamed("row", "body").withColumn("table_id", F.explode("ids")).drop("ids")


def mark_messages(frames: DataFrame) -> DataFrame:
    """Begin and commit messages with what marks a transaction, as ``decode_pgoutput``
    gives them, which need no relation."""
    marks = _native(frames).filter(F.col("tag").isin("B", "C") & F.col("error").isNull())
    return marks.select("source", "seq", "event_time", F.col("tag").alias("action"), action_kind(F.col("tag")).alias("action_kind"), "xid", "commit_time")


class _Tuples:
    """One tuple of each event: marks and places of its values, column by column.
    Events whose tuple does not fit are marked as failed."""

    def __init__(self, data: np.ndarray, pos: np.ndarray, end: np.ndarray, columns: int, error: np.ndarray):
        n = len(pos)
        self.mark = np.zeros((n, columns), np.uint8)
        self.start, self.size = np.zeros((n, columns), np.int64), np.zeros((n, columns), np.int64)
        count = _number(data, pos, 2)
        error[(error == None) & (pos + 2 > end)] = CUT  # noqa: E711
        error[(error == None) & (count != columns)] = "column count differs from the relation"  # noqa: E711
        pos = pos + 2
        for j in range(columns):
            good = error == None  # noqa: E711
            mark = np.where(good & (pos < end), data[np.minimum(pos, len(data) - 1)], 0)
            sized = (mark == ord("t")) | (mark == ord("b"))
            size = np.where(sized, _number(data, pos + 1, 4), 0)
            self.mark[:, j], self.start[:, j], self.size[:, j] = mark, pos + 5, size
            pos = pos + np.where(sized, 5 + size, 1)
            error[good & ((pos > end) | (mark == 0))] = CUT
            error[good & (mark == ord("b"))] = "binary value, which only its type can read"
            error[good & (mark != 0) & ~np.isin(mark, [ord(c) for c in "nutb"])] = "unknown mark in a tuple"
        self.pos = pos


def _number(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    value = np.zeros(len(at), np.int64)
    for i in range(size):
        value = value << 8 | data[np.minimum(at + i, len(data) - 1)]
    return value


def _image(relation: Relation, data: np.ndarray, tuples: _Tuples, keep: np.ndarray) -> pa.Array:
    """Column changes of each event, those of ``keep`` that were sent."""
    keep = keep & (tuples.mark != ord("u"))
    rows, columns = keep.shape
    cell = np.flatnonzero(keep)
    column = pa.array(cell % columns if columns else cell)
    text = _slices(data, tuples.start.ravel()[cell], tuples.size.ravel()[cell], tuples.mark.ravel()[cell] == ord("t")).cast(pa.string())
    types = pa.array(relation.types, pa.string()).take(column)
    if BOOLEAN in relation.types:
        is_true = pc.if_else(pc.equal(text, "t"), "true", "false")
        text = pc.if_else(pc.equal(types, BOOLEAN), is_true, text)
    fields = [pa.field("name", pa.string()), pa.field("type", pa.string()), pa.field("value", pa.string())]
    items = pa.StructArray.from_arrays([pa.array(relation.names, pa.string()).take(column), types, text], fields=fields)
    offsets = np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), items)


_IMAGE = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string()), ("value", pa.string())]))


def _decode(relation: Relation, tag: str, data: np.ndarray, pos: np.ndarray, end: np.ndarray):
    """After and before images of row messages of one kind, and why not."""
    n, width = len(pos), len(relation.names)
    error = np.full(n, None, object)
    every, key = np.ones((n, width), bool), np.tile(np.array(relation.key, bool), (n, 1))
    lead = data[np.minimum(pos + 5, len(data) - 1)]
    old, before = None, (lead == ord("K")) | (lead == ord("O"))
    at = pos + 6
    if tag != "I":
        # an update without an old row kept its key, which the new row then tells
        old = _Tuples(data, at, end, width, error)
        if tag == "D":
            error[(error == None) & ~before] = "delete without its old row"  # noqa: E711
        at = np.where(before, old.pos + 1, at)
        lead = np.where(before, data[np.minimum(at - 1, len(data) - 1)], lead)
    if tag != "D":
        error[(error == None) & (lead != ord("N"))] = "row message without a new row"  # noqa: E711
        new = _Tuples(data, at, end, width, error)
        last = new.pos
    else:
        last = old.pos
    error[(error == None) & (last != end)] = "bytes after the row"  # noqa: E711
    bad = error != None  # noqa: E711
    for tuples in (old, new if tag != "D" else None):
        if tuples is not None:
            tuples.size[bad] = 0
    good = ~bad[:, None]
    columns = _image(relation, data, new, every & good) if tag != "D" else pa.nulls(n, _IMAGE)
    if tag == "I":
        return columns, pa.nulls(n, _IMAGE), error
    whole = data[np.minimum(pos + 5, len(data) - 1)] == ord("O")
    identity = _image(relation, data, old, np.where(whole[:, None], every, key) & good)
    return columns, identity, error


def _decoder(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[bytes, Relation | str] = {}

        def relation(body: bytes | None) -> Relation | str:
            if body is None:
                return UNRELATED
            if body not in parsed:
                try:
                    parsed[body] = parse_relation(body)
                except ValueError as e:
                    parsed[body] = f"unreadable relation: {e}"
            return parsed[body]

        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            tags = get("tag").to_pylist()
            errors = get("error").to_pylist()
            coded = get("state").dictionary_encode()
            states = [relation(b) for b in coded.dictionary.to_pylist()]
            code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            data, offsets = _body_bytes(get("body"))
            data = data if len(data) else np.zeros(1, np.uint8)
            groups: dict[tuple, list[int]] = {}
            schemas: list = [None] * len(tags)
            tables: list = [None] * len(tags)
            for i, tag in enumerate(tags):
                if tag is None or tag not in "IUDT" or errors[i] is not None:
                    continue
                found = states[code[i]] if code[i] >= 0 else UNRELATED
                if isinstance(found, str):
                    errors[i] = found
                    continue
                schemas[i], tables[i] = found.schema, found.table
                if tag != "T":
                    groups.setdefault((int(code[i]), tag), []).append(i)
            parts = [(pa.nulls(1, _IMAGE), pa.nulls(1, _IMAGE))]
            place, filled = np.zeros(len(tags), np.int64), 1
            for (state, tag), rows in groups.items():
                rows = np.array(rows)
                try:
                    columns, identity, error = _decode(states[state], tag, data, offsets[rows], offsets[rows + 1])
                except pa.ArrowInvalid:  # one value that is not UTF-8: find it alone
                    alone = [_alone(states[state], tag, data, offsets[r : r + 1], offsets[r + 1 : r + 2]) for r in rows]
                    columns, identity = (pa.concat_arrays([a[i] for a in alone]) for i in range(2))
                    error = np.concatenate([a[2] for a in alone])
                for r, why in zip(rows.tolist(), error):
                    errors[r] = why
                parts.append((columns, identity))
                place[rows] = np.where(error == None, filled + np.arange(len(rows)), 0)  # noqa: E711
                filled += len(rows)
            images = [pa.concat_arrays([p[i] for p in parts]).take(pa.array(place)) for i in range(2)]
            made = {
                "schema": pa.array(schemas, pa.string()), "table": pa.array(tables, pa.string()),
                "columns": images[0], "identity": images[1], "error": pa.array(errors, pa.string()),
            }
            yield pa.RecordBatch.from_arrays([made[c] if c in made else get(c) for c in names], names=names)

    return run


def _alone(relation: Relation, tag: str, data: np.ndarray, pos: np.ndarray, end: np.ndarray):
    try:
        return _decode(relation, tag, data, pos, end)
    except pa.ArrowInvalid:
        return pa.nulls(1, _IMAGE), pa.nulls(1, _IMAGE), np.array(["text that is not UTF-8"], object)


def decode_pgoutput(frames: DataFrame, found: asof.Intervals | None = None, on_error: str = "fail") -> DataFrame:
    """``pgoutput_frames`` in the shape of ``wal.decode_wal``, so that row events,
    progress and transactions follow alike; ``found`` are the ``relations``.

    A truncate of several tables gives a row for each. Values are text as the
    server prints them; a column sent as unchanged is left out of ``columns``;
    ``identity`` holds the old row, or the key columns where only they were sent
    or none were. Adds ``xid`` on begin, ``commit_lsn`` and ``commit_time`` on begin
    and commit. Relation, type and origin messages pass with a null action.
    """
    found = found or relations(relation_states(frames))
    related = asof.asof_join(_native(frames), found)
    names = [
        "source", "seq", "kind", "start_lsn", "end_lsn", "clock_us", "event_time", "must_reply", "timeline", "tag", "schema", "table",
        "columns", "identity", "transactional", "prefix", "content", "xid", "commit_lsn", "commit_time", "error",
    ]
    made = {"schema": T.StringType(), "table": T.StringType(), "columns": T.DataType.fromDDL(COLUMNS), "identity": T.DataType.fromDDL(COLUMNS)}
    schema = T.StructType([T.StructField(c, made[c]) if c in made else related.schema[c] for c in names])
    decoded = related.mapInArrow(_decoder(names), schema)
    action = F.when(F.col("tag").isin(*"BCIUDTM"), F.col("tag"))
    first = [c for c in names[: names.index("tag")]]
    rest = [c for c in names[names.index("tag") + 1 :] if c != "error"]
    return apply_on_error(
        decoded.select(*first, action.alias("action"), *rest, action_kind(action).alias("action_kind"), "error"), on_error
    )
