"""One row-event schema for both databases.

``source, seq, row_no, op, schema, table, columns, identity, cursor,
event_time``: ``columns`` is the after image (null for delete), ``identity``
the before image or key (null for insert). A column's ``value`` has at most
one member set. Decimals, dates and times travel as ISO text in ``str``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.bytes import utf8
from tidemark.functions.names import literal_map
from tidemark.functions.temporals import interval_from_text
from tidemark.operators.asof import BROADCAST_ROWS

ROW_EVENT = ["source", "seq", "row_no", "op", "schema", "table", "columns", "identity", "cursor", "event_time"]

# Row-event column type by PostgreSQL type name without its
# modifier and what follows it; the rest are strings.
PG_SINK_TYPES = {
    "smallint": "I64", "integer": "I64", "bigint": "I64", "oid": "I64",
    "real": "F64", "double precision": "F64",
    "numeric": "Decimal",
    "date": "Date",
    "time": "Time", "time without time zone": "Time", "time with time zone": "Time",
    "timestamp": "Timestamp", "timestamp without time zone": "Timestamp", "timestamp with time zone": "Timestamp",
    "json": "Json", "jsonb": "Json",
    "bytea": "Bytes",
}


def pg_sink_type(type_name: Column) -> Column:
    """Row-event column type of a PostgreSQL type name; arrays are strings."""
    base = F.when(~type_name.endswith("]"), F.substring_index(type_name, "(", 1))
    return F.coalesce(F.try_element_at(literal_map(PG_SINK_TYPES), base), F.lit("String"))


def _pg_columns(image: Column) -> Column:
    """Two passes, so that a column's type is looked up once, not per field."""

    def with_kind(c: Column) -> Column:
        return F.struct(c["name"].alias("name"), c["type"].alias("type"), c["value"].alias("value"),
                        pg_sink_type(c["type"]).alias("kind"))

    def column(c: Column) -> Column:
        kind = c["kind"]
        text = c["value"].cast("string")
        value = F.struct(
            F.lit(None).cast("decimal(20,0)").alias("u64"),
            F.when(kind == "I64", c["value"].cast("bigint")).alias("i64"),
            F.when(kind == "F64", c["value"].cast("double")).alias("f64"),
            F.when(~kind.isin("I64", "F64", "Bytes"), text).alias("str"),
            F.when(kind == "Bytes", _unhex(text)).alias("bytes"),
        )
        return F.struct(
            c["name"].alias("name"),
            F.lit(None).cast("boolean").alias("is_nullable"),  # not in the message
            kind.alias("column_type"),
            c["type"].alias("type_name"),
            value.alias("value"),
        )

    return F.transform(F.transform(image, with_kind), column)


def pg_text_value(cell: Column) -> Column:
    """A change's value (``type, value``) with everything but bytea as text."""
    text = cell["value"].cast("string")
    is_bytes = cell["type"] == "bytea"
    none = lambda kind: F.lit(None).cast(kind)
    return F.struct(
        none("decimal(20,0)").alias("u64"), none("bigint").alias("i64"), none("double").alias("f64"),
        F.when(~is_bytes, text).alias("str"), F.when(is_bytes, _unhex(text)).alias("bytes"),
    )


def _unhex(text: Column) -> Column:
    return F.unhex(F.regexp_replace(text, r"^\\x", ""))


def pg_event_rows(decoded: DataFrame) -> DataFrame:
    """Inserts, updates and deletes among decoded WAL messages; messages,
    truncates, transaction marks, keepalives and timeline rows give nothing."""
    return decoded.filter(F.col("action").isin("I", "U", "D")).select(
        "source", "seq", F.lit(0).alias("row_no"), F.col("action_kind").alias("op"), "schema", "table",
        "columns", "identity",
        F.struct(F.lit(None).cast("string").alias("file"), F.col("start_lsn").alias("pos")).alias("cursor"),
        "event_time",
    )


def pg_row_events(decoded: DataFrame) -> DataFrame:
    """Decoded WAL messages in the shared schema."""
    return pg_event_rows(decoded).withColumns({
        "columns": F.when(F.col("op") != "delete", _pg_columns(F.col("columns"))),
        "identity": F.when(F.col("op") != "insert", _pg_columns(F.col("identity"))),
    })


def with_cursor(rows: DataFrame) -> DataFrame:
    return rows.withColumn("cursor", F.struct(F.col("log_file").alias("file"), F.col("log_position").alias("pos")))


def mysql_row_events(rows: DataFrame) -> DataFrame:
    """Decoded binlog rows in the shared schema."""
    return with_cursor(rows).select(*ROW_EVENT)


def unify(*events: DataFrame) -> DataFrame:
    """Row events of several databases as one DataFrame."""
    return reduce(lambda a, b: a.unionByName(b), events)


def glob_to_regex(pattern: str) -> str:
    """``*`` and ``?`` as in file globs; all else literal."""
    import re

    return "^" + "".join({"*": ".*", "?": "."}.get(ch, re.escape(ch)) for ch in pattern) + "$"


def table_matches(schema: Column, table: Column, patterns: list[str]) -> Column:
    """True for tables named by ``schema.table`` patterns, which may be globs."""
    full = F.concat_ws(".", schema, table)
    exact = [p for p in patterns if not set(p) & set("*?")]
    globs = [p for p in patterns if set(p) & set("*?")]
    return reduce(lambda a, p: a | full.rlike(glob_to_regex(p)), globs, full.isin(exact))


def filter_tables(events: DataFrame, patterns: list[str]) -> DataFrame:
    return events.filter(table_matches(F.col("schema"), F.col("table"), patterns))


def _as_type(value: Column, to: T.DataType) -> Column:
    """The set member of a value as ``to``. Text that is no valid date, such as
    a zero date, gives null; a number that does not fit raises."""
    number = lambda name: F.coalesce(value["i64"].cast(name), value["u64"].cast(name), value["f64"].cast(name), value["str"].cast(name))
    name = to.simpleString()
    if isinstance(to, T.StringType):
        return F.coalesce(value["str"], utf8(value["bytes"]), value["i64"].cast(name),
                          value["u64"].cast(name), value["f64"].cast(name))
    if isinstance(to, T.BinaryType):
        return F.coalesce(value["bytes"], value["str"].cast("binary"))
    if isinstance(to, T.BooleanType):
        return F.coalesce(value["str"].cast("boolean"), value["i64"] != 0, value["u64"] != 0)
    if isinstance(to, T.VariantType):
        return F.try_parse_json(value["str"])
    if isinstance(to, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        # zero seconds are the zero date
        seconds = F.timestamp_seconds(F.nullif(value["u64"].cast("bigint"), F.lit(0)))
        return F.coalesce(value["str"].try_cast(name), seconds.cast(name))
    if isinstance(to, T.DayTimeIntervalType):
        return interval_from_text(value["str"])
    if isinstance(to, T.DecimalType):
        return F.coalesce(value["str"].cast(name), value["u64"].cast(name), value["i64"].cast(name), value["f64"].cast(name))
    return number(name)


def typed_view(events: DataFrame, table: str, ddl: str, image: str = "columns") -> DataFrame:
    """One table's events with flat typed columns, read by name.

    ``table`` is ``schema.table``; ``ddl`` names the wanted columns and types.
    Columns an event does not carry are null.
    """
    wanted = T.StructType.fromDDL(ddl)
    mine = filter_tables(events, [table]).filter(F.col(image).isNotNull())
    by_name = F.map_from_entries(
        F.transform(image, lambda c: F.struct(c["name"].alias("key"), c["value"].alias("value")))
    )
    # Each step is a projection of its own: a value is looked up once, however
    # many members its cast tries.
    values = mine.withColumn("_by_name", by_name).select(
        *_VIEW_KEYS, *[F.try_element_at("_by_name", F.lit(f.name)).alias(f"_{i}") for i, f in enumerate(wanted.fields)]
    )
    return typed_columns(values, wanted)


_VIEW_KEYS = ["source", "seq", "row_no", "op", "cursor", "event_time"]


def typed_columns(values: DataFrame, wanted: T.StructType) -> DataFrame:
    """Values ``_0, _1, ...`` cast to the wanted types under their names."""
    casts = [_as_type(F.col(f"_{i}"), f.dataType).alias(f.name) for i, f in enumerate(wanted.fields)]
    return values.select(*_VIEW_KEYS, *casts)


def _value_text(value: Column) -> Column:
    return F.coalesce(
        value["str"], value["i64"].cast("string"), value["u64"].cast("string"), value["f64"].cast("string"), F.hex(value["bytes"])
    )


def kafka_payload(events: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """``key`` and ``value`` as a Kafka sink takes them; the value is the whole
    row event as JSON.

    ``keys`` (``schema, table, key_columns``, one row per table, see
    ``tablemap.primary_keys``) puts the row's key values into the key, so that a
    hot table spreads over partitions and one row's events stay in order. An update
    that changes the key gives two records: a null value, a tombstone, under the
    old key and the event under the new one, where later events of the row go too.
    Tables without a key go by their name.
    """
    key = ["schema", "table"]
    if keys is None:
        return events.select(F.to_json(F.struct(*key)).alias("key"), F.to_json(F.struct(*ROW_EVENT)).alias("value"))
    small = keys.select(*key, "key_columns").limit(BROADCAST_ROWS + 1)
    hint = F.broadcast if small.count() <= BROADCAST_ROWS else lambda df: df
    of = lambda image: lambda name: _value_text(F.get(F.filter(image, lambda c: c["name"] == name), F.lit(0))["value"])
    sent = lambda image, name: F.exists(image, lambda c: c["name"] == name)
    before = F.coalesce("identity", "columns")
    named = events.join(hint(keys.select(*key, "key_columns")), key, "left")
    # a key column that the new image leaves out keeps its value
    new = lambda name: F.when(sent(F.col("columns"), name), of(F.col("columns"))(name)).otherwise(of(before)(name))
    with_keys = named.withColumn("_old", F.transform("key_columns", of(before))).withColumn(
        "_new", F.when(F.col("op") == "update", F.transform("key_columns", new)).otherwise(F.col("_old"))
    )
    record = lambda key_values, value: F.struct(F.to_json(F.struct(*key, key_values.alias("key"))).alias("key"), value.alias("value"))
    event = record(F.col("_new"), F.to_json(F.struct(*ROW_EVENT)))
    tombstone = record(F.col("_old"), F.lit(None).cast("string"))
    moved = F.col("key_columns").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))
    return with_keys.select(F.inline(F.when(moved, F.array(tombstone, event)).otherwise(F.array(event))))
