"""MySQL packed date and time integers as Spark values.

``parts`` functions keep every component, so a zero or partial date loses
nothing; the typed functions give null where the calendar has no such day.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _div(value: Column, by: int) -> Column:
    return (value - value % by).cast("bigint") / by


def _digits(value: Column, skip: int, take: int) -> Column:
    return (_div(value, skip).cast("bigint") % take).cast("int")


def date_parts(packed: Column) -> Column:
    """DATE: five bits of day, four of month, the rest year."""
    return F.struct(
        F.shiftright(packed, 9).cast("int").alias("year"),
        F.shiftright(packed, 5).bitwiseAND(F.lit(15)).cast("int").alias("month"),
        packed.bitwiseAND(F.lit(31)).cast("int").alias("day"),
    )


def datetime_parts(packed: Column) -> Column:
    """DATETIME before fractional seconds: decimal digits YYYYMMDDhhmmss."""
    return F.struct(
        _digits(packed, 10_000_000_000, 10_000).alias("year"),
        _digits(packed, 100_000_000, 100).alias("month"),
        _digits(packed, 1_000_000, 100).alias("day"),
        _digits(packed, 10_000, 100).alias("hour"),
        _digits(packed, 100, 100).alias("minute"),
        _digits(packed, 1, 100).alias("second"),
    )


def time_parts(packed: Column) -> Column:
    """TIME before fractional seconds: decimal digits hhhmmss, signed."""
    size = F.abs(packed)
    return F.struct(
        (packed < 0).alias("negative"),
        _digits(size, 10_000, 1_000).alias("hours"),
        _digits(size, 100, 100).alias("minutes"),
        _digits(size, 1, 100).alias("seconds"),
    )


def to_date(packed: Column) -> Column:
    p = date_parts(packed)
    text = F.format_string("%04d-%02d-%02d", p["year"], p["month"], p["day"])
    return text.try_cast("date")


def to_datetime(packed: Column) -> Column:
    p = datetime_parts(packed)
    text = F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d",
        p["year"], p["month"], p["day"], p["hour"], p["minute"], p["second"],
    )
    return text.try_cast("timestamp_ntz")


def to_interval(packed: Column) -> Column:
    p = time_parts(packed)
    size = F.make_dt_interval(
        F.lit(0), p["hours"], p["minutes"], p["seconds"].cast("decimal(18,6)")
    )
    return F.when(p["negative"], -size).otherwise(size)


def to_year(byte: Column) -> Column:
    """YEAR: offset from 1900, where 0 stands for the year 0000."""
    return F.when(byte == 0, 0).otherwise(byte + 1900)


def to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def interval_from_text(text: Column) -> Column:
    """``[-]hhh:mm:ss[.ffffff]`` as an interval."""
    part = lambda n: F.regexp_extract(text, r"^-?(\d+):(\d+):(\d+(?:\.\d+)?)$", n)
    size = F.make_dt_interval(
        F.lit(0), part(1).cast("int"), part(2).cast("int"), part(3).cast("decimal(18,6)")
    )
    return F.when(text.startswith("-"), -size).otherwise(size)
