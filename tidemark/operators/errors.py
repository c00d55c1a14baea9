"""What happens to bad input: stop, set aside, or keep it marked."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def apply_on_error(df: DataFrame, on_error: str, column: str = "error") -> DataFrame:
    """``fail`` raises on the first bad row, ``skip`` drops bad rows from the
    result (take them from ``quarantine``), ``keep`` leaves them marked."""
    if on_error == "keep":
        return df
    if on_error == "skip":
        return df.filter(F.col(column).isNull()).drop(column)
    if on_error == "fail":
        checked = F.when(F.col(column).isNull(), F.lit(True)).otherwise(F.raise_error(F.col(column)))
        return df.filter(checked.cast("boolean")).drop(column)
    raise ValueError(f"on_error must be fail, skip or keep, not {on_error!r}")


def quarantine(df: DataFrame, column: str = "error") -> DataFrame:
    """The rows a ``skip`` run leaves out."""
    return df.filter(F.col(column).isNotNull())
