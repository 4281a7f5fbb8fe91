"""Row filters that reach the file scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from strataloom.functions.values import as_type_of


def filter_status(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose ``col`` is one of ``values``."""
    return df.where(F.col(col).isin(*values))


def active(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows whose ``col`` lies in ``[start, end)``."""
    return df.where(
        (F.col(col) >= as_type_of(df, col, start)) & (F.col(col) < as_type_of(df, col, end))
    )
