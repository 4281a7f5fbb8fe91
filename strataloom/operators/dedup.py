"""Deduplication in batch.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle:
each map task sends at most one row per key, so a key that holds a third of all
rows costs the reduce task one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "_strataloom_rank"


def _first(df: DataFrame, part: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def dedup_exact(df: DataFrame, cols: Sequence[str], id: str) -> DataFrame:
    """One row of those that agree on ``cols``: the one with the smallest ``id``."""
    part = [F.col(c) for c in cols]
    if any(isinstance(df.schema[c].dataType, T.StringType) for c in cols):
        # Sorted by a short hash first, long texts are compared only where it agrees.
        part.insert(0, F.xxhash64(*cols))
    return _first(df, part, [F.col(id).asc()])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key.

    ``order`` is compared column by column, the largest wins.  It must not tie
    within a key, or the kept row is arbitrary.
    """
    return _first(df, [F.col(k) for k in keys], [F.col(c).desc() for c in order])
