"""Distinct counts that can be put together: one sketch per period, any range of periods.

A sketch is a few kilobytes however many values it has seen.  Stored by period, the
sketches of a range are merged without reading the facts again, and a refresh of one
period replaces one sketch (``incremental.refresh_mart`` with ``sketch_per`` as its build).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.functions.values import as_type_of

SKETCH = "sketch"
# Buckets of a sketch as a power of two; 4,096 of them have a standard error of 1.3 %.
LG_BUCKETS = 12
_PLAIN = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def relative_error(lg_buckets: int = LG_BUCKETS, deviations: float = 3.0) -> float:
    """How far an estimate may be off as a share of the count, at so many standard deviations."""
    return deviations * 0.836 / 2 ** (lg_buckets / 2)


def sketch_per(df: DataFrame, keys: Sequence[str], col: str, lg_buckets: int = LG_BUCKETS, name: str = SKETCH) -> DataFrame:
    """One sketch of the different non-null values of ``col`` per ``keys``.

    Sketches are built on the map side, so a hot key costs one sketch a task.  A key whose
    values are all null has an empty sketch, which estimates 0.
    """
    value = F.col(col) if isinstance(df.schema[col].dataType, _PLAIN) else F.col(col).cast("string")
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_buckets).alias(name))


def merged(sketches: DataFrame, keys: Sequence[str] = (), name: str = SKETCH) -> DataFrame:
    """The sketches put together per ``keys``; a value seen by several counts once."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))


def estimate(name: str = SKETCH) -> Column:
    """The number of different values a sketch has seen."""
    return F.hll_sketch_estimate(name)


def over_range(sketches: DataFrame, period: str, low, high, keys: Sequence[str] = (), name: str = SKETCH) -> DataFrame:
    """The sketch of all periods from ``low`` to ``high``, both included, per ``keys``.

    The bounds are literals of the period column's type, so they prune its folders.
    """
    bounds = [as_type_of(sketches, period, b) for b in (low, high)]
    return merged(sketches.where(F.col(period).between(*bounds)), keys, name)


def trailing(sketches: DataFrame, period: str, n: int, keys: Sequence[str] = (), name: str = SKETCH) -> DataFrame:
    """For each row: the sketch of its period and the ``n - 1`` before it, per ``keys``.

    ``period`` is a number that rises by one from period to period, such as a day since
    some day; periods without a row count for nothing and get no row.  A sketch is copied
    to each period it counts for, ``n`` small rows for one.
    """
    if n < 1:
        raise ValueError("a period counts for itself at least")
    kind = sketches.schema[period].dataType
    after = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_after")
    copies = sketches.where(F.col(period).isNotNull()).select(*keys, period, name, after)
    met = copies.groupBy(*keys, (F.col(period) + F.col("_after")).cast(kind).alias(period)).agg(
        F.hll_union_agg(name).alias(name), F.min("_after").alias("_nearest"))
    return met.where("_nearest = 0").drop("_nearest")
