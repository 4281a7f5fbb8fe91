"""Joins.

No side is marked for broadcast unless it has been measured.  Everything else is
a plain equi-join: Catalyst and adaptive execution broadcast a side below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffle both, splitting
the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.session import listed_bytes

# Largest lookup table that is sent whole to every executor.
LOOKUP_ROWS = 1_000_000
LOOKUP_BYTES = 64 * 1024 * 1024


def join_dims(fact: DataFrame, dims: Iterable[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner join of ``fact`` with each ``(dimension, fact column, dimension column)``.

    The dimension columns must be unique keys.
    """
    for dim, fact_key, dim_key in dims:
        fact = _equi(fact, dim, fact_key, dim_key, "inner")
    return fact


def _equi(left: DataFrame, right: DataFrame, lkey: str, rkey: str, how: str) -> DataFrame:
    if lkey == rkey:
        return left.join(right, lkey, how)
    return left.join(right, left[lkey] == right[rkey], how)


def _width(field: T.StructField) -> Column:
    # Bytes a value takes once it is sent: 16 for the fixed part of any column.
    c = F.col(field.name)
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, T.AtomicType):
        return F.lit(16)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16


def small_enough(df: DataFrame, rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> bool:
    """True if ``df`` may be broadcast, measured in one distributed pass.

    Not measured is what the optimiser knows to be too large from the listing of files.
    """
    if listed_bytes(df) > size:
        return False
    total = sum((_width(f) for f in df.schema.fields), F.lit(0)).cast("bigint")
    n, nbytes = df.agg(F.count("*"), F.coalesce(F.sum(total), F.lit(0))).first()
    return n <= rows and nbytes <= size


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, how: str = "inner",
           rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> DataFrame:
    """Enrich ``df`` from a lookup table, sent to every executor if it is small.

    A table beyond ``rows`` or ``size`` is joined by shuffling instead.
    """
    if small_enough(dim, rows, size):
        dim = F.broadcast(dim)
    return _equi(df, dim, key, dim_key or key, how)


def touched(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, which may hold a key many times."""
    # Distinct uses the shuffle the join needs anyway, and a hot key becomes one row.
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``df`` without a partner in ``other``; ``keys`` pairs the columns.

    A row whose own key is null has no partner.
    """
    known = other.select(*[F.col(right).alias(f"_known{i}") for i, (_, right) in enumerate(keys)]).distinct()
    match = [df[left] == known[f"_known{i}"] for i, (left, _) in enumerate(keys)]
    return df.join(known, match, "left_anti")
