"""Comparing rows by several columns at once, without sorting them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def sort_tuple(df: DataFrame, order: Sequence[str]) -> Column:
    """``order`` as one comparable struct: ascending, nulls lowest.

    Dates and times become whole numbers, so that a value read by the driver and
    put back as a literal is exactly the same value.
    """
    fields = []
    for i, name in enumerate(order):
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            c = micros(c)
        elif isinstance(kind, T.DateType):
            c = F.unix_date(c)
        fields.append(c.alias(f"o{i}"))
    return F.struct(*fields)


def micros(c: Column) -> Column:
    """Microseconds since 1970; one without a zone is read in the session's, which is UTC."""
    return F.unix_micros(c.cast("timestamp"))


def literal_tuple(row: Sequence, kind: T.StructType) -> Column:
    return F.struct(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind.fields, strict=True)]
    )


def constant(value, kind: T.DataType) -> Column:
    """A large constant as one short expression, which the optimiser evaluates once."""
    text = json.dumps({"v": value}, default=str)
    return F.from_json(F.lit(text), T.StructType([T.StructField("v", kind)]))["v"]


# Up to so many cuts a tree of comparisons is compiled, which is many times faster
# than searching an array; beyond, it would not fit into one compiled method.
COMPILED_CUTS = 64


def among(cuts: Sequence[Sequence], kind: T.StructType, value: Column) -> Column:
    """How many of the sorted tuples ``cuts`` lie below ``value``, in ``log2(len(cuts))`` steps."""
    if len(cuts) > COMPILED_CUTS:
        entries = [{"at": dict(zip(kind.names, c, strict=True))} for c in cuts]
        kind = T.ArrayType(T.StructType([T.StructField("at", kind)]))
        return place_in(constant(entries, kind), "at", value, len(cuts))

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        above = between(middle + 1, high)
        return F.when(value > literal_tuple(cuts[middle], kind), above).otherwise(between(low, middle))

    return between(0, len(cuts))


def place_in(bounds: Column, field: str, value: Column, largest: int) -> Column:
    """How many entries of the sorted array ``bounds`` have a ``field`` below ``value``.

    For bounds that differ by row: a binary search in ``log2(largest)`` steps,
    where ``largest`` is an upper bound for the length of the array.
    """
    steps = [1 << k for k in reversed(range(max(1, int(largest).bit_length())))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(bounds)) & (value > F.get(bounds, at + step - 1)[field]), at + step
        ).otherwise(at),
    )
