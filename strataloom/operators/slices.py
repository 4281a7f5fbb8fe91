"""Cutting the rows of hot keys into slices, for windows that need a key's rows in order.

``Window.partitionBy(key)`` sends all rows of a key to one task.  A key far above
the rows one task should sort is cut along the window's order instead: a sample
gives the cut points, they are stored once, and from then on the slice of a row
depends on nothing but its own values.  A window over ``(key, slice)`` is then
right inside each slice, and one value per slice carries the rest across.
Any cut points give the same result; the sample only decides how even the slices
are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from strataloom.functions.ordering import place_in, sort_tuple
from strataloom.operators.joins import small_enough
from strataloom.session import materialise

SLICE = "_strataloom_slice"
CARRIED = "_strataloom_carried"

# Rows one task is meant to sort.
ROWS_PER_SLICE = 10_000_000
# Sampled rows per slice; more makes the slices more even.
SAMPLE_PER_SLICE = 20


@dataclass(frozen=True)
class Sliced:
    """``rows`` with a slice number; ``hot`` tells whether any key was cut."""

    rows: DataFrame
    hot: bool


def slice_hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   rows_per_slice: int = ROWS_PER_SLICE, like: DataFrame | None = None,
                   carry: Sequence[str] = ()) -> Sliced:
    """Number the slices of hot keys, from 0 up along ``order``; other keys get -1.

    Cut points are rows of the table, each the last of its slice.  Their columns
    ``carry`` are attached to the rows of the slice behind, as the struct ``CARRIED``.

    Hot keys and cut points are looked for in ``like``, by default ``df`` itself;
    a part of its rows that is cheaper to read will do.
    """
    like = df if like is None else like
    n = like.count()
    whole = Sliced(df.withColumn(SLICE, F.lit(-1)), False)
    if n <= rows_per_slice:
        return whole

    # The sample holds a fixed share of the rows, and only what they are ordered by.
    fraction = min(1.0, SAMPLE_PER_SLICE / rows_per_slice)
    every = max(1, round(rows_per_slice * fraction))
    sampled = (
        like.select(*keys, F.struct(sort_tuple(like, order).alias("at")).alias("cut"))
        .sample(fraction=fraction, seed=17)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
        .where(F.size("cuts") > 2 * every)
    )
    cuts = F.transform(
        F.sequence(F.lit(every), F.size("cuts") - 1, F.lit(every)), lambda i: F.get("cuts", i)
    )
    bounds = materialise(
        sampled.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                       F.array_distinct(cuts).alias("_cuts")),
        "slice-bounds",
    )
    longest = bounds.agg(F.max(F.size("_cuts"))).first()[0]
    if longest is None:
        return whole

    placed = df.withColumn("_at", sort_tuple(df, order))
    match = [placed[k].eqNullSafe(bounds[f"_key{i}"]) for i, k in enumerate(keys)]
    at = F.when(F.col("_cuts").isNull(), -1).otherwise(place_in(F.col("_cuts"), "at", F.col("_at"), longest))
    # Hot keys and their cut points are few: one for each ``rows_per_slice`` rows.
    # Sent to all tasks where that is proven small; else their own join splits hot keys.
    few = F.broadcast(bounds) if small_enough(bounds) else bounds
    rows = placed.join(few, match, "left").withColumn(SLICE, at)
    made = [f"_key{i}" for i in range(len(keys))]
    if not carry:
        return Sliced(rows.drop("_at", "_cuts", *made), True)
    # The columns carried over are looked up afterwards, one row for each slice.
    ends = rows.where(F.col(SLICE) >= 0).where(F.get("_cuts", F.col(SLICE))["at"] == F.col("_at"))
    ends = ends.groupBy(*[F.col(k).alias(a) for k, a in zip(keys, made, strict=True)], (F.col(SLICE) + 1).alias("_next")).agg(
        F.first(F.struct(*carry)).alias(CARRIED))
    ends = materialise(ends, "slice-ends")
    rows = rows.drop("_at", "_cuts", *made)
    match = [rows[k].eqNullSafe(ends[a]) for k, a in zip(keys, made, strict=True)] + [rows[SLICE] == ends["_next"]]
    ends = F.broadcast(ends) if small_enough(ends) else ends
    return Sliced(rows.join(ends, match, "left").drop("_next", *made), True)
