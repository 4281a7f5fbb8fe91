"""Exact ranks over a whole table, without a window that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataloom.operators.joins import small_enough
from strataloom.session import materialise

# Different values one task is meant to sort.
VALUES_PER_SLICE = 1_000_000


def ranks(df: DataFrame, order: Sequence[str], descending: bool = False, rank: str | None = "rank",
          dense: str | None = "dense_rank", percent: str | None = "percent_rank",
          values_per_slice: int = VALUES_PER_SLICE) -> DataFrame:
    """Adds ``rank``, ``dense_rank`` and ``percent_rank`` of each row by the columns ``order``.

    Pass None for a name that is not wanted.  Nulls are lowest and tie with each other, as
    NaN is highest and ties with NaN; a table of one row has percent rank 0.

    Rows that tie share all three ranks, so only the different values are put in order, each
    with its number of rows: a value that a third of the rows hold is one row before any
    shuffle.  The values are dealt to slices by range; the slices' totals give what comes
    before each, and the ranks are joined back on the values.
    """
    wanted = [n for n in (rank, dense, percent) if n]
    if clash := {n.lower() for n in wanted} & {c.lower() for c in df.columns}:
        raise ValueError(f"the rows have the columns {sorted(clash)} already")
    names = [f"_by{i}" for i in range(len(order))]
    way = [F.desc(n) if descending else F.asc(n) for n in names]
    values = df.groupBy(*[F.col(c).alias(n) for c, n in zip(order, names, strict=True)]).agg(F.count("*").alias("_rows"))
    values = materialise(values, "ranked-values")
    slices = values.count() // values_per_slice + 1
    # Stored, so that a task that runs again finds each value in the slice it was in.
    dealt = materialise(values.repartitionByRange(slices, *way).withColumn("_slice", F.spark_partition_id()), "ranked-slices")
    totals = dealt.groupBy("_slice").agg(F.sum("_rows").alias("_sum"), F.count("*").alias("_n"))
    # One row for each slice: a million values to each row of this window.
    below = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_sum").over(Window.partitionBy())
    starts = materialise(totals.select("_slice", F.coalesce(F.sum("_sum").over(below), F.lit(0)).alias("_rows_before"),
                                       F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_values_before"), total.alias("_total")), "ranked-starts")
    few = F.broadcast(starts) if small_enough(starts) else starts

    inside = Window.partitionBy("_slice").orderBy(*way)
    before = F.coalesce(F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.withColumns({"_before": before, "_at": F.row_number().over(inside)}).join(few, "_slice")
    at = F.col("_rows_before") + F.col("_before") + 1
    made: dict[str | None, Column] = {
        rank: at, dense: F.col("_values_before") + F.col("_at"),
        percent: F.when(F.col("_total") > 1, (at - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0)),
    }
    placed = placed.select(*names, *[c.alias(n) for n, c in made.items() if n])
    match = [df[c].eqNullSafe(placed[n]) for c, n in zip(order, names, strict=True)]
    return df.join(placed, match).drop(*names)
