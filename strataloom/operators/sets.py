"""Top k, union of sources, difference of layers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def top_k(df: DataFrame, measure: str, id: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest ``measure``; ``id`` breaks ties."""
    return df.orderBy(F.col(measure).desc(), F.col(id).asc()).limit(k)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Append sources that share one schema, by column name."""
    return reduce(DataFrame.unionByName, frames)


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other, with side and surplus.

    Both sides are counted against each other in one aggregation, which costs one
    shuffle where two ``exceptAll`` would cost four.
    """
    cols = left.columns
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    net = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, F.lit("left")).otherwise(F.lit("right"))
    return net.select(*cols, side.alias("side"), F.abs("_n").alias("copies"))
