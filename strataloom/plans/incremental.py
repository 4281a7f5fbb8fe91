"""Incremental loads and the automatic update of marts.

A mart is a folder of parquet files partitioned by a period column of text, such
as ``2024-05``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from strataloom.functions.values import as_type_of
from strataloom.operators.dedup import dedup_latest
from strataloom.session import delete, materialise
from strataloom.sources.lake import clustered


def read_increment(df: DataFrame, cursor_col: str, last) -> DataFrame:
    """Rows past the stored cursor.

    A row that arrives late under an older value is missed, so a load time makes
    a better cursor than a business time.
    """
    return df.where(F.col(cursor_col) > as_type_of(df, cursor_col, last))


def rebuild_period(df: DataFrame, path: str, part: str, sort_cols: Sequence[str] = ()) -> None:
    """Replace the periods that occur in ``df``; all other periods stay as they are."""
    (
        clustered(df, [part], sort_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(path)
    )


def drop_periods(spark: SparkSession, path: str, part: str, periods: Iterable[str | None]) -> None:
    """Delete whole periods, as far as they exist.  An overwrite cannot: it only replaces what has rows."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for period in periods:
        delete(spark, f"{path}/{names.getPartitionPathString(part, period)}")


def refresh_mart(path: str, facts: DataFrame, changed: Sequence[DataFrame], part: str,
                 build: Callable[[DataFrame], DataFrame]) -> None:
    """Recompute the mart at ``path`` for the periods of the ``changed`` rows only.

    ``facts`` and each frame of ``changed`` carry the period column ``part``, and
    ``build`` keeps it.  Pass changed rows as they were *and* as they are: a row
    that moved to another period touches both.  Null is a period of its own; empty
    text counts as null, as a folder cannot tell them apart.  A period without rows
    in the new result is deleted.  Until then a reader sees its old rows beside the
    new ones of other periods: each period changes as a whole, all of them do not
    change at once.
    """
    spark = facts.sparkSession
    period = F.nullif(F.col(part), F.lit(""))
    periods = changed[0].select(part)
    for more in changed[1:]:
        periods = periods.unionByName(more.select(part))
    periods = materialise(periods.select(period.alias(part)).distinct(), "touched-periods")
    low, high, null = periods.agg(F.min(part), F.max(part), F.count_if(F.col(part).isNull())).first()
    if low is None and not null:
        return
    # The join is on the folders' own column, so the periods found prune the folders of the
    # facts; what has no period is read apart.
    of = periods.where(F.col(part).between(low, high)).select(F.col(part).alias("_period"))
    hit = facts.join(of, F.col(part) == F.col("_period"), "left_semi")
    if null:
        hit = hit.unionByName(facts.where(F.col(part).isNull() | (F.col(part) == "")))
    built = materialise(build(hit), "built-periods")
    built = built.withColumn(part, period)
    rebuild_period(built, path, part)
    there = built.select(F.col(part).alias("_period")).distinct()
    gone = periods.join(there, F.col(part).eqNullSafe(F.col("_period")), "left_anti")
    drop_periods(spark, path, part, (r[0] for r in gone.toLocalIterator()))


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``current`` with the newest version of each changed key; ``changes`` win ties.

    ``current`` has one row per key, and is shuffled once.  Write the result to a new
    path: the current one is still being read.
    """
    both = current.withColumn("_newer", F.lit(0)).unionByName(changes.withColumn("_newer", F.lit(1)))
    return dedup_latest(both, keys, [*order, "_newer"]).drop("_newer")


def _journal(source: str, cursor: str) -> list[Column]:
    return [
        F.count("*").alias("rows"), F.min(cursor).alias("lowest"), F.max(cursor).alias("highest"),
    ]


def journal(df: DataFrame, source: str, load: str, cursor: str) -> DataFrame:
    """One line per load: source, rows, lowest and highest cursor."""
    lines = df.groupBy(load).agg(*_journal(source, cursor))
    return lines.select(F.lit(source).alias("source"), F.col(load).alias("load"), "rows", "lowest", "highest")


def observed(df: DataFrame, source: str, cursor: str) -> tuple[DataFrame, Observation]:
    """``df`` with an observation that holds its journal line once ``df`` was written.

    The line comes from the write itself, without another pass.
    """
    line = Observation(f"load of {source}")
    return df.observe(line, *_journal(source, cursor)), line
