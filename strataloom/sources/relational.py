"""Tables of a relational database.

Thin adapters: no JDBC driver and no database was at hand, so they have not been
run against one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, part_col: str, lo, hi, n: int,
              properties: dict[str, str] | None = None) -> DataFrame:
    """Read ``table`` in ``n`` parallel ranges of ``part_col`` between ``lo`` and ``hi``.

    Rows outside the bounds and nulls are read too, by the outermost ranges.
    """
    return spark.read.jdbc(
        url, table, column=part_col, lowerBound=lo, upperBound=hi, numPartitions=n,
        properties=properties or {},
    )


def jdbc_batch(url: str, table: str, n: int, properties: dict[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """A writer of micro-batches that appends to ``table`` over at most ``n`` connections.

    Each row carries its ``batch_id``; a replayed batch repeats its rows under the
    same number, which is how the reader of the table tells them.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        numbered = df.withColumn("batch_id", F.lit(batch_id))
        numbered.write.option("numPartitions", n).jdbc(url, table, mode="append", properties=properties or {})

    return write
