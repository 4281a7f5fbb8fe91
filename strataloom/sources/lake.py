"""Files of the lake, and the columnar store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

# The file formats a lake folder may hold.
FORMATS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None) -> DataFrame:
    """Table ``name`` of the lake folder ``root``, on any file system Spark can reach.

    Parquet and ORC carry their schema; json and csv need one, so that no pass
    over the data is spent on guessing it.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    if fmt in ("json", "csv") and schema is None:
        raise ValueError(f"a {fmt} table needs a schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return reader.load(f"{root.rstrip('/')}/{name}.{fmt}")


def clustered(df: DataFrame, part_cols: Sequence[str], sort_cols: Sequence[str] = ()) -> DataFrame:
    """Rows brought together by partition value, for few and sorted files.

    ``rebalance`` lets adaptive execution split a value that holds far more rows
    than the others over several tasks and join small ones.
    """
    return df.hint("rebalance", *part_cols).sortWithinPartitions(*part_cols, *sort_cols)


def load_columnar(df: DataFrame, path: str, part_cols: Sequence[str], sort_cols: Sequence[str] = (),
                  mode: str = "error") -> DataFrame:
    """Write ``df`` to the columnar store, partitioned and sorted, and return the stored table."""
    clustered(df, part_cols, sort_cols).write.mode(mode).partitionBy(*part_cols).parquet(path)
    return read_columnar(df.sparkSession, path, df.schema)


def read_columnar(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table under its declared schema, so partition values keep their type."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
