"""Links between similar rows: candidates as a forest, exact counts, components.

A search emits for each small bucket of similar rows a spanning forest, not its
pairs.  The forest's components are cut into blocks, every pair of blocks of a
component is compared exactly in one task, and only counts and again a forest leave
the task.  So a dense group of m rows costs m * m comparisons and m * m / BLOCK
rows, whatever its size, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.session import materialise

BLOCK = 512


def grouped(df: DataFrame, key: str, schema: T.StructType | str, work: Callable[[pa.Table, list[tuple[int, int]]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Runs ``work`` over groups of rows with the same ``key``.

    ``work`` gets a table and the stretches of its rows that are whole groups, many
    small ones at once.  Groups must be of bounded size.
    """

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            keys = batch.column(batch.schema.get_field_index(key))
            if batch.num_rows == 0 or (len(held) > 1 and keys[0] == keys[-1] and held[0].column(held[0].schema.get_field_index(key))[-1] == keys[0]):
                continue  # the group goes on
            table = pa.Table.from_batches(held).combine_chunks()
            cuts = boundaries(table.column(key).combine_chunks())
            if len(cuts) > 2:
                yield from work(table, list(zip(cuts[:-2], cuts[1:-1])))
            held = table.slice(cuts[-2]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            cuts = boundaries(table.column(key).combine_chunks())
            yield from work(table, list(zip(cuts[:-1], cuts[1:])))

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def boundaries(keys) -> list[int]:
    keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    if not len(keys):
        return [0]
    differ = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(differ) + 1).tolist(), len(keys)]


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row of its component."""
    root = np.arange(len(linked))
    joined = linked.sum(axis=0) > linked.diagonal()  # the others are alone
    root[joined] = -1
    for i in np.flatnonzero(joined).tolist():
        if root[i] >= 0:
            continue
        root[i] = i
        front = np.array([i])
        while len(front):
            reached = linked[front].any(axis=0) & (root < 0)
            root[reached] = i
            front = np.flatnonzero(reached)
    return root


def in_block_pairs(df: DataFrame, group: list[str], member: Column, size: Column, block: int = BLOCK) -> DataFrame:
    """Repeats each row for every pair of blocks of its group that it is part of.

    A group of ``size`` rows has about ``size / block`` blocks, dealt by the hash of
    ``member``.  New columns: ``pair`` (binary, names the pair of blocks) and
    ``left`` and ``right`` (the row is in the pair's first or second block; both in
    a pair of a block with itself).
    """
    blocks = F.ceil(size / F.lit(block)).cast("int")
    cut = df.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64(member, F.lit(7)), F.col("_blocks")).cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    names = [F.hex(g) for g in group]
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return (
        cut.withColumn("pair", F.unhex(F.md5(F.concat_ws("/", *names, low.cast("string"), high.cast("string")))))
        .withColumn("left", F.col("_own") == low).withColumn("right", F.col("_own") == high)
        .drop("_blocks", "_own", "_other")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of edges (a, b); the root is the least node.

    Large and small stars in turn: every node's neighbours are joined to the least
    node it knows of, until nodes know one lesser node only, and that one none.  Only
    minima are gathered, and each round is a stored table.
    """
    cut = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = cut.unionAll(cut.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "edges")
        down = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(down, F.col("a") == F.col("n")).select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        cut = materialise(small, "edges")
        ends = F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("up")), F.struct(F.col("b").alias("n"), F.lit(0).alias("up"))))
        known = cut.select(ends.alias("e")).groupBy("e.n").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("low"))
        # Edges lead to lesser nodes: once all are stars, their centres are the roots.
        if not known.agg(F.count_if((F.col("up") > 1) | (F.col("up") > 0) & (F.col("low") == 0))).first()[0]:
            return cut.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(cut.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
