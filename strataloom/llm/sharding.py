"""Shards of equal size that keep equal texts together: balanced label propagation.

Documents with equal texts are linked.  Each starts with a label (shard) dealt in
turn; in each round a link's neighbours pull: the copies of a text that lie in one
shard move to the shard where most other copies lie.  A shard may be overfilled by
that; what is beyond its quota goes on to shards with room, smallest groups first
and whole ones as far as they fit.  So full shards exchange.  The quota of a shard is
its share of all rows; documents without links fill what the linked ones leave.

Copies are interchangeable, so a round works on *blocks* (text, shard, number of
copies): at most one row for each shard and text, however frequent a text is.
Ranks and running sums are taken in hashed buckets of bounded size whose totals are
summed first, so no group of copies gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataloom.session import materialise

SHARDS = 24
ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 256


def buckets_for(rows: int) -> int:
    return LEAST_BUCKETS + rows // ROWS_PER_BUCKET


def running_total(df: DataFrame, group: list[str], order: list[str], value: Column, buckets: int, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before it in its group.

    Rows of a group are in order of a bucket hashed from ``order``, then of
    ``order``.  The totals of the buckets are summed up first (``buckets`` rows a
    group); the rest is one window for each bucket.
    """
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets))).withColumn("_value", value)
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(totals, keys)
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_value", "_before", "_inside")
    )


def at(values: list[int], place: Column) -> Column:
    """The value of a short list at a place (from 0)."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), place.cast("int") + 1)


def loads_of(blocks: DataFrame, shards: int) -> list[int]:
    loads = [0] * shards
    for r in blocks.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        loads[r["shard"]] = r["n"]
    return loads


def together(blocks: DataFrame) -> int:
    """Ordered pairs of linked documents in one shard, each with itself included."""
    return int(blocks.agg(F.sum(F.col("n").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)"))).first()[0] or 0)


def merged(blocks: DataFrame, moves: DataFrame) -> DataFrame:
    """The blocks after moves (key, shard, to, moved)."""
    changes = moves.select("key", "shard", (-F.col("moved")).alias("n")).unionAll(moves.select("key", F.col("to").alias("shard"), F.col("moved").alias("n")))
    return materialise(blocks.unionByName(changes).groupBy("key", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shard-blocks")


def push_out(blocks: DataFrame, quotas: list[int], buckets: int) -> DataFrame:
    """Moves what is beyond the quotas to shards with room.

    Small blocks go first, by the bit length of their number of copies.  What goes
    is laid end to end along the rooms, so few blocks are divided.
    """
    loads = loads_of(blocks, len(quotas))
    surplus = [max(0, n - q) for q, n in zip(quotas, loads)]
    if not any(surplus):
        return blocks
    classed = blocks.where(at(surplus, F.col("shard")) > 0).withColumn("class", F.length(F.bin("n")))
    lower = [[0] * 65 for _ in quotas]
    for r in classed.groupBy("shard", "class").agg(F.sum("n").alias("n")).collect():
        for c in range(r["class"] + 1, 65):
            lower[r["shard"]][c] += r["n"]
    first = F.element_at(F.array(*[F.array(*[F.lit(v).cast("long") for v in row]) for row in lower]), F.col("shard") + 1)
    out = running_total(classed, ["shard", "class"], ["key"], F.col("n"), buckets, "before")
    out = out.withColumn("moved", F.least("n", at(surplus, F.col("shard")) - F.element_at(first, F.col("class") + 1) - F.col("before"))).where("moved > 0")
    laid = running_total(out.select("key", "shard", "moved"), [], ["key", "shard"], F.col("moved"), buckets, "low")
    rooms, start = [], 0
    for s, (q, n) in enumerate(zip(quotas, loads)):
        if q > n:
            rooms.append(F.struct(F.lit(s).alias("to"), F.lit(start).cast("long").alias("low"), F.lit(start + q - n).cast("long").alias("high")))
            start += q - n
    high = F.col("low") + F.col("moved")
    parts = laid.withColumn("room", F.explode(F.filter(F.array(*rooms), lambda r: (r["low"] < high) & (r["high"] > F.col("low")))))
    moves = parts.select("key", "shard", F.col("room.to").alias("to"), (F.least(high, F.col("room.high")) - F.greatest("low", "room.low")).alias("moved"))
    return merged(blocks, moves)


def propagate(blocks: DataFrame, quotas: list[int], buckets: int) -> DataFrame:
    """Moves blocks (key, shard, n) towards their text's largest block within the quotas.

    The largest is taken of the blocks that do not fill a shard; the first by hash
    of equal ones.  A round is kept if more pairs of linked documents lie together
    afterwards, and rounds end when none are gained: that number has a bound, so
    they end.  No shard ends with more than its quota if none began so and the
    quotas hold all.
    """
    now = together(blocks)
    while True:
        rank = F.struct("n", F.xxhash64("key", "shard").alias("draw"), "shard")
        pull = blocks.where(F.col("n") < at(quotas, F.col("shard"))).groupBy("key").agg(F.max(rank).alias("best"))
        # Blocks larger than the best one fill their shards and stay.
        wish = blocks.join(pull, "key").where((F.col("n") < at(quotas, F.col("shard"))) & (F.col("shard") != F.col("best.shard")))
        moves = materialise(wish.select("key", "shard", F.col("best.shard").alias("to"), F.col("n").alias("moved")), "shard-moves")
        if not moves.take(1):
            return blocks
        moved = push_out(merged(blocks, moves), quotas, buckets)
        then = together(moved)
        if then <= now:
            return blocks
        blocks, now = moved, then


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row a document: id, size in bytes, checksum, law, shard and slot in the shard.

    The law is ``rows``: the shards' row counts differ by one at most, and slots
    count from 0 without gaps.  Null is the empty text; equal rows are documents of
    their own.  No documents give no rows.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    base = materialise(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(value) + 8).cast("long").alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"), F.md5(value.cast("binary")).alias("key")), "shard-documents")
    total = base.count()
    buckets = buckets_for(total)
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    copies = base.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
    tagged = materialise(base.join(copies, "key", "left"), "shard-copies")
    order = ["doc_id", "key"]
    one = F.lit(1).cast("long")

    linked = tagged.where("copies IS NOT NULL")
    dealt = running_total(linked, [], order, one, buckets, "place")
    blocks = materialise(dealt.groupBy("key", (F.col("place") % shards).cast("int").alias("shard")).agg(F.count("*").alias("n")), "shard-blocks")
    blocks = propagate(blocks, quotas, buckets)

    # Each block takes a stretch of its text's ranks and a stretch of its shard's slots.
    low = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        running_total(blocks, ["shard"], ["key"], F.col("n"), buckets, "slot")
        .withColumn("low", F.coalesce(F.sum("n").over(low), F.lit(0)))
        .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("low", "shard", "slot"))).alias("stretches"))
    )
    ranked = running_total(linked, ["key"], ["doc_id"], one, buckets, "rank").join(stretches, "key")
    mine = F.element_at(F.filter("stretches", lambda s: s["low"] <= F.col("rank")), -1)
    placed = ranked.withColumn("mine", mine).select(
        "doc_id", "size", "text_crc32", F.col("mine.shard").alias("shard"),
        (F.col("mine.slot") + F.col("rank") - F.col("mine.low")).alias("slot"))

    loads = loads_of(blocks, shards)
    starts = [sum(quotas[i] - loads[i] for i in range(s)) for s in range(shards)]
    fill = running_total(tagged.where("copies IS NULL"), [], order, one, buckets, "place")
    shard = F.size(F.filter(F.array(*[F.lit(int(v)).cast("long") for v in starts]), lambda v: v <= F.col("place"))) - 1
    filled = fill.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "shard", (at(loads, F.col("shard")) + F.col("place") - at(starts, F.col("shard"))).alias("slot"))

    return placed.unionByName(filled).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
