"""Joins on time: the version valid at an event, intervals that overlap.

Both are equi-joins or windows over bounded groups; no plan compares every row of
one side with every row of the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataloom.operators.joins import small_enough
from strataloom.operators.slices import ROWS_PER_SLICE, SLICE, slice_hot_keys
from strataloom.session import materialise


def asof_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, since: str,
              cols: Sequence[str], until: str | None = None, how: str = "left",
              rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``facts`` with the columns ``cols`` of the key's newest version at their time.

    A version holds from ``since`` on, that time included, until the key's next one;
    with ``until`` it ends before that time at the latest, and a null there has no end.
    Of versions of one key and time the largest by ``cols`` holds.  A fact before every
    version, or with a null key or time, has nulls there (``how`` ``left``) or goes
    (``inner``); versions with a null key or ``since`` hold for nothing.

    Facts and versions are one stream of rows in order of time, in which the last
    version is carried forward.  Keys far above what one task sorts are cut into slices
    of time; a slice starts from the newest version before it.
    """
    if how not in ("left", "inner"):
        raise ValueError("an as-of join is left or inner")
    if clash := {c.lower() for c in cols} & {c.lower() for c in facts.columns}:
        raise ValueError(f"facts have the columns {sorted(clash)} already")
    held = [*cols, *([until] if until and until not in cols else [])]
    names = [f"_of{i}" for i in range(len(keys))]
    own_keys = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    known = versions.dropna(subset=[*keys, since]).select(
        *own_keys, F.col(since).alias("_time"), F.lit(0).alias("_side"), F.struct(*held).alias("_version"))
    timed = facts.select(*own_keys, F.col(at).alias("_time"), F.lit(1).alias("_side"), F.struct("*").alias("_fact"))
    whole = F.lit(True)
    for n in (*names, "_time"):
        whole = whole & F.col(n).isNotNull()
    both = known.unionByName(timed.where(whole), allowMissingColumns=True)

    sliced = slice_hot_keys(both, names, ["_time", "_side"], rows_per_slice)
    way = Window.partitionBy(*names, *([SLICE] if sliced.hot else [])).orderBy("_time", "_side", "_version")
    last = F.last("_version", ignorenulls=True).over(way.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if sliced.hot:
        # The newest version of each slice, then the newest of all slices before it.
        newest = F.max(F.when(F.col("_side") == 0, F.struct("_time", "_version")))
        ends = sliced.rows.where(F.col(SLICE) >= 0).groupBy(*[F.col(n).alias(f"{n}s") for n in names], F.col(SLICE).alias("_slice")).agg(newest.alias("_end"))
        before = Window.partitionBy(*[f"{n}s" for n in names]).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = materialise(ends.withColumn("_start", F.max("_end").over(before)["_version"]).drop("_end"), "slice-starts")
        match = [sliced.rows[n] == starts[f"{n}s"] for n in names] + [sliced.rows[SLICE] == starts["_slice"]]
        few = F.broadcast(starts) if small_enough(starts) else starts
        rows = sliced.rows.join(few, match, "left").withColumn("_version", F.coalesce(last, F.col("_start")))
    else:
        rows = both.withColumn("_version", last)
    rows = rows.where("_side = 1").select("_time", "_fact", "_version")
    if how == "left":
        rows = rows.unionByName(timed.where(~whole).select("_time", "_fact"), allowMissingColumns=True)
    valid = F.col("_version").isNotNull()
    if until:
        valid = valid & (F.col(f"_version.`{until}`").isNull() | (F.col("_time") < F.col(f"_version.`{until}`")))
    if how == "inner":
        rows = rows.where(valid)
    return rows.select("_fact.*", *[F.when(valid, F.col(f"_version.`{c}`")).alias(c) for c in cols])


# Bins of an interval's own level are as long as it or longer, so it lies in two at most.
LEAST_LEVEL = 0


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str],
                  right_span: tuple[str, str]) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose intervals ``[from, to)`` overlap.

    Rows with a null key or bound, or an interval without length, meet nothing.  The
    result has the keys once; other columns must have different names.

    Time is cut into bins of 1, 2, 4, ... seconds.  An interval is at home in bins as
    long as itself, of which it meets two at most, and a guest in those of every longer
    level that intervals of the other side are at home in.  So a long interval has as few
    rows as a short one, and guests of a bin meet who is at home there, not each other.
    Of the bins in which a pair meets, the one where the later of them begins emits it.
    """
    if clash := {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {k.lower() for k in keys}:
        raise ValueError(f"both sides have the columns {sorted(clash)}")

    def levelled(df: DataFrame, span: tuple[str, str], side: str) -> DataFrame:
        rows = df.dropna(subset=[*keys, *span]).where(F.col(span[0]) < F.col(span[1]))
        start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in span)
        rows = rows.withColumn(f"_{side}from", start).withColumn(f"_{side}to", end)
        seconds = (F.col(f"_{side}to") - F.col(f"_{side}from")) / F.lit(1e6)
        return rows.withColumn(f"_{side}level", F.greatest(F.lit(LEAST_LEVEL), F.ceil(F.log2(seconds))).cast("int"))

    l, r = levelled(left, left_span, "l"), levelled(right, right_span, "r")
    # The levels there are: some sixty at most.
    levels = {side: sorted(x[0] for x in df.select(f"_{side}level").distinct().collect()) for side, df in (("l", l), ("r", r))}

    def binned(df: DataFrame, side: str, level: Column) -> DataFrame:
        size = _length(level)
        first, last = _bin(F.col(f"_{side}from"), size), _bin(F.col(f"_{side}to") - 1, size)
        return df.withColumn("_level", level).withColumn("_bin", F.explode(F.sequence(first, last)))

    def guests(df: DataFrame, side: str, others: list[int]) -> DataFrame:
        longer = F.filter(F.array(*[F.lit(x) for x in others]).cast("array<int>"), lambda x: x > F.col(f"_{side}level"))
        return binned(df.withColumn("_at_level", F.explode(longer)), side, F.col("_at_level")).drop("_at_level")

    on = [*keys, "_level", "_bin"]
    home_l, home_r = binned(l, "l", F.col("_llevel")), binned(r, "r", F.col("_rlevel"))
    # Rows are several times what the optimiser knows of the tables: shuffled, never broadcast.
    met = home_l.join(home_r.unionByName(guests(r, "r", levels["l"])).hint("merge"), on).unionByName(
        guests(l, "l", levels["r"]).join(home_r.hint("merge"), on))
    size = _length(F.col("_level"))
    later = F.greatest("_lfrom", "_rfrom")
    met = met.where((later < F.least("_lto", "_rto")) & (F.col("_bin") == _bin(later, size)))
    return met.select(*keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys])


def _length(level: Column) -> Column:
    """Microseconds of a bin."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), level) * F.lit(1_000_000).cast("long")


def _bin(micros: Column, size: Column) -> Column:
    """The number of the bin, in whole numbers."""
    return F.call_function("div", micros - F.pmod(micros, size), size)


def trailing(df: DataFrame, keys: Sequence[str], time: str, seconds: int, aggs: dict[str, Column]) -> DataFrame:
    """Adds, by name, ``aggs`` over the key's rows of the last ``seconds`` up to each row's time.

    The frame is ``RANGE``: rows of the same time count for one another, and the bound
    itself is in.  A row without time sees those of its key without time.

    A key's rows are cut into pieces as long as the frame, so that a row's frame lies in
    its own piece and the one before.  Each row goes to its own piece and, as a halo, to
    the next: twice the rows, and no task holds more of a key than two frames' worth.
    """
    made = ["_micros", "_piece", "_halo"]
    length = F.lit(seconds).cast("long") * F.lit(1_000_000)
    rows = df.withColumn("_micros", F.unix_micros(F.col(time).cast("timestamp")))
    own = _bin(F.col("_micros"), length)
    copies = F.when(F.col("_micros").isNull(), F.array(F.struct(F.lit(None).cast("long").alias("piece"), F.lit(False).alias("halo")))).otherwise(
        F.array(F.struct(own.alias("piece"), F.lit(False).alias("halo")), F.struct((own + 1).alias("piece"), F.lit(True).alias("halo"))))
    rows = rows.withColumn("_copy", F.explode(copies)).withColumn("_piece", F.col("_copy.piece")).withColumn("_halo", F.col("_copy.halo")).drop("_copy")
    frame = Window.partitionBy(*keys, "_piece").orderBy("_micros").rangeBetween(-seconds * 1_000_000, Window.currentRow)
    return rows.withColumns({name: agg.over(frame) for name, agg in aggs.items()}).where(~F.col("_halo")).drop(*made)
