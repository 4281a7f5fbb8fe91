"""Windows that hold at scale: exact global buckets, changes per key, running totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strataloom.functions.ordering import among, constant, sort_tuple
from strataloom.operators.joins import small_enough
from strataloom.operators.slices import CARRIED, ROWS_PER_SLICE, SLICE, slice_hot_keys
from strataloom.session import materialise

# Equal-size buckets: rows that one task sorts to find the cut rows, and cut points
# that one pass adds to the slices it refines.
NTILE_ROWS_PER_SLICE = 1_000_000
NTILE_CUTS_PER_PASS = 20_000


def ntile_at_scale(df: DataFrame, n: int, orders: Mapping[str, Sequence[str]],
                   rows_per_slice: int = NTILE_ROWS_PER_SLICE) -> DataFrame:
    """Adds, for each ``name: order``, the bucket 1..n that ``ntile(n)`` would give.

    The order is ascending with nulls lowest and must end in a unique column.

    ``ntile`` over a whole table sorts it in one task.  Only the last row of each
    bucket is needed, though: a sample cuts the order into slices and the rows per
    slice are counted, again and again for those slices that hold a wanted row,
    until they are small enough to be sorted.  The bucket is then a search among
    ``n - 1`` fixed rows, so no row of ``df`` is shuffled.  All orders share the
    passes over ``df``, which should therefore be a stored table.
    """
    total = df.count()
    # Rank of the last row of each bucket but the final one: the first
    # ``total % n`` buckets hold one row more than the others.
    small, extra = divmod(total, n)
    ends = sorted({i * small + min(i, extra) for i in range(1, n)} - {0, total})
    if not ends:
        return df.withColumns({name: F.lit(1) for name in orders})

    at = [sort_tuple(df, order) for order in orders.values()]
    kinds = [f.dataType for f in df.select(*[a.alias(f"at{i}") for i, a in enumerate(at)]).schema]
    cuts: list[list] = [[] for _ in at]
    counts = [{0: total} for _ in at]
    while True:
        pieces = [among(c, kind, a) for c, kind, a in zip(cuts, kinds, at, strict=True)]
        wanted = _wanted(counts, ends)
        large = {(i, s) for i, s, _ in wanted if counts[i][s] > rows_per_slice}
        if not large:
            break
        before, cuts = cuts, _more_cuts(df, at, pieces, cuts, large, counts)
        if cuts == before:
            raise ValueError("an order ties over more rows than one task should sort; end it with a unique column")
        counts = _slice_counts(df, [among(c, kind, a) for c, kind, a in zip(cuts, kinds, at, strict=True)])
    last = _last_rows(df, at, pieces, counts, wanted)
    return df.withColumns({name: among(last[i], kinds[i], at[i]) + 1 for i, name in enumerate(orders)})


def _wanted(counts: Sequence[Mapping[int, int]], ends: Sequence[int]) -> list[tuple[int, int, int]]:
    """Per order the slice of each rank in ``ends``, and the rank inside it."""
    wanted = []
    for i, rows_in in enumerate(counts):
        before = 0
        left = iter(ends)
        end = next(left, None)
        for s in sorted(rows_in):
            while end is not None and end <= before + rows_in[s]:
                wanted.append((i, s, end - before))
                end = next(left, None)
            before += rows_in[s]
    return wanted


def _more_cuts(df: DataFrame, at: Sequence[Column], pieces: Sequence[Column], cuts: Sequence[list],
               large: set[tuple[int, int]], counts: Sequence[Mapping[int, int]]) -> list[list]:
    """``cuts`` with further ones inside the ``large`` slices, from a sample of fixed size."""
    rows = sum(counts[i][s] for i, s in large)
    found = (
        df.select(_each(pieces), *[a.alias(f"at{i}") for i, a in enumerate(at)])
        .where(_in_slices(large, counts))
        .sample(fraction=min(1.0, NTILE_CUTS_PER_PASS / rows), seed=17 + sum(map(len, cuts)))
        .select("p.i", *[F.when(F.col("p.i") == i, F.col(f"at{i}")).alias(f"at{i}") for i in range(len(at))])
        .collect()
    )
    more = [list(c) for c in cuts]
    for r in found:
        more[r["i"]].append(tuple(r[f"at{r['i']}"]))
    # Nulls come first, as in Spark.
    key = lambda t: [(v is not None, v if v is not None else 0) for v in t]
    return [sorted(set(c), key=key) for c in more]


def _each(pieces: Sequence[Column]) -> Column:
    """One ``(order, slice)`` per order."""
    return F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), p.alias("s")) for i, p in enumerate(pieces)
    ])).alias("p")


def _slice_counts(df: DataFrame, pieces: Sequence[Column]) -> list[dict[int, int]]:
    counts: list[dict[int, int]] = [{} for _ in pieces]
    for i, s, rows in df.select(_each(pieces)).groupBy("p.i", "p.s").count().collect():
        counts[i][s] = rows
    return counts


def _last_rows(df: DataFrame, at: Sequence[Column], pieces: Sequence[Column],
               counts: Sequence[Mapping[int, int]], wanted: Sequence[tuple[int, int, int]]) -> list[list]:
    """Per order, the rows at the ``wanted`` ranks of the slices."""
    ranks = [[[] for _ in range(max(c) + 1)] for c in counts]
    for i, s, rank in wanted:
        ranks[i][s].append(rank)
    # Rows of a slice are compared by their own order; the other orders are null.
    own = [F.when(F.col("p.i") == i, F.col(f"at{i}")).alias(f"at{i}") for i in range(len(at))]
    w = Window.partitionBy("i", "s").orderBy(*[f"at{i}" for i in range(len(at))])
    found = (
        df.select(_each(pieces), *[a.alias(f"at{i}") for i, a in enumerate(at)])
        .where(_in_slices({(i, s) for i, s, _ in wanted}, counts))
        .select("p.i", "p.s", *own)
        .withColumn("rank", F.row_number().over(w))
        .where(F.array_contains(F.get(F.get(constant(ranks, T.ArrayType(T.ArrayType(T.ArrayType(T.IntegerType())))), F.col("i")), F.col("s")), F.col("rank")))
        .collect()
    )
    last: list[list] = [[] for _ in at]
    for r in sorted(found, key=lambda r: (r["i"], r["s"], r["rank"])):
        last[r["i"]].append(tuple(r[f"at{r['i']}"]))
    return last


def _in_slices(which: set[tuple[int, int]], counts: Sequence[Mapping[int, int]]) -> Column:
    """Whether the row ``p`` lies in one of these slices."""
    flags = [[(i, s) in which for s in range(max(c) + 1)] for i, c in enumerate(counts)]
    at = F.get(constant(flags, T.ArrayType(T.ArrayType(T.BooleanType()))), F.col("p.i"))
    return F.coalesce(F.get(at, F.col("p.s")), F.lit(False))


def previous(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str],
             name: str = "previous", rows_per_slice: int = ROWS_PER_SLICE,
             like: DataFrame | None = None) -> DataFrame:
    """Adds ``name``: a struct of ``cols`` of the row before within the key, null on the first.

    ``order`` must not tie within a key, unless by equal ``cols``.  ``like`` is
    passed to ``slice_hot_keys``.
    """
    sliced = slice_hot_keys(df, keys, order, rows_per_slice, like, cols)
    before = F.lag(F.struct(*cols))
    if not sliced.hot:
        return df.withColumn(name, before.over(Window.partitionBy(*keys).orderBy(*order)))
    inside = before.over(Window.partitionBy(*keys, SLICE).orderBy(*order))
    return sliced.rows.withColumn(name, F.coalesce(inside, F.col(CARRIED))).drop(SLICE, CARRIED)


def changes(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str],
            rows_per_slice: int = ROWS_PER_SLICE, like: DataFrame | None = None) -> DataFrame:
    """Rows whose ``cols`` differ from the row before within the key; the first row counts."""
    before = "_strataloom_before"
    rows = previous(df, keys, cols, order, before, rows_per_slice, like)
    same = F.col(before).isNotNull()
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"{before}.{c}"))
    return rows.where(~same).drop(before)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
            name: str = "running", rows_per_slice: int | None = ROWS_PER_SLICE) -> DataFrame:
    """Adds ``name``: the sum of ``col`` over the key's rows up to and including this one.

    ``order`` must not tie within a key.  Pass no ``rows_per_slice`` where a key
    cannot have many rows, such as one per month: hot keys are not looked for.
    """
    sliced = slice_hot_keys(df, keys, order, rows_per_slice) if rows_per_slice else None
    whole = (Window.unboundedPreceding, Window.currentRow)
    if sliced is None or not sliced.hot:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*whole)
        return df.withColumn(name, F.sum(col).over(w))

    # What a slice starts from: the sums of the key's slices before it.
    by_key = [f"_key{i}" for i in range(len(keys))]
    sums = (
        sliced.rows.where(F.col(SLICE) >= 0)
        .select(*[F.col(k).alias(a) for k, a in zip(keys, by_key, strict=True)],
                F.col(SLICE).alias("_slice"), F.col(col).alias("_v"))
        .groupBy(*by_key, "_slice")
        .agg(F.sum("_v").alias("_v"))
    )
    below = Window.partitionBy(*by_key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(sums.select(*by_key, "_slice", F.sum("_v").over(below).alias("_start")), "slice-starts")
    match = [sliced.rows[k].eqNullSafe(starts[a]) for k, a in zip(keys, by_key, strict=True)]
    match.append(sliced.rows[SLICE] == starts["_slice"])
    few = F.broadcast(starts) if small_enough(starts) else starts
    rows = sliced.rows.join(few, match, "left").drop(*by_key, "_slice")
    here = F.sum(col).over(Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(*whole))
    kind = rows.select(here.alias("v")).schema["v"].dataType
    both = F.coalesce(here + F.col("_start"), here, F.col("_start"))
    return rows.withColumn(name, both.cast(kind)).drop(SLICE, "_start")


def sessions(df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], gap: str, aggs: Sequence[Column],
             rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``aggs`` for each session of ``keys``: rows no more than ``gap`` apart.

    A session ends ``gap`` after its last row; columns ``session_start`` and
    ``session_end`` come first.  ``[time, *order]`` must not tie within a key.  Rows
    without time are in no session; null keys are keys.  The sessions of a hot key are
    found in slices, across which the row before and the number of the session are
    carried, and summed up before any shuffle.
    """
    wait, by = F.expr(f"INTERVAL {gap}"), [time, *order]
    rows = previous(df.where(F.col(time).isNotNull()), keys, [time], by, "_before", rows_per_slice)
    apart = F.col("_before").isNull() | (F.col(time) > F.col(f"_before.`{time}`") + wait)
    marked = materialise(rows.withColumn("_first", apart.cast("long")).drop("_before"), "session-starts")
    numbered = running(marked, keys, by, "_first", "_session", rows_per_slice)
    totals = numbered.groupBy(*keys, "_session").agg(F.min(time).alias("session_start"), (F.max(time) + wait).alias("session_end"), *aggs)
    return totals.select("session_start", "session_end", *[c for c in totals.columns if c not in ("session_start", "session_end", "_session")])
