"""Aggregations.  All are partial on the map side, so hot groups shrink first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F


def summarise(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def distinct_per(df: DataFrame, keys: Sequence[str], col: str, approx: bool = False) -> DataFrame:
    """Distinct ``col`` per key as ``n_<col>``; exact unless ``approx``.

    The exact plan first shuffles on the keys *and* ``col``, which spreads a hot
    key over all tasks.
    """
    count = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.groupBy(*keys).agg(count.alias(f"n_{col}"))


def ratio(df: DataFrame, keys: Sequence[str], hit: Column, base: Column) -> DataFrame:
    """Rows that are hits, rows that are the base, and their ratio (null on an empty base)."""
    counted = df.groupBy(*keys).agg(
        F.count_if(hit & base).alias("hits"), F.count_if(base).alias("base")
    )
    return counted.withColumn("ratio", F.try_divide("hits", "base"))


def token_count(df: DataFrame, col: str) -> DataFrame:
    """Occurrences of each blank-separated token: map to tokens, reduce by key."""
    tokens = df.select(F.explode(F.split(col, " ")).alias("token"))
    return tokens.where(F.col("token") != "").groupBy("token").agg(F.count("*").alias("n"))


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All keys, all but the last, and so on down to none."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the keys."""
    return [s for n in range(len(keys), -1, -1) for s in combinations(keys, n)]


def totals_by_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], parts: Mapping[str, Column],
                   distinct: Mapping[str, str] | None = None, level: str = "grouping_id") -> DataFrame:
    """``parts``, and distinct counts, for each of several ``sets`` of the ``keys``.

    ``parts`` are aggregates that add up, sums and counts.  ``distinct`` maps a name to the
    one column whose different non-null values are counted, anew at each set.  A key that a
    set lacks is null there; ``level`` tells it from a key that is null, as it has a bit for
    each key, the first key's highest, set where the set lacks the key.  An empty table has
    no totals, not even the one over all rows.

    The rows shrink to one for each combination of all keys and distinct value before they
    are copied once for each set, so what is copied is the aggregate, not the table.  Counted
    values stay in the key of the copies' shuffle, which spreads the total over all rows.
    """
    if len(distinct or {}) > 1:
        raise ValueError("distinct values of one column only")
    counted = {name: f"_of{i}" for i, name in enumerate(distinct or {})}
    fine = df.groupBy(*keys, *[F.col(c).alias(counted[name]) for name, c in (distinct or {}).items()]).agg(
        *[c.alias(name) for name, c in parts.items()])
    kinds = {f.name: f.dataType for f in fine.schema}
    own = [*counted.values()]
    # What is counted comes first and is in every set, so its bit is the highest and never set.
    copied = fine.groupingSets([[*own, *s] for s in sets], *own, *keys).agg(
        F.grouping_id().alias(level), *[F.sum(n).cast(kinds[n]).alias(n) for n in parts])
    if own:
        copied = copied.groupBy(*keys, level).agg(
            *[F.sum(n).cast(kinds[n]).alias(n) for n in parts], *[F.count(c).alias(name) for name, c in counted.items()])
    return copied


# Columns a pivot may make.
PIVOT_COLUMNS = 1000


def pivot(df: DataFrame, keys: Sequence[str], col: str, parts: Mapping[str, Column], values: Sequence | None = None,
          other: str | None = None, most: int = PIVOT_COLUMNS) -> DataFrame:
    """One row per key, and a column ``<value>_<part>`` for each value of ``col`` and aggregate.

    Without ``values`` the values are looked for; more than ``most`` of them are refused, and
    no more than that are ever fetched.  With ``values`` the rows of all others are summed up
    under the name ``other``, or left out without one.  A null value is named ``null``.  A
    cell without rows is null; keys whose rows are all left out stay, with empty cells.
    Count rows by ``count(lit(1))``, as Spark's pivot takes no star.

    Spark aggregates by key and value first and only then lays the values side by side.
    """
    text = F.coalesce(F.col(col).cast("string"), F.lit("null"))
    if values is None:
        found = df.select(text.alias("v")).distinct().limit(most + 1).collect()
        names = sorted(r["v"] for r in found)
    else:
        names = ["null" if v is None else str(v) for v in values]
        if other:
            text = F.when(text.isin(names), text).otherwise(F.lit(other))
            names = [*names, other]
    if len(names) > most:
        raise ValueError(f"more than {most} values to be columns; name those wanted")
    made = [c.lower() for c in [*keys, *[f"{v}_{p}" for v in names for p in parts]]]
    if len(set(made)) < len(made):
        raise ValueError("two columns of the pivot would have one name")
    # Named by number first: a value may hold any character.
    at = F.element_at(F.create_map(*[x for i, v in enumerate(names) for x in (F.lit(v), F.lit(i))]), text) if names else F.lit(None).cast("int")
    numbered = df.withColumn("_value", at).groupBy(*keys).pivot("_value", list(range(len(names)))).agg(
        *[c.alias(f"p{j}") for j, c in enumerate(parts.values())])
    one = len(parts) == 1
    cells = [F.col(f"{i}" if one else f"{i}_p{j}").alias(f"{v}_{p}") for i, v in enumerate(names) for j, p in enumerate(parts)]
    return numbered.select(*keys, *cells)
