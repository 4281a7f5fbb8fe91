"""Data-quality checks with one result schema, and a quarantine.

Row rules of a table share one aggregation over it.  Uniqueness and reference
checks count per key first, so a hot key becomes one row before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from strataloom.operators.sets import union_sources


@dataclass(frozen=True)
class RowRule:
    """A row fails where ``fails()`` is true; an undecided (null) row does not.

    The expression is made on use, so rules can be declared before a session exists.
    """

    check: str
    column: str
    fails: Callable[[], Column] = field(compare=False)


def not_null(col: str) -> RowRule:
    return RowRule("not_null", col, lambda: F.col(col).isNull())


def accepted(col: str, values: Sequence) -> RowRule:
    return RowRule("accepted", col, lambda: ~F.col(col).isin(*values))


def in_range(col: str, low=None, high=None) -> RowRule:
    def fails() -> Column:
        below = F.lit(False) if low is None else F.col(col) < F.lit(low)
        above = F.lit(False) if high is None else F.col(col) > F.lit(high)
        return below | above

    return RowRule("range", col, fails)


def in_order(first: str, then: str) -> RowRule:
    """``then`` must not lie before ``first``."""
    return RowRule("order", f"{first},{then}", lambda: F.col(then) < F.col(first))


@dataclass(frozen=True)
class Unique:
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """``column`` must be found in ``ref_column`` of the table ``ref``; nulls are left out."""

    column: str
    ref: str
    ref_column: str


def _result(check: Column | str, table: str, column: Column | str, failed: Column, total: Column) -> list[Column]:
    check = F.lit(check) if isinstance(check, str) else check
    column = F.lit(column) if isinstance(column, str) else column
    return [
        check.alias("check"), F.lit(table).alias("table_name"), column.alias("column_name"),
        F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
        (F.coalesce(failed, F.lit(0)) == 0).alias("passed"),
    ]


def _row_checks(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    counts = [F.count_if(r.fails()).alias(f"f{i}") for i, r in enumerate(rules)]
    one_row = df.agg(F.count("*").alias("total"), *counts)
    each = F.array(*[
        F.struct(F.lit(r.check).alias("check"), F.lit(r.column).alias("column"),
                 F.col(f"f{i}").alias("failed"))
        for i, r in enumerate(rules)
    ])
    rows = one_row.select("total", F.explode(each).alias("r"))
    return rows.select(*_result(F.col("r.check"), table, F.col("r.column"), F.col("r.failed"), F.col("total")))


def _unique(df: DataFrame, table: str, rule: Unique) -> DataFrame:
    per_key = df.groupBy(*rule.keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum(F.col("n") - 1).alias("failed"), F.sum("n").alias("total")).select(
        *_result("unique", table, ",".join(rule.keys), F.col("failed"), F.col("total"))
    )


def _reference(df: DataFrame, table: str, rule: Reference, refs: Mapping[str, DataFrame]) -> DataFrame:
    # One row per key on both sides before the join; the parent side only marks.
    per_key = df.groupBy(F.col(rule.column).alias("_key")).agg(F.count("*").alias("n"))
    parent = refs[rule.ref].select(F.col(rule.ref_column).alias("_parent")).distinct()
    joined = per_key.join(parent, per_key["_key"] == parent["_parent"], "left")
    orphan = F.col("_key").isNotNull() & F.col("_parent").isNull()
    return joined.agg(
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("failed"), F.sum("n").alias("total")
    ).select(*_result("reference", table, rule.column, F.col("failed"), F.col("total")))


def run_checks(df: DataFrame, table: str, rules: Sequence[RowRule | Unique | Reference],
               refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row ``(check, table_name, column_name, failed, total, passed)`` per rule."""
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    results = [_row_checks(df, table, row_rules)] if row_rules else []
    results += [_unique(df, table, r) for r in rules if isinstance(r, Unique)]
    results += [_reference(df, table, r, refs or {}) for r in rules if isinstance(r, Reference)]
    return union_sources(results)


def reconcile(left: DataFrame, right: DataFrame, table: str, sums: Mapping[str, str]) -> DataFrame:
    """Compares row count and column sums of two layers, as one result row each.

    ``sums`` maps columns to the exact type they are summed in.  ``failed`` is 1
    where the layers differ.
    """
    def totals(df: DataFrame, sign: int) -> DataFrame:
        measures = [F.struct(F.lit("*").alias("column"), F.col("n").cast("decimal(38,6)").alias("v"))]
        measures += [
            F.struct(F.lit(c).alias("column"), F.coalesce(f"s_{c}", F.lit(0)).cast("decimal(38,6)").alias("v"))
            for c in sums
        ]
        one_row = df.agg(F.count("*").alias("n"), *[F.sum(F.col(c).try_cast(t)).alias(f"s_{c}") for c, t in sums.items()])
        return one_row.select(F.explode(F.array(*measures)).alias("m")).select("m.column", (F.col("m.v") * sign).alias("v"))

    net = totals(left, 1).unionByName(totals(right, -1)).groupBy("column").agg(F.sum("v").alias("v"))
    return net.select(*_result("reconcile", table, F.col("column"), F.when(F.col("v") != 0, 1).otherwise(0), F.lit(1)))


def with_reason(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Adds ``reason``: the failed rules of a row, null on a good one."""
    names = [F.when(r.fails(), F.lit(f"{r.check}:{r.column}")) for r in rules]
    return df.withColumn("reason", F.nullif(F.concat_ws(";", *names), F.lit("")))


def quarantine(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reason."""
    marked = with_reason(df, rules)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")
