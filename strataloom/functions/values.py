"""Small column expressions shared by all layers: money, keys, clean text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"

# The key of the row that stands for "no matching dimension row".
UNKNOWN_KEY = "-1"


def money(c: Column | str) -> Column:
    """An amount as an exact decimal, so that its sum does not depend on order.

    Rounded half up to cents.  What is no such amount (NaN, infinite, too large) is null.
    """
    return (F.col(c) if isinstance(c, str) else c).try_cast(MONEY)


def money_sum(df: DataFrame, name: str) -> Column:
    """The exact sum of ``money`` over an amount of ``df``, whatever the order of its rows."""
    return F.sum(money(df[name])).cast(MONEY_SUM)


def mean_of(total: Column, n: Column) -> Column:
    """``total / n`` rounded half up to cents."""
    return F.round(total / n.cast("decimal(18,0)"), 2).cast(MONEY)


def clean(c: Column | str) -> Column:
    """Trimmed text; blank text is null."""
    text = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.nullif(text, F.lit(""))


def _field(c: Column | str) -> Column:
    # The length goes in front of each value, so that no two different rows can
    # give the same text whatever they hold; a null has a mark of its own.
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*cols: Column | str) -> Column:
    """md5 over the values of ``cols``; nulls and field borders count."""
    return F.md5(F.concat(*[_field(c) for c in cols]))


def hash_key(*cols: Column | str) -> Column:
    """Key of a hub, link or dimension row: the digest of its trimmed business key."""
    return digest(*[F.trim((F.col(c) if isinstance(c, str) else c).cast("string")) for c in cols])


def as_type_of(df: DataFrame, name: str, value) -> Column:
    """``value`` as a literal of the type of ``df[name]``.

    The literal is cast, never the column, so that the comparison still reaches
    the file scan as a pushed filter.
    """
    return F.lit(str(value)).cast(df.schema[name].dataType)
