"""Warehouse layers, and facts and dimensions.

Layers: *staging* holds what arrived, as text beside its load metadata; *core*
holds typed and cleaned rows; marts are built from core.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from strataloom.functions.values import UNKNOWN_KEY, clean, digest
from strataloom.operators.dedup import dedup_latest
from strataloom.session import materialise


def to_staging(df: DataFrame, source: str, load_ts: str) -> DataFrame:
    """Every column as text, with source, load time and the digest of the row.

    The load time is an argument, so that a second run writes the same rows.
    """
    return df.select(
        *[F.col(c).cast("string").alias(c) for c in df.columns],
        F.lit(source).alias("source"),
        F.lit(load_ts).cast("timestamp_ntz").alias("load_ts"),
        digest(*df.columns).alias("row_hash"),
    )


def to_core(df: DataFrame, spec: Mapping[str, str], defaults: Mapping[str, object] | None = None,
            keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from staged text: trimmed, blank as null, null as its default.

    ``spec`` maps columns to types.  A value that does not fit its type becomes
    null instead of failing the load; the quality checks find it.
    """
    defaults = defaults or {}
    typed = []
    for name, kind in spec.items():
        value = clean(name) if kind == "string" else clean(name).try_cast(kind)
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]).cast(kind))
        typed.append(value.alias(name))
    return df.select(*typed, *keep)


def build_dim(df: DataFrame, key: str, attrs: Sequence[str], order: Sequence[str], sk: str) -> DataFrame:
    """One row per natural key, the newest, with the surrogate key ``sk``.

    One more row stands for an unknown key: facts without a partner refer to it, so
    a join of fact and dimension keeps every fact.
    """
    needed = list(dict.fromkeys([key, *attrs, *order]))
    latest = dedup_latest(df.select(*needed).where(F.col(key).isNotNull()), [key], order)
    known = latest.select(digest(key).alias(sk), key, *attrs)
    return known.unionByName(unknown_row(known, sk))


def unknown_row(dim: DataFrame, sk: str) -> DataFrame:
    """The row that stands for "no matching row" in ``dim``: null but for its key."""
    row = [UNKNOWN_KEY if f.name == sk else None for f in dim.schema.fields]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in dim.schema.fields])
    return dim.sparkSession.createDataFrame([row], schema)


def build_fact(df: DataFrame, dims: Sequence[tuple[DataFrame, str, str, str]],
               keep: Sequence[str]) -> DataFrame:
    """``keep`` and one key per ``(dimension, fact column, natural key, surrogate key)``.

    A row without a partner in a dimension gets the key of the unknown row.
    """
    keys = []
    for i, (dim, fact_key, natural, sk) in enumerate(dims):
        small = dim.select(F.col(natural).alias(f"_natural{i}"), F.col(sk).alias(f"_sk{i}"))
        df = df.join(small, df[fact_key] == small[f"_natural{i}"], "left")
        keys.append(F.coalesce(f"_sk{i}", F.lit(UNKNOWN_KEY)).alias(sk))
    return df.select(*keep, *keys)


@dataclass(frozen=True)
class DimSpec:
    """A dimension inside a wide table: its natural key, what depends on it, its surrogate key."""

    key: str
    attrs: tuple[str, ...]
    sk: str


def split_wide(df: DataFrame, spec: Mapping[str, DimSpec]) -> dict[str, DataFrame]:
    """Split a wide table into dimensions and a ``fact`` that refers to them.

    Nothing is lost as long as the attributes depend on their key.  The surrogate
    key is computed from the natural key, so the fact needs no join.  The wide table,
    often a large join, is computed once and stored.
    """
    df = materialise(df, "wide")
    tables = {}
    for name, dim in spec.items():
        # Distinct first: it hashes on the map side, where the newest-row rule sorts.
        members = df.select(dim.key, *dim.attrs).distinct()
        tables[name] = build_dim(members, dim.key, dim.attrs, dim.attrs, dim.sk)
    moved = {c for dim in spec.values() for c in (dim.key, *dim.attrs)}
    keys = [
        F.when(F.col(d.key).isNull(), F.lit(UNKNOWN_KEY)).otherwise(digest(d.key)).alias(d.sk)
        for d in spec.values()
    ]
    tables["fact"] = df.select(*[c for c in df.columns if c not in moved], *keys)
    return tables


def wide_view(tables: Mapping[str, DataFrame], spec: Mapping[str, DimSpec], columns: Sequence[str]) -> DataFrame:
    """The split model under its old wide schema."""
    wide = tables["fact"]
    for name, dim in spec.items():
        wide = wide.join(tables[name], dim.sk, "left")
    return wide.select(*columns)
