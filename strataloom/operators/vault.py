"""Data Vault loads: hubs, links, satellites.  All only insert.

Each load returns the rows to append, so a load repeated on the same batch
returns nothing.

A satellite can be stored by the first digits of its hash keys.  A load then reads
the buckets of its own keys, found by their folders, and no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.functions.values import digest, hash_key
from strataloom.operators.dedup import dedup_latest
from strataloom.operators.slices import ROWS_PER_SLICE
from strataloom.operators.windows import changes
from strataloom.session import exists, materialise
from strataloom.sources.lake import clustered, read_columnar

# Hexadecimal digits of a hash key that name its bucket: 256 buckets.
BUCKET_DIGITS = 2
MOST_BUCKET_DIGITS = 4
BUCKET = "_strataloom_bucket"


def _stamp(rows: DataFrame, source: str, load_ts: str) -> DataFrame:
    return rows.withColumns({
        "load_ts": F.lit(load_ts).cast("timestamp_ntz"), "source": F.lit(source),
    })


def _business_key(df: DataFrame, key: str) -> Column:
    return F.trim(key).alias(key) if isinstance(df.schema[key].dataType, T.StringType) else F.col(key)


def load_hub(existing: DataFrame | None, batch: DataFrame, key: str, hk: str, source: str,
             load_ts: str) -> DataFrame:
    """Business keys of ``batch`` that the hub does not hold yet."""
    # Compared by the business key, which is shorter than its hash; only new keys
    # are hashed.
    rows = batch.select(_business_key(batch, key)).where(F.col(key).isNotNull()).distinct()
    if existing is not None:
        rows = rows.join(existing.select(key), key, "left_anti")
    return _stamp(rows.select(hash_key(key).alias(hk), key), source, load_ts)


def load_link(existing: DataFrame | None, batch: DataFrame, keys: Sequence[tuple[str, str]], hk: str,
              source: str, load_ts: str) -> DataFrame:
    """Key combinations that the link does not hold yet; ``keys`` pairs column and hub key."""
    cols = [c for c, _ in keys]
    rows = batch.select(*[_business_key(batch, c) for c in cols]).dropna(subset=cols).distinct()
    hashed = rows.select(hash_key(*cols).alias(hk), *[hash_key(c).alias(hub) for c, hub in keys])
    if existing is not None:
        hashed = hashed.join(existing.select(hk), hk, "left_anti")
    return _stamp(hashed, source, load_ts)


def load_satellite(existing: DataFrame | None, batch: DataFrame, key: str, hk: str,
                   attrs: Sequence[str], order: Sequence[str],
                   rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Rows of ``batch`` whose attributes differ from the row before them.

    A row is compared with the newest older row, stored or in the batch.  Rows
    that arrive late are compared with the stored rows around them; a stored row
    is never removed.
    """
    rows = batch.where(F.col(key).isNotNull()).select(
        hash_key(key).alias(hk), *order, *[a for a in attrs if a not in order],
        digest(*attrs).alias("hashdiff"),
    )
    # Copies of one row lie side by side, the stored one first, so a row that is
    # sent again never counts as a change.
    by = [*order, "hashdiff", "_fresh"]
    fresh = rows.withColumn("_fresh", F.lit(True))
    if existing is None:
        return changes(fresh, [hk], ["hashdiff"], by, rows_per_slice).drop("_fresh")

    # Stored rows that can matter: per key of the batch, those from its oldest
    # row on and the newest one before it.
    oldest = rows.groupBy(hk).agg(F.min(order[0]).alias("_oldest"))
    stored = existing.select(*rows.columns).join(oldest, hk)
    before = dedup_latest(stored.where(F.col(order[0]) < F.col("_oldest")), [hk], order)
    history = stored.where(F.col(order[0]) >= F.col("_oldest")).unionByName(before)
    both = fresh.unionByName(history.drop("_oldest").withColumn("_fresh", F.lit(False)))
    # A key is hot by all its rows: one late row of a key with a long history brings
    # that history along.
    return changes(both, [hk], ["hashdiff"], by, rows_per_slice).where("_fresh").drop("_fresh")


def _buckets(path: str, digits: int) -> str:
    if not 1 <= digits <= MOST_BUCKET_DIGITS:
        raise ValueError(f"a bucket has 1 to {MOST_BUCKET_DIGITS} digits")
    return f"{path.rstrip('/')}/digits={digits}"


def _in_buckets(rows: DataFrame, hk: str, digits: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.substring(hk, 1, digits))


def stored_for(keys: DataFrame, path: str, hk: str, schema: T.StructType, digits: int = BUCKET_DIGITS) -> DataFrame | None:
    """The stored satellite's rows in the buckets of ``keys``, which has the column ``hk``.

    None if nothing is stored yet.  The buckets asked for are at most ``16 ** digits``
    names, whatever the size of the batch, and choose folders before any file is listed
    for reading.  A satellite that was stored with another number of digits is refused.
    """
    spark, folder = keys.sparkSession, _buckets(path, digits)
    if not exists(spark, folder):
        if any(exists(spark, _buckets(path, d)) for d in range(1, MOST_BUCKET_DIGITS + 1)):
            raise ValueError(f"the satellite in {path} is stored with another number of digits")
        return None
    touched = [r[0] for r in _in_buckets(keys.select(hk), hk, digits).select(BUCKET).dropna().distinct().collect()]
    stored = read_columnar(spark, folder, T.StructType([*schema.fields, T.StructField(BUCKET, T.StringType())]))
    return stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)


def append_satellite(path: str, batch: DataFrame, key: str, hk: str, attrs: Sequence[str], order: Sequence[str],
                     digits: int = BUCKET_DIGITS, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Load ``batch`` into the satellite stored in ``path`` and return the rows that were added.

    They are the rows of ``load_satellite``, so a load that is repeated after a failure
    adds what is still missing.  Loads of one satellite must not run at the same time.
    Within a bucket the rows lie in order of their key, so that a scan can also pass
    over the parts of a file that hold none of the keys asked for.
    """
    hashed = batch.where(F.col(key).isNotNull()).select(hash_key(key).alias(hk))
    first = load_satellite(None, batch, key, hk, attrs, order, rows_per_slice)
    stored = stored_for(hashed, path, hk, first.schema, digits)
    new = first if stored is None else load_satellite(stored, batch, key, hk, attrs, order, rows_per_slice)
    # Stored before it is appended, as the folder is still being read until then.
    new = materialise(new, "satellite-load")
    clustered(_in_buckets(new, hk, digits), [BUCKET], [hk, *order]).write.mode("append").partitionBy(BUCKET).parquet(_buckets(path, digits))
    return new


def read_satellite(spark, path: str, schema: T.StructType, digits: int = BUCKET_DIGITS) -> DataFrame:
    """The whole stored satellite."""
    return read_columnar(spark, _buckets(path, digits), schema)


def current(sat: DataFrame, hk: str, order: Sequence[str]) -> DataFrame:
    """The newest row of each key."""
    return dedup_latest(sat, [hk], order)
