"""Helpers that the text operators share: columns from Arrow batches, word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, types as T

# Text a task handles at once; a longer document is a part of its own.
PART_BYTES = 4 * 1024 * 1024
SHINGLE_WORDS = 5

# Odd multipliers that mix 64-bit hashes.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


def parts(batch: pa.RecordBatch, text: str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds about ``limit`` bytes of text at most."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    which = np.cumsum(lengths.astype(np.int64)) // limit
    start = 0
    for end in [*(np.flatnonzero(np.diff(which)) + 1), len(which)]:
        if end > start:
            yield batch.slice(start, end - start)
            start = end


def add_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable, limit: int = PART_BYTES) -> DataFrame:
    """``df`` with new columns that ``make()(part)`` computes from each part of it.

    ``make`` runs once a task and returns a function from a part of an Arrow batch
    to the new columns' arrays.  Every other column passes through; one that has
    the name of a new column, in either case, is replaced by it.  A part has about
    ``limit`` bytes of text.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]

    def run(batches):
        work = make()
        for batch in batches:
            for part in parts(batch, text, limit):
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays(arrays + list(work(part)), names=names + [f.name for f in fields])

    return df.mapInArrow(run, T.StructType(kept + fields))


def column(part: pa.RecordBatch, name: str) -> pa.Array:
    return part.column(part.schema.get_field_index(name))


def filled(part: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with null as the empty text."""
    return pc.fill_null(column(part, name), "")


def lists(values: np.ndarray, counts, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values of each row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scrambles 64-bit hashes; each seed gives another function."""
    with np.errstate(over="ignore"):
        h = (h ^ np.uint64((seed * MIX[0]) & (2**64 - 1))) * np.uint64(MIX[4])
        h ^= h >> np.uint64(32)
        h *= np.uint64(MIX[3])
        h ^= h >> np.uint64(29)
    return h


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and the number of words of each text.

    Words are runs of letters, marks and digits in lower case.
    """
    plain = pc.replace_substring_regex(pc.utf8_lower(text), r"[^\p{L}\p{M}\p{N}]+", " ")
    split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(plain))
    flat, counts = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # a text without words comes as one empty word
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[full], minlength=len(counts))
        flat = flat.filter(pa.array(full))
    return flat, counts


def word_hashes(flat: pa.Array) -> np.ndarray:
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return table[coded.indices.to_numpy(zero_copy_only=False)] if len(table) else np.zeros(0, np.uint64)


def shingles(text: pa.Array, n: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text its sorted distinct shingles of ``n`` words, as 64-bit hashes.

    A text of fewer words has one shingle of all its words; one without words none.
    """
    flat, counts = words(text)
    h = word_hashes(flat)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    with np.errstate(over="ignore"):
        rolled, padded = np.zeros(len(h), np.uint64), np.concatenate([h, np.zeros(n - 1, np.uint64)])
        for k in range(n):
            rolled = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(MIX[1]) + padded[k:len(h) + k]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= n:
            out.append(np.unique(rolled[a: b - n + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
