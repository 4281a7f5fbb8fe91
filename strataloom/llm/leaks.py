"""Benchmark items inside documents: size-partitioned MinHash containment search.

Documents are partitioned by the number of their shingles.  The sketch of a
partition's documents has as many bins as fit its sizes, and keeps the least hash
of each bin; items are sketched with the same bins.  An item that shares a bin's
least hash with a document is a candidate, and the share of the item's shingles
that the document holds is then computed exactly.  The number of repetitions
follows from the item's size, so that a passage is missed less often than ``MISS``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from strataloom.llm.texts import add_columns, filled, mixed, shingles

CONTAINMENT = 0.8
MISS = 1e-9
# Bins for each shingle of the largest document of a partition.
BINS_PER_SHINGLE = 2
# Items go to every task in blocks of this much text at most.
BLOCK_BYTES = 16 * 1024 * 1024


def least(h: np.ndarray, bits: int) -> np.ndarray:
    """The least hash of each of ``2 ** bits`` bins; a bin is a range of hashes.  ``h`` is sorted."""
    if not len(h):
        return h
    bins = h >> np.uint64(64 - bits)
    return h[np.concatenate([[True], bins[1:] != bins[:-1]])]


def repetitions(n: int, containment: float) -> int:
    """Hash functions after which an item of ``n`` shingles is missed rarely enough.

    A shared shingle is the least of its bin in the document with the probability
    below, whatever the document, as bins outnumber shingles.
    """
    load = 1 / BINS_PER_SHINGLE
    hit = (1 - math.exp(-load)) / load
    return max(1, math.ceil(math.log(MISS) / (math.ceil(containment * n) * math.log(1 - hit))))


def size_bits(n: int) -> int:
    """The partition of a document of ``n`` shingles, as the bits of its bins."""
    return max(1, (n * BINS_PER_SHINGLE - 1).bit_length())


class Items:
    """Sketches of items for each size partition, made when a document needs one."""

    def __init__(self, sets: list[np.ndarray], containment: float):
        self.sets, self.containment = sets, containment
        self.need = [math.ceil(containment * len(s) - 1e-9) for s in sets]
        self.runs = [repetitions(len(s), containment) if len(s) else 0 for s in sets]
        self.made: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def sketch(self, run: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted least hashes of all items of that run, and the item of each."""
        if (run, bits) not in self.made:
            mins = [least(np.sort(mixed(s, run + 1)), bits) if self.runs[i] > run else s[:0] for i, s in enumerate(self.sets)]
            flat, owner = np.concatenate([np.zeros(0, np.uint64), *mins]), np.repeat(np.arange(len(mins)), [len(m) for m in mins])
            order = np.argsort(flat, kind="stable")
            self.made[run, bits] = flat[order], owner[order]
        return self.made[run, bits]

    def inside(self, doc: np.ndarray) -> list[tuple[int, int]]:
        """Items contained in a document's sorted shingles, each with the number shared."""
        if not len(doc) or not self.sets:
            return []
        bits, candidates = size_bits(len(doc)), set()
        for run in range(max(self.runs, default=0)):
            flat, owner = self.sketch(run, bits)
            mine = least(np.sort(mixed(doc, run + 1)), bits)
            a = np.searchsorted(flat, mine, "left")
            hit = np.flatnonzero((a < len(flat)) & (flat[np.minimum(a, len(flat) - 1)] == mine)) if len(flat) else []
            for k in hit:
                b = np.searchsorted(flat, mine[k], "right")
                candidates.update(owner[a[k]:b].tolist())
        found = []
        for i in sorted(candidates):
            at = np.searchsorted(doc, self.sets[i])
            shared = int((doc[np.minimum(at, len(doc) - 1)] == self.sets[i]).sum())
            if shared >= self.need[i]:
                found.append((i, shared))
        return found


def find(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "leaks", containment: float = CONTAINMENT) -> DataFrame:
    """``df`` with the items that each whole text contains: id, shared shingles, shingles of the item.

    An item is contained if a document holds at least ``containment`` of its
    distinct five-word shingles.  An item of one to four words has one shingle of all
    its words, so it is found only where it is the whole document, never inside a
    longer one.  Items and texts without words are never found; equal rows among the
    items count once.  Items go to the tasks in blocks of
    bounded size, one pass over ``df`` for each block.
    """
    asked = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    kind = asked.schema["id"].dataType
    total = asked.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = total // BLOCK_BYTES + 1
    element = T.StructType([T.StructField("id", kind), T.StructField("shared", T.IntegerType()), T.StructField("of", T.IntegerType())])
    arrow = pa.list_(pa.struct([("id", to_arrow_type(kind)), ("shared", pa.int32()), ("of", pa.int32())]))
    columns = []
    for block in range(blocks):
        rows = sorted(asked.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect(), key=lambda r: (str(r["id"]), r["text"]))
        ids, texts = [r["id"] for r in rows], [r["text"] for r in rows]
        # Python's broadcast holds the block once on each machine, not in each task's closure.
        sent = df.sparkSession.sparkContext.broadcast((ids, texts))

        def make(sent=sent):
            names, texts = sent.value
            index = Items(shingles(pa.array(texts, pa.string())), containment)

            def work(part):
                rows = [[{"id": names[i], "shared": n, "of": len(index.sets[i])} for i, n in index.inside(doc)] for doc in shingles(filled(part, text))]
                return [pa.array(rows, arrow)]

            return work

        name = out if blocks == 1 else f"{out}__{block}"
        columns.append(name)
        df = add_columns(df, text, [T.StructField(name, T.ArrayType(element))], make)
    if blocks > 1:
        df = df.withColumn(out, F.concat(*columns)).drop(*columns)
    return df
