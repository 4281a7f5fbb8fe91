"""Removing long byte strings that occur more than once, by suffix grouping.

Any repeated string of ``length`` bytes contains, in all its copies at the same
offset, the least hash of its runs of ``GRAM`` bytes.  Places with such a least hash
(*anchors*) whose run occurs once are settled, and so are those whose surroundings
occur again as a whole.  For the others a *block* is a few neighbouring strings
around one anchor: all contain the block's *core*, and differ in the bytes before
and after it.  Equal cores become one symbol, so a string of ``length`` bytes is one
of ``STRIDE`` + 1 symbols, and the suffixes of all blocks with shared cores are
sorted together to find the strings that occur again.

The suffix order comes from a linear construction without recursion: suffixes are
grouped by their Lyndon prefixes, from the largest group to the smallest, through
pointers to the previous smaller suffix; then the groups are emitted in order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from strataloom.llm.links import grouped
from strataloom.llm.texts import column, filled, mixed, parts
from strataloom.session import materialise

LENGTH = 400
GRAM = 64
STRIDE = 31
# Distinct blocks of one core that are sorted together; more are compared by the
# hash of each string.
TOGETHER = 2048
# Symbols in one suffix order.
SYMBOLS = 100_000


def suffix_order(text: list[int]) -> list[int]:
    """The suffixes of ``text`` in order, by grouping in linear time."""
    n = len(text)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    # Groups as lists of suffixes in text order, linked from small to large.  A
    # suffix that has moved on stays in its old list, and is skipped there.
    members = [by_symbol[c] for c in sorted(by_symbol)]
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    group = [0] * n
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    # Groups are compared through ``done``: a suffix of a finished group or of the
    # present one lies above every other.
    done = [False] * len(members)
    previous = [-1] * n
    order: list[list[int]] = []
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        done[g] = True
        order.append(own)
        reached: list[int] = []
        times: list[int] = []
        for i in own:
            j = i - 1
            while j >= 0 and done[group[j]]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                if reached and reached[-1] == j:
                    times[-1] += 1
                else:
                    reached.append(j)
                    times.append(1)
        # Those reached grow by this group's prefix, as often as they were reached,
        # and move to new groups right above their own.
        new: dict[tuple[int, int], int] = {}
        for j, k in sorted(zip(reached, times), key=lambda x: -x[1]) if len(set(times)) > 1 else zip(reached, times):
            key = (group[j], k)
            h = new.get(key)
            if h is None:
                old = group[j]
                h = new[key] = len(members)
                members.append([])
                done.append(False)
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = h
                if up >= 0:
                    below[up] = h
            members[h].append(j)
            group[j] = h
        g = below[g]
    at = [0] * len(members)
    start = 0
    for own in reversed(order):
        if own:
            at[group[own[0]]] = start
            start += len(own)
    result = [-1] * n
    placed = [False] * n
    # The end of the text comes before every suffix; each suffix emitted places those
    # that it is the next smaller part of.
    k = -1
    while k < n:
        j = (n if k < 0 else result[k]) - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            result[at[g]] = j
            at[g] += 1
            placed[j] = True
            j = previous[j]
        k += 1
    return result


def same_run(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For suffixes in order, whether each begins with the ``length`` symbols of the one before."""
    ends = np.concatenate([symbols, np.full(length, -1, symbols.dtype)])
    equal = np.ones(len(order) - 1, bool)
    for k in range(length):
        equal &= ends[order[1:] + k] == ends[order[:-1] + k]
    return equal


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the run of ``gram`` bytes (a power of two) from each place on."""
    with np.errstate(over="ignore"):
        h = mixed(data.astype(np.uint64) + np.uint64(1))
        factor, width = np.uint64(0x9E3779B97F4A7C15), 1
        while width < gram:
            h = h[:-width] * factor + h[width:]
            factor *= factor
            width *= 2
    return mixed(h)


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or largest) of every ``width`` values in a row."""
    pick, done = (np.minimum if least else np.maximum), 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: place, hash, and the first and last string each stands for.

    Each string's anchor is the last place in it with the least hash.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none
    h = gram_hashes(data, gram)
    width = length - gram + 1
    least = sliding(h, width, True)
    # A place is an anchor of some string if its hash is the least of one: the largest
    # of the least hashes around it.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    place = np.flatnonzero(sliding(padded, width, False) == h)
    value = h[place]
    while True:
        # The next anchor takes over when it comes in sight, if its hash is as small,
        # or else when this one is left behind.
        first = np.concatenate([[0], np.where(value[1:] <= value[:-1], place[1:] - width + 1, place[:-1] + 1)])
        first = np.maximum(first, 0)
        last = np.concatenate([first[1:] - 1, [n - length]])
        good = last >= first
        if good.all():
            return place, value, first, last
        # Of equal hashes some are never the last in sight; their neighbours meet.
        place, value = place[good], value[good]


def text_key(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


def survey(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors of all texts: rows (key, place, gram, around, first, last), each text once a batch."""

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                texts = filled(part, "text").cast(pa.binary())
                seen, out = set(), []
                for value in texts:
                    raw = value.as_py()
                    key = text_key(raw)
                    if len(raw) < length or key in seen:
                        continue
                    seen.add(key)
                    place, value, first, last = anchors(np.frombuffer(raw, np.uint8), length, gram)
                    around = [xxhash.xxh3_64_intdigest(raw[f:e + length], p - f) for p, f, e in zip(place.tolist(), first.tolist(), last.tolist())]
                    out.append((key, place, value, np.array(around, np.uint64), first, last))
                if out:
                    sizes = [len(o[1]) for o in out]
                    keys = pa.array([o[0] for o in out], pa.binary()).take(pa.array(np.repeat(np.arange(len(out)), sizes)))
                    flat = [np.concatenate([o[i] for o in out]) for i in range(1, 6)]
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(flat[0].astype(np.int32)), pa.array(flat[1].view(np.int64)), pa.array(flat[2].view(np.int64)),
                         pa.array(flat[3].astype(np.int32)), pa.array(flat[4].astype(np.int32))],
                        names=["key", "place", "gram", "around", "first", "last"])

    return docs.select("text").mapInArrow(run, "key binary, place int, gram long, around long, first int, last int")


BLOCKS = "core binary, before binary, after binary, key binary, start int"


def cut_blocks(texts: DataFrame, length: int, stride: int) -> DataFrame:
    """Blocks of the texts' open anchors (``open``: place, first, last).

    Block ``b`` of an anchor holds the strings that begin ``b * stride`` to
    ``b * stride + stride - 1`` bytes before it.  ``before`` are the bytes ahead of
    the core, ``after`` those behind it, as far as the text goes; ``start`` is where
    ``before`` would begin if it had ``stride - 1`` bytes.
    """

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                raws = filled(part, "text").cast(pa.binary())
                out = []
                for raw, key, found in zip(raws, column(part, "key"), column(part, "open")):
                    raw, key = raw.as_py(), key.as_py()
                    if text_key(raw) != key:
                        continue  # another text under the same id
                    n = len(raw)
                    for a in found.as_py():
                        p = a["place"]
                        for b in range((p - a["last"]) // stride, (p - a["first"]) // stride + 1):
                            # The core begins with the block's last string and ends with its first.
                            begin, end = p - b * stride, p - b * stride - (stride - 1) + length
                            if begin < 0 or end > n:
                                continue
                            low, high = max(0, begin - (stride - 1)), min(n, end + stride - 1)
                            core = xxhash.xxh3_128_digest(raw[begin:end], b)
                            out.append((core, raw[low:begin], raw[end:high], key, begin - (stride - 1)))
                if out:
                    kinds = [pa.binary()] * 4 + [pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["core", "before", "after", "key", "start"])

    return texts.mapInArrow(run, BLOCKS)


def sorted_blocks(blocks: DataFrame, stride: int) -> DataFrame:
    """Strings of distinct blocks that occur again; rows (core, before, after, runs).

    A run has the offsets of its first and last string from the first of the block.
    """

    def order(cores, before, after, rows):
        # Symbols: 0 to 255 are bytes, then one for each core, then separators.
        names: dict[bytes, int] = {}
        symbols, owner, offset = [], [], []
        for r in rows:
            core = names.setdefault(cores[r], 256 + len(names))
            symbols += [*before[r], core, *after[r], -1]
            size = len(before[r]) + 1 + len(after[r])
            owner += [r] * (size + 1)
            offset += range(stride - 1 - len(before[r]), stride - len(before[r]) + size)
        top, k = 256 + len(names), 0
        for i, s in enumerate(symbols):
            if s < 0:
                symbols[i] = top + k
                k += 1
        data, owner, offset = np.array(symbols), np.array(owner), np.array(offset)
        sa = np.array(suffix_order(symbols))
        same = same_run(data, sa, stride)
        hit = np.zeros(len(sa), bool)
        hit[:-1] |= same
        hit[1:] |= same
        at = sa[hit]
        # A string begins before the core or with it.
        at = at[offset[at] < stride]
        return owner[at], offset[at]

    def work(table, groups):
        cores, before, after = (table.column(c).to_pylist() for c in ("core", "before", "after"))
        owners, offsets, rows, size = [], [], [], 0
        for k, (s, e) in enumerate(groups):
            if e - s > 1:
                rows += range(s, e)
                size += (e - s) * 2 * stride
            if rows and (size >= SYMBOLS or k + 1 == len(groups)):
                o, f = order(cores, before, after, rows)
                owners.append(o), offsets.append(f)
                rows, size = [], 0
        if owners:
            owner, offset = np.concatenate(owners), np.concatenate(offsets)
            place = np.lexsort((offset, owner))
            owner, offset = owner[place], offset[place]
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])[:len(owner)]
            own, first, last = owner[new], offset[new], offset[np.concatenate([new[1:], [True]])[:len(owner)]]
            own, counts = np.unique(own, return_counts=True)
            take = pa.array(own)
            runs = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (first, last)], names=["first", "last"])
            yield pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks().take(take) for c in ("core", "before", "after")]
                + [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), runs)],
                names=["core", "before", "after", "runs"])

    schema = "core binary, before binary, after binary, runs array<struct<first:int,last:int>>"
    return grouped(blocks.select("core", "before", "after"), "core", schema, work)


def hashed_blocks(blocks: DataFrame, stride: int) -> DataFrame:
    """The same for cores with very many blocks: each string is counted by its content."""
    size = stride - 1
    spots = F.filter(F.sequence(F.lit(0), F.lit(size)), lambda i: (F.lit(size) - i <= F.length("before")) & (i <= F.length("after")))
    rows = blocks.select("core", "before", "after", F.explode(spots).alias("offset"))
    head = F.expr(f"substring(before, length(before) - ({size} - offset) + 1, {size} - offset)")
    tail = F.expr("substring(after, 1, offset)")
    rows = rows.withColumn("string", F.unhex(F.md5(F.concat(F.col("core"), head, tail)))).withColumn("block", F.xxhash64("before", "after"))
    again = rows.groupBy("string", "offset").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(again, ["string", "offset"]).groupBy("core", "before", "after").agg(
        F.collect_list(F.struct(F.col("offset").alias("first"), F.col("offset").alias("last"))).alias("runs"))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, stride: int = STRIDE, extra: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Removed spans of every distinct text: (known, found).

    ``known`` has a row a document: doc_id, key (of the text), n_bytes, and ``extra``
    columns made from doc_id and text.  ``found`` has a row for each text with something
    to remove: key, first (least id with it), whole (all bytes go), spans (maximal runs
    as start and end in bytes, in order).  Null is the empty text; equal rows are
    documents of their own, and so repeat each other.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    raw = F.coalesce("text", F.lit("")).cast("binary")
    known = materialise(base.select(
        "doc_id", F.unhex(F.md5(raw)).alias("key"), F.octet_length(raw).cast("long").alias("n_bytes"), *(extra or [])), "texts")
    texts = materialise(known.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes")), "texts")
    whole = texts.where((F.col("copies") > 1) & (F.col("n_bytes") >= length))

    # Anchors by their gram, and by what is around them.
    marks = materialise(survey(base, length, gram), "anchors")
    spot = F.struct("key", "place", "first", "last")
    zones = marks.groupBy("gram", "around").agg(F.min(spot).alias("low"), F.max(spot).alias("high"))
    zones = zones.select("gram", "around", (F.col("low") != F.col("high")).alias("again"), "low")
    zones = materialise(zones, "zones")
    grams = materialise(zones.groupBy("gram").agg(F.count("*").alias("n"), F.min("again").alias("settled")).where("n > 1 AND NOT settled").select("gram"), "grams")

    single = texts.where("copies = 1").select("key")
    # Whole surroundings that occur again.
    settled = marks.join(zones.where("again").select("gram", "around"), ["gram", "around"]).join(single, "key", "left_semi")
    settled = settled.select("key", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    # Others that share a gram with different surroundings; of equal ones the first stands for all.
    opened = zones.join(grams, "gram").groupBy(F.col("low.key").alias("key")).agg(
        F.collect_list(F.struct("low.place", "low.first", "low.last")).alias("open"))
    where = opened.join(texts.select("key", F.col("first").alias("at")), "key")
    held = base.join(where, F.col("doc_id").eqNullSafe(F.col("at"))).select("key", "open", "text")
    blocks = materialise(cut_blocks(held, length, stride), "blocks")

    spot = F.struct("key", "start")
    distinct = blocks.groupBy("core", "before", "after").agg(F.min(spot).alias("low"), F.max(spot).alias("high"))
    distinct = materialise(distinct.select("core", "before", "after", (F.col("low") != F.col("high")).alias("several")), "blocks")
    cores = distinct.groupBy("core").agg(F.count("*").alias("n"))
    few = distinct.join(cores.where((F.col("n") > 1) & (F.col("n") <= TOGETHER)).select("core"), "core")
    many = distinct.join(cores.where(F.col("n") > TOGETHER).select("core"), "core")
    # All strings of a block that occurs at several places, if the text has room for any.
    all_of_it = F.struct((F.lit(stride - 1) - F.length("before")).alias("first"), F.length("after").alias("last"))
    alike = distinct.where("several").select("core", "before", "after", F.array(all_of_it).alias("runs"))
    hits = materialise(sorted_blocks(few, stride).unionByName(hashed_blocks(many, stride)).unionByName(alike), "hits")
    partial = blocks.join(hits, ["core", "before", "after"]).select("key", F.explode("runs").alias("run"), "start").where("run.first <= run.last")
    partial = partial.select("key", (F.col("start") + F.col("run.first")).alias("start"), (F.col("start") + F.col("run.last") + length).alias("end"))

    merged = merge(settled.unionByName(partial))
    found = merged.join(texts.select("key", "first"), "key").join(whole.select("key"), "key", "left_anti").select("key", "first", F.lit(False).alias("whole"), "spans")
    full = whole.select("key", "first", F.lit(True).alias("whole"), F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end"))).alias("spans"))
    return known, materialise(found.unionByName(full), "spans")


def merge(stretches: DataFrame) -> DataFrame:
    """Maximal runs of (key, start, end) stretches that overlap or touch."""
    way = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(way.rowsBetween(Window.unboundedPreceding, -1))
    begun = stretches.distinct().withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = begun.withColumn("run", F.sum("new").over(way)).groupBy("key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def kept(docs: DataFrame, found: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The remaining bytes of each distinct text of ``found``: (key, kept)."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = base.join(found.where("NOT whole").select("key", "first", "spans"), F.col("doc_id").eqNullSafe(F.col("first"))).select("key", "spans", "text")

    def run(batches):
        for batch in batches:
            keys, rests = [], []
            for raw, key, own in zip(filled(batch, "text").cast(pa.binary()), column(batch, "key"), column(batch, "spans")):
                raw, at, rest = raw.as_py(), 0, []
                if text_key(raw) != key.as_py():
                    continue
                for s in own.as_py():
                    rest.append(raw[at:s["start"]])
                    at = s["end"]
                keys.append(key.as_py())
                rests.append(b"".join([*rest, raw[at:]]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(rests, pa.binary())], names=["key", "kept"])

    rest = held.mapInArrow(run, "key binary, kept binary").dropDuplicates(["key"])
    return rest.unionByName(found.where("whole").select("key", F.lit(b"").alias("kept")))
