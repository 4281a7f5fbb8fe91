"""Documents with similar sets of word shingles: a chosen-path join.

Each distinct set stands for itself by tokens (place, least hash) of a MinHash
embedding.  A run splits the sets by sampled tokens: a bucket's path decides which
places are sampled, and sets that share a sampled token go on together.  Buckets
split until they are small and are then searched by brute force; runs repeat with
other samples until a pair at the threshold is missed less often than ``MISS``.
Sets that pass through buckets of many splits get further runs for the same.  In a
large bucket of near copies most sets agree with what the bucket has in common; they
are tied together there and go no further.  Candidates are verified with the exact sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from strataloom.llm.links import components, forest, grouped, in_block_pairs
from strataloom.llm.texts import add_columns, filled, mixed, shingles
from strataloom.session import materialise

SIMILARITY = 0.8
PLACES = 64
MISS = 1e-3
# Buckets up to this size are searched by brute force.
SMALL = 256
LEVELS = 6
# Splits that the first runs are counted for.
FEW_SPLITS = 3
# A pair is compared exactly within its group if its estimate is this close.
SLACK = 0.2
# A set leaves a large bucket if it agrees with its centre at so many places; all that
# agree with it nearly as often are then in its group, among them all its candidates.
LEAVE = 0.85
# Sets that a bucket's centre is taken from.
SAMPLE = 33
# Up to this size a group's sets are compared one by one, beyond as matrices.
FEW = 12
COLUMNS_AT_ONCE = 4096


def set_id(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def sketch(values: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The least hash of the set at each place, as 32 bits."""
    with np.errstate(over="ignore"):
        return ((values[None, :] * odd[:, None]).min(axis=1) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketched(df: DataFrame, text: str, places: int = PLACES) -> DataFrame:
    """``df`` with ``set`` (null without words) and ``tokens``, the set's embedding."""
    odd = mixed(np.arange(1, places + 1, dtype=np.uint64), 5) | np.uint64(1)

    def make():
        def work(part):
            sets = shingles(filled(part, text))
            return [
                pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([sketch(s, odd) if len(s) else None for s in sets], pa.list_(pa.int32())),
            ]

        return work

    return add_columns(df, text, [T.StructField("set", T.BinaryType()), T.StructField("tokens", T.ArrayType(T.IntegerType()))], make)


def missed(similarity: float, splits: int, runs: int, places: int = PLACES) -> float:
    """The chance that a pair at the threshold shares no bucket after ``splits`` splits.

    A split samples one place, and a second one so often that a pair at the
    threshold is expected in one bucket again.  The places at which a pair agrees
    are as many as chance has it.
    """
    second = 1 / similarity - 1

    def apart(agreement: float) -> float:
        with_ = 1.0
        for _ in range(splits):
            one = 1 - agreement * with_
            with_ = 1 - (1 - second) * one - second * one ** 2
        return 1 - with_

    chance = lambda k: math.comb(places, k) * similarity ** k * (1 - similarity) ** (places - k)
    return sum(chance(k) * apart(k / places) ** runs for k in range(places + 1))


def runs_for(similarity: float, miss: float, splits: int = LEVELS) -> int:
    """Runs after which a pair at the threshold is ``missed`` with ``miss`` at most."""
    if similarity >= 1:
        return 1
    runs = 1
    while missed(similarity, splits, runs) > miss:
        runs += 1
    return runs


def centres(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(centre, common): for each node the token that over half of a few sets have at each place.

    Where no token has so many there is none.  The few are those of least hashes.
    """
    way = Window.partitionBy("node").orderBy(F.xxhash64("set"), "set")
    few = rows.withColumn("nth", F.row_number().over(way)).where(F.col("nth") <= sample).groupBy("node").agg(F.collect_list("tokens").alias("few"))

    def run(batches):
        for batch in batches:
            common = []
            for own in batch.column(1).to_pylist():
                own = np.sort(np.array(own), axis=0)
                middle = own[len(own) // 2]  # whatever over half have is in the middle
                often = 2 * (own == middle).sum(axis=0) > len(own)
                common.append([t if o else None for t, o in zip(middle.tolist(), often.tolist())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(common, pa.list_(pa.int32()))], names=["centre", "common"])

    return few.mapInArrow(run, "centre long, common array<int>")


def settled(large: DataFrame, tokens: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Sets of large buckets that need not go on, as edges (a, b), and rows (node, set, tokens) of those that do.

    A set that agrees with its bucket's centre at ``LEAVE`` of the places leaves.
    Whatever agrees with it at ``similarity - SLACK`` of them, as candidates must,
    agrees with the centre at ``LEAVE + similarity - SLACK - 1`` at least: places add
    up.  All that do so are tied to one of them, so no candidate pair is lost, and a
    bucket of m sets gives m - 1 edges at most.
    """
    rows = materialise(large.select("node", "set").join(tokens, "set"), "large")
    judged = rows.join(centres(rows), F.col("node") == F.col("centre"))
    agree = F.size(F.filter(F.zip_with("tokens", "common", lambda x, y: x == y), lambda same: same))
    judged = materialise(judged.select("node", "set", "tokens", (agree / F.size("tokens")).alias("agree")), "judged")
    leaves = F.col("agree") >= LEAVE
    near = judged.where(F.col("agree") >= LEAVE + similarity - SLACK - 1 - 1e-9).select("node", "set", "agree")
    hubs = near.groupBy("node").agg(F.min("set").alias("hub"), F.max("agree").alias("most")).where(F.col("most") >= LEAVE)
    edges = near.join(hubs.select(F.col("node").alias("centre"), "hub"), F.col("node") == F.col("centre")).where("set <> hub")
    return edges.select(F.col("hub").alias("a"), F.col("set").alias("b")).distinct(), judged.where(~leaves).select("node", "set", "tokens")


def sized(level: DataFrame) -> DataFrame:
    """Rows of nodes that have several, with their number as ``size``; stored."""
    sizes = level.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return materialise(level.join(sizes, "node"), "paths")


def paths(reps: DataFrame, similarity: float, runs: range, small: int, places: int) -> tuple[DataFrame, DataFrame | None, list[DataFrame]]:
    """Rows (node, set, size), the small buckets in which the runs end; the sets of buckets
    split more than ``FEW_SPLITS`` times (None if no bucket was); edges found on the way."""
    second = int((1 / similarity - 1) * 1000)

    def split(df, path, level, *keep):
        sampled = lambda k: F.pmod(F.xxhash64(path, F.lit(level), F.lit(k)), F.lit(places)).cast("int")
        token = lambda k: F.xxhash64(path, F.lit(level), sampled(k), F.element_at("tokens", sampled(k) + 1))
        more = F.pmod(F.xxhash64(path, F.lit(level), F.lit(0)), F.lit(1000)) < second
        children = F.when(more & (sampled(1) != sampled(2)), F.array(token(1), token(2))).otherwise(F.array(token(1)))
        return df.select(F.explode(children).alias("node"), "set", *keep)

    level = split(reps.withColumn("run", F.explode(F.sequence(F.lit(runs[0]), F.lit(runs[-1])))), F.col("run"), 0)
    done, edges, deep = [], [], None
    for depth in range(1, LEVELS + 1):
        level = sized(materialise(level, "paths"))  # stored, so that rows are not split twice
        if depth == LEVELS:  # what is alike at so many places is one group; it is compared in blocks
            done.append(level)
            break
        done.append(level.where(F.col("size") <= small))
        large = level.where(F.col("size") > small)
        if not large.take(1):
            break
        if depth == 1:
            # Most of a dense group is still together here, and leaves before the splits.
            # The few that go on take their tokens along, joined once for all splits.
            tied, rest = settled(large, reps, similarity)
            edges.append(materialise(tied, "tied"))
            rest = sized(rest)
            done.append(rest.where(F.col("size") <= small))
            large = rest.where(F.col("size") > small)
        if depth == FEW_SPLITS:
            deep = large.select("set").distinct()
        level = split(large, F.col("node"), depth, "tokens")
    done = [d.select("node", "set", "size") for d in done]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out, deep, edges


def search(buckets: DataFrame, reps: DataFrame, least: float, small: int) -> DataFrame:
    """Edges (a, b): a forest of the pairs in each bucket whose estimate is ``least`` or more."""
    rows = in_block_pairs(buckets, ["node"], F.col("set"), F.col("size"), small).select("pair", "set").join(reps.select("set", "tokens"), "set")

    def work(table, groups):
        sets, tokens = table.column("set").combine_chunks(), table.column("tokens").combine_chunks()
        tokens = tokens.flatten().to_numpy().reshape(len(sets), -1)
        need = least * tokens.shape[1]
        a, b = [], []
        for start, end in groups:
            own = tokens[start:end]
            if end - start == 2:
                if (own[0] == own[1]).sum() >= need:
                    a.append(start), b.append(start + 1)
            elif end - start > 2:
                same = np.zeros((len(own), len(own)), np.int16)
                for place in range(own.shape[1]):
                    same += own[:, None, place] == own[None, :, place]
                root = forest(same >= need)
                at = np.flatnonzero(root != np.arange(len(own)))
                a += (start + root[at]).tolist()
                b += (start + at).tolist()
        yield pa.RecordBatch.from_arrays([sets.take(pa.array(a, pa.int64())), sets.take(pa.array(b, pa.int64()))], names=["a", "b"])

    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    return grouped(rows, "pair", schema, work).distinct()


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right."""
    if len(left) * len(right) <= FEW * FEW:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    universe = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(universe):
        return out.astype(np.int64)
    places = []
    for sets in (left, right):
        at = [np.minimum(np.searchsorted(universe, s), len(universe) - 1) for s in sets]
        places.append([p[universe[p] == s] for p, s in zip(at, sets)])
    for at in range(0, len(universe), COLUMNS_AT_ONCE):
        m = []
        for side in places:
            x = np.zeros((len(side), min(COLUMNS_AT_ONCE, len(universe) - at)), np.float32)
            for i, p in enumerate(side):
                lo, hi = np.searchsorted(p, [at, at + COLUMNS_AT_ONCE])
                x[i, p[lo:hi] - at] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return np.rint(out).astype(np.int64)


def compared(members: DataFrame, similarity: float) -> DataFrame:
    """Counts and a forest of the links within groups.

    ``members`` has ``text``, ``set``, ``copies``, ``root`` and ``size`` (of the
    group).  Rows: set, n (documents linked with it, in this pair of blocks), to (a
    set in the same component).
    """
    fields = [T.StructField("own", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))]

    def make():
        def work(part):
            sets = shingles(filled(part, "text"))
            return [pa.array([set_id(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]

        return work

    known = add_columns(members, "text", fields, make).where(F.col("own") == F.col("set"))
    rows = in_block_pairs(known, ["root"], F.col("set"), F.col("size")).select("pair", "left", "right", "set", "copies", "shingles")

    def work(table, groups):
        ids, copies = table.column("set").combine_chunks(), table.column("copies").to_numpy()
        lists = table.column("shingles").combine_chunks()
        flat, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        left, right = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("left", "right"))
        names, count, to = [], [], []
        for start, end in groups:
            seen: dict[bytes, int] = {}
            for i in range(start, end):  # a repeated document comes more than once
                seen.setdefault(ids[i].as_py(), i)
            rows = np.array(list(seen.values()))
            if len(rows) < 2:
                continue
            sets = {i: flat[offsets[i]:offsets[i + 1]] for i in rows.tolist()}
            x, y = rows[left[rows]], rows[right[rows]]
            if not len(x) or not len(y):
                continue
            both = shared([sets[i] for i in x.tolist()], [sets[i] for i in y.tolist()])
            nx, ny = np.array([len(sets[i]) for i in x.tolist()]), np.array([len(sets[i]) for i in y.tolist()])
            # In whole numbers, so that a pair exactly at the threshold is linked.
            linked = both * 1000 >= round(similarity * 1000) * (nx[:, None] + ny[None, :] - both)
            linked &= x[:, None] != y[None, :]
            place = {r: k for k, r in enumerate(rows.tolist())}
            px, py = np.array([place[i] for i in x.tolist()]), np.array([place[i] for i in y.tolist()])
            whole = np.zeros((len(rows), len(rows)), bool)
            whole[np.ix_(px, py)] |= linked
            whole |= whole.T.copy()
            root, n = forest(whole), whole @ copies[rows]
            names += rows.tolist()
            count += n.tolist()
            to += rows[root].tolist()
        take = lambda at: ids.take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([take(names), pa.array(count, pa.int64()), take(to)], names=["set", "n", "to"])

    schema = T.StructType([T.StructField("set", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("to", T.BinaryType())])
    return grouped(rows, "pair", schema, work)


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, miss: float = MISS, small: int = SMALL) -> DataFrame:
    """One row a document: ``doc_id``, ``class_id``, ``n_links``, ``kept``, ``set`` and ``root``.

    Two documents are linked if the Jaccard similarity of their sets of five-word
    shingles is ``similarity`` or more (three decimals count).  ``class_id`` is the
    least id reachable by links, ``n_links`` the number of documents linked
    directly, copies included, and ``kept`` marks the one document of each class.
    Null, empty and wordless texts link with nothing and are kept; a null id is
    larger than any other, and a class of null ids has a null class.  ``set`` names the
    document's set of shingles and ``root`` the class by one of its sets (both null
    without words): where an id is repeated with texts of one class, all these rows are
    ``kept``, and ``root`` tells them from others that have the same id only.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = materialise(sketched(base, "text").drop("text"), "sketches")
    reps = materialise(
        known.where("set IS NOT NULL").groupBy("set")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("tokens").alias("tokens")), "sets")
    # A pair is missed by the first runs if none keeps it together for few splits; a run
    # that does ends in a small bucket, or else both sets are deep and get all runs.
    first, last = runs_for(similarity, miss / 2, FEW_SPLITS), runs_for(similarity, miss / 2)
    tokens = reps.select("set", "tokens")
    buckets, deep, tied = paths(tokens, similarity, range(1, first + 1), small, PLACES)
    if deep is not None and last > first:
        deep = materialise(tokens.join(deep, "set"), "deep-sets")
        more, _, also = paths(deep, similarity, range(first + 1, last + 1), small, PLACES)
        buckets, tied = buckets.unionByName(more), tied + also
    edges = search(buckets, reps, similarity - SLACK, small)
    for t in tied:
        edges = edges.unionByName(t)
    loose = components(edges)
    sizes = loose.groupBy("root").agg(F.count("*").alias("size"))
    members = loose.select(F.col("node").alias("set"), "root").join(sizes, "root").join(reps.drop("tokens"), "set")
    texts = base.join(members, F.col("doc_id").eqNullSafe(F.col("first"))).drop("doc_id", "first")
    exact = materialise(compared(texts, similarity), "links")
    linked = exact.groupBy("set").agg(F.sum("n").alias("n"))
    groups = components(exact.select(F.col("set").alias("a"), F.col("to").alias("b")))
    rooted = reps.select("set", "first", "copies").join(groups.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    least = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    found = rooted.join(least, "root").join(linked, "set", "left").select("set", "root", "class_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    rows = known.select("doc_id", "set")
    alone = rows.where("set IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"),
                                                F.col("set"), F.col("set").alias("root"))
    linked_rows = rows.join(found, "set").select("doc_id", "class_id", "n_links", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"), "set", "root")
    return linked_rows.unionAll(alone)
