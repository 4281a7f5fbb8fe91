"""Which tokens of two vocabularies lie over the same bytes, counted over a corpus.

Text A is the text behind a space, cut by a byte-level vocabulary; text B is the text
cut by a sentence-piece model, which adds that space itself.  Byte offsets where
tokens of both end cut the tokens into groups, and tokens whose bytes overlap are
linked.  An id of A and the id of B with the same bytes are the *identity* pair of
that id: how many documents hold it is counted in vectors as long as the vocabulary,
one a task.  Only other pairs are shuffled, each once for a block of documents.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.llm.pieces import MARK, load
from strataloom.llm.texts import column, filled, lists, parts
from strataloom.session import materialise

# A space behind a character that is no white space ends a token of both vocabularies.
CUT = re.compile(r" (?<=\S )")
# A block's text, in bytes; a longer document is a block of its own.
BLOCK_BYTES = 2 * 1024 * 1024
# A task's table of distinct stretches is emptied between blocks beyond this.
TABLE_STRETCHES = 250_000
TABLE_CHARS = 8_000_000
AT_ONCE = 4000


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Printable Latin-1 signs are themselves, the other bytes are numbered from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, left: str, right: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(left)
        self.a.encode_special_tokens = True
        signs, names = byte_signs(), self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * max(self.a.get_vocab_size(), max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(signs[c] for c in name)
        self.b = load(right)
        ids = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
                        else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        # A byte's own piece is used only where no other has these bytes.
        same = {v: i for i, v in reversed([*enumerate(self.b_bytes)]) if self.b.is_byte(i)}
        same |= {v: i for i, v in reversed([*enumerate(self.b_bytes)]) if v and not self.b.is_byte(i)}
        self.identity = np.array([same.get(v, -1) if v else -1 for v in self.a_bytes], np.int64)
        self.a_sizes, self.b_sizes = (np.array([len(v) for v in x]) for x in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        # A marker at a text's end is a stretch without anything behind it.
        self.single = self.b.encode("a ")[len(self.b.encode("a")):]

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A of each stretch behind a space, and of B."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)]
        b = self.b.encode(stretches, num_threads=1)
        return a, [x if s else self.single for s, x in zip(stretches, b)]


class Table:
    """What is known of each distinct stretch: sizes, groups as text, links."""

    def __init__(self, words: Vocabularies):
        self.words = words
        self.clear()

    def clear(self):
        self.at: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.chars = 0
        self.sizes = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.valid = np.zeros(0, bool)
        self.offsets = np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)  # a << 32 | b

    def learn(self, stretches: list[str]) -> None:
        for at in range(0, len(stretches), AT_ONCE):
            self._learn(stretches[at:at + AT_ONCE])

    def _learn(self, stretches: list[str]) -> None:
        w = self.words
        a, b = w.encode(stretches)
        good = []
        for s, x, y in zip(stretches, a, b):
            raw = b" " + s.encode()
            good.append(b"".join(map(w.a_bytes.__getitem__, x)) == raw == b"".join(map(w.b_bytes.__getitem__, y)))
        good = np.array(good)
        n_a, n_b = (np.where(good, [len(i) for i in ids], 0) for ids in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(i for i, g in zip(ids, good) if g), np.int64) for ids in (a, b))
        # All stretches behind one another have the same bytes in A and B.
        ends_a, ends_b = np.cumsum(w.a_sizes[flat_a]), np.cumsum(w.b_sizes[flat_b])
        ends = np.union1d(ends_a, ends_b)
        links = flat_a[np.searchsorted(ends_a, ends)] << 32 | flat_b[np.searchsorted(ends_b, ends)]
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        whole = ends_a[np.cumsum(n_a)[good] - 1] if good.any() else np.zeros(0, np.int64)  # where stretches end
        n_links, n_groups = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        n_links[good] = np.diff(np.searchsorted(ends, whole, "right"), prepend=0)
        n_groups[good] = np.diff(np.searchsorted(both, whole, "right"), prepend=0)
        names_a, names_b = ([n[i] for i in ids.tolist()] for n, ids in ((w.a_names, flat_a), (w.b_names, flat_b)))
        cut_a, cut_b = ([0, *np.searchsorted(e, both, "right").tolist()] for e in (ends_a, ends_b))
        texts = [",".join(names_a[i:j]) + "|" + ",".join(names_b[k:m]) for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        last = np.cumsum(n_groups).tolist()
        self.groups += [";".join(texts[e - n:e]) if g else None for e, n, g in zip(last, n_groups.tolist(), good.tolist())]
        for s in stretches:
            self.at[s] = len(self.at)
            self.chars += len(s)
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, n_groups], axis=1)])
        self.valid = np.concatenate([self.valid, good])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(n_links)])
        self.links = np.concatenate([self.links, links])


def totals(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of stretches of whole numbers."""
    run = np.concatenate([[0], np.cumsum(values)])
    return run[offsets[1:]] - run[offsets[:-1]]


def aligned(table: Table, texts: list[str]) -> dict:
    """Documents of a block: sizes, groups, and the pairs they hold.

    ``pairs`` has the distinct pairs of the block that are no identity pairs, and in
    how many documents each is; ``at`` and ``times`` say for each document which of
    them it holds, and how often; ``own`` and ``own_times`` do so for identity pairs
    by their id of A.
    """
    if len(table.at) > TABLE_STRETCHES or table.chars > TABLE_CHARS:
        table.clear()
    split = [CUT.split(t) if t else [] for t in texts]
    flat = [*chain.from_iterable(split)]
    table.learn([*dict.fromkeys(s for s in flat if s not in table.at)])
    index = np.fromiter(map(table.at.__getitem__, flat), np.int64, len(flat))
    counts = np.array([len(s) for s in split])
    offsets = np.concatenate([[0], np.cumsum(counts)])
    bad = totals(~table.valid[index], offsets) > 0
    sizes = np.stack([totals(table.sizes[index, k], offsets) for k in range(3)], axis=1)
    sizes[bad] = 0
    names = table.groups
    groups = ["" if b else ";".join([names[i] for i in index[s:e].tolist()]) for b, s, e in zip(bad.tolist(), offsets[:-1].tolist(), offsets[1:].tolist())]

    # Each document's distinct stretches, then its distinct pairs.
    owner = np.repeat(np.arange(len(texts)), counts)
    live = ~bad[owner]
    keys, times = np.unique(owner[live] * max(len(table.at), 1) + index[live], return_counts=True)
    owner, index = np.divmod(keys, max(len(table.at), 1))
    n = table.offsets[index + 1] - table.offsets[index]
    place = np.repeat(table.offsets[index] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n) + np.arange(n.sum())
    codes, which = np.unique(table.links[place], return_inverse=True)
    keys, back = np.unique(np.repeat(owner, n) * max(len(codes), 1) + which, return_inverse=True)
    times = np.bincount(back, weights=np.repeat(times, n), minlength=len(keys)).astype(np.int64)
    owner, which = np.divmod(keys, max(len(codes), 1))
    a, b = codes >> 32, codes & 0xFFFFFFFF
    same = table.words.identity[a] == b
    held = np.bincount(which, minlength=len(codes))
    number = np.cumsum(~same) - 1  # of pairs that are shuffled
    own = same[which]
    per = lambda of: np.bincount(owner[of], minlength=len(texts))
    return {
        "sizes": sizes, "groups": groups, "pairs": (a[~same], b[~same], held[~same]), "identity": (a[same], held[same]),
        "at": (number[which[~own]], per(~own)), "times": (times[~own], per(~own)),
        "own": (a[which[own]], per(own)), "own_times": (times[own], per(own)),
    }


@dataclass
class Alignment:
    """``documents``: the given columns but for the text, n_a, n_b, n_groups, n_links,
    n_best, count_sum and the extra columns; ``pairs``: all linked pairs of ids (a, b)
    and the number n of documents that hold each."""

    documents: DataFrame
    pairs: DataFrame


INTS = T.ArrayType(T.IntegerType())
PAIRS = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())]))
SIZES = ("n_a", "n_b", "n_groups")


def align(docs: DataFrame, left: str, right: str, text: str = "text", extra: list[Column] | None = None) -> Alignment:
    """Aligns the tokens of each whole text in vocabularies A (``left``) and B (``right``).

    A text that is null or empty, or that one of them does not keep byte for byte, has
    no tokens: its numbers are 0 and its ``groups`` are empty.  ``extra`` are columns
    made from ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order) and ``row`` (a struct of
    the given columns); unless given, ``groups`` itself.  Equal rows are documents of
    their own.  Columns of ``docs`` with the name of a new one are replaced by it.
    """
    extra = [F.col("groups")] if extra is None else extra
    quoted = lambda c: F.col(f"`{c}`")
    others = [c for c in docs.columns if c.lower() != text.lower()]
    base = docs.select(F.struct(*[quoted(c) for c in others], F.lit(True).alias("_row")).alias("row"), quoted(text).alias("text"))
    fields = [base.schema["row"], T.StructField("block", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in SIZES],
              T.StructField("groups", T.StringType()), *[T.StructField(c, INTS) for c in ("at", "times", "own", "own_times")],
              T.StructField("pairs", PAIRS), T.StructField("held", T.ArrayType(T.LongType()))]
    fields = [T.StructField(f.name, f.dataType, True) for f in fields]
    names = [f.name for f in fields]

    def run(batches):
        words = Vocabularies(left, right)
        table, vector, kinds = Table(words), np.zeros(len(words.identity), np.int64), None

        def batch_of(n, **given):
            return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(n, kinds[c]) for c in names], names=names)

        for batch in batches:
            kinds = kinds or {
                "row": batch.schema.field("row").type, "block": pa.binary(), **dict.fromkeys(SIZES, pa.int64()), "groups": pa.string(),
                **dict.fromkeys(("at", "times", "own", "own_times"), pa.list_(pa.int32())), "held": pa.list_(pa.int64()),
                "pairs": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))}
            for part in parts(batch, "text", BLOCK_BYTES):
                found, block, n = aligned(table, filled(part, "text").to_pylist()), uuid.uuid4().bytes, part.num_rows
                vector[found["identity"][0]] += found["identity"][1]
                yield batch_of(
                    n, row=column(part, "row"), block=pa.array([block] * n, pa.binary()), groups=pa.array(found["groups"], pa.string()),
                    **{c: pa.array(found["sizes"][:, k]) for k, c in enumerate(SIZES)},
                    **{c: lists(found[c][0].astype(np.int32), found[c][1], pa.int32()) for c in ("at", "times", "own", "own_times")})
                a, b, held = found["pairs"]
                if len(a):
                    values = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(held)], names=["a", "b", "n"])
                    yield batch_of(1, block=pa.array([block], pa.binary()), pairs=pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), values))
        if vector.any():
            yield batch_of(1, held=lists(vector, [len(vector)], pa.int64()))

    mapped = base.mapInArrow(run, T.StructType(fields))
    known = [c for c in names if c != "groups"]
    stored = materialise(mapped.select(*known, *extra), "alignment")
    added = [c for c in stored.columns if c not in known]

    # How many documents hold each pair: identity pairs by vectors, others by block.
    shuffled = stored.where("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("at", "pair")).select("block", "at", "pair.*")
    counts = materialise(shuffled.groupBy("a", "b").agg(F.sum("n").alias("n")), "pair-counts")
    held = stored.where("held IS NOT NULL").select(F.posexplode("held").alias("a", "n")).where("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    identity = Vocabularies(left, right).identity
    same, best = np.zeros(len(identity), np.int64), np.zeros(len(identity), np.int64)
    # Both have a row for each id of A at most.
    for vector, rows in ((same, held.collect()), (best, counts.groupBy("a").agg(F.max("n").alias("n")).collect())):
        for r in rows:
            vector[r["a"]] = r["n"]
    best = np.maximum(same, best)

    back = shuffled.select("block", "at", "a", "b").join(counts, ["a", "b"]).select(F.col("block").alias("of"), "at", "a", "n")
    rows = stored.where("n_a IS NOT NULL").drop("pairs", "held")
    out = [T.StructField("row", stored.schema["row"].dataType), *[T.StructField(c, T.LongType()) for c in (*SIZES, "n_links", "n_best", "count_sum")],
           *[stored.schema[c] for c in added]]
    out_names = [f.name for f in out]

    def counted(documents, pairs):
        order = np.argsort(pairs["at"].to_numpy())
        n, of = pairs["n"].to_numpy()[order], pairs["a"].to_numpy()[order]
        top = (n == best[of]).astype(np.int64)
        sums = np.zeros((2, documents.num_rows), np.int64)
        for at, times, value, hit in (("at", "times", n, top), ("own", "own_times", same, (same == best).astype(np.int64))):
            at, times = documents[at].combine_chunks(), documents[times].combine_chunks()
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(at).to_numpy(zero_copy_only=False))]).astype(np.int64)
            at, times = at.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            sums[0] += totals(times * hit[at], offsets)
            sums[1] += totals(times * value[at], offsets)
        a, b, groups = (documents[c].to_numpy() for c in SIZES)
        new = {"n_links": a + b - groups, "n_best": sums[0], "count_sum": sums[1]}
        return pa.table([pa.array(new[c]) if c in new else documents[c] for c in out_names], names=out_names)

    done = rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(counted, T.StructType(out))
    new = {c.lower() for c in out_names}
    documents = done.select(*[F.col(f"row.`{c}`") for c in others if c.lower() not in new], *out_names[1:])
    return Alignment(documents, counts.unionByName(same_pairs(stored.sparkSession, identity, same)))


def same_pairs(spark, identity: np.ndarray, same: np.ndarray) -> DataFrame:
    """The identity pairs that occur, as rows (a, b, n)."""
    at = np.flatnonzero(same)
    return spark.createDataFrame([(int(a), int(identity[a]), int(same[a])) for a in at], "a int, b int, n long")
