"""Quality by attention over passages: multiple-instance learning from document labels.

A text is cut into passages of equal length.  Each passage is described by how often
kinds of characters follow one another, and encoded by a learned layer; a gated
attention, learned from the documents' labels alone, weighs the passages; the
weighted sum of their codes is what is scored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.llm.texts import add_columns, column, filled, lists, parts
from strataloom.session import materialise

PASSAGE = 512
FEATURES = 256
CODES, GATES = 24, 12
# Bounds of the sample that is learned from: documents, and passages in all of them.
SAMPLE_DOCUMENTS = 4096
SAMPLE_PASSAGES = 49_152
STEPS, RATE, DECAY = 250, 0.02, 1e-4
SEED = 20240817
# Characters described at once.
SLICE = 512 * PASSAGE

# Kinds of characters: ASCII signs stand for themselves, others by category.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KINDS = 12 + len(SIGNS)
_KIND = None


def kind_table() -> np.ndarray:
    """The kind of each code point."""
    global _KIND
    if _KIND is None:
        by = {"Ll": 1, "Lu": 2, "Lt": 2, "Lo": 3, "Lm": 3, "Nd": 4, "Zs": 5, "Mn": 6, "Mc": 6, "Sm": 7, "Sc": 7, "So": 8, "Cc": 10, "Cf": 10}
        _KIND = np.fromiter((by.get(unicodedata.category(chr(c)), 9) for c in range(0x110000)), np.uint8, 0x110000)
        _KIND[[10, 13]] = 11
        for i, sign in enumerate(SIGNS):
            _KIND[ord(sign)] = 12 + i
    return _KIND


def feature_of() -> np.ndarray:
    """The feature of each pair of kinds: common pairs of letters and spaces have their own."""
    return np.random.Generator(np.random.PCG64(SEED)).permutation(KINDS * KINDS) % FEATURES


def slices(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
    """Stretches of whole passages, a few at once, and the text each is from.

    An empty text has one empty stretch.
    """
    held, of, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t), 1), SLICE):
            piece = t[at:at + SLICE]
            if held and size + len(piece) > SLICE:
                yield held, of
                held, of, size = [], [], 0
            held.append(piece)
            of.append(i)
            size += len(piece)
    if held:
        yield held, of


def described(pieces: list[str], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row of pair counts for each passage of the stretches, and each one's number of passages."""
    sizes = np.array([len(p) for p in pieces])
    counts = np.maximum(1, -(-sizes // PASSAGE))
    kinds = kind_table()[np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)].astype(np.int32)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(np.cumsum(counts) - counts, sizes) + (np.arange(len(kinds)) - starts) // PASSAGE
    within = passage[1:] == passage[:-1]
    cells = passage[:-1][within] * FEATURES + which[kinds[:-1] * KINDS + kinds[1:]][within]
    return np.bincount(cells, minlength=counts.sum() * FEATURES).reshape(-1, FEATURES).astype(np.uint16), counts


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares, so that rare pairs count and lengths do not."""
    x = counts.astype(np.float32)
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1)) * 4


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights by name, or ``prior`` alone if there was nothing to tell labels apart by."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def coded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of passages, and their attention before it is shared out."""
        w = self.weights
        h = np.tanh(x @ w["W"] + w["b"])
        return h, (np.tanh(h @ w["V"] + w["v"]) * sigmoid(h @ w["U"] + w["u"])) @ w["a"]

    def pooled(self, h: np.ndarray, e: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents, and the share of each passage in its document."""
        starts = np.cumsum(counts) - counts
        share = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        share /= np.repeat(np.add.reduceat(share, starts), counts)
        z = np.add.reduceat(h * share[:, None], starts, axis=0)
        return sigmoid(z @ self.weights["c"] + self.weights["d"]), share


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = RATE) -> Model:
    """Learns from documents in order: passages ``x``, passages a document, labels 0 or 1."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(set(y.tolist())) < 2:
        return Model(prior)
    rng = np.random.Generator(np.random.PCG64(SEED))
    new = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"W": new(FEATURES, CODES), "b": np.zeros(CODES, np.float32), "V": new(CODES, GATES), "v": np.zeros(GATES, np.float32),
         "U": new(CODES, GATES), "u": np.zeros(GATES, np.float32), "a": new(GATES), "c": new(CODES),
         "d": np.array(np.log(prior / (1 - prior)), np.float32)}
    model, starts = Model(prior, w), np.cumsum(counts) - counts
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    spread = lambda v: np.repeat(v, counts, axis=0)
    for step in range(1, steps + 1):
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"] + w["v"]), sigmoid(h @ w["U"] + w["u"])
        p, share = model.pooled(h, (t * g) @ w["a"], counts)
        ds = ((p - y) / len(y)).astype(np.float32)
        z = np.add.reduceat(h * share[:, None], starts, axis=0)
        dz = spread(ds)[:, None] * w["c"]
        dshare = (dz * h).sum(axis=1)
        de = share * (dshare - spread(np.add.reduceat(share * dshare, starts)))
        dt, dg = de[:, None] * w["a"] * g * (1 - t * t), de[:, None] * w["a"] * t * g * (1 - g)
        dh = (share[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        slope = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "v": dt.sum(0), "U": h.T @ dg, "u": dg.sum(0),
                 "a": (t * g).T @ de, "c": z.T @ ds, "d": ds.sum()}
        for k in w:
            s = slope[k] + DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * s
            second[k] = 0.999 * second[k] + 0.001 * s * s
            w[k] -= (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          documents: int = SAMPLE_DOCUMENTS, passages: int = SAMPLE_PASSAGES) -> Model:
    """A model learned from at most ``documents`` labelled rows with ``passages`` passages in all.

    The sample is that of least hashes.  A document with labels that differ, or none,
    is not learned from, nor is one with more passages than fit into the sample.
    Without labelled texts, or with one kind of label, all texts get the same score.
    """
    known = labels.groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("y"), F.max(label).alias("top")).where("y = top AND id IS NOT NULL")
    chosen = known.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(documents).select("id", F.col("y").cast("int").alias("y"))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    which = feature_of()

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                for y, n, t in zip(column(part, "y").to_pylist(), column(part, "n").to_pylist(), filled(part, "text").to_pylist()):
                    x = np.concatenate([described(held, which)[0] for held, _ in slices([t])])
                    yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([n], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["y", "n", "x"])

    # Of the rows found the least hashes stay, as an id may have many rows.
    size = F.greatest(F.lit(1), F.ceil(F.length(F.coalesce("text", F.lit(""))) / F.lit(PASSAGE))).cast("long")
    order = F.xxhash64("id", F.coalesce("text", F.lit("")), F.lit(SEED))
    sized = rows.withColumn("n", size).where(F.col("n") <= passages).withColumn("order", order)
    found = sized.select("order", "n").orderBy("order").limit(documents).collect()
    last, total = None, 0
    for r in found:
        total += r["n"]
        if total > passages:
            break
        last = r["order"]
    if last is None:
        return Model(0.5)
    sample = sized.where(F.col("order") <= last).dropDuplicates(["order"])
    rows = materialise(sample.select("y", "n", "text").mapInArrow(run, "y int, n long, x binary"), "passages").orderBy("n", "x", "y").collect()
    x = np.concatenate([np.frombuffer(r["x"], np.uint16).reshape(-1, FEATURES) for r in rows])
    return fit(scaled(x), np.array([r["n"] for r in rows]), np.array([r["y"] for r in rows], np.float32))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score", attention: str | None = None) -> DataFrame:
    """``df`` with the score of each whole text, 0 to 1; higher is likelier label 1.

    A null or empty text is one empty passage, and has its score.  ``attention`` names
    a further column for the shares of the text's passages, in order.
    """

    def make():
        which = feature_of()

        def work(part):
            texts = filled(part, text).to_pylist()
            n = np.zeros(len(texts), np.int64)
            hs, es = [], []
            for held, of in slices(texts):
                x, counts = described(held, which)
                np.add.at(n, of, counts)
                if model.weights:
                    h, e = model.coded(scaled(x))
                    hs.append(h)
                    es.append(e)
            if model.weights and texts:
                p, share = model.pooled(np.concatenate(hs), np.concatenate(es), n)
            else:
                p, share = np.full(len(texts), model.prior), np.repeat(1 / np.maximum(n, 1), n)
            columns = [pa.array(p.astype(np.float64))]
            return columns + [lists(share.astype(np.float32), n, pa.float32())] * bool(attention)

        return work

    fields = [T.StructField(out, T.DoubleType())]
    if attention:
        fields.append(T.StructField(attention, T.ArrayType(T.FloatType())))
    return add_columns(df, text, fields, make)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: one in four by its id's checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
