"""Language by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram binds its letters'
vectors, each rotated by its place, into one vector; a text bundles (adds) the
vectors of its trigrams, a language those of its learning texts.  The language of
a text is the one whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataloom.llm.texts import add_columns, column, filled, parts

DIMENSIONS = 1024
SEED = 20240229
UNKNOWN = "und"
MAX_LANGUAGES = 4096
TRIGRAMS_KEPT = 40_000
# Trigrams whose vectors are added at once.
AT_ONCE = 4096
# A table of owners by trigrams is filled in if one in so many of its cells is used.
DENSE = 32
PART_BYTES = 1024 * 1024
# Scores of a text in no learned language are of the order of 1 / sqrt(DIMENSIONS).
LEAST_SCORE, ENOUGH_LETTERS = 0.1, 200

LETTERS = None


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global LETTERS
    if LETTERS is None:
        LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return LETTERS


def letter_vector(code: int, d: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, d, np.int8) * 2 - 1


class Profiles:
    """Trigram vectors, made on first use and kept within a bound."""

    def __init__(self, dimensions: int):
        self.d = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.at: dict[int, int] = {}
        self.rows = np.zeros((TRIGRAMS_KEPT + AT_ONCE, dimensions), np.int8)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row for each trigram code (21 bits a letter), of ``AT_ONCE`` at most."""
        codes = codes.tolist()
        fresh = [c for c in codes if c not in self.at]
        if len(self.at) + len(fresh) > len(self.rows):
            self.at, self.letters, fresh = {}, {}, codes
        if fresh:
            n, bound = len(self.at), np.ones((len(fresh), self.d), np.int8)
            for turn, shift in ((2, 42), (1, 21), (0, 0)):
                letters, which = np.unique([c >> shift & 0x1FFFFF for c in fresh], return_inverse=True)
                bound *= np.roll(np.stack([self.letter(c) for c in letters.tolist()]), turn, axis=1)[which]
            self.rows[n:n + len(fresh)] = bound
            self.at.update(zip(fresh, range(n, n + len(fresh))))
        return self.rows[[self.at[c] for c in codes]].astype(np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = letter_vector(code, self.d)
        return self.letters[code]

    def counted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Trigram codes, and for each trigram of each text: the text, and which code.

        Other characters in a row are one space, and each text has one of its own on
        both sides, so what stands before it in the list has no part in it.
        """
        lowered = [" " + t.lower() + " " for t in texts]
        sizes = np.array([len(t) for t in lowered])
        flat = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(texts)), sizes)
        is_letter = letter_table()[flat]
        keep = is_letter | np.concatenate([[True], is_letter[:-1]])[:len(flat)]
        keep[np.cumsum(sizes) - sizes] = True
        alphabet, small = np.unique(np.where(is_letter, flat, 32)[keep], return_inverse=True)
        owner, n = owner[keep], len(alphabet)
        if len(small) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        gram = (small[:-2].astype(np.int64) * n + small[1:-1]) * n + small[2:]
        space = np.searchsorted(alphabet, 32)
        # A trigram has its middle in a word, and all of it in one text.
        good = (small[1:-1] != space) & (owner[:-2] == owner[2:])
        gram, owner = gram[good], owner[1:-1][good]
        if n <= 200:
            present = np.zeros(n ** 3, bool)
            present[gram] = True
            grams = np.flatnonzero(present)
            place = np.zeros(n ** 3, np.int64)
            place[grams] = np.arange(len(grams))
            gram = place[gram]
        else:
            grams, gram = np.unique(gram, return_inverse=True)
        a, b, c = (alphabet.astype(np.int64)[x] for x in (grams // n // n, grams // n % n, grams % n))
        return a << 42 | b << 21 | c, owner, gram

    def bundles(self, codes: np.ndarray, owner: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
        """The sum of the trigrams' vectors for each of ``n`` owners.

        A few trigrams at once, so that memory follows the text and not texts times
        trigrams.  All sums are of whole numbers, in whatever order.
        """
        out = np.zeros((n, self.d), np.float32)
        keys, times = np.unique(gram * n + owner, return_counts=True)
        gram, owner = np.divmod(keys, n)
        for at in range(0, len(codes), AT_ONCE):
            low, high = np.searchsorted(gram, [at, at + AT_ONCE])
            g, o, k = gram[low:high] - at, owner[low:high], times[low:high].astype(np.float32)
            vectors = self.vectors(codes[at:at + AT_ONCE])
            if n * len(vectors) <= DENSE * len(g):
                counts = np.zeros((n, len(vectors)), np.float32)
                counts[o, g] = k
                out += counts @ vectors
                continue
            order = np.argsort(o, kind="stable")
            for start in range(0, len(order), AT_ONCE):
                some = order[start:start + AT_ONCE]
                first = np.flatnonzero(np.diff(o[some], prepend=-1))
                out[o[some][first]] += np.add.reduceat(vectors[g[some]] * k[some, None], first, axis=0)
        return out


def blocks(texts: list[str], limit: int = PART_BYTES):
    """Slices of the list with about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit or i + 1 == len(texts):
            yield slice(start, i + 1)
            start, size = i + 1, 0


def learn(df: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, most: int = MAX_LANGUAGES) -> dict[str, list[float]]:
    """One prototype for each non-null language: the sum of its texts' vectors.

    Each task adds up its own texts for each language, so neither a frequent
    language nor a long text gathers anywhere; a few numbers a language reach the
    driver.  Prototypes go to every task, so more than ``most`` languages are an error.
    """
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(batches):
        profiles, sums = Profiles(dimensions), {}
        for batch in batches:
            for part in parts(batch, "text"):
                texts, langs = filled(part, "text").to_pylist(), column(part, "lang").to_pylist()
                for block in blocks(texts):
                    codes, owner, gram = profiles.counted(texts[block])
                    if not len(codes):
                        continue
                    names = sorted(set(langs[block]))
                    of = np.array([names.index(n) for n in langs[block]])
                    bundled = profiles.bundles(codes, of[owner], gram, len(names)).astype(np.float64)
                    for n, v in zip(names, bundled):
                        sums[n] = sums[n] + v if n in sums else v
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "vector"])

    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    summed = (
        rows.mapInArrow(run, schema)
        .select("lang", F.posexplode("vector").alias("place", "value"))
        .groupBy("lang", "place").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("values"))
    )
    found = summed.select("lang", "values.value").take(most + 1)
    if len(found) > most:
        raise ValueError(f"more than {most} languages")
    return {r["lang"]: r["value"] for r in found if any(r["value"])}


def predict(df: DataFrame, prototypes: dict[str, list[float]], text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``df`` with ``lang_pred`` and its cosine, ``score`` (0 to 1).

    A null text, or one without a letter, is ``und`` with score 0; so is every text
    if nothing was learned.  Ties go to the first language by name.
    """
    names = sorted(prototypes)
    unit = np.array([prototypes[n] for n in names], np.float64).reshape(len(names), dimensions)
    unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32) if names else unit

    def make():
        profiles = Profiles(dimensions)

        def work(part):
            texts = filled(part, text).to_pylist()
            langs, scores = [], []
            for block in blocks(texts):
                v = profiles.bundles(*profiles.counted(texts[block]), len(texts[block]))
                size = np.linalg.norm(v, axis=1)
                if not names:
                    size[:] = 0
                    best, cosine = np.zeros(len(v), int), np.zeros(len(v))
                else:
                    cosines = v @ unit.T
                    best = cosines.argmax(axis=1)
                    cosine = cosines.max(axis=1) / np.where(size, size, 1)
                langs += [names[b] if s else UNKNOWN for b, s in zip(best, size)]
                scores.append(np.where(size > 0, np.clip(cosine, 0, 1), 0).astype(np.float64))
            return [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return add_columns(df, text, fields, make)


def accepted(text: Column, lang: Column, score: Column, least: float = LEAST_SCORE, letters: int = ENOUGH_LETTERS) -> Column:
    """Whether a prediction is a language: not ``und``, and for a text of ``letters`` letters
    or more a score of ``least`` at least.  Shorter texts have low scores by chance."""
    many = F.length(F.regexp_replace(text, r"\P{L}+", "")) >= letters
    return (lang != UNKNOWN) & ~((score < least) & many)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: one in three by its id's checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
