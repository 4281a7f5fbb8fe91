"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are dealt to a few symbols, so words become short strings over a small
alphabet and several words share one.  Words one edit apart have reduced words at
most one edit apart.  Each distinct reduced word generates its neighbours within
one edit; those that are reduced words of the vocabulary bring their words
together, and only these pairs are compared as they are written.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataloom.llm.texts import column, filled, parts
from strataloom.session import materialise

# Fixed value: the runs that are words, after A to Z are in small letters.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
# Counters a task holds before it hands them on.
COUNTERS = 400_000

# Characters that stand for groups of letters; one more for each doubling.
SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_" + "".join(map(chr, range(0x400, 0x4C0)))
FEWEST = 8
# Letters dealt one by one, the most frequent first; any others share one symbol.
LETTERS = len(SYMBOLS) - 1
# Words compared for each word within its own reduced word, on average, and at most.
CROWD, LARGEST = 4, 256


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change: Callable[[str, str], str] | None = None,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) for words of ``least_length`` code points that occur ``least_count`` times.

    Words are the runs of ``RUN`` in the whole texts, of which A to Z alone are
    lower-cased.  ``change`` gets a document's id as text (null: empty) and a run of
    it of at least ``least_length``, and returns the word to count, which must not be
    longer.  Null and empty texts have no words; repeated rows count each time.
    """

    def run(batches):
        held: Counter = Counter()

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in parts(batch, "text"):
                for i, t in zip(column(part, "id").to_pylist(), filled(part, "text").to_pylist()):
                    for w, n in Counter(RUN.findall(t.encode().lower().decode())).items():
                        if len(w) >= least_length:
                            held[change(i, w) if change else w] += n
                    if len(held) > COUNTERS:
                        yield handed()
                        held.clear()
        yield handed()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def reduced(words: DataFrame, letters: list[str], symbols: int) -> DataFrame:
    """``words`` with ``short``, the word in ``symbols`` symbols.

    The letters, the most frequent first, are dealt to the symbols in turn, there and
    back again; letters that are not listed have the last symbol.
    """
    turn = [*range(symbols), *reversed(range(symbols))]
    dealt = "".join(SYMBOLS[turn[i % (2 * symbols)]] for i in range(len(letters)))
    used = SYMBOLS[:symbols]
    short = F.translate("word", "".join(letters), dealt) if letters else F.col("word")
    return words.withColumn("short", F.regexp_replace(short, f"[^{re.escape(used)}]", used[-1]))


def fitted(words: DataFrame) -> tuple[list[str], int]:
    """The letters by frequency, and how many symbols leave few words to a reduced word.

    At as many symbols as letters every word is its own, so the search ends.
    """
    counts = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    letters = [r["letter"] for r in counts.orderBy(F.desc("n"), "letter").limit(LETTERS).collect()]
    symbols = FEWEST
    while symbols < len(SYMBOLS):
        sizes = reduced(words, letters, symbols).groupBy("short").agg(F.count("*").alias("size"))
        found = sizes.agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("size")).alias("pairs"), F.max("size").alias("most")).first()
        if not found["words"] or (found["pairs"] <= CROWD * found["words"] and found["most"] <= LARGEST):
            break
        symbols = min(2 * symbols, len(SYMBOLS))
    return letters, symbols


def neighbours(short: DataFrame, symbols: int) -> DataFrame:
    """(short, near): each reduced word with itself and all reduced words one edit away.

    Of two reduced words the longer one generates the other by a deletion, and of two
    of one length the one with the smaller symbol by a replacement; so every pair
    comes once.
    """
    r = F.col("short")
    places = F.sequence(F.lit(1), F.length(r))
    head = lambda i: F.substring(r, F.lit(1), i - 1)
    tail = lambda i: F.substring(r, i + 1, F.length(r))
    alphabet = F.array(*[F.lit(s) for s in SYMBOLS[:symbols]])
    deleted = F.transform(places, lambda i: F.concat(head(i), tail(i)))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(
        F.filter(alphabet, lambda s: s > F.substring(r, i, F.lit(1))), lambda s: F.concat(head(i), s, tail(i)))))
    return short.select("short", F.explode(F.array_distinct(F.concat(F.array(r), deleted, replaced))).alias("near"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, m) for all pairs of distinct words one edit apart, both ways."""
    letters, symbols = fitted(words)
    own = materialise(reduced(words, letters, symbols), "reduced-words")
    shorts = own.select("short").distinct()
    met = neighbours(shorts, symbols).join(shorts.withColumnRenamed("short", "near"), "near")
    left = own.select("short", "word", "n")
    right = own.select(F.col("short").alias("near"), F.col("word").alias("other"), F.col("n").alias("m"))
    pairs = met.join(left, "short").join(right, "near").where((F.col("short") != F.col("near")) | (F.col("word") < F.col("other")))
    pairs = pairs.where((F.abs(F.length("word") - F.length("other")) <= 1) & (F.levenshtein("word", "other", 1) == 1))
    pairs = materialise(pairs.select("word", "n", "other", "m"), "near-words")
    return pairs.unionAll(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")))


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """(word, n, form, form_n, root, n_near) for distinct words and their counts (word, n).

    Two words are near if they differ by one inserted, deleted or replaced code
    point.  ``form`` is the near word of largest count, of equal ones the first in
    code-point order, if its count is ``factor`` times the word's or more, else null;
    ``root`` is where the forms end, the word itself if it has none.
    """
    words = materialise(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("m")).alias("down"), "other"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    has = (-F.col("best.down")) >= F.lit(factor) * F.col("n")
    known = materialise(known.select(
        "word", "n", F.when(has, F.col("best.other")).alias("form"), F.when(has, -F.col("best.down")).alias("form_n"), "n_near"), "forms")
    # Counts grow along the forms, so there is no cycle; each round doubles the steps taken.
    way = materialise(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not way.join(on, "root", "left_semi").take(1):
            break
        way = materialise(way.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return known.join(way, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "n", "form", "form_n", "root", "n_near")
