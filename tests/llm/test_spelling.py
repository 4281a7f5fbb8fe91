"""Spelling variants against plain loops."""

import re
import zlib
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strataloom.llm import spelling, workload
from tests.compare import SF_DIR
from tests.llm.rows import empty, odd_documents, with_clashes


def edits(word, alphabet):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    near = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet}
    near |= {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return near - {word}


def plain(counts):
    """What ``variants`` returns, from all edits of each word."""
    alphabet = set("".join(counts))
    near = {w: [o for o in edits(w, alphabet) if o in counts] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, n, form[w], counts.get(form[w]), root(w), len(near[w])) for w, n in counts.items()}


def found(df):
    return [(r["word"], r["n"], r["form"], r["form_n"], r["root"], r["n_near"]) for r in df.collect()]


def test_query_against_plain_loops(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    rows = found(workload.REGISTRY["op13_spelling"](spark, SF_DIR))
    assert len(rows) == len(set(rows)) == len(counts) > 1000
    assert set(rows) == plain(counts)
    assert any(f for _, _, f, *_ in rows) and any(r not in (w, f) for w, _, f, _, r, _ in rows)


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.text("abcé\U0001F600", min_size=1, max_size=5), st.integers(1, 40), max_size=60))
def test_variants_of_any_words(spark, counts):
    words = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n long, short string")
    rows = found(spelling.variants(words))
    assert len(rows) == len(counts) and set(rows) == plain(counts)


def test_one_alphabet_for_all_words_is_made_larger(spark):
    """Words of letters that share a symbol at first; each must not meet all others."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    counts = Counter({a + "mm" + b + "mm" + c + "m": 3 + i for i, (a, b, c) in enumerate(
        (a, b, c) for a in letters for b in letters[::8] for c in letters[::2])})
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    chosen, symbols = spelling.fitted(words)
    assert symbols > spelling.FEWEST and chosen[0] == "m"
    largest = spelling.reduced(words, chosen, symbols).groupBy("short").count().agg(F.max("count")).first()[0]
    assert largest <= spelling.LARGEST
    assert set(found(spelling.variants(words))) == plain(dict(counts))


def test_neighbours_of_reduced_words_come_once(spark):
    short = [a + b + c for a in "012" for b in "0127" for c in ("", "0", "1", "01")]
    rows = spelling.neighbours(spark.createDataFrame([(s,) for s in short], "short string"), 8).collect()
    pairs = [(r["short"], r["near"]) for r in rows if r["near"] in short]
    want = {frozenset((s, o)) for s in short for o in [s, *(e for e in edits(s, "01234567") if e in short)]}
    assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want


def test_odd_texts_and_empty_tables(spark):
    docs = with_clashes(odd_documents(spark), "n")
    counted = {r["word"]: r["n"] for r in spelling.count_words(docs).collect()}
    assert counted["quick"] == 8004 and "odd" not in counted and "кириллица" not in counted
    assert found(spelling.variants(spelling.count_words(empty(spark)))) == []


def test_hot_word_over_many_partitions(spark):
    rows = [(i, "across " * 50 + "acros " * (i % 3)) for i in range(400)]
    words = spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(40))
    assert set(found(spelling.variants(words))) == {("across", 20000, None, None, "across", 1), ("acros", 399, "across", 20000, "across", 1)}


def test_counters_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTERS", 3)
    rows = [(i, " ".join(f"word{chr(97 + (i + k) % 26)}" for k in range(9))) for i in range(52)]
    words = {r["word"]: r["n"] for r in spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert words == {f"word{chr(97 + k)}": 18 for k in range(26)}
