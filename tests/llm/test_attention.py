"""Quality by attention over passages: held-out accuracy, and texts scored one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import attention, workload
from tests.compare import SF_DIR
from tests.llm.rows import LONG, TEXTS, empty, odd_documents, with_clashes

WORDS = "stone river light under amber field morning carry open water slow north".split()


def documents(rng, n):
    """Texts of several passages; label 0 where one of them, anywhere, is made of signs."""
    rows = []
    for i in range(n):
        passages = ["".join(rng.choice(WORDS) + " " for _ in range(200))[:attention.PASSAGE] for _ in range(rng.randint(3, 9))]
        bad = rng.randrange(len(passages)) if i % 2 else None
        if bad is not None:
            passages[bad] = "".join(rng.choice(WORDS) + rng.choice(["$$$ ", "%%% "]) for _ in range(200))[:attention.PASSAGE]
        rows.append((i, "".join(passages), 1 - i % 2, bad))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = documents(random.Random(3), 300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return attention.learn(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))


def test_held_out_accuracy_of_the_query(spark):
    rows = workload.REGISTRY["op12_quality"](spark, SF_DIR).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and {labels[r["doc_id"]] for r in held} == {0, 1}
    assert np.mean([labels[r["doc_id"]] == r["predicted"] for r in held]) >= 0.97


def test_attention_finds_the_passage_that_decides(spark, model):
    rows = documents(random.Random(4), 120)
    docs = spark.createDataFrame([(r[0], r[1], r[2], -1 if r[3] is None else r[3]) for r in rows], "doc_id long, text string, label int, bad int")
    scored = attention.score(docs, model, attention="shares").collect()
    assert np.mean([(r["score"] >= 0.5) == r["label"] for r in scored]) >= 0.97
    for r in scored:
        assert len(r["shares"]) == -(-len(r["text"]) // attention.PASSAGE) and abs(sum(r["shares"]) - 1) < 1e-4
    bad = [r for r in scored if r["bad"] >= 0]
    assert np.mean([int(np.argmax(r["shares"])) == r["bad"] for r in bad]) >= 0.9


def by_hand(model, text):
    which, counts = attention.feature_of(), []
    for at in range(0, max(len(text), 1), attention.PASSAGE):
        row = np.zeros(attention.FEATURES, np.int64)
        kinds = [int(attention.kind_table()[ord(c)]) for c in text[at:at + attention.PASSAGE]]
        for a, b in zip(kinds, kinds[1:]):
            row[which[a * attention.KINDS + b]] += 1
        counts.append(row)
    w = {k: np.asarray(v, np.float64) for k, v in model.weights.items()}
    x = attention.scaled(np.array(counts))
    h = np.tanh(x @ w["W"] + w["b"])
    e = (np.tanh(h @ w["V"] + w["v"]) / (1 + np.exp(-(h @ w["U"] + w["u"])))) @ w["a"]
    share = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
    return 1 / (1 + np.exp(-(share @ h @ w["c"] + w["d"])))


@pytest.mark.parametrize("parts", [1, 7])
def test_each_text_is_scored_by_itself(spark, model, monkeypatch, parts):
    docs = with_clashes(odd_documents(spark)).drop("n_chars").repartition(parts)
    rows = attention.score(docs, model).select("text", "score", "shard").collect()
    assert len(rows) == docs.count() and {r["shard"] for r in rows} == {"clash"}
    for r in rows:
        assert abs(r["score"] - by_hand(model, r["text"] or "")) < 1e-4, (r["text"] or "")[:40]


def test_long_texts_go_in_slices(monkeypatch):
    which = attention.feature_of()
    whole = attention.described([LONG], which)[0]
    monkeypatch.setattr(attention, "SLICE", 3 * attention.PASSAGE)
    texts = [LONG, "", "a", LONG[:5000], *[t or "" for t in TEXTS]]
    rows, owners = [], []
    for held, of in attention.slices(texts):
        assert sum(map(len, held)) <= attention.SLICE
        x, counts = attention.described(held, which)
        rows.append(x)
        owners += np.repeat(of, counts).tolist()
    x = np.concatenate(rows)
    assert (x[np.array(owners) == 0] == whole).all()
    assert [owners.count(i) for i in range(len(texts))] == [max(1, -(-len(t) // attention.PASSAGE)) for t in texts]


def test_labels_that_teach_nothing(spark):
    docs = odd_documents(spark)
    label = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, quality int")
    assert attention.learn(docs, label()).prior == 0.5
    assert attention.learn(docs, label((4, 1), (4, 0), (None, 1), (99, 1), (5, None))).prior == 0.5
    one = attention.learn(docs, label((8, 1), (9, 1), (9, 1)))
    assert one.weights is None and one.prior == 0.75
    assert {r["score"] for r in attention.score(docs, one).collect()} == {0.75}
    assert attention.learn(empty(spark), label((1, 1))).prior == 0.5
    assert attention.score(empty(spark), one).count() == 0


def test_the_sample_is_bounded(spark):
    rows = documents(random.Random(5), 60) + [(100, "x" * 40_000, 1, None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    seen = []
    learned = attention.fit
    try:
        attention.fit = lambda x, counts, y, **k: seen.append((len(x), len(counts))) or learned(x, counts, y, 5)
        attention.learn(docs, labels, documents=50, passages=70)
        attention.learn(docs.unionAll(docs), labels, documents=50)
    finally:
        attention.fit = learned
    assert 50 < seen[0][0] <= 70 and seen[0][1] < 25
    assert seen[1][1] <= 50


def test_two_runs_learn_the_same(spark, model):
    rows = documents(random.Random(3), 300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(11, F.rand())
    again = attention.learn(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))
    assert all((again.weights[k] == v).all() for k, v in model.weights.items())
