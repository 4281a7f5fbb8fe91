"""Tokens of two vocabularies over the same bytes, against plain loops over whole texts."""

import functools
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from strataloom.llm import alignment, workload
from tests.compare import SF_DIR
from tests.llm.rows import LONG, empty, odd_documents, with_clashes

A, B = workload.BYTE_LEVEL, workload.PIECES


@pytest.fixture(scope="module")
def whole():
    """A function from a text to its tokens of A and of B, as (id, start, end) in bytes."""
    left = Tokenizer.from_file(A)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=B)
    # The signs of bytes, from how the vocabulary itself spells each byte that is a character.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    signs = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    @functools.cache
    def left_bytes(i):
        return bytes(signs[c] for c in left.id_to_token(i))

    @functools.cache
    def right_bytes(i):
        piece = right.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        out = []
        for ids, of in ((left.encode(" " + text, add_special_tokens=False).ids, left_bytes), (right.encode(text), right_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((i, at, at + len(of(i))))
                at += len(of(i))
            if b"".join(map(of, ids)) != (" " + text).encode():
                return [], []
            out.append(own)
        return out if text else ([], [])

    return tokens


def plain(texts, tokens):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) and the pairs' counts."""
    rows, held = [], defaultdict(set)
    for d, text in enumerate(texts):
        a, b = tokens(text or "")
        both = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, at = [], [0, 0]
        for end in both:
            names = []
            for k, side in enumerate((a, b)):
                first = at[k]
                while at[k] < len(side) and side[at[k]][2] <= end:
                    at[k] += 1
                names.append(",".join(str(i) for i, *_ in side[first:at[k]]))
            groups.append("|".join(names))
        links, k = Counter(), 0
        for i, s, e in a:
            while k and b[k - 1][2] > s:
                k -= 1
            while k < len(b) and b[k][2] <= s:
                k += 1
            m = k
            while m < len(b) and b[m][1] < e:
                links[i, b[m][0]] += 1
                m += 1
        for p in links:
            held[p].add(d)
        rows.append((len(a), len(b), len(both), links, ";".join(groups)))
    counts = {p: len(ds) for p, ds in held.items()}
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [(n_a, n_b, n_groups, sum(links.values()), sum(k for p, k in links.items() if counts[p] == best[p[0]]),
             sum(k * counts[p] for p, k in links.items()), groups) for n_a, n_b, n_groups, links, groups in rows], counts


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def test_query_against_plain_loops(spark, whole):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want, counts = plain([t for _, t in docs], whole)
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    want = sorted((i, *w[:-1], digest(w[-1])) for (i, _), w in zip(docs, want))
    rows = workload.REGISTRY["op11_alignment"](spark, SF_DIR)
    assert sorted(tuple(r) for r in rows.select("doc_id", *NUMBERS[:-1], "groups_sha256").collect()) == want
    assert sum(r[4] for r in want) > sum(r[5] for r in want) > 0


def test_odd_texts_and_clashing_columns(spark, whole, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 3000)  # many blocks in a task
    extra = ["aa aaa aaaa aaaaa", "say <|endoftext|> </s> <0x41> <unk>", "two  spaces\n\n three wide \x1f x ", "  ", "\n", "tab\t end \x0b ", "naïve Ünï 漢字かな 🙂🙂 é"]
    rows = [(100 + i, t) for i, t in enumerate(extra * 2)]
    docs = odd_documents(spark).unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    got = alignment.align(with_clashes(docs, "text").withColumnRenamed("lang", "n_a"), A, B)
    texts = [r["text"] for r in docs.select("text").collect()]
    want, counts = plain(texts, whole)
    found = got.documents.select(*NUMBERS, "spans").collect()
    assert {r["spans"] for r in found} == {"clash"} and "text" not in got.documents.columns
    assert sorted(tuple(r)[:-1] for r in found) == sorted(want)
    assert {(r["a"], r["b"]): r["n"] for r in got.pairs.collect()} == counts
    assert len(got.pairs.collect()) == len(counts)


def test_empty_table_and_texts_without_tokens(spark):
    got = alignment.align(empty(spark), A, B)
    assert got.documents.count() == 0 and got.pairs.count() == 0
    rows = alignment.align(spark.createDataFrame([(1, None), (2, ""), (3, "a▁b")], "doc_id long, text string"), A, B)
    assert [tuple(r) for r in rows.documents.select(*NUMBERS).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_one_pair_in_most_documents(spark, whole):
    """A hot pair reaches the shuffle once a block, and its count is that of its documents."""
    texts = [f"the quick brouwn fox {i % 7} brouwn" for i in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = alignment.align(docs, A, B)
    want, counts = plain(texts, whole)
    assert sorted(tuple(r) for r in got.documents.select(*NUMBERS).collect()) == sorted(want)
    assert {(r["a"], r["b"]): r["n"] for r in got.pairs.collect()} == counts and max(counts.values()) == 3000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab  ▁é\n\t\x00 漢.1'", max_size=14) | st.text(max_size=30), min_size=1, max_size=4))
def test_stretches_are_encoded_as_in_the_whole_text(whole, values):
    table = test_stretches_are_encoded_as_in_the_whole_text.__dict__.setdefault("table", alignment.Table(alignment.Vocabularies(A, B)))
    found = alignment.aligned(table, values)
    assert found["groups"] == [w[-1] for w in plain(values, whole)[0]]


def test_the_table_is_bounded(monkeypatch, whole):
    monkeypatch.setattr(alignment, "TABLE_STRETCHES", 5)
    monkeypatch.setattr(alignment, "AT_ONCE", 3)
    table = alignment.Table(alignment.Vocabularies(A, B))
    for k in range(6):
        texts = [f"word{k} and word{i} more" for i in range(4)]
        assert alignment.aligned(table, texts)["groups"] == [w[-1] for w in plain(texts, whole)[0]]
        assert len(table.at) < 20
    assert alignment.aligned(table, [LONG])["groups"] == [plain([LONG], whole)[0][0][-1]]
