"""Operators over whole tables, against plain loops."""

import datetime as dt
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from strataloom.llm import leaks, links, repeats, shingle_links, sharding, texts, url_lists, vector_links, workload
from strataloom.session import materialise
from tests.compare import SF_DIR, duck, duck_rows, explain_difference, spark_rows
from tests.llm.rows import LONG, SCHEMA, empty, odd_documents, with_clashes


def roots(n, pairs):
    """The least member of each one's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_components(spark):
    random.seed(1)
    for n, m in ((30, 20), (200, 190), (50, 49)):
        pairs = [(i, i + 1) for i in range(m)] if n == 50 else [(random.randrange(n), random.randrange(n)) for _ in range(m)]
        df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary")
        got = {r["node"][0]: r["root"][0] for r in links.components(df).collect()}
        want = roots(n, pairs)
        assert got == {i: want[i] for p in pairs if p[0] != p[1] for i in p}
    assert links.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_each_pair_of_a_group_meets(spark):
    df = spark.range(700).select(F.col("id"), F.lit("g").alias("g"), F.lit(700).alias("size"))
    rows = links.in_block_pairs(df, ["g"], F.col("id"), F.col("size"), 100).collect()
    pairs, sizes = set(), Counter(r["pair"] for r in rows)
    by = defaultdict(lambda: ([], []))
    for r in rows:
        by[bytes(r["pair"])][0].extend([r["id"]] * r["left"])
        by[bytes(r["pair"])][1].extend([r["id"]] * r["right"])
    for left, right in by.values():
        pairs |= {(a, b) for a in left for b in right if a < b} | {(b, a) for a in left for b in right if b < a}
    assert len(pairs) == 700 * 699 // 2 and max(sizes.values()) < 300


# Shards


def check_shards(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert len(rows) == n and set(by) <= set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1


def test_shards_of_the_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = workload.REGISTRY["op2_sharding"](spark, SF_DIR).collect()
    check_shards(rows, len(docs))
    where = defaultdict(set)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        where[docs[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())  # small groups stay whole


@pytest.mark.parametrize("texts_", [["same"] * 100, ["a"] * 40 + ["b"] * 30 + [f"t{i}" for i in range(50)], [None, "", "x"], [], [f"p{i // 2}" for i in range(97)]])
def test_shards_of_hot_and_small_groups(spark, texts_):
    rows = [(i, t) for i, t in enumerate(texts_)]
    got = sharding.assign(with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    check_shards(got, len(rows))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    share = math.ceil(len(rows) / 24)
    spread = defaultdict(set)
    for r in got:
        spread[texts_[r["doc_id"]] or ""].add(r["shard"])
    sizes = Counter(t or "" for t in texts_)
    # A text needs as many shards as its copies fill; rivals may cost it a few more.
    assert all(len(spread[t]) <= math.ceil(n / max(1, share - 1)) + 2 for t, n in sizes.items())


@pytest.mark.parametrize("groups,singles,most", [([2] * 600, 0, 30), ([2] * 600, 3, 30), ([3] * 300 + [2] * 150, 0, 60), ([200] + [2] * 500, 0, 60)])
def test_full_shards_exchange(spark, groups, singles, most):
    texts_ = [f"g{i}" for i, n in enumerate(groups) for _ in range(n)] + [f"s{i}" for i in range(singles)]
    rows = list(enumerate(texts_))
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(got, len(rows))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    spread = defaultdict(set)
    for r in got:
        spread[texts_[r["doc_id"]]].add(r["shard"])
    # At most one text is divided for each end of a shard, and one for each overfull shard.
    assert sum(len(s) - 1 for s in spread.values()) <= most


def test_shards_of_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    check_shards(sharding.assign(docs).collect(), docs.count())


def test_no_block_moves_beyond_a_quota(spark):
    random.seed(4)
    rows = [(f"k{k}", s, random.randint(1, 30)) for k in range(40) for s in range(6) if random.random() < 0.6]
    load = [sum(n for _, s, n in rows if s == i) for i in range(6)]
    quotas = [x + 20 for x in load]
    got = sharding.propagate(spark.createDataFrame(rows, "key string, shard int, n long"), quotas, 8).collect()
    sums, texts_, cut = Counter(), Counter(), lambda rs: sum(sum(b) ** 2 - sum(x * x for x in b) for b in rs.values())
    before, after = defaultdict(list), defaultdict(list)
    for r in got:
        sums[r["shard"]] += r["n"]
        texts_[r["key"]] += r["n"]
        after[r["key"]].append(r["n"])
    for k, _, n in rows:
        before[k].append(n)
    assert all(sums[i] <= quotas[i] for i in range(6)) and texts_ == Counter({k: sum(b) for k, b in before.items()})
    assert cut(after) < cut(before)


# Repeats


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_order(text):
    assert repeats.suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(raws, length):
    counts = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if counts[r[i:i + length]] > 1:
                covered[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(int), [0]]))).reshape(-1, 2)
        out.append(([tuple(e) for e in edges.tolist()], bytes(np.frombuffer(r, np.uint8)[~covered])))
    return out


@pytest.mark.parametrize("together", [2048, 1])
def test_repeats_of_mixed_texts(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    random.seed(5)
    pool = ["".join(random.choice("abcdé \n") for _ in range(random.randint(20, 200))) for _ in range(12)]
    piece = lambda: random.choice(pool)[random.choice([0, 0, 5]):random.choice([999, 60])] if random.random() < 0.6 else "".join(random.choice("abcdefgh") for _ in range(random.randint(1, 80)))
    values = ["".join(piece() for _ in range(random.randint(0, 6))) for _ in range(100)]
    values += ["ab" * 100, "aaaa" * 50, "a" * 39, "a" * 40, "a" * 41, None, "", values[3], values[3]]
    docs = with_clashes(spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(5))
    known, found = repeats.spans(docs, length=40, gram=8, stride=7)
    spans = {bytes(r["key"]): [tuple(s) for s in r["spans"]] for r in found.collect()}
    rest = {bytes(r["key"]): bytes(r["kept"]) for r in repeats.kept(docs, found).collect()}
    want = removed([(v or "").encode() for v in values], 40)
    assert known.count() == len(values)
    for r in known.collect():
        key, raw = bytes(r["key"]), (values[r["doc_id"]] or "").encode()
        assert r["n_bytes"] == len(raw)
        assert (spans.get(key, []), rest.get(key, raw)) == want[r["doc_id"]]


def test_repeats_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    raws = [r["text"].encode() for r in docs]
    got = {r["doc_id"]: r for r in workload.REGISTRY["op4_repeats"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    counts = Counter(hash(r[i:i + 400]) for r in raws for i in range(len(r) - 399))
    for doc, raw in zip(docs, raws):
        covered = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - 399):
            if counts[hash(raw[i:i + 400])] > 1:
                covered[i] += 1
                covered[i + 400] -= 1
        gone = np.cumsum(covered)[:len(raw)] > 0
        rest = bytes(np.frombuffer(raw, np.uint8)[~gone])
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert tuple(got[doc["doc_id"]]) == (doc["doc_id"], len(raw), int(gone.sum()), n_spans, hashlib.sha256(rest).hexdigest())


def test_repeats_of_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    known, found = repeats.spans(docs)
    assert known.count() == docs.count()
    spans = {bytes(r["key"]): [tuple(s) for s in r["spans"]] for r in found.collect()}
    for value in (LONG, LONG + "the end", "x" * 50_000):
        assert spans[hashlib.md5(value.encode()).digest()] == [(0, len(value.removesuffix("end")))]
    assert len(spans) == 3 and repeats.kept(docs, found).count() == 3
    known, found = repeats.spans(empty(spark))
    assert known.count() == found.count() == repeats.kept(empty(spark), found).count() == 0


# URL lists


def test_lists_at_fetch_time(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    changes = spark.createDataFrame([
        ("domain", "bad.example", True, d(10)), ("domain", "bad.example", False, d(20)), ("domain", "Bad.Example.", True, d(30)),
        ("domain", "bad.example", False, d(30)), ("prefix", "ok.example/x/", True, d(5)), ("prefix", "sub.bad.example", True, d(0)),
        ("domain", None, True, d(0)), ("other", "ok.example", True, d(0)), ("domain", "ok.example", None, d(0)), ("domain", "", True, d(0)), ("domain", "late.example", True, None),
    ], "kind string, pattern string, listed boolean, at date")
    cases = [
        ("http://bad.example/", 9, None, 0), ("http://bad.example/", 10, "domain:bad.example", 1), ("http://user:pw@WWW.Bad.Example:80/a", 19, "domain:bad.example", 1),
        ("http://bad.example/", 20, None, 0), ("http://bad.example/", 30, "domain:bad.example", 1), ("http://notbad.example/", 30, None, 0),
        ("https://ok.example/x", 5, "prefix:ok.example/x", 1), ("https://ok.example/x/y?q#f", 6, "prefix:ok.example/x", 1), ("https://ok.example/xy", 6, None, 0), ("https://ok.example/x", 4, None, 0),
        ("http://sub.bad.example/z", 12, "prefix:sub.bad.example", 2), ("no url", 12, None, 0), ("", 12, None, 0), (None, 12, None, 0), ("http://bad.example/", None, None, 0),
        ("http://bad.example/" + "a/" * 20_000, 10, "domain:bad.example", 1), ("http://late.example/", 300, None, 0), ("http://bad.example/", 10, "domain:bad.example", 1),
    ]
    captures = spark.createDataFrame([(i, u, None if n is None else d(n), e, m) for i, (u, n, e, m) in enumerate(cases)], "id long, url string, at date, want string, m long")
    rows = url_lists.evaluate(with_clashes(captures, "at", "url"), changes).collect()
    assert len(rows) == len(cases) and {r["best"] for r in rows} == {"clash"}
    for r in rows:
        assert (r["entry"], r["n_active"], r["listed"]) == (r["want"], r["m"], r["want"] is not None)
    assert {r["listed"] for r in url_lists.evaluate(captures, changes.limit(0)).collect()} == {False}
    assert url_lists.evaluate(captures.limit(0), changes).count() == 0


@pytest.mark.parametrize("name", sorted(workload.SQL))
def test_query_equals_sql(spark, name):
    names, rows = spark_rows(workload.REGISTRY[name](spark, SF_DIR))
    want_names, want = duck_rows(duck(), workload.SQL[name])
    assert names == want_names and rows
    assert rows == want, explain_difference(rows, want)


# Vectors


def vector_links_by_hand(rows):
    def unit(v):
        if v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        x = x / np.abs(x).max()
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95]
    count = Counter(i for p in pairs for i in p)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    place = {i: k for k, i in enumerate(order)}
    root = roots(len(rows), [(place[a], place[b]) for a, b in pairs])
    return sorted(((rows[i][0], count[i], rows[order[root[place[i]]]][0]) for i in range(len(rows))), key=str)


def test_vectors_with_dense_groups(spark):
    rng = np.random.default_rng(2)
    rows = []
    for size, spread in ((120, 0.02), (40, 0.03), (2, 0.01), (30, 0.04)):
        centre = rng.standard_normal(64)
        rows += [(centre + spread * np.linalg.norm(centre) / 8 * rng.standard_normal(64) * 3).tolist() for _ in range(size)]
    rows += rng.standard_normal((300, 64)).tolist()
    rows += [rows[0]] * 25 + [[2 * x for x in rows[0]], None, [], [0.0] * 64, [float("nan")] + rows[1][1:], [None] + rows[1][1:], [float("inf")] + rows[1][1:], rows[1][:32], rows[1][:32], [x * 1e-30 for x in rows[2]]]
    rows = [(i * 7 % 1009, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in enumerate(rows)]
    rows += [(None, rows[3][1]), (None, None), rows[5], rows[5]]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4))
    got = vector_links.link(df).collect()
    want = vector_links_by_hand(rows)
    have = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)
    assert len(have) == len(want)
    # Retrieval is approximate; counts within the groups found are exact.
    assert sum(min(h[1], w[1]) for h, w in zip(have, want)) >= 0.99 * sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want)) and sum(w[1] for w in want) > 5000
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("mean", [0.0, 0.8, 0.9, 0.99])
def test_vectors_with_a_common_direction(spark, mean):
    rng = np.random.default_rng(6)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = mean * unit(np.ones(64)) + math.sqrt(1 - mean * mean) * unit(rng.standard_normal((450, 64)))
    x = unit(x)
    to = rng.standard_normal((300, 64))
    to = unit(to - (to * x[:300]).sum(axis=1, keepdims=True) * x[:300])
    rows = list(enumerate(np.concatenate([x, 0.951 * x[:300] + math.sqrt(1 - 0.951 ** 2) * to]).tolist()))
    got = vector_links.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = {i: n for i, n, _ in vector_links_by_hand(rows)}
    assert sum(want.values()) >= 600 and all(r["n_links"] <= want[r["vec_id"]] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.97 * sum(want.values())


def test_all_pairs_only_if_wanted(spark):
    rng = np.random.default_rng(6)
    x = 0.99 + 0.02 * rng.standard_normal((200, 64))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="all_pairs"):
        vector_links.link(df, all_pairs=False)
    assert {r["n_links"] for r in vector_links.link(df).collect()} == {199}


@pytest.mark.parametrize("step", [16, 18, 21, 32])
def test_keys_of_every_width_find_pairs_at_the_threshold(step):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotations, tables, bound = vector_links.measured(x, 0.95, step)
    pairs = vector_links.threshold_pairs(x[::-1].copy(), 0.95)
    parts = [vector_links.parts_of(vector_links.words_of(rotations, v), tables, step) for v in pairs]
    assert parts[0].max() < 2 ** step
    met = (np.bitwise_count(parts[0] ^ parts[1]) <= 1).any(axis=1)
    assert met.mean() >= 0.97 and bound < 64 * len(rotations)


def test_keys_widen_with_the_number_of_vectors():
    assert [vector_links.key_bits(n) for n in (0, 1, 500, 10_256, 51_282, 10 ** 6, 10 ** 9, 10 ** 12)] == [16, 16, 16, 16, 18, 22, 32, 32]


def test_vectors_without_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_links.link(df).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in vector_links.link(odd).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_rotation_balances_the_bits():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 64)) @ np.diag(np.linspace(0.2, 2, 64)) + 0.5
    bits = vector_links.Rotation(x, 64, 1).codes(x)
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.1


def test_vector_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = workload.REGISTRY["op7_vector_links"](spark, SF_DIR).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == vector_links_by_hand(rows)


# Shingles


def similar(values):
    """Classes and numbers of links of all texts, by counting shared shingles."""
    sets = [s.tolist() for s in texts.shingles(pa.array([v or "" for v in values], pa.string()))]
    holders, both = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            both.update((j, i) for j in holders[x])
            holders[x].append(i)
    pairs = [(a, b) for (a, b), k in both.items() if k >= 0.8 * (len(sets[a]) + len(sets[b]) - k) - 1e-9]
    count = Counter(i for p in pairs for i in p)
    return [(root, count[i]) for i, root in enumerate(roots(len(values), pairs))]


def near_copies():
    random.seed(8)
    words = ["".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    values = []
    for size in (150, 20, 2, 2):
        base = [random.choice(words) for _ in range(random.randint(60, 200))]
        for _ in range(size):
            own = list(base)
            for _ in range(random.randint(0, 3)):
                own[random.randrange(len(own))] = random.choice(words)
            values.append(" ".join(own))
    values += [" ".join(random.choice(words) for _ in range(random.randint(1, 100))) for _ in range(150)]
    return values + values[:10] + [values[0]] * 30 + [None, "", "!!", "two words", "Two, words!", LONG, LONG + "the end"]


def test_near_copies_all_linked(spark):
    values = near_copies()
    docs = with_clashes(spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(6))
    got = {r["doc_id"]: r for r in shingle_links.join(docs, small=32).collect()}
    want = similar(values)
    assert len(got) == len(values)
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == dict(enumerate(want))
    assert all(r["kept"] == (i == r["class_id"]) for i, r in got.items())


def test_a_dense_group_does_not_cost_its_square(spark):
    """Near copies of one text: rows in buckets and edges for each are bounded, and all are linked."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    base, values = [word() for _ in range(220)], []
    for _ in range(2400):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(len(own))] = word()
        values.append(" ".join(own))
    sketches = shingle_links.sketched(spark.createDataFrame([(v,) for v in values], "text string"), "text").select("set", "tokens").collect()
    assert len({r["set"] for r in sketches}) == 2400
    runs = shingle_links.runs_for(0.8, 5e-4, shingle_links.FEW_SPLITS)
    rows, links_ = [], []
    for m in (600, 1200, 2400):
        reps = spark.createDataFrame(sketches[:m], "set binary, tokens array<int>")
        buckets, _, tied = shingle_links.paths(reps, 0.8, range(1, runs + 1), shingle_links.SMALL, shingle_links.PLACES)
        edges = shingle_links.search(buckets, reps, 0.6, shingle_links.SMALL)
        for t in tied:
            edges = edges.unionByName(t)
        rows.append(buckets.count())
        links_.append(edges.count())
        assert rows[-1] <= 1.25 * runs * m and links_[-1] <= runs * m
    assert links.components(edges).groupBy("root").count().agg(F.max("count")).first()[0] == 2400
    # Sets that stay pass one more split for each doubling, until the bound above; the square were 16 times.
    assert rows[2] <= 9 * rows[0] and links_[2] <= 9 * links_[0], (rows, links_)


def test_sets_that_leave_a_bucket_keep_their_candidates(spark):
    """Whatever agrees with a set that leaves, as a candidate must, is tied to the same one."""
    rng = np.random.default_rng(4)
    base, rows = rng.integers(0, 1000, 64), []
    for share in (0.02, 0.05, 0.15, 0.3, 0.5, 0.9):
        for _ in range(60):
            own = np.where(rng.random(64) < share, rng.integers(0, 1000, 64), base)
            rows.append((1, len(rows).to_bytes(4, "big"), own.tolist()))
    df = spark.createDataFrame(rows, "node long, set binary, tokens array<int>")
    edges, rest = shingle_links.settled(df, df.select("set", "tokens"))
    tied = {bytes(x) for e in edges.collect() for x in (e["a"], e["b"])}
    stays = {bytes(r["set"]) for r in rest.collect()}
    tokens = {s: np.array(t) for _, s, t in rows}
    left = set(tokens) - stays
    assert len(left) > 60 and edges.count() == len(tied) - 1
    for x in left:
        assert x in tied and all(y in tied for y in tokens if (tokens[x] == tokens[y]).mean() >= 0.6)


def test_splits_join_tokens_once(spark, monkeypatch):
    """Sets that go through many splits take their tokens along."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1000, 64)
    rows = [(i.to_bytes(4, "big"), np.where(rng.random(64) < 0.2, rng.integers(0, 1000, 64), base).tolist()) for i in range(400)]
    reps = materialise(spark.createDataFrame(rows, "set binary, tokens array<int>"), "own-tokens")
    read = []

    def watched(df, label):
        read.append(any("own-tokens" in f for f in df.inputFiles()))
        return materialise(df, label)

    monkeypatch.setattr(shingle_links, "materialise", watched)
    buckets, deep, _ = shingle_links.paths(reps, 0.8, range(1, 4), 16, 64)
    assert deep is not None and buckets.count() and sum(read) <= 2, read


def test_components_end_with_the_stars(spark, monkeypatch):
    """No round is run after the one that makes stars of all edges."""
    stored = []
    monkeypatch.setattr(links, "materialise", lambda df, label: stored.append(label) or materialise(df, label))
    edges = spark.createDataFrame([(0, i) for i in range(1, 50)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in links.components(edges).collect()}
    assert got == {**dict.fromkeys(range(50), 0), 100: 100, 101: 100} and len(stored) == 3
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1002), (1001, 1002)], "a long, b long")
    got = {r["node"]: r["root"] for r in links.components(chain).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1003), 1000)}


def test_near_pairs_among_texts_of_one_template(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    template = [word() for _ in range(150)]
    texts_ = []
    for _ in range(1200):
        own = [word() for _ in range(75)]
        texts_.append(" ".join(template + own))
        if len(texts_) < 1600:  # a near copy: 24 other words of 225
            texts_.append(" ".join(template + own[:-24] + [word() for _ in range(24)]))
    docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["n_links"] for r in shingle_links.join(docs, small=4).collect()}
    assert len(got) == len(texts_) == 2000 and all(got[i] == 0 for i in range(1600, 2000))
    # A near pair shares 197 of 245 shingles: 0.804.
    assert sum(got[i] for i in range(1600)) >= 1600 - 2 * 4


def test_runs_cover_all_splits():
    for splits in (shingle_links.FEW_SPLITS, shingle_links.LEVELS):
        runs = shingle_links.runs_for(0.8, 5e-4, splits)
        rng = np.random.default_rng(splits)
        alive = np.repeat(rng.binomial(64, 0.8, 40_000) / 64, runs)
        count = np.ones(len(alive), np.int64)
        for _ in range(splits):  # buckets that a pair shares, by simulation
            count = rng.binomial(count + rng.binomial(count, 0.25), alive)
        found = (count.reshape(-1, runs) > 0).any(axis=1)
        assert 1 - found.mean() < 1e-3


def test_shared_shingles_as_matrices():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[25:]] for a in sets[:25]]
    assert shingle_links.shared(sets[:25], sets[25:]).tolist() == want
    assert shingle_links.shared(sets[:2], sets[2:4]).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:4]] for a in sets[:2]]


def test_near_copy_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    ids = [r["doc_id"] for r in docs]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in workload.REGISTRY["op8_shingle_links"](spark, SF_DIR).collect()}
    assert got == {i: (ids[root], n) for i, (root, n) in zip(ids, similar([r["text"] for r in docs]))}


def test_near_copies_of_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    rows = shingle_links.join(docs).collect()
    assert len(rows) == docs.count()
    got = Counter((r["doc_id"], r["class_id"], r["n_links"], r["kept"]) for r in rows)
    assert got[4, 4, 3, True] == 3 and got[5, 4, 3, False] == 1 and got[10, 10, 1, True] == 1 and got[11, 10, 1, False] == 1
    assert got[None, None, 0, True] == 2 and got[0, 0, 0, True] == 1
    assert shingle_links.join(empty(spark)).count() == 0


# Pipeline


def test_pipeline_stages_of_odd_rows(spark, tmp_path):
    docs = odd_documents(spark)
    secret = "one two three password=hunter22222 four five six seven"
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    more = [(300, secret, "en", "s", 1), (301, "before it " + item + " after it", "en", "s", 1)]
    docs = with_clashes(docs.unionByName(spark.createDataFrame(more, SCHEMA)))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near copies", "leaks", "secrets", "pieces"]
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs)
    ids = [sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in d.select("doc_id").collect()) for d in seen]
    assert ids[0] == [-1, 3, 4, 4, 4, 5, 6, 7, 8, 10, 11, 300, 301]  # no letters, or 50,000 times the same: no language
    assert ids[1] == [-1, 3, 4, 6, 7, 8, 10, 300, 301]
    assert ids[2] == ids[3] == ids[4] == [-1, 3, 4, 6, 7, 8, 10, 300]
    clean = {r["doc_id"]: r["text"] for r in seen[3].collect()}
    assert clean[300] == "one two three [secret] four five six seven" and clean[10] == LONG
    assert all(r["round_trip"] for r in seen[4].where("doc_id <> 7").collect())
    nothing = empty(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, nothing, SF_DIR).count() == 0


def test_pipeline_keeps_unlabelled_documents_with_letters(spark):
    docs = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.identify_language(spark, docs, SF_DIR).select("text").collect()
    want = [r["text"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert want and Counter(r["text"] for r in got) == Counter(want)


def test_pipeline_rejects_texts_in_no_learned_language(spark):
    known = [(3 * i + 1, f"the quick brown fox jumps over the lazy dog {i} times", "en") for i in range(40)]
    other = [(900, "Это пример русского текста для проверки правила. " * 8, None), (901, "漢字かな交じり文の例です。" * 30, "en"),
             (902, "the dog and the fox " * 20, None), (903, "да", None), (904, "12 34", None)]
    docs = spark.createDataFrame([(i, t, g, "s", len(t)) for i, t, g in known + other], SCHEMA)
    learn = [r for r in docs.withColumn("h", corpus_pipeline.language.held_out(F.col("doc_id"))).where("NOT h AND doc_id < 900").collect()]
    assert learn
    docs = docs.where("doc_id <> 901").unionByName(docs.where("doc_id = 901").withColumn("lang", F.lit(None).cast("string")))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, SF_DIR).collect()}
    assert kept == {i for i, *_ in known} | {902, 903}


def test_pipeline_keeps_one_row_where_an_id_has_several_texts_of_a_class(spark):
    base = [f"word{i}" for i in range(120)]
    near = lambda k: " ".join(base[:k] + ["other"] + base[k + 1:])
    apart = " ".join(f"apart{i}" for i in range(60))
    rows = [(5, near(10)), (5, near(50)), (5, apart), (5, apart), (7, near(90)), (8, apart + " more"), (9, "!!"), (9, "!!"), (9, "??"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_a_kind(spark, docs, SF_DIR).collect()]
    assert len([t for i, t in kept if i == 5 and t.startswith("word")]) == 1
    assert sorted((i, t) for i, t in kept if i and not t.startswith("word")) == [(5, apart), (9, "!!"), (9, "??")]
    assert (None, None) in kept and len(kept) == 5


def test_pipeline_keeps_one_clean_document_of_each_class(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"] for r in __spark_entry__.queries()["pipeline"](spark, SF_DIR).select("doc_id").collect()}
    ids, values = [r["doc_id"] for r in docs], [r["text"] for r in docs]
    items = [s for s in texts.shingles(pa.array([r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()])) if len(s)]
    sets = texts.shingles(pa.array(values))
    first = {ids[root] for root, _ in similar(values)}
    leaked = {i for i, s in zip(ids, sets) if any(np.isin(q, s).sum() >= 0.8 * len(q) for q in items)}
    assert got == first - leaked


def test_ten_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
