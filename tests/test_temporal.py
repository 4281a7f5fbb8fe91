"""Joins and frames on time against plain loops, on hot keys, nulls and ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strataloom.operators import temporal, windows
from strataloom.plans import incremental
from strataloom.session import scratch_path

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def asof_rows(rng, n, keys):
    """A third of the rows on one key, times that tie, nulls in keys and times."""
    pick = lambda: rng.choice([1, 1, *range(keys), None])
    when = lambda: rng.choice([None, *[rng.randrange(300) for _ in range(20)]])
    facts = [(i, pick(), at(when())) for i in range(n)]
    versions = [(pick(), at(w := when()), rng.randrange(4), None if w is None or rng.random() < 0.5 else at(w + rng.randrange(60))) for _ in range(n)]
    return facts, versions


def asof_plain(facts, versions, until):
    out = []
    for i, k, t in facts:
        held = [(s, v, u) for key, s, v, u in versions if k is not None and t is not None and key == k and s is not None and s <= t]
        best = max(held, key=lambda x: (x[0], x[1], (x[2] is not None, x[2] or DAY)), default=None)
        good = best is not None and (not until or best[2] is None or t < best[2])
        out.append((i, k, t, best[1] if good else None))
    return out


@pytest.mark.parametrize("until", [None, "ends"])
@pytest.mark.parametrize("rows_per_slice", [10_000_000, 40])
def test_asof_join(spark, until, rows_per_slice):
    facts, versions = asof_rows(random.Random(7), 600, 9)
    f = spark.createDataFrame(facts, "id int, k int, at timestamp").repartition(5)
    v = spark.createDataFrame([(*x, "clash") for x in versions], "k int, since timestamp, version int, ends timestamp, id string").repartition(5)
    want = asof_plain(facts, versions, until)
    got = temporal.asof_join(f, v, ["k"], "at", "since", ["version"], until, rows_per_slice=rows_per_slice)
    order = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)
    inner = temporal.asof_join(f, v, ["k"], "at", "since", ["version"], until, "inner", rows_per_slice)
    assert sorted(map(tuple, inner.collect()), key=order) == [w for w in want if w[3] is not None]
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_join_of_empty_sides_and_clashing_names(spark):
    f = spark.createDataFrame([(1, 1, at(5))], "id int, k int, at timestamp")
    v = spark.createDataFrame([], "k int, since timestamp, version int")
    assert [tuple(r) for r in temporal.asof_join(f, v, ["k"], "at", "since", ["version"]).collect()] == [(1, 1, at(5), None)]
    assert temporal.asof_join(f.limit(0), v, ["k"], "at", "since", ["version"]).count() == 0
    with pytest.raises(ValueError):
        temporal.asof_join(f, v.withColumnRenamed("version", "ID"), ["k"], "at", "since", ["ID"])


def spans(rng, n, keys, longest):
    rows = []
    for i in range(n):
        a = rng.choice([None, *[rng.randrange(-5000, 20_000) for _ in range(30)]])
        b = None if a is None else a + rng.choice([0, -3, 1, rng.randrange(1, 60), rng.randrange(1, longest)])
        rows.append((rng.choice([1, 1, *range(keys), None]), i, at(a), at(b)))
    return rows


def test_interval_join(spark):
    rng = random.Random(9)
    left, right = spans(rng, 400, 5, 9000), spans(rng, 300, 5, 20_000)
    l = spark.createDataFrame(left, "k int, a int, a1 timestamp, a2 timestamp").repartition(4)
    r = spark.createDataFrame(right, "k int, b int, b1 timestamp, b2 timestamp").repartition(4)
    got = temporal.interval_join(l, r, ["k"], ("a1", "a2"), ("b1", "b2"))
    pairs = [(r["a"], r["b"]) for r in got.select("a", "b").collect()]
    want = [(a, b) for k, a, a1, a2 in left for m, b, b1, b2 in right
            if k is not None and k == m and None not in (a1, b1) and a1 < a2 and b1 < b2 and max(a1, b1) < min(a2, b2)]
    assert len(want) > 1000 and sorted(pairs) == sorted(want)
    assert got.columns == ["k", "a", "a1", "a2", "b", "b1", "b2"]
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert temporal.interval_join(l.limit(0), r, ["k"], ("a1", "a2"), ("b1", "b2")).count() == 0
    with pytest.raises(ValueError):
        temporal.interval_join(l, r.withColumnRenamed("b", "a"), ["k"], ("a1", "a2"), ("b1", "b2"))


def test_intervals_without_a_key_and_as_long_as_the_table(spark):
    """Short ones meet long ones, not each other; a decade costs no more rows than a second."""
    short = spark.range(20_000).select(F.col("id").alias("a"), F.timestamp_seconds(F.col("id") * 1000).alias("a1"), F.timestamp_seconds(F.col("id") * 1000 + 1).alias("a2"))
    long_ = spark.range(3).select(F.col("id").alias("b"), F.timestamp_seconds(F.col("id") * 5_000_000).alias("b1"), F.timestamp_seconds(F.col("id") * 5_000_000 + 10_000_000).alias("b2"))
    got = temporal.interval_join(short, long_, [], ("a1", "a2"), ("b1", "b2"))
    assert got.groupBy("b").count().orderBy("b").collect() == [(0, 10_000), (1, 10_000), (2, 10_000)]
    exploded = [n for n in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate" in n]
    assert exploded
    widths = temporal.interval_join(long_, short, [], ("b1", "b2"), ("a1", "a2"))
    assert widths.count() == 30_000


@pytest.mark.parametrize("hot", [False, True])
def test_trailing_frames(spark, hot):
    rng = random.Random(3)
    rows = [(i, 1 if hot and i % 3 else rng.choice([1, 2, 3, None]), at(rng.choice([None, *[rng.randrange(-400, 900) for _ in range(25)]])), rng.randrange(100)) for i in range(500)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id int, k int, t timestamp, v int, piece string")
    got = temporal.trailing(df, ["k"], "t", 3600, {"n": F.count("*"), "s": F.sum("v"), "top": F.max("v")})
    assert got.columns == [*df.columns, "n", "s", "top"]
    found = {r["id"]: (r["n"], r["s"], r["top"]) for r in got.collect()}
    assert len(found) == len(rows)
    for i, k, t, _ in rows:
        own = [v for _, m, u, v in rows if m == k and (u is None if t is None else u is not None and t - dt.timedelta(hours=1) <= u <= t)]
        assert found[i] == (len(own), sum(own), max(own))


@pytest.mark.parametrize("rows_per_slice", [10_000_000, 300])
def test_sessions_of_a_hot_key(spark, rows_per_slice):
    rng = random.Random(5)
    rows = [(i, 1 if i % 3 else rng.choice([2, 3, None]), at(rng.choice([None, *[rng.randrange(20_000) for _ in range(30)]])), i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k int, t timestamp, v int")
    got = windows.sessions(df, ["k"], "t", ["id"], "10 minutes", [F.count("*").alias("n"), F.sum("v").alias("s")], rows_per_slice)
    want = df.where("t IS NOT NULL").groupBy("k", F.session_window("t", "10 minutes").alias("w")).agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    want = want.select("w.start", "w.end", "k", "n", "s")
    key = lambda r: tuple(map(str, r))
    assert got.columns == ["session_start", "session_end", "k", "n", "s"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_ties_beyond_a_slice_end_the_search(spark):
    df = spark.createDataFrame([(1,)] * 500, "v int")
    with pytest.raises(ValueError):
        windows.ntile_at_scale(df, 4, {"b": ["v"]}, rows_per_slice=50)


def test_refresh_reads_the_touched_folders_only(spark):
    """Two far periods change; the folders in between hold files that cannot be read."""
    path, mart = scratch_path(spark, "facts"), scratch_path(spark, "mart")
    days = [f"2024-01-{d:02}" for d in range(1, 21)]
    facts = spark.createDataFrame([(d, i) for i, d in enumerate(days)] + [(None, 99)], "day string, v int")
    facts.write.partitionBy("day").parquet(path)
    build = lambda df: df.groupBy("day").agg(F.sum("v").alias("total"))
    schema = "v int, day string"
    incremental.refresh_mart(mart, spark.read.schema(schema).parquet(path), [facts.select("day")], "day", build)
    for d in days[1:-1]:
        spark.createDataFrame([("not a number",)], "v string").write.mode("overwrite").text(f"{path}/day={d}")
    changed = spark.createDataFrame([(days[0],), (days[-1],), (None,)], "day string")
    incremental.refresh_mart(mart, spark.read.schema(schema).parquet(path), [changed], "day", build)
    assert {r["day"]: r["total"] for r in spark.read.parquet(mart).withColumn("day", F.col("day").cast("string")).collect()} == {**{d: i for i, d in enumerate(days)}, None: 99}




def test_intervals_are_never_broadcast(spark):
    """The optimiser knows the size of a table, not of the bins its rows are copied to."""
    df = spark.range(1000).select("id", F.timestamp_seconds("id").alias("a1"), F.timestamp_seconds(F.col("id") + 5).alias("a2"))
    other = df.select("id", F.col("a1").alias("b1"), (F.col("a2") + F.expr("INTERVAL 1 DAY")).alias("b2"))
    got = temporal.interval_join(df, other, ["id"], ("a1", "a2"), ("b1", "b2"))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 1000
