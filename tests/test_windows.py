"""Windows at scale against Spark's own, with the slicing of hot keys forced."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from strataloom.operators import slices, windows
from strataloom.session import materialise
from tests.compare import SF_DIR, spark_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Events in which one user holds a third of all rows."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    return events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")))


def same(left, right):
    assert spark_rows(left) == spark_rows(right)


def plain_changes(df):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    prev = df.withColumn("p", F.lag("event_type").over(w))
    return prev.where("p is null or p <> event_type").drop("p")


@pytest.mark.parametrize("rows_per_slice", [100, 400, 1000])
def test_changes_of_a_hot_key(spark, skewed, rows_per_slice):
    args = (["user_id"], ["event_type"], ["ts", "event_id"])
    sliced = slices.slice_hot_keys(skewed, ["user_id"], ["ts", "event_id"], rows_per_slice)
    assert sliced.hot
    per_slice = sliced.rows.where(f"{slices.SLICE} >= 0").groupBy("user_id", slices.SLICE).count()
    assert per_slice.agg(F.max("count")).first()[0] < 3 * rows_per_slice
    assert per_slice.where("user_id = 7").count() > 1
    same(windows.changes(skewed, *args, rows_per_slice=rows_per_slice), plain_changes(skewed))


def test_changes_with_bounds_from_a_part(spark, skewed):
    part = skewed.where("ts >= timestamp_ntz'2024-01-10 00:00:00'")
    args = (["user_id"], ["event_type"], ["ts", "event_id"])
    same(windows.changes(skewed, *args, rows_per_slice=300, like=part), plain_changes(skewed))


@pytest.mark.parametrize("rows_per_slice", [100, 10_000_000, None])
def test_running_total_of_a_hot_key(spark, skewed, rows_per_slice):
    df = skewed.select("user_id", "ts", "event_id", F.col("value").cast("decimal(18,2)").alias("v"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    got = windows.running(df, ["user_id"], ["ts", "event_id"], "v", "sum", rows_per_slice)
    same(got, df.withColumn("sum", F.sum("v").over(w)))


def test_running_total_skips_nulls_across_slices(spark, skewed):
    df = skewed.select("user_id", "ts", "event_id", F.when(F.col("event_type") == "click", F.col("event_id")).alias("v"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    got = windows.running(df, ["user_id"], ["ts", "event_id"], "v", "sum", 150)
    same(got, df.withColumn("sum", F.sum("v").over(w)))


def test_hot_null_key(spark, skewed):
    df = skewed.withColumn("user_id", F.when(F.col("user_id") != 7, F.col("user_id")))
    got = windows.changes(df, ["user_id"], ["event_type"], ["ts", "event_id"], rows_per_slice=200)
    same(got, plain_changes(df))


def test_changes_count_nulls_as_values(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 2, None), (1, 3, "a"), (1, 4, None), (2, 1, "a"), (2, 2, "a")], "k int, o int, v string"
    )
    got = windows.changes(df, ["k"], ["v"], ["o"])
    assert sorted((r.k, r.o) for r in got.collect()) == [(1, 1), (1, 3), (1, 4), (2, 1)]


def builtin_ntile(df, n, order, name="b"):
    return df.withColumn(name, F.ntile(n).over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])))


@pytest.mark.parametrize("rows,n", [(1500, 5), (1500, 7), (1499, 11), (3, 5), (5, 5), (1, 5), (1000, 40), (200, 1)])
@pytest.mark.parametrize("rows_per_slice", [50, 1_000_000])
def test_ntile_equals_the_builtin(spark, rows, n, rows_per_slice):
    df = spark.range(rows).select(
        "id", F.when(F.col("id") % 9 > 0, F.pmod(F.xxhash64("id"), F.lit(50))).alias("v")
    )
    got = windows.ntile_at_scale(df, n, {"b": ["v", "id"]}, rows_per_slice)
    same(got, builtin_ntile(df, n, ["v", "id"]))


def test_ntile_of_nothing(spark):
    assert windows.ntile_at_scale(spark.range(0), 5, {"b": ["id"]}).count() == 0


def test_ntile_of_one_value_for_a_third_of_the_rows(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("decimal(18,2)").alias("v"))
    got = windows.ntile_at_scale(df, 6, {"b": ["v", "id"]}, 100)
    same(got, builtin_ntile(df, 6, ["v", "id"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60), n=st.integers(1, 9))
def test_ntile_property(spark, values, n):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    got = windows.ntile_at_scale(df, n, {"b": ["v", "id"]}, 10)
    same(got, builtin_ntile(df, n, ["v", "id"]))


def test_ntile_keeps_microseconds(spark):
    df = spark.range(400).select("id", F.timestamp_micros(F.lit(1700000000000000) + F.col("id") % 97).cast("timestamp_ntz").alias("v"))
    got = windows.ntile_at_scale(df, 4, {"b": ["v", "id"]}, 50)
    same(got, builtin_ntile(df, 4, ["v", "id"]))


def test_ntile_shuffles_no_row(spark):
    orders = materialise(spark.read.parquet(f"{SF_DIR}/orders.parquet"), "orders")
    got = windows.ntile_at_scale(orders, 5, {"b": ["o_totalprice", "o_orderkey"]})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_ntile_of_several_orders_in_one_go(spark):
    df = spark.range(700).select("id", (F.col("id") % 13).alias("v"), F.concat(F.lit("x"), F.col("id") % 7).alias("w"))
    orders = {"a": ["v", "id"], "b": ["w", "id"], "c": ["id"]}
    got = windows.ntile_at_scale(df, 4, orders, 64)
    want = df
    for name, order in orders.items():
        want = builtin_ntile(want, 4, order, name)
    same(got, want)


def test_a_thousand_buckets_in_three_orders(spark):
    df = materialise(spark.range(30_000).select("id", (F.col("id") * 7919 % 30_011).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("b")), "many")
    orders = {"x": ["a"], "y": ["b", "id"], "z": ["id"]}
    got = windows.ntile_at_scale(df, 1200, orders, rows_per_slice=500)
    w = {k: Window.orderBy(*[F.col(c).asc_nulls_first() for c in o]) for k, o in orders.items()}
    same(got, df.withColumns({k: F.ntile(1200).over(o) for k, o in w.items()}))


def test_slices_are_refined_until_they_fit(spark, monkeypatch):
    monkeypatch.setattr(windows, "NTILE_CUTS_PER_PASS", 20)
    df = materialise(spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("v")), "deep")
    passes = []
    counted = windows._slice_counts
    monkeypatch.setattr(windows, "_slice_counts", lambda *a: passes.append(1) or counted(*a))
    got = windows.ntile_at_scale(df, 4, {"x": ["v", "id"]}, rows_per_slice=60)
    assert len(passes) > 1
    same(got, df.withColumn("x", F.ntile(4).over(Window.orderBy("v", "id"))))


def test_late_row_of_a_key_with_a_long_history(spark):
    from strataloom.operators import vault

    start = spark.range(5000).select(F.lit(1).alias("user"), F.col("id").alias("at"), (F.col("id") % 4).cast("string").alias("kind"))
    stored = materialise(vault.load_satellite(None, start, "user", "hk", ["kind"], ["at"]), "stored")
    late = spark.createDataFrame([(1, 10, "9")], "user int, at long, kind string")
    new = vault.load_satellite(stored, late, "user", "hk", ["kind"], ["at"], rows_per_slice=200)
    assert slices.SLICE in new._jdf.queryExecution().toString()
    assert [(r["at"], r["kind"]) for r in new.collect()] == [(10, "9")]
