"""Batch operators on small injected faults, repeats and round trips."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from strataloom.functions import values
from strataloom.operators import dedup, joins, model, quality, sets, vault
from strataloom.plans import incremental, marts
from strataloom.session import scratch_path
from strataloom.sources import lake, messages, payloads, relational
from tests.compare import SF_DIR, spark_rows


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def values_digest(spark, *row):
    return spark.range(1).select(values.digest(*[F.lit(v) for v in row])).first()[0]


def same(left, right):
    assert spark_rows(left) == spark_rows(right)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


# --- values ------------------------------------------------------------------

def test_digest_tells_nulls_and_borders_apart(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("ab", None, None), ("a", "", "b"), ("a", "-", "b"), ("a", "1:", "b")],
        "x string, y string, z string",
    )
    assert df.select(values.digest("x", "y", "z").alias("d")).distinct().count() == 6


def test_money_sum_is_exact_for_doubles_and_decimals(spark):
    df = spark.range(1000).select((F.col("id") * 0 + 0.1).alias("d"), F.lit("0.10").cast("decimal(18,2)").alias("e"))
    got = df.repartition(7).agg(values.money_sum(df, "d"), values.money_sum(df, "e")).first()
    assert [str(v) for v in got] == ["100.00", "100.00"]


def test_money_sum_is_the_sum_of_money(spark):
    rng = random.Random(6)
    odd = [1.005, 0.125, 2.675, 8.345, float("nan"), float("inf"), -float("inf"), 1e300, None]
    amounts = odd + [rng.uniform(-1e6, 1e6) for _ in range(2000)] + [rng.randrange(10**9) / 1000 for _ in range(2000)]
    df = spark.createDataFrame([(a,) for a in amounts], "d double").repartition(5)
    got = df.agg(values.money_sum(df, "d").alias("a"), F.sum(values.money("d")).alias("b")).first()
    assert got["a"] == got["b"] is not None
    few = df.where("d in (1.005, 0.125, 2.675, 8.345)")
    assert str(few.agg(values.money_sum(few, "d")).first()[0]) == "12.17"


def test_ratings_are_not_rounded_to_cents(spark):
    facts = spark.createDataFrame([(1, dt.datetime(2024, 1, d), 100.0, 19.996) for d in (1, 2, 3)],
                                  "courier_id int, delivered_at timestamp_ntz, amount double, rating double")
    row = marts.courier_payout(facts).first()
    assert (str(row["rate"]), str(row["payout"]), row["avg_rating"]) == ("0.05", "15.00", 19.996)


def test_money_sum_of_negative_amounts(spark):
    df = spark.createDataFrame([(-1.15,), (-0.05,), (2.3,)], "d double")
    assert str(df.agg(values.money_sum(df, "d")).first()[0]) == "1.10"


# --- sources -----------------------------------------------------------------

def test_lake_formats(spark, orders):
    root = scratch_path(spark, "formats")
    for fmt in lake.FORMATS:
        writer = orders.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        writer.save(f"{root}/orders.{fmt}")
        same(lake.read_table(spark, root, "orders", fmt, orders.schema), orders)
    with pytest.raises(ValueError):
        lake.read_table(spark, root, "orders", "json")
    with pytest.raises(ValueError):
        lake.read_table(spark, root, "orders", "xml")


def test_conversations_nested_and_flattened(spark):
    conv = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    docs = conv.groupBy("conv_id").agg(turns.alias("turns"))
    flat = payloads.flatten_docs(docs, "turns")
    same(flat.select(*conv.columns), conv)
    assert flat.where("pos <> turn").isEmpty()


def test_flatten_of_plain_elements_and_empty_documents(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, tags array<string>")
    assert rows(payloads.flatten_docs(df, "tags")) == [(1, 0, "a"), (1, 1, "b")]


def test_malformed_pages_and_messages(spark):
    df = spark.createDataFrame([('[{"a":1},{"a":2}]',), ("not json",), ("[]",)], "p string")
    assert rows(payloads.flatten_pages(df, "p", "a int").where("a is not null")) == [(1,), (2,)]
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    sent = spark.createDataFrame([('{"a":1}',), ("{oops",)], "value string")
    got = messages.decode_messages(sent, schema, corrupt=True)
    assert sorted(got.collect(), key=str) == sorted([(1, None), (None, "{oops")], key=str)


def test_messages_keep_microseconds(spark, events):
    same(messages.decode_messages(messages.encode_messages(events, ["event_id"]), events.schema), events)
    zoned = events.withColumn("ts", F.col("ts").cast("timestamp"))
    same(messages.decode_messages(messages.encode_messages(zoned, ["event_id"]), zoned.schema), zoned)


def test_columnar_store_prunes_partitions(spark, events):
    df = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    stored = lake.load_columnar(df, scratch_path(spark, "days"), ["day"], ["user_id", "ts"])
    same(stored, df)
    plan = stored.where("day = '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_hot_partition_is_written_by_several_tasks(spark):
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(8)
    month = F.when(F.col("l_orderkey") % 3 == 0, "1998-05").otherwise(marts.month("l_shipdate"))
    path = scratch_path(spark, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        stored = lake.load_columnar(lineitem.withColumn("ship_month", month), path, ["ship_month"], ["l_shipdate"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert stored.count() == lineitem.count()
    files = Counter(f.split("ship_month=")[1].split("/")[0] for f in stored.inputFiles())
    assert files["1998-05"] > 1 and Counter(files.values()).most_common(1)[0][0] == 1


def test_jdbc_adapter_needs_a_driver(spark):
    with pytest.raises(Exception, match="driver"):
        relational.read_jdbc(spark, "jdbc:postgresql://nowhere/db", "t", "id", 0, 10, 2)


# --- deduplication -----------------------------------------------------------

def test_dedup_exact_keeps_smallest_id_and_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", "x"), (5, None, None), (4, None, None)],
                               "id int, t string, u string")
    assert rows(dedup.dedup_exact(df, ["t", "u"], "id"), "id") == [(1,), (2,), (4,)]


def test_dedup_limits_a_key_before_the_shuffle(spark, events):
    plan = dedup.dedup_latest(events.repartition(4), ["user_id"], ["ts", "event_id"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(user_id"):]
    assert "WindowGroupLimit" in below and "Partial" in below


# --- joins -------------------------------------------------------------------

def test_lookup_broadcasts_only_what_is_small(spark, orders):
    customer = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.lookup(orders, customer, "o_custkey", "c_custkey")
        large = joins.lookup(orders, customer, "o_custkey", "c_custkey", rows=100)
        wide = joins.lookup(orders, customer, "o_custkey", "c_custkey", size=1000)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in wide._jdf.queryExecution().executedPlan().toString()
        same(small, large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_join_key_is_split(spark):
    """A third of all rows on one key: the join reads that partition in several pieces."""
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(8)
    part = spark.read.parquet(f"{SF_DIR}/part.parquet")
    hot = lineitem.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, 5).otherwise(F.col("l_partkey")))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.join_dims(hot, [(part, "l_partkey", "p_partkey")])
        assert len(joined.collect()) == lineitem.count()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


# --- modelling ---------------------------------------------------------------

def test_core_cleans_and_never_fails(spark):
    df = spark.createDataFrame([(" 7 ", " a ", "2024-01-01 00:00:00"), ("x", "  ", "soon"), (None, None, None)],
                               "n string, t string, at string")
    spec = {"n": "bigint", "t": "string", "at": "timestamp_ntz"}
    got = model.to_core(df, spec, {"t": "none"})
    assert [tuple(r) for r in got.collect()] == [
        (7, "a", dt.datetime(2024, 1, 1)), (None, "none", None), (None, "none", None)
    ]


def test_fact_sends_unmatched_and_null_keys_to_the_unknown_row(spark):
    dim = model.build_dim(spark.createDataFrame([(1, "a")], "k int, v string"), "k", ["v"], ["v"], "sk")
    fact = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, fk int")
    got = {r.id: r.sk for r in model.build_fact(fact, [(dim, "fk", "k", "sk")], ["id"]).collect()}
    assert got[2] == got[3] == values.UNKNOWN_KEY and got[1] == dim.first().sk


def test_dimension_keeps_the_newest_row(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "x", 3)], "k int, v string, at int")
    assert rows(model.build_dim(df, "k", ["v"], ["at"], "sk"), "sk", "k", "v") == sorted([(values_digest(spark, 1), 1, "new"), ("-1", None, None)], key=str)


# --- vault -------------------------------------------------------------------

def test_vault_loads_repeated_change_nothing(spark, events):
    hub = vault.load_hub(None, events, "user_id", "hk", "e", "2024-02-01 00:00:00")
    assert vault.load_hub(hub, events, "user_id", "hk", "e", "2024-02-02 00:00:00").isEmpty()
    link = vault.load_link(None, events, [("user_id", "u"), ("event_id", "e")], "hk", "e", "2024-02-01 00:00:00")
    again = vault.load_link(link, events, [("user_id", "u"), ("event_id", "e")], "hk", "e", "2024-02-02 00:00:00")
    assert again.isEmpty() and link.count() == events.count()
    args = ("user_id", "hk", ["event_type"], ["ts", "event_id"])
    sat = vault.load_satellite(None, events, *args)
    assert vault.load_satellite(sat, events, *args).isEmpty()


def test_hub_trims_and_skips_null_keys(spark):
    df = spark.createDataFrame([("a ",), ("a",), (None,), (" a",)], "k string")
    assert rows(vault.load_hub(None, df, "k", "hk", "s", "2024-01-01 00:00:00"), "k") == [("a",)]


def satellite(spark, data):
    return spark.createDataFrame(data, "k int, v string, at int")


def test_satellite_in_two_loads_equals_one(spark):
    data = [(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, None, 1), (1, "b", 4), (2, None, 5), (2, "c", 6), (1, "a", 7)]
    args = ("k", "hk", ["v"], ["at"])
    one = vault.load_satellite(None, satellite(spark, data), *args)
    for cut in range(1, len(data)):
        first = vault.load_satellite(None, satellite(spark, [r for r in data if r[2] <= cut]), *args)
        second = vault.load_satellite(first, satellite(spark, [r for r in data if r[2] > cut]), *args)
        same(first.unionByName(second), one)


def test_stored_satellite_equals_one_load(spark):
    data = [(k, v, i) for i, (k, v) in enumerate([(1, "a"), (1, "a"), (1, "b"), (2, None), (3, "z"), (1, "b"), (2, None), (2, "c"), (3, "z"), (None, "q")])]
    args = ("k", "hk", ["v"], ["at"])
    one = vault.load_satellite(None, satellite(spark, data), *args)
    for digits in (1, 2):
        path = scratch_path(spark, "stored-satellite")
        for cut in (data[:3], data[3:4], data[:0], data[4:], data):  # one is empty, the last repeats all
            new = vault.append_satellite(path, satellite(spark, cut), *args, digits=digits)
        assert new.isEmpty()
        same(vault.read_satellite(spark, path, new.schema, digits), one)
        with pytest.raises(ValueError):
            vault.stored_for(new, path, "hk", new.schema, digits + 1)


def test_stored_satellite_reads_touched_buckets_only(spark):
    args = ("k", "hk", ["v"], ["at"])
    path = scratch_path(spark, "stored-satellite")
    new = vault.append_satellite(path, satellite(spark, [(k, "a", 1) for k in range(2000)]), *args)
    keys = new.where("at = 1").orderBy("hk").limit(1)
    stored = vault.stored_for(keys, path, "hk", new.schema)
    first = keys.first()["hk"][:2]
    scans = stored._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^]]*_strataloom_bucket#\d+ = {first}\)\]", scans)
    same(stored, new.where(F.col("hk").startswith(first)))


def test_satellite_takes_a_late_row(spark):
    args = ("k", "hk", ["v"], ["at"])
    stored = vault.load_satellite(None, satellite(spark, [(1, "a", 1), (1, "b", 5), (2, "z", 2)]), *args)
    late = vault.load_satellite(stored, satellite(spark, [(1, "a", 2), (1, "c", 3), (1, "c", 4), (1, "b", 9)]), *args)
    assert rows(late, "v", "at") == [("c", 3)]


def test_satellite_of_a_hot_key(spark, events):
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")))
    args = ("user_id", "hk", ["event_type"], ["ts", "event_id"])
    plain = vault.load_satellite(None, hot, *args)
    cut = F.expr("timestamp_ntz'2024-01-05 00:00:00'")
    first = vault.load_satellite(None, hot.where(F.col("ts") < cut), *args, rows_per_slice=200)
    second = vault.load_satellite(first, hot.where(F.col("ts") >= cut), *args, rows_per_slice=200)
    same(first.unionByName(second), plain)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(1, 2), st.sampled_from(["a", "b", None])), min_size=2, max_size=12), cut=st.integers(1, 11))
def test_satellite_property(spark, data, cut):
    numbered = [(k, v, i) for i, (k, v) in enumerate(data)]
    last, want = {}, []
    for k, v, i in numbered:
        if k not in last or last[k] != v:
            want.append((k, v, i))
        last[k] = v
    args = ("k", "hk", ["v"], ["at"])
    first = vault.load_satellite(None, satellite(spark, numbered[:cut]), *args)
    # The second batch repeats the first one.
    second = vault.load_satellite(first, satellite(spark, numbered), *args)
    assert sorted((r.at, r.v) for r in first.unionByName(second).collect()) == [(i, v) for _, v, i in want]


# --- sets --------------------------------------------------------------------

def test_diff_counts_copies_both_ways(spark):
    left = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "b")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "c"), (3, "c")], "a int, b string")
    assert rows(sets.diff(left, right), "a", "side", "copies") == [(1, "left", 2), (2, "left", 1), (3, "right", 2)]
    assert sets.diff(left, left).isEmpty()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.sampled_from("abc"), max_size=9), right=st.lists(st.sampled_from("abc"), max_size=9))
def test_diff_property(spark, left, right):
    a, b = ([(x,) for x in side] for side in (left, right))
    got = sets.diff(spark.createDataFrame(a, "x string"), spark.createDataFrame(b, "x string"))
    want = [(x, "left", n) for x, n in (Counter(left) - Counter(right)).items()]
    want += [(x, "right", n) for x, n in (Counter(right) - Counter(left)).items()]
    assert rows(got) == sorted(want)


# --- quality -----------------------------------------------------------------

FAULTY = [
    (1, "a", 5, 1, 2), (1, "a", 5, 1, 2), (2, None, -1, 3, 2), (3, "zz", None, 1, None), (None, "b", 200, 2, 2),
]


def check(df, rule, refs=None):
    r = quality.run_checks(df, "t", [rule], refs).first()
    return r.failed, r.total, r.passed


@pytest.mark.parametrize("rule,failed", [
    (quality.not_null("s"), 1), (quality.accepted("s", ["a", "b"]), 1), (quality.in_range("v", 0, 100), 2),
    (quality.in_range("v", low=0), 1), (quality.in_order("x", "y"), 1), (quality.Unique(("k",)), 1),
    (quality.Reference("k", "ref", "k"), 2),
])
def test_each_rule_fails_on_faults_and_passes_on_clean_rows(spark, rule, failed):
    df = spark.createDataFrame(FAULTY, "k int, s string, v int, x int, y int")
    ref = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert check(df, rule, {"ref": ref}) == (failed, 5, False)
    clean = df.where("k = 1 and s = 'a'").limit(1).withColumn("k", F.lit(2))
    assert check(clean, rule, {"ref": ref}) == (0, 1, True)


def test_checks_of_an_empty_table_pass(spark):
    df = spark.createDataFrame([], "k int, s string")
    got = quality.run_checks(df, "t", [quality.not_null("s"), quality.Unique(("k",))])
    assert [(r.failed, r.total, r.passed) for r in got.collect()] == [(0, 0, True)] * 2


def test_row_rules_share_one_scan(spark, events):
    rules = [quality.not_null("ts"), quality.in_range("value", 0), quality.accepted("event_type", ["view"])]
    plan = quality.run_checks(events, "events", rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_reconcile_finds_lost_rows_and_values(spark, orders):
    lost = orders.where("o_orderkey > 10")
    got = quality.reconcile(orders, lost, "orders", {"o_totalprice": "decimal(18,2)"})
    assert [r.passed for r in got.collect()] == [False, False]
    assert all(r.passed for r in quality.reconcile(orders, orders, "orders", {"o_totalprice": "decimal(18,2)"}).collect())


def test_quarantine_splits_without_loss(spark):
    df = spark.createDataFrame(FAULTY, "k int, s string, v int, x int, y int")
    good, bad = quality.quarantine(df, [quality.not_null("k"), quality.in_range("v", 0, 100), quality.in_order("x", "y")])
    assert good.count() + bad.count() == 5
    assert rows(bad, "reason") == [("not_null:k;range:v",), ("range:v;order:x,y",)]


# --- marts -------------------------------------------------------------------

def test_payout_tiers_are_an_argument(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), 100.0, 4.0)], "courier_id int, delivered_at timestamp_ntz, amount double, rating double")
    assert str(marts.courier_payout(df).first().payout) == "5.00"
    assert str(marts.courier_payout(df, [(3, "0.01"), (None, "0.50")]).first().payout) == "50.00"


def test_conversion_bound_is_inclusive(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    data = [(u, t0, "signup") for u in (1, 2, 3, 4)]
    data += [(1, t0 + dt.timedelta(days=1), "purchase"), (2, t0 + dt.timedelta(days=1, microseconds=1), "purchase"),
             (3, t0 - dt.timedelta(microseconds=1), "purchase"), (4, t0, "purchase"), (1, t0 + dt.timedelta(days=9), "signup")]
    ev = spark.createDataFrame(data, "user_id int, ts timestamp_ntz, event_type string")
    us = spark.createDataFrame([(u, u) for u in (1, 2, 3, 4)], "user_id int, community int")
    got = marts.conversion_by_community(ev, us)
    assert rows(got, "community", "converted") == [(1, 1), (2, 0), (3, 0), (4, 1)]


# --- incremental -------------------------------------------------------------

def test_refresh_moves_rows_between_periods_and_drops_empty_ones(spark):
    schema = "account_id int, ordered_at timestamp_ntz, status string, amount double"
    at = lambda m: dt.datetime(2024, m, 3)
    before = spark.createDataFrame([(1, at(1), "F", 1.0), (2, at(2), "F", 2.0), (3, at(3), "F", 3.0)], schema)
    after = spark.createDataFrame([(1, at(1), "F", 1.0), (2, at(3), "F", 2.0), (3, at(3), "F", 3.0)], schema)
    with_month = lambda df: df.withColumn("month", marts.month("ordered_at"))
    build = lambda df: marts.daily_turnover(df).withColumn("month", marts.month("day"))
    path = scratch_path(spark, "refresh")
    incremental.rebuild_period(build(with_month(before)), path, "month")
    changed = [with_month(before).where("account_id = 2"), with_month(after).where("account_id = 2")]
    for _ in range(2):
        incremental.refresh_mart(path, with_month(after), changed, "month", build)
        same(lake.read_columnar(spark, path, build(with_month(after)).schema), build(with_month(after)))


def test_rebuild_leaves_other_periods_alone(spark, orders):
    df = orders.withColumn("month", marts.month("o_orderdate"))
    path = scratch_path(spark, "rebuild")
    incremental.rebuild_period(df, path, "month")
    for _ in range(2):
        incremental.rebuild_period(df.where("month = '1998-05'"), path, "month")
    same(lake.read_columnar(spark, path, df.schema), df)


def test_upsert_twice_equals_once_and_ignores_stale(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "k int, v string, ver int")
    chg = spark.createDataFrame([(1, "A", 2), (1, "AA", 3), (2, "old", 4), (4, "d", 1), (3, "C", 1)], "k int, v string, ver int")
    once = incremental.upsert(cur, chg, ["k"], ["ver"])
    assert rows(once) == [(1, "AA", 3), (2, "b", 5), (3, "C", 1), (4, "d", 1)]
    same(incremental.upsert(once, chg, ["k"], ["ver"]), once)


def test_increment_is_pushed_to_the_scan(spark, events):
    plan = incremental.read_increment(events, "ts", "2024-01-16")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan


def test_journal_line_from_the_write_itself(spark, orders):
    df, line = incremental.observed(orders, "orders", "o_orderkey")
    df.write.format("noop").mode("overwrite").save()
    assert line.get == {"rows": 15000, "lowest": 0, "highest": 14999}


# --- a mart's refresh where periods empty, have no name, or an odd one --------

def refreshed(spark, before, after, changed, keep=lambda df: df):
    """The mart after a refresh, and a full rebuild of it."""
    build = lambda df: keep(df).groupBy("period").agg(F.sum("v").alias("v"))
    frame = lambda rows: spark.createDataFrame(rows, "period string, v int")
    path = scratch_path(spark, "mart")
    incremental.rebuild_period(build(frame(before)), path, "period")
    incremental.refresh_mart(path, frame(after), [frame(changed)], "period", build)
    got = spark.read.schema("v long, period string").parquet(path)
    return rows(got, "period", "v") if not got.where("period is null").count() else Counter(map(tuple, got.select("period", "v").collect())), build(frame(after))


def test_refresh_drops_a_period_that_the_build_filters_away(spark):
    got, want = refreshed(spark, [("2024-01", 10), ("2024-02", 5)], [("2024-01", 0), ("2024-02", 5)], [("2024-01", 0)], lambda df: df.where("v > 0"))
    assert got == rows(want, "period", "v") == [("2024-02", 5)]


def test_refresh_reaches_rows_without_a_period(spark):
    got, want = refreshed(spark, [(None, 10), ("2024-02", 5)], [(None, 99), ("2024-02", 5)], [(None, 99)])
    assert got == Counter(map(tuple, want.collect())) == Counter([(None, 99), ("2024-02", 5)])
    got, _ = refreshed(spark, [(None, 10), ("2024-02", 5)], [("2024-02", 5)], [(None, 10)])
    assert got == [("2024-02", 5)]


def test_refresh_drops_a_period_with_an_odd_name(spark):
    got, want = refreshed(spark, [("2024/01", 10), ("a=b c%", 1), ("x", 5)], [("x", 5)], [("2024/01", 10), ("a=b c%", 1)])
    assert got == rows(want, "period", "v") == [("x", 5)]


def test_refresh_of_unchanged_facts_changes_nothing(spark):
    got, want = refreshed(spark, [("a", 1)], [("a", 1), ("b", 9)], [])
    assert got == [("a", 1)]


def test_refresh_reads_only_the_touched_folders(spark, monkeypatch):
    facts = lake.load_columnar(spark.range(100).select(F.concat(F.lit("p"), F.col("id") % 10).alias("period"), F.col("id").alias("v")), scratch_path(spark, "facts"), ["period"])
    plans = []

    def build(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.groupBy("period").agg(F.sum("v").alias("v"))

    incremental.refresh_mart(scratch_path(spark, "mart"), facts, [facts.where("period in ('p0', 'p9')")], "period", build)
    assert "dynamicpruning" in plans[0]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_upsert_shuffles_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("version"))
        assert exchanges(incremental.upsert(base, base.where("k < 10"), ["k"], ["version"])) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_table_is_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)
    wide = spark.range(50).select("id", (F.col("id") % 5).alias("k"), F.lit("a").alias("attr"))
    tables = model.split_wide(wide, {"d": model.DimSpec("k", ("attr",), "sk")})
    for df in tables.values():
        assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert tables["d"].count() == 6 and tables["fact"].count() == 50 and calls.value == 0


# --- landed data without silent loss -----------------------------------------

def test_broken_pages_are_kept_apart(spark):
    pages = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (2, "[]"), (3, '[{"a":3},{"a":'), (4, None), (5, "")], "page int, payload string")
    assert rows(payloads.flatten_pages(pages, "payload", "a int")) == [(1,), (2,)]
    assert [r[0] for r in rows(payloads.rejected_pages(pages, "payload", "a int"), "page")] == [3, 5] or [r[0] for r in rows(payloads.rejected_pages(pages, "payload", "a int"), "page")] == [3]


def test_documents_keep_their_other_fields(spark):
    schema = "id int, body struct<title: string, inner: struct<n: int, lines: array<struct<id: int, line: string>>>>"
    docs = spark.createDataFrame([(1, ("t", (7, [(5, "x"), (6, "y")]))), (2, ("u", (8, []))), (3, None)], schema)
    inner = payloads.flatten_docs(docs, "body.inner.lines")
    assert inner.columns == ["id", "body", "pos", "item_id", "line"]
    got = inner.select("id", "body.title", "body.inner.n", "pos", "item_id", "line")
    assert rows(got) == [(1, "t", 7, 0, 5, "x"), (1, "t", 7, 1, 6, "y")]
    outer = payloads.flatten_docs(docs, "body.inner.lines", outer=True)
    assert sorted(r["id"] for r in outer.collect()) == [1, 1, 2, 3]


def test_broken_json_text_is_kept(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "oops"), (3, None)], "id int, props string")
    got = {r["id"]: (r["k"], r["bad"]) for r in payloads.extract_json(df, "props", "k int", "bad").collect()}
    assert got == {1: (3, None), 2: (None, "oops"), 3: (None, None)}


def test_unknown_rows_join_their_dimension(spark):
    dim = model.build_dim(spark.createDataFrame([(1, "a", 1)], "k int, v string, at int"), "k", ["v"], ["at"], "sk")
    facts = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, k2 int")
    fact = model.build_fact(facts, [(dim, "k2", "k", "sk")], ["id"])
    assert rows(fact.join(dim, "sk"), "id") == [(10,), (11,), (12,)]


def test_a_large_lookup_is_not_measured(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    monkeypatch.setattr(joins, "_width", lambda f: 1 / 0)
    assert not joins.small_enough(df, size=1000)
