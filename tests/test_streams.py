"""The streaming path equals its batch twin, over several micro-batches and on replay."""

import pytest
from pyspark.sql import functions as F

from strataloom.operators import dedup, windows
from strataloom.session import scratch_path
from strataloom.sources import messages
from strataloom.streaming import streams
from tests.compare import SF_DIR, spark_rows

SPEC = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
        "value": "decimal(18,2)", "props": "string"}


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def land(events, path):
    encoded = messages.encode_messages(events, ["event_id"]).withColumn("timestamp", F.lit(0).cast("timestamp"))
    encoded.coalesce(1).write.mode("append").parquet(path)


def topic(spark, parts):
    """One file per part, oldest first."""
    path = scratch_path(spark, "topic")
    for part in parts:
        land(part, path)
    return path


def thirds(events):
    return [events.where(f"ts >= timestamp_ntz'{a} 00:00:00' and ts < timestamp_ntz'{b} 00:00:00'")
            for a, b in (("2023-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2025-01-01"))]


def start(stream, out, checkpoint):
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return q


def same(left, right):
    assert spark_rows(left) == spark_rows(right)


def one_by_one(spark, path, schema):
    return streams.read_stream(spark, "parquet", {"path": path, "maxFilesPerTrigger": "1"}, schema)


def test_dedup_over_three_micro_batches(spark, events):
    # Repeats come in the same and in the next micro-batch.
    a, b, c = thirds(events)
    repeats = events.where("ts >= timestamp_ntz'2024-01-10 12:00:00' and ts < timestamp_ntz'2024-01-11 00:00:00'")
    assert repeats.count() > 100
    path = topic(spark, [a.unionByName(repeats), b.unionByName(repeats), c])
    once = streams.dedup_stream(one_by_one(spark, path, events.schema), ["event_id"], "ts", "2 days")
    out = scratch_path(spark, "out")
    q = start(once, out, scratch_path(spark, "cp"))
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    got = spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*events.columns)
    twin = dedup.dedup_exact(events.unionByName(repeats), ["event_id"], "event_id")
    same(got, twin)


def test_late_rows_are_dropped_and_counted(spark, events):
    a, b, c = thirds(events)
    path, out, cp = topic(spark, [c]), scratch_path(spark, "out"), scratch_path(spark, "cp")
    late = streams.LateRows(spark, scratch_path(spark, "late"))
    total = lambda: late.counted().agg(F.coalesce(F.sum("dropped"), F.lit(0))).first()[0]

    def run():
        q = start(streams.dedup_stream(one_by_one(spark, path, events.schema), ["event_id"], "ts", "1 hour"), out, cp)
        late.settle()
        return q

    # The query keeps the progress of two batches only; the count does not depend on it.
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(late)
    try:
        run()
        assert total() == 0
        for part in (a, b.where("ts < timestamp_ntz'2024-01-15 00:00:00'"), b.where("ts >= timestamp_ntz'2024-01-15 00:00:00'"), a.where("event_type = 'view'")):
            land(part, path)
        assert len(run().recentProgress) <= 2
    finally:
        spark.streams.removeListener(late)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert total() == a.count() + b.count() + a.where("event_type = 'view'").count()
    assert late.counted().where("dropped > 0").count() == 4
    assert spark.read.parquet(out).count() == c.count()


def test_static_join_deals_a_hot_user_out(spark, events):
    # A third of the rows is one user's; none of the join's tasks gets them all.
    hot = events.withColumn("user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(7)).otherwise(F.col("user_id")))
    dim = spark.range(1000).select(F.col("id").alias("user_id"), F.lit("n").alias("name"))
    # As in a stateful stream: no adaptive execution, no broadcast.
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dealt = streams.enrich_stream(hot, dim, "user_id")
        sizes = [r["count"] for r in dealt.where("user_id = 7").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)
        same(dealt, hot.join(dim, "user_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_folded_batches_give_the_same_counters(spark, events):
    path, root = topic(spark, thirds(events)), scratch_path(spark, "layers")
    run = streams.layers(root, "events", "2024-02-01 00:00:00", SPEC)
    stream = one_by_one(spark, path, events.schema).drop("timestamp")
    streams.write_each_batch(stream, [run], scratch_path(spark, "cp")).awaitTermination()
    want = streams.user_counters(events)
    made = streams.fold_batches(spark, root, 0)
    same(streams.counters_view(spark, root, made), want)
    made = streams.fold_batches(spark, root, 1, made)
    streams.drop_folded(spark, root, made)
    assert made == 1 and spark.read.parquet(f"{root}/mart").select("batch_id").distinct().count() == 1
    same(streams.counters_view(spark, root, made), want)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_static_join_equals_batch(spark, events, how):
    customer = spark.read.parquet(f"{SF_DIR}/customer.parquet").where("c_acctbal > 3000")
    dim = customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    path = topic(spark, thirds(events))
    stream = one_by_one(spark, path, events.schema).drop("timestamp")
    out = scratch_path(spark, "out")
    start(streams.enrich_stream(stream, dim, "user_id", how), out, scratch_path(spark, "cp"))
    twin = events.join(dim, "user_id", how)
    assert twin.where("c_name is null").isEmpty() == (how == "inner")
    same(spark.read.parquet(out), twin)


def test_only_hot_keys_are_copied(spark, events):
    # Both sides have a column that is called like the one that deals the rows out.
    hot = events.withColumn("user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(7)).when(F.col("event_id") % 50 == 1, None)
                            .otherwise(F.col("user_id"))).withColumn("_salt", F.lit("x"))
    dim = spark.range(1000).select(F.col("id").alias("user_id"), F.lit("n").alias("name"), F.lit(1).alias("_salt_"))
    found = streams.hot_keys(hot, "user_id", 0.05)
    assert found == [7]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            dealt = streams.enrich_stream(hot, dim, "user_id", how, hot=found)
            same(dealt, hot.join(dim, "user_id", how))
        sizes = [r["count"] for r in dealt.where("user_id = 7").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)
        # Without a hot key nothing is copied or dealt.
        assert "Generate" not in plan(streams.enrich_stream(hot, dim, "user_id", hot=[]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert streams.hot_keys(hot.limit(0), "user_id") == []


def test_a_small_static_table_is_broadcast_as_it_is(spark, events):
    dim = spark.range(1000).select(F.col("id").alias("user_id"), F.lit("n").alias("name"))
    text = plan(streams.enrich_stream(events, dim, "user_id", "left"))
    assert "BroadcastHashJoin" in text and "Generate" not in text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_static_join_refuses_other_kinds(spark, events):
    with pytest.raises(ValueError):
        streams.enrich_stream(events, events, "user_id", "outer")


def test_layers_equal_batch_and_survive_a_replay(spark, events):
    path, root = topic(spark, thirds(events)), scratch_path(spark, "layers")
    run = streams.layers(root, "events", "2024-02-01 00:00:00", SPEC)
    stream = one_by_one(spark, path, events.schema).drop("timestamp")
    streams.write_each_batch(stream, [run], scratch_path(spark, "cp")).awaitTermination()
    assert spark.read.parquet(f"{root}/mart").select("batch_id").distinct().count() == 3
    want = streams.user_counters(events)
    same(streams.counters_view(spark, root), want)
    # The last batch once more, as after a failure before its commit.
    run(thirds(events)[2], 2)
    same(streams.counters_view(spark, root), want)


def test_fan_out_computes_once_and_replays_safely(spark, events):
    path = topic(spark, thirds(events))
    targets = [scratch_path(spark, "t") for _ in range(2)]
    writers = [streams.batch_files(t) for t in targets]
    seen = []

    def fail_once(df, batch_id):
        seen.append(batch_id)
        if batch_id == 1 and seen.count(1) == 1:
            raise RuntimeError("lost")

    cp = scratch_path(spark, "cp")
    stream = lambda: one_by_one(spark, path, events.schema).drop("timestamp")
    with pytest.raises(Exception, match="lost"):
        streams.write_each_batch(stream(), [*writers, fail_once], cp).awaitTermination()
    streams.write_each_batch(stream(), [*writers, fail_once], cp).awaitTermination()
    assert seen == [0, 1, 1, 2]
    for t in targets:
        same(spark.read.parquet(t).drop("batch_id"), events)


def test_corrupt_messages_are_kept_apart(spark, events):
    path = topic(spark, [events])
    bad = spark.createDataFrame([("k", "{broken", None)], "key string, value string, timestamp timestamp")
    bad.write.mode("append").parquet(path)
    stream = streams.read_stream(spark, "parquet", {"path": path}, events.schema, corrupt=True)
    out = scratch_path(spark, "out")
    start(stream, out, scratch_path(spark, "cp"))
    got = spark.read.parquet(out)
    assert got.count() == events.count() + 1
    assert got.where(f"{messages.CORRUPT} is not null").count() == 1


def test_messages_out_and_in_again(spark, events):
    path, sent = topic(spark, [events]), scratch_path(spark, "sent")
    stream = one_by_one(spark, path, events.schema).drop("timestamp")
    writer = streams.broker_messages(["event_id"], {"path": sent}, "parquet")
    streams.write_each_batch(stream, [writer], scratch_path(spark, "cp")).awaitTermination()
    same(messages.decode_messages(spark.read.parquet(sent), events.schema), events)


def closing(spark, events, kinds):
    """One event of each kind by a user of its own, far behind the others."""
    last = [(-1 - i, k) for i, k in enumerate(kinds)]
    df = spark.createDataFrame(last, "user_id bigint, event_type string").selectExpr(
        "user_id AS event_id", "timestamp_ntz'2030-01-01 00:00:00' AS ts", "user_id", "event_type", "CAST(NULL AS DOUBLE) AS value", "CAST(NULL AS STRING) AS props")
    return df.select(*events.columns)


def finished(stream, spark):
    out = scratch_path(spark, "out")
    q = (stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), q


def event_topic(spark, events, kinds):
    path = topic(spark, [*thirds(events), closing(spark, events, kinds)])
    return lambda: streams.read_stream(spark, "parquet", {"path": path, "maxFilesPerTrigger": "1"}, events.schema).drop("timestamp")


@pytest.mark.parametrize("size,slide", [("6 hours", "6 hours"), ("1 day", "7 hours")])
def test_event_time_windows_equal_their_batch_twin(spark, events, size, slide):
    read = event_topic(spark, events, ["view"])
    aggs = [F.count("*").alias("n"), F.max("event_id").alias("last")]
    got, q = finished(streams.window_totals(read(), "ts", size, slide, ["event_type"], aggs, "1 hour"), spark)
    want = streams.window_totals(events, "ts", size, slide, ["event_type"], aggs)
    assert spark_rows(got) == spark_rows(want) and want.count() > 100
    # Only the closing row's windows are still remembered.
    left = [o["numRowsTotal"] for o in q.lastProgress["stateOperators"]]
    assert left and max(left) <= 4


def test_sessions_in_a_stream_merge_over_batches(spark, events):
    read = event_topic(spark, events, ["view"])
    aggs = [F.count("*").alias("n"), F.max("event_id").alias("last")]
    got, q = finished(streams.session_totals(read(), "ts", "8 hours", ["user_id"], aggs, "1 hour"), spark)
    want = windows.sessions(events, ["user_id"], "ts", ["event_id"], "8 hours", aggs)
    cast = lambda df: df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
    assert spark_rows(cast(got)) == spark_rows(cast(want)) and want.count() > 100
    assert max(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]) <= 1


def test_rows_behind_the_watermark_are_dropped_from_windows_and_counted(spark, events):
    late = streams.LateRows(spark, scratch_path(spark, "late"))
    # A batch is late by the watermark that the batch before it went by, so the second one is not.
    path = topic(spark, [closing(spark, events, ["view"]), thirds(events)[1], thirds(events)[0]])
    stream = streams.read_stream(spark, "parquet", {"path": path, "maxFilesPerTrigger": "1"}, events.schema)
    spark.streams.addListener(late)
    try:
        got, _ = finished(streams.window_totals(stream, "ts", "1 day", "1 day", ["event_type"], [F.count("*").alias("n")], "1 hour"), spark)
        late.settle()
    finally:
        spark.streams.removeListener(late)
    assert spark_rows(got) == spark_rows(streams.window_totals(thirds(events)[1], "ts", "1 day", "1 day", ["event_type"], [F.count("*").alias("n")]))
    assert late.counted().agg(F.sum("dropped")).first()[0] > 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_two_streams_joined_within_a_day(spark, events, how):
    read = event_topic(spark, events, ["signup", "purchase"])
    sides = lambda df: (df.where("event_type = 'signup'").select("event_id", "user_id", "ts"),
                        df.where("event_type = 'purchase'").select(F.col("event_id").alias("message_id"), "user_id", F.col("ts").alias("sent_at")))
    (l, _), (_, r) = sides(read()), sides(read())
    got, q = finished(streams.join_streams(l, r, "user_id", "ts", "sent_at", "1 day", "1 hour", how), spark)
    a, b = sides(events.withColumn("ts", F.col("ts").cast("timestamp")))
    b = b.withColumnRenamed("user_id", "_on")
    want = a.join(b, (F.col("user_id") == F.col("_on")) & F.col("sent_at").between(F.col("ts"), F.col("ts") + F.expr("INTERVAL 1 DAY")), how).drop("_on")
    assert spark_rows(got) == spark_rows(want)
    assert how == "inner" or want.where("message_id IS NULL").count() > 10
    # State holds what lies within the interval of the newest rows: the closing ones.
    assert max(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]) <= 4
