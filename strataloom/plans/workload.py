"""The registered queries: each operator over whole tables of a lake folder.

Names of people and things are stand-ins: suppliers deliver, nations are
communities, a purchase is a message.  FIXTURES.md has the mapping.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from strataloom.functions.values import MONEY, MONEY_SUM, money, money_sum
from strataloom.operators import aggregates, dedup, filters, joins, model, quality, ranks, sets, sketches, temporal, vault, windows
from strataloom.plans import incremental, marts
from strataloom.session import materialise, own_session, scratch_path, size_for
from strataloom.sources import lake, messages, payloads
from strataloom.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]

# The points in time at which the tables are cut into loads.
ORDERS_CUT = "1998-07-15"
TURNOVER_CUT = "2000-03-15"
EVENTS_CUT = "2024-01-16"
LANDED_AT = ("2024-01-11", "2024-01-21")
HEARTBEAT_AT = "2030-01-01 00:00:00"
# Offers of a part, in days.
OFFERS_FROM, OFFER_DAYS = "1995-06-01 00:00:00", (1, 30, 1500)
LOADED_AT = ("2024-02-01 00:00:00", "2024-02-02 00:00:00")

REGISTRY: dict[str, Query] = {}


class Lake:
    """The tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        # Counting the rows of a state looks each key up once more; nothing here asks for it.
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")

    def __getattr__(self, name: str) -> DataFrame:
        self.__dict__[name] = table = lake.read_table(self.spark, self.root, name)
        size_for(table, fine=True)
        return table

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals and dates as text, which every engine shows alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, root: comparable(fn(Lake(own_session(spark), root)))
    return fn


# --- stand-ins ---------------------------------------------------------------

def closed_orders(t: Lake) -> DataFrame:
    return filters.filter_status(t.orders, "o_orderstatus", ["F"]).select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ordered_at"),
        F.col("o_totalprice").alias("amount"),
    )


def users(t: Lake) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("user_id"))


def deliveries(t: Lake) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("courier_id"), F.col("l_shipdate").alias("delivered_at"),
        F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("rating"),
    )


def account_orders(t: Lake, ordered_at: Column | None = None) -> DataFrame:
    at = F.col("o_orderdate") if ordered_at is None else ordered_at
    return t.orders.select(
        F.col("o_custkey").alias("account_id"), at.alias("ordered_at"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"),
        "o_orderdate", "o_orderpriority",
    )


def geography(t: Lake) -> DataFrame:
    """Customers with nation and region; the two lookup tables are small and measured."""
    with_nation = joins.lookup(t.customer, t.nation, "c_nationkey", "n_nationkey")
    return joins.lookup(with_nation, t.region, "n_regionkey", "r_regionkey")


WIDE_SPEC = {
    "customer": model.DimSpec("c_custkey", ("c_name", "c_acctbal", "c_mktsegment"), "customer_sk"),
    "nation": model.DimSpec("n_nationkey", ("n_name", "r_name"), "nation_sk"),
}


def wide_orders(t: Lake) -> DataFrame:
    wide = joins.join_dims(t.orders, [(geography(t), "o_custkey", "c_custkey")])
    return wide.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "c_custkey", "c_name",
        "c_acctbal", "c_mktsegment", "n_nationkey", "n_name", "r_name",
    )


EVENT_SPEC = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
    "value": "decimal(18,2)", "props": "string",
}


def land_events(t: Lake, events: DataFrame, label: str) -> str:
    """``events`` as a folder of messages, the stand-in for a broker's topic."""
    path = t.scratch(label)
    # In three steps of time, as a topic grows: no row lies behind the watermark.
    step = F.when(F.col("ts") >= F.lit(LANDED_AT[1]).cast("timestamp_ntz"), 2).when(
        F.col("ts") >= F.lit(LANDED_AT[0]).cast("timestamp_ntz"), 1).otherwise(0)
    for k in range(3):
        encoded = messages.encode_messages(events.where(step == k), ["event_id"])
        landed = encoded.withColumn("timestamp", F.lit(LOADED_AT[0]).cast("timestamp"))
        landed.repartition(files_a_step(t)).write.mode("append").parquet(path)
    return path


def files_a_step(t: Lake) -> int:
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


def event_stream(t: Lake, path: str) -> DataFrame:
    # A micro-batch for each step that landed.
    options = {"path": path, "maxFilesPerTrigger": str(files_a_step(t))}
    return streams.read_stream(t.spark, "parquet", options, t.events.schema).drop("timestamp")


def run_to_end(t: Lake, stream: DataFrame, label: str, checkpoint: str | None = None):
    """Run ``stream`` over all that has landed; returns its output folder and the query."""
    out = t.scratch(label)
    q = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint or t.scratch(f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return out, q


def without_zone(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


# --- scans, sources, sinks ---------------------------------------------------

@query
def lake_read(t: Lake) -> DataFrame:
    return t.orders


def landed_pages(t: Lake) -> DataFrame:
    """Pages of up to 100 order numbers; one in seven is cut off before its end, one empty."""
    page = F.expr("o_orderkey div 100")
    landed = t.orders.select(page.alias("page"), F.struct(*t.orders.columns).alias("r")).groupBy("page").agg(
        F.to_json(F.collect_list("r"), payloads.JSON_TIMES).alias("payload")
    )
    kind = F.pmod("page", F.lit(7))
    cut = F.expr("substr(payload, 1, length(payload) - 5)")
    return landed.withColumn("payload", F.when(kind == 3, cut).when(kind == 5, F.lit("[]")).otherwise(F.col("payload")))


@query
def landed_pages_flatten(t: Lake) -> DataFrame:
    return payloads.flatten_pages(landed_pages(t), "payload", t.orders.schema)


@query
def landed_pages_rejected(t: Lake) -> DataFrame:
    return payloads.rejected_pages(landed_pages(t), "payload", t.orders.schema).select("page")


@query
def documents_flatten(t: Lake) -> DataFrame:
    # One document per turn, holding its text as a nested array of lines beside a
    # title; the system's turns have no lines, and every seventh text is broken.
    lines = F.when(F.col("role") == "system", F.array().cast("array<struct<line:string>>")).otherwise(
        F.transform(F.split("text", "\n"), lambda s: F.struct(s.alias("line"))))
    body = F.struct(F.concat("role", F.lit("!")).alias("title"), lines.alias("lines"))
    doc = F.to_json(F.struct("conv_id", "turn", "role", body.alias("body")))
    broken = F.when(F.pmod("turn", F.lit(7)) == 6, F.lit("{")).otherwise(doc)
    schema = "conv_id bigint, turn bigint, role string, body struct<title: string, lines: array<struct<line: string>>>"
    docs = payloads.extract_json(t.conversations.select(broken.alias("doc")), "doc", schema, "rejected")
    flat = payloads.flatten_docs(docs, "body.lines", outer=True)
    return flat.select("conv_id", "turn", "role", F.col("body.title").alias("title"), "pos", "line", "rejected")


@query
def json_props(t: Lake) -> DataFrame:
    props = F.when(F.col("event_type") == "error", F.lit("oops")).otherwise(F.col("props"))
    return payloads.extract_json(t.events.select("event_id", props.alias("props")), "props", "k bigint", "rejected")


@query
def cold_to_columnar(t: Lake) -> DataFrame:
    df = t.lineitem.withColumn("ship_month", marts.month("l_shipdate"))
    return lake.load_columnar(df, t.scratch("columnar"), ["ship_month"], ["l_shipdate", "l_orderkey"])


@query
def kafka_encode(t: Lake) -> DataFrame:
    # A double's text differs between engines, so the value goes as a whole number.
    events = t.events.withColumn("value", F.round(F.col("value") * 100).cast("bigint"))
    return messages.encode_messages(events, ["event_id", "user_id"])


@query
def kafka_round_trip(t: Lake) -> DataFrame:
    encoded = messages.encode_messages(t.events, ["event_id"])
    return messages.decode_messages(encoded, t.events.schema)


# --- layers and modelling ----------------------------------------------------

@query
def staging_load(t: Lake) -> DataFrame:
    return model.to_staging(t.orders, "orders", LOADED_AT[0])


ORDERS_SPEC = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "decimal(18,2)", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query
def core_typed(t: Lake) -> DataFrame:
    staged = model.to_staging(t.orders, "orders", LOADED_AT[0])
    return model.to_core(staged, ORDERS_SPEC, {"o_orderpriority": "5-LOW"})


def wide_items(t: Lake) -> DataFrame:
    return joins.join_dims(t.lineitem, [(t.part, "l_partkey", "p_partkey")])


PART_ATTRS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query
def dim_build(t: Lake) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return model.build_dim(wide_items(t), "p_partkey", PART_ATTRS, order, "part_sk")


@query
def fact_build(t: Lake) -> DataFrame:
    # Only the smaller half of the parts is known, so the other rows must go to
    # the unknown part.
    known = t.part.where("p_size <= 25")
    dim = model.build_dim(known, "p_partkey", PART_ATTRS, ["p_name"], "part_sk")
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    fact = model.build_fact(t.lineitem, [(dim, "l_partkey", "p_partkey", "part_sk")], keep)
    # Joined with its dimension again, the fact keeps all its rows.
    return fact.join(dim.select("part_sk", "p_partkey", "p_brand"), "part_sk")


@query
def model_split(t: Lake) -> DataFrame:
    return model.split_wide(wide_orders(t), WIDE_SPEC)["fact"]


@query
def model_split_sizes(t: Lake) -> DataFrame:
    tables = model.split_wide(wide_orders(t), WIDE_SPEC)
    sizes = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return sets.union_sources(sizes)


@query
def compat_view(t: Lake) -> DataFrame:
    wide = wide_orders(t)
    # The dimensions are stored tables, as after a real split, so the join knows
    # their size.
    tables = {
        name: df if name == "fact" else materialise(df, name)
        for name, df in model.split_wide(wide, WIDE_SPEC).items()
    }
    return model.wide_view(tables, WIDE_SPEC, wide.columns)


def order_batches(t: Lake) -> list[DataFrame]:
    later = F.coalesce(F.col("o_orderdate") >= F.lit(ORDERS_CUT).cast("timestamp_ntz"), F.lit(False))
    return [t.orders.where(~later), t.orders.where(later)]


@query
def vault_hub(t: Lake) -> DataFrame:
    hub = None
    for batch, at in zip(order_batches(t), LOADED_AT, strict=True):
        new = vault.load_hub(hub, batch, "o_custkey", "customer_hk", "orders", at)
        hub = new if hub is None else hub.unionByName(new)
    return hub


@query
def vault_link(t: Lake) -> DataFrame:
    link, keys = None, [("o_orderkey", "order_hk"), ("o_custkey", "customer_hk")]
    for batch, at in zip(order_batches(t), LOADED_AT, strict=True):
        new = vault.load_link(link, batch, keys, "order_customer_hk", "orders", at)
        link = new if link is None else link.unionByName(new)
    return link


def event_satellite(t: Lake) -> DataFrame:
    later = F.coalesce(F.col("ts") >= F.lit(EVENTS_CUT).cast("timestamp_ntz"), F.lit(False))
    args = ("user_id", "user_hk", ["event_type"], ["ts", "event_id"])
    first = vault.load_satellite(None, t.events.where(~later), *args)
    path = t.scratch("satellite")
    first.write.parquet(path)
    stored = t.spark.read.schema(first.schema).parquet(path)
    second = vault.load_satellite(stored, t.events.where(later), *args)
    return stored.unionByName(second)


@query
def vault_satellite(t: Lake) -> DataFrame:
    return event_satellite(t)


@query
def vault_satellite_stored(t: Lake) -> DataFrame:
    later = F.coalesce(F.col("ts") >= F.lit(EVENTS_CUT).cast("timestamp_ntz"), F.lit(False))
    args = ("user_id", "user_hk", ["event_type"], ["ts", "event_id"])
    path = t.scratch("satellite")
    for batch in (t.events.where(~later), t.events.where(later)):
        new = vault.append_satellite(path, batch, *args)
    return vault.read_satellite(t.spark, path, new.schema)


@query
def vault_current(t: Lake) -> DataFrame:
    return vault.current(event_satellite(t), "user_hk", ["ts", "event_id"])


# --- deduplication, filters, joins -------------------------------------------

@query
def dedup_exact(t: Lake) -> DataFrame:
    return dedup.dedup_exact(t.documents, ["text"], "doc_id")


LINE_KEY = ["l_orderkey", "l_linenumber"]


@query
def dedup_latest(t: Lake) -> DataFrame:
    rest = [c for c in t.lineitem.columns if c not in (*LINE_KEY, "l_shipdate")]
    return dedup.dedup_latest(t.lineitem, LINE_KEY, ["l_shipdate", *rest])


@query
def filter_status(t: Lake) -> DataFrame:
    return filters.filter_status(t.orders, "o_orderstatus", ["F"])


@query
def active_window(t: Lake) -> DataFrame:
    return filters.active(t.events, "ts", "2024-01-08", "2024-01-15")


@query
def join_inner(t: Lake) -> DataFrame:
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    return joins.join_dims(items, [(orders, "l_orderkey", "o_orderkey"), (parts, "l_partkey", "p_partkey")])


@query
def join_left_unknown(t: Lake) -> DataFrame:
    known = t.customer.where("c_mktsegment <> 'HOUSEHOLD'")
    dim = model.build_dim(known, "c_custkey", ["c_name", "c_mktsegment"], ["c_name"], "customer_sk")
    return model.build_fact(
        t.orders, [(dim, "o_custkey", "c_custkey", "customer_sk")], ["o_orderkey", "o_custkey", "o_totalprice"]
    )


@query
def join_broadcast_lookup(t: Lake) -> DataFrame:
    return geography(t)


@query
def join_semi(t: Lake) -> DataFrame:
    changed = t.events.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("o_custkey"))
    return joins.touched(t.orders, changed, ["o_custkey"])


@query
def join_anti(t: Lake) -> DataFrame:
    known = t.customer.where("c_mktsegment <> 'HOUSEHOLD'")
    return joins.not_in(t.orders, known, [("o_custkey", "c_custkey")])


# --- aggregations, windows, sets ---------------------------------------------

@query
def asof_join(t: Lake) -> DataFrame:
    # What a user had done last when buying; actions are versions that hold for a day.
    bought = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    actions = t.events.where("event_type <> 'purchase'").select(
        "user_id", F.col("ts").alias("since"), F.col("event_id").alias("action_id"), F.col("event_type").alias("action"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("until"))
    return temporal.asof_join(bought, actions, ["user_id"], "ts", "since", ["action_id", "action"], "until")


@query
def interval_join(t: Lake) -> DataFrame:
    # Deliveries take as many days as there are pieces; a part has offers of very different lengths.
    sent = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").alias("sent_at"),
                             (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias("due_at")).withColumnRenamed("l_partkey", "part")
    begin = F.lit(OFFERS_FROM).cast("timestamp_ntz")
    days = F.explode(F.array(*[F.lit(d) for d in OFFER_DAYS]))
    offers = t.part.select(F.col("p_partkey").alias("part"), days.alias("days"), (F.col("p_size") * 20).alias("wait")).select(
        "part", "days", (begin + F.make_dt_interval(F.col("wait"))).alias("opens_at"), (begin + F.make_dt_interval(F.col("wait") + F.col("days"))).alias("ends_at"))
    return temporal.interval_join(sent, offers, ["part"], ("sent_at", "due_at"), ("opens_at", "ends_at"))


@query
def range_frame(t: Lake) -> DataFrame:
    bought = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("price"))
    return temporal.trailing(bought, ["o_custkey"], "o_orderdate", 90 * 86400, {
        "n_90_days": F.count("*"), "spent_90_days": F.sum("price"), "most_90_days": F.max("price")})


@query
def agg_group(t: Lake) -> DataFrame:
    total = money_sum(t.orders, "o_totalprice")
    return aggregates.summarise(t.orders, ["o_custkey"], {
        "n_orders": F.count("*"),
        "total": total,
        "average": total.cast("double") / F.count("*"),
        "smallest": F.min("o_totalprice"),
        "largest": F.max("o_totalprice"),
        "first_order": F.min("o_orderdate"),
        "last_order": F.max("o_orderdate"),
    })


@query
def agg_distinct(t: Lake) -> DataFrame:
    return aggregates.distinct_per(t.events.withColumn("day", marts.day("ts")), ["day"], "user_id")


@query
def agg_conditional(t: Lake) -> DataFrame:
    hit, base = F.col("event_type") == "purchase", F.col("event_type").isin("purchase", "view")
    return aggregates.ratio(t.events, ["user_id"], hit, base)


@query
def token_count(t: Lake) -> DataFrame:
    return aggregates.token_count(t.documents, "text")


@query
def ntile_global(t: Lake) -> DataFrame:
    spend = t.orders.groupBy("o_custkey").agg(money_sum(t.orders, "o_totalprice").alias("total"))
    return windows.ntile_at_scale(materialise(spend, "spend"), 5, {"bucket": ["total", "o_custkey"]})


@query
def lag_change(t: Lake) -> DataFrame:
    return windows.changes(t.events, ["user_id"], ["event_type"], ["ts", "event_id"])


@query
def running_total(t: Lake) -> DataFrame:
    monthly = marts.courier_payout(deliveries(t)).select("courier_id", "month", "payout")
    # One row per courier and month: no courier can be hot.
    total = windows.running(monthly, ["courier_id"], ["month"], "payout", "paid_so_far", None)
    return total.withColumn("paid_so_far", F.col("paid_so_far").cast(MONEY_SUM))


@query
def top_k(t: Lake) -> DataFrame:
    spend = t.orders.groupBy("o_custkey").agg(money_sum(t.orders, "o_totalprice").alias("total"))
    return sets.top_k(spend, "total", "o_custkey", 25)


@query
def union_sources(t: Lake) -> DataFrame:
    return sets.union_sources(order_batches(t))


@query
def except_recon(t: Lake) -> DataFrame:
    # Core has lost the urgent orders and carries the rounded price of the rest.
    staged = t.orders.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"))
    core = t.orders.where("o_orderpriority <> '1-URGENT'").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.round("o_totalprice", 0)).otherwise(F.col("o_totalprice"))
        .cast(MONEY).alias("price"),
    )
    return sets.diff(staged, core)


# --- streams -----------------------------------------------------------------

@query
def stream_read(t: Lake) -> DataFrame:
    stream = event_stream(t, land_events(t, t.events, "topic"))
    out, _ = run_to_end(t, stream, "read")
    return t.spark.read.schema(t.events.schema).parquet(out)


@query
def stream_dedup(t: Lake) -> DataFrame:
    # Every purchase is sent twice.
    sent = t.events.unionByName(t.events.where(F.col("event_type") == "purchase"))
    stream = event_stream(t, land_events(t, sent, "topic"))
    once = streams.dedup_stream(stream, ["event_id"], "ts", "1 day")
    out, _ = run_to_end(t, once, "dedup")
    return without_zone(t.spark.read.schema(once.schema).parquet(out), "ts")


@query
def stream_static_join(t: Lake) -> DataFrame:
    sent = t.events.unionByName(t.events.where(F.col("event_type") == "purchase"))
    stream = event_stream(t, land_events(t, sent, "topic"))
    once = streams.dedup_stream(stream, ["event_id"], "ts", "1 day")
    known = t.customer.where("c_mktsegment <> 'HOUSEHOLD'")
    dim = known.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    joined = streams.enrich_stream(once, dim, "user_id", "left")
    out, _ = run_to_end(t, joined, "enriched")
    return without_zone(t.spark.read.schema(joined.schema).parquet(out), "ts")


def with_heartbeats(t: Lake, kinds: list[str]) -> DataFrame:
    """The events and, far behind them, one of each kind by a user of its own: they end all windows."""
    beats = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(-1 - i).cast("bigint").alias("user")) for i, k in enumerate(kinds)]))
    last = t.events.limit(1).select(beats.alias("beat")).select(
        F.col("beat.user").alias("event_id"), F.lit(HEARTBEAT_AT).cast("timestamp_ntz").alias("ts"), F.col("beat.user").alias("user_id"),
        F.col("beat.kind").alias("event_type"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props"))
    return t.events.unionByName(last)


def value_totals() -> list[Column]:
    return [F.count("*").alias("n"), F.sum(money("value")).cast(MONEY_SUM).alias("total")]


@query
def stream_windows(t: Lake) -> DataFrame:
    stream = event_stream(t, land_events(t, with_heartbeats(t, ["view"]), "topic"))
    totals = streams.window_totals(stream, "ts", "1 day", "6 hours", ["event_type"], value_totals(), "1 hour")
    out, _ = run_to_end(t, totals, "windows")
    return without_zone(without_zone(t.spark.read.schema(totals.schema).parquet(out), "window_start"), "window_end")


@query
def window_totals(t: Lake) -> DataFrame:
    totals = streams.window_totals(t.events, "ts", "1 day", "6 hours", ["event_type"], value_totals())
    return without_zone(without_zone(totals, "window_start"), "window_end")


@query
def stream_sessions(t: Lake) -> DataFrame:
    stream = event_stream(t, land_events(t, with_heartbeats(t, ["view"]), "topic"))
    totals = streams.session_totals(stream, "ts", "6 hours", ["user_id"], value_totals(), "1 hour")
    out, _ = run_to_end(t, totals, "sessions")
    return without_zone(without_zone(t.spark.read.schema(totals.schema).parquet(out), "session_start"), "session_end")


@query
def session_totals(t: Lake) -> DataFrame:
    return windows.sessions(t.events, ["user_id"], "ts", ["event_id"], "6 hours", value_totals())


@query
def stream_interval_join(t: Lake) -> DataFrame:
    # Who signed up, and each message within a day of it as it comes.
    path = land_events(t, with_heartbeats(t, ["signup", "purchase"]), "topic")
    joined = event_stream(t, path).where("event_type = 'signup'").select("event_id", "user_id", "ts")
    sent = event_stream(t, path).where("event_type = 'purchase'").select(
        F.col("event_id").alias("message_id"), "user_id", F.col("ts").alias("sent_at"))
    both = streams.join_streams(joined, sent, "user_id", "ts", "sent_at", "1 day", "1 hour", "left")
    out, _ = run_to_end(t, both, "joined")
    return without_zone(without_zone(t.spark.read.schema(both.schema).parquet(out), "ts"), "sent_at")


@query
def stream_fanout(t: Lake) -> DataFrame:
    stream = event_stream(t, land_events(t, t.events, "topic"))
    one, two = t.scratch("target"), t.scratch("target")
    writers = [streams.batch_files(one), streams.batch_files(two)]
    streams.write_each_batch(stream, writers, t.scratch("fanout-checkpoint")).awaitTermination()
    read = [t.spark.read.schema(t.events.schema).parquet(f"{p}/batch_id=*") for p in (one, two)]
    return sets.union_sources([df.withColumn("target", F.lit(n)) for df, n in zip(read, ("a", "b"), strict=True)])


@query
def stream_layers(t: Lake) -> DataFrame:
    stream = event_stream(t, land_events(t, t.events, "topic"))
    root = t.scratch("layers")
    run = streams.layers(root, "events", LOADED_AT[0], EVENT_SPEC)
    streams.write_each_batch(stream, [run], t.scratch("layers-checkpoint")).awaitTermination()
    return streams.counters_view(t.spark, root)


@query
def stream_late(t: Lake) -> DataFrame:
    # The newer half arrives first; the older half then lies behind the watermark.
    cut = F.lit(EVENTS_CUT).cast("timestamp_ntz")
    path = land_events(t, t.events.where(F.col("ts") >= cut), "topic")
    checkpoint, out = t.scratch("late-checkpoint"), t.scratch("late")

    late = streams.LateRows(t.spark, t.scratch("late-rows"))

    def run():
        once = streams.dedup_stream(event_stream(t, path), ["event_id"], "ts", "1 hour")
        q = (once.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(out))
        q.awaitTermination()
        late.settle()

    t.spark.streams.addListener(late)
    try:
        run()
        older = messages.encode_messages(t.events.where(F.col("ts") < cut), ["event_id"])
        older.withColumn("timestamp", F.lit(LOADED_AT[1]).cast("timestamp")).write.mode("append").parquet(path)
        run()
    finally:
        t.spark.streams.removeListener(late)
    dropped = late.counted().agg(F.coalesce(F.sum("dropped"), F.lit(0))).first()[0]
    kept = t.spark.read.parquet(out)
    return kept.groupBy("event_type").agg(F.count("*").alias("kept")).withColumn("late_in_all", F.lit(dropped).cast("bigint"))


# --- marts -------------------------------------------------------------------

@query
def rfm(t: Lake) -> DataFrame:
    return marts.rfm(closed_orders(t), users(t))


@query
def courier_payout(t: Lake) -> DataFrame:
    return marts.courier_payout(deliveries(t))


def member_events(t: Lake) -> tuple[DataFrame, DataFrame]:
    members = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("community")
    )
    return t.events.select("user_id", "ts", "event_type"), members


@query
def first_message_conversion(t: Lake) -> DataFrame:
    return marts.conversion(*member_events(t), within=timedelta(days=1), k=10)


@query
def first_message_conversion_all(t: Lake) -> DataFrame:
    return marts.conversion_by_community(*member_events(t))


@query
def social_activity(t: Lake) -> DataFrame:
    return marts.social_activity(t.events)


@query
def customer_category(t: Lake) -> DataFrame:
    items = t.lineitem.select("l_orderkey", "l_partkey")
    orders = t.orders.select("o_orderkey", "o_custkey")
    facts = joins.join_dims(items, [(orders, "l_orderkey", "o_orderkey")]).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
    )
    parts = t.part.select(F.col("p_partkey").alias("part_id"), F.col("p_brand").alias("brand"))
    return marts.customer_category(facts, parts)


@query
def dashboard_kpi(t: Lake) -> DataFrame:
    orders = t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("ordered_at"),
        F.col("o_totalprice").alias("amount"),
    )
    geo = geography(t).select(F.col("c_custkey").alias("customer_id"), F.col("r_name").alias("region"))
    return marts.dashboard_kpi(orders, geo)


@query
def daily_turnover(t: Lake) -> DataFrame:
    return marts.daily_turnover(account_orders(t).drop("o_orderdate", "o_orderpriority"))


@query
def ranks_global(t: Lake) -> DataFrame:
    # Fifty quantities; the days tie by the dozen.
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    up = ranks.ranks(items, ["l_quantity", "l_shipdate"])
    return ranks.ranks(up, ["l_shipdate"], True, "newest_rank", "newest_dense", "newest_percent")


def dated_orders(t: Lake) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    geo = geography(t).select("c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    return joins.join_dims(orders, [(geo, "o_custkey", "c_custkey")]).withColumn("day", marts.day("o_orderdate"))


def turnover_parts(df: DataFrame) -> dict[str, Column]:
    return {"orders": F.count(F.lit(1)), "revenue": money_sum(df, "o_totalprice")}


@query
def kpi_rollup(t: Lake) -> DataFrame:
    orders = dated_orders(t)
    keys = ["region", "nation", "day"]
    return aggregates.totals_by_sets(orders, keys, aggregates.rollup_sets(keys), turnover_parts(orders), {"customers": "o_custkey"})


@query
def kpi_cube(t: Lake) -> DataFrame:
    orders = dated_orders(t)
    keys = ["region", "o_orderstatus", "day"]
    return aggregates.totals_by_sets(orders, keys, aggregates.cube_sets(keys), turnover_parts(orders), {"customers": "o_custkey"})


@query
def kpi_grouping_sets(t: Lake) -> DataFrame:
    orders = dated_orders(t)
    return aggregates.totals_by_sets(orders, ["day", "region"], [["day"], ["region"]], turnover_parts(orders))


@query
def pivot_status(t: Lake) -> DataFrame:
    orders = dated_orders(t)
    return aggregates.pivot(orders, ["day"], "o_orderstatus", turnover_parts(orders))


@query
def pivot_segments(t: Lake) -> DataFrame:
    parts = {"customers": F.count(F.lit(1)), "best": F.max("c_acctbal")}
    return aggregates.pivot(t.customer, ["c_nationkey"], "c_mktsegment", parts, ["BUILDING", "MACHINERY"], "rest")


@query
def sketch_trailing(t: Lake) -> DataFrame:
    """Accounts of each month and the two before, from stored sketches; a month of them refreshed."""
    month = F.expr("year(o_orderdate) * 12 + month(o_orderdate)").cast("int")
    orders = t.orders.select("o_custkey", month.alias("month"), "o_orderstatus")
    build = lambda f: sketches.sketch_per(f, ["month"], "o_custkey")
    facts = lake.load_columnar(orders, t.scratch("months"), ["month"])
    # At first the orders that are still open are missing; their months are refreshed.
    path = t.scratch("sketches")
    incremental.rebuild_period(build(facts.where("o_orderstatus <> 'P'")), path, "month")
    late = facts.where("o_orderstatus = 'P'").select(F.col("month").cast("string"))
    incremental.refresh_mart(path, facts.withColumn("month", F.col("month").cast("string")), [late], "month", build)
    stored = lake.read_columnar(t.spark, path, build(facts).schema)
    met = sketches.trailing(stored, "month", 3).select("month", sketches.estimate().alias("estimate"))
    days = facts.select(F.explode(F.sequence(F.col("month"), F.col("month") + 2)).alias("month"), "o_custkey")
    exact = days.groupBy("month").agg(F.count_distinct("o_custkey").alias("accounts"))
    off = F.abs(F.col("estimate") - F.col("accounts")) <= F.col("accounts") * sketches.relative_error(deviations=5)
    return met.join(exact, "month").select("month", "accounts", off.alias("within_error"))


# --- incremental -------------------------------------------------------------

@query
def increment_read(t: Lake) -> DataFrame:
    return incremental.read_increment(t.events, "ts", EVENTS_CUT)


@query
def period_rebuild(t: Lake) -> DataFrame:
    df = t.orders.withColumn("month", marts.month("o_orderdate"))
    path = t.scratch("periods")
    incremental.rebuild_period(df.withColumn("o_totalprice", F.lit(0.0)), path, "month")
    # The load of 1998 is run twice, with the right prices; other years keep theirs.
    again = df.where(F.col("month").between("1998-01", "1998-12"))
    for _ in range(2):
        incremental.rebuild_period(again, path, "month")
    return lake.read_columnar(t.spark, path, df.schema)


@query
def mart_refresh(t: Lake) -> DataFrame:
    # Before the change urgent orders were dated a month earlier; after it high ones
    # have no date, and orders since the cut have come in.
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    now = F.when(~high, F.col("o_orderdate"))
    was = F.when(urgent, F.col("o_orderdate") - F.expr("INTERVAL 30 DAYS")).otherwise(F.col("o_orderdate"))
    columns = ["account_id", "ordered_at", "status", "amount", "month"]

    def facts(at: Column) -> DataFrame:
        return account_orders(t, at).withColumn("month", marts.month("ordered_at"))

    def build(df: DataFrame) -> DataFrame:
        # Small orders do not count, so a month may lose all its rows.
        return marts.daily_turnover(df.where("amount >= 50000")).withColumn("month", marts.month("day"))

    known = F.col("o_orderdate") < F.lit(TURNOVER_CUT).cast("timestamp_ntz")
    before = facts(was).where(known).select(*columns)
    changed = [facts(was).where(known & (urgent | high)), facts(now).where(~known | urgent | high)]
    # The facts are stored by month, as a warehouse has them.
    stored = lake.load_columnar(facts(now).select(*columns), t.scratch("facts"), ["month"], ["ordered_at"])

    path = t.scratch("turnover")
    incremental.rebuild_period(build(before), path, "month")
    incremental.refresh_mart(path, stored, [c.select("month") for c in changed], "month", build)
    return lake.read_columnar(t.spark, path, build(stored).schema).drop("month")


@query
def upsert(t: Lake) -> DataFrame:
    base = t.customer.withColumn("version", F.lit(1))
    changed = base.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0)).withColumn("version", F.lit(2))
    fresh = base.where("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", -F.col("c_custkey") - 1)
    stale = base.where("c_mktsegment = 'BUILDING'").withColumn("c_name", F.lit("old")).withColumn("version", F.lit(0))
    changes = sets.union_sources([changed, fresh, stale])
    return incremental.upsert(base, changes, ["c_custkey"], ["version"])


@query
def load_journal(t: Lake) -> DataFrame:
    loads = t.orders.withColumn("year", F.year("o_orderdate").cast("bigint"))
    return incremental.journal(loads, "orders", "year", "o_orderdate")


# --- data quality ------------------------------------------------------------

def customers_with_orders(t: Lake) -> DataFrame:
    """A left join: customers without an open order have nulls."""
    open_orders = filters.filter_status(t.orders, "o_orderstatus", ["P"])
    return t.customer.join(open_orders, t.customer["c_custkey"] == open_orders["o_custkey"], "left")


@query
def dq_not_null(t: Lake) -> DataFrame:
    rules = [quality.not_null(c) for c in ("c_custkey", "c_name", "o_orderkey", "o_totalprice")]
    return quality.run_checks(customers_with_orders(t), "customer_orders", rules)


@query
def dq_unique(t: Lake) -> DataFrame:
    return sets.union_sources([
        quality.run_checks(t.lineitem, "lineitem", [quality.Unique(("l_orderkey", "l_linenumber"))]),
        quality.run_checks(t.orders, "orders", [quality.Unique(("o_orderkey",))]),
    ])


@query
def dq_accepted(t: Lake) -> DataFrame:
    return quality.run_checks(t.events, "events", [
        quality.accepted("event_type", ["click", "purchase", "signup", "view"]),
    ])


@query
def dq_range(t: Lake) -> DataFrame:
    return quality.run_checks(t.customer, "customer", [
        quality.in_range("c_acctbal", low=0), quality.in_range("c_nationkey", 0, 24),
    ])


@query
def dq_reference(t: Lake) -> DataFrame:
    refs = {"known": t.customer.where("c_mktsegment <> 'HOUSEHOLD'"), "customer": t.customer}
    return quality.run_checks(t.orders, "orders", [
        quality.Reference("o_custkey", "known", "c_custkey"),
        quality.Reference("o_custkey", "customer", "c_custkey"),
    ], refs)


@query
def dq_reconcile(t: Lake) -> DataFrame:
    staged = model.to_staging(t.orders, "orders", LOADED_AT[0])
    whole = model.to_core(staged, ORDERS_SPEC)
    # A second core layer has lost the value of the cheapest orders, not the rows.
    broken = whole.withColumn(
        "o_totalprice", F.when(F.col("o_totalprice") < 5000, None).otherwise(F.col("o_totalprice"))
    )
    sums = {"o_totalprice": MONEY, "o_custkey": "decimal(20,0)"}
    return sets.union_sources([
        quality.reconcile(staged, whole, "orders", sums), quality.reconcile(staged, broken, "orders_broken", sums),
    ])


@query
def dq_order(t: Lake) -> DataFrame:
    items = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.run_checks(items, "lineitem_orders", [quality.in_order("o_orderdate", "l_shipdate")])


def items_with_faults(t: Lake) -> tuple[DataFrame, list]:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    customers = t.customer.select("c_custkey", "c_acctbal")
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    wide = joins.join_dims(items, [(orders, "l_orderkey", "o_orderkey"), (customers, "o_custkey", "c_custkey")])
    rules = [quality.in_range("c_acctbal", low=0), quality.in_order("o_orderdate", "l_shipdate")]
    return wide, rules


@query
def dq_quarantine(t: Lake) -> DataFrame:
    return quality.with_reason(*items_with_faults(t))


@query
def dq_quarantine_split(t: Lake) -> DataFrame:
    good, rejected = quality.quarantine(*items_with_faults(t))
    return rejected.withColumn("part", F.lit("rejected")).unionByName(
        good.withColumns({"reason": F.lit(None).cast("string"), "part": F.lit("good")}))
