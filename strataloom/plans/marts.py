"""Data marts.

The subjects are given; every formula, threshold and filter here is a choice of
this library and an argument with a default.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from strataloom.functions.ordering import micros
from strataloom.functions.values import MONEY_SUM, mean_of, money_sum
from strataloom.operators.sets import top_k
from strataloom.operators.windows import ntile_at_scale
from strataloom.session import materialise

# Payout rate below each average rating; None is the rest.
PAYOUT_TIERS: tuple[tuple[float | None, str], ...] = ((20, "0.05"), (30, "0.07"), (None, "0.09"))

# Ratings are no money: exact to a millionth, so that their sum does not depend on order.
RATING = "decimal(18,6)"

# Actions counted in the activity mart.
ACTIONS = ("click", "error", "purchase", "signup", "view")


def day(c: str) -> Column:
    return F.to_date(c)


def month(c: str) -> Column:
    """The period text of a mart, such as ``2024-05``."""
    return F.date_format(c, "yyyy-MM")


def rfm(orders: DataFrame, users: DataFrame, n: int = 5) -> DataFrame:
    """Recency, frequency and monetary class of every user; ``n`` is best.

    ``orders(user_id, ordered_at, amount)`` are the closed orders and
    ``users(user_id)`` all users; one without orders is lowest in each class.
    """
    per_user = orders.groupBy("user_id").agg(
        F.max("ordered_at").alias("last_order"),
        F.count("*").alias("n_orders"),
        money_sum(orders, "amount").alias("total"),
    )
    base = users.select("user_id").join(per_user, "user_id", "left").select(
        "user_id", "last_order",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.coalesce("total", F.lit(0)).cast(MONEY_SUM).alias("total"),
    )
    # Stored once, so that the aggregation does not run again for every pass.
    base = materialise(base, "rfm-base")
    return ntile_at_scale(base, n, {
        "recency": ["last_order", "user_id"],
        "frequency": ["n_orders", "user_id"],
        "monetary": ["total", "user_id"],
    })


def courier_payout(facts: DataFrame, tiers: Sequence[tuple[float | None, str]] = PAYOUT_TIERS) -> DataFrame:
    """Payout per courier and month from ``facts(courier_id, delivered_at, amount, rating)``."""
    # Grouped by the first day of the month; its text is made per result row.
    first_day = F.trunc(day("delivered_at"), "month").alias("first_day")
    per_month = facts.groupBy("courier_id", first_day).agg(
        F.count("*").alias("deliveries"),
        money_sum(facts, "amount").alias("gross"),
        F.sum(F.col("rating").try_cast(RATING)).alias("ratings"),
    )
    rated = per_month.select(
        "courier_id", month("first_day").alias("month"), "deliveries", "gross",
        (F.col("ratings").cast("double") / F.col("deliveries")).alias("avg_rating"),
    )
    rate: Column | None = None
    for below, value in tiers:
        value = F.lit(value).cast("decimal(4,2)")
        if below is None:
            rate = value if rate is None else rate.otherwise(value)
            break
        under = F.col("avg_rating") < below
        rate = F.when(under, value) if rate is None else rate.when(under, value)
    payout = F.round(F.col("gross") * F.col("rate"), 2).cast(MONEY_SUM)
    return rated.withColumn("rate", rate).withColumn("payout", payout)


def _piece(ts: Column, length: int) -> Column:
    """Number of the piece of ``length`` microseconds that ``ts`` lies in."""
    at = micros(ts)
    return ((at - F.pmod(at, F.lit(length))) / F.lit(length)).cast("bigint")


def conversion_by_community(events: DataFrame, users: DataFrame, within: timedelta = timedelta(days=1),
                            join_type: str = "signup", message_type: str = "purchase") -> DataFrame:
    """Members of each community and those who wrote within ``within`` of joining.

    ``events(user_id, ts, event_type)`` and ``users(user_id, community)``.
    """
    # Time is cut into pieces as long as the bound.  The interval after joining
    # meets two of them, and the first and last message of each decide.  So the
    # messages of a hot user shrink on the map side, before any shuffle.
    length = int(within.total_seconds() * 1_000_000)
    joined = (
        events.where(F.col("event_type") == join_type)
        .groupBy("user_id").agg(F.min("ts").alias("joined_at"))
    )
    pieces = (
        events.where(F.col("event_type") == message_type)
        .groupBy("user_id", _piece(F.col("ts"), length).alias("piece"))
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    )
    until = F.col("joined_at") + F.make_dt_interval(secs=F.lit(within.total_seconds()))
    start = _piece(F.col("joined_at"), length)
    hit = ((F.col("piece") == start) & (F.col("last") >= F.col("joined_at"))) | (
        (F.col("piece") == start + 1) & (F.col("first") <= until)
    )
    members = joined.join(pieces, "user_id", "left").groupBy("user_id").agg(
        F.coalesce(F.max(hit), F.lit(False)).alias("converted")
    )
    return (
        members.join(users, "user_id")
        .groupBy("community")
        .agg(F.count("*").alias("members"), F.count_if("converted").alias("converted"))
        .withColumn("ratio", F.try_divide("converted", "members"))
    )


def conversion(events: DataFrame, users: DataFrame, within: timedelta = timedelta(days=1), k: int = 10) -> DataFrame:
    """The ``k`` communities with the highest conversion into the first message."""
    return top_k(conversion_by_community(events, users, within), "ratio", "community", k)


def social_activity(events: DataFrame, actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Per user and day of ``events(user_id, ts, event_type)``: actions by type, first and last."""
    counts = [F.count_if(F.col("event_type") == a).alias(f"n_{a}") for a in actions]
    return events.groupBy("user_id", day("ts").alias("day")).agg(
        F.count("*").alias("n_actions"), *counts,
        F.min("ts").alias("first_action"), F.max("ts").alias("last_action"),
    )


def customer_category(facts: DataFrame, parts: DataFrame) -> DataFrame:
    """Distinct orders and items per customer and brand.

    ``facts(customer_id, order_id, part_id)`` has one row per item and
    ``parts(part_id, brand)``.
    """
    return facts.join(parts, "part_id").groupBy("customer_id", "brand").agg(
        F.count_distinct("order_id").alias("orders"), F.count("*").alias("items")
    )


def dashboard_kpi(orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Orders, revenue, customers and average check per day and region.

    ``orders(customer_id, ordered_at, amount)``, ``geo(customer_id, region)`` with
    one region per customer.
    """
    # One row per customer and day before the join: counts the customers too.
    per_customer = orders.groupBy("customer_id", day("ordered_at").alias("day")).agg(
        F.count("*").alias("n"), money_sum(orders, "amount").alias("amount")
    )
    return (
        per_customer.join(geo, "customer_id")
        .groupBy("day", "region")
        .agg(
            F.sum("n").alias("orders"),
            F.sum("amount").cast(MONEY_SUM).alias("revenue"),
            F.count("*").alias("customers"),
        )
        .withColumn("avg_check", mean_of(F.col("revenue"), F.col("orders")))
    )


def daily_turnover(orders: DataFrame) -> DataFrame:
    """Amount, operations, unique accounts and operations per account per day and status.

    ``orders(account_id, ordered_at, status, amount)``.
    """
    per_account = orders.groupBy(day("ordered_at").alias("day"), "status", "account_id").agg(
        F.count("*").alias("n"), money_sum(orders, "amount").alias("amount")
    )
    return (
        per_account.groupBy("day", "status")
        .agg(
            F.sum("amount").cast(MONEY_SUM).alias("amount"),
            F.sum("n").alias("operations"),
            F.count("*").alias("accounts"),
        )
        .withColumn("operations_per_account", F.col("operations") / F.col("accounts"))
    )
