"""Labels over a later window."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import bins
from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.operators import labels
from tidemark.plans.entity_plans import CUT, cutoff, orders_by_customer
from tidemark.plans.registry import Tables, plan, r, rq
from tidemark.spans import Span, days, instant, months

NEXT_90 = Span(days(0), days(90), "right")
IN_90 = f"o_orderdate > {CUT} AND o_orderdate <= {CUT} + INTERVAL 90 DAY"


def customers(t: Tables):
    return t.customer.select("c_custkey")


@plan(
    "l10_future_event",
    f"""
    SELECT c_custkey, CAST(EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND {IN_90}) AS INTEGER) AS will_order
    FROM customer
    """,
)
def l10(t: Tables):
    urgent = orders_by_customer(t).where("o_orderpriority = '1-URGENT'")
    return labels.event_label(customers(t), urgent, "c_custkey", "o_orderdate", cutoff(), NEXT_90, "will_order")


@plan(
    "l11_no_future_event",
    f"SELECT c_custkey, CAST(NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {IN_90}) AS INTEGER) AS churned FROM customer",
)
def l11(t: Tables):
    return labels.no_event_label(customers(t), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), NEXT_90, "churned")


@plan(
    "l12_state_change",
    f"""
    WITH d AS (SELECT c_custkey, min(CASE WHEN o_totalprice > 400000 THEN o_orderdate END) AS changed_at
               FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1)
    SELECT c_custkey, CAST(coalesce(changed_at > {CUT} AND changed_at <= {CUT} + INTERVAL 90 DAY, false) AS INTEGER) AS changes
    FROM d WHERE changed_at IS NULL OR changed_at > {CUT}
    """,
)
def l12(t: Tables):
    recent = orders_by_customer(t).where(F.col("o_orderdate") >= instant(F.lit("1999-01-01")))
    first_big = agg.smallest("changed_at", F.when(F.col("o_totalprice") > 400000, F.col("o_orderdate")))
    dated = agg.attach_summary(customers(t), recent, "c_custkey", [first_big])
    return labels.state_change_label(dated, "changed_at", cutoff(), NEXT_90, "changes").select("c_custkey", "changes")


@plan(
    "l12_months",
    f"""
    WITH d AS (SELECT c_custkey, min(o_orderdate) AS changed_at FROM customer
               LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 480000 GROUP BY 1)
    SELECT c_custkey, CAST(coalesce(changed_at > {CUT} AND changed_at <= {CUT} + INTERVAL 6 MONTH, false) AS INTEGER) AS changes
    FROM d WHERE changed_at IS NULL OR changed_at > {CUT}
    """,
)
def l12_months(t: Tables):
    big = orders_by_customer(t).where("o_totalprice > 480000")
    dated = agg.attach_summary(customers(t), big, "c_custkey", [agg.smallest("changed_at", "o_orderdate")])
    half_year = Span(months(0), months(6), "right")
    return labels.state_change_label(dated, "changed_at", cutoff(), half_year, "changes").select("c_custkey", "changes")


@plan(
    "l13_future_total",
    f"""
    SELECT c_custkey, {rq('coalesce(sum(o_totalprice), 0)', 2)} AS next_spend FROM customer
    LEFT JOIN orders ON o_custkey = c_custkey AND {IN_90} GROUP BY 1
    """,
)
def l13(t: Tables):
    spend = agg.total("next_spend", "o_totalprice")
    df = labels.future_total_label(customers(t), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), NEXT_90, spend)
    return df.select("c_custkey", r("next_spend", 2).alias("next_spend"))


@plan(
    "l13_future_count",
    f"SELECT c_custkey, count(o_orderkey) AS next_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND {IN_90} GROUP BY 1",
)
def l13_count(t: Tables):
    return labels.future_total_label(
        customers(t), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), NEXT_90, agg.count("next_orders")
    )


@plan(
    "l14_future_tier",
    f"""
    WITH s AS (SELECT c_custkey, coalesce(sum(o_totalprice), 0) AS spend FROM customer
               LEFT JOIN orders ON o_custkey = c_custkey AND {IN_90} GROUP BY 1),
    q AS (SELECT quantile_cont(spend, 1/3.0::DOUBLE) AS a, quantile_cont(spend, 2/3.0::DOUBLE) AS b FROM s WHERE spend > 0)
    SELECT c_custkey, CASE WHEN spend <= 0 THEN 'none' WHEN spend <= a THEN 'low' WHEN spend <= b THEN 'medium' ELSE 'high' END AS tier FROM s, q
    """,
)
def l14(t: Tables):
    spend = agg.total("spend", "o_totalprice")
    df = labels.future_total_label(customers(t), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), NEXT_90, spend)
    return bins.zero_and_quantile_tiers(df, "spend", ["none", "low", "medium", "high"], "tier").select("c_custkey", "tier")


@plan(
    "l15_next_value",
    """
    SELECT o_orderkey, next_price FROM (
      SELECT o_orderkey, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price FROM orders)
    WHERE next_price IS NOT NULL
    """,
)
def l15(t: Tables):
    df = labels.next_value_label(t.orders, "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "next_price")
    return df.select("o_orderkey", "next_price")


@plan(
    "l15_next_category",
    """
    SELECT event_id, next_type FROM (
      SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events) WHERE next_type IS NOT NULL
    """,
)
def l15_category(t: Tables):
    return labels.next_value_label(t.events, "user_id", "ts", "event_id", "event_type", "next_type").select("event_id", "next_type")


@plan(
    "l16_main_category",
    f"""
    WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE {IN_90} GROUP BY 1, 2),
    m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS k FROM c) WHERE k = 1)
    SELECT c_custkey, coalesce(o_orderpriority, 'none') AS main_priority FROM customer LEFT JOIN m ON o_custkey = c_custkey
    """,
)
def l16(t: Tables):
    return labels.main_category_label(
        customers(t), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), NEXT_90, "o_orderpriority", "main_priority", "none"
    )


@plan(
    "l16_longest_category",
    """
    WITH c AS (SELECT user_id, event_type, sum(value) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2),
    m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, event_type) AS k FROM c) WHERE k = 1)
    SELECT u.user_id, coalesce(event_type, 'none') AS main_type FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN m USING (user_id)
    """,
)
def l16_longest(t: Tables):
    users = t.events.select("user_id").distinct()
    start = F.lit("2024-01-20")
    onwards = Span(days(0), None, "both")
    return labels.main_category_label(users, t.events, "user_id", "ts", start, onwards, "event_type", "main_type", "none", F.col("value"))


@plan(
    "l17_state_and_event",
    f"""
    WITH s AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS state FROM orders WHERE o_orderdate <= {CUT} GROUP BY 1)
    SELECT c_custkey, CAST(c_custkey IN (SELECT o_custkey FROM s WHERE state = 'F')
      AND c_custkey IN (SELECT o_custkey FROM orders WHERE {IN_90}) AS INTEGER) AS renews FROM customer
    """,
)
def l17(t: Tables):
    orders = orders_by_customer(t)
    states = ent.newest_rows(orders.where(F.col("o_orderdate") <= cutoff()), "c_custkey", "o_orderdate", "o_orderkey")
    return labels.state_and_event_label(
        customers(t), states, orders, "c_custkey", F.col("o_orderstatus") == "F", "o_orderdate", cutoff(), NEXT_90, "renews"
    )


@plan(
    "l18_rule_on_totals",
    f"""
    SELECT l_suppkey, {rq('sum(l_extendedprice * (1 - l_discount)) / sum(l_extendedprice)', 6)} AS paid_share,
           CAST(sum(l_extendedprice * (1 - l_discount)) / sum(l_extendedprice) < 0.95 AS INTEGER) AS short_paid FROM lineitem GROUP BY 1
    """,
)
def l18(t: Tables):
    paid = agg.total("paid", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    totals = agg.summarise(t.lineitem, "l_suppkey", [paid, agg.total("expected", "l_extendedprice")])
    df = labels.shortfall_label(totals, "paid", "expected", 0.95, "short_paid")
    return df.select("l_suppkey", r(F.col("paid") / F.col("expected"), 6).alias("paid_share"), "short_paid")


@plan(
    "l19_projected_shortage",
    f"""
    WITH v AS (SELECT l_partkey, sum(l_quantity) / 365.0 AS daily FROM lineitem
               WHERE l_shipdate >= {CUT} - INTERVAL 365 DAY AND l_shipdate < {CUT} GROUP BY 1)
    SELECT p_partkey, {rq('coalesce(daily, 0)', 6)} AS daily, CAST(p_size < coalesce(daily, 0) * 60 AS INTEGER) AS will_run_out
    FROM part LEFT JOIN v ON l_partkey = p_partkey
    """,
)
def l19(t: Tables):
    shipped = t.lineitem.withColumnRenamed("l_partkey", "p_partkey")
    year = {"": Span(days(-365), days(0), "left")}
    rates = ent.cutoff_features(t.part, shipped, "p_partkey", "l_shipdate", cutoff(), year, [agg.total("sold", "l_quantity")])
    df = labels.shortage_label(rates.withColumn("daily", F.col("sold") / 365.0), "p_size", "daily", 60, "will_run_out")
    return df.select("p_partkey", r("daily", 6).alias("daily"), "will_run_out")


@plan(
    "l20_eligibility",
    """
    WITH b AS (SELECT user_id, min(ts) AS born FROM events WHERE event_type = 'signup' GROUP BY 1)
    SELECT user_id FROM b WHERE born <= TIMESTAMP '2024-01-05' AND born + INTERVAL 28 DAY <= (SELECT max(ts) FROM events)
    """,
)
def l20(t: Tables):
    born = t.events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("born"))
    observed = Span(days(0), days(28), "both")
    return labels.eligible(born, "born", F.lit("2024-01-05"), ent.data_cutoff(t.events, "ts"), observed).select("user_id")
