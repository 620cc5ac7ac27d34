"""Point-in-time features per entity and per event."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import elapsed_days, elapsed_seconds
from tidemark.functions.values import flag, safe_ratio
from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.operators import history as h
from tidemark.plans.join_plans import FIRST_SEEN, first_seen
from tidemark.plans.registry import Tables, plan, r, rounded, rq
from tidemark.skew import spread_join
from tidemark.spans import Span, days, hours, instant

CUTOFF = "2000-06-30"
CUT = f"TIMESTAMP '{CUTOFF}'"


def cutoff():
    return instant(F.lit(CUTOFF))


def orders_by_customer(t: Tables):
    return t.orders.withColumnRenamed("o_custkey", "c_custkey")


@plan(
    "l1_cutoff_features",
    "SELECT c_custkey, "
    + ", ".join(
        f"count(o_orderkey) FILTER (WHERE {w}) AS n_{k}, {rq(f'coalesce(sum(o_totalprice) FILTER (WHERE {w}), 0)', 2)} AS spend_{k}, "
        f"coalesce(max(o_totalprice) FILTER (WHERE {w}), 0) AS top_{k}, "
        f"count(DISTINCT CASE WHEN {w} THEN o_orderpriority END) AS kinds_{k}"
        for k, w in (("90d", f"o_orderdate >= {CUT} - INTERVAL 90 DAY"), ("365d", f"o_orderdate >= {CUT} - INTERVAL 365 DAY"))
    )
    + f" FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate < {CUT} GROUP BY 1",
)
def l1(t: Tables):
    windows = {"90d": Span(days(-90), days(0), "left"), "365d": Span(days(-365), days(0), "left")}
    measures = [
        agg.count("n"), agg.total("spend", "o_totalprice"), agg.largest("top", "o_totalprice", 0.0), agg.distinct("kinds", "o_orderpriority"),
    ]
    df = ent.cutoff_features(t.customer.select("c_custkey"), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), windows, measures)
    return df.withColumns({f"spend_{k}": r(f"spend_{k}", 2) for k in windows})


@plan(
    "l1_all_history",
    f"""
    SELECT c_custkey, count(o_orderkey) AS n, {rq('coalesce(avg(o_totalprice), 0)')} AS mean_price,
           {rq('coalesce(stddev_samp(o_totalprice), 0)')} AS std_price,
           max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS any_urgent,
           {rq("coalesce(avg(CASE WHEN o_orderid IS NULL THEN NULL WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END), 0)")} AS finished_rate
    FROM customer LEFT JOIN (SELECT *, o_orderkey AS o_orderid FROM orders) ON o_custkey = c_custkey AND o_orderdate < {CUT} GROUP BY 1
    """,
)
def l1_all(t: Tables):
    measures = [
        agg.count("n"),
        agg.mean("mean_price", "o_totalprice", 0.0),
        agg.spread("std_price", "o_totalprice", 0.0),
        agg.any_flag("any_urgent", F.col("o_orderpriority") == "1-URGENT"),
        agg.rate("finished_rate", F.col("o_orderstatus") == "F", 0.0),
    ]
    ever = {"": Span(None, days(0), "left")}
    df = ent.cutoff_features(t.customer.select("c_custkey"), orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), ever, measures)
    return rounded(df)


@plan(
    "l2_first_n_days",
    f"""
    WITH {FIRST_SEEN}
    SELECT f.user_id, count(e.event_id) AS n, count(DISTINCT event_type) AS kinds, count(DISTINCT CAST(ts AS DATE)) AS active_days,
           {rq("coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0)", 2)} AS spent,
           {rq('coalesce(avg(value), 0)')} AS mean_value
    FROM first_seen f LEFT JOIN events e ON e.user_id = f.user_id AND ts >= anchor AND ts < anchor + INTERVAL 7 DAY GROUP BY 1
    """,
)
def l2(t: Tables):
    measures = [
        agg.count("n"),
        agg.distinct("kinds", "event_type"),
        agg.distinct("active_days", F.to_date("ts")),
        agg.total("spent", F.when(F.col("event_type") == "purchase", F.col("value"))),
        agg.mean("mean_value", "value", 0.0),
    ]
    week = {"": Span(days(0), days(7), "left")}
    df = ent.anchored_features(first_seen(t), t.events, "user_id", "ts", "event_id", "anchor", week, measures)
    return df.select("user_id", "n", "kinds", "active_days", r("spent", 2).alias("spent"), r("mean_value").alias("mean_value"))


@plan(
    "l2_first_hours",
    f"""
    WITH {FIRST_SEEN}
    SELECT f.user_id, count(e.event_id) FILTER (WHERE ts <= anchor + INTERVAL 6 HOUR) AS n_6h, count(e.event_id) AS n_24h
    FROM first_seen f LEFT JOIN events e ON e.user_id = f.user_id AND ts >= anchor AND ts <= anchor + INTERVAL 24 HOUR GROUP BY 1
    """,
)
def l2_hours(t: Tables):
    windows = {"6h": Span(hours(0), hours(6), "both"), "24h": Span(hours(0), hours(24), "both")}
    df = ent.anchored_features(first_seen(t), t.events, "user_id", "ts", "event_id", "anchor", windows, [agg.count("n")])
    return df.drop("anchor")


@plan(
    "l3_last_n_from_own_latest",
    f"""
    WITH a AS (SELECT user_id, max(ts) AS latest_at FROM events GROUP BY 1)
    SELECT a.user_id, count(e.event_id) AS n, {rq('avg(value)')} AS mean_value, max(value) AS top_value
    FROM a LEFT JOIN events e ON e.user_id = a.user_id AND ts > latest_at - INTERVAL 3 DAY AND ts <= latest_at GROUP BY 1
    """,
)
def l3(t: Tables):
    users = t.events.select("user_id").distinct()
    measures = [agg.count("n"), agg.mean("mean_value", "value"), agg.largest("top_value", "value")]
    df = ent.before_own_latest(users, t.events, "user_id", "ts", "event_id", Span(days(-3), days(0), "right"), measures)
    return df.select("user_id", "n", r("mean_value").alias("mean_value"), "top_value")


PRIOR_ORDER = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
L4_SQL = f"""
    WITH b AS (SELECT o_custkey, min(o_orderdate) AS born FROM orders GROUP BY 1),
    f AS (
      SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment,
        coalesce(avg(o_totalprice) OVER w, 0) AS mean_prior, coalesce(max(o_totalprice) OVER w, 0) AS max_prior,
        count(*) OVER w AS n_prior,
        coalesce(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') OVER w / nullif(count(*) OVER w, 0)::DOUBLE, 0) AS urgent_rate,
        (epoch_us(o_orderdate) - epoch_us(coalesce(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), TIMESTAMP '1995-01-01'))) / 86400e6 AS days_since,
        (epoch_us(o_orderdate) - epoch_us(max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) OVER w)) / 86400e6 AS days_since_urgent
      FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS {PRIOR_ORDER})
    SELECT o_orderkey, o_custkey, c_mktsegment, n_prior, {rq('mean_prior')} AS mean_prior, max_prior, {rq('urgent_rate')} AS urgent_rate,
           {rq('days_since')} AS days_since, {rq('coalesce(days_since_urgent, 9999)')} AS days_since_urgent,
           {rq('CASE WHEN mean_prior > 0 THEN o_totalprice / mean_prior ELSE 1 END')} AS ratio_to_mean,
           CAST(n_prior = 0 AS INTEGER) AS is_first,
           CAST(o_totalprice > 450000 OR (CASE WHEN mean_prior > 0 THEN o_totalprice / mean_prior ELSE 1 END > 1.5 AND days_since < 30 AND n_prior > 0) AS INTEGER) AS unusual
    FROM f
"""


@plan("l4_prior_event_features", L4_SQL)
def l4(t: Tables):
    """The flagship: every order with its customer's strictly earlier orders summarised."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    born = F.lit("1995-01-01").cast("timestamp_ntz")
    features = [
        h.past_count("n_prior"),
        h.past_mean("mean_prior", "o_totalprice"),
        h.past_max("max_prior", "o_totalprice", 0.0),
        h.past_mean("urgent_rate", flag(urgent)),
        h.previous("previous_at", "o_orderdate", born),
        h.latest("urgent_at", F.when(urgent, F.col("o_orderdate"))),
    ]
    rows = h.running_features(t.orders, "o_custkey", "o_orderdate", "o_orderkey", features)
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = spread_join(rows, segments, "o_custkey", "o_orderkey", hot_from=t.orders)
    days_since = elapsed_days("o_orderdate", "previous_at")
    ratio = F.when(F.col("mean_prior") > 0, safe_ratio("o_totalprice", "mean_prior")).otherwise(1.0)
    unusual = (F.col("o_totalprice") > 450000) | ((ratio > 1.5) & (days_since < 30) & (F.col("n_prior") > 0))
    return rows.select(
        "o_orderkey", "o_custkey", "c_mktsegment", "n_prior", r("mean_prior").alias("mean_prior"), "max_prior",
        r("urgent_rate").alias("urgent_rate"), r(days_since).alias("days_since"),
        r(F.coalesce(elapsed_days("o_orderdate", "urgent_at"), F.lit(9999.0))).alias("days_since_urgent"),
        r(ratio).alias("ratio_to_mean"), flag(F.col("n_prior") == 0).alias("is_first"), flag(unusual).alias("unusual"),
    )


@plan(
    "l5_range_history",
    f"""
    SELECT event_id, count(*) OVER h AS n_6h, {rq('avg(value) OVER h')} AS mean_6h, {rq('stddev_samp(value) OVER h')} AS std_6h,
           count(DISTINCT event_type) OVER h AS kinds_6h, count(*) OVER d AS n_72h, {rq('avg(value) OVER d')} AS mean_72h, {rq('stddev_samp(value) OVER d')} AS std_72h,
           count(DISTINCT event_type) OVER d AS kinds_72h
    FROM events
    WINDOW h AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
           d AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 72 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    """,
)
def l5(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "value", "event_type")
    wanted = [h.Trailing("n" if k == "count" else k, k, F.col("value")) for k in ("count", "mean", "std")]
    wanted.append(h.Trailing("kinds", "distinct", F.col("event_type")))
    rows = h.trailing_features(rows, "user_id", "ts", "event_id", {"6h": hours(6), "72h": hours(72)}, wanted)
    return rounded(rows.drop("user_id", "ts", "value", "event_type"))


@plan(
    "l6_static_history",
    f"""
    WITH x AS (SELECT l.*, p_brand, CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem l JOIN part ON l_partkey = p_partkey),
    h AS (SELECT * FROM x WHERE l_shipdate < {CUT}),
    s AS (SELECT l_suppkey, count(*) AS n, avg(returned) AS rate FROM h GROUP BY 1),
    b AS (SELECT p_brand, count(*) AS n, avg(returned) AS rate FROM h GROUP BY 1),
    p AS (SELECT l_partkey, count(*) AS n, avg(returned) AS rate FROM h GROUP BY 1)
    SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.l_suppkey, x.l_extendedprice,
           coalesce(s.n, 0) AS l_suppkey_n, {rq('coalesce(s.rate, 0)', 6)} AS l_suppkey_rate,
           coalesce(b.n, 0) AS p_brand_n, {rq('coalesce(b.rate, 0)', 6)} AS p_brand_rate,
           coalesce(p.n, 0) AS l_partkey_n, {rq('coalesce(p.rate, 0)', 6)} AS l_partkey_rate
    FROM x LEFT JOIN s USING (l_suppkey) LEFT JOIN b USING (p_brand) LEFT JOIN p ON p.l_partkey = x.l_partkey
    WHERE l_shipdate >= {CUT}
    """,
)
def l6(t: Tables):
    item = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    items = t.lineitem.select(*item, "l_extendedprice", "l_shipdate", "l_returnflag")
    rows = spread_join(items, brands, "l_partkey", item)
    past, later = rows.where(F.col("l_shipdate") < cutoff()), rows.where(F.col("l_shipdate") >= cutoff())
    measures = [agg.count("n"), agg.rate("rate", F.col("l_returnflag") == "R", 0.0)]
    axes = ["l_suppkey", "p_brand", "l_partkey"]
    df = ent.static_history(later, past, axes, measures, item)
    return df.select(*item, "l_extendedprice", *[f"{a}_n" for a in axes], *[r(f"{a}_rate", 6).alias(f"{a}_rate") for a in axes])


@plan(
    "l7_recency",
    f"""
    SELECT c_custkey, {rq(f'coalesce((epoch_us({CUT}) - epoch_us(max(o_orderdate))) / 86400e6, 9999)')} AS days_since_last
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate < {CUT} GROUP BY 1
    """,
)
def l7(t: Tables):
    df = ent.recency(t.customer, orders_by_customer(t), "c_custkey", "o_orderdate", cutoff(), "days_since_last", ent.never_constant())
    return df.select("c_custkey", r("days_since_last").alias("days_since_last"))


@plan(
    "l8_days_to_first",
    f"""
    WITH {FIRST_SEEN}
    SELECT f.user_id, {rq("coalesce((epoch_us(min(e.ts)) - epoch_us(anchor)) / 86400e6, 30)")} AS days_to_purchase
    FROM first_seen f LEFT JOIN events e ON e.user_id = f.user_id AND event_type = 'purchase' AND ts >= anchor GROUP BY f.user_id, anchor
    """,
)
def l8(t: Tables):
    bought = t.events.where("event_type = 'purchase'")
    df = ent.days_to_first(first_seen(t), bought, "user_id", "ts", "anchor", "days_to_purchase", F.lit(30.0))
    return df.select("user_id", r("days_to_purchase").alias("days_to_purchase"))


@plan(
    "l9_never_policies",
    f"""
    WITH x AS (SELECT c_custkey, (epoch_us({CUT}) - epoch_us(max(o_orderdate))) / 86400e6 AS d FROM customer
               LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 490000 AND o_orderdate < {CUT} GROUP BY 1),
    a AS (SELECT o_custkey, (epoch_us({CUT}) - epoch_us(min(o_orderdate))) / 86400e6 AS age FROM orders WHERE o_orderdate < {CUT} GROUP BY 1)
    SELECT c_custkey, {rq('coalesce(d, 9999)')} AS by_constant, {rq('coalesce(d, 2007)')} AS by_window,
           {rq('coalesce(d, age, 0)')} AS by_own_age, {rq('coalesce(d, 1.5 * (SELECT max(d) FROM x))')} AS by_max
    FROM x LEFT JOIN a ON o_custkey = c_custkey
    """,
)
def l9(t: Tables):
    rare = orders_by_customer(t).where("o_totalprice > 490000")
    gaps = ent.recency(t.customer.select("c_custkey"), rare, "c_custkey", "o_orderdate", cutoff(), "gap")
    # an account is as old as its first order; one without orders has no age yet
    before = orders_by_customer(t).where(F.col("o_orderdate") < cutoff())
    age = (F.unix_micros(cutoff().cast("timestamp")) - F.unix_micros(F.min("o_orderdate").cast("timestamp"))) / 86400e6
    gaps = gaps.join(before.groupBy("c_custkey").agg(age.alias("age")), "c_custkey", "left")
    policies = {
        "by_constant": ent.never_constant(),
        "by_window": F.lit(2007.0),
        "by_own_age": F.coalesce("age", F.lit(0.0)),
        "by_max": ent.never_factor_of_max(gaps, "gap"),
    }
    filled = agg.fill_defaults(gaps.withColumns({n: F.col("gap") for n in policies}), policies)
    return rounded(filled.drop("gap", "age"))


@plan(
    "l21_session_rollup",
    f"""
    WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'click') AS n_click,
      count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS d,
      sum(value) AS total FROM events GROUP BY 1, 2)
    SELECT user_id, CAST(day AS VARCHAR) AS day, n_events, n_click, n_purchase, {rq('d', 3)} AS duration_seconds,
           {rq('n_events / nullif(d / 60, 0)', 5)} AS events_per_minute, {rq('total', 2)} AS total FROM s
    """,
)
def l21(t: Tables):
    dated = t.events.withColumn("day", F.to_date("ts").cast("string"))
    df = ent.session_rollup(dated, ["user_id", "day"], "ts", "event_type", ["click", "purchase"], [agg.total("total", "value")])
    return df.select(
        "user_id", "day", "n_events", "n_click", "n_purchase", r("duration_seconds", 3).alias("duration_seconds"),
        r("events_per_minute", 5).alias("events_per_minute"), r("total", 2).alias("total"),
    )


@plan(
    "l21_order_offsets",
    f"""
    SELECT o_orderkey, count(l_orderkey) AS items, {rq('coalesce(sum(l_quantity), 0)', 2)} AS quantity,
           {rq('(epoch_us(min(l_shipdate)) - epoch_us(o_orderdate)) / 1e6', 0)} AS first_offset, {rq('(epoch_us(max(l_shipdate)) - epoch_us(o_orderdate)) / 1e6', 0)} AS last_offset
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate
    """,
)
def l21_orders(t: Tables):
    items = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    measures = [
        agg.count("items"), agg.total("quantity", "l_quantity"), agg.smallest("first_at", "l_shipdate"), agg.largest("last_at", "l_shipdate"),
    ]
    df = agg.attach_summary(t.orders, items, "o_orderkey", measures)
    return df.select(
        "o_orderkey", "items", r("quantity", 2).alias("quantity"),
        r(elapsed_seconds("first_at", "o_orderdate"), 0).alias("first_offset"), r(elapsed_seconds("last_at", "o_orderdate"), 0).alias("last_offset"),
    )


EXPOSED = """
    a AS (SELECT event_id AS assignment_id, user_id, ts AS assigned_at, CASE WHEN value > 25 THEN 'B' ELSE 'A' END AS variant
          FROM events WHERE event_type = 'signup'),
    x AS (SELECT a.assignment_id, a.variant, count(e.event_id) FILTER (WHERE event_type = 'view') AS views,
                 count(e.event_id) FILTER (WHERE event_type = 'click') AS clicks, count(e.event_id) FILTER (WHERE event_type = 'purchase') AS purchases,
                 coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0) AS revenue
          FROM a LEFT JOIN events e ON e.user_id = a.user_id AND e.ts > a.assigned_at AND e.ts < a.assigned_at + INTERVAL 7 DAY GROUP BY 1, 2)
"""


def exposures(t: Tables):
    """Each signup is an assignment; outcomes are the user's events in the following 7 days."""
    assignments = t.events.where("event_type = 'signup'").select(
        F.col("event_id").alias("assignment_id"), "user_id", F.col("ts").alias("assigned_at"),
        F.when(F.col("value") > 25, "B").otherwise("A").alias("variant"),
    )
    kind = F.col("event_type")
    measures = [
        agg.count("views", kind == "view"), agg.count("clicks", kind == "click"), agg.count("purchases", kind == "purchase"),
        agg.total("revenue", F.when(kind == "purchase", F.col("value"))),
    ]
    week = {"": Span(days(0), days(7), "neither")}
    return ent.anchored_features(
        assignments, t.events, "user_id", "ts", "event_id", "assigned_at", week, measures, unit=["assignment_id"]
    )


@plan(
    "l22_exposure_features",
    f"""
    WITH {EXPOSED}
    SELECT assignment_id, variant, views, clicks, purchases, {rq('revenue', 2)} AS revenue,
           {rq('coalesce(clicks / nullif(views, 0)::DOUBLE, 0)')} AS click_rate FROM x
    """,
)
def l22(t: Tables):
    return exposures(t).select(
        "assignment_id", "variant", "views", "clicks", "purchases", r("revenue", 2).alias("revenue"),
        r(safe_ratio("clicks", "views")).alias("click_rate"),
    )


@plan(
    "l22_variant_rates",
    f"""
    WITH {EXPOSED}
    SELECT variant, count(*) AS assignments, {rq('avg(CASE WHEN purchases > 0 THEN 1.0 ELSE 0 END)', 6)} AS buyer_rate,
           {rq('avg(revenue)', 3)} AS mean_revenue FROM x GROUP BY 1
    """,
)
def l22_rates(t: Tables):
    return exposures(t).groupBy("variant").agg(
        F.count(F.lit(1)).alias("assignments"), r(F.avg(flag(F.col("purchases") > 0)), 6).alias("buyer_rate"),
        r(F.avg("revenue"), 3).alias("mean_revenue"),
    )
