"""Whole feature-and-label tables and model runs, each composed of several operators."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bins, text
from tidemark.functions import dates as d
from tidemark.functions.values import choose, flag, safe_ratio, smoothed_ratio
from tidemark.models import evaluate, prepare, train
from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.operators import history as h
from tidemark.operators import labels
from tidemark.plans.entity_plans import orders_by_customer
from tidemark.plans.registry import Tables, plan, r, rounded, rq
from tidemark.skew import settle, spread_join
from tidemark.spans import Span, days, hours, instant

P = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
SECOND = "INTERVAL 1 MICROSECOND PRECEDING"


@plan(
    "click_history_table",
    f"""
    WITH f AS (
      SELECT event_id, user_id, event_type, value, ts,
        count(*) OVER u AS user_seen, count(*) FILTER (WHERE value > 20) OVER u AS user_hits,
        count(*) OVER k AS kind_seen, count(*) FILTER (WHERE value > 20) OVER k AS kind_hits,
        lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_at,
        max(CASE WHEN value > 20 THEN ts END) OVER u AS last_hit
      FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id {P}), k AS (PARTITION BY event_type ORDER BY ts, event_id {P}))
    SELECT event_id, user_seen, kind_seen, {rq('coalesce(user_hits / nullif(user_seen, 0)::DOUBLE, 0)', 6)} AS user_rate,
      {rq('(kind_hits + 1.0) / (kind_seen + 1.0)', 6)} AS kind_rate,
      {rq('coalesce((epoch_us(ts) - epoch_us(previous_at)) / 3600e6, -1)', 5)} AS hours_since_previous,
      {rq('coalesce((epoch_us(ts) - epoch_us(last_hit)) / 3600e6, 9999)', 5)} AS hours_since_hit,
      CAST(user_seen = 0 AS INTEGER) AS is_first, hour(ts) AS hour, CAST(isodow(ts) >= 6 AS INTEGER) AS weekend,
      CAST(value > 20 AS INTEGER) AS label FROM f
    """,
)
def click_history_table(t: Tables):
    """Per event: what the user and the kind of event did before."""
    hit = F.col("value") > 20
    by_user = [
        h.past_count("user_seen"), h.past_count("user_hits", hit), h.previous("previous_at", "ts"),
        h.latest("last_hit", F.when(hit, F.col("ts"))),
    ]
    by_kind = [h.past_count("kind_seen"), h.past_count("kind_hits", hit)]
    rows = h.running_features(t.events, "user_id", "ts", "event_id", by_user)
    rows = h.running_features(rows, "event_type", "ts", "event_id", by_kind, hot_from=t.events)
    since = d.elapsed_seconds("ts", "previous_at") / 3600
    since_hit = d.elapsed_seconds("ts", "last_hit") / 3600
    return rows.select(
        "event_id", "user_seen", "kind_seen", r(safe_ratio("user_hits", "user_seen"), 6).alias("user_rate"),
        r(smoothed_ratio("kind_hits", "kind_seen"), 6).alias("kind_rate"),
        r(F.coalesce(since, F.lit(-1.0)), 5).alias("hours_since_previous"),
        r(F.coalesce(since_hit, F.lit(9999.0)), 5).alias("hours_since_hit"),
        flag(F.col("user_seen") == 0).alias("is_first"), F.hour("ts").alias("hour"), d.is_weekend("ts").alias("weekend"),
        flag(hit).alias("label"),
    )


@plan(
    "churn_table",
    f"""
    WITH c AS (SELECT max(ts) - INTERVAL 7 DAY AS cutoff FROM events),
    born AS (SELECT user_id, min(ts) AS born FROM events GROUP BY 1),
    past AS (SELECT e.*, cutoff FROM events e, c WHERE ts <= cutoff),
    f AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE ts > cutoff - INTERVAL 7 DAY) AS n_7d,
                 count(DISTINCT CAST(ts AS DATE)) AS active_days, max(ts) AS last_at, sum(value) AS total FROM past GROUP BY 1),
    later AS (SELECT DISTINCT user_id FROM events, c WHERE ts > cutoff)
    SELECT b.user_id, coalesce(n, 0) AS n, coalesce(n_7d, 0) AS n_7d, coalesce(active_days, 0) AS active_days,
      {rq('coalesce(total / nullif(n, 0), 0)')} AS mean_value, {rq('coalesce(n_7d / nullif(n, 0)::DOUBLE, 0)', 6)} AS recent_share,
      {rq('coalesce((epoch_us(cutoff) - epoch_us(last_at)) / 86400e6, 9999)', 5)} AS days_since_last,
      CAST(floor((epoch_us(cutoff) - epoch_us(born)) / 86400e6) AS BIGINT) AS tenure,
      CAST(b.user_id NOT IN (SELECT user_id FROM later) AS INTEGER) AS churned
    FROM born b CROSS JOIN c LEFT JOIN f ON f.user_id = b.user_id WHERE born <= cutoff
    """,
)
def churn_table(t: Tables):
    """Users known at a cutoff taken from the data, with features before it and churn after it."""
    cutoff = ent.data_cutoff(t.events, "ts", days(7))
    born = t.events.groupBy("user_id").agg(F.min("ts").alias("born")).where(F.col("born") <= cutoff)
    windows = {"": Span(None, days(0), "right"), "7d": Span(days(-7), days(0), "right")}
    measures = [agg.count("n"), agg.distinct("active_days", F.to_date("ts")), agg.total("total", "value"), agg.largest("last_at", "ts")]
    df = ent.cutoff_features(born, t.events, "user_id", "ts", cutoff, windows, measures)
    df = labels.no_event_label(df, t.events, "user_id", "ts", cutoff, Span(days(0), None, "neither"), "churned")
    return df.select(
        "user_id", "n", "n_7d", "active_days", r(safe_ratio("total", "n")).alias("mean_value"),
        r(safe_ratio("n_7d", "n"), 6).alias("recent_share"),
        r(F.coalesce(d.elapsed_days(cutoff, "last_at"), F.lit(9999.0)), 5).alias("days_since_last"),
        d.days_floored(cutoff, "born").alias("tenure"), "churned",
    )


@plan(
    "lifetime_value_table",
    f"""
    WITH a AS (SELECT o_custkey, min(o_orderdate) AS anchor FROM orders GROUP BY 1),
    o AS (SELECT orders.*, anchor FROM orders JOIN a USING (o_custkey)),
    early AS (SELECT * FROM o WHERE o_orderdate >= anchor AND o_orderdate < anchor + INTERVAL 180 DAY),
    f AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend, count(DISTINCT o_orderpriority) AS kinds FROM early GROUP BY 1),
    i AS (SELECT o_custkey, count(*) AS items, sum(l_quantity) AS quantity FROM lineitem JOIN early ON l_orderkey = o_orderkey GROUP BY 1),
    l AS (SELECT a.o_custkey, coalesce(sum(o_totalprice), 0) AS next_spend FROM a LEFT JOIN o ON o.o_custkey = a.o_custkey
          AND o_orderdate >= a.anchor + INTERVAL 180 DAY AND o_orderdate < a.anchor + INTERVAL 720 DAY GROUP BY 1),
    q AS (SELECT quantile_cont(next_spend, 1/3.0::DOUBLE) AS x, quantile_cont(next_spend, 2/3.0::DOUBLE) AS y FROM l WHERE next_spend > 0)
    SELECT a.o_custkey, n, {rq('spend', 2)} AS spend, kinds, coalesce(items, 0) AS items, {rq('coalesce(quantity, 0)', 2)} AS quantity,
      {rq('coalesce(quantity / nullif(items, 0), 0)')} AS per_item,
      CASE WHEN next_spend <= 0 THEN 'none' WHEN next_spend <= x THEN 'low' WHEN next_spend <= y THEN 'medium' ELSE 'high' END AS tier
    FROM a JOIN f USING (o_custkey) LEFT JOIN i USING (o_custkey) JOIN l USING (o_custkey), q
    """,
)
def lifetime_value_table(t: Tables):
    """First 180 days per customer from two event tables; label is the tier of what follows."""
    anchors = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("anchor"))
    early, late = Span(days(0), days(180), "left"), Span(days(180), days(720), "left")
    price, first = F.col("o_totalprice"), {"": early}
    measures = [agg.count("n"), agg.total("spend", price), agg.distinct("kinds", "o_orderpriority")]
    df = ent.anchored_features(anchors, t.orders, "o_custkey", "o_orderdate", "o_orderkey", "anchor", first, measures)
    started = ent.window_join(anchors, t.orders, "o_custkey", "o_orderdate", "o_orderkey", "anchor", early)
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity")
    )
    items = started.select("o_custkey", "o_orderkey").join(per_order, "o_orderkey")
    df = agg.attach_summary(df, items, "o_custkey", [agg.total("items", "items", 0), agg.total("quantity", "quantity")])
    spent = [agg.total("next_spend", price)]
    future = ent.anchored_features(anchors, t.orders, "o_custkey", "o_orderdate", "o_orderkey", "anchor", {"": late}, spent)
    tiers = bins.zero_and_quantile_tiers(future, "next_spend", ["none", "low", "medium", "high"], "tier")
    return df.join(tiers.select("o_custkey", "tier"), "o_custkey").select(
        "o_custkey", "n", r("spend", 2).alias("spend"), "kinds", "items", r("quantity", 2).alias("quantity"),
        r(safe_ratio("quantity", "items")).alias("per_item"), "tier",
    )


@plan(
    "next_order_table",
    f"""
    WITH f AS (
      SELECT o_orderkey, o_totalprice, c_mktsegment, count(*) OVER w AS n_prior, avg(o_totalprice) OVER w AS mean_prior,
        count(DISTINCT o_orderpriority) OVER w AS kinds_prior, avg(o_totalprice) OVER m AS mean_60d,
        lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price
      FROM orders JOIN customer ON c_custkey = o_custkey
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey {P}),
             m AS (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND {SECOND}))
    SELECT o_orderkey, c_mktsegment, n_prior, kinds_prior, {rq('coalesce(o_totalprice / nullif(mean_prior, 0), 1)')} AS ratio,
      {rq('coalesce(mean_60d, 0)')} AS mean_60d, next_price FROM f WHERE next_price IS NOT NULL
    """,
)
def next_order_table(t: Tables):
    """Per order: history of the customer, and the price of the next order as the target."""
    key, time, tie = "o_custkey", "o_orderdate", "o_orderkey"
    rows = labels.next_value_label(t.orders, key, time, tie, "o_totalprice", "next_price").select(tie, "next_price")
    prior = h.running_features(t.orders, key, time, tie, [h.past_count("n_prior"), h.past_mean("mean_prior", "o_totalprice", None)])
    kinds = h.distinct_before(t.orders, key, time, tie, "o_orderpriority", "kinds_prior").select(tie, "kinds_prior")
    recent = [h.Trailing("mean", "mean", F.col("o_totalprice"))]
    range_ = h.trailing_features(t.orders, key, time, tie, {"60d": days(60)}, recent).select(tie, "mean_60d")
    segments = t.customer.select(F.col("c_custkey").alias(key), "c_mktsegment")
    df = spread_join(prior, segments, key, tie).join(rows, tie).join(kinds, tie).join(range_, tie)
    return df.select(
        tie, "c_mktsegment", "n_prior", "kinds_prior", r(safe_ratio("o_totalprice", "mean_prior", 1.0)).alias("ratio"),
        r(F.coalesce("mean_60d", F.lit(0.0))).alias("mean_60d"), "next_price",
    )


CUT = "TIMESTAMP '2000-06-30'"


@plan(
    "renewal_table",
    f"""
    WITH s AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS state, max(o_orderdate) AS state_at
               FROM orders WHERE o_orderdate < {CUT} GROUP BY 1),
    u AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend FROM orders WHERE o_orderdate < {CUT} AND o_orderdate >= {CUT} - INTERVAL 180 DAY GROUP BY 1),
    y AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= {CUT} AND o_orderdate < {CUT} + INTERVAL 120 DAY)
    SELECT c_custkey, state, {rq(f'(epoch_us({CUT}) - epoch_us(state_at)) / 86400e6', 3)} AS days_in_state, coalesce(n, 0) AS n,
      {rq('coalesce(spend, 0)', 2)} AS spend, CAST(state = 'F' AND y.o_custkey IS NOT NULL AS INTEGER) AS renews
    FROM customer JOIN s ON s.o_custkey = c_custkey LEFT JOIN u ON u.o_custkey = c_custkey LEFT JOIN y ON y.o_custkey = c_custkey
    """,
)
def renewal_table(t: Tables):
    """State at the cutoff, usage before it, and whether customers in that state come back."""
    orders, cutoff = orders_by_customer(t), instant(F.lit("2000-06-30"))
    past = orders.where(F.col("o_orderdate") < cutoff)
    latest = ent.newest_rows(past, "c_custkey", "o_orderdate", "o_orderkey")
    states = latest.select("c_custkey", F.col("o_orderstatus").alias("state"), F.col("o_orderdate").alias("state_at"))
    half_year = {"": Span(days(-180), days(0), "left")}
    df = t.customer.select("c_custkey").join(states, "c_custkey")
    df = ent.cutoff_features(df, orders, "c_custkey", "o_orderdate", cutoff, half_year, [agg.count("n"), agg.total("spend", "o_totalprice")])
    after = Span(days(0), days(120), "left")
    df = labels.state_and_event_label(df, states, orders, "c_custkey", F.col("state") == "F", "o_orderdate", cutoff, after, "renews")
    return df.select("c_custkey", "state", r(d.elapsed_days(cutoff, "state_at"), 3).alias("days_in_state"), "n", r("spend", 2).alias("spend"), "renews")


@plan(
    "category_demand_table",
    f"""
    WITH k AS (SELECT DISTINCT o_orderpriority FROM orders), n AS (SELECT n_nationkey FROM nation),
    o AS (SELECT c_nationkey, o_orderpriority, o_orderdate, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT n_nationkey, k.o_orderpriority,
      count(o_totalprice) FILTER (WHERE o_orderdate < {CUT} AND o_orderdate >= {CUT} - INTERVAL 30 DAY) AS n_30d,
      {rq(f'coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate < {CUT} AND o_orderdate >= {CUT} - INTERVAL 90 DAY), 0)', 2)} AS total_90d,
      {rq(f'coalesce((epoch_us({CUT}) - epoch_us(max(o_orderdate) FILTER (WHERE o_orderdate < {CUT}))) / 86400e6, 9999)', 3)} AS days_since_last,
      count(o_totalprice) FILTER (WHERE o_orderdate >= {CUT} AND o_orderdate < {CUT} + INTERVAL 7 DAY) AS next_7d
    FROM n CROSS JOIN k LEFT JOIN o ON o.c_nationkey = n_nationkey AND o.o_orderpriority = k.o_orderpriority GROUP BY 1, 2
    """,
)
def category_demand_table(t: Tables):
    """Every nation with every priority: past windows, recency, and demand in the next week."""
    cutoff = instant(F.lit("2000-06-30"))
    nations = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    sales = spread_join(t.orders, nations, "o_custkey", "o_orderkey")
    grid = ent.category_grid(t.nation.select("n_nationkey"), t.orders, "o_orderpriority")
    unit = ["n_nationkey", "o_orderpriority"]
    windows = {
        "30d": Span(days(-30), days(0), "left"), "90d": Span(days(-90), days(0), "left"),
        "past": Span(None, days(0), "left"), "7d": Span(days(0), days(7), "left"),
    }
    measures = [agg.count("n"), agg.total("total", "o_totalprice"), agg.largest("last", "o_orderdate")]
    wide = ent.windowed_summary(sales, unit, "o_orderdate", cutoff, windows, measures)
    df = agg.fill_defaults(grid.join(wide, unit, "left"), {"n_30d": 0, "n_7d": 0, "total_90d": 0.0})
    gap = F.coalesce(d.elapsed_days(cutoff, "last_past"), F.lit(9999.0))
    return df.select(*unit, "n_30d", r("total_90d", 2).alias("total_90d"), r(gap, 3).alias("days_since_last"), F.col("n_7d").alias("next_7d"))


CUT_E = "TIMESTAMP '2024-01-25'"


@plan(
    "booking_demand_table",
    f"""
    WITH w AS (SELECT user_id, avg(value) FILTER (WHERE ts >= {CUT_E} - INTERVAL 7 DAY) AS m7,
                      avg(value) FILTER (WHERE ts < {CUT_E} - INTERVAL 7 DAY AND ts >= {CUT_E} - INTERVAL 14 DAY) AS m7_before,
                      avg(value) FILTER (WHERE ts >= {CUT_E} - INTERVAL 21 DAY) AS m21 FROM events WHERE ts < {CUT_E} GROUP BY 1),
    main AS (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM
             (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts < {CUT_E} GROUP BY 1, 2)) WHERE k = 1),
    peer AS (SELECT main.event_type, avg(value) AS peer_mean FROM events e JOIN main USING (user_id) WHERE ts < {CUT_E} GROUP BY 1),
    nxt AS (SELECT user_id, avg(value) AS next_mean FROM events WHERE ts >= {CUT_E} GROUP BY 1)
    SELECT w.user_id, {rq('m7')} AS mean_7d, {rq('m21')} AS mean_21d, {rq('m7 - m7_before')} AS trend, main.event_type AS main_type, {rq('peer_mean')} AS peer_mean,
      CASE WHEN next_mean / m21 >= 1.2 THEN 'up' WHEN next_mean / m21 >= 0.8 THEN 'flat' WHEN next_mean IS NULL THEN 'none' ELSE 'down' END AS demand
    FROM w JOIN main USING (user_id) JOIN peer ON peer.event_type = main.event_type LEFT JOIN nxt ON nxt.user_id = w.user_id
    """,
)
def booking_demand_table(t: Tables):
    """Window means, their trend and the peer group's mean; label is the change in the following days."""
    cutoff = instant(F.lit("2024-01-25"))
    past = t.events.where(F.col("ts") < cutoff)
    windows = {"7d": Span(days(-7), days(0), "left"), "before": Span(days(-14), days(-7), "left"), "21d": Span(days(-21), days(0), "left")}
    df = ent.windowed_summary(past, "user_id", "ts", cutoff, windows, [agg.mean("mean", "value")])
    main = agg.top_value(past, "user_id", "event_type", "main_type")
    df = df.join(main, "user_id")
    peers = spread_join(past, main, "user_id", "event_id").groupBy("main_type").agg(F.avg("value").alias("peer_mean"))
    df = spread_join(df, peers, "main_type", "user_id")
    df = labels.future_total_label(df, t.events, "user_id", "ts", cutoff, Span(days(0), None, "both"), agg.mean("next_mean", "value"))
    change = F.col("next_mean") / F.nullif(F.col("mean_21d"), F.lit(0.0))
    demand = choose([(change >= 1.2, "up"), (change >= 0.8, "flat"), (F.col("next_mean").isNull(), "none")], "down")
    return df.select(
        "user_id", r("mean_7d").alias("mean_7d"), r("mean_21d").alias("mean_21d"), r(F.col("mean_7d") - F.col("mean_before")).alias("trend"),
        "main_type", r("peer_mean").alias("peer_mean"), demand.alias("demand"),
    )


@plan(
    "delay_table",
    f"""
    WITH w AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS day_errors FROM events WHERE event_type = 'error' GROUP BY ALL),
    f AS (SELECT event_id, user_id, event_type, ts, value, count(*) OVER u AS user_n, avg(value) OVER u AS user_mean,
                 avg(value) OVER k AS kind_mean
          FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND {SECOND}),
                             k AS (PARTITION BY event_type, user_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND {SECOND}))
    SELECT event_id, hour(ts) AS hour, dayofweek(ts) AS weekday, user_n, {rq('coalesce(user_mean, -1)')} AS user_mean, {rq('coalesce(kind_mean, -1)')} AS kind_mean,
      coalesce(day_errors, 0) AS day_errors,
      CASE WHEN value <= 5 THEN 'on time' WHEN value <= 20 THEN 'late' WHEN value <= 1000 THEN 'very late' END AS delay
    FROM f LEFT JOIN w ON w.event_type = f.event_type AND w.day = CAST(f.ts AS DATE)
    """,
)
def delay_table(t: Tables):
    """Per event: clock features, 48-hour history on two keys, a daily table joined on two columns, binned target."""
    value = F.col("value")
    two_days = {"": hours(48)}
    by_user = [h.Trailing("user_n", "count", value), h.Trailing("user_mean", "mean", value)]
    rows = h.trailing_features(t.events, "user_id", "ts", "event_id", two_days, by_user)
    by_kind = [h.Trailing("kind_mean", "mean", value)]
    kinds = h.trailing_features(t.events, ["event_type", "user_id"], "ts", "event_id", two_days, by_kind)
    errors = t.events.where("event_type = 'error'").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("day_errors")
    )
    df = rows.join(kinds.select("event_id", "kind_mean"), "event_id").withColumn("day", F.to_date("ts"))
    df = spread_join(df, errors, ["event_type", "day"], "event_id", how="left", hot_from=t.events.withColumn("day", F.to_date("ts")))
    return df.select(
        "event_id", F.hour("ts").alias("hour"), d.weekday_sunday0("ts").alias("weekday"), "user_n",
        r(F.coalesce("user_mean", F.lit(-1.0))).alias("user_mean"), r(F.coalesce("kind_mean", F.lit(-1.0))).alias("kind_mean"),
        F.coalesce("day_errors", F.lit(0)).alias("day_errors"),
        bins.cut("value", [-1, 5, 20, 1000], ["on time", "late", "very late"]).alias("delay"),
    )


@plan(
    "session_value_table",
    f"""
    WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS clicks,
                      count(*) FILTER (WHERE event_type = 'view') AS views, sum(value) AS total FROM events GROUP BY 1, 2),
    q AS (SELECT quantile_cont(total, 0.75) AS cut FROM s)
    SELECT user_id, CAST(day AS VARCHAR) AS day, n, {rq('0.6 * clicks + 0.4 * views')} AS score, {rq('coalesce(clicks / nullif(views, 0)::DOUBLE, 0)')} AS click_rate,
      CAST(total > cut AS INTEGER) AS high_value FROM s, q
    """,
)
def session_value_table(t: Tables):
    """Daily sessions: counts, a composite score, and a high-value flag at the 75% quantile."""
    dated = t.events.withColumn("day", F.to_date("ts").cast("string"))
    rows = ent.session_rollup(dated, ["user_id", "day"], "ts", "event_type", ["click", "view"], [agg.total("total", "value")])
    rows = bins.above_quantile(rows, "total", {"high_value": 0.75})
    score = 0.6 * F.col("n_click") + 0.4 * F.col("n_view")
    return rows.select("user_id", "day", F.col("n_events").alias("n"), r(score).alias("score"), r(safe_ratio("n_click", "n_view")).alias("click_rate"), "high_value")


@plan(
    "text_intent_table",
    """
    WITH f AS (SELECT doc_id, lang, source, length(text) AS chars, CAST(contains(text, '!') AS INTEGER) AS exclaims,
      CAST(contains(lower(text), 'error') AS INTEGER) + CAST(contains(lower(text), 'the') AS INTEGER) AS n_words,
      count(*) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS source_seen FROM documents)
    SELECT doc_id, chars, exclaims, n_words, source_seen, CASE WHEN chars < 500 THEN 'short' WHEN chars < 3000 THEN 'medium' ELSE 'long' END AS size_class,
      CASE WHEN quality IS NULL THEN 'unknown' WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END AS intent
    FROM f LEFT JOIN labels USING (doc_id)
    """,
)
def text_intent_table(t: Tables):
    """Per document: text features, how many came before from its source, a size class and a class label."""
    features = t.documents.select(
        "doc_id", "lang", "source", text.text_length("text").alias("chars"), text.contains_any_of("text", ["!"]).alias("exclaims"),
        text.keywords_present("text", ["error", "the"]).alias("n_words"),
    )
    rows = h.running_features(features, "source", "doc_id", [], [h.past_count("source_seen")], hot_from=t.documents)
    rows = rows.join(t.labels, "doc_id", "left")
    size = bins.cut("chars", [0, 500, 3000, float("inf")], ["short", "medium", "long"], closed="left")
    known = [(F.col("quality").isNull(), "unknown"), (F.col("toxic") == 1, "toxic"), (F.col("quality") == 1, "good")]
    return rows.select("doc_id", "chars", "exclaims", "n_words", "source_seen", size.alias("size_class"), choose(known, "poor").alias("intent"))


def _report(scored: DataFrame) -> DataFrame:
    rows = settle(train.positive_score(scored).select("label", "score"), "scored")
    quality = evaluate.ranking_quality(rows, "label", "score")
    loss = rows.agg(evaluate.log_loss("label", "score")).scalar()
    return rounded(quality.withColumn("log_loss", loss), 5)


@plan("churn_features_to_model")
def churn_features_to_model(t: Tables):
    """Features, label, stratified split, weighted boosted trees, ranking measures."""
    bought = t.events.where("event_type = 'purchase'")
    cutoff, onwards = ent.data_cutoff(t.events, "ts", days(7)), Span(days(0), None, "neither")
    df = labels.no_event_label(churn_table(t), bought, "user_id", "ts", cutoff, onwards, "label")
    df = df.withColumn("label", F.col("label").cast("double"))
    numbers = ["n", "n_7d", "active_days", "mean_value", "recent_share", "days_since_last", "tenure"]
    df = settle(df.withColumns({c: F.col(c).cast("double") for c in numbers}), "rows")
    marked = settle(prepare.stratified_split(df, "label", ["user_id"], 0.3), "rows")
    fit_rows = prepare.positive_weight(marked.where("is_test = 0"), "label")
    model = prepare.pipeline(prepare.matrix_stages(numbers), train.boosted(weight="weight"))
    return _report(model.fit(fit_rows).transform(marked.where("is_test = 1")))


@plan("clicks_in_time_order_to_model")
def clicks_in_time_order_to_model(t: Tables):
    """Per-event features, a split in time order, preparation fitted on the earlier part only."""
    rows = click_history_table(t).join(t.events.select("event_id", "ts", "event_type"), "event_id")
    numbers = ["user_seen", "kind_seen", "user_rate", "kind_rate", "hours_since_previous", "hours_since_hit", "hour"]
    rows = rows.withColumns({c: F.col(c).cast("double") for c in [*numbers, "label"]})
    parts = settle(train.dealt(prepare.chronological_split(settle(rows, "rows"), "ts", [0.7, 0.3], ["train", "test"])), "rows")
    fit_rows = prepare.positive_weight(parts.where("part = 'train'"), "label")
    model = train.fit_prepared(fit_rows, prepare.matrix_stages(numbers, ["event_type"]), train.boosted_in_blocks(weight="weight"))
    return _report(model.transform(parts.where("part = 'test'")))


@plan("tuned_model_on_one_table")
def tuned_model_on_one_table(t: Tables):
    """Select columns, search a grid, read the best setting back."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", (F.col("l_returnflag") == "R").cast("double").alias("label"))
    rows = settle(rows, "rows")
    model = train.logistic()
    options = train.grid({model.regParam: [0.001, 0.1]})
    stages = prepare.matrix_stages(["l_quantity", "l_discount", "l_tax"])
    found = train.cross_validate(
        rows, ["l_orderkey", "l_linenumber", "l_quantity"], prepare.pipeline(stages, model), BinaryClassificationEvaluator(), 3, options
    )
    scored = [(float(o[model.regParam]), float(m)) for o, m in zip(options, found.avgMetrics, strict=True)]
    best = float(found.bestModel.stages[-1].getRegParam())
    out = t.spark.createDataFrame([(p, m, int(p == best)) for p, m in scored], "penalty double, mean_auc double, is_best int")
    return out.orderBy("penalty")
