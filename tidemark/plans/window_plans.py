"""Features over earlier rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import elapsed_days, elapsed_seconds
from tidemark.functions.values import flag, safe_ratio, smoothed_ratio
from tidemark.operators import aggregates as agg
from tidemark.operators import history as h
from tidemark.operators.entity_features import mean_gap, newest_rows
from tidemark.plans.registry import Tables, plan, r, rounded, rq
from tidemark.skew import names
from tidemark.spans import days, hours, instant

PRIOR = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
ORDER = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
PRIOR_USER = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
USER = "(PARTITION BY user_id ORDER BY ts, event_id)"


def over_orders(t: Tables, features, **options):
    return h.running_features(t.orders, "o_custkey", "o_orderdate", "o_orderkey", features, **options)


def over_events(t: Tables, features, **options):
    return h.running_features(t.events, "user_id", "ts", "event_id", features, **options)


@plan(
    "w1_group_total_on_rows",
    f"""
    SELECT o_orderkey, count(*) OVER w AS n, {rq('sum(o_totalprice) OVER w', 2)} AS total,
           {rq('o_totalprice / sum(o_totalprice) OVER w', 6)} AS share FROM orders WINDOW w AS (PARTITION BY o_custkey)
    """,
)
def w1(t: Tables):
    rows = agg.group_totals(t.orders, "o_custkey", [agg.count("n"), agg.total("total", "o_totalprice")], "o_orderkey")
    return rows.select("o_orderkey", "n", r("total", 2).alias("total"), r(F.col("o_totalprice") / F.col("total"), 6).alias("share"))


@plan(
    "w2_running_total",
    f"""
    SELECT o_orderkey, {rq('sum(o_totalprice) OVER w', 2)} AS running, count(*) OVER w AS n FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def w2(t: Tables):
    rows = over_orders(t, [h.past_sum("running", "o_totalprice"), h.past_count("n")], current_row=True)
    return rows.select("o_orderkey", r("running", 2).alias("running"), "n")


@plan(
    "w2_monthly_running_total",
    f"""
    WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2)
    SELECT o_custkey, month, {rq('total', 2)} AS total,
           {rq('sum(total) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS running
    FROM m
    """,
)
def w2_monthly(t: Tables):
    monthly = t.orders.groupBy("o_custkey", F.date_trunc("month", "o_orderdate").alias("month")).agg(
        F.sum("o_totalprice").alias("total")
    )
    rows = h.running_features(monthly, "o_custkey", "month", [], [h.past_sum("running", "total")], current_row=True)
    return rows.select("o_custkey", F.date_format("month", "yyyy-MM").alias("month"), r("total", 2).alias("total"), r("running", 2).alias("running"))


@plan(
    "w3_prior_running",
    f"""
    SELECT o_orderkey, count(*) OVER w AS n_prior, {rq('coalesce(sum(o_totalprice) OVER w, 0)', 2)} AS sum_prior,
           {rq('coalesce(avg(o_totalprice) OVER w, 0)')} AS mean_prior, coalesce(max(o_totalprice) OVER w, 0) AS max_prior,
           coalesce(min(o_totalprice) OVER w, 0) AS min_prior FROM orders WINDOW w AS {PRIOR}
    """,
)
def w3(t: Tables):
    price = "o_totalprice"
    features = [
        h.past_count("n_prior"), h.past_sum("sum_prior", price), h.past_mean("mean_prior", price),
        h.past_max("max_prior", price, 0.0), h.past_min("min_prior", price, 0.0),
    ]
    rows = over_orders(t, features)
    return rows.select("o_orderkey", "n_prior", r("sum_prior", 2).alias("sum_prior"), r("mean_prior").alias("mean_prior"), "max_prior", "min_prior")


@plan(
    "w3_strictly_earlier",
    f"""
    SELECT o_orderkey, count(*) OVER w AS n_before, {rq('coalesce(avg(o_totalprice) OVER w, 0)')} AS mean_before FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    """,
)
def w3_strict(t: Tables):
    rows = over_orders(t, [h.past_count("n_before"), h.past_mean("mean_before", "o_totalprice")], strictly_earlier=True)
    return rows.select("o_orderkey", "n_before", r("mean_before").alias("mean_before"))


@plan(
    "w3_strictly_earlier_null_times",
    f"""
    WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS moment FROM orders)
    SELECT o_orderkey, CASE WHEN moment IS NULL THEN 0 ELSE count(*) OVER w END AS n_before,
           {rq('CASE WHEN moment IS NULL THEN 0 ELSE coalesce(avg(o_totalprice) OVER w, 0) END')} AS mean_before FROM o
    WINDOW w AS (PARTITION BY o_custkey ORDER BY moment NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    """,
)
def w3_null_times(t: Tables):
    """Orders in progress have no time: nothing is earlier than they are, and they are earlier than all others."""
    orders = t.orders.withColumn("moment", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    features = [h.past_count("n_before"), h.past_mean("mean_before", "o_totalprice")]
    rows = h.running_features(orders, "o_custkey", "moment", "o_orderkey", features, strictly_earlier=True, hot_from=t.orders)
    return rows.select("o_orderkey", "n_before", r("mean_before").alias("mean_before"))


@plan(
    "w4_last_n_rows",
    f"""
    SELECT o_orderkey, count(*) OVER w AS n5, {rq('avg(o_totalprice) OVER w')} AS mean5, max(o_totalprice) OVER w AS max5 FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
    """,
)
def w4(t: Tables):
    wanted = {"n5": F.count(F.lit(1)), "mean5": F.avg("o_totalprice"), "max5": F.max("o_totalprice")}
    rows = h.last_rows_features(t.orders, "o_custkey", "o_orderdate", "o_orderkey", -5, -1, wanted)
    return rows.select("o_orderkey", "n5", r("mean5").alias("mean5"), "max5")


@plan(
    "w5_trailing_range",
    f"""
    SELECT event_id, count(*) OVER w AS n_24h, {rq('coalesce(sum(value) OVER w, 0)', 2)} AS sum_24h,
           {rq('avg(value) OVER w')} AS mean_24h, max(value) OVER w AS max_24h FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    """,
)
def w5(t: Tables):
    value = F.col("value")
    wanted = [h.Trailing("n" if k == "count" else k, k, value) for k in ("count", "sum", "mean", "max")]
    rows = h.trailing_features(t.events, "user_id", "ts", "event_id", {"24h": hours(24)}, wanted)
    return rows.select("event_id", "n_24h", r(F.coalesce("sum_24h", F.lit(0.0)), 2).alias("sum_24h"), r("mean_24h").alias("mean_24h"), "max_24h")


@plan(
    "w5_trailing_range_null_times",
    f"""
    WITH e AS (SELECT event_id, user_id, value, CASE WHEN event_type <> 'purchase' THEN ts END AS moment FROM events)
    SELECT event_id, CASE WHEN moment IS NULL THEN 0 ELSE count(value) OVER w END AS n_24h,
           {rq('CASE WHEN moment IS NOT NULL THEN avg(value) OVER w END')} AS mean_24h, CASE WHEN moment IS NOT NULL THEN max(value) OVER w END AS max_24h,
           CASE WHEN moment IS NULL THEN 0 ELSE count(DISTINCT value) OVER w END AS distinct_24h FROM e
    WINDOW w AS (PARTITION BY user_id ORDER BY moment RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    """,
)
def w5_null_times(t: Tables):
    """Purchases have no time here: their frames are empty and they are in no other."""
    events = t.events.withColumn("moment", F.when(F.col("event_type") != "purchase", F.col("ts")))
    wanted = [h.Trailing("n" if k == "count" else k, k, F.col("value")) for k in ("count", "mean", "max", "distinct")]
    rows = h.trailing_features(events, "user_id", "moment", "event_id", {"24h": hours(24)}, wanted)
    return rows.select("event_id", "n_24h", r("mean_24h").alias("mean_24h"), "max_24h", "distinct_24h")


@plan(
    "w6_lag_with_default",
    f"""
    SELECT event_id, coalesce(lag(event_type) OVER {USER}, 'none') AS previous_type,
           {rq(f"coalesce(lag(value) OVER {USER}, value)")} AS previous_value FROM events
    """,
)
def w6(t: Tables):
    features = [h.previous("previous_type", "event_type", "none"), h.previous("previous_value", "value", F.col("value"))]
    return over_events(t, features).select("event_id", "previous_type", r("previous_value").alias("previous_value"))


@plan("w7_next_row", f"SELECT event_id, lead(event_type) OVER {USER} AS next_type, lead(value) OVER {USER} AS next_value FROM events")
def w7(t: Tables):
    both = t.events.withColumn("both", F.struct("event_type", "value"))
    rows = h.next_value(both, "user_id", "ts", "event_id", "both", "next")
    return rows.select("event_id", F.col("next.event_type").alias("next_type"), F.col("next.value").alias("next_value"))


@plan(
    "w8_last_time_condition_held",
    f"""
    SELECT event_id, {rq(f"(epoch_us(ts) - epoch_us(max(CASE WHEN event_type = 'purchase' THEN ts END) OVER {PRIOR_USER})) / 1e6", 3)} AS seconds_since_purchase
    FROM events
    """,
)
def w8(t: Tables):
    bought = F.when(F.col("event_type") == "purchase", F.col("ts"))
    rows = over_events(t, [h.latest("bought_at", bought)])
    return rows.select("event_id", r(elapsed_seconds("ts", "bought_at"), 3).alias("seconds_since_purchase"))


@plan(
    "w9_latest_row",
    """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1
    """,
)
def w9(t: Tables):
    return newest_rows(t.events, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@plan("w10_ordinal", f"SELECT o_orderkey, row_number() OVER {ORDER} AS ordinal FROM orders")
def w10(t: Tables):
    return h.ordinal(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", "ordinal")


@plan("w11_global_row_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no FROM orders")
def w11(t: Tables):
    return h.ordinal(t.orders, [], "o_orderdate", "o_orderkey", "row_no").select("o_orderkey", "row_no")


@plan(
    "w12_distinct_before",
    f"""
    SELECT event_id, count(DISTINCT event_type) OVER {PRIOR_USER} AS kinds_before FROM events
    """,
)
def w12(t: Tables):
    rows = h.distinct_before(t.events, "user_id", "ts", "event_id", "event_type", "kinds_before")
    return rows.select("event_id", "kinds_before")


@plan(
    "w12_distinct_last_rows",
    """
    SELECT event_id, count(DISTINCT event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
           AS kinds_last5 FROM events
    """,
)
def w12_rows(t: Tables):
    return h.distinct_last_rows(t.events, "user_id", "ts", "event_id", "event_type", 5, "kinds_last5").select("event_id", "kinds_last5")


@plan("w13_prior_cumulative_sum", f"SELECT event_id, {rq(f'coalesce(sum(value) OVER {PRIOR_USER}, 0)', 2)} AS spent_before FROM events")
def w13(t: Tables):
    return over_events(t, [h.past_sum("spent_before", "value")]).select("event_id", r("spent_before", 2).alias("spent_before"))


@plan(
    "w14_time_since_previous",
    f"""
    SELECT o_orderkey, {rq(f"(epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER {ORDER})) / 86400e6")} AS days_since FROM orders
    """,
)
def w14(t: Tables):
    rows = over_orders(t, [h.previous("previous_at", "o_orderdate")])
    return rows.select("o_orderkey", r(elapsed_days("o_orderdate", "previous_at")).alias("days_since"))


@plan(
    "w15_rolling_time_mean",
    f"""
    SELECT o_orderkey, {rq('avg(o_totalprice) OVER w')} AS mean_30d FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate
                 RANGE BETWEEN INTERVAL '29 days 23:59:59.999999' PRECEDING AND CURRENT ROW)
    """,
)
def w15(t: Tables):
    wanted = [h.Trailing("mean", "mean", F.col("o_totalprice"))]
    rows = h.trailing_features(t.orders, "o_custkey", "o_orderdate", "o_orderkey", {"30d": days(30)}, wanted, closed="right")
    return rows.select("o_orderkey", r("mean_30d").alias("mean_30d"))


DAILY = """
    daily AS (SELECT event_type, date_trunc('day', ts) AS day, sum(value) AS total FROM events GROUP BY 1, 2)
"""


def daily(t: Tables):
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("day")
    return t.events.groupBy("event_type", day).agg(F.sum("value").alias("total"))


@plan(
    "w16_rolling_rows_mean",
    f"""
    WITH {DAILY} SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
      {rq('avg(total) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS mean7 FROM daily
    """,
)
def w16(t: Tables):
    rows = h.last_rows_features(daily(t), "event_type", "day", [], -6, 0, {"mean7": F.avg("total")})
    return rows.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), r("mean7").alias("mean7"))


@plan(
    "w17_series_lag",
    f"""
    WITH {DAILY} SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
      {rq('lag(total, 1) OVER (PARTITION BY event_type ORDER BY day)', 2)} AS lag1,
      {rq('lag(total, 7) OVER (PARTITION BY event_type ORDER BY day)', 2)} AS lag7 FROM daily
    """,
)
def w17(t: Tables):
    rows = daily(t)
    for n in (1, 7):
        back = {f"lag{n}": F.max("total")}
        rows = h.last_rows_features(rows, "event_type", "day", [], -n, -n, back)
    return rows.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), r("lag1", 2).alias("lag1"), r("lag7", 2).alias("lag7"))


HORIZONS = (1, 4, 24, 168)


def _horizon_sql() -> str:
    columns = []
    for n in HORIZONS:
        w = f"w{n}"
        columns += [
            f"{rq(f'avg(value) OVER {w}')} AS mean_{n}h", f"{rq(f'median(value) OVER {w}')} AS median_{n}h",
            f"{rq(f'stddev_samp(value) OVER {w}')} AS std_{n}h", f"min(value) OVER {w} AS min_{n}h", f"max(value) OVER {w} AS max_{n}h",
        ]
    windows = ", ".join(
        f"w{n} AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {n} HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"
        for n in HORIZONS
    )
    return f"SELECT event_id, {', '.join(columns)} FROM events WINDOW {windows}"


@plan("w18_multi_horizon", _horizon_sql())
def w18(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    wanted = [h.Trailing(kind, kind, F.col("value")) for kind in ("mean", "median", "std", "min", "max")]
    rows = h.trailing_features(rows, "user_id", "ts", "event_id", {f"{n}h": hours(n) for n in HORIZONS}, wanted)
    return rounded(rows.drop("user_id", "ts", "value"))


@plan(
    "w19_mean_gap",
    f"""
    WITH g AS (SELECT user_id, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER {USER})) / 1e6 AS gap FROM events
               WHERE ts < TIMESTAMP '2024-01-15')
    SELECT user_id, {rq('avg(gap)', 3)} AS mean_gap_seconds FROM g GROUP BY 1
    """,
)
def w19(t: Tables):
    early = t.events.where(F.col("ts") < instant(F.lit("2024-01-15")))
    gaps = mean_gap(early, "user_id", "ts", "mean_gap_seconds")
    return gaps.select("user_id", r("mean_gap_seconds", 3).alias("mean_gap_seconds"))


@plan(
    "w20_prior_rate",
    f"""
    SELECT event_id, {rq(f"coalesce(count(*) FILTER (WHERE event_type = 'purchase') OVER {PRIOR_USER} / nullif(count(*) OVER {PRIOR_USER}, 0)::DOUBLE, 0)")} AS buy_rate
    FROM events
    """,
)
def w20(t: Tables):
    rows = over_events(t, [h.past_count("buys", F.col("event_type") == "purchase"), h.past_count("n")])
    return rows.select("event_id", r(safe_ratio("buys", "n")).alias("buy_rate"))


@plan(
    "w21_smoothed_prior_ratio",
    f"""
    SELECT event_id, {rq(f"(count(*) FILTER (WHERE event_type = 'click') OVER {PRIOR_USER} + 1.0) / (count(*) FILTER (WHERE event_type = 'view') OVER {PRIOR_USER} + 1.0)")} AS clicks_per_view
    FROM events
    """,
)
def w21(t: Tables):
    kind = F.col("event_type")
    rows = over_events(t, [h.past_count("clicks", kind == "click"), h.past_count("views", kind == "view")])
    return rows.select("event_id", r(smoothed_ratio("clicks", "views")).alias("clicks_per_view"))


@plan(
    "w22_first_flags",
    """
    SELECT event_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS INTEGER) AS is_first,
      CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS INTEGER) AS is_first_of_kind FROM events
    """,
)
def w22(t: Tables):
    rows = h.running_features(t.events, "user_id", "ts", "event_id", [h.past_count("n")])
    rows = h.running_features(rows, ["user_id", "event_type"], "ts", "event_id", [h.past_count("n_kind")], hot_from=t.events)
    return rows.select("event_id", flag(F.col("n") == 0).alias("is_first"), flag(F.col("n_kind") == 0).alias("is_first_of_kind"))


@plan(
    "w23_second_axis",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
      count(*) OVER p AS part_prior_n, {rq('coalesce(avg(l_quantity) OVER p, 0)')} AS part_prior_quantity,
      count(*) OVER s AS supplier_prior_n,
      {rq("coalesce(count(*) FILTER (WHERE l_returnflag = 'R') OVER s / nullif(count(*) OVER s, 0)::DOUBLE, 0)")} AS supplier_prior_returns
    FROM lineitem
    WINDOW p AS (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           s AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    """,
)
def w23(t: Tables):
    parts = [h.past_count("part_prior_n"), h.past_mean("part_prior_quantity", "l_quantity")]
    sellers = [h.past_count("supplier_prior_n"), h.past_mean("supplier_prior_returns", flag(F.col("l_returnflag") == "R"))]
    tie = names(["l_orderkey", "l_linenumber"])
    rows = h.running_features(t.lineitem, "l_partkey", "l_shipdate", [*tie, "l_suppkey", "l_extendedprice"], parts)
    rows = h.running_features(rows, "l_suppkey", "l_shipdate", [*tie, "l_partkey", "l_extendedprice"], sellers, hot_from=t.lineitem)
    kept = rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                       "part_prior_n", "part_prior_quantity", "supplier_prior_n", "supplier_prior_returns")
    return rounded(kept)


@plan("w24_deviation_from_prior_mean", f"SELECT o_orderkey, {rq(f'o_totalprice - coalesce(avg(o_totalprice) OVER {PRIOR}, 0)')} AS above_usual FROM orders")
def w24(t: Tables):
    rows = over_orders(t, [h.past_mean("usual", "o_totalprice")])
    return rows.select("o_orderkey", r(F.col("o_totalprice") - F.col("usual")).alias("above_usual"))


@plan("w25_ratio_to_prior_mean", f"SELECT o_orderkey, {rq(f'coalesce(o_totalprice / nullif(avg(o_totalprice) OVER {PRIOR}, 0), 1)')} AS ratio FROM orders")
def w25(t: Tables):
    rows = over_orders(t, [h.past_mean("usual", "o_totalprice", None)])
    return rows.select("o_orderkey", r(safe_ratio("o_totalprice", "usual", 1.0)).alias("ratio"))
