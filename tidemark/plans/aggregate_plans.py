"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import weekday_name
from tidemark.functions.values import flag, safe_ratio
from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.plans.registry import Tables, plan, r, rounded, rq
from tidemark.skew import spread_join
from tidemark.spans import Span, days, instant


@plan(
    "g1_group_by_key",
    f"""
    SELECT o_custkey, {rq('sum(o_totalprice)', 2)} AS total, count(*) AS n, {rq('avg(o_totalprice)')} AS mean,
           min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1
    """,
)
def g1(t: Tables):
    price = "o_totalprice"
    measures = [agg.total("total", price), agg.count("n"), agg.mean("mean", price), agg.smallest("low", price), agg.largest("high", price)]
    df = agg.summarise(t.orders, "o_custkey", measures)
    return df.select("o_custkey", r("total", 2).alias("total"), "n", r("mean").alias("mean"), "low", "high")


@plan(
    "g2_conditional_aggregates",
    f"""
    SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS buys,
           {rq("coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0)", 2)} AS spent,
           {rq("avg(CASE WHEN event_type = 'error' THEN value END)")} AS error_mean,
           max(CASE WHEN event_type = 'click' THEN value END) AS top_click FROM events GROUP BY 1
    """,
)
def g2(t: Tables):
    kind, value = F.col("event_type"), F.col("value")
    df = agg.summarise(
        t.events,
        "user_id",
        [
            agg.count("buys", kind == "purchase"),
            agg.total("spent", F.when(kind == "purchase", value)),
            agg.mean("error_mean", F.when(kind == "error", value)),
            agg.largest("top_click", F.when(kind == "click", value)),
        ],
    )
    return df.select("user_id", "buys", r(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"), r("error_mean").alias("error_mean"), "top_click")


@plan(
    "g3_count_distinct",
    """
    SELECT user_id, count(DISTINCT event_type) AS kinds, count(DISTINCT CAST(ts AS DATE)) AS active_days,
           count(DISTINCT CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS buying_days FROM events GROUP BY 1
    """,
)
def g3(t: Tables):
    day = F.to_date("ts")
    measures = [
        agg.distinct("kinds", "event_type"), agg.distinct("active_days", day),
        agg.distinct("buying_days", F.when(F.col("event_type") == "purchase", day)),
    ]
    return agg.summarise(t.events, "user_id", measures)


@plan(
    "g4_any_flag",
    """
    SELECT o_custkey, max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS any_big,
           max(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 1 ELSE 0 END) AS any_urgent_pending
    FROM orders GROUP BY 1
    """,
)
def g4(t: Tables):
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return agg.summarise(t.orders, "o_custkey", [agg.any_flag("any_big", F.col("o_totalprice") > 450000), agg.any_flag("any_urgent_pending", urgent)])


@plan(
    "g5_group_statistics",
    f"""
    SELECT event_type, count(value) AS n, {rq('avg(value)')} AS mean, {rq('stddev_samp(value)')} AS std, min(value) AS min,
           max(value) AS max, {rq('quantile_cont(value, 0.25)')} AS p25, {rq('quantile_cont(value, 0.5)')} AS median,
           {rq('quantile_cont(value, 0.75)')} AS p75 FROM events GROUP BY 1
    """,
)
def g5(t: Tables):
    return rounded(agg.describe_groups(t.events, "event_type", "value"))


@plan(
    "g6_quantile_thresholds",
    f"""
    SELECT {rq('quantile_cont(c_acctbal, 0.33)')} AS q0, {rq('quantile_cont(c_acctbal, 0.66)')} AS q1,
           {rq('quantile_cont(c_acctbal, 0.9)')} AS q2 FROM customer WHERE c_acctbal > 0
    """,
)
def g6(t: Tables):
    return rounded(agg.exact_quantiles(t.customer.where("c_acctbal > 0"), "c_acctbal", [0.33, 0.66, 0.9]))


@plan(
    "g7_mode_per_group",
    """
    WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT user_id, event_type AS main_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM c) WHERE k = 1
    """,
)
def g7(t: Tables):
    return agg.top_value(t.events, "user_id", "event_type", "main_type")


@plan(
    "g8_arg_max_per_group",
    """
    SELECT o_custkey, o_orderkey AS largest_order FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1
    """,
)
def g8(t: Tables):
    rows = ent.newest_rows(t.orders, "o_custkey", "o_totalprice", "o_orderkey")
    return rows.select("o_custkey", F.col("o_orderkey").alias("largest_order"))


KINDS = ["click", "error", "purchase", "signup", "view"]


@plan(
    "g9_cross_table",
    "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS \"{k}\"" for k in KINDS) + " FROM events GROUP BY 1",
)
def g9(t: Tables):
    return agg.cross_table(t.events, "user_id", "event_type", KINDS)


@plan(
    "g9_cross_table_shares",
    "SELECT o_orderpriority, "
    + ", ".join(rq(f"count(*) FILTER (WHERE o_orderstatus = '{k}') / count(*)::DOUBLE", 6) + f' AS "{k}"' for k in "FOP")
    + " FROM orders GROUP BY 1",
)
def g9_shares(t: Tables):
    return rounded(agg.cross_table(t.orders, "o_orderpriority", "o_orderstatus", list("FOP"), shares=True), 6)


@plan(
    "g10_class_shares",
    f"SELECT c_mktsegment, count(*) AS n, {rq('count(*) / (SELECT count(*) FROM customer)::DOUBLE', 6)} AS share FROM customer GROUP BY 1",
)
def g10(t: Tables):
    return rounded(agg.class_shares(t.customer, "c_mktsegment"), 6)


@plan(
    "g11_skewness",
    f"SELECT event_type, {rq('skewness(value)')} AS skew, {rq('skewness(ln(1 + value))')} AS skew_log FROM events GROUP BY 1",
)
def g11(t: Tables):
    return t.events.groupBy("event_type").agg(
        r(agg.sample_skewness(F.col("value"))).alias("skew"), r(agg.sample_skewness(F.log1p("value"))).alias("skew_log")
    )


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@plan(
    "g12_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rq(f'corr({a}, {b})', 6)} AS r FROM lineitem" for a in MEASURES for b in MEASURES
    ),
)
def g12(t: Tables):
    return rounded(agg.correlations(t.lineitem, MEASURES), 6)


@plan(
    "g13_column_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, {rq(f'avg({c})')} AS mean, "
        f"{rq(f'stddev_samp({c})')} AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max "
        "FROM documents LEFT JOIN labels USING (doc_id)"
        for c in ("n_chars", "quality", "toxic")
    ),
)
def g13(t: Tables):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return rounded(agg.column_summary(rows, ["n_chars", "quality", "toxic"]))


@plan(
    "g14_latest_as_parameter",
    "SELECT user_id, count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1",
)
def g14(t: Tables):
    start = ent.data_cutoff(t.events, "ts", days(7))
    return t.events.where(F.col("ts") > start).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "g15_ratio_of_aggregates",
    f"""
    SELECT l_suppkey, {rq("sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0)", 6)} AS returned_share,
           {rq('sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0)', 6)} AS discount_share FROM lineitem GROUP BY 1
    """,
)
def g15(t: Tables):
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)
    sums = t.lineitem.groupBy("l_suppkey").agg(
        F.sum(returned).alias("returned"), F.sum("l_quantity").alias("quantity"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("off"), F.sum("l_extendedprice").alias("price"),
    )
    return sums.select(
        "l_suppkey", r(safe_ratio("returned", "quantity", None), 6).alias("returned_share"),
        r(safe_ratio("off", "price", None), 6).alias("discount_share"),
    )


@plan(
    "g16_rates_by_axis",
    " UNION ALL ".join(
        f"SELECT '{axis}' AS axis, CAST({axis} AS VARCHAR) AS value, {rq('''avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END)''', 6)} AS rate "
        f"FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY {axis}"
        for axis in ("p_brand", "p_type", "l_linestatus")
    ),
)
def g16(t: Tables):
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    items = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    rows = spread_join(items, kinds, "l_partkey", ["l_orderkey", "l_linenumber"])
    # one pass: each row counts once under each axis
    axes = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in ("p_brand", "p_type", "l_linestatus")])
    returned = flag(F.col("l_returnflag") == "R").alias("returned")
    listed = rows.select(returned, F.explode(axes).alias("x")).select("returned", "x.*")
    return listed.groupBy("axis", "value").agg(r(F.avg("returned"), 6).alias("rate"))


CUT = "TIMESTAMP '2024-01-25'"


@plan(
    "g17_several_windows",
    "SELECT user_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE ts >= {CUT} - INTERVAL {n} DAY) AS n_{n}d, "
        + rq(f"coalesce(sum(value) FILTER (WHERE ts >= {CUT} - INTERVAL {n} DAY), 0)", 2)
        + f" AS spent_{n}d"
        for n in (3, 7, 14)
    )
    + f" FROM events WHERE ts < {CUT} AND ts >= {CUT} - INTERVAL 14 DAY GROUP BY 1",
)
def g17(t: Tables):
    cutoff = F.lit("2024-01-25")
    windows = {f"{n}d": Span(days(-n), days(0), "left") for n in (3, 7, 14)}
    measures = [agg.count("n"), agg.total("spent", "value")]
    past = t.events.where(Span(days(-14), days(0), "left").contains("ts", cutoff))
    wide = ent.windowed_summary(past, "user_id", "ts", cutoff, windows, measures)
    return wide.select(
        "user_id", *[f"n_{w}" for w in windows], *[r(F.coalesce(f"spent_{w}", F.lit(0.0)), 2).alias(f"spent_{w}") for w in windows]
    )


@plan(
    "g18_trend",
    f"""
    SELECT user_id, {rq(f"avg(value) FILTER (WHERE ts >= {CUT} - INTERVAL 7 DAY) - avg(value) FILTER (WHERE ts < {CUT} - INTERVAL 7 DAY)")} AS trend
    FROM events WHERE ts < {CUT} AND ts >= {CUT} - INTERVAL 14 DAY GROUP BY 1
    """,
)
def g18(t: Tables):
    cutoff = F.lit("2024-01-25")
    windows = {"now": Span(days(-7), days(0), "left"), "before": Span(days(-14), days(-7), "left")}
    past = t.events.where(Span(days(-14), days(0), "left").contains("ts", cutoff))
    wide = ent.windowed_summary(past, "user_id", "ts", cutoff, windows, [agg.mean("value", "value")])
    return wide.select("user_id", r(F.col("value_now") - F.col("value_before")).alias("trend"))


@plan(
    "g19_monthly_totals_and_top",
    f"""
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2)
    SELECT month, {rq('month_total', 2)} AS month_total, o_orderpriority AS top_priority FROM (
      SELECT *, sum(total) OVER (PARTITION BY month) AS month_total,
             row_number() OVER (PARTITION BY month ORDER BY total DESC, o_orderpriority) AS k FROM m) WHERE k = 1
    """,
)
def g19(t: Tables):
    dated = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    totals = agg.summarise(dated, "month", [agg.total("month_total", "o_totalprice")])
    top = agg.top_value(dated, "month", "o_orderpriority", "top_priority", F.col("o_totalprice"))
    return totals.join(top, "month").select("month", r("month_total", 2).alias("month_total"), "top_priority")


@plan(
    "g20_seasonality",
    f"""
    SELECT 'month' AS part, CAST(month(o_orderdate) AS VARCHAR) AS value, {rq('avg(o_totalprice)')} AS mean, count(*) AS n FROM orders GROUP BY 2
    UNION ALL SELECT 'weekday', dayname(o_orderdate), {rq('avg(o_totalprice)')}, count(*) FROM orders GROUP BY 2
    """,
)
def g20(t: Tables):
    parts = {"month": F.month("o_orderdate").cast("string"), "weekday": weekday_name("o_orderdate")}
    listed = t.orders.select(
        "o_totalprice", F.explode(F.array(*[F.struct(F.lit(k).alias("part"), c.alias("value")) for k, c in parts.items()])).alias("x")
    )
    return listed.select("x.*", "o_totalprice").groupBy("part", "value").agg(
        r(F.avg("o_totalprice")).alias("mean"), F.count(F.lit(1)).alias("n")
    )


@plan(
    "g21_above_peer_average",
    f"""
    WITH c AS (SELECT c_custkey, c_mktsegment, sum(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    a AS (SELECT c_mktsegment, avg(total) AS peer_average FROM c GROUP BY 1)
    SELECT c_custkey, c_mktsegment, {rq('total', 2)} AS total, {rq('peer_average', 2)} AS peer_average
    FROM c JOIN a USING (c_mktsegment) WHERE total > peer_average
    """,
)
def g21(t: Tables):
    spend = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("spend"))
    rows = t.customer.select("c_custkey", "c_mktsegment").join(spend, "c_custkey")
    return rounded(agg.above_peer_average(rows, "c_custkey", "c_mktsegment", "spend"), 2)


@plan(
    "g22_peer_averages",
    f"""
    WITH o AS (SELECT c_mktsegment, c_nationkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
               WHERE o_orderdate >= TIMESTAMP '2001-01-01')
    SELECT c_custkey, {rq('s.m', 3)} AS segment_mean, {rq('n.m', 3)} AS nation_mean, {rq('(SELECT avg(o_totalprice) FROM o)', 3)} AS overall_mean
    FROM customer c LEFT JOIN (SELECT c_mktsegment, avg(o_totalprice) AS m FROM o GROUP BY 1) s USING (c_mktsegment)
    LEFT JOIN (SELECT c_nationkey, avg(o_totalprice) AS m FROM o GROUP BY 1) n ON n.c_nationkey = c.c_nationkey
    """,
)
def g22(t: Tables):
    recent = t.orders.where(F.col("o_orderdate") >= instant(F.lit("2001-01-01")))
    recent = recent.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    peers = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    rows = spread_join(recent, peers, "c_custkey", "o_orderkey")
    df = agg.peer_averages(peers, "c_custkey", rows, ["c_mktsegment", "c_nationkey"], "o_totalprice", ["segment_mean", "nation_mean"], "overall_mean")
    return df.select("c_custkey", *[r(c, 3).alias(c) for c in ("segment_mean", "nation_mean", "overall_mean")])


@plan(
    "g23_segment_history_on_later_rows",
    f"""
    WITH h AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1)
    SELECT o_orderkey, n AS o_orderpriority_n, {rq('m')} AS o_orderpriority_m FROM orders JOIN h USING (o_orderpriority)
    WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    """,
)
def g23(t: Tables):
    cutoff = instant(F.lit("2000-01-01"))
    before, after = t.orders.where(F.col("o_orderdate") < cutoff), t.orders.where(F.col("o_orderdate") >= cutoff)
    df = ent.static_history(after, before, ["o_orderpriority"], [agg.count("n"), agg.mean("m", "o_totalprice")], "o_orderkey")
    return df.select("o_orderkey", "o_orderpriority_n", r("o_orderpriority_m").alias("o_orderpriority_m"))


NEIGHBOUR = "RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING"


@plan(
    "g24_neighbours_before",
    f"""
    WITH x AS (SELECT *, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey),
    y AS (SELECT o_orderkey,
      count(*) OVER g - count(*) OVER o AS n, coalesce(sum(o_totalprice) OVER g, 0) - coalesce(sum(o_totalprice) OVER o, 0) AS s
      FROM x WINDOW g AS (PARTITION BY c_nationkey ORDER BY o_orderdate {NEIGHBOUR}),
                    o AS (PARTITION BY c_nationkey, o_custkey ORDER BY o_orderdate {NEIGHBOUR}))
    SELECT o_orderkey, n AS nation_count, {rq('coalesce(s / nullif(n, 0), 0)', 3)} AS nation_mean FROM y
    """,
)
def g24(t: Tables):
    nations = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = spread_join(t.orders, nations, "o_custkey", "o_orderkey")
    df = agg.neighbours_before(rows, "c_nationkey", "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "nation")
    return df.select("o_orderkey", "nation_count", r("nation_mean", 3).alias("nation_mean"))


@plan(
    "g25_positive_mean",
    f"SELECT c_nationkey, {rq('coalesce(avg(CASE WHEN c_acctbal - 4000 > 0 THEN c_acctbal - 4000 END), 0)')} AS mean_over FROM customer GROUP BY 1",
)
def g25(t: Tables):
    df = agg.summarise(t.customer, "c_nationkey", [agg.positive_mean("mean_over", F.col("c_acctbal") - 4000)])
    return df.select("c_nationkey", r(F.coalesce("mean_over", F.lit(0.0))).alias("mean_over"))
