"""Joins, sorting, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.operators import history
from tidemark.plans.projection_plans import PRIORITY_SCORE
from tidemark.plans.registry import Tables, plan, r, rq
from tidemark.skew import spread_join
from tidemark.spans import Span, day_window, days, instant


def first_seen(t: Tables):
    """Users with the time of their first event."""
    return t.events.groupBy("user_id").agg(F.min("ts").alias("anchor"))


FIRST_SEEN = "first_seen AS (SELECT user_id, min(ts) AS anchor FROM events GROUP BY 1)"


@plan(
    "j1_inner_join",
    f"""
    SELECT c_custkey, c_name, count(*) AS n, {rq('sum(o_totalprice)', 2)} AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    """,
)
def j1(t: Tables):
    # one name per key, so the orders are summed before the join
    revenue = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("revenue"))
    joined = t.customer.join(revenue, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_custkey", "c_name", "n", r("revenue", 2).alias("revenue"))


@plan(
    "j2_left_join",
    """
    SELECT n_nationkey, n_name, s_suppkey, s_name FROM nation
    LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000
    """,
)
def j2(t: Tables):
    rich = t.supplier.where("s_acctbal > 5000")
    joined = t.nation.join(rich, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return joined.select("n_nationkey", "n_name", "s_suppkey", "s_name")


@plan(
    "j3_star_join",
    f"""
    SELECT r_name, p_type, o_orderpriority, count(*) AS n, {rq('sum(l_extendedprice * (1 - l_discount))')} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3
    """,
)
def j3(t: Tables):
    region = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = t.customer.join(region, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    bought = spread_join(orders, buyers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "o_orderkey")
    bought = bought.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "r_name")
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    item = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    items = t.lineitem.select(*item, "l_extendedprice", "l_discount")
    joined = spread_join(spread_join(items, kinds, "l_partkey", item), bought, "l_orderkey", item, hot_from=items)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return joined.groupBy("r_name", "p_type", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum(net)).alias("revenue")
    )


@plan(
    "j4_composite_key_join",
    f"""
    WITH q AS (SELECT l_partkey, l_suppkey, avg(l_quantity) AS usual FROM lineitem GROUP BY 1, 2)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, {rq('l.l_quantity - q.usual')} AS above_usual
    FROM lineitem l JOIN q ON l.l_partkey = q.l_partkey AND l.l_suppkey = q.l_suppkey
    """,
)
def j4(t: Tables):
    usual = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("usual"))
    joined = spread_join(t.lineitem, usual, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        r(F.col("l_quantity") - F.col("usual")).alias("above_usual"),
    )


EDGE_RULES = {
    "closed": (Span(days(1), days(8), "both"), "ts >= anchor + INTERVAL 1 DAY AND ts <= anchor + INTERVAL 8 DAY"),
    "half_open": (Span(days(0), days(7), "left"), "ts >= anchor AND ts < anchor + INTERVAL 7 DAY"),
    "open_start": (Span(days(0), days(7), "right"), "ts > anchor AND ts <= anchor + INTERVAL 7 DAY"),
    "open": (Span(days(0), days(3), "neither"), "ts > anchor AND ts < anchor + INTERVAL 3 DAY"),
    "fraction_of_day": (Span(days(0), days(1.5), "both"), "ts >= anchor AND ts <= anchor + INTERVAL 36 HOUR"),
    "whole_last_day": (
        Span(days(0), days(6), "both", whole_last_day=True),
        "ts >= anchor AND ts < date_trunc('day', anchor) + INTERVAL 7 DAY",
    ),
    "n_days_inclusive": (day_window(0, 30), "ts >= anchor AND ts < date_trunc('day', anchor) + INTERVAL 31 DAY"),
}


def _edge_plan(name: str, span: Span, condition: str) -> None:
    sql = f"""
    WITH {FIRST_SEEN}
    SELECT user_id, count(e.event_id) AS n, {rq('coalesce(sum(value), 0)', 2)} AS total,
           count(DISTINCT event_type) AS kinds
    FROM first_seen f LEFT JOIN events e USING (user_id) WHERE {condition} GROUP BY 1
    """

    @plan(f"j5_window_join_{name}", sql)
    def build(t: Tables):
        pairs = ent.window_join(first_seen(t), t.events, "user_id", "ts", "event_id", "anchor", span)
        return pairs.groupBy("user_id").agg(
            F.count("event_id").alias("n"), r(F.sum("value"), 2).alias("total"), F.count_distinct("event_type").alias("kinds")
        )


for _name, (_span, _condition) in EDGE_RULES.items():
    _edge_plan(_name, _span, _condition)


@plan(
    "j6_history_range",
    f"""
    SELECT o_orderkey, count(*) OVER w AS n_30d, {rq('coalesce(avg(o_totalprice) OVER w, 0)')} AS mean_30d FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate
                 RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
    """,
)
def j6(t: Tables):
    price = F.col("o_totalprice")
    wanted = [history.Trailing("n", "count", price), history.Trailing("mean", "mean", price)]
    rows = history.trailing_features(t.orders, "o_custkey", "o_orderdate", "o_orderkey", {"30d": days(30)}, wanted)
    return rows.select("o_orderkey", "n_30d", r(F.coalesce("mean_30d", F.lit(0.0))).alias("mean_30d"))


@plan(
    "j7_exclusion_join",
    f"""
    WITH own AS (SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n, coalesce(sum(o_totalprice), 0) AS s
                 FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
    seg AS (SELECT c_mktsegment, sum(n) AS n, sum(s) AS s FROM own GROUP BY 1)
    SELECT c_custkey, CAST(seg.n - own.n AS BIGINT) AS others_n, {rq('(seg.s - own.s) / (seg.n - own.n)', 2)} AS others_mean
    FROM own JOIN seg USING (c_mktsegment)
    """,
)
def j7(t: Tables):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    own = agg.attach_summary(t.customer, orders, "c_custkey", [agg.count("n"), agg.total("s", "o_totalprice")])
    whole = own.groupBy("c_mktsegment").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    joined = spread_join(own, whole, "c_mktsegment", "c_custkey")
    others = F.col("all_n") - F.col("n")
    mean = (F.col("all_s") - F.col("s")) / F.nullif(others, F.lit(0))
    return joined.select("c_custkey", others.alias("others_n"), r(mean, 2).alias("others_mean"))


@plan(
    "j8_category_grid",
    f"""
    WITH k AS (SELECT DISTINCT event_type FROM events), u AS (SELECT DISTINCT user_id FROM events)
    SELECT u.user_id, k.event_type, count(e.event_id) AS n, {rq('coalesce(sum(value), 0)', 2)} AS total
    FROM u CROSS JOIN k LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = k.event_type GROUP BY 1, 2
    """,
)
def j8(t: Tables):
    grid = ent.category_grid(t.events.select("user_id").distinct(), t.events, "event_type")
    filled = agg.attach_summary(grid, t.events, ["user_id", "event_type"], [agg.count("n"), agg.total("total", "value")])
    return filled.select("user_id", "event_type", "n", r("total", 2).alias("total"))


@plan(
    "j8_attach_total",
    f"""
    SELECT o_orderstatus, {rq('sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders)', 6)} AS share FROM orders GROUP BY 1
    """,
)
def j8_total(t: Tables):
    whole = t.orders.agg(F.sum("o_totalprice")).scalar()
    totals = t.orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("total"))
    return totals.select("o_orderstatus", r(F.col("total") / whole, 6).alias("share"))


@plan(
    "j9_membership_flag",
    """
    SELECT c_custkey, CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) AS INTEGER) AS has_big
    FROM customer
    """,
)
def j9(t: Tables):
    big = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    flagged = t.customer.join(big.withColumn("hit", F.lit(1)), "c_custkey", "left")
    return flagged.select("c_custkey", F.coalesce("hit", F.lit(0)).alias("has_big"))


@plan(
    "j10_anti_membership",
    """
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN
      (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_custkey IS NOT NULL)
    """,
)
def j10(t: Tables):
    active = t.orders.where(F.col("o_orderdate") >= instant(F.lit("2001-01-01"))).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(active, "c_custkey", "left_anti").select("c_custkey")


@plan(
    "j11_as_of_cutoff",
    """
    SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders
    WHERE o_orderdate <= TIMESTAMP '1999-06-30' GROUP BY 1
    """,
)
def j11(t: Tables):
    past = t.orders.where(F.col("o_orderdate") <= instant(F.lit("1999-06-30")))
    return ent.newest_rows(past, "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey")


@plan(
    "j11_as_of_per_row",
    f"""
    SELECT p.event_id, {rq('s.value')} AS signup_value, {rq('(epoch_us(p.ts) - epoch_us(s.ts)) / 1e6', 3)} AS seconds_since
    FROM events p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
      ON p.user_id = s.user_id AND p.ts >= s.ts
    WHERE p.event_type = 'purchase'
    """,
)
def j11_rows(t: Tables):
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    signups = t.events.where("event_type = 'signup'").select(
        "user_id", F.col("ts").alias("signup_at"), F.col("value").alias("signup_value")
    )
    known = history.latest_known(purchases, signups, "user_id", "ts", "event_id", "signup_at", ["signup_value"])
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("signup_at").cast("timestamp"))) / 1e6
    return known.select("event_id", r("signup_value").alias("signup_value"), r(seconds, 3).alias("seconds_since"))


@plan(
    "j12_lookup_join",
    f"""
    WITH s(o_orderpriority, score) AS (VALUES {', '.join(f"('{k}', {s})" for k, s in PRIORITY_SCORE.items())})
    SELECT o_custkey, {rq('avg(score)')} AS mean_score, max(score) AS top_score FROM orders JOIN s USING (o_orderpriority) GROUP BY 1
    """,
)
def j12(t: Tables):
    scores = t.spark.createDataFrame(list(PRIORITY_SCORE.items()), "o_orderpriority string, score int")
    # five constant rows
    joined = t.orders.join(F.broadcast(scores), "o_orderpriority")
    return joined.groupBy("o_custkey").agg(r(F.avg("score")).alias("mean_score"), F.max("score").alias("top_score"))


@plan(
    "j13_aggregate_then_join",
    f"""
    WITH o AS (SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS spend FROM orders GROUP BY 1),
    i AS (SELECT o_custkey, count(*) AS items, sum(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT c_custkey, coalesce(orders, 0) AS orders, {rq('coalesce(spend, 0)', 2)} AS spend,
           coalesce(items, 0) AS items, {rq('coalesce(quantity, 0)', 2)} AS quantity
    FROM customer LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN i ON i.o_custkey = c_custkey
    """,
)
def j13(t: Tables):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity"))
    owner = orders.select("c_custkey", F.col("o_orderkey").alias("l_orderkey"))
    items = per_order.join(owner, "l_orderkey")
    joined = agg.attach_summary(t.customer, orders, "c_custkey", [agg.count("orders"), agg.total("spend", "o_totalprice")])
    joined = agg.attach_summary(joined, items, "c_custkey", [agg.total("items", "items", 0), agg.total("quantity", "quantity")])
    return joined.select("c_custkey", "orders", r("spend", 2).alias("spend"), "items", r("quantity", 2).alias("quantity"))


@plan(
    "o1_multi_key_sort",
    """
    SELECT n_regionkey, n_name, n_nationkey, row_number() OVER (ORDER BY n_regionkey, n_name DESC) AS place FROM nation
    """,
)
def o1(t: Tables):
    # 25 fixed rows; the place column shows the order
    order = [F.asc("n_regionkey"), F.desc("n_name")]
    return (
        t.nation.select("n_regionkey", "n_name", "n_nationkey", F.row_number().over(Window.orderBy(*order)).alias("place"))
        .orderBy(*order)
    )


@plan("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def o2(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@plan(
    "o3_top_k_per_group",
    """
    SELECT o_orderpriority, o_orderkey, CAST(place AS INTEGER) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders)
    WHERE place <= 5
    """,
)
def o3(t: Tables):
    place = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return t.orders.withColumn("place", place).where("place <= 5").select("o_orderpriority", "o_orderkey", "place")


@plan(
    "o4_sort_keep_first",
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS k FROM events) WHERE k = 1
    """,
)
def o4(t: Tables):
    return ent.newest_rows(t.events, "user_id", "value", "event_id").select("user_id", "event_id", "event_type")


@plan(
    "u1_append_frames",
    """
    SELECT 'customer' AS source, c_custkey AS id, c_nationkey AS nation FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier
    """,
)
def u1(t: Tables):
    a = t.customer.select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b)


@plan("u2_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def u2(t: Tables):
    a, b = t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    return a.unionByName(b).distinct()


@plan("u3_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def u3(t: Tables):
    return t.part.select("p_brand", "p_type").distinct()


@plan(
    "u4_drop_duplicates",
    """
    SELECT user_id, event_type, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1
    """,
)
def u4(t: Tables):
    first = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))
    return t.events.withColumn("k", first).where("k = 1").select("user_id", "event_type", "event_id")


@plan(
    "u5_intersect_keys",
    """
    SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100
    INTERSECT SELECT user_id FROM events WHERE event_type = 'error' AND value > 100
    """,
)
def u5(t: Tables):
    large = t.events.where("value > 100")
    buyers = large.where("event_type = 'purchase'").select("user_id")
    return buyers.intersect(large.where("event_type = 'error'").select("user_id"))

