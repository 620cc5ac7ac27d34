"""Projection, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import values as v
from tidemark.plans.registry import Tables, plan, r, rq
from tidemark.spans import instant

# The ordinal score of each order priority.
PRIORITY_SCORE = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
PRIORITY_CASE = " ".join(f"WHEN '{k}' THEN {s}" for k, s in PRIORITY_SCORE.items())

# A measure that is really missing for many customers: the largest urgent order of 2001.
SPARSE_SQL = """
    sparse AS (
      SELECT c_custkey, c_acctbal, u.urgent FROM customer LEFT JOIN (
        SELECT o_custkey, max(o_totalprice) AS urgent FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1) u ON o_custkey = c_custkey)
"""


def sparse(t: Tables):
    recent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= instant(F.lit("2001-01-01")))
    urgent = t.orders.where(recent).groupBy("o_custkey").agg(F.max("o_totalprice").alias("urgent"))
    joined = t.customer.join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("c_custkey", "c_acctbal", "urgent")


@plan("p1_project", "SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def p1(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )


@plan("p2_star_plus_columns", f"SELECT *, {rq('s_acctbal * 2', 2)} AS doubled, s_nationkey + 1 AS next_nation FROM supplier")
def p2(t: Tables):
    return t.supplier.select("*", r(F.col("s_acctbal") * 2, 2).alias("doubled"), (F.col("s_nationkey") + 1).alias("next_nation"))


@plan(
    "p3_arithmetic",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate::DATE::VARCHAR AS shipped,
           {rq('l_extendedprice * (1 - l_discount)')} AS net, {rq('l_extendedprice / l_quantity')} AS unit_price,
           {rq('l_quantity - 25')} AS above_25 FROM lineitem
    """,
)
def p3(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        r(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        r(v.safe_ratio("l_extendedprice", "l_quantity")).alias("unit_price"),
        r(F.col("l_quantity") - 25).alias("above_25"),
    )


@plan(
    "p4_safe_ratio",
    f"""
    WITH c AS (
      SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS buys,
             count(*) FILTER (WHERE event_type = 'signup' AND value > 200) AS rare FROM events GROUP BY 1)
    SELECT user_id, {rq('coalesce(buys / nullif(rare, 0)::DOUBLE, -1)')} AS ratio, {rq('(buys + 1.0) / (rare + 1.0)')} AS smoothed
    FROM c
    """,
)
def p4(t: Tables):
    counts = t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("buys"),
        F.count_if((F.col("event_type") == "signup") & (F.col("value") > 200)).alias("rare"),
    )
    return counts.select(
        "user_id", r(v.safe_ratio("buys", "rare", -1.0)).alias("ratio"), r(v.smoothed_ratio("buys", "rare")).alias("smoothed")
    )


@plan(
    "p5_searched_case",
    """
    SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium'
           WHEN o_orderpriority = '1-URGENT' THEN 'small urgent' ELSE 'small' END AS size_class FROM orders
    """,
)
def p5(t: Tables):
    price = F.col("o_totalprice")
    size = F.when(price >= 400000, "large").when(price >= 100000, "medium")
    size = size.when(F.col("o_orderpriority") == "1-URGENT", "small urgent").otherwise("small")
    return t.orders.select("o_orderkey", size.alias("size_class"))


@plan("p6_value_lookup", f"SELECT o_orderkey, CASE o_orderpriority {PRIORITY_CASE} ELSE 0 END AS score FROM orders")
def p6(t: Tables):
    return t.orders.select("o_orderkey", v.lookup("o_orderpriority", PRIORITY_SCORE, 0).alias("score"))


@plan(
    "p7_choose_branches",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'problem' WHEN event_type = 'purchase' AND value > 100 THEN 'big buy'
           WHEN event_type = 'purchase' THEN 'buy' WHEN value < 1 THEN 'tiny' ELSE 'other' END AS kind,
           CASE WHEN value > 50 THEN 1 ELSE 0 END AS above_50 FROM events
    """,
)
def p7(t: Tables):
    kind, value = F.col("event_type"), F.col("value")
    branches = [
        (kind == "error", "problem"),
        ((kind == "purchase") & (value > 100), "big buy"),
        (kind == "purchase", "buy"),
        (value < 1, "tiny"),
    ]
    return t.events.select("event_id", v.choose(branches, "other").alias("kind"), v.flag(value > 50).alias("above_50"))


@plan("p8_coalesce", f"WITH {SPARSE_SQL} SELECT c_custkey, coalesce(urgent, 0.0) AS urgent FROM sparse")
def p8(t: Tables):
    return sparse(t).select("c_custkey", F.coalesce("urgent", F.lit(0.0)).alias("urgent"))


@plan(
    "p9_fill_missing",
    f"""
    WITH {SPARSE_SQL}, s AS (SELECT avg(urgent) AS m, quantile_cont(urgent, 0.5) AS md, max(urgent) AS mx FROM sparse)
    SELECT c_custkey, coalesce(urgent, -1.0) AS constant, coalesce(urgent, c_acctbal) AS other_column,
           {rq('coalesce(urgent, m)')} AS mean, {rq('coalesce(urgent, md)')} AS median,
           {rq('coalesce(urgent, 1.5 * mx)')} AS beyond_max FROM sparse, s
    """,
)
def p9(t: Tables):
    df = sparse(t)
    for name in ("mean", "median", "max"):
        df = v.fill_from_column(df.withColumn(name, F.col("urgent")), name, name, 1.5 if name == "max" else 1.0)
    return df.select(
        "c_custkey", F.coalesce("urgent", F.lit(-1.0)).alias("constant"), F.coalesce("urgent", "c_acctbal").alias("other_column"),
        r("mean").alias("mean"), r("median").alias("median"), r("max").alias("beyond_max"),
    )


@plan(
    "p10_replace_infinity",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
           CASE WHEN l_discount = 0 THEN 0.0 ELSE {rq('l_tax / l_discount')} END AS ratio FROM lineitem
    """,
)
def p10(t: Tables):
    endless = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.col("l_tax") / F.nullif(F.col("l_discount"), F.lit(0.0))
    )
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        r(v.without_infinity(endless, 0.0)).alias("ratio"),
    )


@plan("p11_drop_missing", f"WITH {SPARSE_SQL} SELECT c_custkey, urgent FROM sparse WHERE urgent IS NOT NULL")
def p11(t: Tables):
    return sparse(t).select("c_custkey", "urgent").dropna()


@plan(
    "p12_clamp",
    "SELECT c_custkey, greatest(0.0, c_acctbal) AS floored, least(5000.0, greatest(0.0, c_acctbal)) AS boxed FROM customer",
)
def p12(t: Tables):
    return t.customer.select(
        "c_custkey", v.clamp("c_acctbal", low=0.0).alias("floored"), v.clamp("c_acctbal", 0.0, 5000.0).alias("boxed")
    )


@plan(
    "p13_truncating_cast",
    "SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS whole, CAST(c_nationkey AS DOUBLE) AS nation FROM customer",
)
def p13(t: Tables):
    return t.customer.select(
        "c_custkey", F.col("c_acctbal").cast("bigint").alias("whole"), F.col("c_nationkey").cast("double").alias("nation")
    )


@plan("p14_constant_column", "SELECT c_custkey, '2000-01-01' AS cutoff, 30 AS horizon_days FROM customer")
def p14(t: Tables):
    return t.customer.select("c_custkey", F.lit("2000-01-01").alias("cutoff"), F.lit(30).alias("horizon_days"))


@plan(
    "p15_filters",
    f"""
    WITH {SPARSE_SQL}
    SELECT o_orderkey, o_custkey FROM orders JOIN sparse ON c_custkey = o_custkey
    WHERE (o_totalprice BETWEEN 50000 AND 200000 OR o_orderstatus IN ('F', 'O')) AND o_orderpriority <> '5-LOW'
      AND o_orderdate < TIMESTAMP '2000-01-01' AND urgent IS NULL
    """,
)
def p15(t: Tables):
    wanted = (F.col("o_totalprice").between(50000, 200000) | F.col("o_orderstatus").isin("F", "O")) & (
        F.col("o_orderpriority") != "5-LOW"
    )
    kept = t.orders.where(wanted & (F.col("o_orderdate") < instant(F.lit("2000-01-01"))))
    unknown = sparse(t).where(F.col("urgent").isNull())
    return kept.join(unknown, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "o_custkey")


@plan(
    "p16_derived_table",
    f"""
    SELECT c_mktsegment, count(*) AS customers, {rq('avg(n)')} AS mean_orders FROM customer
    JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON o_custkey = c_custkey
    GROUP BY 1
    """,
)
def p16(t: Tables):
    finished = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    joined = t.customer.join(finished, F.col("c_custkey") == F.col("o_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), r(F.avg("n")).alias("mean_orders"))


CHAIN = """
    WITH monthly AS (
      SELECT user_id, date_trunc('day', ts) AS day, count(*) AS n, sum(value) AS v FROM {events} GROUP BY 1, 2),
    per_user AS (SELECT user_id, count(*) AS days, max(n) AS busiest, sum(v) AS v FROM monthly GROUP BY 1),
    buyers AS (SELECT user_id, count(*) AS buys FROM {events} WHERE event_type = 'purchase' GROUP BY 1),
    joined AS (SELECT p.user_id, days, busiest, v, coalesce(buys, 0) AS buys
               FROM per_user p LEFT JOIN buyers b ON p.user_id = b.user_id)
    SELECT user_id, days, busiest, {v} AS v, buys FROM joined WHERE busiest >= 3
"""


@plan("p17_cte_chain", CHAIN.format(v=rq("v", 2), events="events"))
def p17(t: Tables):
    t.events.createOrReplaceTempView("tidemark_events")
    return t.spark.sql(CHAIN.format(v="round(v + 1e-9, 2)", events="tidemark_events"))


@plan("p18_columns_by_type", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def p18(t: Tables):
    return t.customer.select(*v.numeric_columns(t.customer))


@plan("p19_drop_rename", "SELECT p_partkey AS part_id, p_brand, p_type, p_size, p_retailprice AS price FROM part")
def p19(t: Tables):
    return t.part.drop("p_name").withColumnsRenamed({"p_partkey": "part_id", "p_retailprice": "price"})


@plan(
    "p20_threshold_flag",
    """
    SELECT o_orderkey, CAST(o_totalprice > 300000 AS INTEGER) AS is_large,
           CAST(o_totalprice > 300000 AND o_orderpriority = '1-URGENT' AS INTEGER) AS is_large_urgent FROM orders
    """,
)
def p20(t: Tables):
    large = F.col("o_totalprice") > 300000
    return t.orders.select(
        "o_orderkey", v.flag(large).alias("is_large"),
        v.flag(large & (F.col("o_orderpriority") == "1-URGENT")).alias("is_large_urgent"),
    )


@plan(
    "p21_target_band",
    """
    SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN CAST(p_size BETWEEN 1 AND 10 AS INTEGER)
      WHEN 'SMALL' THEN CAST(p_size BETWEEN 5 AND 20 AS INTEGER) ELSE CAST(p_size BETWEEN 15 AND 50 AS INTEGER) END AS in_band
    FROM part
    """,
)
def p21(t: Tables):
    band = v.lookup("p_type", {"ECONOMY": "1-10", "SMALL": "5-20"}, "15-50")
    return t.part.select("p_partkey", v.in_band("p_size", band).alias("in_band"))
