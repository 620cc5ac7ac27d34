"""Dates, numbers, text and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import bins, text
from tidemark.functions import dates as d
from tidemark.functions import values as v
from tidemark.operators import entity_features as ent
from tidemark.operators.aggregates import exact_quantiles, group_totals, largest, smallest
from tidemark.plans.registry import Tables, plan, r, rounded, rq
from tidemark.skew import spread_join
from tidemark.spans import days, hours, instant, months, weeks

REF = "TIMESTAMP '2024-01-15 12:00:00'"


def ref():
    return instant(F.lit("2024-01-15 12:00:00"))


@plan("d1_fractional_days", f"SELECT event_id, {rq(f'(epoch_us({REF}) - epoch_us(ts)) / 86400e6', 6)} AS days FROM events")
def d1(t: Tables):
    return t.events.select("event_id", r(d.elapsed_days(ref(), "ts"), 6).alias("days"))


@plan(
    "d1b_whole_days",
    f"""
    SELECT event_id, CAST(trunc((epoch_us({REF}) - epoch_us(ts)) / 86400e6) AS BIGINT) AS truncated,
           CAST(floor((epoch_us({REF}) - epoch_us(ts)) / 86400e6) AS BIGINT) AS floored FROM events
    """,
)
def d1b(t: Tables):
    return t.events.select(
        "event_id", d.days_truncated(ref(), "ts").alias("truncated"), d.days_floored(ref(), "ts").alias("floored")
    )


@plan("d1c_seconds", f"SELECT event_id, {rq(f'(epoch_us({REF}) - epoch_us(ts)) / 1e6', 3)} AS seconds FROM events")
def d1c(t: Tables):
    return t.events.select("event_id", r(d.elapsed_seconds(ref(), "ts"), 3).alias("seconds"))


# Next to a 30-day shift DuckDB 2.0 takes "1 MONTH" for the same expression, hence 3 months here.
@plan(
    "d2_shift",
    """
    SELECT event_id, strftime(ts + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS plus_30d, strftime(ts + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS plus_6h,
           strftime(ts - INTERVAL 2 WEEK, '%Y-%m-%d %H:%M:%S') AS minus_2w, strftime(ts + INTERVAL 3 MONTH, '%Y-%m-%d %H:%M:%S') AS plus_3m,
           strftime(ts - INTERVAL 11 MONTH, '%Y-%m-%d %H:%M:%S') AS minus_11m FROM events
    """,
)
def d2(t: Tables):
    shifts = {"plus_30d": days(30), "plus_6h": hours(6), "minus_2w": weeks(-2), "plus_3m": months(3), "minus_11m": months(-11)}
    return t.events.select("event_id", *[F.date_format(s.after("ts"), "yyyy-MM-dd HH:mm:ss").alias(n) for n, s in shifts.items()])


@plan("d3_truncate_to_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def d3(t: Tables):
    return t.events.select("event_id", F.to_date("ts").cast("string").alias("day"))


@plan(
    "d4_date_parts",
    "SELECT event_id, hour(ts) AS hour, month(ts) AS month, day(ts) AS day, year(ts) AS year FROM events",
)
def d4(t: Tables):
    return t.events.select(
        "event_id", F.hour("ts").alias("hour"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.year("ts").alias("year")
    )


@plan(
    "d5_weekday_numbers",
    "SELECT o_orderkey, dayofweek(o_orderdate) AS sunday0, (dayofweek(o_orderdate) + 6) % 7 AS monday0, isodow(o_orderdate) AS monday1 FROM orders",
)
def d5(t: Tables):
    at = "o_orderdate"
    return t.orders.select(
        "o_orderkey", d.weekday_sunday0(at).alias("sunday0"), d.weekday_monday0(at).alias("monday0"), d.weekday_monday1(at).alias("monday1")
    )


@plan(
    "d6_weekday_name_weekend",
    "SELECT o_orderkey, dayname(o_orderdate) AS weekday, CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS weekend FROM orders",
)
def d6(t: Tables):
    return t.orders.select("o_orderkey", d.weekday_name("o_orderdate").alias("weekday"), d.is_weekend("o_orderdate").alias("weekend"))


@plan("d7_day_of_year", "SELECT o_orderkey, dayofyear(o_orderdate) AS day FROM orders")
def d7(t: Tables):
    return t.orders.select("o_orderkey", F.dayofyear("o_orderdate").alias("day"))


@plan("d8_month_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day FROM orders")
def d8(t: Tables):
    return t.orders.select("o_orderkey", d.month_key("o_orderdate").alias("month"), d.month_start("o_orderdate").cast("string").alias("first_day"))


@plan(
    "d9_part_of_day",
    """
    SELECT event_id, CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'afternoon'
           WHEN hour(ts) BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END AS part FROM events
    """,
)
def d9(t: Tables):
    return t.events.select("event_id", d.part_of_day("ts").alias("part"))


@plan(
    "d10_date_from_year",
    f"""
    SELECT o_orderkey, CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS year_start,
           {rq('(epoch_us(o_orderdate) - epoch_us(CAST(make_date(year(o_orderdate), 1, 1) AS TIMESTAMP))) / 86400e6')} AS days_in FROM orders
    """,
)
def d10(t: Tables):
    start = d.year_start(F.year("o_orderdate"))
    return t.orders.select("o_orderkey", start.cast("string").alias("year_start"), r(d.elapsed_days("o_orderdate", start)).alias("days_in"))


@plan("d11_cyclical", f"SELECT event_id, {rq('sin(2 * pi() * hour(ts) / 24)', 6)} AS sin_hour, {rq('cos(2 * pi() * hour(ts) / 24)', 6)} AS cos_hour FROM events")
def d11(t: Tables):
    sin, cos = d.cyclical(F.hour("ts"), 24)
    return t.events.select("event_id", r(sin, 6).alias("sin_hour"), r(cos, 6).alias("cos_hour"))


@plan(
    "d12_tenure",
    """
    SELECT user_id, greatest(0, CAST(floor((epoch_us(TIMESTAMP '2024-01-02') - epoch_us(min(ts))) / 86400e6) AS BIGINT)) AS tenure,
           greatest(1, CAST(floor((epoch_us(TIMESTAMP '2024-01-02') - epoch_us(min(ts))) / 86400e6) AS BIGINT)) AS at_least_1
    FROM events GROUP BY 1
    """,
)
def d12(t: Tables):
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("first_at"))
    age = d.days_floored(F.lit("2024-01-02").cast("timestamp_ntz"), "first_at")
    return first.select("user_id", d.at_least(age, 0).alias("tenure"), d.at_least(age, 1).alias("at_least_1"))


@plan(
    "d13_lead_time",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400e6 AS BIGINT) AS lead_days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def d13(t: Tables):
    item = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    ordered = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = spread_join(t.lineitem, ordered, "l_orderkey", item)
    return rows.select(*item, "l_extendedprice", d.days_truncated("l_shipdate", "o_orderdate").alias("lead_days"))


@plan(
    "d14_campaign_position",
    """
    SELECT event_id, CAST(floor((epoch_us(ts) - epoch_us(first_at)) / 86400e6) AS BIGINT) AS days_in,
           CAST(floor((epoch_us(last_at) - epoch_us(first_at)) / 86400e6) AS BIGINT) AS total_days
    FROM events JOIN (SELECT user_id, min(ts) AS first_at, max(ts) AS last_at FROM events GROUP BY 1) USING (user_id)
    """,
)
def d14(t: Tables):
    rows = group_totals(t.events, "user_id", [smallest("first_at", "ts"), largest("last_at", "ts")], "event_id")
    position, length = d.campaign_position("ts", "first_at", "last_at")
    return rows.select("event_id", position.alias("days_in"), length.alias("total_days"))


@plan(
    "d15_derived_cutoff",
    f"""
    SELECT strftime(max(ts) - INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS minus_days, strftime(max(ts) - INTERVAL 2 WEEK, '%Y-%m-%d %H:%M:%S') AS minus_weeks,
           strftime(max(ts) - INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS minus_months, {rq('quantile_cont(epoch_us(ts), 0.8) / 1e6', 2)} AS time_quantile FROM events
    """,
)
def d15(t: Tables):
    back = {"minus_days": days(7), "minus_weeks": weeks(2), "minus_months": months(1)}
    point = exact_quantiles(t.events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))), "at", [0.8])
    shifted = [F.date_format(ent.data_cutoff(t.events, "ts", b), "yyyy-MM-dd HH:mm:ss").alias(n) for n, b in back.items()]
    return point.select(*shifted, r(F.col("q0") / 1e6, 2).alias("time_quantile"))


@plan(
    "n1_log1p_if_skewed",
    f"""
    WITH s AS (SELECT skewness(value) AS a, skewness(event_id) AS b FROM events)
    SELECT event_id, {rq('CASE WHEN a > 0.75 THEN ln(1 + value) ELSE value END')} AS value_scaled,
           {rq('CASE WHEN b > 0.75 THEN ln(1 + event_id) ELSE event_id END')} AS event_id_scaled FROM events, s
    """,
)
def n1(t: Tables):
    rows = v.log1p_if_skewed(t.events.select("event_id", "value"), ["value", "event_id"])
    return rounded(rows.drop("value"))


@plan("n2_round", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(l_quantity * 1.25 + 0.001, 1) + 0.0 AS up FROM lineitem")
def n2(t: Tables):
    up = F.round(F.col("l_quantity") * 1.25 + 0.001, 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", up.alias("up"))


@plan("n3_absolute", "SELECT c_custkey, abs(c_acctbal) AS size FROM customer")
def n3(t: Tables):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("size"))


@plan("n4_products", f"SELECT p_partkey, p_size * p_size AS size_squared, {rq('p_size * p_retailprice')} AS size_price FROM part")
def n4(t: Tables):
    size = F.col("p_size")
    return t.part.select("p_partkey", (size * size).alias("size_squared"), r(size * F.col("p_retailprice")).alias("size_price"))


@plan(
    "n5_weighted_score",
    f"""
    SELECT user_id, {rq("0.5 * count(*) FILTER (WHERE event_type = 'purchase') + 0.3 * count(*) FILTER (WHERE event_type = 'click') + 0.2 * count(*) FILTER (WHERE event_type = 'view')")} AS score
    FROM events GROUP BY 1
    """,
)
def n5(t: Tables):
    counts = t.events.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(k) for k in ("purchase", "click", "view")])
    return counts.select("user_id", r(v.weighted_score({"purchase": 0.5, "click": 0.3, "view": 0.2})).alias("score"))


@plan(
    "n6_frequency",
    f"""
    SELECT user_id, {rq('count(*) / 30.0')} AS per_day, {rq('count(*) / greatest(1, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400e6))')} AS per_active_day
    FROM events GROUP BY 1
    """,
)
def n6(t: Tables):
    spans = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    active = d.at_least(d.days_floored("b", "a"), 1)
    return spans.select("user_id", r(F.col("n") / 30.0).alias("per_day"), r(F.col("n") / active).alias("per_active_day"))


# Fixed word list for the text features.
WORDS = ["the", "and", "error", "les", "der"]


def documents(t: Tables):
    return t.documents


@plan("x1_text_length", "SELECT doc_id, length(text) AS chars FROM documents")
def x1(t: Tables):
    return t.documents.select("doc_id", text.text_length("text").alias("chars"))


@plan("x2_contains_character", "SELECT doc_id, CAST(contains(text, '!') OR contains(text, '?') AS INTEGER) AS has_mark FROM documents")
def x2(t: Tables):
    return t.documents.select("doc_id", text.contains_any_of("text", ["!", "?"]).alias("has_mark"))


@plan(
    "x3_keywords_present",
    "SELECT doc_id, " + " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in WORDS) + " AS n_words FROM documents",
)
def x3(t: Tables):
    return documents(t).select("doc_id", text.keywords_present("text", WORDS).alias("n_words"))


# DuckDB's word boundary knows only ASCII letters, so whole words are counted by splitting.
MATCHES = (
    r"len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w IN ("
    + ", ".join(f"'{w}'" for w in WORDS)
    + ")))"
)


@plan("x4_any_word", f"SELECT conv_id, turn, CAST({MATCHES} > 0 AS INTEGER) AS any_word FROM conversations")
def x4(t: Tables):
    return t.conversations.select("conv_id", "turn", text.mentions("text", WORDS).alias("any_word"))


@plan("x5_count_matches", f"SELECT doc_id, {MATCHES} AS n_matches FROM documents")
def x5(t: Tables):
    return documents(t).select("doc_id", text.count_matches("text", WORDS).alias("n_matches"))


@plan("x6_distinct_list_items", "SELECT p_partkey, len(list_distinct(list_filter(string_split(p_name || ' ' || p_type, ' '), lambda x: x <> ''))) AS n FROM part")
def x6(t: Tables):
    return t.part.select("p_partkey", text.distinct_items(F.concat_ws(" ", "p_name", "p_type"), " ").alias("n"))


@plan("x7_concatenate", "SELECT p_partkey, p_brand || '-' || p_type || '-' || CAST(p_size AS VARCHAR) AS code FROM part")
def x7(t: Tables):
    return t.part.select("p_partkey", F.concat("p_brand", F.lit("-"), "p_type", F.lit("-"), F.col("p_size").cast("string")).alias("code"))


@plan(
    "b1_equal_width",
    """
    WITH s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders)
    SELECT o_orderkey, CASE WHEN o_totalprice <= a + (b - a) * 0.25 THEN 'low' WHEN o_totalprice <= a + (b - a) * 0.5 THEN 'mid'
           WHEN o_totalprice <= a + (b - a) * 0.75 THEN 'high' ELSE 'top' END AS band FROM orders, s
    """,
)
def b1(t: Tables):
    return bins.equal_width(t.orders, "o_totalprice", ["low", "mid", "high", "top"], "band").select("o_orderkey", "band")


@plan(
    "b2_right_closed_bins",
    """
    SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'S' WHEN p_size > 10 AND p_size <= 25 THEN 'M'
           WHEN p_size > 25 AND p_size <= 45 THEN 'L' END AS size_class FROM part
    """,
)
def b2(t: Tables):
    return t.part.select("p_partkey", bins.cut("p_size", [0, 10, 25, 45], ["S", "M", "L"]).alias("size_class"))


@plan(
    "b3_left_closed_bins",
    """
    SELECT p_partkey, CASE WHEN p_size >= 1 AND p_size < 10 THEN 'S' WHEN p_size >= 10 AND p_size < 25 THEN 'M'
           WHEN p_size >= 25 THEN 'L' END AS size_class FROM part
    """,
)
def b3(t: Tables):
    edges = [1, 10, 25, float("inf")]
    return t.part.select("p_partkey", bins.cut("p_size", edges, ["S", "M", "L"], closed="left").alias("size_class"))


def _tier_sql(shares: list[str], labels: list[str]) -> str:
    cuts = ", ".join(f"quantile_cont(spent, {s}) AS c{i}" for i, s in enumerate(shares))
    steps = " ".join(f"WHEN spent <= c{i} THEN '{labels[i + 1]}'" for i in range(len(shares)))
    return f"""
    WITH u AS (SELECT o_custkey AS custkey, sum(CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN o_totalprice ELSE 0 END) AS spent FROM orders GROUP BY 1),
    q AS (SELECT {cuts} FROM u WHERE spent > 0)
    SELECT custkey, CASE WHEN spent <= 0 THEN '{labels[0]}' {steps} ELSE '{labels[-1]}' END AS tier FROM u, q
    """


def late_spend(t: Tables):
    late = F.when(F.col("o_orderdate") >= instant(F.lit("2001-01-01")), F.col("o_totalprice")).otherwise(0.0)
    return t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.sum(late).alias("spent"))


TERCILES = ["none", "low", "medium", "high"]
QUARTILES = ["none", "q1", "q2", "q3", "q4"]


@plan("b4_zero_and_terciles", _tier_sql(["1/3.0::DOUBLE", "2/3.0::DOUBLE"], TERCILES))
def b4(t: Tables):
    return bins.zero_and_quantile_tiers(late_spend(t), "spent", TERCILES, "tier").select("custkey", "tier")


@plan("b5_zero_and_quartiles", _tier_sql(["0.25", "0.5", "0.75"], QUARTILES))
def b5(t: Tables):
    return bins.zero_and_quantile_tiers(late_spend(t), "spent", QUARTILES, "tier").select("custkey", "tier")


@plan(
    "b6_above_quantile",
    """
    WITH q AS (SELECT quantile_cont(c_acctbal, 0.2) AS a, quantile_cont(c_acctbal, 0.75) AS b, quantile_cont(c_acctbal, 0.9) AS c FROM customer)
    SELECT c_custkey, CAST(c_acctbal > a AS INTEGER) AS above_20, CAST(c_acctbal > b AS INTEGER) AS above_75,
           CAST(c_acctbal > c AS INTEGER) AS above_90 FROM customer, q
    """,
)
def b6(t: Tables):
    shares = {"above_20": 0.2, "above_75": 0.75, "above_90": 0.9}
    return bins.above_quantile(t.customer, "c_acctbal", shares).select("c_custkey", "above_20", "above_75", "above_90")


@plan(
    "b7_named_category",
    """
    WITH x AS (SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END) AS rate FROM lineitem GROUP BY 1)
    SELECT l_suppkey, CASE WHEN rate >= 0.36 THEN 'many returns' WHEN rate >= 0.32 THEN 'usual' ELSE 'few returns' END AS grade FROM x
    """,
)
def b7(t: Tables):
    rates = t.lineitem.groupBy("l_suppkey").agg(F.avg(v.flag(F.col("l_returnflag") == "R")).alias("rate"))
    grade = v.choose([(F.col("rate") >= 0.36, "many returns"), (F.col("rate") >= 0.32, "usual")], "few returns")
    return rates.select("l_suppkey", grade.alias("grade"))
