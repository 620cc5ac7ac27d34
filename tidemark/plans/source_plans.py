"""Sources and sinks."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tidemark.models import prepare, train
from tidemark.plans.registry import Tables, plan, r, rq
from tidemark.session import checkpoint_folder
from tidemark.sources import tables as src
from tidemark.spans import instant


def fresh_path(t: Tables, name: str) -> str:
    return os.path.join(checkpoint_folder(t.spark), f"{name}-{uuid.uuid4().hex}")


VIEWS = "tidemark_"  # names of the plans' own views


def counts(prefix: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {prefix}{n}" for n in src.SCHEMAS)


@plan("s1_register_tables", counts())
def s1(t: Tables):
    src.register_folder(t.spark, t.folder, prefix=VIEWS)
    return src.query(t.spark, counts(VIEWS))


@plan(
    "s2_schema_checks",
    """
    SELECT 'unique o_orderkey' AS rule, count(*) AS offenders
    FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'reference o_custkey', count(*) FROM orders
      WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'not null o_orderkey', count(*) FROM orders WHERE o_orderkey IS NULL
    """,
)
def s2(t: Tables):
    declared = src.SCHEMAS["orders"].replace("o_orderkey bigint", "o_orderkey bigint NOT NULL")
    return src.check_table(t.orders, declared, "o_orderkey", [("o_custkey", t.customer, "c_custkey")])


@plan(
    "s2_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def s2_duplicates(t: Tables):
    return src.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@plan(
    "s2_orphans",
    "SELECT conv_id, turn FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)",
)
def s2_orphans(t: Tables):
    return src.orphans(t.conversations, "conv_id", t.labels, "doc_id").select("conv_id", "turn")


@plan(
    "s3_append_rows",
    f"SELECT o_orderstatus, count(*) AS n, {rq('sum(o_totalprice)', 2)} AS total FROM orders GROUP BY 1",
)
def s3(t: Tables):
    path = fresh_path(t, "orders")
    finished = F.col("o_orderstatus") == "F"
    src.append(t.orders.where(finished), path)
    src.append(t.orders.where(~finished), path)
    back = t.spark.read.schema(src.SCHEMAS["orders"]).parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r(F.sum("o_totalprice"), 2).alias("total"))


@plan(
    "s2_checked_write",
    """
    SELECT 'rows' AS rule, count(*) AS offenders FROM lineitem UNION ALL SELECT 'not null l_orderkey', count(*) FROM lineitem WHERE l_orderkey IS NULL
    UNION ALL SELECT 'range l_discount', count(*) FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.05
    UNION ALL SELECT 'range l_quantity', count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 10 AND 40
    """,
)
def s2_checked(t: Tables):
    declared = src.SCHEMAS["lineitem"].replace("l_orderkey bigint", "l_orderkey bigint NOT NULL")
    return src.write_checked(t.lineitem, fresh_path(t, "lineitem"), declared, {"l_discount": (0, 0.05), "l_quantity": (10, 40)})


@plan(
    "s3_replayed_append",
    f"SELECT o_orderstatus AS batch, count(*) AS n, {rq('sum(o_totalprice)', 2)} AS total FROM orders GROUP BY 1",
)
def s3_replayed(t: Tables):
    """Each status is one batch, and the first one is appended twice."""
    path = fresh_path(t, "orders")
    for status in ("F", "O", "P", "F"):
        src.append(t.orders.where(F.col("o_orderstatus") == status), path, batch=("batch", status))
    back = t.spark.read.schema(src.SCHEMAS["orders"] + ", batch string").parquet(path)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), r(F.sum("o_totalprice"), 2).alias("total"))


@plan(
    "s9_bucketed_features",
    f"""
    SELECT o_custkey, count(*) AS n, {rq('sum(o_totalprice)', 2)} AS spend,
           count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1
    """,
)
def s9_bucketed(t: Tables):
    """Two feature tables in the same buckets, joined without a shuffle."""
    spend = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("spend"))
    urgent = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    tables = [
        src.write_bucketed(df, f"{VIEWS}{name}_{uuid.uuid4().hex}", fresh_path(t, name), "o_custkey", 8) for name, df in (("spend", spend), ("urgent", urgent))
    ]
    joined = tables[0].join(tables[1].hint("merge"), "o_custkey")
    return joined.select("o_custkey", "n", r("spend", 2).alias("spend"), "urgent")


@plan(
    "s4_bound_sql",
    f"""
    SELECT o_orderpriority, count(*) AS n, {rq('avg(o_totalprice)')} AS mean_price FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_totalprice > 1000
    GROUP BY 1
    """,
)
def s4(t: Tables):
    src.register({"orders": t.orders}, VIEWS)
    return src.query(
        t.spark,
        f"""
        SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice) + 1e-9, 4) AS mean_price FROM {VIEWS}orders
        WHERE o_orderdate >= to_timestamp_ntz(:first) AND o_orderdate < to_timestamp_ntz(:until) AND o_totalprice > :least
        GROUP BY o_orderpriority
        """,
        first="1997-01-01",
        until="1998-01-01",
        least=1000,
    )


@plan(
    "s5_parse_dates",
    """
    SELECT o_orderkey, strftime(CASE WHEN o_orderstatus <> 'P' THEN date_trunc('day', o_orderdate) END, '%Y-%m-%d') AS day,
           CAST(o_orderstatus = 'P' AS INTEGER) AS unreadable
    FROM orders
    """,
)
def s5(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).otherwise(
        src.format_time("o_orderdate", "yyyy-MM-dd")
    )
    parsed = src.parse_time(text, "yyyy-MM-dd")
    return t.orders.select(
        "o_orderkey", src.format_time(parsed, "yyyy-MM-dd").alias("day"), parsed.isNull().cast("int").alias("unreadable")
    )


@plan(
    "s6_parse_numbers",
    """
    SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_number,
           TRY_CAST(p_type AS DOUBLE) AS type_number FROM part
    """,
)
def s6(t: Tables):
    number = F.get(F.split("p_brand", "#"), F.lit(1))
    return t.part.select(
        "p_partkey", src.parse_number(number).alias("brand_number"), src.parse_number("p_type").alias("type_number")
    )


@plan(
    "s7_format_dates",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS written, strftime(ts, '%Y-%m-%d') AS day FROM events
    """,
)
def s7(t: Tables):
    return t.events.select(
        "event_id", src.format_time("ts").alias("written"), src.format_time("ts", "yyyy-MM-dd").alias("day")
    )


@plan("s8_save_reload_model")
def s8(t: Tables):
    rows = t.orders.withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    stages = prepare.matrix_stages(["o_totalprice"], ["o_orderpriority"])
    fitted = prepare.pipeline(stages, train.logistic(rows)).fit(rows)
    path = fresh_path(t, "model")
    train.save(fitted, path)
    scored = train.positive_score(train.reload(path).transform(rows))
    return scored.select("o_orderkey", r("score", 6).alias("score"), "prediction")


@plan(
    "s9_write_feature_table",
    f"""
    SELECT strftime(c.cutoff, '%Y-%m-%d') AS cutoff, count(DISTINCT o_custkey) AS customers, count(*) AS n,
           {rq('sum(o_totalprice)', 2)} AS spend
    FROM orders, (VALUES (TIMESTAMP '1998-01-01'), (TIMESTAMP '2000-01-01')) c(cutoff)
    WHERE o_orderdate < c.cutoff GROUP BY 1
    """,
)
def s9(t: Tables):
    path = fresh_path(t, "features")
    for cutoff in ("1998-01-01", "2000-01-01"):
        past = t.orders.where(F.col("o_orderdate") < instant(F.lit(cutoff)))
        features = past.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("spend"))
        src.write_features(features.withColumn("cutoff", F.lit(cutoff)), path, "cutoff")
    back = t.spark.read.schema("o_custkey bigint, n bigint, spend double, cutoff string").parquet(path)
    return back.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("n").alias("n"), r(F.sum("spend"), 2).alias("spend")
    )
