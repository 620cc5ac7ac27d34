"""The tables behind the charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.models.prepare import draw
from tidemark.operators import aggregates as agg
from tidemark.plans.registry import Tables, plan, r, rounded, rq

SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)


@plan(
    "e1_five_numbers",
    "SELECT o_orderpriority, " + ", ".join(f"{rq(f'quantile_cont(o_totalprice, {s})', 3)} AS q{i}" for i, s in enumerate(SHARES)) + " FROM orders GROUP BY 1",
)
def e1(t: Tables):
    return rounded(agg.exact_quantiles(t.orders, "o_totalprice", SHARES, "o_orderpriority"), 3)


@plan(
    "e2_histogram",
    """
    WITH s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders)
    SELECT CAST(least(49, floor((o_totalprice - a) / (b - a) * 50)) AS BIGINT) AS bin, count(*) AS n FROM orders, s GROUP BY 1
    """,
)
def e2(t: Tables):
    ends = t.orders.agg(F.struct(F.min("o_totalprice").alias("a"), F.max("o_totalprice").alias("b"))).scalar()
    place = F.floor((F.col("o_totalprice") - ends["a"]) / (ends["b"] - ends["a"]) * 50)
    return t.orders.groupBy(F.least(F.lit(49), place).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@plan(
    "e3_stacked_bars",
    """
    SELECT lang, count(*) FILTER (WHERE quality = 0) AS "0", count(*) FILTER (WHERE quality = 1) AS "1"
    FROM documents JOIN labels USING (doc_id) GROUP BY 1
    """,
)
def e3(t: Tables):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return agg.cross_table(rows.withColumn("quality", F.col("quality").cast("string")), "lang", "quality", ["0", "1"])


@plan("e4_scatter_sample")
def e4(t: Tables):
    """A repeatable 5% sample for pairwise scatter charts; sampling is the feature here."""
    rows = t.lineitem.where(draw(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 42) < 0.05)
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", r("l_extendedprice", 2).alias("l_extendedprice"), "l_discount")
