"""Shared helpers: tables written to the cluster's shared folder, running totals of hot keys, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only in a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage, so a lost executor costs no recomputation of earlier steps, and it tells Spark the
    size of the table: joins of two settled tables are broadcast or split by Spark from what was measured.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_in(text: Column) -> Column:
    """Number of words, as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_start(df: DataFrame, key: str, order: list[str], amount: str, out: str, *, rows_per_bucket: int = 1024) -> DataFrame:
    """Add the sum of ``amount`` over the earlier rows of the same key, however many rows a key has.

    ``order[0]`` must be a long spread evenly over 0..2^40. A key's rows are cut into buckets of about
    ``rows_per_bucket`` by that value; a window runs inside each bucket and another over the buckets' sums.
    ``df`` is read twice, so it should be a settled table.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(key, F.greatest(F.lit(1), F.expr(f"_n div {int(rows_per_bucket)}")).alias("_buckets"))
    cut = df.join(settle(counts, "buckets"), key).withColumn("_bucket", F.floor(F.col(order[0]) / (F.lit(float(1 << 40)) / F.col("_buckets"))))
    sums = cut.groupBy(key, "_bucket").agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = settle(sums.select(key, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")), "bucket-starts")
    inside = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(sums, [key, "_bucket"])
    return placed.withColumn(out, (F.col("_before") + F.col("_inside")).cast("long")).drop("_bucket", "_buckets", "_before", "_inside")


def spread_key(*columns: Column) -> Column:
    """A long spread evenly over 0..2^40, fixed by the given columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40))


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): each node of the edges (a, b) with the smallest node reachable from it.

    Alternating large and small stars on settled tables: every round keeps the components, moves all nodes
    towards their smallest one and stops when each node points at a root. No more than the edges is held anywhere.
    """
    step = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        step = settle(step, "edges")
        both = step.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(step.select(F.col("b").alias("u"), F.col("a").alias("v")))
        below = F.count_if(F.col("v") < F.col("u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"), below.alias("below"))
        least = settle(least.select("u", F.least("u", "m").alias("m"), "n", "below"), "least")
        # a root has no smaller neighbour, any other node has its root and nothing else
        if not least.where("below > 1 or below = 1 and n > 1").take(1):
            return least.select(F.col("u").alias("node"), F.col("m").alias("root"))
        large = settle(both.where("v > u").join(least.select("u", "m"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")), "large-star")
        least = settle(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        step = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
