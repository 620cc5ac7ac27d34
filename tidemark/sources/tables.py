"""Reading, registering, checking and writing tables."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.skew import names
from tidemark.spans import column

# Fixed column layouts of the input tables.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One declared table; the schema is stated, so no file is opened to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(folder, f"{name}.parquet"))


def register(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make DataFrames available to SQL by name, after a prefix where the session may have views of these names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def register_folder(spark: SparkSession, folder: str, wanted: Sequence[str] = tuple(SCHEMAS), prefix: str = "") -> None:
    register({name: load(spark, folder, name) for name in wanted}, prefix)


def query(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """SQL over registered tables with bound parameters (``:name``)."""
    return spark.sql(text, args=parameters)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference has no parent row; a null reference is allowed, as in SQL."""
    parents = parent.select(F.col(parent_key).alias("_tm_parent"))
    return df.where(F.col(key).isNotNull()).join(parents, F.col(key) == F.col("_tm_parent"), "left_anti")


def check_table(
    df: DataFrame, schema: str | T.StructType, keys=(), references: Sequence[tuple] = (), ranges: Mapping[str, tuple] | None = None
) -> DataFrame:
    """One row per declared rule with the number of offenders.

    ``references`` holds (column, parent table, parent column), ``ranges`` the least and greatest allowed value of a column. All
    rules that a row breaks by itself are counted in one pass.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    _same_columns(df, declared)
    rules = []
    if names(keys):
        rules.append(("unique " + ",".join(names(keys)), duplicate_keys(df, keys)))
    for name, parent, parent_name in references:
        rules.append((f"reference {name}", orphans(df, name, parent, parent_name)))
    counted = [r.agg(F.count(F.lit(1)).alias("offenders")).select(F.lit(rule).alias("rule"), "offenders") for rule, r in rules]
    broken = row_rules(declared, ranges)
    if broken:
        one_pass = df.agg(*[F.count_if(condition).alias(f"_tm_{i}") for i, condition in enumerate(broken.values())])
        cells = [F.struct(F.lit(rule).alias("rule"), F.col(f"_tm_{i}").alias("offenders")) for i, rule in enumerate(broken)]
        counted.append(one_pass.select(F.inline(F.array(*cells))))
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


def _same_columns(df: DataFrame, declared: T.StructType) -> None:
    actual = dict(df.dtypes)
    wrong = [f.name for f in declared if actual.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"columns differ from the declared schema: {wrong}")


def row_rules(declared: T.StructType, ranges: Mapping[str, tuple] | None = None) -> dict[str, Column]:
    """What breaks each rule that concerns a single row. A null is in every range."""
    rules = {f"not null {field.name}": F.col(field.name).isNull() for field in declared if not field.nullable}
    for name, (low, high) in (ranges or {}).items():
        rules[f"range {name}"] = ~F.col(name).between(low, high)
    return rules


def write_checked(df: DataFrame, path: str, schema: str | T.StructType, ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    """Write a table, then count its rows and the offenders of all row rules in one pass over the ruled columns of what was written.

    Not by ``observe``: a session that has observed once can't run some of Spark ML's evaluators any more.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    _same_columns(df, declared)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    rules = row_rules(declared, ranges)
    one_pass = written.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(condition).alias(f"r{i}") for i, condition in enumerate(rules.values())])
    cells = [F.struct(F.lit("rows").alias("rule"), F.col("rows").alias("offenders")), *[F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("offenders")) for i, rule in enumerate(rules)]]
    return one_pass.select(F.inline(F.array(*cells)))


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), batch: tuple[str, str] | None = None) -> None:
    """Append rows. With ``batch``, a column's name and this batch's value, appending the same batch again replaces it: a replay changes nothing."""
    if batch is None:
        writer = df.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return
    named = df.withColumn(batch[0], F.lit(batch[1]))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch[0], *partition_by).parquet(path)


def write_features(df: DataFrame, path: str, cutoff: str | None = None) -> None:
    """Write a feature table partitioned by cutoff date; only the given cutoffs' partitions are replaced."""
    writer = df.write.mode("overwrite")
    if cutoff is None:
        writer.parquet(path)
    else:
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(cutoff).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys, buckets: int) -> DataFrame:
    """Write a feature table dealt over buckets of its keys, under a name of the session's catalog, and return it.

    Tables of equally many buckets on the same keys join and group by them without a shuffle. ``path`` lies in the shared folder.
    """
    keys = names(keys)
    # one task per bucket, so each bucket is one file
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def parse_time(text, pattern: str | None = None) -> Column:
    """Timestamp from text; text that is not one becomes null."""
    parsed = F.try_to_timestamp(column(text), F.lit(pattern)) if pattern else F.try_to_timestamp(column(text))
    return parsed.cast("timestamp_ntz")


def parse_number(text) -> Column:
    return column(text).try_cast("double")


def format_time(time, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column(time), pattern)
