"""Operator 3: judge urls by host and path rules, and by boosted trees on lexical features where no rule fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle

#: Rules of the registered query: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ["url_length", "host_length", "host_labels", "path_length", "depth", "digit_ratio", "symbol_ratio", "entropy", "parameters", "query_length", "has_fragment"]
SUFFIX = ["suffix_rate", "suffix_seen", "domain_rate", "domain_seen"]


def after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, ASCII letters lower-cased; empty for null or no ://."""
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or #; empty for null or no ://."""
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule for the host or a parent domain whose path starts the url's, as a struct, or null."""
    longest = sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    fits = [
        F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(prefix), F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, name, prefix in longest
    ]
    return F.coalesce(*fits, nothing)


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    size = F.greatest(F.length(url), F.lit(1))
    letters = F.split(url, "")
    shares = F.transform(F.array_distinct(letters), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "host_labels": F.size(F.split(host, r"\.")),
        "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/[^/]")),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / size,
        "symbol_ratio": F.regexp_count(url, F.lit("[-_%~+]")) / size,
        "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        "query_length": F.length(query),
        "has_fragment": F.when(F.contains(url, F.lit("#")), 1).otherwise(0),
    }


def describe(pages: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id") -> DataFrame:
    """The key, host, path, rule, given (the rule's verdict), the url's suffixes, the url, its place in the draw and its lexical features."""
    url = F.coalesce("url", F.lit(""))
    rows = pages.select(key, url.alias("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    features = [value.cast("double").alias(name) for name, value in lexical_features(F.col("url"), F.col("host"), F.col("path")).items()]
    return rows.select(
        key, "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("given"),
        F.substring_index("host", ".", -1).alias("suffix"), F.substring_index("host", ".", -2).alias("domain"),
        "url", F.xxhash64("url").alias("draw"), *features,
    )


def with_suffix_statistics(rows: DataFrame, statistics: dict[str, DataFrame], *, leave_own_out: bool) -> DataFrame:
    """Add the smoothed share of blocked labelled urls per suffix and its evidence; labelled rows don't see themselves."""
    own = F.lit(1 if leave_own_out else 0)
    for name, table in statistics.items():
        blocked = F.coalesce("_blocked", F.lit(0)) - own * F.coalesce(F.col("label"), F.lit(0.0))
        seen = F.coalesce("_seen", F.lit(0)) - own
        rows = rows.join(table, name, "left").withColumn(f"{name}_rate", (blocked + 1) / (seen + 2)).withColumn(f"{name}_seen", F.log1p(F.greatest(seen, F.lit(0)).cast("double")))
        rows = rows.drop("_blocked", "_seen")
    return rows


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None, *,
    training_rows: int = 20_000, trees: int = 20, depth: int = 3, seed: int = 5,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block) and score.

    A fitting rule decides; its urls' verdicts are also the labels that the trees learn from, unless ``labelled``
    (url, label: 1 block) gives others. The trees are fitted to at most ``training_rows`` different labelled urls, those
    with the smallest hashes, each weighing as much as it has rows; suffix statistics are counted over all labelled urls. With labels of one kind only
    that verdict stands for every other url; without labels it is allow. ``score`` is the trees' share for block
    (null where nothing could be fitted). Null urls count as empty; repeated rows stay; other columns are
    ignored, whatever their names; no rows give no rows.
    """
    rows = describe(pages, rules)
    if labelled is None:
        known = rows.where("given is not null").withColumn("label", F.when(F.col("given") == "block", 1.0).otherwise(0.0))
    else:
        known = describe(labelled.select("url", F.col("label").cast("double")), (), "label")
    statistics = {
        name: settle(known.groupBy(name).agg(F.sum("label").alias("_blocked"), F.count(F.lit(1)).alias("_seen")), "suffixes") for name in ("suffix", "domain")
    }
    kinds = statistics["suffix"].agg(F.coalesce(F.sum("_blocked"), F.lit(0.0)).alias("blocked"), F.coalesce(F.sum("_seen"), F.lit(0)).alias("seen")).first()
    if not 0 < kinds["blocked"] < kinds["seen"]:
        verdict = "block" if kinds["blocked"] else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("given", F.lit(verdict)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    different = known.groupBy("url", "label", "draw", "suffix", "domain", *LEXICAL).agg(F.count(F.lit(1)).cast("double").alias("rows"))
    chosen = different.orderBy("draw", "url", "label").limit(training_rows)
    assembler = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features")
    train = settle(with_suffix_statistics(chosen, statistics, leave_own_out=True).select("label", "rows", *LEXICAL, *SUFFIX), "training-urls")
    model = GBTClassifier(labelCol="label", weightCol="rows", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed).fit(assembler.transform(train))
    scored = with_suffix_statistics(rows.withColumn("label", F.lit(0.0)), statistics, leave_own_out=False)
    scored = model.transform(assembler.transform(scored))
    verdict = F.coalesce("given", F.when(F.col("prediction") == 1.0, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.element_at(_values("probability"), 2).alias("score"))


def _values(vector: str) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(vector))
