"""Preparation, models and evaluation."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, PolynomialExpansion, StopWordsRemover, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import cyclical, weekday_monday0
from tidemark.functions.values import fill_from_column, flag
from tidemark.models import cluster, evaluate, prepare, train
from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.operators import labels
from tidemark.plans.entity_plans import CUT, cutoff, orders_by_customer
from tidemark.plans.label_plans import NEXT_90
from tidemark.plans.projection_plans import SPARSE_SQL, sparse
from tidemark.plans.registry import Tables, plan, r, rounded, rq
from tidemark.skew import settle, spread_join
from tidemark.spans import Span, days

NUMBERS = ["c_acctbal", "n_90d", "n_365d", "spend_365d", "days_since_last"]
GROUPS = ["c_mktsegment", "o_main"]


def customer_table(t: Tables) -> DataFrame:
    """Point-in-time customer features with three labels from the next 90 days; written once for repeated passes."""
    orders = orders_by_customer(t)
    windows = {"90d": Span(days(-90), days(0), "left"), "365d": Span(days(-365), days(0), "left")}
    df = ent.cutoff_features(
        t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"), orders, "c_custkey", "o_orderdate", cutoff(),
        windows, [agg.count("n"), agg.total("spend", "o_totalprice")],
    )
    df = ent.recency(df, orders, "c_custkey", "o_orderdate", cutoff(), "days_since_last", F.lit(9999.0))
    past = orders.where(F.col("o_orderdate") < cutoff())
    main = agg.top_value(past, "c_custkey", "o_orderpriority", "o_main")
    df = df.join(main, "c_custkey", "left").withColumn("o_main", F.coalesce("o_main", F.lit("none")))
    df = labels.event_label(df, orders, "c_custkey", "o_orderdate", cutoff(), NEXT_90, "label")
    spend = agg.total("next_spend", "o_totalprice")
    df = labels.future_total_label(df, orders, "c_custkey", "o_orderdate", cutoff(), NEXT_90, spend)
    tier = F.when(F.col("next_spend") <= 0, 0).when(F.col("next_spend") <= 300000, 1).otherwise(2)
    typed = df.withColumns({"tier": tier.cast("double"), "label": F.col("label").cast("double")})
    return settle(typed.withColumns({c: F.col(c).cast("double") for c in NUMBERS}), "rows")


def split(df: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    marked = settle(train.dealt(prepare.stratified_split(df, label, ["c_custkey"], 0.3)), "rows")
    return marked.where("is_test = 0").drop("is_test"), marked.where("is_test = 1").drop("is_test")


def matrix(**options) -> list:
    return prepare.matrix_stages(NUMBERS, GROUPS, **options)


@plan(
    "m1_impute",
    f"""
    WITH {SPARSE_SQL}, s AS (SELECT avg(urgent) AS m, quantile_cont(urgent, 0.5) AS md FROM sparse),
    x AS (SELECT c_custkey, urgent, CASE WHEN urgent IS NOT NULL THEN c_mktsegment END AS segment FROM sparse JOIN customer USING (c_custkey)),
    top AS (SELECT segment FROM x WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, segment LIMIT 1)
    SELECT c_custkey, {rq('coalesce(urgent, m)')} AS by_mean, {rq('coalesce(urgent, md)')} AS by_median,
           coalesce(segment, (SELECT segment FROM top)) AS by_mode, coalesce(segment, 'missing') AS by_constant FROM x, s
    """,
)
def m1(t: Tables):
    known = sparse(t).join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    df = known.withColumn("segment", F.when(F.col("urgent").isNotNull(), F.col("c_mktsegment"))).drop("c_mktsegment")
    df = Imputer(inputCols=["urgent"], outputCols=["by_mean"], strategy="mean").fit(df).transform(df)
    df = fill_from_column(df.withColumn("by_median", F.col("urgent")), "by_median", "median")
    df = df.withColumn("by_constant", F.coalesce("segment", F.lit("missing")))
    df = prepare.impute_modes(df.withColumnRenamed("segment", "by_mode"), ["by_mode"])
    return df.select("c_custkey", r("by_mean").alias("by_mean"), r("by_median").alias("by_median"), "by_mode", "by_constant")


@plan(
    "m3_standardise",
    f"""
    WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders WHERE o_orderdate < {CUT})
    SELECT o_orderkey, {rq('(o_totalprice - m) / d', 6)} AS o_totalprice_z FROM orders, s
    """,
)
def m3(t: Tables):
    past = t.orders.where(F.col("o_orderdate") < cutoff())
    df = prepare.standardise(past, t.orders, ["o_totalprice"])
    return df.select("o_orderkey", r("o_totalprice_z", 6).alias("o_totalprice_z"))


LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@plan(
    "m4_one_hot",
    "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderpriority = '{v}' AS DOUBLE) AS hot{i}" for i, v in enumerate(LEVELS[:4])) + " FROM orders",
)
def m4(t: Tables):
    # fitted without one level, which then counts as unknown and gives zeros
    stages = prepare.matrix_stages([], ["o_orderpriority"])
    fitted = Pipeline(stages=stages).fit(t.orders.where(F.col("o_orderpriority") != "5-LOW"))
    hot = fitted.transform(t.orders).withColumn("hot", vector_to_array("features"))
    return hot.select("o_orderkey", *[F.col("hot")[i].alias(f"hot{i}") for i in range(4)])


@plan(
    "m4_one_hot_columns",
    "SELECT event_id, " + ", ".join(f"CAST(event_type = '{v}' AS INTEGER) AS event_type_{v}" for v in ("click", "view")) + " FROM events",
)
def m4_columns(t: Tables):
    df = prepare.one_hot_columns(t.events, "event_type", ["click", "view"])
    return df.select("event_id", "event_type_click", "event_type_view")


@plan(
    "m5_ordinal_code",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE -1 END AS code FROM orders",
)
def m5(t: Tables):
    return t.orders.select("o_orderkey", prepare.ordinal_code("o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"]).alias("code"))


@plan(
    "m6_label_codes",
    """
    WITH c AS (SELECT DISTINCT c_mktsegment FROM customer), k AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code FROM c)
    SELECT c_custkey, CAST(code AS INTEGER) AS code, c_mktsegment AS decoded FROM customer JOIN k USING (c_mktsegment)
    """,
)
def m6(t: Tables):
    codes = prepare.label_codes(t.customer, "c_mktsegment")
    encoded = spread_join(t.customer, codes, "c_mktsegment", "c_custkey").select("c_custkey", "code")
    return spread_join(encoded, codes, "code", "c_custkey").select("c_custkey", "code", F.col("c_mktsegment").alias("decoded"))


@plan("m7_hashed_features")
def m7(t: Tables):
    columns = ["p_brand", "p_type", "p_name"]
    hashed = prepare.hashed_features(columns).transform(t.part).withColumn("h", vector_to_array("hashed"))
    return hashed.select("p_partkey", *[F.col("h")[i].alias(f"h{i}") for i in range(15)])


@plan(
    "m8_polynomial",
    f"""
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, CAST(p_size * p_size AS DOUBLE) AS aa, p_retailprice AS b, {rq('p_size * p_retailprice', 2)} AS ab,
           {rq('p_retailprice * p_retailprice', 2)} AS bb FROM part
    """,
)
def m8(t: Tables):
    plain = VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="plain").transform(t.part)
    expanded = PolynomialExpansion(degree=2, inputCol="plain", outputCol="wide").transform(plain)
    x = vector_to_array("wide")
    return expanded.select("p_partkey", x[0].alias("a"), x[1].alias("aa"), x[2].alias("b"), r(x[3], 2).alias("ab"), r(x[4], 2).alias("bb"))


# Fixed stop words of the text plan.
STOP = ["the", "of", "and", "in", "la", "le", "der", "die", "el", "de"]
TERMS_SQL = f"""
    docs AS (SELECT doc_id, text FROM documents),
    tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM docs),
    cnt AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term NOT IN ({', '.join(f"'{w}'" for w in STOP)}) GROUP BY 1, 2),
    voc AS (SELECT term, count(*) AS df, sum(tf) AS uses FROM cnt GROUP BY 1
            HAVING count(*) >= 5 AND count(*) <= 0.85 * (SELECT count(*) FROM docs) ORDER BY uses DESC, term LIMIT 200),
    raw AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1.0 + df)::DOUBLE) + 1) AS w FROM cnt JOIN voc USING (term)),
    len AS (SELECT doc_id, sqrt(sum(w * w)) AS l FROM raw GROUP BY 1),
    wgt AS (SELECT doc_id, term, w / l AS weight FROM raw JOIN len USING (doc_id))
"""


def weights(t: Tables):
    return prepare.text_weights(t.documents, "doc_id", "text", stop_words=STOP, max_features=200)


@plan("m9_text_weights", f"WITH {TERMS_SQL} SELECT doc_id, term, {rq('weight', 6)} AS weight FROM wgt")
def m9(t: Tables):
    return rounded(weights(t), 6)


@plan(
    "o3_top_terms_per_class",
    f"""
    WITH {TERMS_SQL},
    s AS (SELECT quality, term, sum(weight) / any_value(n) AS m FROM wgt JOIN labels USING (doc_id)
          JOIN (SELECT quality, count(*) AS n FROM labels GROUP BY 1) USING (quality) GROUP BY 1, 2)
    SELECT quality, term, {rq('m', 6)} AS mean_weight, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY quality ORDER BY round(m, 9) DESC, term) AS rank FROM s) WHERE rank <= 5
    """,
)
def o3_terms(t: Tables):
    top = prepare.top_terms(weights(t), t.labels, "doc_id", "quality")
    return top.select("quality", "term", r("mean_weight", 6).alias("mean_weight"), "rank")


@plan("m9_text_classifier")
def m9_classifier(t: Tables):
    rows = t.documents.select("doc_id", "text").join(t.labels, "doc_id").withColumn("label", F.col("quality").cast("double"))
    parts = settle(prepare.stratified_split(rows, "label", ["doc_id"], 0.3), "rows")
    fit_rows = parts.where("is_test = 0")
    stages = prepare.text_stages("text", output="features")
    scored = prepare.pipeline(stages, train.logistic(fit_rows)).fit(fit_rows).transform(parts.where("is_test = 1"))
    return train.positive_score(scored).select("doc_id", "label", "prediction", r("score", 5).alias("score"))


@plan("m9_stop_words")
def m9_stop_words(t: Tables):
    """Documents with Spark's English stop words removed, counted per language."""
    words = t.documents.select("lang", F.split(F.lower("text"), r"\s+").alias("words"))
    left = StopWordsRemover(inputCol="words", outputCol="kept").transform(words)
    return left.groupBy("lang").agg(F.sum(F.size("words")).alias("n_words"), F.sum(F.size("kept")).alias("n_kept"))


FACTORS = ["l_quantity", "l_discount", "l_tax"]


@plan(
    "m10_best_features",
    "WITH c AS (SELECT count(*) AS n, " + ", ".join(f"corr({c}, l_extendedprice) AS {c}" for c in FACTORS) + " FROM lineitem), "
    + "f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} * {c} * (n - 2) / (1 - {c} * {c}) AS f FROM c" for c in FACTORS) + ") "
    + f"SELECT feature, {rq('f', 3)} AS f_score, CAST(row_number() OVER (ORDER BY f DESC) <= 2 AS INTEGER) AS chosen FROM f",
)
def m10(t: Tables):
    _, names = prepare.best_features(t.lineitem, FACTORS, "l_extendedprice", 2)
    scores = prepare.f_scores(t.lineitem, FACTORS, "l_extendedprice")
    return scores.select("feature", r("f_score", 3).alias("f_score"), F.col("feature").isin(names).cast("int").alias("chosen"))


@plan(
    "m11_column_stages",
    f"""
    WITH {SPARSE_SQL}, x AS (SELECT c_custkey, c_mktsegment, coalesce(urgent, (SELECT avg(urgent) FROM sparse)) AS u FROM sparse JOIN customer USING (c_custkey)),
    s AS (SELECT avg(u) AS m, stddev_samp(u) AS d FROM x)
    SELECT c_custkey, {rq('(u - m) / d', 6)} AS v0, {', '.join(f"CAST(c_mktsegment = '{v}' AS DOUBLE) AS v{i + 1}"
      for i, v in enumerate(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']))} FROM x, s
    """,
)
def m11(t: Tables):
    rows = sparse(t).join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    fitted = Pipeline(stages=prepare.matrix_stages(["urgent"], ["c_mktsegment"])).fit(rows)
    x = vector_to_array("features")
    return fitted.transform(rows).select("c_custkey", r(x[0], 6).alias("v0"), *[x[i].alias(f"v{i}") for i in range(1, 6)])


@plan(
    "m12_custom_transformer",
    f"""
    SELECT p_partkey, CAST(p_size * p_size AS BIGINT) AS p_size_x_p_size, {rq('p_size * p_retailprice', 2)} AS p_size_x_p_retailprice,
           {rq('p_retailprice * p_retailprice', 2)} AS p_retailprice_x_p_retailprice FROM part
    """,
)
def m12(t: Tables):
    products = prepare.PairwiseProducts(inputCols=["p_size", "p_retailprice"])
    return rounded(products.transform(t.part).select("p_partkey", *products.output_names()), 2)


def _line(t: Tables):
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        t.lineitem.select("l_quantity", F.col("l_extendedprice").alias("label"))
    )


@plan(
    "m13_linear_regression",
    f"SELECT {rq('regr_slope(l_extendedprice, l_quantity)', 3)} AS slope, {rq('regr_intercept(l_extendedprice, l_quantity)', 2)} AS intercept FROM lineitem",
)
def m13(t: Tables):
    rows = _line(t)
    model = train.linear().fit(rows)
    return t.lineitem.agg(
        r(F.first(F.lit(float(model.coefficients[0]))), 3).alias("slope"), r(F.first(F.lit(float(model.intercept))), 2).alias("intercept")
    )


@plan(
    "m13_ridge_regression",
    f"SELECT {rq('regr_sxy(l_extendedprice, l_quantity) / (regr_sxx(l_extendedprice, l_quantity) + 1000.0)', 3)} AS slope FROM lineitem",
)
def m13_ridge(t: Tables):
    rows = _line(t)
    model = train.ridge(1000.0, rows).fit(rows)
    return t.lineitem.agg(r(F.first(F.lit(float(model.coefficients[0]))), 3).alias("slope"))


def scored_customers(make, t: Tables, label: str = "label"):
    """Fit make(training rows) on 70% of the customers and score the rest."""
    fit_rows, test_rows = split(customer_table(t), label)
    fitted = prepare.pipeline(matrix(), make(fit_rows)).fit(fit_rows)
    return fitted, fitted.transform(test_rows)


@plan("m14_logistic_regression")
def m14(t: Tables):
    _, scored = scored_customers(train.logistic, t)
    return train.positive_score(scored).select("c_custkey", "label", "prediction", r("score", 5).alias("score"))


@plan("m14_logistic_classes")
def m14_classes(t: Tables):
    _, scored = scored_customers(partial(train.logistic, label="tier"), t, "tier")
    probability = train.with_probabilities(scored)
    return probability.select("c_custkey", "tier", "prediction", *[r(F.col("probabilities")[i], 5).alias(f"p{i}") for i in range(3)])


@plan("m15_random_forest")
def m15(t: Tables):
    _, scored = scored_customers(lambda _: train.forest_in_blocks(), t)
    return train.positive_score(scored).select("c_custkey", "label", "prediction", r("score", 5).alias("score"))


@plan("m16_boosted_trees")
def m16(t: Tables):
    _, scored = scored_customers(lambda _: train.boosted(subsample=0.8), t)
    return train.positive_score(scored).select("c_custkey", "label", "prediction", r("score", 5).alias("score"))


@plan("m16_tuned_boosting")
def m16_tuned(t: Tables):
    """Many small steps on samples of rows and columns, positives weighted, splits only where they gain."""
    weighted = prepare.positive_weight(customer_table(t), "label")
    fit_rows, test_rows = split(weighted)
    model = train.boosted(rounds=200, depth=7, rate=0.05, subsample=0.7, weight="weight", columns=0.7, min_gain=0.2)
    scored = prepare.pipeline(matrix(), model).fit(fit_rows).transform(test_rows)
    return train.positive_score(scored).select("c_custkey", "label", "prediction", r("score", 5).alias("score"))


@plan("m16_boosted_classes")
def m16_classes(t: Tables):
    _, scored = scored_customers(lambda _: train.boosted_classes("tier"), t, "tier")
    probability = train.with_probabilities(scored)
    return probability.select("c_custkey", "tier", "prediction", *[r(F.col("probabilities")[i], 5).alias(f"p{i}") for i in range(3)])


@plan("m17_boosted_regressor")
def m17(t: Tables):
    fitted, scored = scored_customers(lambda _: train.boosted_regressor("next_spend"), t)
    return scored.select("c_custkey", r("next_spend", 2).alias("next_spend"), r("prediction", 2).alias("prediction"))


@plan(
    "m18_stratified_split",
    "SELECT o_orderpriority, count(*) AS n, CAST(floor((count(*) - 1) * 0.2::DOUBLE) + 1 AS BIGINT) AS n_test FROM orders GROUP BY 1",
)
def m18(t: Tables):
    marked = prepare.stratified_split(t.orders, "o_orderpriority", ["o_orderkey"], 0.2)
    return marked.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("is_test").alias("n_test"))


@plan(
    "m19_chronological_split",
    """
    WITH q AS (SELECT quantile_cont(epoch_us(ts), 0.7) AS a, quantile_cont(epoch_us(ts), 0.85) AS b FROM events)
    SELECT event_id, CASE WHEN epoch_us(ts) <= a THEN 'train' WHEN epoch_us(ts) <= b THEN 'validation' ELSE 'test' END AS part FROM events, q
    """,
)
def m19(t: Tables):
    parts = prepare.chronological_split(t.events, "ts", [0.7, 0.15, 0.15], ["train", "validation", "test"])
    return parts.select("event_id", "part")


@plan("m19_split_by_date", f"SELECT o_orderkey, CASE WHEN o_orderdate < {CUT} THEN 'train' ELSE 'test' END AS part FROM orders")
def m19_date(t: Tables):
    return prepare.split_at(t.orders, "o_orderdate", cutoff()).select("o_orderkey", "part")


def _result(t: Tables, names: list[str], rows: list[tuple], types: str) -> DataFrame:
    rows = [tuple(float(v) if isinstance(v, float) else v for v in row) for row in rows]
    return t.spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, types.split(), strict=True)))


@plan("m20_cross_validation")
def m20(t: Tables):
    df = customer_table(t)
    pipeline = prepare.pipeline(matrix(), train.logistic(df))
    found = train.cross_validate(df, ["c_custkey"], pipeline, BinaryClassificationEvaluator(), k=5)
    return _result(t, ["measure", "mean", "std"], [("areaUnderROC", found.avgMetrics[0], found.stdMetrics[0])], "string double double")


@plan("m21_grid_search")
def m21(t: Tables):
    df = customer_table(t)
    model = train.logistic()
    options = train.grid({model.regParam: [0.001, 0.1], model.elasticNetParam: [0.0, 0.5]})
    found = train.cross_validate(df, ["c_custkey"], prepare.pipeline(matrix(), model), BinaryClassificationEvaluator(), 3, options)
    rows = [
        (float(o[model.regParam]), float(o[model.elasticNetParam]), m, s)
        for o, m, s in zip(options, found.avgMetrics, found.stdMetrics, strict=True)
    ]
    return _result(t, ["penalty", "mixing", "mean", "std"], rows, "double double double double").orderBy(F.desc("mean"))


@plan("m21_model_families")
def m21_families(t: Tables):
    """Each family's own grid over the same folds, the best setting by area under the curve, and how it does on the held-out rows."""
    weighted = prepare.with_class_weight(customer_table(t), "label", "c_custkey")
    fit_rows, test_rows = split(weighted)
    families = {
        "logistic": train.Family(lambda rows, c: train.logistic(rows, c, weight="weight"), [{"c": c} for c in (0.01, 0.1, 1.0, 10.0)]),
        "forest": train.Family(lambda _, depth: train.forest_in_blocks(trees=200, depth=depth, weight="weight"), [{"depth": d} for d in (5, 10, train.DEEPEST)], (50, 100, 200)),
        "boosted": train.Family(lambda _, rate: train.boosted_in_blocks(rounds=200, rate=rate), [{"rate": r} for r in (0.01, 0.1, 0.2)], (50, 100, 200)),
    }
    rows = train.search_families(fit_rows, ["c_custkey"], matrix(), families, BinaryClassificationEvaluator(), test_rows)
    return _result(t, ["family", "best", "mean_auc", "test_auc"], rows, "string string double double")


@plan("m22_random_search")
def m22(t: Tables):
    df = customer_table(t)
    model = train.logistic()
    options = train.log_uniform_grid(model.regParam, 1e-3, 1e2, 10)
    judge = evaluate.MinorityF1(labelCol="label", predictionCol="prediction")
    found = train.cross_validate(df, ["c_custkey"], prepare.pipeline(matrix(), model), judge, 3, options)
    rows = [(float(o[model.regParam]), m) for o, m in zip(options, found.avgMetrics, strict=True)]
    return _result(t, ["penalty", "mean_f1"], rows, "double double")


@plan(
    "m23_class_weights",
    f"SELECT quality, count(*) AS n, {rq('(SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*))::DOUBLE', 6)} AS weight FROM labels GROUP BY 1",
)
def m23(t: Tables):
    return rounded(prepare.class_weights(t.labels, "quality"), 6)


@plan(
    "m23_positive_weight",
    f"SELECT doc_id, toxic, {rq('CASE WHEN toxic = 1 THEN (SELECT sum(1 - toxic) / sum(toxic)::DOUBLE FROM labels) ELSE 1 END', 6)} AS weight FROM labels",
)
def m23_positive(t: Tables):
    return prepare.positive_weight(t.labels, "toxic").select("doc_id", "toxic", r("weight", 6).alias("weight"))


@plan("m23_weighted_forest")
def m23_forest(t: Tables):
    weighted = prepare.with_class_weight(customer_table(t), "label", "c_custkey")
    fit_rows, test_rows = split(weighted)
    model = train.forest_in_blocks(weight="weight")
    scored = prepare.pipeline(matrix(), model).fit(fit_rows).transform(test_rows)
    return train.positive_score(scored).select("c_custkey", "label", "prediction", r("score", 5).alias("score"))


@plan("m24_feed_forward")
def m24(t: Tables):
    df = customer_table(t)
    fit_rows, test_rows = split(df)
    stages = prepare.matrix_stages(NUMBERS, [])
    scored = train.fit_prepared(fit_rows, stages, train.feed_forward(len(NUMBERS))).transform(test_rows)
    return train.positive_score(scored).select("c_custkey", "label", "prediction", r("score", 4).alias("score"))


# A rule-based prediction over a whole table makes the measures checkable in SQL.
RULE = "SELECT o_orderpriority AS actual, CASE WHEN o_totalprice > 400000 THEN '1-URGENT' WHEN o_totalprice > 250000 THEN '3-MEDIUM' ELSE '5-LOW' END AS predicted FROM orders"


def ruled(t: Tables):
    price = F.col("o_totalprice")
    guess = F.when(price > 400000, "1-URGENT").when(price > 250000, "3-MEDIUM").otherwise("5-LOW")
    return t.orders.select(F.col("o_orderpriority").alias("actual"), guess.alias("predicted"))


@plan(
    "m25_class_report",
    f"""
    WITH x AS ({RULE}), k AS (SELECT DISTINCT actual AS class FROM x UNION SELECT DISTINCT predicted FROM x),
    p AS (SELECT class, (SELECT count(*) FROM x WHERE actual = class) AS support, (SELECT count(*) FROM x WHERE predicted = class) AS called,
                 (SELECT count(*) FROM x WHERE predicted = class AND actual = class) AS hits FROM k),
    m AS (SELECT class, support, hits, coalesce(hits / nullif(called, 0)::DOUBLE, 0) AS precision, coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
                 coalesce(2.0 * hits / nullif(support + called, 0)::DOUBLE, 0) AS f1 FROM p),
    o AS (SELECT class, support, precision, recall, f1 FROM m
      UNION ALL SELECT 'macro avg', sum(support)::BIGINT, avg(precision), avg(recall), avg(f1) FROM m
      UNION ALL SELECT 'weighted avg', sum(support)::BIGINT, sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM m
      UNION ALL SELECT 'accuracy', sum(support)::BIGINT, sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support) FROM m)
    SELECT class, support, {rq('precision', 6)} AS precision, {rq('recall', 6)} AS recall, {rq('f1', 6)} AS f1 FROM o
    """,
)
def m25(t: Tables):
    return rounded(evaluate.class_report(ruled(t), "actual", "predicted"), 6)


# A score between 0 and 1 taken from the price, with ties, against a 0/1 label.
SCORED = "SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS label, floor(o_totalprice / 1000) / 500 AS score FROM orders"


def priced(t: Tables):
    return t.orders.select(
        flag(F.col("o_orderstatus") == "F").alias("label"), (F.floor(F.col("o_totalprice") / 1000) / 500).alias("score")
    )


STEPS = f"""
    x AS ({SCORED}), g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM x GROUP BY 1),
    c AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
          FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@plan(
    "m26_ranking_quality",
    f"""
    WITH {STEPS} SELECT {rq('sum(neg * (tp - pos + pos / 2.0)) / (any_value(p) * any_value(n))::DOUBLE', 6)} AS roc_auc,
      {rq('sum(tp / (tp + fp)::DOUBLE * pos) / any_value(p)::DOUBLE', 6)} AS average_precision FROM c
    """,
)
def m26(t: Tables):
    return rounded(evaluate.ranking_quality(priced(t), "label", "score"), 6)


@plan("m27_roc_points", f"WITH {STEPS} SELECT {rq('score', 6)} AS threshold, {rq('fp / n::DOUBLE', 6)} AS fpr, {rq('tp / p::DOUBLE', 6)} AS tpr FROM c")
def m27(t: Tables):
    return rounded(evaluate.roc_points(priced(t), "label", "score"), 6)


@plan(
    "m27_calibration",
    f"""
    WITH x AS ({SCORED})
    SELECT CAST(least(9, floor(score * 10)) AS INTEGER) AS bin, count(*) AS n, {rq('avg(score)', 6)} AS mean_score, {rq('avg(label)', 6)} AS rate FROM x GROUP BY 1
    """,
)
def m27_calibration(t: Tables):
    return rounded(evaluate.calibration(priced(t), "label", "score"), 6)


@plan(
    "m28_regression_quality",
    f"""
    WITH x AS (SELECT l_extendedprice AS y, 2000 * l_quantity AS p FROM lineitem)
    SELECT {rq('avg(abs(y - p))', 3)} AS mae, {rq('avg((y - p) * (y - p))', 0)} AS mse, {rq('1 - avg((y - p) * (y - p)) / var_pop(y)', 6)} AS r2 FROM x
    """,
)
def m28(t: Tables):
    rows = t.lineitem.select(F.col("l_extendedprice").alias("y"), (2000 * F.col("l_quantity")).alias("p"))
    found = evaluate.regression_quality(rows, "y", "p")
    return found.select(r("mae", 3).alias("mae"), r("mse", 0).alias("mse"), r("r2", 6).alias("r2"))


@plan(
    "m29_log_loss",
    f"""
    WITH x AS ({SCORED}), y AS (SELECT label, greatest(1e-15, least(1 - 1e-15, score)) AS p FROM x)
    SELECT {rq('avg(-ln(CASE WHEN label = 1 THEN p ELSE 1 - p END))', 6)} AS loss FROM y
    """,
)
def m29(t: Tables):
    return priced(t).agg(r(evaluate.log_loss("label", "score"), 6).alias("loss"))


@plan(
    "m29_confusion_matrix",
    f"WITH x AS ({RULE}) SELECT actual, "
    + ", ".join(f"count(*) FILTER (WHERE predicted = '{c}') AS \"predicted_{c}\"" for c in ("1-URGENT", "3-MEDIUM", "5-LOW"))
    + " FROM x GROUP BY 1",
)
def m29_confusion(t: Tables):
    return evaluate.confusion_matrix(ruled(t), "actual", "predicted", ["1-URGENT", "3-MEDIUM", "5-LOW"])


@plan(
    "m30_minority_f1",
    f"""
    WITH x AS (SELECT toxic AS actual, CAST(n_chars > 1500 AS INTEGER) AS predicted FROM labels JOIN documents USING (doc_id)),
    m AS (SELECT actual AS c FROM x GROUP BY 1 ORDER BY count(*), actual LIMIT 1)
    SELECT {rq('2.0 * count(*) FILTER (WHERE actual = c AND predicted = c) / (count(*) FILTER (WHERE actual = c) + count(*) FILTER (WHERE predicted = c))', 6)} AS f1 FROM x, m
    """,
)
def m30(t: Tables):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    rows = rows.select(F.col("toxic").alias("actual"), flag(F.col("n_chars") > 1500).alias("predicted"))
    return rounded(evaluate.minority_f1(rows, "actual", "predicted"), 6)


@plan("m31_feature_importances")
def m31(t: Tables):
    fitted, scored = scored_customers(lambda _: train.forest_in_blocks(), t)
    return evaluate.feature_weights(t.spark, scored, fitted.stages[-1].featureImportances.toArray())


@plan("m31_coefficients")
def m31_coefficients(t: Tables):
    fitted, scored = scored_customers(train.logistic, t)
    return evaluate.feature_weights(t.spark, scored, fitted.stages[-1].coefficients.toArray())


@plan("m32_score_date_grid")
def m32(t: Tables):
    """Daily demand per event type, fitted on the past and scored for each of the next 7 days."""
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("label"))

    def calendar(df):
        sin, cos = cyclical(weekday_monday0("day"), 7)
        return df.withColumns({"sin": sin, "cos": cos, "weekday": weekday_monday0("day").cast("double")})

    stages = prepare.matrix_stages(["sin", "cos", "weekday"], ["event_type"])
    fitted = prepare.pipeline(stages, train.linear()).fit(calendar(daily))
    last = t.events.agg(F.to_date(F.max("ts"))).scalar()
    ahead = F.sequence(F.date_add(last, 1), F.date_add(last, 7))
    grid = t.events.select("event_type").distinct().withColumn("day", F.explode(ahead))
    return fitted.transform(calendar(grid)).select("event_type", F.col("day").cast("string").alias("day"), r("prediction", 3).alias("prediction"))


@plan("m33_compare_encodings")
def m33(t: Tables):
    df = customer_table(t)
    fit_rows, test_rows = split(df)
    named = {
        "onehot": prepare.pipeline(matrix(encode="onehot"), train.logistic(fit_rows)),
        "ordinal": prepare.pipeline(matrix(encode="ordinal"), train.logistic(fit_rows)),
    }

    def measure(scored):
        rows = train.positive_score(scored)
        return evaluate.ranking_quality(rows, "label", "score")

    return rounded(train.compare(named, fit_rows, test_rows, measure), 6)


@plan("m33_plain_and_polynomial")
def m33_polynomial(t: Tables):
    df = customer_table(t).withColumn("target", F.col("next_spend"))
    fit_rows, test_rows = split(df)
    named = {
        "plain": prepare.pipeline(prepare.matrix_stages(NUMBERS), train.ridge(1.0, fit_rows, "target")),
        "polynomial": prepare.pipeline(prepare.polynomial_stages(NUMBERS), train.ridge(1.0, fit_rows, "target")),
    }
    measure = partial(evaluate.regression_quality, label="target", prediction="prediction")
    return rounded(train.compare(named, fit_rows, test_rows, measure), 4)


@plan("m20_regression_cross_validation")
def m20_regression(t: Tables):
    df = customer_table(t)
    pipeline = prepare.pipeline(prepare.polynomial_stages(NUMBERS), train.ridge(1.0, df, "next_spend"))
    judge = RegressionEvaluator(labelCol="next_spend", metricName="rmse")
    found = train.cross_validate(df, ["c_custkey"], pipeline, judge, k=3)
    return _result(t, ["measure", "mean", "std"], [("rmse", found.avgMetrics[0], found.stdMetrics[0])], "string double double")


@plan("m20_class_cross_validation")
def m20_classes(t: Tables):
    df = customer_table(t)
    pipeline = prepare.pipeline(matrix(), train.forest_in_blocks("tier"))
    judge = MulticlassClassificationEvaluator(labelCol="tier", metricName="weightedFMeasure")
    found = train.cross_validate(df, ["c_custkey"], pipeline, judge, k=3)
    return _result(t, ["measure", "mean", "std"], [("weightedF", found.avgMetrics[0], found.stdMetrics[0])], "string double double")


def vectors(t: Tables):
    return t.embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@plan("m34_kmeans_sweep")
def m34(t: Tables):
    return rounded(cluster.kmeans_sweep(t.spark, settle(vectors(t), "vectors"), range(2, 9)), 5)


@plan("m34_kmeans_assignments")
def m34_assignments(t: Tables):
    _, assigned = cluster.clustered(settle(vectors(t), "vectors"), 5)
    return assigned.select("vec_id", "prediction")


@plan("m35_projection")
def m35(t: Tables):
    rows = settle(vectors(t), "rows")
    _, _, placed = cluster.projected(rows)
    x = vector_to_array("projected")
    return placed.select("vec_id", r(x[0], 5).alias("x"), r(x[1], 5).alias("y"))


@plan("m35_projected_centroids")
def m35_centroids(t: Tables):
    rows = settle(vectors(t), "rows")
    model, _ = cluster.clustered(rows, 5)
    centre, pca, _ = cluster.projected(rows)
    centres = t.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.clusterCenters())], "cluster int, v array<double>")
    placed = pca.transform(centre.transform(centres.withColumn("features", array_to_vector("v"))))
    x = vector_to_array("projected")
    return placed.select("cluster", r(x[0], 5).alias("x"), r(x[1], 5).alias("y"))


