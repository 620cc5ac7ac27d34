"""Model parts against closed forms computed with numpy on small data."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tidemark.models import cluster, evaluate, prepare, train
from tidemark.session import checkpoint_folder
from tidemark.skew import SkewPolicy


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] + 0.5 * rng.normal(size=200) > 0).astype(float)
    data = [(i, float(x[i, 0]), float(x[i, 1]), "abc"[i % 3], float(y[i])) for i in range(200)]
    return spark.createDataFrame(data, "id bigint, a double, b double, kind string, label double").cache()


def test_split_is_stratified_and_repeatable(rows):
    first = prepare.stratified_split(rows, "label", ["id"], 0.25)
    again = prepare.stratified_split(rows.repartition(5), "label", ["id"], 0.25)
    assert {r.id for r in first.where("is_test = 1").collect()} == {r.id for r in again.where("is_test = 1").collect()}
    shares = first.groupBy("label").agg(F.avg("is_test").alias("s"), F.count("id").alias("n")).collect()
    assert all(abs(r.s - 0.25) <= 1 / r.n for r in shares)


def test_ridge_equals_closed_form(spark, rows):
    pdf = rows.select("a", "b").toPandas().to_numpy()
    y = 3 * pdf[:, 0] - pdf[:, 1] + 10
    df = spark.createDataFrame([(Vectors.dense(p), float(t)) for p, t in zip(pdf, y, strict=True)], ["features", "label"])
    model = train.ridge(25.0, df).fit(df)
    x = pdf - pdf.mean(axis=0)
    expected = np.linalg.solve(x.T @ x + 25.0 * np.eye(2), x.T @ (y - y.mean()))
    assert model.coefficients.toArray() == pytest.approx(expected, rel=1e-6)


def test_logistic_has_zero_gradient_at_its_penalty(rows):
    stages = prepare.matrix_stages(["a", "b"], scale=False)
    fitted = prepare.pipeline(stages, train.logistic(rows, c=0.5).setTol(1e-10)).fit(rows)
    w, w0 = fitted.stages[-1].coefficients.toArray(), fitted.stages[-1].intercept
    pdf = rows.toPandas()
    x, y = pdf[["a", "b"]].to_numpy(), pdf["label"].to_numpy()
    p = 1 / (1 + np.exp(-(x @ w + w0)))
    gradient = 0.5 * x.T @ (p - y) + w
    assert np.abs(gradient).max() < 1e-3


def test_ranking_quality_equals_pair_counting(spark):
    rng = np.random.default_rng(3)
    label, score = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 40
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(label, score, strict=True)], "label int, score double")
    found = evaluate.ranking_quality(df, "label", "score").first()
    pos, neg = score[label == 1], score[label == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert found.roc_auc == pytest.approx(pairs / (len(pos) * len(neg)))
    precision = [(label[score >= t].mean(), ((score == t) & (label == 1)).sum()) for t in np.unique(score)]
    assert found.average_precision == pytest.approx(sum(p * n for p, n in precision) / len(pos))


def test_one_vs_rest_probabilities(rows):
    coded = rows.withColumn("label", F.pmod("id", F.lit(3)).cast("double"))
    fitted = prepare.pipeline(prepare.matrix_stages(["a", "b"], ["kind"]), train.boosted_classes(rounds=2)).fit(coded)
    scored = train.with_probabilities(fitted.transform(coded))
    best = F.array_position("probabilities", F.array_max("probabilities")) - 1
    checked = scored.select(
        F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("whole"), (best == F.col("prediction")).alias("same")
    ).collect()
    assert all(r.whole == pytest.approx(1) and r.same for r in checked)


def test_unknown_level_gives_zeros(rows):
    fitted = prepare.Pipeline(stages=prepare.matrix_stages([], ["kind"])).fit(rows.where("kind <> 'c'"))
    sizes = fitted.transform(rows).select("kind", "features").collect()
    assert {(r.kind, tuple(r.features.toArray())) for r in sizes} == {("a", (1, 0)), ("b", (0, 1)), ("c", (0, 0))}


def test_save_and_reload(spark, rows, tmp_path):
    fitted = prepare.pipeline(prepare.matrix_stages(["a"], ["kind"]), train.logistic()).fit(rows)
    train.save(fitted, str(tmp_path / "model"))
    again = train.reload(str(tmp_path / "model"))
    a = [tuple(r) for r in train.positive_score(fitted.transform(rows)).select("id", "score").orderBy("id").collect()]
    b = [tuple(r) for r in train.positive_score(again.transform(rows)).select("id", "score").orderBy("id").collect()]
    assert a == b


def test_custom_transformer_round_trip(rows, tmp_path):
    products = prepare.PairwiseProducts(inputCols=["a", "b"])
    products.write().save(str(tmp_path / "products"))
    again = prepare.PairwiseProducts.load(str(tmp_path / "products"))
    assert again.transform(rows).columns[-3:] == ["a_x_a", "a_x_b", "b_x_b"]


def test_grid_and_random_search(rows):
    model = train.logistic()
    options = train.log_uniform_grid(model.regParam, 1e-3, 1.0, 3)
    assert options == train.log_uniform_grid(model.regParam, 1e-3, 1.0, 3)
    assert all(1e-3 <= o[model.regParam] <= 1.0 for o in options)
    judge = evaluate.MinorityF1()
    found = train.cross_validate(rows, ["id"], prepare.pipeline(prepare.matrix_stages(["a", "b"]), model), judge, 3, options)
    assert len(found.avgMetrics) == 3 and all(0 < m <= 1 for m in found.avgMetrics)


def test_clusters_and_projection(spark):
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(c, 0.1, size=(30, 3)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, v array<double>")
    df = df.withColumn("features", array_to_vector("v")).cache()
    sweep = {r.k: r for r in cluster.kmeans_sweep(spark, df, [2, 3]).collect()}
    model, placed = cluster.clustered(df, 3)
    assigned = np.array([r.prediction for r in placed.orderBy("id").collect()])
    inertia = sum(((points[assigned == k] - points[assigned == k].mean(axis=0)) ** 2).sum() for k in range(3))
    assert sweep[3].inertia == pytest.approx(inertia) and sweep[3].silhouette > sweep[2].silhouette
    _, pca, projected = cluster.projected(df)
    centred = points - points.mean(axis=0)
    values = np.linalg.svd(centred, full_matrices=False)[1]
    found = np.array([r.projected.toArray() for r in projected.orderBy("id").collect()])
    assert np.sqrt((found**2).sum(axis=0)) == pytest.approx(values[:2], rel=1e-6)


def test_importances_carry_names(spark, rows):
    fitted = prepare.pipeline(prepare.matrix_stages(["a", "b"], ["kind"]), train.forest(trees=5)).fit(rows)
    scored = fitted.transform(rows)
    table = evaluate.feature_weights(spark, scored, fitted.stages[-1].featureImportances.toArray()).collect()
    assert len(table) == 5 and table[0].weight >= table[-1].weight
    assert math.isclose(sum(r.weight for r in table), 1.0)


def test_forests_grow_their_trees_fully(spark):
    # like a chessboard: no tree of 32 leaves tells its 256 squares apart
    board = spark.createDataFrame([(float(a), float(b), (a + b) % 2) for a in range(16) for b in range(16)] * 4, "a double, b double, label int")
    fitted = prepare.pipeline(prepare.matrix_stages(["a", "b"], []), train.forest(trees=5)).fit(board)
    assert min(tree.depth for tree in fitted.stages[-1].trees) > 5
    assert fitted.transform(board).where("prediction <> label").count() < 26


def test_class_weights_balance(rows):
    weighted = prepare.with_class_weight(rows, "label", "id").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert weighted[0].w == pytest.approx(weighted[1].w)


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_checkpoint_folder_is_read_from_the_session():
    class Session:
        conf = _Conf({"spark.checkpoint.dir": "hdfs://shared/folder"})

    assert checkpoint_folder(Session()) == "hdfs://shared/folder"


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, score double")
    found = evaluate.ranking_quality(df, "label", "score").first()
    assert found.roc_auc is None and found.average_precision is None


def test_model_text_weights_are_those_of_the_table(spark):
    docs = spark.createDataFrame([(i, f"common word{i % 3} tail{i % 2} common") for i in range(12)], "id bigint, text string")
    fitted = prepare.pipeline(prepare.text_stages("text", min_df=1, max_df=12.0, max_features=20), train.linear()).getStages()[:-1]
    model = Pipeline(stages=fitted).fit(docs)
    terms = model.stages[2].vocabulary
    got = {(r.id, terms[i]): v for r in model.transform(docs).collect() for i, v in zip(r.text_vector.indices.tolist(), r.text_vector.values.tolist())}
    want = {(r.id, r.term): r.weight for r in prepare.text_weights(docs, "id", "text", min_df=1, max_df=1.0, max_features=20).collect()}
    assert got.keys() == want.keys() and any(term == "common" for _, term in got)
    for key in want:
        assert got[key] == pytest.approx(want[key])


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(min_rows=1, max_hot=1000)])
def test_label_codes_have_no_limit(spark, policy):
    values = spark.range(12_000).select(F.format_string("v%d", F.col("id") % 11_000).alias("name"))
    values = values.unionByName(spark.createDataFrame([(None,), ("",), ("v",), ("é",)], "name string"))
    got = prepare.label_codes(values, "name", policy=policy).collect()
    assert [r.name for r in sorted(got, key=lambda r: r.code)] == sorted({f"v{i}" for i in range(11_000)} | {"", "v", "é"})
    assert sorted(r.code for r in got) == list(range(11_003))


def test_missing_values_are_learned_exactly_and_kept(spark, tmp_path):
    rows = [(float(i % 7) if i % 5 else None, float("nan") if i % 4 == 0 else i / 3, "xyz"[i % 3] if i % 6 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, kind string")
    known = {"a": [a for a, _, _ in rows if a is not None], "b": [b for _, b, _ in rows if not math.isnan(b)]}
    for strategy, value in (("median", np.median), ("mean", np.mean)):
        fitted = prepare.FillMissing(inputCols=["a", "b"], outputCols=["fa", "fb"], strategy=strategy).fit(df)
        path = str(tmp_path / strategy)
        fitted.write().save(path)
        got = prepare.FilledMissing.load(path).transform(df).collect()
        for name, row in ((name, row) for name in ("a", "b") for row in got):
            missing = row[name] is None or math.isnan(row[name])
            assert row[f"f{name}"] == (pytest.approx(value(known[name]), rel=1e-12) if missing else row[name])
    mode = prepare.FillMissing(inputCols=["kind"], outputCols=["k"], strategy="mode").fit(df).transform(df)
    assert {row.k for row in mode.where("kind IS NULL").collect()} == {"y"} or mode.where("kind IS NULL").first().k == agg_mode(rows)
    constant = prepare.FillMissing(inputCols=["kind"], outputCols=["k"], strategy="constant", constants='["none"]').fit(df).transform(df)
    assert constant.where("kind IS NULL AND k <> 'none'").count() == 0
    # inside a pipeline: fitted on the training rows, saved, reloaded, the same on other rows
    pipeline = prepare.pipeline(prepare.matrix_stages(["a", "b"], [], impute="median"), train.linear("y"))
    made = pipeline.fit(df.withColumn("y", F.rand(1)))
    train.save(made, str(tmp_path / "pipeline"))
    again = train.reload(str(tmp_path / "pipeline"))
    assert [r.prediction for r in made.transform(df).collect()] == [r.prediction for r in again.transform(df).collect()]


def agg_mode(rows):
    kinds = [kind for _, _, kind in rows if kind]
    return min(set(kinds), key=lambda kind: (-kinds.count(kind), kind))


def plain_softmax(margins):
    raised = np.exp(margins - margins.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def test_two_rounds_of_softmax_boosting_by_hand(spark, tmp_path):
    x = np.array([0, 0, 0, 0, 1, 1, 1, 1, 1, 0])
    y = np.array([0, 0, 1, 2, 1, 1, 2, 2, 0, 0])
    df = spark.createDataFrame([(Vectors.dense([float(a)]), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"])
    fitted = train.SoftmaxBoosting(rounds=2, depth=1, rate=0.5).fit(df)
    margins = np.log(np.bincount(y) / 10)[None, :].repeat(10, axis=0)
    for _ in range(2):
        p = plain_softmax(margins)
        gradient, slope = np.eye(3)[y] - p, p * (1 - p) * 1.5
        step = np.zeros((10, 3))
        for leaf in (0, 1):  # a stump on the one column
            step[x == leaf] = gradient[x == leaf].sum(axis=0) / slope[x == leaf].sum(axis=0)
        margins = margins + 0.5 * step
    train.save(fitted, str(tmp_path / "boosting"))
    for model in (fitted, train.reload(str(tmp_path / "boosting"))):
        got = np.array([row.probabilities for row in train.with_probabilities(model.transform(df)).collect()])
        assert got == pytest.approx(plain_softmax(margins), rel=1e-9)
        assert got.sum(axis=1) == pytest.approx(1.0, rel=1e-12)


def test_softmax_boosting_lowers_its_loss(spark):
    draw = np.random.default_rng(11)
    x = draw.normal(size=(300, 4))
    y = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 0.5)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"]).cache()
    losses = []
    for rounds in (1, 2, 4, 9):
        scored = train.with_probabilities(train.SoftmaxBoosting(rounds=rounds).fit(df).transform(df))
        losses.append(scored.agg(-F.avg(F.log(F.get("probabilities", F.col("label").cast("int"))))).first()[0])
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.8
    # each tree keeps to its sample of columns, and splits only where it gains
    some = train.SoftmaxBoosting(rounds=3, columns=0.25, subsample=0.8).fit(df)
    for ensemble in some.stages[:-1]:
        assert all(len(np.flatnonzero(tree.featureImportances.toArray())) <= 1 for tree in ensemble.trees)
    none = train.SoftmaxBoosting(rounds=1, minGain=1e9).fit(df)
    assert all(tree.depth == 0 for ensemble in none.stages[:-1] for tree in ensemble.trees)


def test_softmax_is_worked_out_once_a_row(spark):
    margins = [[0.5, -1.0, 2.0], [3.0, 3.0, 3.0], [-700.0, 0.0, 700.0]]
    df = train.with_softmax(spark.createDataFrame([(m,) for m in margins], "m array<double>"), "m", 3, "p")
    assert df.columns == ["m", "p"]
    assert np.array([row.p for row in df.collect()]) == pytest.approx(plain_softmax(np.array(margins)), rel=1e-12)
    # no function over the array's elements, which Spark would run for every class
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_boosting_arguments_reach_the_trees(rows):
    model = train.boosted(rounds=200, depth=7, rate=0.05, columns=0.7, min_gain=0.2)
    assert (model.getMaxIter(), model.getMaxDepth(), model.getStepSize(), model.getMinInfoGain(), model.getFeatureSubsetStrategy()) == (200, 7, 0.05, 0.2, "0.7")


def test_families_are_searched_by_their_own_grids(rows):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    families = {
        "logistic": train.Family(lambda df, c: train.logistic(df, c), [{"c": c} for c in (0.001, 1.0)]),
        "forest": train.Family(lambda _, depth: train.forest(trees=6, depth=depth), [{"depth": d} for d in (1, 4)], (2, 6)),
        "boosted": train.Family(lambda _, rate: train.boosted(rounds=4, rate=rate), [{"rate": 0.2}], (1, 4)),
    }
    parts = prepare.stratified_split(rows, "label", ["id"], 0.3)
    fit_rows, test_rows = parts.where("is_test = 0"), parts.where("is_test = 1")
    found = train.search_families(fit_rows, ["id"], prepare.matrix_stages(["a", "b"], ["kind"]), families, BinaryClassificationEvaluator(), test_rows)
    assert [row[0] for row in found] == list(families) and all(0.5 < row[2] <= 1 and 0.5 < row[3] <= 1 for row in found)
    assert {row[1] for row in found} <= {"c=0.001", "c=1.0", *[f"depth={d}, trees={n}" for d in (1, 4) for n in (2, 6)], "rate=0.2, trees=1", "rate=0.2, trees=4"}


def test_families_fit_side_by_side_in_few_tasks(spark, monkeypatch):
    # 6,000 rows: dealt by the thousand, each fit would start six tasks a job
    x = spark.range(0, 6000, 1, 1).select("id", F.rand(3).alias("a")).withColumn("label", (F.col("a") + F.rand(4) > 1).cast("double"))
    at_once, tasks = [], []

    class Noted(train.ThreadPool):
        def __init__(self, n):
            at_once.append(n)
            super().__init__(n)

    monkeypatch.setattr(train, "ThreadPool", Noted)
    make = lambda df, c: tasks.append(df.rdd.getNumPartitions()) or train.logistic(df, c)
    families = {"logistic": train.Family(make, [{"c": 1.0}])}
    found = train.search_families(x, ["id"], prepare.matrix_stages(["a"]), families, BinaryClassificationEvaluator(), x, k=2)
    assert tasks == [1, 1, 1] and set(at_once) == {spark.sparkContext.defaultParallelism}
    assert found[0][:2] == ("logistic", "c=1.0") and 0.7 < found[0][2] < 1


def test_first_trees_are_the_smaller_ensemble(rows):
    prepared = prepare.Pipeline(stages=prepare.matrix_stages(["a", "b"], ["kind"])).fit(rows).transform(rows)
    large, small = (train.boosted(rounds=n).fit(prepared) for n in (6, 2))
    cut = train.first_trees(large, 2)
    scores = [[r.score for r in train.positive_score(m.transform(prepared)).orderBy("id").collect()] for m in (small, cut)]
    assert scores[0] == scores[1]


def test_forests_keep_each_rows_place_and_get_dealt_rows(spark):
    assert train.forest().getOrDefault("cacheNodeIds")
    many, few = spark.range(0, 6000, 1, 1), spark.range(0, 900, 1, 1)
    assert train.dealt(many).rdd.getNumPartitions() == min(6, spark.sparkContext.defaultParallelism)
    assert train.dealt(few).rdd.getNumPartitions() == 1
    assert sorted(r.id for r in train.dealt(many).collect()) == list(range(6000))


def test_cross_validation_prepares_once_per_fold(rows, monkeypatch):
    model = train.logistic().setMaxIter(4)
    estimator = prepare.pipeline(prepare.matrix_stages(["a", "b"], ["kind"]), model)
    options, judge = train.grid({model.regParam: [0.01, 10.0]}), BinaryClassificationEvaluator()
    expected = CrossValidator(estimator=estimator, estimatorParamMaps=options, evaluator=judge, numFolds=2, foldCol="fold").fit(train.folds(rows, ["id"], 2))
    fits, plain = [], prepare.FillMissing._fit
    monkeypatch.setattr(prepare.FillMissing, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    found = train.cross_validate(rows, ["id"], estimator, judge, 2, options)
    assert len(fits) == 3
    assert found.avgMetrics == pytest.approx(expected.avgMetrics) and found.stdMetrics == pytest.approx(expected.stdMetrics)
    assert found.bestModel.stages[-1].getRegParam() == expected.bestModel.stages[-1].getRegParam()
    assert found.bestModel.stages[-1].coefficients.toArray() == pytest.approx(expected.bestModel.stages[-1].coefficients.toArray())


def test_text_weights_add_up_the_rows_of_a_document(spark):
    data = [(1, "red red blue"), (1, "red green"), (1, None), (2, "blue green"), (3, ""), (4, "red"), (None, "red"), (5, "x y")]
    docs = spark.createDataFrame(data, "id bigint, text string")
    got = {(r.id, r.term): r.weight for r in prepare.text_weights(docs, "id", "text", min_df=1, max_df=1.0, max_features=2).collect()}
    # uses: red 4, blue 2, green 2; eight rows
    red, blue = 3 * (math.log(9 / 3) + 1), math.log(9 / 3) + 1
    length = math.hypot(red, blue)
    assert got == pytest.approx({(1, "red"): red / length, (1, "blue"): blue / length, (2, "blue"): 1.0, (4, "red"): 1.0})
    assert prepare.text_weights(docs, "id", "text", min_df=9).count() == 0


def test_neither_text_weights_nor_splits_move_the_texts(spark, tmp_path):
    spark.createDataFrame([(i, f"word{i % 3} other", float(i % 2)) for i in range(60)], "id bigint, text string, label double").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for made in (prepare.text_weights(docs, "id", "text"), prepare.stratified_split(docs, "label", ["id"], 0.3)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not any("Exchange hashpartitioning" in line for line in plan.splitlines())


def test_kept_places_grow_the_same_forest(rows):
    made = Pipeline(stages=prepare.matrix_stages(["a", "b"])).fit(rows).transform(rows).coalesce(1)
    kept, sent = train.forest(trees=4).fit(made), train.forest(trees=4).setCacheNodeIds(False).fit(made)
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in sent.trees]


@pytest.mark.parametrize(("parts", "weight", "min_gain"), [(5, "weight", 0.0), (1, None, 0.01)])
def test_blocks_boost_the_trees_that_spark_boosts(spark, parts, weight, min_gain):
    levels = F.element_at(F.array(*map(F.lit, "xyz")), (F.floor(F.rand(8) * 3) + 1).cast("int"))
    x = spark.range(0, 900, 1, parts).select("id", F.rand(3).alias("a"), F.floor(F.rand(5) * 7).cast("double").alias("b"), F.lit(1.0).alias("flat"), levels.alias("kind"))
    x = x.withColumn("label", (F.col("a") * F.col("b") + (F.col("kind") == "x").cast("int") + F.rand(4) > 2).cast("double")).withColumn("weight", 1.5 - F.col("label"))
    made = prepare.Pipeline(stages=prepare.matrix_stages(["a", "b", "flat"], ["kind"])).fit(x).transform(x).cache()
    options = {"rounds": 12, "weight": weight, "min_gain": min_gain}
    plain, blocks = train.boosted(**options).fit(made), train.boosted_in_blocks(**options).fit(made.repartition(parts + 3))
    was, now = ([(r.score, r.prediction) for r in train.positive_score(m.transform(made)).orderBy("id").collect()] for m in (plain, blocks))
    assert np.array(now) == pytest.approx(np.array(was), abs=1e-9) and len({score for score, _ in now}) > 20
    assert type(blocks) is type(plain) and blocks.treeWeights == plain.treeWeights and blocks.numFeatures == plain.numFeatures
    assert blocks.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=1e-9)


def test_blocks_refuse_what_spark_refuses(spark):
    for values in ([(1.0, None)], [(1.0, 2.0)], [(float("nan"), 1.0)]):
        df = spark.createDataFrame([(0.5, 0.0), *values], "a double, label double").withColumn("features", array_to_vector(F.array("a")))
        with pytest.raises(ValueError, match="labels"):
            train.boosted_in_blocks(rounds=2).fit(df)
    one_class = spark.createDataFrame([(0.5, 1.0), (0.7, 1.0)], "a double, label double").withColumn("features", array_to_vector(F.array("a")))
    assert {r.prediction for r in train.boosted_in_blocks(rounds=2).fit(one_class).transform(one_class).collect()} == {1.0}


def test_a_prepared_fit_is_the_pipelines_and_prepares_once(spark, monkeypatch):
    x = spark.range(0, 300, 1, 1).select("id", F.rand(3).alias("a"), F.rand(4).alias("b"))
    x = x.withColumn("label", (F.col("a") > F.col("b")).cast("double")).cache()
    stages, seen = prepare.matrix_stages(["a", "b"]), []
    plain = prepare.pipeline(stages, train.feed_forward(2)).fit(x)
    monkeypatch.setattr(train, "settle", lambda df, label, settle=train.settle: seen.append(df.columns) or settle(df, label))
    once = train.fit_prepared(x, stages, train.feed_forward(2))
    assert seen == [["label", "features"]] and len(once.stages) == len(plain.stages)
    assert once.stages[-1].weights.toArray() == pytest.approx(plain.stages[-1].weights.toArray(), rel=1e-9)


def test_the_models_of_large_tables_are_fitted_to_prepared_rows(spark, folder, monkeypatch):
    from tidemark.plans import PLANS

    read = []

    class Stop(Exception):
        pass

    def noted(self, df, params=None):
        read.append(df.inputFiles())
        raise Stop

    monkeypatch.setattr(type(train.feed_forward(2)), "fit", noted)
    monkeypatch.setattr(train.BlockBoosting, "fit", noted)
    for name in ("m24_feed_forward", "clicks_in_time_order_to_model"):
        with pytest.raises(Stop):
            PLANS[name].build(spark, folder)
    assert len(read) == 2 and all(files and all("/prepared-" in f for f in files) for files in read)


@pytest.fixture(scope="module")
def many(spark):
    levels = F.element_at(F.array(*map(F.lit, "xyz")), (F.floor(F.rand(8) * 3) + 1).cast("int"))
    x = spark.range(0, 900, 1, 5).select("id", F.rand(3).alias("a"), F.floor(F.rand(5) * 7).cast("double").alias("b"), F.lit(1.0).alias("flat"), levels.alias("kind"))
    score = F.col("a") * F.col("b") + (F.col("kind") == "x").cast("int") + F.rand(4)
    x = x.withColumns({"label": (score > 2).cast("double"), "tier": (score > 2).cast("double") + (score > 3.5).cast("double")}).withColumn("weight", 1.5 - F.col("label"))
    return prepare.Pipeline(stages=prepare.matrix_stages(["a", "b", "flat"], ["kind"])).fit(x).transform(x).cache()


def voted(model, df):
    rows = train.with_probabilities(model.transform(df)).orderBy("id").collect()
    return np.array([r.probabilities for r in rows]), [r.prediction for r in rows]


@pytest.mark.parametrize(("label", "weight", "depth"), [("label", "weight", 30), ("tier", None, 30), ("tier", "weight", 4)])
def test_a_tree_in_blocks_is_the_tree_that_spark_grows(many, monkeypatch, label, weight, depth):
    from pyspark.ml.classification import DecisionTreeClassifier

    from tidemark.models import forest

    # every row once; one tree tries all columns
    monkeypatch.setattr(forest.Grower, "drawn", lambda self, tree, block, n: np.ones(n, np.uint8))
    plain = DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=42)
    plain = (plain.setWeightCol(weight) if weight else plain).fit(many)
    (was, called), importances = voted(plain, many), plain.featureImportances.toArray()
    # grown whole, and below a top from parts of at most 90 rows
    for unit in (10_000, 90):
        model = forest.BlockForest(labelCol=label, weightCol=weight or "", trees=1, depth=depth, plain=0, unit=unit).fit(many.repartition(3))
        (now, called_now), about = voted(model, many), model.about
        assert now == pytest.approx(was, abs=1e-9) and called_now == called
        # among rows of two kinds their columns split alike, and rounding chooses
        merged, merged_now = (np.append(found[:3], found[3:].sum()) for found in (importances, model.featureImportances.toArray()))
        assert merged_now == pytest.approx(merged, abs=1e-9)
        assert bool(about["tops"]) == (unit < 900) and len({round(p, 9) for p in was[:, 0]}) > 5


def test_forests_in_blocks_do_not_depend_on_how_they_are_grown(many, tmp_path, monkeypatch):
    from tidemark.models import forest

    made = many.coalesce(1)
    whole, parts = (forest.BlockForest(labelCol="tier", trees=9, plain=0, unit=unit).fit(made) for unit in (10_000, 150))
    (was, called), (now, called_now) = voted(whole, many), voted(parts, many)
    assert now == pytest.approx(was, abs=1e-12) and called_now == called and was.sum(axis=1) == pytest.approx(1.0)
    assert parts.featureImportances.toArray() == pytest.approx(whole.featureImportances.toArray()) and whole.featureImportances.toArray().sum() == pytest.approx(1.0)
    # several tasks grow, and several score some trees and some rows each
    for name, value in (("GROWN_PER_TASK", 2000), ("SCORED_PER_TASK", 2000), ("SCORED_ROWS", 300), ("TREE_BYTES", 3000)):
        monkeypatch.setattr(forest, name, value)
    monkeypatch.setattr("tidemark.models.blocks.BLOCK", 100)
    for model in (whole, forest.BlockForest(labelCol="tier", trees=9, plain=0).fit(made)):
        assert voted(model, many)[0] == pytest.approx(was, abs=0.5) and len(voted(model, many)[0]) == 900
    assert voted(whole, many)[0] == pytest.approx(was, abs=1e-12)
    # the first trees are the forest of so many trees; a saved one is the same
    monkeypatch.undo()
    few = forest.BlockForest(labelCol="tier", trees=3, plain=0).fit(made)
    assert voted(train.first_trees(parts, 3), many)[0] == pytest.approx(voted(few, many)[0], abs=1e-12)
    train.save(Pipeline(stages=[parts]).fit(many), str(tmp_path / "forest"))
    assert voted(train.reload(str(tmp_path / "forest")).stages[0], many)[0] == pytest.approx(now, abs=1e-12)


def test_forests_in_blocks_rank_as_sparks_do(spark):
    x = spark.range(0, 6000, 1, 3).select("id", *[F.rand(i).alias(f"x{i}") for i in range(6)])
    x = x.withColumn("label", (F.col("x0") + F.col("x1") * F.col("x2") + F.rand(9) > 1.2).cast("double"))
    made = prepare.Pipeline(stages=prepare.matrix_stages([f"x{i}" for i in range(6)])).fit(x).transform(x)
    fit_rows, test_rows = made.where("id % 3 > 0").cache(), made.where("id % 3 = 0").cache()
    judge = BinaryClassificationEvaluator()
    plain, blocks = train.forest(trees=40).fit(fit_rows), train.BlockForest(trees=40, plain=0).fit(fit_rows)
    assert judge.evaluate(blocks.transform(test_rows)) == pytest.approx(judge.evaluate(plain.transform(test_rows)), abs=0.015)
    assert blocks.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=0.02)
    # what the driver holds of the trees does not grow with their nodes
    nodes = spark.read.parquet(blocks.about["path"]).agg(F.sum(F.length("cuts"))).first()[0]
    assert nodes > 10_000 and len(blocks.about["units"]) == 40 and not blocks.about["tops"]


def test_small_tables_get_sparks_own_forest(many):
    plain, small = train.forest("tier", trees=3).fit(many), train.forest_in_blocks("tier", trees=3).fit(many)
    assert type(small) is type(plain) and [t.toDebugString.split("\n", 1)[1] for t in small.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]


@pytest.mark.parametrize("name", ["m20_class_cross_validation", "m15_random_forest", "m31_feature_importances", "m23_weighted_forest"])
def test_forests_of_large_tables_are_grown_in_blocks(spark, folder, monkeypatch, name):
    from tidemark.plans import PLANS

    class Stop(Exception):
        pass

    def stopped(self, df, params=None):
        raise Stop

    monkeypatch.setattr(train.BlockForest, "fit", stopped)
    with pytest.raises(Stop):
        PLANS[name].build(spark, folder)


def test_one_task_boosts_small_tables_as_many_tasks_do(many, monkeypatch):
    from tidemark.models import blocks

    made, jobs, plain = many.coalesce(2), [], blocks._boosted_apart
    monkeypatch.setattr(blocks, "_boosted_apart", lambda *a: jobs.append(1) or plain(*a))
    alone = train.boosted_in_blocks(rounds=12, weight="weight").fit(made)
    assert not jobs
    monkeypatch.setattr(blocks, "ALONE", 0)
    apart = train.boosted_in_blocks(rounds=12, weight="weight").fit(made)
    assert jobs and voted(alone, many)[0] == pytest.approx(voted(apart, many)[0], abs=1e-12)
    assert alone.featureImportances.toArray() == pytest.approx(apart.featureImportances.toArray(), abs=1e-12)
    # no Python model of any tree is made unless asked for
    cut = train.first_trees(alone, 5)
    assert "trees" not in alone.__dict__ and "trees" not in cut.__dict__
    assert (len(alone.trees), len(cut.trees), cut.getStepSize()) == (12, 5, alone.getStepSize())


def test_the_families_trees_are_grown_in_blocks(spark, folder, monkeypatch):
    from tidemark.plans import PLANS

    seen = {}

    def noted(df, ids, stages, families, *rest):
        seen.update({name: [family.make(df, **setting) for setting in family.settings] for name, family in families.items()})
        seen["sizes"] = {name: family.sizes for name, family in families.items()}
        return [("logistic", "c=1.0", 0.5, 0.5)]

    monkeypatch.setattr(train, "search_families", noted)
    assert PLANS["m21_model_families"].build(spark, folder).count() == 1
    assert [type(m) for m in seen["forest"] + seen["boosted"]] == [train.BlockForest] * 3 + [train.BlockBoosting] * 3
    assert [m.getOrDefault("depth") for m in seen["forest"]] == [5, 10, 30] and {m.getOrDefault("trees") for m in seen["forest"]} == {200}
    assert {m.getOrDefault("weightCol") for m in seen["forest"]} == {"weight"} and {m.getOrDefault("rounds") for m in seen["boosted"]} == {200}
    assert [m.getOrDefault("rate") for m in seen["boosted"]] == [0.01, 0.1, 0.2] and seen["sizes"] == {"logistic": (), "forest": (50, 100, 200), "boosted": (50, 100, 200)}
