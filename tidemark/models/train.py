"""Estimators with the defaults the workload uses, tuning, scoring and saving."""

from __future__ import annotations

import math
import random
import statistics
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.models.blocks import BlockBoosting, wrapped
from tidemark.models.forest import BlockForest, BlockForestModel
from tidemark.models.prepare import draw
from tidemark.skew import settle

SEED = 42
#: The deepest trees that Spark grows; the workload's forests have no limit.
DEEPEST = 30


def linear(label: str = "label") -> LinearRegression:
    return LinearRegression(labelCol=label, solver="normal")


def ridge(alpha: float, train: DataFrame, label: str = "label") -> LinearRegression:
    """Minimises the summed squared error plus alpha × squared coefficients.

    Spark divides its penalty by the rows and by the label's deviation, so both are multiplied back in.
    """
    size = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("deviation")).first()
    penalty = alpha * (size["deviation"] or 1.0) / max(size["n"], 1)
    return LinearRegression(labelCol=label, regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal")


def logistic(
    train: DataFrame | None = None, c: float = 1.0, label: str = "label", weight: str | None = None
) -> LogisticRegression:
    """Logistic regression; with training rows, an L2 penalty of strength c over the whole data set."""
    model = LogisticRegression(labelCol=label, maxIter=100, elasticNetParam=0.0, standardization=False)
    if train is not None:
        model = model.setRegParam(1.0 / (c * max(train.count(), 1)))
    return model.setWeightCol(weight) if weight else model


def forest(label: str = "label", trees: int = 100, depth: int = DEEPEST, weight: str | None = None) -> RandomForestClassifier:
    """Trees grown until their leaves are pure or can't be split, or are ``depth`` levels down.

    Each row's place in each tree is kept beside it; otherwise Spark sends all that has grown of all trees to the tasks for every level.
    """
    model = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=1, cacheNodeIds=True, seed=SEED)
    return model.setWeightCol(weight) if weight else model


def forest_in_blocks(label: str = "label", trees: int = 100, depth: int = DEEPEST, weight: str | None = None) -> BlockForest:
    """``forest`` for tables of any number of rows: its trees are neither grown nor held by the driver."""
    return BlockForest(labelCol=label, trees=trees, depth=depth, weightCol=weight or "", seed=SEED)


def boosted(
    label: str = "label", rounds: int = 100, depth: int = 3, rate: float = 0.1, subsample: float = 1.0, weight: str | None = None,
    columns: float = 1.0, min_gain: float = 0.0,
) -> GBTClassifier:
    """Binary boosting. ``columns`` is the share of the columns tried at each split, ``min_gain`` the least decrease of impurity that splits a node."""
    model = GBTClassifier(
        labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, minInfoGain=min_gain,
        featureSubsetStrategy="all" if columns >= 1 else str(columns), seed=SEED,
    )
    return model.setWeightCol(weight) if weight else model


def boosted_in_blocks(
    label: str = "label", rounds: int = 100, depth: int = 3, rate: float = 0.1, weight: str | None = None, min_gain: float = 0.0
) -> BlockBoosting:
    """``boosted`` on all rows and columns, for tables of many rows: the same trees, in a fraction of the time a row."""
    return BlockBoosting(labelCol=label, rounds=rounds, depth=depth, rate=rate, minGain=min_gain, weightCol=weight or "", seed=SEED)


class Softmax(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Class probabilities and the likeliest class (ties to the smallest) from one margin column per class, after adding each class's base."""

    inputCols = Param(Params._dummy(), "inputCols", "margin columns", TypeConverters.toListString)
    bases = Param(Params._dummy(), "bases", "what is added to each margin", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), bases: Sequence[float] = ()):
        super().__init__()
        self._setDefault(inputCols=[], bases=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        named = zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.bases), strict=True)
        margins = F.array(*[F.col(name) + F.lit(base) for name, base in named])
        with_margins = df.withColumn("_tm_margins", margins)
        scored = with_softmax(with_margins, "_tm_margins", len(self.getOrDefault(self.bases)), "_tm_p")
        best = F.array_position("_tm_p", F.array_max("_tm_p")) - 1
        made = {"rawPrediction": array_to_vector("_tm_margins"), "probability": array_to_vector("_tm_p"), "prediction": best.cast("double")}
        return scored.withColumns(made).drop("_tm_margins", "_tm_p", *self.getOrDefault(self.inputCols))


def with_softmax(df: DataFrame, margins: str, classes: int, name: str) -> DataFrame:
    """Class probabilities from an array of margins; each step is a column, as Spark would work a step within a lambda out again for every class."""
    top = df.withColumn("_tm_top", F.array_max(margins))
    raised = top.withColumn("_tm_raised", F.array(*[F.exp(F.col(margins)[k] - F.col("_tm_top")) for k in range(classes)]))
    whole = raised.withColumn("_tm_whole", sum((F.col("_tm_raised")[k] for k in range(classes)), F.lit(0.0)))
    shares = F.array(*[F.col("_tm_raised")[k] / F.col("_tm_whole") for k in range(classes)])
    return whole.withColumn(name, shares).drop("_tm_top", "_tm_raised", "_tm_whole")


class SoftmaxBoosting(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Multi-class boosting: in every round one Spark regression tree per class, all on the gradients of one softmax.

    A tree is fitted to (label - p) / h with weights h, where h = p (1 - p) K / (K - 1), so its leaves hold the sum of the
    gradients over the sum of h, the Newton step. Margins start at the logarithms of the class shares. ``columns`` is the
    share of the columns that each tree may use, ``subsample`` the share of the rows, ``minGain`` the least decrease of a
    node's weighted variance. Fitting returns a pipeline of one Spark ensemble per class and ``Softmax``.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class numbers from 0", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weights, if any", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "trees per class", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of each step taken", TypeConverters.toFloat)
    columns = Param(Params._dummy(), "columns", "share of the columns per tree", TypeConverters.toFloat)
    subsample = Param(Params._dummy(), "subsample", "share of the rows per round", TypeConverters.toFloat)
    minGain = Param(Params._dummy(), "minGain", "least gain of a split", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the samples", TypeConverters.toInt)

    #: Rounds after which the margins are written to the shared folder, which cuts their lineage.
    SETTLED = 8

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", weightCol: str = "", rounds: int = 100, depth: int = 3, rate: float = 0.1,
        columns: float = 1.0, subsample: float = 1.0, minGain: float = 0.0, seed: int = SEED,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", weightCol="", rounds=100, depth=3, rate=0.1, columns=1.0, subsample=1.0, minGain=0.0, seed=SEED)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        get = {param.name: self.getOrDefault(param) for param in self.params}
        weight = F.col(get["weightCol"]).cast("double") if get["weightCol"] else F.lit(1.0)
        rows = df.select(F.col(get["featuresCol"]).alias("features"), F.col(get["labelCol"]).cast("int").alias("class"), weight.alias("weight"))
        shares = {row["class"]: row["w"] for row in rows.groupBy("class").agg(F.sum("weight").alias("w")).collect()}
        classes = max(shares) + 1
        if classes < 2:
            raise ValueError("boosting needs at least two classes")
        bases = [math.log(max(shares.get(k, 0.0), 1e-12) / sum(shares.values())) for k in range(classes)]
        # a tree reads its rows several times, so the probabilities are kept beside the margins
        work = held = settle(with_softmax(rows.withColumn("margins", F.array(*[F.lit(b) for b in bases])), "margins", classes, "p"), "boosting").persist()
        width = work.first()["features"].size
        steps: list[list] = [[] for _ in range(classes)]
        pool = ThreadPool(min(classes, 8))
        for turn in range(get["rounds"]):
            chance = get["seed"] + turn
            p = work
            if get["subsample"] < 1:
                p = p.where(F.rand(get["seed"] + turn) < get["subsample"])

            def grown(k: int, p=p, chance=chance):
                slope = F.greatest(F.col("p")[k] * (1 - F.col("p")[k]) * (classes / (classes - 1)), F.lit(1e-9))
                aim = F.when(F.col("class") == k, 1.0).otherwise(0.0) - F.col("p")[k]
                fitted_to = p.select("features", (aim / slope).alias("target"), (slope * F.col("weight")).alias("by"))
                used = "features"
                if get["columns"] < 1:
                    chosen = set(random.Random(f"{chance}-{k}").sample(range(width), max(1, round(get["columns"] * width))))
                    mask = Vectors.dense([1.0 if i in chosen else 0.0 for i in range(width)])
                    # a column of zeros is never split, and the others keep their places
                    fitted_to, used = ElementwiseProduct(scalingVec=mask, inputCol="features", outputCol="masked").transform(fitted_to), "masked"
                tree = DecisionTreeRegressor(featuresCol=used, labelCol="target", weightCol="by", maxDepth=get["depth"], minInfoGain=get["minGain"], seed=get["seed"])
                return tree.fit(fitted_to).setFeaturesCol("features")

            # the classes' trees don't depend on one another
            for k, tree in enumerate(pool.map(grown, range(classes))):
                steps[k].append(tree)
            moved = work
            for k in range(classes):
                moved = steps[k][-1].setPredictionCol(f"step{k}").transform(moved)
            margins = F.array(*[F.col("margins")[k] + get["rate"] * F.col(f"step{k}") for k in range(classes)])
            moved = with_softmax(moved.select("features", "class", "weight", margins.alias("margins")), "margins", classes, "p")
            last = held
            work = held = (settle(moved, "boosting") if (turn + 1) % self.SETTLED == 0 else moved).persist()
            held.count()
            last.unpersist()
        pool.close()
        held.unpersist()
        names = [f"_tm_margin{k}" for k in range(classes)]
        return PipelineModel([*[ensemble(trees, get["rate"], get["featuresCol"], name) for trees, name in zip(steps, names, strict=True)], Softmax(inputCols=names, bases=bases)])


def ensemble(trees: list, rate: float, features: str, prediction: str) -> GBTRegressionModel:
    """Spark's own model of a weighted sum of fitted trees."""
    context = SparkContext.getOrCreate()
    gateway = context._gateway
    held = gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(context._jvm.double, len(trees))
    for i, tree in enumerate(trees):
        held[i], weights[i] = tree._java_obj, rate
    made = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"gbtr_{uuid.uuid4().hex[:12]}", held, weights)
    return GBTRegressionModel(made).setFeaturesCol(features).setPredictionCol(prediction)


def boosted_classes(label: str = "label", rounds: int = 100, depth: int = 3, weight: str | None = None, **options) -> SoftmaxBoosting:
    """Multi-class boosting on one softmax."""
    return SoftmaxBoosting(labelCol=label, rounds=rounds, depth=depth, weightCol=weight or "", **options)


def boosted_regressor(label: str = "label", rounds: int = 100, depth: int = 3, rate: float = 0.1) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED)


def feed_forward(inputs: int, label: str = "label", hidden: Sequence[int] = (32, 16), classes: int = 2):
    return MultilayerPerceptronClassifier(labelCol=label, layers=[inputs, *hidden, classes], maxIter=100, seed=SEED)


def with_probabilities(scored: DataFrame, name: str = "probabilities") -> DataFrame:
    """Class probabilities as an array."""
    return scored.withColumn(name, vector_to_array("probability"))


def positive_score(scored: DataFrame, name: str = "score") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1])


def folds(df: DataFrame, ids: Sequence[str], k: int, seed: int = SEED) -> DataFrame:
    """A fold number per row from its id, so folds survive retries and are the same in every run."""
    return df.withColumn("fold", F.floor(draw(ids, seed) * k).cast("int"))


def cross_validate(df: DataFrame, ids: Sequence[str], estimator, evaluator, k: int = 5, grid=None, parallelism: int = 2) -> CrossValidatorModel:
    """Fitted CrossValidatorModel; avgMetrics and stdMetrics hold one value per grid point.

    Of a pipeline whose grid concerns its last stage alone, the stages before it are fitted once for each fold, not for each grid point too.
    """
    options = list(grid or [{}])
    numbered = settle(dealt(folds(df, ids, k)), "folds")
    stages = list(estimator.getStages()) if isinstance(estimator, Pipeline) else [estimator]
    last = stages.pop()
    if any(param.parent != last.uid for setting in options for param in setting):
        return CrossValidator(estimator=estimator, estimatorParamMaps=options, evaluator=evaluator, numFolds=k, foldCol="fold", parallelism=parallelism).fit(numbered)
    parts = []
    for fold in range(k):
        made = _needed(Pipeline(stages=stages).fit(numbered.where(F.col("fold") != fold)).transform(numbered), df.columns, last, evaluator)
        parts.append(settle(made, "fold") if stages else made)

    def judged(task: tuple[int, dict]) -> float:
        fold, setting = task
        # not cached: Spark's estimators cache their own form of the rows
        model = last.fit(parts[fold].where(F.col("fold") != fold), setting)
        return evaluator.evaluate(model.transform(parts[fold].where(F.col("fold") == fold)))

    with ThreadPool(parallelism) as pool:
        found = pool.map(judged, [(fold, setting) for fold in range(k) for setting in options], chunksize=1)
    scores = [[found[fold * len(options) + i] for fold in range(k)] for i in range(len(options))]
    means = [statistics.fmean(values) for values in scores]
    best = (max if evaluator.isLargerBetter() else min)(range(len(options)), key=means.__getitem__)
    whole = Pipeline(stages=stages).fit(numbered)
    model = last.fit(whole.transform(numbered), options[best])
    chosen = PipelineModel([*whole.stages, model]) if isinstance(estimator, Pipeline) else model
    return CrossValidatorModel(chosen, means, None, [statistics.pstdev(values) for values in scores])


def _needed(df: DataFrame, given: Sequence[str], estimator, evaluator) -> DataFrame:
    """The fold, and the columns that the estimator or the evaluator names."""
    named = {each.getOrDefault(param) for each in (estimator, evaluator) for param in each.params if param.name.endswith("Col") and each.isDefined(param)}
    return df.select("fold", *[name for name in df.columns if name in named and name != "fold"])


#: Rows that are worth a task of their own when models are fitted.
ROWS_PER_TASK = 1000
#: The same where many models are fitted at a time: fits side by side fill the cores, and more tasks only cost their start.
ROWS_PER_SHARED_TASK = 4000


def dealt(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt evenly over as many tasks as run at once: Spark ML works in the tasks that its rows come in, and small files are read by one."""
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def fit_prepared(rows: DataFrame, stages: Sequence, model: Estimator) -> PipelineModel:
    """The fitted pipeline of ``stages`` and ``model``, whose rows are prepared once and settled.

    A model's fit goes over its rows several times, and that of a pipeline would prepare them again each time.
    """
    made = Pipeline(stages=list(stages)).fit(rows)
    named = {model.getOrDefault(param) for param in model.params if param.name.endswith("Col") and model.isDefined(param)}
    ready = made.transform(rows)
    return PipelineModel([*made.stages, model.fit(settle(ready.select(*[name for name in ready.columns if name in named]), "prepared"))])


@dataclass(frozen=True)
class Family:
    """A kind of model with the settings to try: ``make`` builds an estimator from one of them.

    Where ``sizes`` is given the estimator is a Spark ensemble of the largest size, and each setting is also judged with only
    its first trees: boosting adds its trees one after the other, and a forest's first trees are a smaller forest.
    """

    make: Callable[..., Estimator]
    settings: Sequence[dict]
    sizes: Sequence[int] = ()


def first_trees(model, n: int):
    """A fitted classifier of trees with only its first n."""
    if isinstance(model, BlockForestModel):
        return model.first(n)
    context = SparkContext.getOrCreate()
    java = model._java_obj
    trees = context._gateway.new_array(getattr(context._jvm, java.trees()[0].getClass().getName()), n)
    for i in range(n):
        trees[i] = java.trees()[i]
    uid = f"{java.uid()}_{n}"
    if hasattr(model, "getStepSize"):
        weights = context._gateway.new_array(context._jvm.double, n)
        for i in range(n):
            weights[i] = java.treeWeights()[i]
        made = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, trees, weights)
    else:
        made = context._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(uid, trees, java.numFeatures(), java.numClasses())
    java.extractParamMap()
    return wrapped(type(model), java.copyValues(made, context._jvm.org.apache.spark.ml.param.ParamMap.empty()))


def search_families(
    df: DataFrame, ids: Sequence[str], stages: Sequence, families: dict[str, Family], evaluator, test: DataFrame, k: int = 3, parallelism: int | None = None
) -> list[tuple[str, str, float, float]]:
    """For each family (name, best setting, its mean score over the folds, score on the test rows).

    All families share one assignment to folds and the preparation fitted in each; the best setting, the first of
    equals, is fitted again to all rows. Fits run ``parallelism`` at a time, or as many as have tasks for all cores, but four at least.
    """
    numbered = settle(dealt(folds(df, ids, k), ROWS_PER_SHARED_TASK), "folds")
    parallelism = parallelism or max(4, df.sparkSession.sparkContext.defaultParallelism // max(1, numbered.rdd.getNumPartitions()))
    parts = []
    for fold in range(k):
        prepared = Pipeline(stages=list(stages)).fit(numbered.where(F.col("fold") != fold))
        made = settle(prepared.transform(numbered), "fold")
        parts.append((made.where(F.col("fold") != fold).cache(), made.where(F.col("fold") == fold).cache()))
    whole = Pipeline(stages=list(stages)).fit(df)
    train_rows, test_rows = settle(whole.transform(dealt(df, ROWS_PER_SHARED_TASK)), "train").cache(), settle(whole.transform(test), "test").cache()

    def judged(family: Family, setting: dict, fit_rows: DataFrame, score_rows: DataFrame) -> list[tuple[str, float]]:
        model = family.make(fit_rows, **setting).fit(fit_rows)
        sizes = [(n, first_trees(model, n)) for n in family.sizes] or [(None, model)]
        return [(_spelled(setting, n), evaluator.evaluate(m.transform(score_rows))) for n, m in sizes]

    # the longest fits first, so that none is left to run alone, and the families by turns: what one's driver does and the other's tasks do overlap
    by_family = [[(name, setting, part) for setting in family.settings for part in parts] for name, family in families.items()]
    turns = sorted((not families[task[0]].sizes, turn, i) for i, some in enumerate(by_family) for turn, task in enumerate(some))
    tasks = [by_family[i][turn] for _, turn, i in turns]
    with ThreadPool(parallelism) as pool:
        found = pool.map(lambda task: judged(families[task[0]], task[1], *task[2]), tasks, chunksize=1)
    scores: dict[str, dict[str, list[float]]] = {name: {} for name in families}
    for (name, _, _), results in zip(tasks, found, strict=True):
        for spelled, score in results:
            scores[name].setdefault(spelled, []).append(score)

    def settled(name: str) -> tuple[str, str, float, float]:
        means = {spelled: sum(values) / len(values) for spelled, values in scores[name].items()}
        best = max(means, key=means.get)
        setting = next(s for s in families[name].settings for n in (families[name].sizes or [None]) if _spelled(s, n) == best)
        return name, best, means[best], dict(judged(families[name], setting, train_rows, test_rows))[best]

    with ThreadPool(parallelism) as pool:
        rows = pool.map(settled, list(scores), chunksize=1)
    for held in (train_rows, test_rows, *[side for part in parts for side in part]):
        held.unpersist()
    return rows


def _spelled(setting: dict, size: int | None) -> str:
    return ", ".join(f"{name}={value}" for name, value in (setting | ({} if size is None else {"trees": size})).items())


def grid(options: dict) -> list[dict]:
    builder = ParamGridBuilder()
    for param, values in options.items():
        builder = builder.addGrid(param, list(values))
    return builder.build()


def log_uniform_grid(param, low: float, high: float, n: int, seed: int = SEED) -> list[dict]:
    """n parameter maps with values drawn evenly on a logarithmic scale."""
    rng = random.Random(seed)
    return [{param: math.exp(rng.uniform(math.log(low), math.log(high)))} for _ in range(n)]


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def reload(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def compare(named: dict[str, Pipeline], train: DataFrame, test: DataFrame, measure) -> DataFrame:
    """Fit each pipeline on the same rows and stack the measured results."""
    results = [measure(p.fit(train).transform(test)).select(F.lit(name).alias("pipeline"), "*") for name, p in named.items()]
    stacked = results[0]
    for part in results[1:]:
        stacked = stacked.unionByName(part)
    return stacked
