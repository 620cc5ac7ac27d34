"""Quality measures as DataFrames over a scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import Past, running_features
from tidemark.skew import DEFAULT, SkewPolicy


def confusion_counts(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(scored: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    table = scored.groupBy(F.col(label).alias("actual")).pivot(prediction, list(classes)).agg(F.count(F.lit(1))).na.fill(0)
    return table.select("actual", *[F.col(f"`{c}`").alias(f"predicted_{c}") for c in classes])


def class_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages and accuracy."""
    counts = confusion_counts(scored, label, prediction)
    hits = F.col("actual") == F.col("predicted")
    both = F.array(
        F.struct(
            F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"),
            F.when(hits, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("right"),
        ),
        F.struct(
            F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"),
            F.lit(0).cast("bigint").alias("right"),
        ),
    )
    sums = (
        counts.select(F.inline(both))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("right").alias("right"))
    )
    precision = F.coalesce(F.col("right") / F.nullif(F.col("called"), F.lit(0)), F.lit(0.0))
    recall = F.coalesce(F.col("right") / F.nullif(F.col("support"), F.lit(0)), F.lit(0.0))
    f1 = F.coalesce(2.0 * F.col("right") / F.nullif(F.col("support") + F.col("called"), F.lit(0)), F.lit(0.0))
    per_class = sums.select(F.col("class").cast("string").alias("class"), "support", precision.alias("precision"),
                            recall.alias("recall"), f1.alias("f1"), "right")
    measures = ["precision", "recall", "f1"]
    weighted = [(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures]
    accuracy = F.sum("right") / F.sum("support")
    macro_row = per_class.agg(F.sum("support").alias("support"), *[F.avg(m).alias(m) for m in measures])
    weighted_row = per_class.agg(F.sum("support").alias("support"), *weighted)
    accuracy_row = per_class.agg(F.sum("support").alias("support"), *[accuracy.alias(m) for m in measures])
    out = per_class.drop("right")
    for name, row in (("macro avg", macro_row), ("weighted avg", weighted_row), ("accuracy", accuracy_row)):
        out = out.unionByName(row.withColumn("class", F.lit(name)))
    return out


def _score_steps(scored: DataFrame, label: str, score: str, policy: SkewPolicy) -> DataFrame:
    """Per distinct score, from the highest: positives and negatives at or above it, and totals."""
    per_score = scored.groupBy((-F.col(score)).alias("_tm_desc")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum(1 - F.col(label).cast("bigint")).alias("neg")
    )
    features = [Past("tp", "sum", F.col("pos"), 0), Past("fp", "sum", F.col("neg"), 0)]
    cells = F.floor(F.col("_tm_desc") * (1 << 20))
    steps = running_features(per_score, [], "_tm_desc", [], features, current_row=True, slice_by=cells, policy=policy)
    totals = scored.agg(
        F.struct(
            F.sum(F.col(label).cast("double")).alias("p"), F.sum(1 - F.col(label).cast("double")).alias("n")
        )
    ).scalar()
    return steps.select(
        (-F.col("_tm_desc")).alias("threshold"), "pos", "neg", "tp", "fp", totals["p"].alias("p"), totals["n"].alias("n")
    )


def roc_points(scored: DataFrame, label: str, score: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    steps = _score_steps(scored, label, score, policy)
    fpr, tpr = (F.col(a) / F.nullif(F.col(b), F.lit(0.0)) for a, b in (("fp", "n"), ("tp", "p")))
    return steps.select("threshold", fpr.alias("fpr"), tpr.alias("tpr"))


def ranking_quality(scored: DataFrame, label: str, score: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Exact ROC AUC (tied scores count half) and average precision, one row; null where a class is missing."""
    steps = _score_steps(scored, label, score, policy)
    above = F.col("tp") - F.col("pos")
    pairs = F.col("neg") * (above + F.col("pos") / 2.0)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return steps.agg(
        (F.sum(pairs) / F.nullif(F.first(F.col("p") * F.col("n")), F.lit(0.0))).alias("roc_auc"),
        (F.sum(precision * F.col("pos")) / F.nullif(F.first("p"), F.lit(0.0))).alias("average_precision"),
    )


def calibration(scored: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score against the observed rate, in equal-width score bins."""
    cell = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(cell.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("rate")
    )


def log_loss(label: str, score: str, floor: float = 1e-15) -> Column:
    p = F.greatest(F.lit(floor), F.least(F.lit(1 - floor), F.col(score)))
    return F.avg(-F.log(F.when(F.col(label) == 1, p).otherwise(1 - p)))


def regression_quality(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE, MSE and R², one pass."""
    error = F.col(label) - F.col(prediction)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        (1 - F.avg(error * error) / F.nullif(F.var_pop(label), F.lit(0.0))).alias("r2"),
    )


def class_f1(label: str, prediction: str, positive) -> Column:
    actual, called = F.col(label) == positive, F.col(prediction) == positive
    right = F.count_if(actual & called)
    return F.coalesce(2.0 * right / F.nullif(F.count_if(actual) + F.count_if(called), F.lit(0)), F.lit(0.0))


def minority_f1(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 of the rarest class (ties to the smallest), one row."""
    rarest = scored.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy("n", label).limit(1).select(label).scalar()
    marked = scored.withColumn("_tm_rarest", rarest)
    return marked.agg(class_f1(label, prediction, F.col("_tm_rarest")).alias("f1"))


class MinorityF1(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """F1 of the rarest class, for use in cross-validation."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        label, prediction = self.getLabelCol(), self.getPredictionCol()
        return minority_f1(dataset, label, prediction).first()["f1"]

    def isLargerBetter(self) -> bool:
        return True


def feature_weights(spark, scored: DataFrame, values: Sequence[float], features: str = "features") -> DataFrame:
    """Importances or coefficients with their column names, largest magnitude first."""
    attributes = scored.schema[features].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for kind in attributes.values() for a in kind)
    rows = [(name, float(values[i])) for i, name in named]
    return spark.createDataFrame(rows, "feature string, weight double").orderBy(F.desc(F.abs("weight")), "feature")
