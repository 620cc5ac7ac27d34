"""k-means sweeps and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.sql import DataFrame, SparkSession

SEED = 42


def kmeans_sweep(spark: SparkSession, df: DataFrame, counts: Sequence[int], features: str = "features") -> DataFrame:
    """Inertia and silhouette per number of clusters; each fit is one distributed job over the data.

    The silhouette is Spark's, on squared distances, which needs no pairwise distances.
    """
    evaluator = ClusteringEvaluator(featuresCol=features)
    rows = []
    for k in counts:
        model = KMeans(k=k, seed=SEED, featuresCol=features).fit(df)
        rows.append((k, float(model.summary.trainingCost), float(evaluator.evaluate(model.transform(df)))))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def clustered(df: DataFrame, k: int, features: str = "features"):
    model = KMeans(k=k, seed=SEED, featuresCol=features).fit(df)
    return model, model.transform(df)


def projected(df: DataFrame, features: str = "features", k: int = 2):
    """Centre, then project to k components. Returns the fitted stages and the projected rows."""
    centre = StandardScaler(inputCol=features, outputCol="centred", withMean=True, withStd=False).fit(df)
    centred = centre.transform(df)
    pca = PCA(k=k, inputCol="centred", outputCol="projected").fit(centred)
    return centre, pca, pca.transform(centred)
