"""Bins and tiers with stated edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import thresholds
from tidemark.skew import DEFAULT
from tidemark.spans import column


def cut(value, edges: Sequence, labels: Sequence, *, closed: str = "right", include_lowest: bool = False) -> Column:
    """Label of the bin the value falls in; null outside the edges.

    closed='right' means (a, b], closed='left' means [a, b).
    """
    if len(labels) != len(edges) - 1 or closed not in ("left", "right"):
        raise ValueError("need one label per bin and closed 'left' or 'right'")
    x, result = column(value), None
    for i, label in enumerate(labels):
        low, high = (e if isinstance(e, Column) else F.lit(float(e)) for e in (edges[i], edges[i + 1]))
        if closed == "right":
            inside = ((x >= low) if include_lowest and i == 0 else (x > low)) & (x <= high)
        else:
            inside = (x >= low) & (x < high)
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result


def equal_width(df: DataFrame, value: str, labels: Sequence, name: str) -> DataFrame:
    """Bins of equal width between the column's minimum and maximum, right-closed, lowest included."""
    n = len(labels)
    ends = df.agg(F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    edges = [low + (high - low) * F.lit(i / n) for i in range(1, n)]
    result = F.when(F.col(value).isNull(), F.lit(None))
    for edge, label in zip(edges, labels, strict=False):
        result = result.when(F.col(value) <= edge, label)
    return df.withColumn(name, result.otherwise(labels[-1]))


def zero_and_quantile_tiers(
    df: DataFrame, value: str, labels: Sequence[str], name: str, policy=DEFAULT
) -> DataFrame:
    """First label for zero (or less), the rest by equal shares of the values above zero."""
    tiers = len(labels) - 1
    cuts = thresholds(df, value, [i / tiers for i in range(1, tiers)], non_zero=True, policy=policy)
    result = F.when(F.coalesce(F.col(value), F.lit(0)) <= 0, labels[0])
    for point, label in zip(cuts, labels[1:-1], strict=True):
        result = result.when(F.col(value) <= point, label)
    return df.withColumn(name, result.otherwise(labels[-1]))


def above_quantile(df: DataFrame, value: str, shares: dict[str, float], *, non_zero: bool = False, policy=DEFAULT) -> DataFrame:
    """For each new column's share, 1 when the value is above the column's quantile at it."""
    points = thresholds(df, value, list(shares.values()), non_zero=non_zero, policy=policy)
    above = [F.coalesce((F.col(value) > point).cast("int"), F.lit(0)) for point in points]
    return df.withColumns(dict(zip(shares, above, strict=True)))
