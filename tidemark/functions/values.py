"""Numeric and conditional expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spans import column


def safe_ratio(top, bottom, default=0.0) -> Column:
    """top / bottom, or the default when bottom is 0 or either side is null."""
    value = column(top).cast("double") / F.nullif(column(bottom).cast("double"), F.lit(0.0))
    return value if default is None else F.coalesce(value, F.lit(default))


def smoothed_ratio(top, bottom, add_top: float = 1.0, add_bottom: float = 1.0) -> Column:
    return (column(top) + F.lit(add_top)) / (column(bottom) + F.lit(add_bottom))


def lookup(value, table: Mapping, default=None) -> Column:
    """Fixed value-to-value mapping; the table is a short constant."""
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.get(F.map_values(F.map_filter(mapping, lambda k, v: k == column(value))), F.lit(0))
    return found if default is None else F.coalesce(found, F.lit(default))


def choose(conditions: Sequence[tuple[Column, object]], default) -> Column:
    """First matching condition wins."""
    first, *rest = conditions
    result = F.when(*first)
    for condition, value in rest:
        result = result.when(condition, value)
    return result.otherwise(default)


def clamp(value, low=None, high=None) -> Column:
    result = column(value)
    if low is not None:
        result = F.greatest(F.lit(low), result)
    return result if high is None else F.least(F.lit(high), result)


def without_infinity(value, replacement=None) -> Column:
    x = column(value)
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(replacement)).otherwise(x)


def flag(condition: Column) -> Column:
    """0/1; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def in_band(value, band) -> Column:
    """Whether a number lies in a band written like '18-24'."""
    ends = F.split(column(band), "-")
    return flag(column(value).between(F.get(ends, F.lit(0)).cast("int"), F.get(ends, F.lit(1)).cast("int")))


def fill_from_column(df: DataFrame, name: str, statistic: str, factor: float = 1.0) -> DataFrame:
    """Fill nulls with a statistic of the same column (mean, median, max …), times a factor."""
    if statistic == "median":
        from tidemark.operators.aggregates import thresholds

        value = thresholds(df, name, [0.5])[0]
    else:
        value = df.agg(getattr(F, {"mean": "avg"}.get(statistic, statistic))(name).cast("double")).scalar()
    return df.withColumn(name, F.coalesce(F.col(name).cast("double"), value * F.lit(factor)))


def weighted_score(weights: Mapping[str, float]) -> Column:
    parts = [column(name) * F.lit(float(weight)) for name, weight in weights.items()]
    return sum(parts[1:], parts[0])


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [name for name, kind in df.dtypes if kind in kinds or kind.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def log1p_if_skewed(df: DataFrame, columns: Sequence[str], limit: float = 0.75) -> DataFrame:
    """Add log1p of each column whose bias-corrected skewness exceeds the limit; others pass through."""
    from tidemark.operators.aggregates import sample_skewness

    skews = df.agg(F.array(*[sample_skewness(c) for c in columns])).scalar()
    return df.withColumns(
        {
            f"{c}_scaled": F.when(F.get(skews, F.lit(i)) > limit, F.log1p(c)).otherwise(F.col(c).cast("double"))
            for i, c in enumerate(columns)
        }
    )
