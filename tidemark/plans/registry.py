"""Named plans over the given tables, each with the equal SQL statement where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import tune
from tidemark.sources.tables import load


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


PLANS: dict[str, Plan] = {}


class Tables:
    """Attribute access to the declared tables of one folder, in a session with the settings that the plans rely on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.folder, name)


def plan(name: str, sql: str | None = None):
    """Register a function of the tables under a name."""

    def add(function: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"plan {name} exists")
        PLANS[name] = Plan(name, lambda spark, folder: function(Tables(spark, folder)), sql)
        return function

    return add


# Reported decimals. The tiny shift moves exact halves off the rounding edge, where engines differ;
# adding zero turns -0.0 into 0.0.
SHIFT = 1e-9


def r(value, digits: int = 4) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double") + F.lit(SHIFT), digits) + F.lit(0.0)


def rq(expression: str, digits: int = 4) -> str:
    """The same rounding as SQL text."""
    return f"(round(CAST({expression} AS DOUBLE) + 1e-9, {digits}) + 0.0)"


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column."""
    return df.select(*[r(name, digits).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes])
