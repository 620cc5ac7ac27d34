"""Labels built from a window after the cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import Measure, attach_summary, top_value
from tidemark.operators.history import next_value
from tidemark.skew import DEFAULT, SkewPolicy
from tidemark.spans import Span, instant


def future_rows(events: DataFrame, time: str, cutoff, span: Span) -> DataFrame:
    return events.where(span.contains(time, cutoff))


def event_label(entities, events, key: str, time: str, cutoff, span: Span, name: str) -> DataFrame:
    """1 when the entity has an event in the window, else 0."""
    seen = future_rows(events, time, cutoff, span).select(key).distinct().withColumn("_tm_seen", F.lit(1))
    return entities.join(seen, key, "left").withColumn(name, F.coalesce("_tm_seen", F.lit(0))).drop("_tm_seen")


def no_event_label(entities, events, key: str, time: str, cutoff, span: Span, name: str) -> DataFrame:
    """1 when the entity has no event in the window (churn), else 0."""
    return event_label(entities, events, key, time, cutoff, span, name).withColumn(name, 1 - F.col(name))


def state_change_label(entities, changed_at: str, cutoff, span: Span, name: str) -> DataFrame:
    """1 when a dated change falls in the window. Entities changed at or before the cutoff are left out."""
    open_cases = entities.where(F.col(changed_at).isNull() | (instant(changed_at) > instant(cutoff)))
    return open_cases.withColumn(name, F.coalesce(span.contains(changed_at, cutoff), F.lit(False)).cast("int"))


def future_total_label(entities, events, key, time: str, cutoff, span: Span, measure: Measure) -> DataFrame:
    """A sum or count over the window, 0 (the measure's default) without events."""
    return attach_summary(entities, future_rows(events, time, cutoff, span), key, [measure])


def next_value_label(
    rows: DataFrame, key: str, time: str, tie: str, value: str, name: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """The value on the key's next row; rows without a next one are left out."""
    return next_value(rows, key, time, tie, value, name, policy).where(F.col(name).isNotNull())


def main_category_label(
    entities, events, key: str, time: str, cutoff, span: Span, category: str, name: str, default: str, score: Column | None = None
) -> DataFrame:
    """Most frequent (or highest scoring) category in the window, with a default for none."""
    best = top_value(future_rows(events, time, cutoff, span), key, category, name, score)
    return entities.join(best, key, "left").withColumn(name, F.coalesce(name, F.lit(default)))


def state_and_event_label(entities, states, events, key: str, state: Column, time: str, cutoff, span: Span, name: str):
    """1 when the state at the cutoff holds and an event follows in the window."""
    holds = states.where(state).select(key).distinct()
    follows = future_rows(events, time, cutoff, span).select(key)
    both = holds.join(follows, key, "left_semi").withColumn("_tm_both", F.lit(1))
    return entities.join(both, key, "left").withColumn(name, F.coalesce("_tm_both", F.lit(0))).drop("_tm_both")


def shortfall_label(totals: DataFrame, paid: str, expected: str, share: float, name: str) -> DataFrame:
    """1 when the final paid / expected ratio stays under the share."""
    ratio = F.col(paid) / F.nullif(F.col(expected), F.lit(0.0))
    return totals.withColumn(name, F.coalesce((ratio < share).cast("int"), F.lit(0)))


def shortage_label(stock_table: DataFrame, stock: str, daily_rate: str, horizon_days: float, name: str) -> DataFrame:
    """1 when stock will not cover the demand expected over the horizon."""
    return stock_table.withColumn(name, (F.col(stock) < F.col(daily_rate) * F.lit(float(horizon_days))).cast("int"))


def eligible(entities: DataFrame, born: str, cutoff, data_end, observation: Span) -> DataFrame:
    """Entities that exist at the cutoff and whose observation window has fully passed."""
    existing = entities.where(instant(born) <= instant(cutoff))
    return existing.where(observation.end.after(born) <= instant(data_end))
