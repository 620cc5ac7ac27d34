"""Features per entity or exposure: before a cutoff, after an anchor, up to the entity's own latest event."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.dates import elapsed_days
from tidemark.operators.aggregates import Measure, attach_summary, fill_defaults
from tidemark.operators.history import ordinal
from tidemark.skew import DEFAULT, SkewPolicy, names, settle, spread_join
from tidemark.spans import MICROS_PER_DAY, MICROS_PER_SECOND, Offset, Span, instant, micros


def windowed_summary(
    events: DataFrame, keys, time: str, anchor, windows: dict[str, Span], measures: Sequence[Measure]
) -> DataFrame:
    """All measures for all windows in one grouping; columns are named measure_window (or measure alone)."""
    aggregates = []
    for label, span in windows.items():
        inside = span.contains(time, anchor)
        aggregates += [m.aggregate(inside).alias(_named(m, label)) for m in measures]
    return events.groupBy(*names(keys)).agg(*aggregates)


def _named(measure: Measure, label: str) -> str:
    return f"{measure.name}_{label}" if label else measure.name


def _defaults(windows, measures) -> dict[str, object]:
    return {_named(m, label): m.default for label in windows for m in measures}


def _reach(windows: dict[str, Span], time: str, anchor) -> Column:
    """Widest bounds of the windows, as a plain range on the event time that can reach the scan."""
    at, condition = F.col(time), F.lit(True)
    spans = list(windows.values())
    if all(s.start is not None and not s.start.months for s in spans):
        condition = condition & (at >= min((s.start for s in spans), key=lambda o: o.us).after(anchor))
    if all(s.end is not None and not s.end.months and not s.whole_last_day for s in spans):
        condition = condition & (at <= max((s.end for s in spans), key=lambda o: o.us).after(anchor))
    return condition


def cutoff_features(
    entities: DataFrame,
    events: DataFrame,
    key: str,
    time: str,
    cutoff,
    windows: dict[str, Span],
    measures: Sequence[Measure],
) -> DataFrame:
    """One row per entity: measures over windows that end at a global cutoff.

    The event filter runs before the join, so entities without matching events are kept.
    """
    kept = events.where(_reach(windows, time, cutoff))
    summary = windowed_summary(kept, key, time, cutoff, windows, measures)
    return fill_defaults(entities.join(summary, names(key), "left"), _defaults(windows, measures))


CELL = "_tm_cell"
#: A change of the clock may move the session's microseconds by this much against calendar time.
CLOCK = 2 * 3600 * MICROS_PER_SECOND


def _reach_in_micros(spans: Sequence[Span]) -> tuple[int, int] | None:
    """Microseconds from the anchor between which all windows lie, with room for months of any length; None if one is open."""
    if any(s.start is None or s.end is None for s in spans):
        return None
    low = min(s.start.us + s.start.months * (31 if s.start.months < 0 else 28) * MICROS_PER_DAY for s in spans)
    high = max(s.end.us + s.end.months * (31 if s.end.months > 0 else 28) * MICROS_PER_DAY + s.whole_last_day * MICROS_PER_DAY for s in spans)
    return low - CLOCK, max(low, high) + CLOCK


def candidate_pairs(
    events: DataFrame, anchors: DataFrame, key: str, time: str, event_id, anchor: str, spans: Sequence[Span], policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Events with the anchors of their key whose windows they may lie in.

    Time is cut into cells as long as the windows reach. An anchor goes to the two cells at most that its windows can
    touch, an event to its own, and rows are joined by key and cell: about as many pairs as match, however
    many anchors and events a key has. An open window reaches everything, so its rows are joined by key alone.
    """
    reach = _reach_in_micros(spans)
    if reach is None:
        return spread_join(events, anchors, key, event_id, policy)
    low, high = reach
    cell = lambda at: F.floor(at / F.lit(high - low))
    at = micros(instant(anchor))
    touched = F.explode(F.sequence(cell(at + low), cell(at + high)))
    placed = anchors.where(F.col(anchor).isNotNull()).withColumn(CELL, touched)
    return spread_join(events.withColumn(CELL, cell(micros(instant(time)))), placed, [key, CELL], event_id, policy).drop(CELL)


def window_join(
    entities: DataFrame,
    events: DataFrame,
    key: str,
    time: str,
    event_id: str,
    anchor: str,
    span: Span,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Events of an entity that fall in a window relative to the entity's own anchor."""
    pairs = candidate_pairs(events, entities, key, time, event_id, anchor, [span], policy)
    return pairs.where(span.contains(time, anchor))


def anchored_features(
    entities: DataFrame,
    events: DataFrame,
    key: str,
    time: str,
    event_id: str,
    anchor: str,
    windows: dict[str, Span],
    measures: Sequence[Measure],
    *,
    unit: Sequence[str] | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """One row per entity (or per ``unit``, e.g. an assignment): measures over windows after its anchor."""
    unit = [key] if unit is None else list(unit)
    anchors = entities.select(*dict.fromkeys([*unit, key]), F.col(anchor).alias("_tm_anchor"))
    pairs = candidate_pairs(events, anchors, key, time, event_id, "_tm_anchor", list(windows.values()), policy)
    inside = reduce(lambda a, b: a | b, [span.contains(time, "_tm_anchor") for span in windows.values()])
    summary = windowed_summary(pairs.where(inside), unit, time, "_tm_anchor", windows, measures)
    return fill_defaults(entities.join(summary, unit, "left"), _defaults(windows, measures))


def latest_anchor(events: DataFrame, key: str, time: str, name: str = "latest_at") -> DataFrame:
    return events.groupBy(key).agg(F.max(time).alias(name))


def before_own_latest(
    entities: DataFrame,
    events: DataFrame,
    key: str,
    time: str,
    event_id: str,
    span: Span,
    measures: Sequence[Measure],
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Windows that end at each entity's own latest event."""
    anchors = latest_anchor(events, key, time)
    known = entities.join(anchors, key, "left")
    return anchored_features(known, events, key, time, event_id, "latest_at", {"": span}, measures, policy=policy)


def recency(entities: DataFrame, events: DataFrame, key: str, time: str, cutoff, name: str, never=None) -> DataFrame:
    """Days from an entity's last event before the cutoff to the cutoff."""
    last = events.where(F.col(time) < instant(cutoff)).groupBy(key).agg(F.max(time).alias("_tm_last"))
    gap = elapsed_days(cutoff, "_tm_last")
    return _with_never(entities.join(last, key, "left").withColumn(name, gap).drop("_tm_last"), name, never)


def days_to_first(
    entities: DataFrame, events: DataFrame, key: str, time: str, anchor: str, name: str, never=None, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Days from the entity's anchor to its first event at or after it."""
    anchors = entities.select(key, F.col(anchor).alias("_tm_anchor"))
    pairs = spread_join(events.select(key, time), anchors, key, time, policy)
    first = pairs.where(F.col(time) >= instant("_tm_anchor")).groupBy(key).agg(F.min(time).alias("_tm_first"))
    gap = elapsed_days("_tm_first", anchor)
    return _with_never(entities.join(first, key, "left").withColumn(name, gap).drop("_tm_first"), name, never)


def _with_never(df: DataFrame, name: str, never) -> DataFrame:
    return df if never is None else fill_defaults(df, {name: never})


def never_constant(days: float = 9999.0) -> Column:
    return F.lit(float(days))


def never_factor_of_max(df: DataFrame, name: str, factor: float = 1.5) -> Column:
    """A sentinel above everything seen: factor times the column's maximum."""
    return df.agg(F.max(name) * F.lit(factor)).scalar()


def static_history(
    rows: DataFrame,
    history: DataFrame,
    axes: Sequence[Sequence[str] | str],
    measures: Sequence[Measure],
    row_id,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Past rates by several keys (customer, product, category …) attached to later rows.

    ``history`` holds only rows before the cutoff. Columns are named axis_measure.
    """
    joined = rows
    for axis in axes:
        keys = names(axis)
        prefix = "_".join(keys)
        renamed = [Measure(f"{prefix}_{m.name}", m.kind, m.value, m.default) for m in measures]
        joined = attach_summary(joined, history, keys, renamed, row_id, rows, policy)
    return joined


def category_grid(
    entities: DataFrame, source: DataFrame, category: str, limit: int | None = None, per_block: int = 10_000, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Every entity with every category that the source holds.

    The categories are numbered and gathered in blocks of ``per_block``; entities are joined with each block and the block is
    exploded, so there may be any number of them. With ``limit``, more categories are an error.
    """
    levels = source.select(category).where(F.col(category).isNotNull()).distinct()
    if limit is not None:
        few = levels.limit(limit + 1).agg(F.sort_array(F.collect_set(category)).alias("levels"))
        checked = few.select(
            F.when(F.size("levels") <= limit, F.col("levels")).otherwise(
                F.raise_error(F.lit(f"{category} has more than {limit} levels")).cast(few.schema["levels"].dataType)
            )
        )
        return entities.withColumn(category, F.explode(checked.scalar()))
    block = F.floor((F.col("_tm_no") - 1) / F.lit(per_block)).cast("int")
    numbered = ordinal(levels, [], category, [], "_tm_no", policy).withColumn("_tm_block", block)
    blocks = settle(numbered.groupBy("_tm_block").agg(F.sort_array(F.collect_list(category)).alias("_tm_levels")), "levels")
    last = blocks.agg(F.max("_tm_block")).scalar()
    each = entities.withColumn("_tm_block", F.explode(F.when(last.isNotNull(), F.sequence(F.lit(0), last))))
    joined = spread_join(each, blocks, "_tm_block", entities.columns, policy)
    return joined.select(*entities.columns, F.explode("_tm_levels").alias(category))


def mean_gap(events: DataFrame, key: str, time: str, name: str) -> DataFrame:
    """Mean seconds between a key's consecutive events: (last - first) / (n - 1), no sort needed."""
    n = F.count(time)
    length = F.unix_micros(F.max(time).cast("timestamp")) - F.unix_micros(F.min(time).cast("timestamp"))
    return events.groupBy(key).agg((length / F.nullif(n - 1, F.lit(0)) / F.lit(1e6)).alias(name))


def session_rollup(
    events: DataFrame, key, time: str, kind: str, kinds: Sequence[str], measures: Sequence[Measure] = ()
) -> DataFrame:
    """Per session or order: counts per kind, first and last offset, density per minute."""
    seconds = (F.unix_micros(F.max(time).cast("timestamp")) - F.unix_micros(F.min(time).cast("timestamp"))) / F.lit(1e6)
    return events.groupBy(*names(key)).agg(
        F.count(F.lit(1)).alias("n_events"),
        *[F.count_if(F.col(kind) == level).alias(f"n_{level}") for level in kinds],
        F.min(time).alias("first_at"),
        F.max(time).alias("last_at"),
        seconds.alias("duration_seconds"),
        (F.count(F.lit(1)) / F.nullif(seconds / F.lit(60.0), F.lit(0.0))).alias("events_per_minute"),
        *[m.aggregate().alias(m.name) for m in measures],
    )


def newest_rows(df: DataFrame, keys, time: str, tie, k: int = 1) -> DataFrame:
    """The k newest rows per key. Spark keeps only k rows per key and task before the shuffle."""
    order = [F.desc(time), *[F.desc(t) for t in names(tie)]]
    rank = F.row_number().over(Window.partitionBy(*names(keys)).orderBy(*order))
    return df.withColumn("_tm_rank", rank).where(F.col("_tm_rank") <= k).drop("_tm_rank")


def data_cutoff(df: DataFrame, time: str, back: Offset | None = None) -> Column:
    """Latest event time minus an offset, as a one-row subquery."""
    latest = df.agg(F.max(time).alias("latest"))
    return latest.select((-back).after("latest") if back else F.col("latest")).scalar()
