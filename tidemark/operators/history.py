"""Features over a key's earlier rows: running, last N rows, trailing time range, as-of.

A key that is too heavy for one task is cut into slices of about equally many rows. For running features each
slice starts with an opening row that carries the state of everything before it; for last-N and range features
the rows a slice needs from its neighbours are copied or pre-aggregated. One plan serves every size.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from tidemark.skew import DEFAULT, HOT, ROWS, TASKS, SkewPolicy, hot_keys, known_once, mark_hot, names, settle, with_listed
from tidemark.spans import Offset, column, micros

SLICE = "_tm_slice"
REAL = "_tm_real"
AT = "_tm_at"
TIMED = "_tm_timed"
CUTS = "_tm_cuts"
EVERY = "_tm_every"
BEFORE_ALL = -(1 << 62)
DRAWN = 32
HORIZON = "_tm_horizon"


@dataclass(frozen=True)
class Past:
    """One feature over earlier rows. ``value`` null means the row does not take part."""

    name: str
    kind: str
    value: Column
    default: object = None

    def parts(self) -> list[tuple[str, Column, str]]:
        """(state column, what a row adds to it, how states combine)."""
        ones = F.when(self.value.isNotNull(), F.lit(1)).cast("bigint")
        if self.kind == "count":
            return [(f"_tm_{self.name}_n", ones, "sum")]
        if self.kind == "mean":
            return [(f"_tm_{self.name}_s", self.value.cast("double"), "sum"), (f"_tm_{self.name}_n", ones, "sum")]
        combine = {"sum": "sum", "min": "min", "max": "max"}.get(self.kind, self.kind)
        return [(f"_tm_{self.name}_v", self.value, combine)]

    def result(self, over: dict[str, Column]) -> Column:
        states = [over[state] for state, _, _ in self.parts()]
        value = states[0] / F.nullif(states[1], F.lit(0)) if self.kind == "mean" else states[0]
        if self.default is None:
            return value
        fallback = self.default if isinstance(self.default, Column) else F.lit(self.default)
        return F.coalesce(value, fallback)


def past_count(name: str, when: Column | None = None) -> Past:
    value = F.lit(1) if when is None else F.when(when, F.lit(1))
    return Past(name, "count", value, 0)


def past_sum(name: str, value, default=0.0) -> Past:
    return Past(name, "sum", column(value), default)


def past_mean(name: str, value, default=0.0) -> Past:
    return Past(name, "mean", column(value), default)


def past_min(name: str, value, default=None) -> Past:
    return Past(name, "min", column(value), default)


def past_max(name: str, value, default=None) -> Past:
    return Past(name, "max", column(value), default)


def previous(name: str, value, default=None) -> Past:
    """Value of the row just before, even if that value is null."""
    return Past(name, "previous", column(value), default)


def latest(name: str, value, default=None) -> Past:
    """Last non-null value, e.g. the last time a condition held."""
    return Past(name, "latest", column(value), default)


def _over(combine: str, state: str, frame: WindowSpec, order: WindowSpec) -> Column:
    if combine == "previous":
        return F.lag(state).over(order)
    if combine == "latest":
        return F.last(state, ignorenulls=True).over(frame)
    return getattr(F, combine)(state).over(frame)


def _carried(combine: str, state: str, order: Column) -> Column:
    if combine == "previous":
        return F.max_by(state, order)
    if combine == "latest":
        return F.max_by(F.col(state), F.when(F.col(state).isNotNull(), order))
    return getattr(F, combine)(state)


def _cuts(df: DataFrame, keys: list[str], place: list[str], draw_by: list[str], source: DataFrame, policy: SkewPolicy) -> DataFrame | None:
    """For each hot key, the places at which a new slice begins; None without hot keys.

    About ``DRAWN`` rows are drawn for each task that the key needs, by the hash of ``draw_by``. There are at most
    2 x ``max_hot`` tasks, and so many times ``DRAWN`` rows drawn, from all keys together. The list is settled and
    shared like that of the hot keys.
    """
    hot = hot_keys(source, keys, policy)
    if hot is None:
        return None
    drawn_from = source if all(name in source.columns for name in draw_by) else df
    slim = drawn_from.select(*dict.fromkeys([*keys, *draw_by, *place]))
    return known_once(slim, ("cuts", *keys, "", *place, "", *draw_by, policy.min_rows, policy.max_hot), lambda: settle(_drawn_cuts(slim, keys, place, draw_by, hot), "cuts"))


def _drawn_cuts(slim: DataFrame, keys: list[str], place: list[str], draw_by: list[str], hot: DataFrame) -> DataFrame:
    per_task = F.col(ROWS) / F.col(TASKS)
    rates = hot.select(*keys, F.greatest(F.floor(per_task / DRAWN), F.lit(1)).alias(EVERY), per_task.alias(ROWS))
    drawn = with_listed(slim, rates, keys, [EVERY, ROWS]).where(F.pmod(F.xxhash64(*draw_by), F.col(EVERY)) == 0)
    step = F.greatest(F.floor(F.first(F.col(ROWS) / F.col(EVERY))), F.lit(1))
    spots = drawn.groupBy(*keys, F.struct(*place).alias(CUTS)).agg(F.count(F.lit(1)).alias("_tm_drawn"), step.alias("_tm_step"))
    until = F.sum("_tm_drawn").over(Window.partitionBy(*keys).orderBy(CUTS).rowsBetween(Window.unboundedPreceding, 0))
    part, part_before = (F.floor(n / F.col("_tm_step")) for n in (F.col("_tm_until"), F.col("_tm_until") - F.col("_tm_drawn")))
    starts = spots.withColumn("_tm_until", until).where(part > part_before)
    return starts.groupBy(*keys).agg(F.array_sort(F.collect_list(CUTS)).alias(CUTS))


def _slice_of(here: Column, policy: SkewPolicy) -> Column:
    """How many of the row's cuts lie at or before a place, by binary search in halving steps."""
    widest = (2 * policy.max_hot).bit_length()
    steps = F.array(*[F.lit(1 << power) for power in range(widest, -1, -1)])
    # past the last cut there is nothing to step over
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(CUTS, at + step - 1) <= here, step).otherwise(F.lit(0)))


def _sliced(
    df: DataFrame, keys: list[str], place: list[str], draw_by: list[str], source: DataFrame, policy: SkewPolicy
) -> DataFrame:
    """Number the slice of each row: null for ordinary keys, else how many of its key's cuts lie at or before it.

    Without hot keys there are no slices and the rows come back as they are.
    """
    cuts = _cuts(df, keys, place, draw_by, source, policy)
    if cuts is None:
        return df
    cut = with_listed(df, cuts, keys, [CUTS])
    return cut.withColumn(SLICE, F.when(F.col(CUTS).isNotNull(), _slice_of(F.struct(*place), policy))).drop(CUTS)


def _with_opening_rows(
    df: DataFrame, keys: list[str], order: list[str], states: list[tuple[str, Column, str]]
) -> DataFrame:
    """Add, before each slice, one row holding the combined state of the key's earlier slices."""
    position = F.struct(*order)
    carried = (
        df.where(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(*[_carried(combine, state, position).alias(state) for state, _, combine in states])
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    opening = carried.select(
        *keys,
        SLICE,
        *[_over(combine, state, before, by_slice).alias(state) for state, _, combine in states],
        F.lit(0).alias(REAL),
    )
    return df.withColumn(REAL, F.lit(1)).unionByName(opening, allowMissingColumns=True)


def _axis(df: DataFrame, time: str) -> Column:
    """The time in microseconds; a whole number is its own axis."""
    return F.col(time) if df.schema[time].dataType == T.LongType() else micros(time)


def running_features(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str,
    tie: str | Sequence[str],
    features: Sequence[Past],
    *,
    current_row: bool = False,
    strictly_earlier: bool = False,
    slice_by: Column | None = None,
    hot_from: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Add features over the earlier rows of each key, ordered by ``time`` then ``tie``.

    ``hot_from`` is a table to count the keys in when ``df`` itself is costly, such as the scan it comes
    from. ``current_row`` also counts the row itself. ``strictly_earlier`` leaves out rows at the same time
    instead of ordering them by ``tie``; a row without a time then has no earlier rows, and comes before
    all rows with one. Rows of a hot key that are equal in ``time`` and ``tie`` stay in one slice, with
    ``strictly_earlier`` all rows at one time. ``slice_by`` names slices that are known beforehand, in order; it
    is for tables without keys.
    """
    keys, tie = names(keys), names(tie)
    if strictly_earlier and (current_row or any(f.kind in ("previous", "latest") for f in features)):
        raise ValueError("strictly_earlier takes whole instants: no current row, and no feature that needs one row of an instant")
    if slice_by is not None and keys:
        raise ValueError("slices are named only for tables without keys")
    states = [part for feature in features for part in feature.parts()]
    work = df.withColumns({state: value for state, value, _ in states})
    if strictly_earlier:
        work = work.withColumn(AT, _axis(df, time)).withColumn(TIMED, F.col(AT).isNotNull())
    if slice_by is None:
        place = [time] if strictly_earlier else [time, *tie]
        work = _sliced(work, keys, place, [time, *tie], df if hot_from is None else hot_from, policy)
    else:
        work = work.withColumn(SLICE, slice_by)
    sliced = SLICE in work.columns
    part, ordering = [*keys], [F.col(AT)] if strictly_earlier else [F.col(time), *[F.col(c) for c in tie]]
    if sliced:
        work = _with_opening_rows(work, keys, [time, *tie], states)
        part.append(SLICE)
        if strictly_earlier:
            work = work.withColumn(AT, F.when(F.col(REAL) == 0, F.lit(BEFORE_ALL)).otherwise(F.col(AT)))
        else:
            ordering = [F.col(REAL), *ordering]
    by_order = Window.partitionBy(*part).orderBy(*ordering)
    if strictly_earlier:
        frame = by_order.rangeBetween(Window.unboundedPreceding, -1)
    else:
        frame = by_order.rowsBetween(Window.unboundedPreceding, 0 if current_row else -1)
    found = {state: _over(combine, state, frame, by_order) for state, _, combine in states}
    if strictly_earlier:
        found = {state: F.when(F.col(TIMED), value) for state, value in found.items()}
    work = work.withColumns(found).where(F.col(REAL) == 1) if sliced else work.withColumns(found)
    over = {state: F.col(state) for state, _, _ in states}
    return work.select(*df.columns, *[f.result(over).alias(f.name) for f in features])


def next_value(
    df: DataFrame, keys, time: str, tie: str, value: str, name: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """The value on the key's next row, null on the last one. ``tie`` is a numeric id.

    For several values pass a struct column and unpack it, so the rows are sorted once.
    """
    # the next row is the previous one in reversed order
    last = F.lit(1 << 62)
    reverse = df.withColumns({"_tm_rt": F.coalesce(-micros(time), last), "_tm_ri": F.coalesce(-F.col(tie), last)})
    found = running_features(reverse, names(keys), "_tm_rt", "_tm_ri", [previous(name, value)], policy=policy)
    return found.drop("_tm_rt", "_tm_ri")


def ordinal(df, keys, time, tie, name="ordinal", policy: SkewPolicy = DEFAULT) -> DataFrame:
    """1 for the key's first row, 2 for the second, and so on."""
    counted = Past(name, "count", F.lit(1))
    return running_features(df, keys, time, tie, [counted], current_row=True, policy=policy)


def distinct_before(
    df: DataFrame, keys, time: str, tie, value: str, name: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Number of different values among a key's earlier rows.

    Each (key, value) adds one marker at its first occurrence; the feature is the running count of markers.
    """
    keys, tie = names(keys), names(tie)
    first = F.min(F.struct(time, *tie)).alias("_tm_first")
    markers = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(first)
        .select(*keys, "_tm_first.*", F.lit(1).alias("_tm_marker"))
    )
    rows = df.withColumn("_tm_marker", F.lit(0)).unionByName(markers, allowMissingColumns=True)
    seen = past_count(name, F.col("_tm_marker") == 1)
    # a marker sorts after the row it comes from, so a row never counts its own value
    counted = running_features(rows, keys, time, [*tie, "_tm_marker"], [seen], policy=policy)
    return counted.where(F.col("_tm_marker") == 0).drop("_tm_marker")


WHEN = "_tm_when"
PROBE = "_tm_probe"


def distinct_within(
    df: DataFrame,
    keys,
    at: str,
    tie,
    values: Sequence[tuple[Column, Mapping[str, int]]],
    *,
    inclusive: bool = False,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Add, for each value and named reach, how many different values the key's rows less than a reach back hold.

    ``at`` is a whole number, such as microseconds or an ordinal; a row at s counts for those at t with s < t <= s + reach,
    with ``inclusive`` for those with s <= t < s + reach. Each row opens an interval, closed by the next row of the same value or the
    reach's end, whichever comes first; the count is a running sum of these marks, one row for each end, so its cost
    does not depend on how many rows a reach holds. Null values don't count; a row without a place has 0 and is in no reach.
    """
    keys, tie = names(keys), names(tie)
    columns = [name for _, reaches in values for name in reaches]
    marks = {name: f"_tm_mark{i}" for i, name in enumerate(columns)}
    early = F.lit(1 if inclusive else 0)

    def mark(place: Column, given: Mapping[str, int]) -> Column:
        return F.struct((place - early).alias(WHEN), *[F.lit(given.get(name)).cast("bigint").alias(m) for name, m in marks.items()])

    both = df.withColumns({WHEN: F.col(at), PROBE: F.lit(True)})
    for value, reaches in values:
        slim = df.select(*keys, *tie, F.col(at).alias(WHEN), value.alias("_tm_value")).where(F.col(WHEN).isNotNull() & F.col("_tm_value").isNotNull())
        back = slim.withColumn("_tm_back", -F.col(WHEN))
        later = running_features(back, [*keys, "_tm_value"], "_tm_back", tie, [previous("_tm_next", WHEN)], policy=policy)
        opens = mark(F.col(WHEN), dict.fromkeys(reaches, 1))
        closes = [mark(F.least("_tm_next", F.col(WHEN) + reach), {name: -1}) for name, reach in reaches.items()]
        both = both.unionByName(later.select(*keys, F.inline(F.array(opens, *closes))), allowMissingColumns=True)
    sums = [past_sum(name, m, 0) for name, m in marks.items()]
    counted = running_features(both, keys, WHEN, tie, sums, strictly_earlier=True, hot_from=df, policy=policy)
    return counted.where(PROBE).select(*df.columns, *[F.col(name).cast("bigint").alias(name) for name in columns])


def distinct_last_rows(df: DataFrame, keys, time: str, tie, value: str, rows: int, name: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Number of different values among a key's last ``rows`` rows before each row."""
    numbered = ordinal(df, keys, time, tie, "_tm_row", policy)
    return distinct_within(numbered, keys, "_tm_row", [], [(F.col(value), {name: rows})], policy=policy).select(*df.columns, name)


def last_rows_features(
    df: DataFrame,
    keys,
    time: str,
    tie,
    first: int,
    last: int,
    aggregates: dict[str, Column],
    *,
    rows_per_slice: int = 1_000_000,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Aggregates over the rows from ``first`` to ``last`` relative to each row, e.g. -5 to -1.

    A key is cut by row number; the last rows of a slice are also given to the next one.
    """
    keys, tie = names(keys), names(tie)
    if not first <= last <= 0:
        raise ValueError("the frame must end at or before the current row")
    reach = -first
    width = max(rows_per_slice, reach)
    numbered = ordinal(df, keys, time, tie, "_tm_row", policy)
    own = F.floor((F.col("_tm_row") - 1) / F.lit(width))
    ends_slice = F.pmod(F.col("_tm_row") - 1, F.lit(width)) >= width - reach
    copies = numbered.withColumn("_tm_own", own).withColumn(
        SLICE, F.explode(F.when(ends_slice, F.array("_tm_own", F.col("_tm_own") + 1)).otherwise(F.array("_tm_own")))
    )
    frame = Window.partitionBy(*keys, SLICE).orderBy("_tm_row").rowsBetween(first, last)
    added = copies.select("*", *[agg.over(frame).alias(name) for name, agg in aggregates.items()])
    return added.where(F.col(SLICE) == F.col("_tm_own")).select(*df.columns, *aggregates)


DECOMPOSABLE = ("count", "sum", "mean", "min", "max", "std")


@dataclass(frozen=True)
class Trailing:
    """One statistic of a value over a trailing time range."""

    name: str
    kind: str
    value: Column

    def column(self, label: str) -> str:
        return f"{self.name}_{label}" if label else self.name

    def empty(self) -> Column:
        """The statistic of no rows."""
        return F.lit(0).cast("bigint") if self.kind in ("count", "distinct") else F.lit(None)

    def on(self, name: str) -> Trailing:
        return replace(self, value=F.col(name))

    def over(self, frame: WindowSpec) -> Column:
        functions = {
            "count": F.count,
            "sum": F.sum,
            "mean": F.avg,
            "min": F.min,
            "max": F.max,
            "std": F.stddev_samp,
        }
        return functions[self.kind](self.value).over(frame)

    def states(self, centre: Column) -> dict[str, tuple[Column, str]]:
        x = self.value.cast("double")
        ones = F.when(self.value.isNotNull(), F.lit(1)).cast("bigint")
        n, s, q = f"_tm_{self.name}_n", f"_tm_{self.name}_s", f"_tm_{self.name}_q"
        if self.kind == "count":
            return {n: (ones, "sum")}
        if self.kind in ("min", "max"):
            return {s: (self.value, self.kind)}
        if self.kind == "sum":
            return {s: (self.value, "sum")}
        if self.kind == "mean":
            return {s: (x, "sum"), n: (ones, "sum")}
        # squares are taken about the overall mean to keep their sums small
        return {n: (ones, "sum"), s: (x - centre, "sum"), q: ((x - centre) * (x - centre), "sum")}

    def result(self, suffix: str) -> Column:
        n, s, q = (F.col(f"_tm_{self.name}_{part}{suffix}") for part in "nsq")
        if self.kind == "count":
            return F.coalesce(n, F.lit(0)).cast("bigint")
        if self.kind in ("min", "max", "sum"):
            return s
        if self.kind == "mean":
            return s / F.nullif(n, F.lit(0))
        return F.when(n > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))))


def trailing_features(
    df: DataFrame,
    keys,
    time: str,
    tie,
    horizons: Mapping[str, Offset],
    features: Sequence[Trailing],
    *,
    closed: str = "left",
    all_dense: bool = False,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Statistics over the rows of the key in [t - horizon, t) or, with closed='right', (t - horizon, t].

    All horizons share one sort. Columns are named feature_horizon. ``tie`` must identify a row. A RANGE
    frame costs its length per row, so keys count as hot earlier here than for running features;
    ``all_dense`` treats every key so, for long horizons over busy keys such as sensors. A row without a
    time has an empty frame and is in none. Distinct values are running sums of marks (``distinct_within``), medians
    come from a sorted window that slides over the rows (``_trailing_medians``).
    """
    keys, tie = names(keys), names(tie)
    if closed not in ("left", "right") or any(h.months or h.us <= 0 for h in horizons.values()):
        raise ValueError("horizons must be positive exact durations, closed 'left' or 'right'")
    shift = 0 if closed == "left" else 1
    bounds = {label: (shift - h.us, shift - 1) for label, h in horizons.items()}
    kinds = {kind: [f for f in features if f.kind == kind or kind == "simple" and f.kind in DECOMPOSABLE] for kind in ("simple", "distinct", "median")}
    rows = _trailing_simple(df, keys, time, tie, bounds, kinds["simple"], all_dense, policy) if kinds["simple"] else df
    if kinds["distinct"]:
        reaches = [(f.value, {f.column(label): high - low + 1 for label, (low, high) in bounds.items()}) for f in kinds["distinct"]]
        rows = distinct_within(rows.withColumn("_tm_at_us", micros(time)), keys, "_tm_at_us", tie, reaches, inclusive=shift == 1, policy=policy).drop("_tm_at_us")
    if kinds["median"]:
        rows = _trailing_medians(rows, keys, time, tie, bounds, kinds["median"], policy)
    return rows.select(*df.columns, *[f.column(label) for label in bounds for f in features])


def _trailing_simple(df, keys, time, tie, bounds, features, all_dense, policy) -> DataFrame:
    # the cost of a frame per row matters long before a task runs out of room
    early = replace(policy, min_rows=min(policy.min_rows, 20_000), max_hot=max(policy.max_hot, 65_536))
    hot_list = None if all_dense else hot_keys(df, keys, early)
    if hot_list is None and not all_dense:
        return _range_windows(df, keys, time, bounds, features)
    marked = df.withColumn(HOT, F.lit(True)) if all_dense else mark_hot(df, keys, hot_list)
    ordinary = _range_windows(marked.where(~F.col(HOT)).drop(HOT), keys, time, bounds, features)
    timed = F.col(time).isNotNull()
    hot = marked.where(F.col(HOT) & timed).drop(HOT)
    empty = {f.column(label): f.empty().cast(ordinary.schema[f.column(label)].dataType) for label in bounds for f in features}
    untimed = marked.where(F.col(HOT) & ~timed).drop(HOT).withColumns(empty)
    values = {f.name: f"_tm_x{i}" for i, f in enumerate(features)}
    slim = hot.select(*keys, *tie, micros(time).alias(AT), *[f.value.alias(values[f.name]) for f in features])
    simple = [f.on(values[f.name]) for f in features]
    # one mean per feature serves all horizons
    centres = {f.name: slim.agg(F.avg(f.value)).scalar() for f in simple if f.kind == "std"}
    heavy = _attached(hot, _range_pieces(slim, keys, tie, bounds, simple, centres), tie)
    return ordinary.unionByName(heavy.select(*ordinary.columns)).unionByName(untimed.select(*ordinary.columns))


class _Frames(BaseIndexer):
    """Windows whose first and one past last rows are given."""

    def __init__(self, begin: np.ndarray, end: np.ndarray):
        super().__init__()
        self.begin, self.end = begin, end

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        return self.begin, self.end


def _trailing_medians(rows: DataFrame, keys, time, tie, bounds, features, policy: SkewPolicy) -> DataFrame:
    """Exact medians over trailing ranges, in time that grows with the logarithm of a frame's rows.

    A task reads a key's rows in order of time while a sorted window slides over them. A hot key is cut into slices of
    about equally many rows, and a row also goes to those later slices whose frames reach back to it. A slice and
    what its frames reach back to are held by one task at a time. NaN and infinite values count as missing.
    """
    medians = {f.column(label): (f"_tm_x{i}", low, high) for i, f in enumerate(features) for label, (low, high) in bounds.items()}
    values = {f"_tm_x{i}": f.value.cast("double") for i, f in enumerate(features)}
    work = rows.withColumns({AT: micros(time), "_tm_copy": F.lit(False), SLICE: F.lit(0)} | values)
    cuts = _cuts(work, keys, [AT], [AT, *tie], rows, policy)
    if cuts is not None:
        cut = with_listed(work.drop("_tm_copy", SLICE), cuts, keys, [CUTS])
        reach = max(-low for low, _ in bounds.values())
        own, last = (F.coalesce(_slice_of(F.struct((F.col(AT) + more).alias(AT)), policy), F.lit(0)) for more in (0, reach))
        copied = cut.withColumn("_tm_own", own).withColumn(SLICE, F.explode(F.sequence("_tm_own", F.greatest("_tm_own", last))))
        work = copied.withColumn("_tm_copy", F.col(SLICE) > F.col("_tm_own")).drop("_tm_own", CUTS)
    in_order = Window.partitionBy(*keys, SLICE).orderBy(AT)
    helpers = [AT, "_tm_copy", SLICE, *values, "_tm_new"]
    # the window also deals out and sorts the rows, which reach the function in this order
    work = work.withColumn("_tm_new", F.row_number().over(in_order) == 1)
    kept = [name for name in work.columns if name not in helpers]
    schema = T.StructType([*[rows.schema[name] for name in kept], *[T.StructField(name, T.DoubleType()) for name in medians]])

    def whole_keys(held: pa.Table) -> pa.RecordBatch:
        at = held[AT].to_numpy()
        timed = np.flatnonzero(held[AT].is_valid().to_numpy())
        key = np.cumsum(held["_tm_new"].to_numpy())[timed]
        at = at[timed].astype(np.int64)
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        out = {}
        for name, (value, low, high) in medians.items():
            first, last = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            for b, e in zip(begins, [*begins[1:], len(at)], strict=True):
                first[b:e] = b + np.searchsorted(at[b:e], at[b:e] + low, "left")
                last[b:e] = b + np.searchsorted(at[b:e], at[b:e] + high, "right")
            column = np.full(len(held), np.nan)
            series = pd.Series(held[value].to_numpy()[timed].astype(np.float64))
            column[timed] = series.rolling(_Frames(first, last), min_periods=1).median() if len(at) else []
            out[name] = pa.array(column, from_pandas=True)
        own = held.select(kept)
        for name, column in out.items():
            own = own.append_column(name, column)
        return own.filter(pa.array(~held["_tm_copy"].to_numpy()))

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows_held = [], 0
        for batch in batches:
            held.append(batch)
            rows_held += batch.num_rows
            starts = np.flatnonzero(batch["_tm_new"].to_numpy(zero_copy_only=False))
            if rows_held >= 1 << 16 and len(starts):
                table = pa.Table.from_batches(held)
                end = rows_held - batch.num_rows + int(starts[-1])
                yield from whole_keys(table.slice(0, end)).to_batches()
                rest = table.slice(end)
                held, rows_held = rest.to_batches(), rest.num_rows
        if rows_held:
            yield from whole_keys(pa.Table.from_batches(held)).to_batches()

    return work.mapInArrow(slide, schema)


def _attached(rows: DataFrame, found: DataFrame, tie: list[str]) -> DataFrame:
    """Join on the row's id, which may be null."""
    found = found.withColumnsRenamed({name: f"_tm_f_{name}" for name in tie})
    match = F.lit(True)
    for name in tie:
        match = match & rows[name].eqNullSafe(found[f"_tm_f_{name}"])
    return rows.join(found, match).drop(*[f"_tm_f_{name}" for name in tie])


def _range_windows(df, keys, time, bounds, features) -> DataFrame:
    by_time = Window.partitionBy(*keys).orderBy(AT)
    timed = df.withColumn(AT, micros(time))
    has_time = F.col(AT).isNotNull()
    added = [
        F.when(has_time, f.over(by_time.rangeBetween(low, high))).otherwise(f.empty()).alias(f.column(label))
        for label, (low, high) in bounds.items()
        for f in features
    ]
    return timed.select(*df.columns, *added)


CELLS = 32


def _range_pieces(df, keys, tie, bounds, features, centres) -> DataFrame:
    """Frames of a dense key put together from three pieces, one row per ``tie``, all horizons in one pass.

    Time is cut into cells, up to 32 to a horizon. A frame is the tail of its first cell, the whole cells
    in between (pre-aggregated) and the head of its last cell, so no task holds more than a cell of raw rows.
    """
    # cells divide every horizon evenly, so the ones in between lie wholly inside the frame
    lengths = [high - low + 1 for low, high in bounds.values()]
    between = max(n for n in range(1, CELLS + 1) if all(length % n == 0 for length in lengths))
    states: dict[str, tuple[Column, str]] = {}
    for feature in features:
        states |= feature.states(centres.get(feature.name, F.lit(0.0)))
    combine = {name: getattr(F, how) for name, (_, how) in states.items()}
    spans = [
        F.struct(*[F.lit(v).cast("bigint").alias(k) for k, v in zip((HORIZON, "_tm_low", "_tm_high", "_tm_length"), span, strict=True)])
        for span in ((i, low, high, (high - low + 1) // between) for i, (low, high) in enumerate(bounds.values()))
    ]
    each, part = df.select("*", F.inline(F.array(*spans))), [*keys, HORIZON]
    data = each.select(
        *part,
        F.lit(None).cast("string").alias("_tm_side"),
        F.floor(F.col(AT) / F.col("_tm_length")).alias(SLICE),
        AT,
        *[value.alias(name) for name, (value, _) in states.items()],
    )
    head_at, tail_at = F.col(AT) + F.col("_tm_high"), F.col(AT) + F.col("_tm_low")
    last_cell = F.floor(head_at / F.col("_tm_length"))
    ends = F.array(
        F.struct(F.lit("head").alias("_tm_side"), last_cell.alias(SLICE), head_at.alias("at")),
        F.struct(F.lit("tail").alias("_tm_side"), (last_cell - between).alias(SLICE), tail_at.alias("at")),
    )
    probes = each.select(*part, *tie, F.inline(ends)).withColumnRenamed("at", AT)
    stream = data.unionByName(probes, allowMissingColumns=True)
    in_cell = Window.partitionBy(*part, SLICE).orderBy(AT)
    head, tail = in_cell.rangeBetween(Window.unboundedPreceding, 0), in_cell.rangeBetween(0, Window.unboundedFollowing)
    is_head = F.col("_tm_side") == "head"
    parts = stream.withColumns(
        {name: F.when(is_head, how(name).over(head)).otherwise(how(name).over(tail)) for name, how in combine.items()}
    ).where(F.col("_tm_side").isNotNull())
    if between > 1:
        per_cell = stream.groupBy(*part, SLICE).agg(*[how(name).alias(name) for name, how in combine.items()])
        full = Window.partitionBy(*part).orderBy(SLICE).rangeBetween(1 - between, -1)
        middle = per_cell.select(
            *[F.col(k).alias(f"_tm_k_{k}") for k in part],
            F.col(SLICE).alias("_tm_cell"),
            *[how(name).over(full).alias(f"{name}_mid") for name, how in combine.items()],
        )
        match = F.col(SLICE) == F.col("_tm_cell")
        for key in part:
            match = match & F.col(key).eqNullSafe(F.col(f"_tm_k_{key}"))
        # the head row also brings the cells in between
        pieces = F.array(
            F.struct(*[F.col(name) for name in states]),
            F.struct(*[F.when(is_head, F.col(f"{name}_mid")).alias(name) for name in states]),
        )
        parts = parts.join(middle, match).select(*tie, HORIZON, F.inline(pieces))
    of_horizon = [
        how(F.when(F.col(HORIZON) == i, F.col(name))).alias(f"{name}{i}") for i in range(len(bounds)) for name, how in combine.items()
    ]
    whole = parts.groupBy(*tie).agg(*of_horizon)
    return whole.select(*tie, *[f.result(str(i)).alias(f.column(label)) for i, label in enumerate(bounds) for f in features])


def latest_known(
    rows: DataFrame,
    facts: DataFrame,
    keys,
    time: str,
    tie,
    fact_time: str,
    values: Sequence[str],
    *,
    or_equal: bool = True,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """As-of join: the newest fact of the key at (or strictly before) each row's time."""
    keys, tie = names(keys), names(tie)
    fact_rows = facts.select(
        *keys,
        F.col(fact_time).alias(time),
        F.struct(fact_time, *values).alias("_tm_fact"),
        F.lit(0 if or_equal else 2).alias("_tm_rank"),
    )
    both = rows.withColumn("_tm_rank", F.lit(1)).unionByName(fact_rows, allowMissingColumns=True)
    found = running_features(
        both, keys, time, ["_tm_rank", *tie, "_tm_fact"], [latest("_tm_found", "_tm_fact")], policy=policy
    )
    kept = found.where(F.col("_tm_rank") == 1)
    return kept.select(*rows.columns, *[F.col(f"_tm_found.{v}").alias(v) for v in [fact_time, *values]])
