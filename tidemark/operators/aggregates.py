"""Group aggregates, shares, quantiles, modes and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.history import Past, running_features
from tidemark.skew import DEFAULT, SkewPolicy, names, settle, spread_join
from tidemark.spans import column


@dataclass(frozen=True)
class Measure:
    """One aggregate over events. Each kind combines partially before the shuffle."""

    name: str
    kind: str
    value: Column
    default: object = None

    def aggregate(self, when: Column | None = None) -> Column:
        value = self.value if when is None else F.when(when, self.value)
        functions = {
            "count": F.count,
            "sum": F.sum,
            "mean": F.avg,
            "min": F.min,
            "max": F.max,
            "any": lambda c: F.max(c.cast("int")),
            "distinct": F.count_distinct,
            "std": F.stddev_samp,
            "positive_mean": lambda c: F.avg(F.when(c > 0, c)),
        }
        return functions[self.kind](value)


def count(name: str, when: Column | None = None) -> Measure:
    return Measure(name, "count", F.lit(1) if when is None else F.when(when, F.lit(1)), 0)


def total(name: str, value, default=0.0) -> Measure:
    return Measure(name, "sum", column(value), default)


def mean(name: str, value, default=None) -> Measure:
    return Measure(name, "mean", column(value), default)


def smallest(name: str, value, default=None) -> Measure:
    return Measure(name, "min", column(value), default)


def largest(name: str, value, default=None) -> Measure:
    return Measure(name, "max", column(value), default)


def any_flag(name: str, condition: Column) -> Measure:
    return Measure(name, "any", condition, 0)


def distinct(name: str, value) -> Measure:
    return Measure(name, "distinct", column(value), 0)


def spread(name: str, value, default=None) -> Measure:
    return Measure(name, "std", column(value), default)


def positive_mean(name: str, value) -> Measure:
    """Average of the values above zero, 0 when there are none."""
    return Measure(name, "positive_mean", column(value), 0.0)


def rate(name: str, flag: Column, default=None) -> Measure:
    return Measure(name, "mean", flag.cast("double"), default)


def summarise(df: DataFrame, keys, measures: Sequence[Measure]) -> DataFrame:
    return df.groupBy(*names(keys)).agg(*[m.aggregate().alias(m.name) for m in measures])


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls left by an entity without events; a missing default leaves the null."""
    filled = {
        name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
        for name, value in defaults.items()
        if value is not None
    }
    return df.withColumns(filled) if filled else df


def attach_summary(
    rows: DataFrame,
    source: DataFrame,
    keys,
    measures: Sequence[Measure],
    row_id=None,
    hot_from: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Aggregate ``source`` to the keys first, then join: rows never multiply.

    Without ``row_id`` the rows are entities, one per key. With it a key may have any number of rows, and
    the rows of a hot key are spread.
    """
    summary, keys = summarise(source, keys, measures), names(keys)
    if row_id is None:
        joined = rows.join(summary, keys, "left")
    else:
        joined = spread_join(rows, summary, keys, row_id, policy, how="left", hot_from=hot_from)
    return fill_defaults(joined, {m.name: m.default for m in measures})


def group_totals(df: DataFrame, keys, measures: Sequence[Measure], row_id, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Whole-group aggregates on every row, without gathering a group in one task."""
    return attach_summary(df, df, keys, measures, row_id, policy=policy)


#: Bits of a value that one pass over the rows settles, and how many rows of a bucket may be told apart at once.
LEVEL = 16
FEW = 1 << LEVEL


def ordered_bits(value: Column) -> Column:
    """A double as a long in the same order, equal for equal values (-0.0 is 0.0, NaN above all): its sign, exponent and fraction."""
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    part = size / F.pow(F.lit(2.0), guess)
    # the logarithm may round over a power of two
    exponent = guess + F.when(part < 1, F.lit(-1)).when(part >= 2, F.lit(1)).otherwise(F.lit(0))
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)).cast("bigint")
    half = F.lit(2.0**537)
    bits = (
        F.when(F.isnan(value), F.lit((2047 << 52) + 1))
        .when(size == float("inf"), F.lit(2047 << 52))
        .when(size < 2.0**-1022, (size * half * half).cast("bigint"))
        .otherwise((exponent + 1023) * F.lit(1 << 52) + fraction)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], by=(), policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Exact, linearly interpolated quantiles as columns q0, q1, … per group.

    Found by counting: rows are counted by the leading bits of their values, which tells the bucket of each wanted
    rank; the rows of these buckets are counted by more bits, until a bucket is one value. Each pass combines on
    the map side and moves counts, never values; no group or bucket is sorted or gathered, and as only whole numbers
    are added, the result is the same whenever it is computed. As soon as the buckets have at most ``FEW`` rows, the
    rest of the bits are taken at once, so most tables take two passes and none more than four.
    """
    by, shares = names(by), [float(share) for share in shares]
    keys = [f"_tm_b{i}" for i in range(len(by))]
    x = F.col(value).cast("double")
    # a group's key may be null: structs of nulls are equal
    rows = df.select(*[F.struct(F.col(b)).alias(k) for b, k in zip(by, keys, strict=True)], x.alias("_tm_x")).where(F.col("_tm_x").isNotNull())
    rows = rows.withColumn("_tm_bits", ordered_bits(F.col("_tm_x")))
    shift = 64 - LEVEL
    counts = rows.groupBy(*keys, F.shiftright("_tm_bits", shift).alias("_tm_bucket")).agg(F.count(F.lit(1)).alias("_tm_c"), F.max("_tm_x").alias("_tm_x"))
    whole = Window.partitionBy(*keys)
    at = [(F.col("_tm_n") - 1).cast("double") * F.lit(share) for share in shares]
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), rank.alias("rank")) for i, rank in enumerate(r for a in at for r in (F.floor(a), F.ceil(a)))])
    counts = counts.withColumn("_tm_n", F.sum("_tm_c").over(whole)).withColumn("_tm_hits", ranks)
    picked = _holding(counts, keys)
    while shift:
        picked = settle(picked, "buckets")
        most = picked.agg(F.max("_tm_c")).first()[0]
        narrower = 0 if most is None or most <= FEW else shift - LEVEL
        held = picked.select(*keys, F.col("_tm_bucket").alias("_tm_parent"))
        inside = rows.withColumn("_tm_parent", F.shiftright("_tm_bits", shift)).join(held, [*keys, "_tm_parent"])
        counts = inside.groupBy(*keys, "_tm_parent", F.shiftright("_tm_bits", narrower).alias("_tm_bucket")).agg(
            F.count(F.lit(1)).alias("_tm_c"), F.max("_tm_x").alias("_tm_x")
        )
        wanted = picked.select(*keys, F.col("_tm_bucket").alias("_tm_parent"), "_tm_n", "_tm_hits")
        picked, shift = _holding(counts.join(wanted, [*keys, "_tm_parent"]), [*keys, "_tm_parent"]), narrower
    each = picked.select(*keys, "_tm_n", "_tm_x", F.inline("_tm_hits"))
    ends = [F.max(F.when(F.col("i") == i, F.col("_tm_x"))).alias(f"_tm_e{i}") for i in range(2 * len(shares))]
    found = each.groupBy(*keys).agg(F.first("_tm_n").alias("_tm_n"), *ends)
    columns = []
    for i, place in enumerate(at):
        low, high = F.col(f"_tm_e{2 * i}"), F.col(f"_tm_e{2 * i + 1}")
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(*[F.col(k)[b].alias(b) for b, k in zip(by, keys, strict=True)], *columns)


def _holding(counts: DataFrame, part: list[str]) -> DataFrame:
    """The buckets in which wanted ranks (``_tm_hits``, counted within ``part``) lie, each with its ranks counted within the bucket."""
    until = F.sum("_tm_c").over(Window.partitionBy(*part).orderBy("_tm_bucket").rowsBetween(Window.unboundedPreceding, 0))
    start, end = F.col("_tm_until") - F.col("_tm_c"), F.col("_tm_until")
    inside = F.filter("_tm_hits", lambda hit: (hit["rank"] >= start) & (hit["rank"] < end))
    moved = F.transform(inside, lambda hit: F.struct(hit["i"].alias("i"), (hit["rank"] - start).alias("rank")))
    return counts.withColumn("_tm_until", until).withColumn("_tm_hits", moved).where(F.size("_tm_hits") > 0).drop("_tm_until")


def thresholds(df: DataFrame, value: str, shares: Sequence[float], *, non_zero: bool = False, policy=DEFAULT) -> list[Column]:
    """Quantiles of a column as one-row subqueries, usable in any expression."""
    source = df.where(F.col(value) > 0) if non_zero else df
    points = exact_quantiles(source, value, shares, policy=policy)
    packed = points.select(F.array(*[f"q{i}" for i in range(len(shares))])).scalar()
    return [F.get(packed, F.lit(i)) for i in range(len(shares))]


def describe_groups(df: DataFrame, by, value: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per group."""
    by = names(by)
    stats = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, value, (0.25, 0.5, 0.75), by, policy).toDF(*by, "p25", "median", "p75")
    return stats.join(quartiles, by, "left")


def top_value(df: DataFrame, keys, value: str, name: str, score: Column | None = None) -> DataFrame:
    """Most frequent value per key, or the one with the largest summed score; ties go to the smallest."""
    keys = names(keys)
    weight = F.count(F.lit(1)) if score is None else F.sum(score)
    scored = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(weight.alias("_tm_weight"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_tm_weight"), F.asc(value)))
    return scored.withColumn("_tm_rank", rank).where("_tm_rank = 1").select(*keys, F.col(value).alias(name))


def cross_table(df: DataFrame, rows: str, columns: str, levels: Sequence[str], *, shares: bool = False) -> DataFrame:
    """Counts (or row shares) of ``columns`` levels per value of ``rows``."""
    table = df.groupBy(rows).pivot(columns, list(levels)).agg(F.count(F.lit(1))).na.fill(0, list(levels))
    if not shares:
        return table
    whole = sum((F.col(level) for level in levels), F.lit(0))
    return table.select(rows, *[(F.col(level) / F.nullif(whole, F.lit(0))).alias(level) for level in levels])


def class_shares(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (F.col("n") / whole).alias("share"))


def sample_skewness(value) -> Column:
    """Bias-corrected skewness; Spark's own function is the uncorrected one."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation matrix as (a, b, r) rows, one aggregate pass over each pair once."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one_row = df.agg(*[F.corr(a, b).alias(f"_tm_{i}") for i, (a, b) in enumerate(pairs)])
    both = [(x, y, i) for i, (a, b) in enumerate(pairs) for x, y in dict.fromkeys([(a, b), (b, a)])]
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_tm_{i}").alias("r")) for a, b, i in both]
    return one_row.select(F.inline(F.array(*cells)))


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, mean, deviation, minimum and maximum per numeric column, one pass."""
    stats = {
        "n_rows": lambda c: F.count(F.lit(1)),
        "n_null": lambda c: F.count_if(F.col(c).isNull()),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    one_row = df.agg(*[make(c).alias(f"_tm_{i}_{name}") for i, c in enumerate(columns) for name, make in stats.items()])
    cells = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"_tm_{i}_{name}").alias(name) for name in stats])
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def above_peer_average(df: DataFrame, key: str, peer: str, value: str) -> DataFrame:
    """Keys whose total is above the average total of their peers."""
    totals = df.groupBy(key, peer).agg(F.sum(value).alias("total"))
    averages = totals.groupBy(peer).agg(F.avg("total").alias("peer_average"))
    return spread_join(totals, averages, peer, key).where(F.col("total") > F.col("peer_average"))


def peer_averages(
    entities: DataFrame, key: str, rows: DataFrame, peers: Sequence[str], value: str, columns: Sequence[str], overall: str
) -> DataFrame:
    """Average of a value per peer group and overall, attached to each entity."""
    joined = entities
    for peer, name in zip(peers, columns, strict=True):
        joined = attach_summary(joined, rows, peer, [mean(name, value)], key, entities)
    return joined.withColumn(overall, rows.agg(F.avg(value)).scalar())


def neighbours_before(
    df: DataFrame, group: str, own: str, time: str, tie, value: str, prefix: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Average and count over the group's strictly earlier rows, leaving out the row's own key.

    Computed as the group's running totals minus the key's own, not as a join on "other key".
    """
    def states(side):
        return [Past(f"_tm_{side}_s", "sum", F.col(value), 0.0), Past(f"_tm_{side}_n", "count", F.col(value), 0)]

    with_group = running_features(df, group, time, tie, states("g"), strictly_earlier=True, policy=policy)
    both = running_features(
        with_group, [group, own], time, tie, states("o"), strictly_earlier=True, hot_from=df, policy=policy
    )
    n = F.col("_tm_g_n") - F.col("_tm_o_n")
    s = F.col("_tm_g_s") - F.col("_tm_o_s")
    return both.select(
        *df.columns,
        F.coalesce(s / F.nullif(n, F.lit(0)), F.lit(0.0)).alias(f"{prefix}_mean"),
        n.alias(f"{prefix}_count"),
    )
