"""Hand-made tables for window edges, ties, missing rows and leaks."""

import math
import random
import statistics
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import bins
from tidemark.functions import dates as d
from tidemark.functions import values as v
from tidemark.operators import aggregates as agg
from tidemark.operators import entity_features as ent
from tidemark.operators import history as h
from tidemark.operators import labels
from tidemark.skew import TASKS, SkewPolicy, hot_keys, spread_join
from tidemark.sources import tables as src
from tidemark.spans import Offset, Span, day_window, days, hours, months

TIGHT = SkewPolicy(min_rows=1, max_hot=1000)
ENTITIES = [("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 1, 12)), ("c", datetime(2024, 1, 5)), ("d", None)]
EVENTS = [
    (1, "a", datetime(2023, 12, 31, 23), 5.0),  # before the entity was born
    (2, "a", datetime(2024, 1, 1), 1.0),  # on the start edge
    (3, "a", datetime(2024, 1, 3), 2.0),
    (4, "a", datetime(2024, 1, 3), None),  # same time, null measure
    (5, "a", datetime(2024, 1, 8), 4.0),  # on the end edge
    (6, "a", datetime(2024, 1, 8, 18), 8.0),  # later on the last day
    (7, "b", datetime(2024, 1, 1, 12), 3.0),  # one event only
    (8, "d", datetime(2024, 1, 2), 7.0),  # entity without an anchor
    (9, "a", datetime(2024, 2, 20), 9.0),  # after everything
]


@pytest.fixture(scope="module")
def entities(spark):
    return spark.createDataFrame(ENTITIES, "key string, born timestamp_ntz")


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "id bigint, key string, at timestamp_ntz, x double")


def found(df, *columns):
    return {row[0]: tuple(row[1:]) if len(columns) > 2 else row[1] for row in df.select(*columns).collect()}


@pytest.mark.parametrize(
    ("span", "expected"),
    [
        (Span(days(0), days(7), "both"), 4),
        (Span(days(0), days(7), "left"), 3),
        (Span(days(0), days(7), "right"), 3),
        (Span(days(0), days(7), "neither"), 2),
        (Span(days(0), days(7), "both", whole_last_day=True), 5),
        (day_window(0, 6), 3),
        (Span(days(0), days(7.75), "both"), 5),
        (Span(None, days(0), "left"), 1),
        (Span(months(0), months(1), "left"), 5),
    ],
)
@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_window_edges(entities, events, span, expected, policy):
    df = ent.anchored_features(entities, events, "key", "at", "id", "born", {"": span}, [agg.count("n")], policy=policy)
    counts = found(df, "key", "n")
    assert counts["a"] == expected
    assert counts["c"] == 0 and counts["d"] == 0
    assert len(counts) == 4


def test_edges_must_be_named():
    with pytest.raises(ValueError):
        Span(days(0), days(1), "closed")


def test_months_clamp_and_hours(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 10),)], "at timestamp_ntz")
    row = df.select(months(-1).after("at").alias("m"), hours(6).after("at").alias("h"), (-days(1.5)).after("at").alias("d")).first()
    assert row.m == datetime(2024, 2, 29, 10)
    assert row.h == datetime(2024, 3, 31, 16)
    assert row.d == datetime(2024, 3, 29, 22)


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_prior_features_ignore_later_events(events, policy):
    features = [h.past_count("n"), h.past_sum("s", "x"), h.past_mean("m", "x"), h.latest("l", "x"), h.previous("p", "x")]
    whole = h.running_features(events, "key", "at", "id", features, policy=policy)
    cut = h.running_features(events.where("id <= 5"), "key", "at", "id", features, policy=policy)
    columns = ["id", "n", "s", "m", "l", "p"]
    before = found(cut, *columns)
    after = found(whole, *columns)
    assert all(after[i] == before[i] for i in before)
    assert after[2] == (1, 5.0, 5.0, 5.0, 5.0)
    assert after[5] == (4, 8.0, 8.0 / 3, 2.0, None)  # the row before has a null measure
    assert after[7] == (0, 0.0, 0.0, None, None)


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_ties_are_ordered_by_id_or_left_out(events, policy):
    by_id = found(h.running_features(events, "key", "at", "id", [h.past_count("n")], policy=policy), "id", "n")
    strict = h.running_features(events, "key", "at", "id", [h.past_count("n")], strictly_earlier=True, policy=policy)
    strict = found(strict, "id", "n")
    assert (by_id[3], by_id[4]) == (2, 3)
    assert (strict[3], strict[4]) == (2, 2)


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_trailing_range_edges(events, policy):
    wanted = [h.Trailing("n", "count", F.col("id")), h.Trailing("s", "sum", F.col("x")), h.Trailing("m", "median", F.col("x"))]
    left = h.trailing_features(events, "key", "at", "id", {"5d": days(5)}, wanted, policy=policy)
    right = h.trailing_features(events, "key", "at", "id", {"5d": days(5)}, wanted, closed="right", policy=policy)
    left, right = found(left, "id", "n_5d", "s_5d", "m_5d"), found(right, "id", "n_5d", "s_5d", "m_5d")
    assert left[5] == (2, 2.0, 2.0)  # exactly five days back belongs, the row itself does not
    assert right[5] == (1, 4.0, 4.0)
    assert left[3] == (2, 6.0, 3.0) and left[4] == (2, 6.0, 3.0)
    assert left[9] == (0, None, None)


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_null_keys_are_one_group(spark, policy):
    rows = [(i, None if i % 2 else "k", datetime(2024, 1, 1, i), float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "id bigint, key string, at timestamp_ntz, x double")
    running = found(h.running_features(df, "key", "at", "id", [h.past_sum("s", "x")], policy=policy), "id", "s")
    assert running[7] == 9.0 and running[6] == 6.0
    sums = [h.Trailing("s", "sum", F.col("x"))]
    ranged = found(h.trailing_features(df, "key", "at", "id", {"": hours(4)}, sums, policy=policy), "id", "s")
    assert ranged[7] == 8.0


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_last_rows_and_next_value(events, policy):
    frames = {"n": F.count(F.lit(1)), "s": F.sum("x")}
    rows = h.last_rows_features(events, "key", "at", "id", -2, -1, frames, rows_per_slice=2, policy=policy)
    rows = found(rows, "id", "n", "s")
    assert rows[1] == (0, None) and rows[5] == (2, 2.0) and rows[9] == (2, 12.0)
    following = found(h.next_value(events, "key", "at", "id", "id", "next", policy), "id", "next")
    assert following[6] == 9 and following[9] is None and following[3] == 4


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_as_of_join_edge(spark, events, policy):
    facts = spark.createDataFrame(
        [("a", datetime(2024, 1, 3), "new"), ("a", datetime(2024, 1, 1), "old"), ("z", datetime(2020, 1, 1), "other")],
        "key string, known_at timestamp_ntz, state string",
    )
    at_or_before = h.latest_known(events, facts, "key", "at", "id", "known_at", ["state"], policy=policy)
    before = h.latest_known(events, facts, "key", "at", "id", "known_at", ["state"], or_equal=False, policy=policy)
    at_or_before, before = found(at_or_before, "id", "state"), found(before, "id", "state")
    assert at_or_before[3] == "new" and before[3] == "old"
    assert at_or_before[1] is None and at_or_before[7] is None
    assert len(at_or_before) == len(EVENTS)


def test_entities_with_only_later_events_stay(entities, events):
    cutoff = F.lit("2024-01-01").cast("timestamp_ntz")
    windows = {"": Span(None, days(0), "left")}
    df = ent.cutoff_features(entities, events, "key", "at", cutoff, windows, [agg.count("n"), agg.total("s", "x")])
    assert found(df, "key", "n", "s") == {"a": (1, 5.0), "b": (0, 0.0), "c": (0, 0.0), "d": (0, 0.0)}


def test_counts_over_entities_equal_filtered_events(entities, events):
    cutoff = F.lit("2024-01-08").cast("timestamp_ntz")
    df = ent.cutoff_features(entities, events, "key", "at", cutoff, {"": Span(None, days(0), "right")}, [agg.count("n")])
    assert df.agg(F.sum("n")).first()[0] == events.where(F.col("at") <= cutoff).count()


def test_two_event_tables_do_not_multiply(spark, entities, events):
    other = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, y int")
    df = agg.attach_summary(entities, events, "key", [agg.count("n")])
    df = agg.attach_summary(df, other, "key", [agg.total("y", "y", 0), agg.count("m")])
    assert found(df, "key", "n", "y", "m")["a"] == (7, 3, 2)


def test_recency_and_never(entities, events):
    cutoff = F.lit("2024-01-10").cast("timestamp_ntz")
    df = ent.recency(entities, events, "key", "at", cutoff, "gap", ent.never_constant())
    assert found(df, "key", "gap") == {"a": 1.25, "b": 8.5, "c": 9999.0, "d": 8.0}


def test_labels(entities, events):
    cutoff, week = F.lit("2024-01-08").cast("timestamp_ntz"), Span(days(0), days(7), "right")
    seen = found(labels.event_label(entities, events, "key", "at", cutoff, week, "y"), "key", "y")
    gone = found(labels.no_event_label(entities, events, "key", "at", cutoff, week, "y"), "key", "y")
    assert seen == {"a": 1, "b": 0, "c": 0, "d": 0}
    assert all(gone[k] == 1 - seen[k] for k in seen)
    change = labels.state_change_label(entities, "born", F.lit("2024-01-01").cast("timestamp_ntz"), week, "y")
    assert found(change, "key", "y") == {"b": 1, "c": 1, "d": 0}


def test_mode_ties_go_to_the_smallest(spark):
    rows = [("a", "x"), ("a", "w"), ("a", None), ("b", "q"), ("b", "q"), ("b", "a")]
    df = spark.createDataFrame(rows, "key string, v string")
    assert found(agg.top_value(df, "key", "v", "m"), "key", "m") == {"a": "w", "b": "q"}


def test_bin_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,)], "x double")
    right = [r[0] for r in df.select(bins.cut("x", [0, 1, 3], ["l", "h"])).collect()]
    lowest = [r[0] for r in df.select(bins.cut("x", [0, 1, 3], ["l", "h"], include_lowest=True)).collect()]
    left = [r[0] for r in df.select(bins.cut("x", [0, 1, 3], ["l", "h"], closed="left")).collect()]
    assert right == [None, "l", "h", "h", None]
    assert lowest == ["l", "l", "h", "h", None]
    assert left == ["l", "h", "h", None, None]
    tiers = bins.zero_and_quantile_tiers(df.na.fill(0.0), "x", ["none", "low", "high"], "t")
    assert sorted(r.t for r in tiers.collect()) == ["high", "low", "low", "none", "none"]


def test_ratios_and_whole_days(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(v.safe_ratio("a", "b", -1.0)).collect()] == [-1.0, 0.5, -1.0]
    moments = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 2, 12))], "a timestamp_ntz, b timestamp_ntz")
    row = moments.select(d.days_truncated("a", "b").alias("t"), d.days_floored("a", "b").alias("f"), d.elapsed_days("a", "b").alias("e")).first()
    assert (row.t, row.f, row.e) == (-1, -2, -1.5)


def test_skewness_matches_the_corrected_formula(spark):
    x = [1.0, 2.0, 3.0, 10.0, 25.0]
    df = spark.createDataFrame([(i,) for i in x], "x double")
    n, mean = len(x), sum(x) / len(x)
    m2, m3 = sum((i - mean) ** 2 for i in x) / n, sum((i - mean) ** 3 for i in x) / n
    expected = m3 / m2**1.5 * (n * (n - 1)) ** 0.5 / (n - 2)
    assert df.agg(agg.sample_skewness(F.col("x"))).first()[0] == pytest.approx(expected)


def test_quantiles_split_equal_plain(spark):
    rows = [("a" if i % 3 else "b", float(i * i % 97)) for i in range(500)] + [("c", 1.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    plain = {r[0]: tuple(r)[1:] for r in agg.exact_quantiles(df, "x", shares, "k").collect()}
    split = {r[0]: tuple(r)[1:] for r in agg.exact_quantiles(df, "x", shares, "k", TIGHT).collect()}
    assert plain.keys() == split.keys()
    for key in plain:
        assert plain[key] == pytest.approx(split[key])


def test_hot_keys_are_few_and_joins_stay_whole(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(600)]
    big = spark.createDataFrame(rows, "id bigint, key string")
    small = big.select("key").distinct().withColumn("y", F.length("key"))
    policy = SkewPolicy(min_rows=30, max_hot=100)
    assert [(r.key, r[TASKS]) for r in hot_keys(big, ["key"], policy).collect()] == [("hot", 7)]
    joined = spread_join(big, small, "key", "id", policy)
    assert joined.count() == 600 and joined.select("id").distinct().count() == 600


def test_table_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",)], "name string")
    rules = src.check_table(df, "id int NOT NULL, ref string", "id", [("ref", parent, "name")])
    assert found(rules, "rule", "offenders") == {"unique id": 1, "reference ref": 1, "not null id": 1}
    with pytest.raises(ValueError):
        src.check_table(df, "id bigint, ref string", "id")


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-31", "1.5"), ("31.1.2024", "x")], "day string, number string")
    rows = df.select(src.parse_time("day", "yyyy-MM-dd").alias("d"), src.parse_number("number").alias("n")).collect()
    assert rows[0].d == datetime(2024, 1, 31) and rows[0].n == 1.5
    assert rows[1].d is None and rows[1].n is None


def test_grid_checks_its_levels(spark, entities):
    source = spark.createDataFrame([("x",), ("y",), ("x",)], "kind string")
    assert ent.category_grid(entities.select("key"), source, "kind").count() == 8
    with pytest.raises(Exception, match="more than 1 levels"):
        ent.category_grid(entities.select("key"), source, "kind", limit=1).collect()


def test_offsets_reject_calendar_horizons(events):
    with pytest.raises(ValueError):
        h.trailing_features(events, "key", "at", "id", {"m": months(1)}, [h.Trailing("n", "count", F.col("id"))])
    with pytest.raises(ValueError):
        h.trailing_features(events, "key", "at", "id", {"z": Offset()}, [h.Trailing("n", "count", F.col("id"))])


def test_all_dense_equals_range_frames(spark, events):
    wanted = [h.Trailing(k, k, F.col("x")) for k in ("count", "sum", "mean", "min", "max", "std")]
    columns = ["id", *[f"{k}_w" for k in ("count", "sum", "mean", "min", "max", "std")]]
    plain = found(h.trailing_features(events, "key", "at", "id", {"w": days(7)}, wanted), *columns)
    dense = found(h.trailing_features(events, "key", "at", "id", {"w": days(7)}, wanted, all_dense=True, policy=TIGHT), *columns)
    assert plain.keys() == dense.keys()
    for key in plain:
        assert plain[key] == pytest.approx(dense[key])


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(min_rows=50, max_hot=10)])
def test_left_spread_join_keeps_every_row(spark, policy):
    rows = [(i, None if i % 4 == 0 else "hot" if i % 4 < 3 else f"k{i}") for i in range(400)]
    big = spark.createDataFrame(rows, "id bigint, key string")
    small = spark.createDataFrame([("hot", 1), ("other", 2)], "key string, y int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = found(spread_join(big, small, "key", "id", policy, how="left"), "id", "y")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(joined) == 400 and sum(1 for y in joined.values() if y == 1) == 200


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_rows_without_time_or_id_are_kept(spark, policy):
    rows = [(1, "a", datetime(2024, 1, 1), 1.0), (2, "a", datetime(2024, 1, 1, 6), 2.0), (3, "a", None, 4.0), (4, "a", None, 8.0), (None, "a", datetime(2024, 1, 1, 12), 16.0), (6, "b", None, 3.0)]
    df = spark.createDataFrame(rows, "id bigint, key string, at timestamp_ntz, x double")
    wanted = [h.Trailing("n", "count", F.col("x")), h.Trailing("s", "sum", F.col("x")), h.Trailing("d", "distinct", F.col("x"))]
    got = found(h.trailing_features(df, "key", "at", "id", {"1d": days(1)}, wanted, policy=policy), "id", "n_1d", "s_1d", "d_1d")
    assert got == {1: (0, None, 0), 2: (1, 1.0, 1), 3: (0, None, 0), 4: (0, None, 0), None: (2, 3.0, 2), 6: (0, None, 0)}
    strict = found(h.running_features(df, "key", "at", "id", [h.past_count("n"), h.past_sum("s", "x")], strictly_earlier=True, policy=policy), "id", "n", "s")
    assert strict == {1: (2, 12.0), 2: (3, 13.0), 3: (0, 0.0), 4: (0, 0.0), None: (4, 15.0), 6: (0, 0.0)}


def test_latest_needs_an_order_of_rows(events):
    with pytest.raises(ValueError):
        h.running_features(events, "key", "at", "id", [h.latest("x_at", "x")], strictly_earlier=True)


def test_horizons_that_no_cell_divides(spark, events):
    wanted = [h.Trailing("n", "count", F.col("id")), h.Trailing("s", "sum", F.col("x"))]
    odd = {"odd": Offset(us=7 * 86_400_000_000 + 1), "even": days(7)}
    columns = ["id", "n_odd", "s_odd", "n_even", "s_even"]
    plain = found(h.trailing_features(events, "key", "at", "id", odd, wanted), *columns)
    assert found(h.trailing_features(events, "key", "at", "id", odd, wanted, policy=TIGHT), *columns) == plain


def test_a_busy_day_is_cut_by_rows(spark):
    rows = spark.range(2000).select("id", F.lit("k").alias("key"), F.lit(datetime(2024, 1, 1)).alias("at"))
    sliced = h._sliced(rows, ["key"], ["at", "id"], ["at", "id"], rows, SkewPolicy(min_rows=100, max_hot=100))
    sizes = [r["count"] for r in sliced.groupBy(h.SLICE).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) >= 15 and max(sizes) < 300


@pytest.mark.parametrize("closed", ["left", "right"])
@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(min_rows=20, max_hot=1000)])
def test_medians_and_distinct_values_of_trailing_ranges(spark, closed, policy):
    draw = random.Random(4)
    day = datetime(2024, 1, 1)
    rows = [
        (i, "hot" if i % 3 else f"k{i % 7}", day + timedelta(minutes=draw.randint(0, 600)) if i % 11 else None, draw.choice([None, 1.5, -2.0, 3.0, 4.25, float(i)]))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "id bigint, key string, at timestamp_ntz, x double").repartition(4)
    wanted = [h.Trailing("mid", "median", F.col("x")), h.Trailing("kinds", "distinct", F.col("x")), h.Trailing("n", "count", F.col("x"))]
    got = found(h.trailing_features(df, "key", "at", "id", {"h": hours(1), "d": hours(6)}, wanted, closed=closed, policy=policy),
                "id", "mid_h", "kinds_h", "n_h", "mid_d", "kinds_d", "n_d")
    assert len(got) == 300
    for id_, key, at, _ in rows:
        expected = []
        for reach in (timedelta(hours=1), timedelta(hours=6)):
            near = lambda t: at - reach <= t < at if closed == "left" else at - reach < t <= at
            frame = [x for _, k, t, x in rows if at and t and k == key and x is not None and near(t)]
            expected += [statistics.median(frame) if frame else None, len(set(frame)), len(frame)]
        assert got[id_] == tuple(expected), id_


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(min_rows=20, max_hot=1000)])
def test_distinct_values_of_last_rows(spark, policy):
    draw = random.Random(5)
    rows = [(i, "hot" if i % 3 else None, draw.choice([None, "a", "b", "c", "d"])) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, key string, kind string")
    got = found(h.distinct_last_rows(df, "key", "id", [], "kind", 4, "n", policy), "id", "n")
    for i, key, _ in rows:
        before = [kind for j, k, kind in rows if k == key and j < i][-4:]
        assert got[i] == len({kind for kind in before if kind})


def test_ordered_bits_are_those_of_the_number(spark):
    draw = random.Random(6)
    edges = [0.0, -0.0, 5e-324, 2.225073858507201e-308, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, 0.1, 1 - 2**-53, 1 + 2**-52]
    powers = [x for k in range(-1074, 1024, 17) for x in (2.0**k, math.nextafter(2.0**k, 0.0), -math.nextafter(2.0**k, math.inf))]
    values = edges + powers + [draw.gauss(0, 1) * 10.0 ** draw.randint(-300, 300) for _ in range(300)]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", agg.ordered_bits(F.col("x")).alias("bits")).collect()
    for row in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(row.x)))[0]
        assert row.bits == (-bits if row.x < 0 else bits), row.x
    assert spark.range(1).select(agg.ordered_bits(F.lit(math.nan))).first()[0] > (2047 << 52)


@pytest.mark.parametrize("few", [1, 1 << 16])
def test_quantiles_refine_to_the_last_bit(spark, monkeypatch, few):
    monkeypatch.setattr(agg, "FEW", few)
    draw = random.Random(7)
    groups = {"close": [1 + k * 2.0**-52 for k in range(40)], "wide": [draw.choice([-1, 1]) * 10.0 ** draw.randint(-300, 300) for _ in range(200)],
              "ties": [0.0, -0.0] * 30 + [1.0], None: [7.5], "inf": [math.inf, math.inf, 5.0]}
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in [*xs, None]], "k string, x double")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {row.k: tuple(row)[1:] for row in agg.exact_quantiles(df, "x", shares, "k").collect()}
    assert got.keys() == groups.keys()
    for key, xs in groups.items():
        xs = sorted(xs)
        for share, value in zip(shares, got[key], strict=True):
            at = (len(xs) - 1) * share
            low, high = xs[math.floor(at)], xs[math.ceil(at)]
            assert value == (low if low == high else low + (high - low) * (at - math.floor(at)))
    assert agg.exact_quantiles(df.where("x is null"), "x", [0.5], "k").count() == 0
    assert agg.exact_quantiles(df.where("x is null"), "x", [0.5]).first() is None or agg.exact_quantiles(df.where("x is null"), "x", [0.5]).first().q0 is None


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_window_joins_make_few_pairs_beside_the_matching_ones(spark, policy):
    minutes = lambda n: F.timestamp_micros(n * 60_000_000).cast("timestamp_ntz")
    events = spark.range(3000).select("id", F.lit("k").alias("key"), minutes(F.col("id") * 7).alias("at"))
    anchors = spark.range(400).select(F.col("id").alias("anchor_id"), F.lit("k").alias("key"), minutes(F.col("id") * 50).alias("born"))
    span = Span(hours(-3), hours(4), "both")
    pairs = ent.candidate_pairs(events, anchors, "key", "at", "id", "born", [span], policy).count()
    joined = ent.window_join(anchors, events, "key", "at", "id", "born", span, policy)
    matching = [(a, e) for a in range(400) for e in range(3000) if -180 <= e * 7 - a * 50 <= 240]
    assert sorted((r.anchor_id, r.id) for r in joined.collect()) == matching
    assert pairs < 4 * len(matching) < 1_200_000 / 10


@pytest.mark.parametrize("span", [Span(months(-1), months(1), "both"), Span(months(1), months(2), "left"), Span(days(0), months(1), "both", whole_last_day=True)])
def test_cells_hold_calendar_windows(spark, span):
    draw = random.Random(8)
    day = datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, "k", day + timedelta(hours=draw.randint(0, 9000))) for i in range(300)], "id bigint, key string, at timestamp_ntz")
    anchors = spark.createDataFrame([(i, "k", day + timedelta(hours=draw.randint(0, 9000))) for i in range(40)], "anchor_id bigint, key string, born timestamp_ntz")
    plain = anchors.join(events, "key").where(span.contains("at", "born"))
    cells = ent.window_join(anchors, events, "key", "at", "id", "born", span)
    assert sorted(map(tuple, cells.select("anchor_id", "id").collect())) == sorted(map(tuple, plain.select("anchor_id", "id").collect()))


def test_row_rules_take_one_pass_and_checked_writes_count_alike(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (None, 50.0), (3, None)], "id int, x double")
    declared, ranges = "id int NOT NULL, x double NOT NULL", {"x": (0, 10)}
    rules = src.check_table(df, declared, ranges=ranges)
    want = {"not null id": 1, "not null x": 1, "range x": 1}
    assert found(rules, "rule", "offenders") == want
    assert str(rules._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 1
    assert found(src.write_checked(df, str(tmp_path / "t"), declared, ranges), "rule", "offenders") == {"rows": 3} | want
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    none = src.write_checked(df.limit(0), str(tmp_path / "none"), declared, ranges)
    assert set(found(none, "rule", "offenders").values()) == {0}


def test_a_replayed_append_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "rows")
    for day, n in (("a", 3), ("b", 2), ("a", 3)):
        src.append(spark.range(n), path, batch=("day", day))
    assert sorted(map(tuple, spark.read.parquet(path).groupBy("day").count().collect())) == [("a", 3), ("b", 2)]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    tables = [src.write_bucketed(spark.range(1000).withColumn(x, F.col("id") * 2), f"edge_{x}", str(tmp_path / x), "id", 4) for x in ("x", "y")]
    joined = tables[0].join(tables[1].hint("merge"), "id")
    assert joined.where("x = y").count() == 1000
    assert "Exchange" not in joined._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    for x in ("x", "y"):
        spark.sql(f"DROP TABLE edge_{x}")


@pytest.mark.parametrize("policy", [SkewPolicy(), TIGHT])
def test_grids_of_any_number_of_levels(spark, policy):
    entities = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "key string, n int")
    source = spark.createDataFrame([(f"x{i % 13:02}",) for i in range(40)] + [(None,)], "kind string")
    grid = ent.category_grid(entities, source, "kind", per_block=5, policy=policy)
    assert grid.columns == ["key", "n", "kind"]
    assert sorted(map(str, grid.collect())) == sorted(map(str, entities.join(source.distinct().where("kind IS NOT NULL")).collect()))
    assert ent.category_grid(entities, source.limit(0), "kind").count() == 0
