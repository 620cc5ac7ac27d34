"""Every registered plan against its SQL statement, and once more with busy keys split."""

import pytest

from tests.compare import connect, differences
from tidemark.plans import PLANS
from tidemark.skew import DEFAULT

WITH_SQL = [name for name, plan in PLANS.items() if plan.sql]
# plans that go through the skew-safe paths
SPLITTABLE = [
    "g22_peer_averages", "g24_neighbours_before", "j3_star_join", "j6_history_range", "j11_as_of_per_row", "l2_first_n_days",
    "l4_prior_event_features", "l5_range_history", "l15_next_value", "l22_exposure_features", "w2_running_total",
    "w3_prior_running", "w3_strictly_earlier", "w3_strictly_earlier_null_times", "w5_trailing_range_null_times", "w4_last_n_rows", "w5_trailing_range", "w6_lag_with_default", "w7_next_row",
    "w8_last_time_condition_held", "w11_global_row_number", "w12_distinct_before", "w12_distinct_last_rows", "w15_rolling_time_mean",
    "w16_rolling_rows_mean", "w18_multi_horizon", "w23_second_axis", "g5_group_statistics", "e1_five_numbers",
    "b4_zero_and_terciles", "m19_chronological_split", "m26_ranking_quality",
]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", WITH_SQL)
def test_plan_equals_sql(spark, con, folder, name):
    assert differences(spark, con, folder, PLANS[name]) is None


@pytest.mark.parametrize("name", SPLITTABLE)
def test_split_plan_equals_sql(spark, con, folder, name, monkeypatch):
    for field, value in {"min_rows": 8, "max_hot": 100_000}.items():
        monkeypatch.setitem(DEFAULT.__dict__, field, value)
    assert differences(spark, con, folder, PLANS[name]) is None
