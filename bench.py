"""Times the headline queries, the faster of two runs each, and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import PLANS
from tidemark.session import local_session

HEADLINE = [
    "l4_prior_event_features", "w3_prior_running", "w5_trailing_range", "w18_multi_horizon", "w23_second_axis", "l1_cutoff_features",
    "l2_first_n_days", "l5_range_history", "l6_static_history", "l21_order_offsets", "l22_exposure_features", "g1_group_by_key",
    "g3_count_distinct", "g5_group_statistics", "g15_ratio_of_aggregates", "g17_several_windows", "g24_neighbours_before",
    "j3_star_join", "j4_composite_key_join", "j6_history_range", "j11_as_of_per_row", "j13_aggregate_then_join", "w12_distinct_before",
    "b4_zero_and_terciles", "l10_future_event", "l14_future_tier", "m9_text_weights", "m26_ranking_quality", "x5_count_matches",
]


def timed(spark, folder: str, name: str) -> float:
    begun = time.perf_counter()
    # every row and column is computed, nothing is sent to the driver
    PLANS[name].build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cores, "bench")
    # the first run of a query also pays for compiling its code
    seconds = {name: round(min(timed(spark, folder, name) for _ in range(2)), 3) for name in HEADLINE}
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
