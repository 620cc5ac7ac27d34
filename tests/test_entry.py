"""The driver's contract and the shape of the plans."""

import __spark_entry__ as contract
import pytest
from tidemark.plans import PLANS
from tidemark.sources.tables import load


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "mean_prior" in df.columns


def test_queries_and_sql_share_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan_text(PLANS["l1_cutoff_features"].build(spark, folder))
    assert "LessThan" in text and "o_orderstatus" not in text.split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", [n for n, p in PLANS.items() if not n.startswith("m")])
def test_no_cross_joins(spark, folder, name):
    physical = plan_text(PLANS[name].build(spark, folder)).split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_prior_features_need_one_exchange(spark, folder):
    df = PLANS["w3_prior_running"].build(spark, folder)
    physical = plan_text(df).split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1


def test_declared_schemas_match_the_files(spark, folder):
    from tidemark.sources.tables import SCHEMAS

    for name in SCHEMAS:
        inferred = spark.read.parquet(f"{folder}/{name}.parquet").dtypes
        assert load(spark, folder, name).dtypes == inferred


def test_keys_are_counted_once(spark, folder, monkeypatch):
    """A running frame reads its input once for the keys and once for itself; later ones on the key, and copies of it, only for themselves."""
    from tidemark import skew

    made = []
    monkeypatch.setattr(skew, "_hot_keys", lambda slim, keys, policy, real=skew._hot_keys: made.append(tuple(keys)) or real(slim, keys, policy))
    monkeypatch.setattr(skew, "_known", type(skew._known)())
    for name, reads in (("w3_prior_running", 1), ("w2_running_total", 1), ("j11_as_of_per_row", 2), ("w23_second_axis", 1), ("g24_neighbours_before", None)):
        physical = plan_text(PLANS[name].build(spark, folder)).split("== Physical Plan ==")[1]
        assert reads is None or physical.count("Scan parquet") == reads or physical.count("FileScan parquet") == reads, name
    assert made.count(("o_custkey",)) == 1 and len(made) <= 6
    before = len(made)
    PLANS["l4_prior_event_features"].build(spark, folder)
    PLANS["w23_second_axis"].build(spark, folder)
    assert len(made) == before
