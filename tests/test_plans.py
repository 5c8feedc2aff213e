"""What the plans must look like for large data."""

import re

import pytest
from pyspark.sql import functions as F

from bootloom import Model, metric_dist, prepare, split_rows
from bootloom.plans import fit


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    from bootloom.plans import tables
    path = str(tmp_path_factory.mktemp("stored") / "wide")
    tables.orders_wide(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(stored, **options):
    return prepare(stored, "y", {"m": Model("lasso", ("qty", "disc"), (5.0,))}, n_boot=3, **options)


def test_scans_are_pruned_and_filtered(stored):
    plan = plan_of(run(stored).moments())
    schemas = [s for s in re.findall(r"ReadSchema: struct<([^>]*)", plan) if "_bucket" not in s and "_range" not in s]
    assert [len(s.split(",")) for s in schemas] == [5]  # the columns used
    assert plan.count("EqualTo(test_set,0)") == 1


@pytest.mark.parametrize("cached", [False, True])
def test_a_derived_input_is_computed_once(spark, sf_dir, monkeypatch, cached):
    """One job over lineitem for the fit and one for scoring; the rest reads what they wrote. A cached
    table is written too, as its blocks may be evicted."""
    from bootloom.functions import scratch
    from bootloom.plans import tables
    orders, written = tables.orders_reg(spark, sf_dir).withColumn("own", F.lit(f"{cached}")), []
    orders = orders.cache() if cached else orders
    staged = scratch.staged
    monkeypatch.setattr(scratch, "staged", lambda df, name: written.append(
        (name, plan_of(df).count("lineitem.parquet"))) or staged(df, name))
    prepared = prepare(orders, "y", {"m": Model("lasso", ("qty", "disc"), (5.0,))}, n_boot=3)
    records = fit.to_records(prepared)
    metrics = metric_dist(records, split_rows(orders, "test"), "y")
    assert "lineitem.parquet" not in plan_of(records) + plan_of(metrics)
    assert [name for name, scans in written if scans] == ["rows", "rows"]
    orders.unpersist()


def test_stored_inputs_are_not_copied(stored, monkeypatch):
    from bootloom.functions import scratch
    monkeypatch.setattr(scratch, "staged", None)
    assert scratch.computed_once(split_rows(stored, "train").select("row_id", "qty")) is not None


def test_wide_moments_shuffle_the_rows_once(stored, monkeypatch):
    from bootloom.operators import moments, resample
    plans, staged = [], resample.staged
    monkeypatch.setattr(moments, "PARTIAL_BYTES", 1)   # a batch for every seed
    monkeypatch.setattr(resample, "staged", lambda df, name: plans.append(plan_of(df)) or staged(df, name))
    plan = plan_of(run(stored).moments())
    assert len(plans) == 1 and plans[0].count("REPARTITION_BY_NUM") == 2   # rows, counts of draws
    assert len(re.findall("Exchange ", plan)) == 1                         # partial Gram matrices


def test_rows_are_shuffled_once_and_draws_never(stored):
    plan = plan_of(run(stored).moments())
    moved = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(moved) == 2                        # the rows, and the counts of draws
    assert plan.count("xxhash64") == 1            # every draw is hashed once
    assert "partial_count" in plan and "partial_sum" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "RDD"):
        assert bad not in plan


def test_poisson_moves_no_rows(stored):
    plan = plan_of(run(stored, sampling="poisson").moments())
    assert len(re.findall(r"Exchange ", plan)) == 1   # partial Gram matrices


def test_scoring_moves_no_rows(stored):
    records = fit.to_records(run(stored, sampling="poisson"))
    plan = plan_of(metric_dist(records, split_rows(stored, "test"), "y", features=["qty", "disc"]))
    assert "Exchange " not in plan   # the records were put in a table of their own
    # Gram matrices, then one group per seed
    assert len(re.findall(r"Exchange ", plan_of(records))) == 2
