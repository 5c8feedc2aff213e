import numpy as np
import pytest

from bootloom.operators import summary
from test_score import make_records


@pytest.fixture(scope="module")
def records(spark):
    return make_records(spark, [
        ("m", 0, 1.0, {"a": 0.0, "b_kind_x": 2.0, "intercept": 5.0}),
        ("m", 1, 0.0, {"a": 1.0, "b_kind_x": 3.0, "intercept": 0.0}),
        ("m", 2, 2.0, {"a": 0.0, "b_kind_x": 4.0}),
        ("k", 0, 3.0, {"a": 1.0}),
    ])


def test_a_feature_called_intercept_keeps_apart(records):
    rows = [tuple(r) for r in summary.coef_table(records).where("model = 'm'").collect()]
    assert ("m", 0, "intercept", False, 5.0) in rows and ("m", 0, "intercept", True, 1.0) in rows
    assert len(rows) == 4 + 4 + 3


def test_wide_table_has_gaps_for_missing_features(spark):
    records = make_records(spark, [("m", 0, 1.0, {"a": 2.0}), ("m", 1, 5.0, {"c": 3.0})])
    wide = summary.coef_wide(records).orderBy("seed")
    assert wide.columns == ["model", "seed", "a", "c", "intercept"]
    assert [tuple(r) for r in wide.collect()] == [("m", 0, 2.0, None, 1.0), ("m", 1, None, 3.0, 5.0)]


def test_wide_table_refuses_a_feature_called_intercept(records):
    with pytest.raises(ValueError, match="long form"):
        summary.coef_wide(records)


def test_selection_frequency_counts_a_features_own_replicates(records):
    coefs = summary.coef_table(records)
    got = {(r["model"], r["feature"]): r["p_nonzero"] for r in
           summary.selection_freq(coefs).collect()}
    assert got == {("m", "a"): 1 / 3, ("m", "b_kind_x"): 1.0, ("m", "intercept"): 0.5,
                   ("k", "a"): 1.0}
    with_it = summary.selection_freq(coefs, include_intercept=True)
    assert {(r["model"], r["p_nonzero"]) for r in with_it.where("is_intercept").collect()} == {
        ("m", 2 / 3), ("k", 1.0)}


def test_rank_and_count(records):
    freq = summary.selection_freq(summary.coef_table(records)).where("model = 'm'")
    assert [r["feature"] for r in summary.selection_rank(freq).collect()] == [
        "a", "intercept", "b_kind_x"]
    assert [r["feature"] for r in summary.selection_rank(freq, 1, descending=True).collect()] == [
        "b_kind_x"]
    assert tuple(summary.selection_count(freq).first()) == ("m", 3, 1)       # strictly more
    assert tuple(summary.selection_count(freq, 0.3).first()) == ("m", 3, 3)


def test_features_by_name(records):
    freq = summary.selection_freq(summary.coef_table(records))
    assert {r["feature"] for r in summary.feature_subset(freq, ["a"]).collect()} == {"a"}
    assert {r["feature"] for r in summary.feature_match(freq, "kind").collect()} == {"b_kind_x"}
    with pytest.raises(Exception, match="unknown features.*zz"):
        summary.feature_subset(freq, ["a", "zz"]).collect()


def test_distributions_equal_numpy(spark):
    rng = np.random.default_rng(0)
    v = {m: rng.normal(size=37) for m in "pq"}
    metrics = spark.createDataFrame(
        [(m, s, float(x), float(-x)) for m in v for s, x in enumerate(v[m])],
        "model string, seed long, rmse double, r2 double")
    got = {r["model"]: r for r in summary.ci_summary(metrics).collect()}
    bars = {r["model"]: r for r in summary.error_bars(summary.ci_summary(metrics)).collect()}
    for m, x in v.items():
        lo, hi = np.percentile(x, [2.5, 97.5])
        assert np.allclose([got[m][f"rmse_{c}"] for c in ("mean", "se", "lower", "upper")],
                           [x.mean(), x.std(), lo, hi])
        assert np.isclose(got[m]["r2_lower"], -hi)
        assert np.allclose([bars[m][f"rmse_{c}"] for c in ("se_from", "se_to", "ci_below", "ci_above")],
                           [x.mean() - x.std(), x.mean() + x.std(), x.mean() - lo, hi - x.mean()])
    pair = summary.compare_models(metrics, "p", "q", "rmse").first()
    d = v["p"] - v["q"]
    assert pair["n_pairs"] == 37 and np.isclose(pair["diff_mean"], d.mean())
    assert np.isclose(pair["diff_upper"], np.percentile(d, 97.5))
    assert np.isclose(pair["share_above_zero"], (d > 0).mean())


def test_comparison_uses_common_seeds_only(spark):
    metrics = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 1, 1.5)],
                                    "model string, seed long, r2 double")
    got = summary.compare_models(metrics, "a", "b").first()
    assert got["n_pairs"] == 1 and got["diff_mean"] == 0.5


def test_parameter_intervals(records):
    ci = {(r["model"], r["feature"], r["is_intercept"]): r for r in
          summary.coef_ci(summary.coef_table(records)).collect()}
    r = ci["m", "b_kind_x", False]
    assert (r["mean"], r["lower"]) == (3.0, np.percentile([2, 3, 4], 2.5))
    assert np.isclose(r["se"], np.std([2, 3, 4]))


def test_level_is_checked(spark):
    with pytest.raises(ValueError, match="level"):
        summary.ci_summary(spark.range(1), level=0)
