"""Whole runs on Spark against the plain way on gathered resamples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from bootloom import (Model, ci_summary, coef_table, fit_bootstrap, metric_dist, prepare,
                      selection_freq, split_rows)
from bootloom.operators import resample as rs
from bootloom.operators.solve import DEFAULT_ALPHAS
from bootloom.plans import fit as plan, tables

FULL = ("qty", "lines", "disc")
GRID = (5.0, 500.0, 5000.0)


def gathered(spark, df, features, target, seeds, n, k=3):
    """Every resample row by row, from the listed draws."""
    local = df.orderBy("row_id").toPandas()
    x, y = local[list(features)].to_numpy(float), local[target].to_numpy(float)
    draws = rs.resample(spark, seeds, n, k).toPandas()
    for seed in seeds:
        d = draws[draws["seed"] == seed]
        at = d["position"].to_numpy()
        yield seed, x[at], y[at], d["fold"].to_numpy()


def agree(record, want, rtol=1e-7):
    alpha, b, b0, r2, path = want
    assert record["alpha"] == alpha
    scale = max(np.abs(b).max(), 1.0)
    assert np.allclose(record["coef"], b, rtol=rtol, atol=rtol * scale)
    assert np.isclose(record["intercept"], b0, rtol=1e-5, atol=1e-6 * scale)
    assert np.isclose(record["r2"], r2, rtol=1e-7, atol=1e-9)
    if record["mse_min"] is not None:
        assert np.isclose(record["mse_min"], min(v[0] for v in path.values()), rtol=1e-7)


@pytest.mark.parametrize("method,alphas", [("linear", ()), ("lasso", GRID),
                                           ("ridge", DEFAULT_ALPHAS["ridge"])])
def test_records_equal_fits_on_gathered_rows(spark, orders, method, alphas):
    seeds = [10, 11]
    records = {r["seed"]: r for r in fit_bootstrap(
        orders, "y", {"m": Model(method, FULL, alphas)}, seeds=seeds).collect()}
    train = orders.where("test_set = 0")
    for seed, x, y, fold in gathered(spark, train, FULL, "y", seeds, train.count()):
        agree(records[seed], brute.cross_validated(method, x, y, fold, alphas))


def test_collinear_wide_table(spark, sf_dir):
    """One-hot sets that sum to one, and products: the shortest least-squares solution."""
    df = tables.orders_wide(spark, sf_dir)
    features = [c for c in df.columns if c not in ("row_id", "y", "test_set")]
    assert len(features) == 13
    got = {r["seed"]: r for r in fit_bootstrap(
        df, "y", {"linear": Model("linear"), "lasso": Model("lasso", None, (500.0, 5000.0))},
        n_boot=1).where("model = 'linear'").collect()}
    train = df.where("test_set = 0")
    for seed, x, y, fold in gathered(spark, train, got[0]["column_names"], "y", [0], train.count()):
        agree(got[seed], brute.cross_validated("linear", x, y, fold, ()), rtol=1e-5)


def test_more_features_than_one_block(spark):
    """70 features: rows of the Gram matrix span two blocks."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 70))
    y = x[:, :3] @ [3.0, -2.0, 1.0] + rng.normal(size=400)
    names = [f"f{i}" for i in range(70)]
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "row_id long, " + ", ".join(f"{c} double" for c in names) + ", y double")
    for sampling in ("exact", "poisson"):
        records = {r["seed"]: r for r in fit_bootstrap(
            df, "y", {"m": Model("lasso", None, (0.05, 0.1))}, n_boot=2, sampling=sampling).collect()}
        if sampling == "exact":
            for seed, xs, ys, fold in gathered(spark, df, names, "y", [0, 1], 400):
                agree(records[seed], brute.cross_validated("lasso", xs, ys, fold, (0.05, 0.1)))
        assert all(abs(r["coef"][0] - 3) < 0.5 for r in records.values())


def test_seed_batches_change_nothing(spark, orders, monkeypatch):
    from bootloom.operators import moments
    for sampling in ("exact", "poisson"):
        models = {"m": Model("linear", FULL)}
        want = {r["seed"]: r["coef"] for r in fit_bootstrap(
            orders, "y", models, n_boot=3, sampling=sampling).collect()}
        with monkeypatch.context() as mp:
            mp.setattr(moments, "PARTIAL_BYTES", 1)
            got = {r["seed"]: r["coef"] for r in fit_bootstrap(
                orders, "y", models, n_boot=3, sampling=sampling).collect()}
        assert got.keys() == want.keys()
        assert all(np.allclose(got[s], want[s], rtol=1e-8) for s in want)


def test_poisson_fit_equals_fit_on_its_weights(spark, orders):
    run = prepare(orders, "y", {"m": Model("linear", FULL)}, n_boot=2, sampling="poisson")
    records = {r["seed"]: r for r in plan.to_records(run).collect()}
    w = rs.poisson_weights(run.rows, run.seeds).join(run.rows, "row_id").toPandas()
    for seed, part in w.groupby("seed"):
        rows = part.loc[part.index.repeat(part["w"])]
        b, b0 = brute.least_squares(rows[list(FULL)].to_numpy(), rows["y"].to_numpy())
        assert np.allclose(records[seed]["coef"], b, rtol=1e-7)
        assert np.isclose(records[seed]["intercept"], b0, rtol=1e-5)


def test_numpy_sampling_replays_the_stream(spark, orders):
    records = fit_bootstrap(orders, "y", {"m": Model("linear", FULL)}, seeds=[3], sampling="numpy")
    local = orders.where("test_set = 0").orderBy("row_id").toPandas()
    at = np.random.RandomState(3).randint(0, high=len(local), size=len(local))
    b, _ = brute.least_squares(local[list(FULL)].to_numpy()[at], local["y"].to_numpy()[at])
    assert np.allclose(records.first()["coef"], b, rtol=1e-7)


def test_partitioning_changes_nothing(spark, orders):
    models = {"m": Model("lasso", FULL, GRID)}
    a = fit_bootstrap(orders, "y", models, n_boot=2).orderBy("seed").collect()
    b = fit_bootstrap(orders.repartition(7, F.rand(1)), "y", models, n_boot=2).orderBy("seed").collect()
    for x, y in zip(a, b):
        assert x["alpha"] == y["alpha"] and np.allclose(x["coef"], y["coef"], rtol=1e-9)


def test_models_fitted_together_equal_models_fitted_alone(spark, orders):
    models = {"reduced": Model("lasso", ("qty",), GRID), "full": Model("ridge", FULL),
              "swapped": Model("linear", ("disc", "qty"))}
    together = {(r["model"], r["seed"]): r for r in
                fit_bootstrap(orders, "y", models, n_boot=2).collect()}
    for name, model in models.items():
        for r in fit_bootstrap(orders, "y", {name: model}, n_boot=2).collect():
            other = together[name, r["seed"]]
            assert r["column_names"] == other["column_names"] == list(model.features)
            assert np.allclose(r["coef"], other["coef"], rtol=1e-8)


def test_splits(spark, orders):
    sizes = {}
    for split in ("train", "test", "all"):
        run = prepare(orders, "y", {"m": Model("linear", ("qty",))}, n_boot=1, split=split)
        sizes[split] = run.solved().first()["n"]
    assert sizes == {"train": 1200, "test": 300, "all": 1500}
    whole = prepare(orders.drop("test_set"), "y", {"m": Model("linear", ("qty",))}, n_boot=1)
    assert whole.solved().first()["n"] == 1500


def test_defaults_and_fields_that_do_not_apply(spark, orders):
    records = {r["model"]: r for r in fit_bootstrap(
        orders, "y", {"linear": Model("linear"), "lasso": Model(), "ridge": Model("ridge")},
        n_boot=1, training_feats="feats.csv", training_targets="target.csv").collect()}
    assert records["linear"]["alpha"] is None and records["linear"]["mse_min"] is None
    assert records["lasso"]["alpha"] in (0.05, 0.1, 0.2) and records["lasso"]["cv"] is None
    assert records["ridge"]["cv"] == 3 and records["ridge"]["random_state"] is None
    assert records["ridge"]["alpha"] in DEFAULT_ALPHAS["ridge"]
    assert {r["training_feats"] for r in records.values()} == {"feats.csv"}


@pytest.mark.parametrize("call,message", [
    (dict(models={"m": Model("svr")}), "unknown model"),
    (dict(models={"m": Model("lasso", ("nope",))}), "unknown features"),
    (dict(sampling="half"), "unknown sampling"),
    (dict(n_boot=0), "n_boot"),
    (dict(seeds=[1, 1]), "once"),
    (dict(k=1), "folds"),
    (dict(models={"m": Model("ridge", None, (0.0,))}), "positive"),
])
def test_bad_arguments(spark, orders, call, message):
    with pytest.raises(ValueError, match=message):
        prepare(orders, "y", **call)


def test_missing_values_stop_the_run(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, None, 3.0)], "row_id long, a double, y double")
    with pytest.raises(ValueError, match="missing"):
        fit_bootstrap(df, "y", {"m": Model("linear")})


def test_tiny_table_with_uneven_folds_and_a_rare_level(spark):
    rows = [(i, float(i), 1.0 if i == 0 else 0.0, 2.0 * i + 1) for i in range(7)]
    df = spark.createDataFrame(rows, "row_id long, a double, rare double, y double")
    records = fit_bootstrap(df, "y", {"m": Model("lasso", None, (0.01, 0.1))}, n_boot=20).collect()
    assert len(records) == 20
    assert any(r["coef"][1] == 0.0 for r in records)


def test_feature_names_with_odd_characters(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(a), float(a) * 3) for i, a in enumerate(rng.normal(size=50))],
                               "row_id long, `a.b c` double, y double")
    record = fit_bootstrap(df, "y", {"m": Model("linear")}, n_boot=1).first()
    assert record["column_names"] == ["a.b c"] and np.isclose(record["coef"][0], 3)


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(i, float(i % 5), 4.0) for i in range(30)],
                               "row_id long, a double, y double")
    record = fit_bootstrap(df, "y", {"m": Model("linear")}, n_boot=1).first()
    assert record["coef"] == [0.0] and record["intercept"] == 4.0 and np.isnan(record["r2"])


def test_noise_is_rarely_selected(spark, sf_dir):
    """Event type and hour say next to nothing about the value of an event."""
    df = tables.events_null(spark, sf_dir, ["click", "error", "purchase", "signup", "view"])
    records = fit_bootstrap(df, "y", {"m": Model("lasso", None, (20.0, 40.0))}, n_boot=20).cache()
    freq = selection_freq(coef_table(records)).collect()
    assert len(freq) == 6
    # One-hot types have a small spread, so only the hour can reach such a penalty by chance.
    assert all(r["p_nonzero"] == 0 for r in freq if r["feature"] != "hour")
    assert all(abs(r["r2"]) < 0.05 for r in records.collect())


def test_model_list_from_small_to_wide(spark, sf_dir):
    df = tables.orders_wide(spark, sf_dir)
    records = fit_bootstrap(df, "y", {**tables.MODELS, "wide": Model("lasso", None, GRID)}, n_boot=3)
    summary = {r["model"]: r for r in
               ci_summary(metric_dist(records, split_rows(df, "test"), "y")).collect()}
    assert summary["reduced"]["r2_mean"] < summary["full"]["r2_mean"] <= summary["wide"]["r2_mean"] + 0.01
    assert summary["reduced"]["rmse_mean"] > summary["full"]["rmse_mean"]
