import numpy as np
import pytest
from pyspark.sql import functions as F

from bootloom import Model, bagged_predict, fit_bootstrap, metric_dist, predict, split_rows
from bootloom.operators import score
from bootloom.sources.records import RECORD

FULL = ("qty", "lines", "disc")


def make_records(spark, rows):
    """(model, seed, intercept, {feature: coef}) -> records."""
    return spark.createDataFrame(
        [(m, s, None, None, None, None, None, None, None, None, list(map(float, c.values())),
          float(b0), list(c), None) for m, s, b0, c in rows], RECORD)


@pytest.fixture(scope="module")
def records(orders):
    return fit_bootstrap(orders, "y", {
        "full": Model("lasso", FULL, (5.0, 5000.0)), "reduced": Model("linear", ("qty",)),
        "turned": Model("linear", ("disc", "qty"))}, n_boot=3).cache()


def expected(records, test):
    local, out = test.orderBy("row_id").toPandas(), {}
    for r in records.collect():
        out[r["model"], r["seed"]] = local[r["column_names"]].to_numpy() @ r["coef"] + r["intercept"]
    return local, out


def test_predictions_match_by_name(orders, records):
    test = split_rows(orders, "test")
    local, want = expected(records, test)
    predictions = predict(records, test, target="y")
    assert predictions._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = predictions.toPandas()
    assert len(got) == 9 * len(local)
    for (m, s), p in want.items():
        part = got[(got["model"] == m) & (got["seed"] == s)].sort_values("row_id")
        assert np.allclose(part["prediction"], p, rtol=1e-12)
        assert part["y"].tolist() == local["y"].tolist()


def test_all_ways_to_the_metrics_agree(orders, records):
    test = split_rows(orders, "test")
    local, want = expected(records, test)
    y = local["y"].to_numpy()
    ways = [metric_dist(records, test, "y"), metric_dist(records, test, "y", via="rows"),
            score.prediction_metrics(predict(records, test, target="y"), "y")]
    for way in ways:
        got = {(r["model"], r["seed"]): r for r in way.collect()}
        assert got.keys() == want.keys()
        for at, p in want.items():
            sse = ((y - p) ** 2).sum()
            assert np.isclose(got[at]["rmse"] ** 2 * len(y), sse, rtol=1e-9)
            assert np.isclose(got[at]["r2"], 1 - sse / ((y - y.mean()) ** 2).sum(), rtol=1e-9)


def test_bagging_reduces_the_predictions_of_a_row(orders, records):
    test = split_rows(orders, "test")
    p = predict(records, test).groupBy("model", "row_id").agg(
        F.avg("prediction").alias("m"), F.stddev_pop("prediction").alias("s"),
        F.percentile("prediction", 0.05).alias("l"), F.percentile("prediction", 0.95).alias("u"))
    both = bagged_predict(records, test, level=90).join(p, ["model", "row_id"]).toPandas()
    assert len(both) == 900
    for a, b in (("prediction", "m"), ("se", "s"), ("lower", "l"), ("upper", "u")):
        assert np.allclose(both[a], both[b], rtol=1e-9, atol=1e-6)


def test_small_pieces_change_nothing(spark, orders, records, monkeypatch):
    test = split_rows(orders, "test")
    want = sorted(map(tuple, predict(records, test).collect()))
    bagged = sorted(map(tuple, bagged_predict(records, test).collect()))
    monkeypatch.setattr(score, "SHIPPED_BYTES", 40)
    monkeypatch.setattr(score, "VALUES_AT_ONCE", 7)
    assert np.allclose([w[3] for w in sorted(map(tuple, predict(records, test).collect()))],
                       [w[3] for w in want], rtol=1e-12)
    again = sorted(map(tuple, bagged_predict(records, test).collect()))
    assert np.allclose([a[2:] for a in again], [a[2:] for a in bagged], rtol=1e-9)
    metrics = {(r["model"], r["seed"]): r["rmse"] for r in
               metric_dist(records, test, "y", via="rows").collect()}
    for r in metric_dist(records, test, "y").collect():
        assert np.isclose(metrics[r["model"], r["seed"]], r["rmse"], rtol=1e-9)


def test_other_features_than_the_fit_are_an_error(orders, records):
    test = split_rows(orders, "test")
    with pytest.raises(ValueError, match="other features"):
        predict(records.where("model = 'full'"), test, features=["qty", "lines"])
    with pytest.raises(ValueError, match="lacks the features"):
        predict(records, test.drop("disc"))
    with pytest.raises(Exception, match="lacks the features"):
        metric_dist(records, test.drop("disc"), "y").collect()
    assert predict(records.where("model = 'full'"), test, features=list(FULL)).count() == 900


def test_replicate_without_any_feature_predicts_its_intercept(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 7.0)], "row_id long, a double")
    records = make_records(spark, [("m", 0, 2.5, {"a": 0.0}), ("m", 1, 1.0, {"a": 2.0})])
    got = {(r["row_id"], r["seed"]): r["prediction"] for r in predict(records, df).collect()}
    assert got == {(0, 0): 2.5, (1, 0): 2.5, (0, 1): 11.0, (1, 1): 15.0}


def test_records_without_model_name(spark):
    df = spark.createDataFrame([(0, 5.0, 10.0), (1, 7.0, 14.5)], "row_id long, a double, y double")
    records = make_records(spark, [(None, 0, 0.0, {"a": 2.0})])
    assert sorted(r["prediction"] for r in predict(records, df).collect()) == [10.0, 14.0]
    assert np.isclose(metric_dist(records, df, "y").first()["rmse"], np.sqrt(0.125))


def test_constant_target(spark):
    df = spark.createDataFrame([(i, float(i), 4.0) for i in range(5)],
                               "row_id long, a double, y double")
    records = make_records(spark, [("m", 0, 4.0, {"a": 0.0}), ("m", 1, 5.0, {"a": 0.0})])
    for way in (metric_dist(records, df, "y"), metric_dist(records, df, "y", via="rows"),
                score.prediction_metrics(predict(records, df, target="y"), "y")):
        got = {r["seed"]: r["r2"] for r in way.collect()}
        assert np.isnan(got[0]) and got[1] == float("-inf")


def test_missing_feature_value_gives_missing_prediction(spark):
    df = spark.createDataFrame([(0, None), (1, 1.0)], "row_id long, a double")
    got = {r["row_id"]: r["prediction"] for r in
           predict(make_records(spark, [("m", 0, 1.0, {"a": 2.0})]), df).collect()}
    assert np.isnan(got[0]) and got[1] == 3.0


def test_odd_names(spark):
    df = spark.createDataFrame([(0, 5.0, 10.0), (1, 7.0, 14.5)], "id long, `a.b` double, `my x` double")
    records = make_records(spark, [("m", 0, 0.0, {"a.b": 2.0})])
    got = predict(records, df, row_id="id", target="my x")
    assert got.columns == ["model", "id", "seed", "prediction", "my x"]
    for m in (score.prediction_metrics(got, "my x"), metric_dist(records, df, "my x", row_id="id"),
              metric_dist(records, df, "my x", row_id="id", via="rows")):
        assert np.isclose(m.first()["rmse"], np.sqrt(0.125))


def test_no_records(spark, orders):
    with pytest.raises(ValueError, match="no records"):
        predict(make_records(spark, []), orders)


def test_via_is_checked(orders, records):
    with pytest.raises(ValueError, match="via"):
        metric_dist(records, orders, "y", via="magic")


@pytest.mark.parametrize("level", [95.0, 50.0, 100.0])
def test_bagging_in_blocks(spark, orders, monkeypatch, level):
    rng = np.random.default_rng(3)
    rows = [("m" if s % 3 else "few", s, rng.normal(), {"qty": rng.normal(), "disc": rng.normal() * 9}) for s in range(60)]
    records, test = make_records(spark, rows), split_rows(orders, "test")
    want = bagged_predict(records, test, level=level).orderBy("model", "row_id").toPandas()
    blocks, staged = [], score.staged
    monkeypatch.setattr(score, "SHIPPED_BYTES", 16 * 7)
    monkeypatch.setattr(score, "staged", lambda df, name: blocks.append(name) or staged(df, name))
    got = bagged_predict(records, test, level=level).orderBy("model", "row_id").toPandas()
    assert blocks.count("bag") > 8
    assert list(got[["model", "row_id"]].itertuples(index=False)) == list(want[["model", "row_id"]].itertuples(index=False))
    for c in ("prediction", "se", "lower", "upper"):
        assert np.allclose(got[c], want[c], rtol=1e-9, atol=1e-9)
