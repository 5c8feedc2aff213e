"""Tiles, sparse rows and the wide solver against the dense, narrow path."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from bootloom import Model, metric_dist, one_hot, predict, predict_sparse, prepare, split_rows
from bootloom.functions import scratch
from bootloom.functions.memory import read_ahead
from bootloom.operators import moments as mom, score, sparse_score, tiles, wide
from bootloom.operators.score import prediction_metrics
from bootloom.plans import fit, tables
from bootloom.sources import frames

FIVE = ("qty", "lines", "disc", "orderstatus_F", "orderstatus_O")
MODELS = {"linear": Model("linear", FIVE), "lasso": Model("lasso", FIVE, (5.0, 500.0, 5000.0)),
          "ridge": Model("ridge", FIVE, (10.0, 1000.0)), "none": Model("lasso", ("disc", "qty"), (1e9,))}


@pytest.fixture(scope="module")
def dense(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dense") / "t")
    tables.orders_wide(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "t")
    tables.orders_levels(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def grams(table, q):
    return {(s, f): mom.unpack(part, q) for (s, f), part in table.toPandas().groupby(["seed", "fold"])}


def same(a, b, tolerance=1e-9):
    assert a.keys() == b.keys() and a
    for key in a:
        size = np.sqrt(np.outer(np.diag(b[key]), np.diag(b[key]))) + 1e-300
        assert np.abs((a[key] - b[key]) / size).max() < tolerance


def solved(df):
    return {(r["model"], r["seed"]): r.asDict(recursive=True) for r in df.collect()}


def equal_fits(got, expected, tolerance=1e-6):
    assert got.keys() == expected.keys() and got
    for key, e in expected.items():
        g = got[key]
        assert g["alpha"] == e["alpha"] and g["column_names"] == e["column_names"] and g["n"] == e["n"]
        assert np.allclose(g["coef"], e["coef"], rtol=tolerance, atol=tolerance * np.abs(e["coef"]).max(initial=0))
        for c in ("intercept", "r2", "mse_min"):
            assert g[c] == e[c] or abs(g[c] - e[c]) <= tolerance * max(1, abs(e[c]))
        assert [(p["alpha"], p["fold"]) for p in g["path"]] == [(p["alpha"], p["fold"]) for p in e["path"]]
        assert np.allclose([p["mse"] for p in g["path"]], [p["mse"] for p in e["path"]], rtol=1e-6)


# ------------------------------------------------------------------ dense tiles

@pytest.mark.parametrize("sampling, tile", [("exact", 4), ("poisson", 16), ("numpy", 16)])
def test_tiles_hold_the_same_moments(dense, sampling, tile):
    run = prepare(dense, "y", {"m": Model("linear")}, n_boot=3, sampling=sampling)
    got = tiles.as_moments(tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, sampling, tile=tile), 3, tile)
    same(grams(got, len(run.columns) + 1), grams(run.moments(), len(run.columns) + 1))


def test_tiles_take_seeds_in_batches(dense, monkeypatch):
    run = prepare(dense, "y", {"m": Model("linear")}, n_boot=3)
    monkeypatch.setattr(tiles, "PARTIAL_BYTES", 1)
    monkeypatch.setattr(tiles, "ROWS_BYTES", 1)
    got = tiles.as_moments(tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, "exact", tile=8), 3, 8)
    same(grams(got, len(run.columns) + 1), grams(run.moments(), len(run.columns) + 1))


def test_repeated_ids_are_refused(dense):
    twice = dense.unionByName(dense.where("row_id % 50 = 1"))
    run = prepare(twice, "y", {"m": Model("linear")}, n_boot=2)
    with pytest.raises(Exception, match="not unique"):
        tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, "exact", tile=8).collect()


def test_what_a_task_holds_does_not_grow_with_the_columns(spark, monkeypatch):
    """Largest value that a task of the products reads, and largest tile, for 40 and 400 columns."""
    seen = []
    keep = tiles.staged

    def spy(df, name):
        out = keep(df, name)
        if name == "blocks":
            seen.append(out.agg(F.max(F.length("x") + F.length("ids"))).first()[0])
        return out

    monkeypatch.setattr(tiles, "staged", spy)
    for m in (40, 400):
        df = spark.range(3000).select(F.col("id").alias("row_id"), *[
            F.cos(F.col("id") * (i + 1)).alias(f"x{i}") for i in range(m)], F.sin("id").alias("y"))
        run = prepare(df, "y", {"m": Model("linear")}, n_boot=2)
        packed = tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, "exact", tile=32).cache()
        assert packed.agg(F.max(F.length("g"))).first()[0] == 3 * 32 * 32 * 8
        assert packed.count() == 2 * (-(-(m + 2) // 32)) * (-(-(m + 2) // 32) + 1) // 2
    assert seen[0] == seen[1]


# ------------------------------------------------------------------ sparse rows

TERMS = [("orderstatus",), ("priority",)]


def made(raw, split="train", **options):
    return one_hot(raw, "y", ["qty", "lines", "disc"], TERMS, split=split, **options)


@pytest.mark.parametrize("sampling, tile", [("exact", 4), ("poisson", 512)])
def test_sparse_moments_are_the_dense_ones(raw, dense, sampling, tile):
    sparse = prepare(made(raw), "y", {"m": Model("linear")}, n_boot=3, sampling=sampling)
    names = sparse.columns
    assert names[:3] == ["qty", "lines", "disc"] and names[3:6] == ["orderstatus_F", "orderstatus_O", "orderstatus_P"]
    plain = dense.select("row_id", "test_set", "y", *names[:6], *[
        F.col(f"priority_{i}").alias(f"priority_P{i}") for i in range(1, 6)])
    run = prepare(plain, "y", {"m": Model("linear")}, n_boot=3, sampling=sampling)
    assert run.columns == names
    assert all(abs(sparse.stats.means[c] - run.stats.means[c]) < 1e-9 * max(1, abs(run.stats.means[c])) for c in names)
    same(grams(dataclasses.replace(sparse, tile=tile).moments(), len(names) + 1),
         grams(run.moments(), len(names) + 1), 1e-8)


def test_sparse_moments_in_batches_of_seeds_and_tiles(raw, monkeypatch):
    run = dataclasses.replace(prepare(made(raw), "y", {"m": Model("linear")}, n_boot=3), tile=4)
    expected = grams(run.moments(), len(run.columns) + 1)
    monkeypatch.setattr(tiles, "PARTIAL_BYTES", 3 * 4 * 4 * 8 * 2)   # two tiles of one seed
    monkeypatch.setattr(tiles, "PAIRS_AT_ONCE", 100)
    same(grams(run.moments(), len(run.columns) + 1), expected)


def test_products_missing_values_and_unknown_levels(spark):
    rows = [(i, [None, "a", "b", "a"][i % 4], ["x", "y", None][i % 3], float(i % 7), float(i), int(i % 5 == 0))
            for i in range(300)]
    rows += [(300, "new", "x", 2.0, 5.0, 1)]
    df = spark.createDataFrame(rows, "row_id long, s string, t string, v double, y double, test_set int")
    train = one_hot(df, "y", ["v"], [("s",), ("s", "t"), ("v", "s")])
    assert train.names == ["1", "v", "s_a", "s_b", "s_a:t_x", "s_a:t_y", "s_b:t_x", "s_b:t_y", "v:s_a", "v:s_b", "y"]
    test = one_hot(df, "y", ["v"], [("s",), ("s", "t"), ("v", "s")], split="test", levels=train)
    assert test.names == train.names
    for sparse, flag in ((train, 0), (test, 1)):
        for r in sparse.rows.collect():
            _, s, t, v, y, test_set = rows[r["row_id"]]
            full = {"1": 1.0, "v": v - train.stats.means["v"], "y": y - train.stats.means["y"]}
            if s in ("a", "b"):
                full[f"s_{s}"] = 1.0
                full |= {f"s_{s}:t_{t}": 1.0} if t else {}
                full |= {f"v:s_{s}": v} if v else {}
            got = dict(zip([sparse.names[i] for i in r["_i"]], r["_v"]))
            assert test_set == flag and got == pytest.approx(full) and list(r["_i"]) == sorted(r["_i"])
    with pytest.raises(ValueError, match="no categorical"):
        one_hot(df, "y", ["v"], [("v",)])


def test_sparse_fits_are_the_dense_ones(raw, dense):
    names = ["qty", "lines", "disc", "orderstatus_F", "orderstatus_O"]
    models = {"linear": Model("linear", tuple(names)), "lasso": Model("lasso", tuple(names), (5.0, 500.0, 5000.0))}
    got = solved(prepare(made(raw), "y", models, n_boot=3).solved())
    equal_fits(got, solved(prepare(dense, "y", models, n_boot=3).solved()))


# ------------------------------------------------------------------ predictions for sparse rows

def test_sparse_predictions_are_the_dense_ones(spark, raw, dense, monkeypatch):
    names = ("qty", "disc", "orderstatus_F", "orderstatus_O")
    train = made(raw)
    models = {"lasso": Model("lasso", names, (50.0, 500.0)), "ridge": Model("ridge", names), "none": MODELS["none"]}
    records = fit.fit_bootstrap(train, "y", models, n_boot=4).cache()
    assert not any(any(r["coef"]) for r in records.where("model = 'none'").collect())
    test = made(raw, "test", levels=train)
    expected = {(r["model"], r["row_id"], r["seed"]): (r["prediction"], r["y"]) for r in predict(
        records, split_rows(dense, "test"), target="y").collect()}

    def check():
        rows = predict_sparse(records, test, target=True).collect()
        assert len(rows) == len(expected)
        for r in rows:
            assert (r["prediction"], r["y"]) == pytest.approx(expected[r["model"], r["row_id"], r["seed"]], rel=1e-9, abs=1e-6)

    check()
    for limit in ("PART_REPLICATES", "CHUNK_ENTRIES", "PRODUCTS"):
        monkeypatch.setattr(sparse_score, limit, 3 if limit == "PART_REPLICATES" else 500)
    monkeypatch.setattr(score, "SHIPPED_BYTES", 16)
    check()
    metrics = {(r["model"], r["seed"]): r["rmse"] for r in prediction_metrics(predict_sparse(records, test, True), "y").collect()}
    plain = {(r["model"], r["seed"]): r["rmse"] for r in metric_dist(records, split_rows(dense, "test"), "y").collect()}
    assert metrics == pytest.approx(plain, rel=1e-9)


def test_no_coefficient_comes_to_the_driver(spark, raw, monkeypatch):
    train = made(raw)
    records = fit.fit_bootstrap(train, "y", {"m": Model("lasso", None, (50.0,))}, n_boot=3).cache()
    fetched = []
    for name in ("collect", "toPandas", "toArrow"):
        def spy(df, *a, keep=getattr(type(records), name), **b):
            fetched.append(df.columns)
            return keep(df, *a, **b)
        monkeypatch.setattr(type(records), name, spy)
    out = predict_sparse(records, made(raw, "test", levels=train))
    assert not any("coef" in c or "e" in c for c in fetched)
    assert out.count() == 3 * split_rows(raw, "test").count()


def test_records_with_other_features_are_refused(spark, raw, dense):
    records = fit.fit_bootstrap(dense, "y", {"m": Model("ridge", ("qty", "qty_disc"))}, n_boot=2)
    with pytest.raises(ValueError, match="qty_disc"):
        predict_sparse(records, made(raw))
    with pytest.raises(ValueError, match="no records"):
        predict_sparse(records.where("false"), made(raw))


# ------------------------------------------------------------------ the wide solver

def test_wide_solver_gives_the_narrow_fits(dense, monkeypatch, tile=4):
    narrow = prepare(dense, "y", MODELS, n_boot=2)
    expected = solved(narrow.solved())
    monkeypatch.setattr(fit, "WIDE", 1)
    monkeypatch.setattr(wide, "JOIN", 2)
    run = dataclasses.replace(narrow, tile=tile)
    assert run.is_wide()
    equal_fits(solved(run.solved()), expected)


def test_wide_sparse_fits(raw, dense, monkeypatch):
    models = {"lasso": Model("lasso", None, (50.0, 500.0))}
    expected = solved(prepare(made(raw), "y", models, n_boot=2).solved())
    monkeypatch.setattr(fit, "WIDE", 1)
    equal_fits(solved(dataclasses.replace(prepare(made(raw), "y", models, n_boot=2), tile=4).solved()), expected)


def test_collinear_columns_have_the_same_scores(dense, monkeypatch):
    models = {"linear": Model("linear", (*FIVE, "orderstatus_P"))}
    narrow = prepare(dense, "y", models, n_boot=2)
    expected = {k: v["r2"] for k, v in solved(narrow.solved()).items()}
    monkeypatch.setattr(fit, "WIDE", 1)
    got = {k: v["r2"] for k, v in solved(dataclasses.replace(narrow, tile=5).solved()).items()}
    assert got == pytest.approx(expected, abs=1e-9)


def test_too_many_features_in_play_are_an_error(dense, monkeypatch):
    monkeypatch.setattr(fit, "WIDE", 1)
    monkeypatch.setattr(wide, "IN_PLAY", 2)
    monkeypatch.setattr(wide, "JOIN", 1)
    run = dataclasses.replace(prepare(dense, "y", {"m": Model("lasso", None, (5.0,))}, n_boot=2), tile=4)
    with pytest.raises(Exception, match="in play"):
        run.solved().collect()


# ------------------------------------------------------------------ what many columns take

def test_many_columns_are_packed_without_code_for_each(spark):
    """Compiling a row of 4,000 columns took the driver over 750 MB of heap."""
    names = [f"x{i}" for i in range(frames.COMPILED_COLUMNS + 1)]
    df = spark.range(3).select(*[(F.col("id") * i).alias(n) for i, n in enumerate(names)])
    packed = df.select(*frames.packed(names))
    assert [r["_x"] for r in packed.collect()] == [[float(j * i) for i in range(len(names))] for j in range(3)]
    assert len(code_of(packed)) < 2 * len(code_of(df.select(*frames.packed(names[:20]))))


def code_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")


def test_rows_of_some_stripes_are_sent_as_few_times_as_fits(monkeypatch):
    assert tiles.striped(8, 2, 1, 512) == (8, 2)
    assert tiles.striped(1, 5, 3, 512) == (1, 5)
    monkeypatch.setattr(tiles, "PARTIAL_BYTES", 1)
    assert tiles.striped(8, 2, 1, 512) == (1, 1)


@pytest.mark.parametrize("sampling", ["exact", "poisson"])
def test_tiles_of_several_stripes_and_chunks(dense, monkeypatch, sampling):
    run = prepare(dense, "y", {"m": Model("linear")}, n_boot=3, sampling=sampling)
    expected = grams(run.moments(), len(run.columns) + 1)
    monkeypatch.setattr(tiles, "PARTIAL_BYTES", 3 * 2 * 2 * 8 * 8)   # eight tiles
    got = tiles.as_moments(tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, sampling, tile=2), 3, 2)
    same(grams(got, len(run.columns) + 1), expected)


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_tiles_are_asked_where_they_are_or_shuffled(dense, monkeypatch, most):
    monkeypatch.setattr(wide, "SENT_BYTES", most)
    run = dataclasses.replace(prepare(dense, "y", {"linear": Model("linear", FIVE)}, n_boot=2), tile=4)
    got = solved(wide.solve_wide(run.tiles(), run.columns, run.stats.centres(run.columns), run.models, run.seeds, 3, 4))
    equal_fits(got, solved(run.solved()))


@pytest.mark.parametrize("sampling", ["exact", "poisson", "numpy"])
@pytest.mark.parametrize("by_id", [False, True])
def test_rows_are_multiplied_in_place(dense, monkeypatch, sampling, by_id):
    """Rows of many bytes are not written in blocks, whether their partitions are by id or not."""
    monkeypatch.setattr(tiles, "BLOCKED_BYTES", 0)
    monkeypatch.setattr(tiles, "ROWS_AT_ONCE", 100)
    monkeypatch.setattr(tiles, "staged", lambda df, name: pytest.fail("rows were written"))
    run = prepare(scratch.dealt(dense, "row_id") if by_id else dense, "y", {"m": Model("linear")}, n_boot=3, sampling=sampling)
    got = tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, sampling, tile=4)
    same(grams(tiles.as_moments(got, 3, 4), len(run.columns) + 1), grams(run.moments(), len(run.columns) + 1))


def test_repeated_ids_are_refused_in_place(dense, monkeypatch):
    monkeypatch.setattr(tiles, "BLOCKED_BYTES", 0)
    run = prepare(dense.unionByName(dense.where("row_id % 50 = 1")), "y", {"m": Model("linear")}, n_boot=2)
    with pytest.raises(Exception, match="not unique"):
        tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 3, "exact", tile=8).collect()


def test_wide_rows_that_are_dealt_by_id_are_not_shuffled(spark, sf_dir, monkeypatch):
    """Neither written before the fit nor sent to where their weights are."""
    monkeypatch.setattr(scratch, "DEALT_ROWS", (50, 1 << 18))
    wide_rows = tables.part_wide(spark, sf_dir, 40)
    assert scratch.is_dealt(wide_rows, "row_id") and not scratch.is_dealt(tables.part_line(spark, sf_dir), "row_id")
    monkeypatch.setattr(scratch, "staged", lambda df, name: pytest.fail("rows were written"))
    assert "RepartitionByExpression" in scratch.computed_once(wide_rows)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.undo()
    monkeypatch.setattr(tiles, "BLOCKED_BYTES", 0)
    run = prepare(wide_rows, "y", {"m": Model("linear")}, n_boot=2)
    plan = tiles.dense_tiles(run.rows, run.stats, run.columns, run.seeds, 1, "exact", tile=16)._jdf.queryExecution().sparkPlan()
    text = plan.toString()
    made = text[:text.index("FlatMapCoGroupsInArrow")]   # the side of the rows, above that of the weights
    assert "ShuffledHashJoin" in made and made.index("array(") < made.index("Exchange hashpartitioning(row_id")


def test_narrow_rows_in_one_file_keep_all_cores_busy(spark, tmp_path):
    spark.range(40_000).select(F.col("id").alias("row_id")).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows.rdd.getNumPartitions() == 1 and scratch.dealt(rows, "row_id").rdd.getNumPartitions() == 9
    assert scratch.dealt(rows.limit(10), "row_id").rdd.getNumPartitions() == 1


def test_many_columns_are_compiled_by_the_executors(spark):
    """All but the first are no argument of a higher-order function, which Spark evaluates value by value."""
    names = [f"x{i}" for i in range(frames.COMPILED_COLUMNS + 1)]
    df = spark.range(3).select(*[(F.col("id") * i).cast("double").alias(n) for i, n in enumerate(names)])
    plan = df.select(*frames.packed(names))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lambdafunction") == 1 and "transform(array(x0" not in plan.replace("transform(array(x0)", "")


def test_batches_are_read_ahead_in_order():
    assert list(read_ahead(iter(range(50)), 3)) == list(range(50))

    def broken():
        yield 1
        raise ValueError("no more")

    with pytest.raises(ValueError, match="no more"):
        list(read_ahead(broken(), 3))
