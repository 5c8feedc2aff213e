"""Entry points for checks: a flagship query, one query per operator, and their SQL twins."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles as o  # noqa: E402
from bootloom import split_rows  # noqa: E402
from bootloom.functions.hashing import POISSON_1_CDF  # noqa: E402
from bootloom.functions.scratch import scratch_path  # noqa: E402
from bootloom.functions.ship import ship_package  # noqa: E402
from bootloom.operators import moments as mom, resample as rs, score, sparse_score, summary  # noqa: E402
from bootloom.operators.index import dense_index as add_position  # noqa: E402
from bootloom.plans import fit, tables  # noqa: E402
from bootloom.plans.fit import Model  # noqa: E402
from bootloom.sources import frames, records as rec  # noqa: E402

try:  # the corpus operators can be left out of an installation
    import corpus_pipeline
    from bootloom.llm import queries as corpus
except ImportError:
    CORPUS_QUERIES, CORPUS_ORACLES = {}, {}
else:
    CORPUS_QUERIES = corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    CORPUS_ORACLES = corpus.ORACLES

SEEDS = 5
FULL = ("qty", "lines", "disc")
GRID = o.LASSO_GRID
PART_ALPHAS = (0.05, 10.0, 20.0)
PART_SEEDS = 20
UNITS = {"1": 1.0, "qty": 97.3, "lines": 1.07, "disc": 0.0137, "y": 1.13e5}

REDUCED = Model("lasso", ("qty",), GRID)
LASSO = Model("lasso", FULL, GRID)
RIDGE = Model("ridge", FULL)
LINEAR = Model("linear", FULL)
FAMILY = {"reduced": REDUCED, "pair": Model("lasso", ("qty", "lines"), GRID), "full": LASSO,
          "ridge": RIDGE, "linear": LINEAR}
ONE_HOT = ("qty", "orderstatus_F", "orderstatus_O")
ONE_HOT_ALPHAS = (5.0, 1e4, 1e5)
WIDE_COLUMNS, WIDE_SEEDS = 4000, 2
LEVEL_UNITS = {"1": 1.0, "qty": 97.3, **{f"orderstatus_{s}": 1.07 for s in "FOP"},
               **{f"priority_P{i}": 1.01 for i in range(1, 6)}, "y": 1.13e5}
COLLINEAR = Model("linear", (*ONE_HOT, "orderstatus_P"))
PART = {"part": Model("lasso", ("partkey", "size"), PART_ALPHAS)}


# ------------------------------------------------------------------ shared pieces

def _orders(spark, d):
    return tables.orders_reg(spark, d)


def _prepare(spark, d, models, **options):
    return fit.prepare(_orders(spark, d), "y", models, n_boot=SEEDS, **options)


def _records(spark, d, models, **options):
    return fit.fit_bootstrap(_orders(spark, d), "y", models, n_boot=SEEDS,
                             training_feats="orders_reg", training_targets="y", **options)


def _part_coefs(spark, d):
    records = fit.fit_bootstrap(tables.part_line(spark, d), "y", PART, n_boot=PART_SEEDS)
    return summary.coef_table(records)


def _metrics(spark, d, models, **options):
    return score.metric_dist(_records(spark, d, models),
                             split_rows(_orders(spark, d), "test"), "y", **options)


def _train(spark, d):
    df = split_rows(_orders(spark, d), "train").select("row_id", "y")
    return df, frames.frame_stats(df, ["y"])


def _rounded(df: DataFrame, /, **digits) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _money(df: DataFrame) -> DataFrame:
    return df.select("row_id", "qty", "lines", F.round("disc", 9).alias("disc"),
                     F.round("y", 6).alias("y"))


def _coefs(spark, d, models):
    return summary.coef_table(_records(spark, d, models)).select(
        "model", "seed", "feature", F.round("coef", 3).alias("coef"))


# ------------------------------------------------------------------ sources, splits

def load_align(spark, d):
    """Features and target through CSV files with a saved index column."""
    base = scratch_path(spark, "csv")
    table = _orders(spark, d).withColumnRenamed("row_id", " ")
    table.drop("y").withColumnRenamed(" ", "Unnamed: 0").write.option("header", True).csv(
        f"{base}/feats.csv")
    table.select(F.col(" ").alias("Unnamed: 0"), "y").write.option("header", True).csv(
        f"{base}/target.csv")
    df = frames.align(frames.read_table(spark, f"{base}/feats.csv"),
                      frames.read_table(spark, f"{base}/target.csv"))
    return df.select("row_id", "qty", "lines", F.round("disc", 9).alias("disc"),
                     F.round("y", 6).alias("y"), F.col("test_set").cast("int"))


def split_query(flag):
    return lambda spark, d: _money(split_rows(_orders(spark, d), flag))


def record_roundtrip(spark, d):
    path = scratch_path(spark, "roundtrip")
    rec.write_records(_records(spark, d, {"full": LASSO, "ridge": RIDGE, "linear": LINEAR}), path)
    back = rec.read_records(spark, path)
    return back.select(
        "model", "seed", "alpha", "random_state", "training_feats", "training_targets", "cv",
        F.round("mse_min", -2).alias("mse_min"), F.round("r2", 8).alias("r2"),
        F.concat_ws(",", "column_names").alias("names"),
        F.round(F.element_at("coef", 1), 3).alias("coef_first"),
        F.round("intercept", 3).alias("intercept"))


def record_append(spark, d):
    """A run of 2 seeds, continued to 5: each (model, seed) is there exactly once."""
    path = scratch_path(spark, "append")
    models = {"reduced": REDUCED, "linear": LINEAR}
    for n_boot in (2, SEEDS):
        fit.extend_run(_orders(spark, d), "y", models, path, n_boot=n_boot)
    return rec.read_records(spark, path).groupBy("model", "seed").agg(
        F.count("*").alias("copies"), F.round(F.max("intercept"), 3).alias("intercept"))


def load_no_index(spark, d):
    """Two CSV tables of several files without an index column: rows are numbered as they are in the files."""
    base = scratch_path(spark, "plain")
    table = _orders(spark, d)
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for name, rows in (("a", table.where("row_id % 2 = 0")), ("b", table.where("row_id % 2 = 1"))):
        rows.select("qty", "lines", F.col("row_id").alias("was")).repartitionByRange(parts, "was").sortWithinPartitions(
            "was").write.option("header", True).csv(f"{base}/{name}.csv")
        read = frames.read_table(spark, f"{base}/{name}.csv", schema="qty double, lines double, was long")
        both = read.withColumn("file", F.lit(name)) if name == "a" else both.unionByName(
            read.withColumn("file", F.lit(name)))
    return both.select("file", "row_id", "was", "qty", "lines")


def seedless_records(spark, d):
    """Records that were written without seed and model: each is a replicate of its own."""
    path = scratch_path(spark, "seedless")
    _records(spark, d, {"full": LASSO}).drop("model", "seed").write.json(path)
    metrics = score.metric_dist(rec.read_records(spark, path),
                                split_rows(_orders(spark, d), "test"), "y")
    return metrics.groupBy().agg(F.count_distinct("model", "seed").alias("n"), F.round(F.avg("rmse"), 4).alias(
        "rmse_mean"), F.round(F.avg("r2"), 8).alias("r2_mean"))


def coef_wide(spark, d):
    return summary.coef_wide(_records(spark, d, {"full": LASSO, "reduced": REDUCED})).select(
        "model", "seed", *[F.round(c, 3).alias(c) for c in (*FULL, "intercept")])


# ------------------------------------------------------------------ resampling

def dense_index_hashed(spark, d):
    """Positions of rows whose ids are hashes, over all 64 bits."""
    df = split_rows(_orders(spark, d), "train").select(F.conv(F.substring(F.md5(
        F.col("row_id").cast("string")), 1, 16), 16, -10).cast("long").alias("row_id"), "y")
    return add_position(df, frames.frame_stats(df, ["y"]), wanted=64).select("row_id", "position")


def dense_index(spark, d):
    df, stats = _train(spark, d)
    return add_position(df, stats, wanted=1024).select("row_id", "position")


def fold_assign(spark, d):
    df, stats = _train(spark, d)
    return rs.fold_assign(add_position(df, stats), stats.n).select("row_id", "position", "fold")


def resample(spark, d):
    _, stats = _train(spark, d)
    return rs.resample(spark, rs.seed_list(0, SEEDS), stats.n)


def resample_weights(spark, d):
    df, stats = _train(spark, d)
    return rs.resample_weights(df, stats, rs.seed_list(0, SEEDS))


def poisson_weights(spark, d):
    df, _ = _train(spark, d)
    return rs.poisson_weights(df, rs.seed_list(0, SEEDS))


def moments(spark, d, **options):
    """Gram entries in units of each column, so that all have a similar size. (The units are
    odd because exact decimal ties would be rounded up or down by the last bit of a sum.)"""
    run = _prepare(spark, d, {"full": LASSO}, **options)
    units = F.array(*map(F.lit, UNITS.values()))
    entries = run.moments().select(
        "seed", "fold", "i", F.posexplode(F.array(*[f"g{b}" for b in range(5)])).alias("j", "g"))
    return entries.select("seed", "fold", "i", "j", F.round(
        F.col("g") / (units[F.col("i")] * units[F.col("j")]), 5).alias("g"))


# ------------------------------------------------------------------ fits

def fit_1d(model):
    def query(spark, d):
        return _records(spark, d, {"one": model}).select(
            "seed", "alpha", F.round(F.col("coef")[0], 6).alias("slope"),
            F.round("intercept", 3).alias("intercept"), F.round("r2", 8).alias("r2"))
    return query


def fit_linear(spark, d):
    return _coefs(spark, d, {"linear": LINEAR})


def fit_lasso(spark, d):
    return _coefs(spark, d, {"lasso": LASSO})


def fit_ridge(spark, d):
    return _coefs(spark, d, {"ridge": RIDGE})


def cv_path(spark, d):
    return _rounded(fit.cv_path(_prepare(spark, d, {"full": LASSO, "ridge": RIDGE})), mse=-2, r2=8)


def cv_path_1d(spark, d):
    return _rounded(fit.cv_path(_prepare(spark, d, {"reduced": REDUCED})), mse=-2, r2=8)


def best_alpha(spark, d):
    return _records(spark, d, {"reduced": REDUCED, "full": LASSO, "ridge": RIDGE}).select(
        "model", "seed", "alpha")


def mse_min(spark, d):
    return _records(spark, d, {"full": LASSO, "ridge": RIDGE}).select(
        "model", "seed", F.round("mse_min", -2).alias("mse_min"))


def fit_r2(spark, d):
    return _records(spark, d, FAMILY).select("model", "seed", F.round("r2", 8).alias("r2"))


PAIR = ("qty", "disc")


def ridge_df(spark, d):
    """Effective degrees of freedom of a ridge of two features at every default penalty."""
    out = fit.ridge_degrees(_prepare(spark, d, {"pair": Model("ridge", PAIR)}))
    return _rounded(out, df=8)


def lasso_knots(spark, d):
    """Penalties at which the lasso takes up its first and its second feature."""
    out = fit.lasso_knots(_prepare(spark, d, {"pair": Model("lasso", PAIR, (0.05,))}))
    return _rounded(out, alpha=3)


def fit_lasso_default(spark, d):
    """The default penalties."""
    return _coefs(spark, d, {"lasso": Model("lasso", FULL)})


# ------------------------------------------------------------------ one-hot features

def _wide_records(spark, d, model):
    return fit.fit_bootstrap(tables.orders_wide(spark, d), "y", {"wide": model}, n_boot=SEEDS)


def fit_r2_wide(spark, d):
    """All levels of a column, which are collinear with the intercept: R^2 is that of all but one."""
    return _wide_records(spark, d, COLLINEAR).select(
        "model", "seed", F.size("coef").alias("n_features"), F.round("r2", 8).alias("r2"))


def metrics_wide(spark, d):
    """Predictions of the collinear fit on the test rows."""
    return _rounded(score.metric_dist(_wide_records(spark, d, COLLINEAR),
                                      split_rows(tables.orders_wide(spark, d), "test"), "y"), rmse=4, r2=8)


def feature_match_wide(spark, d):
    """Selection frequencies of the columns that a category was spread over."""
    records = _wide_records(spark, d, Model("lasso", ONE_HOT, ONE_HOT_ALPHAS))
    freq = summary.selection_freq(summary.coef_table(records))
    return _rounded(summary.feature_match(freq, "orderstatus_"), p_nonzero=9).drop("is_intercept")


def moments_one_hot(spark, d):
    """Gram entries of sparse rows, on and above the diagonal."""
    run = fit.prepare(tables.orders_one_hot(spark, d), "y", {"m": Model("linear")}, n_boot=SEEDS)
    units = F.array(*map(F.lit, LEVEL_UNITS.values()))
    table = run.moments()
    width = sum(c[0] == "g" for c in table.columns)
    entries = table.select("seed", "fold", "i", "j0", F.posexplode(F.array(*[f"g{b}" for b in range(width)])).alias("b", "g"))
    entries = entries.withColumn("j", (F.col("j0") + F.col("b")).cast("int")).where(
        (F.col("j") >= F.col("i")) & (F.col("j") < len(LEVEL_UNITS)))
    return entries.select("seed", "fold", "i", "j", F.round(
        F.col("g") / (units[F.col("i")] * units[F.col("j")]), 5).alias("g"))


def fit_wide_tiles(spark, d):
    """4,000 columns, whose Gram matrices stay in tiles; they span two dimensions, so R^2 is that of two columns."""
    records = fit.fit_bootstrap(tables.part_wide(spark, d, WIDE_COLUMNS), "y", {"wide": Model("linear")},
                                n_boot=WIDE_SEEDS, k=1)
    return records.select("model", "seed", F.size("coef").alias("n_features"), F.round("r2", 8).alias("r2"))


def predict_sparse(spark, d):
    """Predictions for sparse test rows from inverted lists of coefficients; one model keeps no feature."""
    train = tables.orders_one_hot(spark, d)
    models = {"wide": Model("lasso", ONE_HOT, (5.0, 1e4)), "none": Model("lasso", ONE_HOT, (1e9,))}
    records = fit.fit_bootstrap(train, "y", models, n_boot=SEEDS)
    test = tables.orders_one_hot(spark, d, "test", train)
    return _rounded(sparse_score.predict_sparse(records, test), prediction=3)


# ------------------------------------------------------------------ analysis

def coef_table(spark, d):
    return _rounded(summary.coef_table(_records(spark, d, {"full": LASSO, "reduced": REDUCED})),
                    coef=3)


def info_table(spark, d):
    info = summary.info_table(_records(spark, d, {"full": LASSO, "ridge": RIDGE}))
    return _rounded(info, r2=8, mse_min=-2).drop("engine_version")


def predict(spark, d):
    test = split_rows(_orders(spark, d), "test")
    return _rounded(score.predict(_records(spark, d, {"full": LASSO}), test.drop("y"),
                                  features=list(FULL)), prediction=4)


def rmse_dist(spark, d):
    return _rounded(_metrics(spark, d, FAMILY).select("model", "seed", "rmse"), rmse=4)


def r2_dist(spark, d):
    """R^2 from sums kept inside the tasks, not from a table of predictions."""
    records = _records(spark, d, {"full": LASSO, "reduced": REDUCED})
    return score.metric_dist(records, split_rows(_orders(spark, d), "test"), "y", via="rows").select(
        "model", "seed", F.round("r2", 8).alias("r2"))


def multi_model(spark, d):
    return _rounded(_metrics(spark, d, FAMILY, via="rows"), rmse=4, r2=8)


def _round_summary(df):
    return df.select("model", *[F.round(c, 4 if c.startswith("rmse") else 8).alias(c)
                                for c in df.columns if c != "model"])


def ci_summary(spark, d):
    return _round_summary(summary.ci_summary(_metrics(spark, d, FAMILY)))


def error_bars(spark, d):
    return _round_summary(summary.error_bars(summary.ci_summary(_metrics(spark, d, FAMILY))))


def coef_ci(spark, d):
    ci = summary.coef_ci(summary.coef_table(_records(spark, d, {"full": LASSO})))
    return _rounded(ci, mean=3, se=3, lower=3, upper=3)


def compare_models(spark, d):
    out = summary.compare_models(_metrics(spark, d, {"full": LASSO, "reduced": REDUCED}),
                                 "full", "reduced", "r2")
    return _rounded(out, diff_mean=8, diff_se=8, diff_lower=8, diff_upper=8)


def bagged_predict(spark, d):
    test = split_rows(_orders(spark, d), "test")
    out = score.bagged_predict(_records(spark, d, {"full": LASSO}), test, features=None)
    return _rounded(out, prediction=4, se=4, lower=4, upper=4)


def _freq(spark, d, **options):
    return summary.selection_freq(_part_coefs(spark, d), **options)


def selection_freq(spark, d):
    return _rounded(_freq(spark, d, include_intercept=True), p_nonzero=9)


def selection_rank(spark, d):
    return _rounded(summary.selection_rank(_freq(spark, d)).drop("is_intercept"), p_nonzero=9)


def selection_count(spark, d):
    return summary.selection_count(_freq(spark, d))


def feature_subset(spark, d):
    freq = _rounded(_freq(spark, d), p_nonzero=9)
    return summary.feature_subset(freq, ["partkey"]).drop("is_intercept")


def feature_match(spark, d):
    return summary.feature_match(_rounded(_freq(spark, d), p_nonzero=9), "iz").drop("is_intercept")


def _shipped(query):
    """The executors get the package with the first query that runs in an application."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(query) for name, query in (own_queries() | CORPUS_QUERIES).items()}


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "load_align": load_align,
        "split_train": split_query("train"),
        "split_test": split_query("test"),
        "split_all": split_query("all"),
        "load_no_index": load_no_index,
        "record_roundtrip": record_roundtrip,
        "seedless_records": seedless_records,
        "record_append": record_append,
        "dense_index": dense_index,
        "dense_index_hashed": dense_index_hashed,
        "fold_assign": fold_assign,
        "resample": resample,
        "resample_weights": resample_weights,
        "poisson_weights": poisson_weights,
        "moments": moments,
        "moments_one_hot": moments_one_hot,
        "fit_wide_tiles": fit_wide_tiles,
        "predict_sparse": predict_sparse,
        "fit_linear": fit_linear,
        "fit_linear_1d": fit_1d(Model("linear", ("qty",))),
        "fit_lasso": fit_lasso,
        "fit_lasso_1d": fit_1d(REDUCED),
        "fit_lasso_default": fit_lasso_default,
        "ridge_df": ridge_df,
        "lasso_knots": lasso_knots,
        "fit_ridge": fit_ridge,
        "fit_r2_wide": fit_r2_wide,
        "metrics_wide": metrics_wide,
        "feature_match_wide": feature_match_wide,
        "cv_path": cv_path,
        "cv_path_1d": cv_path_1d,
        "best_alpha": best_alpha,
        "mse_min": mse_min,
        "fit_r2": fit_r2,
        "coef_table": coef_table,
        "coef_wide": coef_wide,
        "info_table": info_table,
        "predict": predict,
        "rmse_dist": rmse_dist,
        "r2_dist": r2_dist,
        "multi_model": multi_model,
        "ci_summary": ci_summary,
        "error_bars": error_bars,
        "coef_ci": coef_ci,
        "compare_models": compare_models,
        "bagged_predict": bagged_predict,
        "selection_freq": selection_freq,
        "selection_rank": selection_rank,
        "selection_count": selection_count,
        "feature_subset": feature_subset,
        "feature_match": feature_match,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Lasso with cross-validated penalty on 20 resamples of the training orders, scored on the
    test orders: mean, standard error and 95% interval of RMSE and R^2."""
    ship_package(spark)
    orders = _orders(spark, "/root/testdata/sf0.001")
    records = fit.fit_bootstrap(orders, "y", {"full": LASSO}, n_boot=20)
    return summary.ci_summary(score.metric_dist(records, split_rows(orders, "test"), "y"))


# ------------------------------------------------------------------ SQL twins

def _family(sql: o.Sql, names=tuple(FAMILY)) -> o.Sql:
    for name in names:
        m = FAMILY[name]
        sql.fit(name, m.method, m.features,
                o.RIDGE_GRID if m.method == "ridge" else m.alphas or ())
    return sql


def _split_sql(where: str) -> str:
    return (f"SELECT row_id, qty, lines, round(disc, 9) AS disc, round(y, 6) AS y "
            f"FROM ({o.ORDERS_REG}) WHERE {where}")


def oracle_sql() -> dict[str, str]:
    return own_oracles() | CORPUS_ORACLES


def own_oracles() -> dict[str, str]:
    fitted = _family(o.Sql().moments())
    scored = _family(o.Sql().moments()).metrics({n: m.features for n, m in FAMILY.items()})
    only = {n: _family(o.Sql().moments(), (n,)) for n in FAMILY}

    def coefs(name, label):
        return only[name].select(
            f"SELECT model, seed, feature, round(coef, 3) AS coef FROM "
            f"({only[name].long(name, FAMILY[name].features, label)})")

    def one(sql, name):
        return sql.select(f"SELECT seed, alpha, round(b_qty, 6) AS slope, round(b0, 3) AS intercept, "
                          f"round(r2, 8) AS r2 FROM coef_{name} JOIN score_{name} USING (seed)")

    def record(name, extra):
        mse = (f"(SELECT min(mse) FROM path_{name} p WHERE p.seed = c.seed)"
               if name != "linear" else "NULL::DOUBLE")
        return (f"SELECT '{name}' AS model, c.seed, alpha, NULL::INTEGER AS random_state, "
                "'orders_reg' AS training_feats, 'y' AS training_targets, "
                f"{'3' if name == 'ridge' else 'NULL::INTEGER'} AS cv, round({mse}, -2) AS mse_min, "
                f"round(r2, 8) AS r2{extra} FROM coef_{name} c JOIN score_{name} USING (seed)")

    def union(parts):
        return " UNION ALL ".join(parts)

    def paths(names):
        return union(f"SELECT '{n}' AS model, seed, alpha, fold, round(mse, -2) AS mse, "
                     f"round(r2, 8) AS r2 FROM path_{n}" for n in names)

    def summary_sql(cols):
        return scored.select(f"SELECT model, {cols} FROM metrics GROUP BY model")

    bars = ", ".join(
        f"round(avg({v}), {n}) AS {v}_mean, round(avg({v}) - stddev_pop({v}), {n}) AS {v}_se_from, "
        f"round(avg({v}) + stddev_pop({v}), {n}) AS {v}_se_to, "
        f"round(avg({v}) - quantile_cont({v}, 0.025), {n}) AS {v}_ci_below, "
        f"round(quantile_cont({v}, 0.975) - avg({v}), {n}) AS {v}_ci_above"
        for v, n in (("rmse", 4), ("r2", 8)))
    parts = o.Sql(o.PART_LINE, ("partkey", "size"), "true", (0, PART_SEEDS)).moments().fit(
        "part", "lasso", ("partkey", "size"), PART_ALPHAS)
    freq = ("SELECT model, feature, is_intercept, round(avg((coef <> 0)::INTEGER), 9) AS p_nonzero "
            f"FROM ({parts.long('part', ('partkey', 'size'))}) GROUP BY ALL")
    plain = f"SELECT model, feature, p_nonzero FROM ({freq}) WHERE NOT is_intercept"

    default = o.Sql().moments().fit("default", "lasso", FULL, o.LASSO_DEFAULT)
    wide = o.Sql(o.ORDERS_ONE_HOT, ONE_HOT).moments().fit("wide", "linear", ONE_HOT, ())
    wide_lasso = o.Sql(o.ORDERS_ONE_HOT, ONE_HOT).moments().fit("wide", "lasso", ONE_HOT, ONE_HOT_ALPHAS)
    wide_scored = o.Sql(o.ORDERS_ONE_HOT, ONE_HOT).moments().fit("wide", "linear", ONE_HOT, ()).metrics(
        {"wide": ONE_HOT})

    z = list(UNITS)
    mo = o.Sql().moments()
    gram = union(
        f"SELECT seed, fold, {i}::INTEGER AS i, {j}::INTEGER AS j, round(s_"
        f"{'_'.join((a, b) if i <= j else (b, a))} / {o.lit(UNITS[a] * UNITS[b])}, 5) AS g FROM mom"
        for i, a in enumerate(z) for j, b in enumerate(z))

    levels = o.Sql(o.ORDERS_LEVELS, list(LEVEL_UNITS)[1:-1]).moments()
    level_gram = union(
        f"SELECT seed, fold, {i}::INTEGER AS i, {j}::INTEGER AS j, round(s_{a}_{b} / "
        f"{o.lit(LEVEL_UNITS[a] * LEVEL_UNITS[b])}, 5) AS g FROM mom"
        for i, a in enumerate(LEVEL_UNITS) for j, b in enumerate(LEVEL_UNITS) if i <= j)
    mixtures = o.Sql(o.PART_LINE, ("partkey", "size"), "true", (0, WIDE_SEEDS)).moments().fit("wide", "linear", ("partkey", "size"), ())
    sparse = o.Sql(o.ORDERS_ONE_HOT, ONE_HOT).moments().fit("wide", "lasso", ONE_HOT, (5.0, 1e4)).fit(
        "none", "lasso", ONE_HOT, (1e9,)).metrics({"wide": ONE_HOT, "none": ONE_HOT})

    pair = o.Sql().moments()
    pair.ctes.append(
        "whole AS (SELECT seed, n, c_qty_qty AS a, c_qty_disc AS b, c_disc_disc AS d, c_qty_y AS u, c_disc_y AS v "
        "FROM blocks WHERE fold = -1)")
    pair.ctes.append("eigen AS (SELECT seed, big, (a * d - b * b) / big AS small FROM (SELECT *, "
                     "(a + d + sqrt((a - d) ** 2 + 4 * b * b)) / 2 AS big FROM whole))")
    pair.ctes.append(
        "led AS (SELECT seed, n, abs(u) >= abs(v) AS first, CASE WHEN abs(u) >= abs(v) THEN u ELSE v END AS u, "
        "CASE WHEN abs(u) >= abs(v) THEN v ELSE u END AS v, b / CASE WHEN abs(u) >= abs(v) THEN a ELSE d END AS r FROM whole)")
    pair.ctes.append(
        "joined AS (SELECT *, greatest((v - r * u) / (1 - r * sign(u)), -(v - r * u) / (1 + r * sign(u))) AS next FROM led)")
    knots = pair.select(
        "SELECT 'pair' AS model, seed, 1 AS knot, round(abs(u) / n, 3) AS alpha, CASE WHEN first THEN 'qty' ELSE 'disc' END "
        "AS feature, true AS enters FROM joined UNION ALL SELECT 'pair', seed, 2, round(next / n, 3), "
        "CASE WHEN first THEN 'disc' ELSE 'qty' END, true FROM joined WHERE next / n > 0.05")
    degrees = pair.select(
        "SELECT 'pair' AS model, seed, alpha, round(big / (big + alpha) + small / (small + alpha), 8) AS df FROM eigen, "
        "(SELECT unnest([" + ", ".join(o.lit(a) for a in o.RIDGE_GRID) + "]) AS alpha)")

    poisson = o.Sql()
    poisson.ctes.append("p0 AS (SELECT seed, row_id FROM seeds, train)")
    poisson.ctes += o.hash_step("p1", "p0", "seed, row_id", "seed", "42")
    poisson.ctes += o.hash_step("p2", "p1", "seed, row_id", "row_id", "h")
    cases = " ".join(f"WHEN x < {o.lit(p)} THEN {j}" for j, p in enumerate(POISSON_1_CDF))
    draws = o.Sql().draws()
    weights = o.Sql().weights()
    base = o.Sql()

    return {
        "ridge_df": degrees,
        "lasso_knots": knots,
        "moments_one_hot": levels.select(level_gram),
        "fit_wide_tiles": mixtures.select(f"SELECT 'wide' AS model, seed, {WIDE_COLUMNS}::INTEGER AS n_features, "
                                          "round(r2, 8) AS r2 FROM score_wide"),
        "predict_sparse": sparse.select("SELECT model, row_id, seed, round(prediction, 3) AS prediction FROM pred"),
        "load_align": "SELECT row_id, qty, lines, round(disc, 9) AS disc, round(y, 6) AS y, "
                      f"test_set FROM ({o.ORDERS_REG})",
        "load_no_index": "SELECT CASE WHEN row_id % 2 = 0 THEN 'a' ELSE 'b' END AS file, "
                         "row_number() OVER (PARTITION BY row_id % 2 ORDER BY row_id) - 1 AS row_id, "
                         f"row_id AS was, qty::DOUBLE AS qty, lines::DOUBLE AS lines FROM ({o.ORDERS_REG})",
        "seedless_records": scored.select(
            "SELECT count(*)::BIGINT AS n, round(avg(rmse), 4) AS rmse_mean, "
            "round(avg(r2), 8) AS r2_mean FROM metrics WHERE model = 'full'"),
        "coef_wide": fitted.select(
            "SELECT 'full' AS model, seed, round(b_qty, 3) AS qty, round(b_lines, 3) AS lines, "
            "round(b_disc, 3) AS disc, round(b0, 3) AS intercept FROM coef_full UNION ALL "
            "SELECT 'reduced', seed, round(b_qty, 3), NULL, NULL, round(b0, 3) FROM coef_reduced"),
        "dense_index_hashed": "SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS position FROM "
                              "(SELECT (u - CASE WHEN u >= 9223372036854775808 THEN 18446744073709551616 "
                              "ELSE 0 END)::BIGINT AS row_id FROM (SELECT ('0x' || substr(md5(row_id::VARCHAR), "
                              f"1, 16))::UBIGINT::HUGEINT AS u FROM ({o.ORDERS_REG}) WHERE test_set = 0))",
        "split_train": _split_sql("test_set = 0"),
        "split_test": _split_sql("test_set = 1"),
        "split_all": _split_sql("true"),
        "record_roundtrip": fitted.select(union(
            record(n, f", 'qty,lines,disc' AS names, round(b_qty, 3) AS coef_first, "
                      "round(b0, 3) AS intercept") for n in ("full", "ridge", "linear"))),
        "record_append": fitted.select(union(
            f"SELECT '{n}' AS model, seed, count(*)::BIGINT AS copies, round(max(b0), 3) AS intercept "
            f"FROM coef_{n} GROUP BY seed" for n in ("reduced", "linear"))),
        "dense_index": base.select("SELECT row_id, position::BIGINT AS position FROM train"),
        "fold_assign": base.select(f"SELECT row_id, position::BIGINT AS position, "
                                   f"{base.fold('position')} AS fold FROM train, size"),
        "resample": draws.select("SELECT * FROM draws"),
        "resample_weights": weights.select("SELECT seed, row_id, fold, w FROM w"),
        "poisson_weights": poisson.select(
            "SELECT seed, row_id, ((h & 2047)::BIGINT % 3)::INTEGER AS fold, w::INTEGER AS w FROM "
            f"(SELECT *, CASE {cases} ELSE {len(POISSON_1_CDF)} END AS w FROM "
            f"(SELECT *, (h >> 11)::DOUBLE * {o.lit(2.0 ** -53)} AS x FROM p2)) WHERE w > 0"),
        "moments": mo.select(gram),
        "fit_linear": coefs("linear", "linear"),
        "fit_linear_1d": weights.select(
            "SELECT seed, NULL::DOUBLE AS alpha, round(regr_slope(y, qty), 6) AS slope, "
            "round(regr_intercept(y, qty), 3) AS intercept, round(regr_r2(y, qty), 8) AS r2 "
            "FROM draws JOIN train USING (position) GROUP BY seed"),
        "fit_lasso": coefs("full", "lasso"),
        "fit_lasso_1d": one(only["reduced"], "reduced"),
        "fit_ridge": coefs("ridge", "ridge"),
        "fit_lasso_default": default.select(
            "SELECT model, seed, feature, round(coef, 3) AS coef FROM "
            f"({default.long('default', FULL, 'lasso')})"),
        "fit_r2_wide": wide.select("SELECT 'wide' AS model, seed, 4::INTEGER AS n_features, "
                                   "round(r2, 8) AS r2 FROM score_wide"),
        "metrics_wide": wide_scored.select("SELECT model, seed, round(rmse, 4) AS rmse, "
                                           "round(r2, 8) AS r2 FROM metrics"),
        "feature_match_wide": wide_lasso.select(
            "SELECT model, feature, round(avg((coef <> 0)::INTEGER), 9) AS p_nonzero FROM "
            f"({wide_lasso.long('wide', ONE_HOT)}) WHERE feature LIKE 'orderstatus_%' GROUP BY ALL"),
        "cv_path": fitted.select(paths(("full", "ridge"))),
        "cv_path_1d": fitted.select(paths(("reduced",))),
        "best_alpha": fitted.select(union(f"SELECT '{n}' AS model, seed, alpha FROM best_{n}"
                                          for n in ("reduced", "full", "ridge"))),
        "mse_min": fitted.select(union(
            f"SELECT '{n}' AS model, seed, round(min(mse), -2) AS mse_min FROM path_{n} "
            "GROUP BY seed" for n in ("full", "ridge"))),
        "fit_r2": fitted.select(union(f"SELECT '{n}' AS model, seed, round(r2, 8) AS r2 "
                                      f"FROM score_{n}" for n in FAMILY)),
        "coef_table": fitted.select(
            "SELECT model, seed, feature, is_intercept, round(coef, 3) AS coef FROM ("
            + fitted.long("full", FULL) + " UNION ALL " + fitted.long("reduced", ("qty",)) + ")"),
        "info_table": fitted.select(union(record(n, "") for n in ("full", "ridge"))),
        "predict": scored.select("SELECT model, row_id, seed, round(prediction, 4) AS prediction "
                                 "FROM pred WHERE model = 'full'"),
        "rmse_dist": scored.select("SELECT model, seed, round(rmse, 4) AS rmse FROM metrics"),
        "r2_dist": scored.select("SELECT model, seed, round(r2, 8) AS r2 FROM metrics "
                                 "WHERE model IN ('full', 'reduced')"),
        "multi_model": scored.select("SELECT model, seed, round(rmse, 4) AS rmse, "
                                     "round(r2, 8) AS r2 FROM metrics"),
        "ci_summary": summary_sql(o.distribution("rmse", "rmse_", 4) + ", "
                                  + o.distribution("r2", "r2_", 8)),
        "error_bars": summary_sql(bars),
        "coef_ci": fitted.select(
            f"SELECT model, feature, is_intercept, {o.distribution('coef', '', 3)} FROM "
            f"({fitted.long('full', FULL)}) GROUP BY ALL"),
        "compare_models": scored.select(
            "SELECT 'full' AS first, 'reduced' AS second, 'r2' AS metric, "
            f"count(*)::BIGINT AS n_pairs, {o.distribution('d', 'diff_', 8)}, "
            "avg((d > 0)::INTEGER)::DOUBLE AS share_above_zero FROM (SELECT a.r2 - b.r2 AS d "
            "FROM metrics a JOIN metrics b USING (seed) WHERE a.model = 'full' "
            "AND b.model = 'reduced')"),
        "bagged_predict": scored.select(
            "SELECT model, row_id, round(avg(prediction), 4) AS prediction, "
            "round(stddev_pop(prediction), 4) AS se, "
            "round(quantile_cont(prediction, 0.025), 4) AS lower, "
            "round(quantile_cont(prediction, 0.975), 4) AS upper "
            "FROM pred WHERE model = 'full' GROUP BY model, row_id"),
        "selection_freq": parts.select(freq),
        "selection_rank": parts.select(f"{plain} ORDER BY p_nonzero, feature"),
        "selection_count": parts.select(
            "SELECT model, count(*)::BIGINT AS n_features, "
            f"count_if(p_nonzero > 0.5)::BIGINT AS n_selected FROM ({plain}) GROUP BY model"),
        "feature_subset": parts.select(f"SELECT * FROM ({plain}) WHERE feature = 'partkey'"),
        "feature_match": parts.select(f"SELECT * FROM ({plain}) WHERE feature LIKE '%iz%'"),
    }
