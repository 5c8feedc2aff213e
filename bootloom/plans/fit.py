"""Bootstrap fits: table in, one record per (model, seed) out."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.scratch import computed_once
from ..operators import moments as mom, solve, tiles, wide
from ..operators.resample import EXACT, SAMPLINGS, seed_list
from ..sources import commits
from ..sources.frames import (ROW_ID, TEST_COLUMN, FrameStats, feature_names, frame_stats,
                              split_rows)
from ..sources.sparse import Sparse
from ..sources.records import ENGINE_VERSION, RECORD, append_records, missing_seeds, read_records


# Columns beyond which the Gram matrices of a seed stay in tiles.
WIDE = 3000


@dataclass(frozen=True)
class Model:
    """What to fit: a method, the features it sees (all when None) and a penalty grid."""
    method: str = solve.LASSO
    features: tuple[str, ...] | None = None
    alphas: tuple[float, ...] | None = None


@dataclass(frozen=True)
class Prepared:
    """Everything a run needs that is known before its one distributed pass."""
    rows: DataFrame
    stats: FrameStats
    columns: list[str]
    models: dict[str, tuple[str, list[str], tuple]]
    seeds: list[int]
    k: int
    sampling: str
    row_id: str
    sparse: Sparse | None = None
    tile: int = tiles.TILE

    def is_wide(self) -> bool:
        return len(self.columns) > WIDE

    def tiles(self) -> DataFrame:
        shared = (self.seeds, self.k, self.sampling, self.row_id, self.tile)
        if self.sparse is None:
            return tiles.dense_tiles(self.rows, self.stats, self.columns, *shared)
        at = [0, *self.sparse.places(self.columns)]
        return tiles.sparse_tiles(self.sparse.only(at), self.stats, self.sparse.rest[at], *shared)

    def moments(self) -> DataFrame:
        if self.sparse is not None or self.is_wide():
            return tiles.as_moments(self.tiles(), self.k, self.tile)
        return mom.moments(self.rows, self.stats, self.columns, self.seeds, self.k, self.sampling, self.row_id)

    def solved(self) -> DataFrame:
        centres = self.stats.centres(self.columns)
        if self.is_wide():
            return wide.solve_wide(self.tiles(), self.columns, centres, self.models, self.seeds, self.k, self.tile)
        return solve.solve_replicates(self.moments(), self.columns, centres, self.models, len(self.seeds))


def prepare(df: DataFrame | Sparse, target: str, models: dict[str, Model] | None = None, *,
            n_boot: int = 2, seed_start: int = 0, seeds: list[int] | None = None,
            split: str = "train", k: int = 3, sampling: str = EXACT,
            row_id: str = ROW_ID) -> Prepared:
    """A run over a feature table, or over sparse rows as `sparse.one_hot` makes them; those were split when they
    were made, so `split` does not apply to them."""
    if sampling not in SAMPLINGS:
        raise ValueError(f"unknown sampling {sampling!r}: use one of {', '.join(SAMPLINGS)}")
    seeds = seed_list(seed_start, n_boot) if seeds is None else list(seeds)
    if not seeds or len(set(seeds)) < len(seeds):
        raise ValueError("seeds must be given once each")
    sparse = df if isinstance(df, Sparse) else None
    every = feature_names(df, target, row_id) if sparse is None else sparse.names[1:-1]
    resolved = {}
    for name, model in (models or {"lasso": Model()}).items():
        solve.check_method(model.method)
        features = list(every if model.features is None else model.features)
        known = set(every)
        unknown = [f for f in features if f not in known]
        if unknown or not features:
            raise ValueError(f"model {name!r} has no or unknown features: {unknown}")
        if model.method != solve.LINEAR and k < 2:
            raise ValueError("choosing a penalty needs at least 2 folds")
        alphas = solve.DEFAULT_ALPHAS[model.method] if model.alphas is None else model.alphas
        if model.method != solve.LINEAR and (not alphas or min(alphas) <= 0):
            raise ValueError(f"model {name!r} needs positive penalties")
        resolved[name] = (model.method, features, tuple(alphas))
    wanted = {f for m in resolved.values() for f in m[1]}
    columns = [f for f in every if f in wanted] + [target]
    if sparse is not None:
        if sparse.row_id != row_id or sparse.names[-1] != target:
            raise ValueError(f"the sparse rows were made for {sparse.row_id} and {sparse.names[-1]}")
        return Prepared(sparse.rows, sparse.stats, columns, resolved, seeds, k, sampling, row_id, sparse)
    marker = [TEST_COLUMN] if TEST_COLUMN in df.columns else []
    rows = computed_once(split_rows(df.select(F.col(row_id).cast("long").alias(row_id),
                                              *[f"`{c}`" for c in columns], *marker), split))
    stats = frame_stats(rows, columns, row_id)
    return Prepared(rows, stats, columns, resolved, seeds, k, sampling, row_id)


def fit_bootstrap(df: DataFrame, target: str, models: dict[str, Model] | None = None, *,
                  training_feats: str | None = None, training_targets: str | None = None,
                  **options) -> DataFrame:
    """Fit every model to every resample; one record per (model, seed).

    All models of a call share the resamples and one pass over the data: the moments are
    taken over the union of their features. Options are those of `prepare`.
    """
    return to_records(prepare(df, target, models, **options), training_feats, training_targets)


def to_records(run: Prepared, training_feats: str | None = None,
               training_targets: str | None = None) -> DataFrame:
    ridge = [name for name, m in run.models.items() if m[0] == solve.RIDGE]
    given = {
        "random_state": F.lit(None).cast("int"),
        "training_feats": F.lit(training_feats).cast("string"),
        "training_targets": F.lit(training_targets).cast("string"),
        "cv": F.when(F.col("model").isin(ridge), F.lit(run.k)),
        "engine_version": F.lit(ENGINE_VERSION),
        "settings": F.coalesce(*[F.when(F.col("model") == name, F.lit(settings(run, name)))
                                 for name in run.models]),
    }
    return run.solved().select(*[given[f.name].alias(f.name) if f.name in given else f.name
                                 for f in RECORD.fields])


def settings(run: Prepared, name: str) -> str:
    """What decides a record besides its seed: records with other settings don't belong to the
    same run."""
    method, features, alphas = run.models[name]
    return json.dumps({"method": method, "features": features, "target": run.columns[-1],
                       "alphas": list(alphas) if method != solve.LINEAR else [], "k": run.k,
                       "sampling": run.sampling, "n": run.stats.n})


def cv_path(run: Prepared) -> DataFrame:
    """(model, seed, alpha, fold, mse, r2): held-out errors of every penalty and fold."""
    return run.solved().select("model", "seed", F.explode("path").alias("p")).select(
        "model", "seed", "p.alpha", "p.fold", "p.mse", "p.r2")


def ridge_degrees(run: Prepared) -> DataFrame:
    """(model, seed, alpha, df): effective degrees of freedom of the ridge models at their penalties."""
    return solve.ridge_degrees(run.moments(), run.columns, run.models, len(run.seeds))


def lasso_knots(run: Prepared) -> DataFrame:
    """(model, seed, knot, alpha, feature, enters): where the set of features changes along each lasso path."""
    return solve.lasso_knots(run.moments(), run.columns, run.models, len(run.seeds))


def extend_run(df: DataFrame, target: str, models: dict[str, Model], path: str, *,
               n_boot: int, seed_start: int = 0, **options) -> int:
    """Fit only the (model, seed) pairs a record folder does not hold and append them, so a
    run can be repeated or continued. Returns the number of records added. Runs can extend a folder at the same time:
    what another one has committed meanwhile is not added again.

    Records of a model of the same name that were fitted with other features, penalties, folds,
    sampling or number of rows are an error; records without settings are taken as they are."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(
        [(m, s) for m in models for s in seed_list(seed_start, n_boot)], "model string, seed long")
    if commits.exists(spark, path):
        todo = missing_seeds(spark, wanted, path).collect()
        plain = {k: v for k, v in options.items() if not k.startswith("training_")}
        run = prepare(df, target, models, n_boot=1, **plain)
        held = read_records(spark, path).where(F.col("model").isin(list(models))).select(
            "model", "settings").where("settings IS NOT NULL").distinct().collect()
        other = sorted({r["model"] for r in held if r["settings"] != settings(run, r["model"])})
        if other:
            raise ValueError(f"{path} holds records of {other} that were fitted with other settings")
    else:
        todo = wanted.collect()
    # Models that lack the same seeds go through the data together.
    lacking: dict[tuple, list[str]] = {}
    for name in models:
        seeds = tuple(sorted(r["seed"] for r in todo if r["model"] == name))
        if seeds:
            lacking.setdefault(seeds, []).append(name)
    added = 0
    for seeds, names in lacking.items():
        records = fit_bootstrap(df, target, {n: models[n] for n in names},
                                seeds=list(seeds), **options)
        added += append_records(records, path, once=True)
    return added
