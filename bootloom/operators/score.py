"""Predictions, error metrics per replicate, and bagging.

The number of (row, replicate) pairs is the one thing here that multiplies, so only
`predict` writes them out, for when that table is itself the wanted result. Metrics come
from the moments of the evaluated rows or from sums kept inside each task, and bagging
reduces the replicates of a row where the row is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.scratch import computed_once, staged
from ..sources.frames import ROW_ID, frame_stats, packed, unpacked
from ..sources.records import unique_records
from .moments import plain_moments
from .solve import CONSTANT, ratio, squared_error

# Coefficients shipped to the tasks at once; more replicates go in several passes.
SHIPPED_BYTES = 64 << 20
# (row, replicate) values held at once in a task.
VALUES_AT_ONCE = 1 << 20
# Up to this many features the metrics come from one Gram matrix of the evaluated rows.
GRAM_FEATURES = 512


@dataclass(frozen=True)
class Replicates:
    """Coefficients of some replicates of one model, features in the order of `features`."""
    model: str | None
    features: list[str]
    seeds: np.ndarray
    coef: np.ndarray        # replicates x features
    intercept: np.ndarray


def replicates(records: DataFrame, features: list[str] | None = None) -> Iterator[Replicates]:
    """The replicates of a record table, at most SHIPPED_BYTES of coefficients at a time.

    The records (one small row per model and seed) are first put in a table of their own, so
    that the fits behind them run once however many passes follow.
    """
    kept = _kept(records)
    groups = (kept.groupBy("model", "column_names")
              .agg(F.sort_array(F.collect_list("seed")).alias("seeds")).collect())
    size = sum(8 * len(g["seeds"]) * (len(g["column_names"]) + 1) for g in groups)
    together = None
    if size <= SHIPPED_BYTES:
        together = kept.toPandas()
        together["group"] = [(m, *names) for m, names in
                             zip(together["model"], together["column_names"])]
    for g in sorted(groups, key=lambda g: (g["model"] or "", g["column_names"])):
        if features is not None and set(features) != set(g["column_names"]):
            raise ValueError(f"model {g['model']!r} was fitted on other features: "
                             f"{sorted(set(features) ^ set(g['column_names']))}")
        if together is not None:
            same = together["group"].map((g["model"], *g["column_names"]).__eq__)
            yield _replicates(g, together[same])
            continue
        at_once = max(1, SHIPPED_BYTES // (8 * (len(g["column_names"]) + 1)))
        for s in range(0, len(g["seeds"]), at_once):
            part = g["seeds"][s:s + at_once]
            yield _replicates(g, kept.where(
                F.col("model").eqNullSafe(F.lit(g["model"]))
                & (F.col("column_names") == F.array(*map(F.lit, g["column_names"])))
                & F.col("seed").between(part[0], part[-1])).toPandas())


def _kept(records: DataFrame) -> DataFrame:
    """The records in a table of their own; repeated or missing seeds are an error."""
    return staged(unique_records(records.select("model", "seed", "intercept", "coef", "column_names")),
                  "records")


def _replicates(group, rows: pd.DataFrame) -> Replicates:
    names = sorted(group["column_names"])
    order = np.array([group["column_names"].index(c) for c in names], dtype=int)
    rows = rows.sort_values("seed")
    return Replicates(group["model"], names, rows["seed"].to_numpy(np.int64),
                      np.stack(rows["coef"].to_list()).astype(float)[:, order],
                      rows["intercept"].to_numpy(float))


def _need(df: DataFrame, features: list[str]) -> None:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"the table to score lacks the features {missing}")


def _row_slices(rows: int, per_row: int) -> Iterator[slice]:
    step = max(1, VALUES_AT_ONCE // max(per_row, 1))
    for lo in range(0, rows, step):
        yield slice(lo, min(lo + step, rows))


def _passes(parts: Iterator[Replicates]) -> Iterator[tuple[list[Replicates], list[str]]]:
    """Replicates that share a pass over the rows, of whatever models, with the union of
    their features."""
    now, size = [], 0
    for r in parts:
        if now and size + r.coef.nbytes > SHIPPED_BYTES:
            yield now, sorted({f for p in now for f in p.features})
            now, size = [], 0
        now, size = now + [r], size + r.coef.nbytes
    if now:
        yield now, sorted({f for p in now for f in p.features})


def _over_rows(parts: Iterator[Replicates], df: DataFrame, keep: list[str], schema: str,
               make) -> DataFrame:
    """Apply ``make(passed)(batches)`` to the rows of `df`, once per pass. `passed` lists
    each replicate block with the places of its features in the packed columns of a row."""
    out = None
    for now, names in _passes(parts):
        _need(df, names)
        place = {c: i for i, c in enumerate(names)}
        passed = [(r, [place[f] for f in r.features]) for r in now]
        part = df.select(*[F.col(f"`{c}`") for c in keep], *packed(names)).mapInArrow(
            make(passed, len(names)), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no records to work with")
    return out


def predict(records: DataFrame, df: DataFrame, features: list[str] | None = None,
            row_id: str = ROW_ID, target: str | None = None) -> DataFrame:
    """(model, row_id, seed, prediction[, target]): every row under every replicate.

    Coefficients and features are matched by name. With `features` given, a record fitted on
    any other set is an error; without, the features of the record must be in the table.
    """
    carried = f", `{target}` double" if target else ""
    schema = f"model string, `{row_id}` long, seed long, prediction double{carried}"

    def make(passed, m):
        def run(batches):
            for whole in batches:
                x, ids = unpacked(whole, m), whole.column(row_id).to_numpy()
                y = whole.column(target).to_numpy(zero_copy_only=False) if target else None
                for r, at in passed:
                    for rows in _row_slices(len(x), len(r.seeds)):
                        p = x[rows][:, at] @ r.coef.T + r.intercept
                        n, b = p.shape
                        data = {"model": pa.array([r.model], pa.string()).take(
                                    pa.array(np.zeros(n * b, dtype=np.int32))),
                                row_id: np.repeat(ids[rows], b),
                                "seed": np.tile(r.seeds, n), "prediction": p.ravel()}
                        if target:
                            data[target] = np.repeat(y[rows].astype(float), b)
                        yield pa.RecordBatch.from_pydict(data)
        return run

    return _over_rows(replicates(records, features), _long_id(df, row_id),
                      [row_id] + ([target] if target else []), schema, make)


def prediction_metrics(predictions: DataFrame, target: str) -> DataFrame:
    """(model, seed, rmse, r2) from a table of predictions that carries the target."""
    y = F.col(f"`{target}`")
    error = y - F.col("prediction")
    sums = predictions.groupBy("model", "seed").agg(
        F.avg(error * error).alias("mse"), F.var_pop(y).alias("var"))
    constant = F.when(F.col("mse") == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return sums.select("model", "seed", F.sqrt("mse").alias("rmse"),
                       F.when(F.col("var") == 0, constant)
                       .otherwise(1 - F.try_divide("mse", "var")).alias("r2"))


def metric_dist(records: DataFrame, df: DataFrame, target: str,
                features: list[str] | None = None, via: str | None = None,
                row_id: str = ROW_ID) -> DataFrame:
    """(model, seed, rmse, r2) of every replicate on the rows of `df`.

    Records are read first, and their features (or `features`, which must have them all) are
    the only columns looked at. via="moments" reduces the rows to one Gram matrix that serves
    all replicates, and scores the records where they are. via="rows" predicts in the tasks and
    keeps only error sums; it gives the same and is the default for very many features.
    """
    if via not in (None, "moments", "rows"):
        raise ValueError(f"via must be 'moments' or 'rows', not {via!r}")
    records = _kept(records)
    used = {r[0] for r in records.select(F.explode("column_names")).distinct().collect()}
    if features is not None and used - set(features):
        raise ValueError(f"records have other features: {sorted(used - set(features))}")
    features = sorted(used)
    _need(df, features + [target])
    ids = [row_id] if row_id in df.columns else []
    df = computed_once(df.select(*[f"`{c}`" for c in [*ids, *features, target]]))
    if via is None:
        via = "moments" if len(features) <= GRAM_FEATURES else "rows"
    if via == "moments":
        return _from_gram(records, df, features, target, row_id)
    parts = list(replicates(records))
    if not parts:
        raise ValueError("no records to work with")
    stats = frame_stats(df, sorted({f for r in parts for f in r.features}) + [target], row_id)
    return _from_rows(df, parts, target, stats)


def _from_gram(records, df, features, target, row_id) -> DataFrame:
    columns = features + [target]
    stats = frame_stats(df, columns, row_id)
    gram = plain_moments(df, columns, stats.centres(columns))
    place = {c: i for i, c in enumerate(features, start=1)}
    n, means, last = gram[0, 0], stats.means, len(columns)
    sst = gram[-1, -1] - gram[0, -1] ** 2 / n
    sst = sst if sst > CONSTANT * gram[-1, -1] else 0.0

    def score(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                names, b = r["column_names"], np.asarray(r["coef"], dtype=float)
                unknown = [c for c in names if c not in place]
                if unknown:
                    raise ValueError(f"the table to score lacks the features {unknown}")
                at = [0] + [place[c] for c in names] + [last]
                b0 = r["intercept"] + sum(means[c] * x for c, x in zip(names, b))
                sse = squared_error(gram[np.ix_(at, at)], b, b0 - means[target])
                out.append({"model": r["model"], "seed": r["seed"],
                            "rmse": float(np.sqrt(sse / n)), "r2": ratio(sst, sse)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("model", pa.string()), ("seed", pa.int64()), ("rmse", pa.float64()),
                ("r2", pa.float64())]))

    return records.select("model", "seed", "intercept", "coef", "column_names").mapInArrow(
        score, "model string, seed long, rmse double, r2 double")


def _from_rows(df, parts, target, stats) -> DataFrame:
    centre = stats.means[target]

    def make(passed, m):
        def sums(batches):
            sse, sst, n = [np.zeros(len(r.seeds)) for r, _ in passed], 0.0, 0
            for whole in batches:
                x = unpacked(whole, m)
                y = whole.column(target).to_numpy(zero_copy_only=False).astype(float)
                sst, n = sst + ((y - centre) ** 2).sum(), n + len(y)
                for total, (r, at) in zip(sse, passed):
                    for rows in _row_slices(len(x), len(r.seeds)):
                        p = x[rows][:, at] @ r.coef.T + r.intercept
                        total += ((y[rows, None] - p) ** 2).sum(axis=0)
            for total, (r, _) in zip(sse, passed):
                b = len(r.seeds)
                yield pa.RecordBatch.from_pydict({
                    "model": pa.array([r.model] * b, pa.string()), "seed": r.seeds, "sse": total,
                    "sst": np.full(b, sst), "n": np.full(b, n)})
        return sums

    total = _over_rows(parts, df, [target],
                       "model string, seed long, sse double, sst double, n long", make) \
        .groupBy("model", "seed").agg(*[F.sum(c).alias(c) for c in ("sse", "sst", "n")])
    constant = F.when(F.col("sse") == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return total.select("model", "seed", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                        F.when(F.col("sst") == 0, constant)
                        .otherwise(1 - F.try_divide("sse", "sst")).alias("r2"))


def bagged_predict(records: DataFrame, df: DataFrame, features: list[str] | None = None,
                   row_id: str = ROW_ID, level: float = 95.0) -> DataFrame:
    """(model, row_id, prediction, se, lower, upper): the mean over replicates, their
    population standard deviation and percentile interval.

    As long as all coefficients go with one pass over the rows nothing is shuffled. More of them go in blocks, one at a
    time: each block leaves, per row, moments that can be put together and its lowest and highest predictions, as
    many as the interval's ends can lie among, and these are merged by row.
    """
    df, tails = _long_id(df, row_id), [(100 - level) / 2, 100 - (100 - level) / 2]
    passes = _passes(replicates(records, features))
    first, second = next(passes, None), next(passes, None)
    if second is not None:
        return _merged_blocks(_bag_blocks(chain([first, second], passes), records, df, row_id, tails[0]), row_id, tails[0])
    schema = (f"model string, `{row_id}` long, prediction double, se double, lower double, "
              "upper double")

    def make(passed, m):
        def bag(batches):
            for whole in batches:
                x, ids = unpacked(whole, m), whole.column(row_id).to_numpy()
                for r, at in passed:
                    for rows in _row_slices(len(x), len(r.seeds)):
                        p = x[rows][:, at] @ r.coef.T + r.intercept
                        lower, upper = np.percentile(p, tails, axis=1)
                        yield pa.RecordBatch.from_pydict({
                            "model": pa.array([r.model] * len(p), pa.string()),
                            row_id: ids[rows], "prediction": p.mean(axis=1),
                            "se": p.std(axis=1), "lower": lower, "upper": upper})
        return bag

    return _over_rows(iter(first[0] if first else ()), df, [row_id], schema, make)


def _bag_blocks(passes, records: DataFrame, df: DataFrame, row_id: str, tail: float) -> DataFrame:
    """(model, row_id, n, mean, m2, low, high) per row and block of replicates, each block written before the next
    one is fetched."""
    sizes = {r["model"]: r["count"] for r in records.groupBy("model").count().collect()}
    schema = f"model string, `{row_id}` long, n long, mean double, m2 double, low array<double>, high array<double>"

    def make(passed, m):
        def bag(batches):
            for whole in batches:
                x, ids = unpacked(whole, m), whole.column(row_id).to_numpy()
                for r, at in passed:
                    b = len(r.seeds)
                    k = min(b, int((sizes[r.model] - 1) * tail / 100) + 2)
                    for rows in _row_slices(len(x), b):
                        p = np.sort(x[rows][:, at] @ r.coef.T + r.intercept, axis=1)
                        ends = np.arange(len(p) + 1, dtype=np.int32) * k
                        yield pa.RecordBatch.from_arrays([
                            pa.array([r.model] * len(p), pa.string()), pa.array(ids[rows]), pa.array(np.full(len(p), b)),
                            pa.array(p.mean(axis=1)), pa.array(p.var(axis=1) * b),
                            pa.ListArray.from_arrays(ends, p[:, :k].ravel()),
                            pa.ListArray.from_arrays(ends, p[:, b - k:].ravel())],
                            names=["model", row_id, "n", "mean", "m2", "low", "high"])
        return bag

    out = None
    for now, _ in passes:
        part = staged(_over_rows(iter(now), df, [row_id], schema, make), "bag")
        out = part if out is None else out.unionByName(part)
    return out


def _merged_blocks(parts: DataFrame, row_id: str, tail: float) -> DataFrame:
    rows = parts.groupBy("model", row_id).agg(
        F.sum("n").alias("b"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("prediction"),
        F.collect_list(F.struct("n", "mean", "m2")).alias("s"), F.array_sort(F.flatten(F.collect_list("low"))).alias("low"),
        F.sort_array(F.flatten(F.collect_list("high")), False).alias("high"))
    spread = F.aggregate("s", F.lit(0.0), lambda a, e: a + e["m2"] + e["n"] * (e["mean"] - F.col("prediction")) ** 2)
    place = (F.col("b") - 1) * F.lit(tail / 100)
    at = F.floor(place).cast("int")

    def end(c):
        one = F.element_at(c, at + 1)
        return one + (place - at) * (F.element_at(c, F.least(at + 2, F.col("b")).cast("int")) - one)

    return rows.select("model", row_id, "prediction", F.sqrt(spread / F.col("b")).alias("se"),
                       end("low").alias("lower"), end("high").alias("upper"))


def _long_id(df: DataFrame, row_id: str) -> DataFrame:
    return df.withColumn(row_id, F.col(row_id).cast("long"))
