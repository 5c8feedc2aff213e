"""Linear, lasso and ridge fits with cross-validated penalty, from moments.

All estimators have an unpenalised intercept and leave the features unscaled:

* linear  minimises |y - Xb|^2 (the shortest b where that is not unique)
* lasso   minimises |y - Xb|^2 / 2n + alpha |b|_1
* ridge   minimises |y - Xb|^2 + alpha |b|^2

Here `Block` is the moment matrix of some weighted rows, and a fit is a small dense problem
on it. One group of `solve_replicates` is one seed; all models of a run share its matrix,
each reading the rows and columns of its own features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .moments import unpack

LINEAR, LASSO, RIDGE = "linear", "lasso", "ridge"
METHODS = (LINEAR, LASSO, RIDGE)

# The penalty grids offered by default.
DEFAULT_ALPHAS = {
    LINEAR: (),
    LASSO: (0.05, 0.1, 0.2),
    RIDGE: (1e-5, 1e-4, 1e-3, 1e-2, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0),
}

# A column counts as constant when centring removes all but this share of its square sum.
CONSTANT = 1e-12
# Eigenvalues of the correlation matrix below this share of the largest count as zero.
RANK = 1e-11
SWEEPS = 20000
# Where the active set cannot be solved, the duality gap to reach, as a share of y'y.
GAP = 1e-12

SOLVED = """model string, seed long, alpha double, mse_min double, r2 double,
    coef array<double>, intercept double, column_names array<string>, n double,
    path array<struct<alpha: double, fold: int, mse: double, r2: double>>"""
_CELL = pa.struct([("alpha", pa.float64()), ("fold", pa.int32()), ("mse", pa.float64()),
                   ("r2", pa.float64())])
_SOLVED = pa.schema([
    ("model", pa.string()), ("seed", pa.int64()), ("alpha", pa.float64()),
    ("mse_min", pa.float64()), ("r2", pa.float64()), ("coef", pa.list_(pa.float64())),
    ("intercept", pa.float64()), ("column_names", pa.list_(pa.string())), ("n", pa.float64()),
    ("path", pa.list_(_CELL))])


def check_method(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"unknown model {method!r}: use one of {', '.join(METHODS)}")


@dataclass
class Block:
    """Moments about the block's own means, from a Gram matrix of (1, features, target)."""
    n: float
    mean: np.ndarray      # features, about the overall centres
    y_mean: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float
    live: np.ndarray      # features that vary in this block

    @classmethod
    def of(cls, gram: np.ndarray) -> "Block":
        n, total, square = gram[0, 0], gram[0, 1:], gram[1:, 1:]
        if n <= 0:
            raise ValueError("a resample or one of its training sets has no rows")
        centred = square - np.outer(total, total) / n
        raw = np.diag(square)
        live = np.diag(centred) > CONSTANT * raw
        centred[~live, :] = 0.0
        centred[:, ~live] = 0.0
        return cls(n, total[:-1] / n, total[-1] / n, centred[:-1, :-1], centred[:-1, -1],
                   centred[-1, -1], live[:-1])

    def intercept(self, b: np.ndarray) -> float:
        return self.y_mean - self.mean @ b

    def r2(self, b: np.ndarray) -> float:
        """In-sample: the intercept is the fitted one, so only centred moments matter."""
        return ratio(self.yy, self.yy - 2 * b @ self.xy + b @ self.xx @ b)


def ratio(sst: float, sse: float) -> float:
    """1 - sse/sst; a constant target gives NaN for a perfect fit and -inf otherwise."""
    if sst > 0:
        return float(1.0 - sse / sst)
    return float("nan") if sse == 0 else float("-inf")


def squared_error(gram: np.ndarray, b: np.ndarray, intercept: float) -> float:
    """Sum of w (y - intercept - x b)^2 over the rows behind a Gram matrix."""
    v = np.concatenate([[-intercept], -b, [1.0]])
    return max(float(v @ gram @ v), 0.0)


def fit_linear(block: Block) -> np.ndarray:
    """Least squares; of all solutions the shortest. The rank is judged on the correlation
    matrix, so it does not depend on the units of the features."""
    b = np.zeros(len(block.xy))
    live = np.flatnonzero(block.live)
    if not len(live):
        return b
    scale = np.sqrt(np.diag(block.xx)[live])
    value, vector = np.linalg.eigh(block.xx[np.ix_(live, live)] / np.outer(scale, scale))
    kept = value > RANK * value[-1]
    if kept.all():
        b[live] = np.linalg.solve(block.xx[np.ix_(live, live)], block.xy[live])
        return b
    right = vector[:, kept].T @ (block.xy[live] / scale)
    some = (vector[:, kept] @ (right / value[kept])) / scale
    null, _ = np.linalg.qr(vector[:, ~kept] / scale[:, None])
    b[live] = some - null @ (null.T @ some)
    return b


class Spectrum:
    """The matrix of a block in its eigenbasis, which serves every penalty. Directions in which nothing varies, as
    the correlation matrix shows whatever the units, are left out: their part of a ridge fit is zero."""

    def __init__(self, block: Block):
        self.size, self.live = len(block.xy), np.flatnonzero(block.live)
        xx = block.xx[np.ix_(self.live, self.live)]
        scale = np.sqrt(np.diag(xx))
        basis = np.eye(len(self.live))
        if len(self.live):
            value, vector = np.linalg.eigh(xx / np.outer(scale, scale))
            none = value <= RANK * value[-1]
            if none.any():
                every, _ = np.linalg.qr(np.column_stack([vector[:, none] / scale[:, None], basis]))
                basis = every[:, none.sum():]
        value, vector = np.linalg.eigh(basis.T @ xx @ basis)
        self.value, self.vector = np.maximum(value, 0.0), basis @ vector
        self.along = self.vector.T @ block.xy[self.live]

    def fit(self, alpha: float) -> np.ndarray:
        b = np.zeros(self.size)
        b[self.live] = self.vector @ (self.along / (self.value + alpha))
        return b

    def degrees(self, alpha: float) -> float:
        """Effective degrees of freedom of the smoother, without the intercept."""
        return float((self.value / (self.value + alpha)).sum())


def fit_ridge(block: Block, alpha: float) -> np.ndarray:
    return Spectrum(block).fit(alpha)


@dataclass
class Knot:
    """A place of the lasso path where a feature enters or leaves; ``limit`` is n times the penalty there."""
    limit: float
    feature: int
    enters: bool


class Homotopy:
    """The lasso path over a Gram matrix, from the penalty at which nothing is left downwards. Between knots the
    solution is linear in the penalty; the inverse of the active part is extended by a border, or cut down, at each.

    A feature that the active ones span (which its part not explained by them shows) keeps its slope at the limit
    by itself, whatever they do, so it stays out until one of them leaves. Of features that reach the limit
    together, each enters in a step of its own.
    """

    def __init__(self, block: Block):
        self.xx, self.xy = block.xx, block.xy
        self.size = np.diag(block.xx)
        self.slope = block.xy.astype(float).copy()       # xy - xx b
        self.b = np.zeros(len(block.xy))
        self.active: list[int] = []
        self.sign = np.zeros(0)
        self.inverse = np.zeros((0, 0))
        self.spanned: set[int] = set()
        self.live = block.live.copy()
        self.limit = float(np.abs(self.slope[self.live]).max(initial=0.0))
        self.last = -1                                   # what has just left
        self.still = 0

    def _enter(self, j: int) -> bool:
        a = self.active
        g = self.xx[a, j]
        u = self.inverse @ g
        u += self.inverse @ (g - self.xx[np.ix_(a, a)] @ u)   # one step of refinement
        rest = self.size[j] - g @ u
        if rest <= RANK * self.size[j] * 10:
            self.spanned.add(j)
            return False
        k = len(a)
        out = np.empty((k + 1, k + 1))
        out[:k, :k] = self.inverse + np.outer(u, u) / rest
        out[:k, k] = out[k, :k] = -u / rest
        out[k, k] = 1 / rest
        self.inverse, self.active = out, a + [j]
        self.sign = np.append(self.sign, np.sign(self.slope[j]))
        return True

    def _leave(self, at: int) -> int:
        keep = [i for i in range(len(self.active)) if i != at]
        m = self.inverse
        self.inverse = m[np.ix_(keep, keep)] - np.outer(m[keep, at], m[at, keep]) / m[at, at]
        j = self.active.pop(at)
        self.sign = np.delete(self.sign, at)
        self.b[j] = 0.0
        self.spanned.clear()
        return j

    def knots(self, until: float):
        """The knots down to a limit, one by one; after the last one ``b`` is the solution at ``until``. What is
        asked for next must not be larger."""
        while self.limit > until:
            a = self.active
            way = self.inverse @ self.sign
            if a:
                way += self.inverse @ (self.sign - self.xx[np.ix_(a, a)] @ way)
            rate = self.xx[:, a] @ way if a else np.zeros(len(self.xy))
            step, event, which = self.limit - until, None, None
            out = self.live.copy()
            out[a] = False
            if self.spanned:
                out[list(self.spanned)] = False
            others = np.flatnonzero(out)
            for side in (1.0, -1.0):
                closing = 1 - side * rate[others]
                gap = self.limit - side * self.slope[others]
                # what has just left is on its limit, and moves away from it
                may = (closing > 1e-12) & ((others != self.last) | (gap > 1e-9 * self.limit))
                if may.any():
                    reach = np.maximum(gap[may] / closing[may], 0.0)
                    if reach.min() < step:
                        step, event, which = float(reach.min()), True, int(others[may][reach.argmin()])
            for i, j in enumerate(a):
                if way[i] * self.sign[i] < 0 and -self.b[j] / way[i] < step:
                    step, event, which = max(-self.b[j] / way[i], 0.0), False, i
            if a:
                self.b[a] += step * way
                self.slope = self.xy - self.xx[:, a] @ self.b[a]
            self.limit -= step
            self.still = self.still + 1 if step <= 0 else 0
            if self.still > 4 * len(self.xy) + 10:
                raise ArithmeticError("the lasso path does not move on")
            self.last = -1
            if event is True:
                if self._enter(which):
                    yield Knot(self.limit, which, True)
            elif event is False:
                self.last = self._leave(which)
                yield Knot(self.limit, self.last, False)
            else:
                self.limit = until


def lasso_path(block: Block, alphas) -> dict[float, np.ndarray]:
    """The lasso at every penalty, from one walk along the path. At each the active part is solved once more and the
    optimality conditions are checked; coordinate descent goes on from there where rounding has broken them."""
    out, path = {}, Homotopy(block)
    for alpha in sorted(alphas, reverse=True):
        limit = alpha * block.n
        try:
            for _ in path.knots(limit):
                pass
            start = path.b.copy()
        except ArithmeticError:
            start = None
        exact = _active_set(block, limit, start) if start is not None else None
        if exact is None and start is not None and _gap(block, limit, start, block.xy - block.xx @ start) <= GAP * block.yy:
            exact = start
        out[alpha] = exact + 0.0 if exact is not None else fit_lasso(block, alpha, start)
    return out


def fit_lasso(block: Block, alpha: float, start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent on the Gram matrix, finished by solving the active set exactly.

    Where collinear features leave no unique active set, the duality gap decides instead.
    Features so nearly collinear that neither is reached are an error, not a rough answer.
    """
    xx, xy, limit = block.xx, block.xy, alpha * block.n
    size = np.diag(xx)
    live = np.flatnonzero(block.live)
    b = np.zeros(len(xy)) if start is None else np.where(block.live, start, 0.0)
    left = xy - xx @ b
    every = True
    for sweep in range(SWEEPS):
        step = 0.0
        # Most sweeps go over the active features only; the others are checked now and then.
        for j in live if every else live[b[live] != 0]:
            old = b[j]
            rho = left[j] + size[j] * old
            new = 0.0
            if rho > limit:
                new = (rho - limit) / size[j]
            elif rho < -limit:
                new = (rho + limit) / size[j]
            if new != old:
                left -= xx[j] * (new - old)
                b[j] = new
                step = max(step, (new - old) ** 2 * size[j])
        settled = step <= 1e-26 * block.yy
        if settled or sweep % 10 == 9:
            exact = _active_set(block, limit, b)
            if exact is not None:
                return exact
            if _gap(block, limit, b, left) <= GAP * block.yy or (settled and every):
                break
        every = settled or sweep % 10 == 9
    else:
        raise ArithmeticError(f"the lasso with penalty {alpha:g} has not converged in {SWEEPS} "
                              "sweeps: features are nearly collinear; drop some or use ridge")
    return b + 0.0


def _gap(block: Block, limit: float, b: np.ndarray, left: np.ndarray) -> float:
    """Duality gap of a lasso solution, times n; `left` is X'(y - Xb)."""
    residual = max(block.yy - b @ (block.xy + left), 0.0)
    along = block.yy - b @ block.xy
    steepest = np.abs(left).max(initial=0.0)
    scale = 1.0 if steepest <= limit else limit / steepest
    return (residual * (1 + scale ** 2) / 2 + limit * np.abs(b).sum() - scale * along)


def _active_set(block: Block, limit: float, b: np.ndarray) -> np.ndarray | None:
    """The exact solution with the signs of `b`, or None if those signs are not optimal."""
    active = np.flatnonzero(b)
    sign = np.sign(b[active])
    out = np.zeros_like(b)
    if len(active):
        try:
            value = np.linalg.solve(block.xx[np.ix_(active, active)],
                                    block.xy[active] - limit * sign)
        except np.linalg.LinAlgError:
            return None
        if not np.all(np.sign(value) == sign):
            return None
        out[active] = value
    slack = np.abs(block.xy - block.xx[:, active] @ out[active])
    allowed = limit + 1e-9 * np.sqrt(np.diag(block.xx) * max(block.yy, 0.0))
    return out if np.all(slack <= allowed) else None


def fit(method: str, block: Block, alpha: float | None) -> np.ndarray:
    if method == LINEAR:
        return fit_linear(block)
    return fit_ridge(block, alpha) if method == RIDGE else lasso_path(block, [alpha])[alpha]


def fit_all(method: str, block: Block, alphas) -> dict[float, np.ndarray]:
    """The fits of all penalties: one path, or one spectrum, for them together."""
    if method == RIDGE:
        spectrum = Spectrum(block)
        return {a: spectrum.fit(a) for a in alphas}
    return lasso_path(block, alphas)


def cross_validate(method: str, folds: np.ndarray, alphas) -> list[tuple]:
    """(alpha, fold, mse, r2) for every penalty and held-out fold."""
    total, cells = folds.sum(axis=0), []
    for f, held_out in enumerate(folds):
        train = Block.of(total - held_out)
        fits = fit_all(method, train, alphas)
        test_n, test_total = held_out[0, 0], held_out[0, -1]
        if test_n <= 0:
            raise ValueError("a cross-validation fold has no rows")
        sst = held_out[-1, -1] - test_total ** 2 / test_n
        for alpha in sorted(alphas, reverse=True):
            b = fits[alpha]
            sse = squared_error(held_out, b, train.intercept(b))
            cells.append((float(alpha), f, sse / test_n,
                          ratio(sst if sst > CONSTANT * held_out[-1, -1] else 0.0, sse)))
    return cells


def best_alpha(method: str, cells: list[tuple], alphas) -> float:
    """Lasso: lowest mean held-out MSE, the larger penalty on a tie. Ridge: highest mean
    held-out R^2, the one listed first on a tie."""
    def mean(alpha, at):
        return float(np.mean([c[at] for c in cells if c[0] == alpha]))
    if method == LASSO:
        return min(sorted(alphas, reverse=True), key=lambda a: mean(a, 2))
    return max(alphas, key=lambda a: mean(a, 3))


def solve_one(method: str, folds: np.ndarray, alphas) -> dict:
    """Pick the penalty, refit on the whole resample; `folds` is (k x q x q)."""
    total = Block.of(folds.sum(axis=0))
    cells, alpha = [], None
    if method != LINEAR:
        alphas = [float(a) for a in alphas]
        cells = cross_validate(method, folds, alphas)
        alpha = best_alpha(method, cells, alphas)
    b = fit(method, total, alpha)
    return {"alpha": alpha, "coef": b, "intercept": total.intercept(b), "r2": total.r2(b),
            "mse_min": min(c[2] for c in cells) if cells else None, "n": total.n, "path": cells}


def _by_seed(moments: DataFrame, n_seeds: int, solve, schema: str) -> DataFrame:
    """``solve(key, table)`` for the moments of each seed."""
    # A stated number of tasks: by size alone the tiny moment table would end in one task.
    tasks = max(1, min(n_seeds, 2 * moments.sparkSession.sparkContext.defaultParallelism))
    return moments.repartition(tasks, "seed").groupBy("seed").applyInArrow(solve, schema)


def whole_blocks(moments: DataFrame, columns: list[str], models: dict, n_seeds: int, rows, schema: pa.Schema,
                 ddl: str) -> DataFrame:
    """``rows(block, features, alphas)`` as dictionaries for each model's moments of each whole resample, with
    ``model`` and ``seed``."""
    q = len(columns) + 1
    place = {c: i for i, c in enumerate(columns, start=1)}

    def solve(key, table):
        block = table.to_pandas()
        gram = sum(unpack(part, q) for _, part in block.groupby("fold"))
        out = []
        for name, (_, features, alphas) in models.items():
            at = [0] + [place[f] for f in features] + [q - 1]
            out += [{"model": name, "seed": key[0].as_py(), **row}
                    for row in rows(Block.of(gram[np.ix_(at, at)]), features, alphas)]
        return pa.Table.from_pylist(out, schema)

    return _by_seed(moments, n_seeds, solve, ddl)


def ridge_degrees(moments: DataFrame, columns: list[str], models: dict, n_seeds: int) -> DataFrame:
    """(model, seed, alpha, df): effective degrees of freedom of each ridge model at each of its penalties."""
    def rows(block, features, alphas):
        spectrum = Spectrum(block)
        return [{"alpha": float(a), "df": spectrum.degrees(a)} for a in alphas]

    schema = pa.schema([("model", pa.string()), ("seed", pa.int64()), ("alpha", pa.float64()), ("df", pa.float64())])
    own = {name: m for name, m in models.items() if m[0] == RIDGE}
    return whole_blocks(moments, columns, own, n_seeds, rows, schema, "model string, seed long, alpha double, df double")


def lasso_knots(moments: DataFrame, columns: list[str], models: dict, n_seeds: int) -> DataFrame:
    """(model, seed, knot, alpha, feature, enters): the penalties at which the lasso's set of features changes, from
    the largest down to the smallest penalty of each model."""
    def rows(block, features, alphas):
        path = Homotopy(block).knots(min(alphas) * block.n)
        return [{"knot": i, "alpha": k.limit / block.n, "feature": features[k.feature], "enters": k.enters}
                for i, k in enumerate(path, 1)]

    schema = pa.schema([("model", pa.string()), ("seed", pa.int64()), ("knot", pa.int32()), ("alpha", pa.float64()),
                        ("feature", pa.string()), ("enters", pa.bool_())])
    own = {name: m for name, m in models.items() if m[0] == LASSO}
    return whole_blocks(moments, columns, own, n_seeds, rows, schema,
                        "model string, seed long, knot int, alpha double, feature string, enters boolean")


def solve_replicates(moments: DataFrame, columns: list[str], centres: list[float],
                     models: dict[str, tuple[str, list[str], tuple]], n_seeds: int) -> DataFrame:
    """One row per (model, seed). `models` maps a name to (method, features, alphas); the
    target is the last of `columns`."""
    q = len(columns) + 1
    place = {c: i for i, c in enumerate(columns, start=1)}
    centre = dict(zip(columns, centres))

    def solve(key, table):
        block = table.to_pandas()
        folds = np.stack([unpack(part, q) for _, part in block.groupby("fold", sort=True)])
        out = []
        for name, (method, features, alphas) in models.items():
            at = [0] + [place[f] for f in features] + [q - 1]
            got = solve_one(method, folds[:, at][:, :, at], alphas)
            shift = centre[columns[-1]] - sum(centre[f] * b for f, b in zip(features, got["coef"]))
            out.append({
                "model": name, "seed": key[0].as_py(), "alpha": got["alpha"],
                "mse_min": got["mse_min"], "r2": got["r2"], "coef": got["coef"] + 0.0,
                "intercept": float(got["intercept"] + shift), "column_names": features,
                "n": got["n"], "path": [dict(zip(_CELL.names, c)) for c in got["path"]]})
        return pa.Table.from_pylist(out, _SOLVED)

    return _by_seed(moments, n_seeds, solve, SOLVED)
