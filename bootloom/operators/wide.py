"""Fits of models too wide for one task to hold a seed's Gram matrix.

The matrices stay where they are, in tiles. A seed is a row of vectors; what it asks for is the product of its
matrices with some of them, or the entries of some features. Tiles answer in parallel, one job for all seeds of a
round, and a step per seed goes on with the answers:

* least squares and ridge by conjugate gradients, one product a round for all training sets and penalties;
* lasso by working sets: the entries of the features in play are gathered, the lasso on them is solved exactly, and a
  product with the solution shows which other features break the optimality conditions. They join, until none does.

Held-out errors of cross-validation are products too: v' G v for v = (-intercept, -coefficients, 1).
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.scratch import staged
from .solve import CONSTANT, LASSO, LINEAR, _CELL, _SOLVED, SOLVED, Block, best_alpha, lasso_path, ratio

# Features that may be in play at once for one seed: their entries are what one task holds, k + 1 times.
IN_PLAY = 3000
# Features that join for one problem in a round, at most and at first.
JOIN = 128
# Where conjugate gradients end, as a share of the first residual; what is good enough where rounding allows no more.
RESIDUAL, SETTLED = 1e-12, 1e-6
PATIENCE = 60
# Bytes that all seeds ask with in a round up to which they are sent to the tiles; beyond it the tiles are shuffled.
SENT_BYTES = 16 << 20

STATE = "seed long, state binary, r int, v binary, wanted array<int>, busy boolean"
_STATE = pa.schema([("seed", pa.int64()), ("state", pa.binary()), ("r", pa.int32()), ("v", pa.binary()),
                    ("wanted", pa.list_(pa.int32())), ("busy", pa.bool_())])
ANSWER = "seed long, c1 int, c2 int, y1 binary, y2 binary, part binary, diag binary"
_ANSWER = pa.schema([("seed", pa.int64()), ("c1", pa.int32()), ("c2", pa.int32()), ("y1", pa.binary()),
                     ("y2", pa.binary()), ("part", pa.binary()), ("diag", pa.binary())])


# ------------------------------------------------------------------ tiles

def answers(tiles: DataFrame, state: DataFrame, k: int, tile: int, asked_bytes: int | None = None) -> DataFrame:
    """What each tile adds to what its seed asked for: products with ``v`` from either side, the entries of
    ``wanted``, and the diagonal. Little that is asked, ``asked_bytes``, goes to the tiles where they are."""
    questions = state.where("busy").select("seed", "r", "v", "wanted")
    few = asked_bytes is not None and asked_bytes <= SENT_BYTES
    asked = tiles.join(F.broadcast(questions) if few else questions, "seed")

    def work(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                a, b, r = (row[c].as_py() for c in ("c1", "c2", "r"))
                g = np.frombuffer(row["g"].as_buffer()).reshape(k, tile, tile)
                v = np.frombuffer(row["v"].as_buffer()).reshape(-1, r)
                one, two = (v[c * tile:(c + 1) * tile] for c in (a, b))
                wanted = np.array(row["wanted"].as_py(), np.int64)
                i, j = (wanted[wanted // tile == c] % tile for c in (a, b))
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((
                    row["seed"].as_py(), a, b, (g @ two).tobytes(),
                    (g.transpose(0, 2, 1) @ one).tobytes() if a != b else None,
                    np.ascontiguousarray(g[:, i][:, :, j]).tobytes(),
                    np.ascontiguousarray(np.diagonal(g, axis1=1, axis2=2)).tobytes() if a == b else None), _ANSWER)],
                    schema=_ANSWER)

    return asked.select("seed", "c1", "c2", "g", "r", "v", "wanted").mapInArrow(work, ANSWER)


def _assembled(table: pa.Table, blocks: int, k: int, tile: int, r: int, wanted: np.ndarray):
    """(products, diagonal, entries of ``wanted``) of a seed's matrices from the answers of its tiles."""
    y = np.zeros((k, blocks * tile, r))
    diag = np.zeros((k, blocks * tile))
    part = np.zeros((k, len(wanted), len(wanted)))
    for row in table.to_pylist():
        a, b = row["c1"], row["c2"]
        one, two = slice(a * tile, (a + 1) * tile), slice(b * tile, (b + 1) * tile)
        y[:, one] += np.frombuffer(row["y1"]).reshape(k, tile, r)
        i, j = (np.flatnonzero(wanted // tile == c) for c in (a, b))
        piece = np.frombuffer(row["part"]).reshape(k, len(i), len(j))
        part[:, i[:, None], j] = piece
        if a != b:
            y[:, two] += np.frombuffer(row["y2"]).reshape(k, tile, r)
            part[:, j[:, None], i] = piece.transpose(0, 2, 1)
        else:
            diag[:, one] = np.frombuffer(row["diag"]).reshape(k, tile)
    return y, diag, part


# ------------------------------------------------------------------ one seed

class Seed:
    """The problems of one seed and where they stand. ``ask`` and ``answer`` alternate."""

    def __init__(self, q: int, size: int, k: int, models: dict, join: int, in_play: int):
        """``models``: name -> (method, columns of its features, penalties), columns of z = (1, features, target)."""
        self.q, self.size, self.k, self.models, self.join, self.in_play = q, size, k, models, join, in_play
        self.phase = "moments"
        self.problems = [(name, t, a) for name, (method, _, alphas) in models.items()
                         for t in ([k] if method == LINEAR else range(k + 1))
                         for a in ([None] if method == LINEAR else sorted(map(float, alphas), reverse=True))]
        self.wanted = np.zeros(0, np.int64)

    # -------- what to ask for

    def ask(self) -> tuple[np.ndarray, np.ndarray]:
        """(vectors as columns, columns whose entries are wanted)."""
        none = np.zeros(0, np.int64)
        if self.phase == "moments":
            v = np.zeros((self.size, 2))
            v[0, 0] = v[self.q - 1, 1] = 1.0
            return v, none
        if self.phase == "gradients":
            return self.p[:, self.open], none
        if self.phase == "entries":
            return np.zeros((self.size, 1)), self.wanted
        if self.phase == "conditions":
            return self.b[:, self.lasso], none
        v = -self.b
        v[0] = -self.intercepts()
        v[self.q - 1] = 1.0
        return v, none

    def answer(self, y: np.ndarray, diag: np.ndarray, part: np.ndarray) -> None:
        getattr(self, "_" + self.phase)(y, diag, part)

    def training(self, x: np.ndarray, t: int) -> np.ndarray:
        """The sum over a training set of what is given by fold: all but fold t, or all."""
        return x.sum(axis=0) - (x[t] if t < self.k else 0.0)

    def times(self, y: np.ndarray, v: np.ndarray, t: int) -> np.ndarray:
        """The centred matrix of a training set times v, from products by fold."""
        return self.training(y, t) - self.sums[t] * (self.sums[t] @ v / self.n[t])

    # -------- phases

    def _moments(self, y, diag, part):
        q, every = self.q, range(self.k + 1)
        if (y[:, 0, 0] <= 0).any() or (self.training(y, self.k)[0, 0] <= 0):
            raise ValueError("a resample or one of its folds has no rows")
        self.fold_n, self.fold_y, self.fold_yy = y[:, 0, 0], y[:, q - 1, 0], y[:, q - 1, 1]
        self.sums = np.stack([self.training(y, t)[:, 0] for t in every])
        self.n = self.sums[:, 0].copy()
        used = sorted({t for _, t, _ in self.problems})
        if (self.n[used] <= 0).any():
            raise ValueError("a training set has no rows")
        self.n[self.n <= 0] = 1.0   # of no use where there is one fold only
        raw = np.stack([self.training(diag, t) for t in every])
        self.square = raw - self.sums ** 2 / self.n[:, None]
        self.live = self.square > CONSTANT * raw
        self.live[:, [0, q - 1]] = False
        self.live[:, q:] = False
        self.square = np.where(self.live, self.square, 0.0)
        self.yy = np.array([self.training(self.fold_yy, t) - self.sums[t, q - 1] ** 2 / self.n[t] for t in every])
        self.xy = np.stack([self.training(y, t)[:, 1] - self.sums[t] * self.sums[t, q - 1] / self.n[t] for t in every])
        self.b = np.zeros((self.size, len(self.problems)))
        self.inside = np.zeros(self.b.shape, bool)
        for c, (name, t, _) in enumerate(self.problems):
            self.inside[self.models[name][1], c] = True
            self.inside[:, c] &= self.live[t]
        kind = [self.models[name][0] for name, _, _ in self.problems]
        self.lasso = [c for c, m in enumerate(kind) if m == LASSO]
        self.open = [c for c, m in enumerate(kind) if m != LASSO]
        self._start_gradients()

    def _start_gradients(self):
        self.shift = np.array([0.0 if a is None else a for _, _, a in self.problems])
        self.scale = np.zeros(self.b.shape)
        self.res = np.zeros(self.b.shape)
        for c, (_, t, _) in enumerate(self.problems):
            d = self.square[t] + self.shift[c]
            self.scale[:, c] = np.where(self.inside[:, c], 1.0 / np.where(d > 0, d, 1.0), 0.0)
            self.res[:, c] = np.where(self.inside[:, c], self.xy[t], 0.0)
        self.p = self.scale * self.res
        self.rz = np.einsum("ij,ij->j", self.res, self.p)
        self.first, self.least, self.waited = self.rz.copy(), self.rz.copy(), np.zeros(len(self.problems), int)
        self.phase = "gradients"
        self._close()

    def _close(self):
        done = [c for c in self.open if self.rz[c] <= RESIDUAL ** 2 * self.first[c]]
        stuck = [c for c in self.open if c not in done and self.waited[c] >= PATIENCE]
        bad = [c for c in stuck if self.least[c] > SETTLED ** 2 * self.first[c]]
        if bad:
            raise ArithmeticError("conjugate gradients have come to a halt: features are nearly collinear; use ridge")
        self.open = [c for c in self.open if c not in done and c not in stuck]
        if not self.open:
            self._start_lasso()

    def _gradients(self, y, diag, part):
        for i, c in enumerate(self.open):
            t, p = self.problems[c][1], self.p[:, c]
            a = np.where(self.inside[:, c], self.times(y[:, :, i], p, t) + self.shift[c] * p, 0.0)
            curve = p @ a
            if curve <= 0:
                self.waited[c] = PATIENCE
                continue
            step = self.rz[c] / curve
            self.b[:, c] += step * p
            self.res[:, c] -= step * a
            z = self.scale[:, c] * self.res[:, c]
            rz = self.res[:, c] @ z
            self.p[:, c] = z + rz / self.rz[c] * p
            self.rz[c] = rz
            better = rz < 0.25 * self.least[c]
            self.waited[c] = 0 if better else self.waited[c] + 1
            self.least[c] = min(self.least[c], rz) if better else self.least[c]
        self._close()

    def _start_lasso(self):
        self.res = self.scale = self.p = None
        if not self.lasso:
            self.phase = "errors"
            return
        first = [self._worst(c, np.abs(self.xy[self.problems[c][1]])) for c in self.lasso]
        self.wanted = np.unique(np.concatenate(first))
        self.phase = "entries" if len(self.wanted) else "errors"

    def _limit(self, c: int) -> np.ndarray:
        t = self.problems[c][1]
        return self.problems[c][2] * self.n[t] * (1 + 1e-9) + 1e-9 * np.sqrt(self.square[t] * max(self.yy[t], 0.0))

    def _worst(self, c: int, slope: np.ndarray) -> np.ndarray:
        """Features whose slope exceeds the penalty the most."""
        over = np.where(self.inside[:, c], slope - self.problems[c][2] * self.n[self.problems[c][1]], -np.inf)
        at = np.argsort(-over)[:self.join]
        return at[over[at] > 0]

    def _entries(self, y, diag, part):
        """The lasso on the features in play, exactly."""
        at = self.wanted
        for c in self.lasso:
            name, t, alpha = self.problems[c]
            own = np.flatnonzero(self.inside[at, c])
            full = self.training(part, t)[np.ix_(own, own)]
            s, n = self.sums[t][at[own]], self.n[t]
            xx = full - np.outer(s, s) / n
            block = Block(n, s / n, 0.0, xx, self.xy[t][at[own]], self.yy[t], np.ones(len(own), bool))
            self.b[:, c] = 0.0
            self.b[at[own], c] = lasso_path(block, [alpha])[alpha]
        self.phase = "conditions"

    def _conditions(self, y, diag, part):
        join = []
        for i, c in enumerate(self.lasso):
            t = self.problems[c][1]
            slope = np.abs(self.xy[t] - self.times(y[:, :, i], self.b[:, c], t))
            breaks = self.inside[:, c] & (slope > self._limit(c))
            breaks[self.wanted] = False
            join.append(self._worst(c, np.where(breaks, slope, 0.0)))
        more = np.unique(np.concatenate(join))
        if not len(more):
            self.phase = "errors"
            return
        self.wanted = np.union1d(self.wanted, more)
        if len(self.wanted) > self.in_play:
            raise ArithmeticError(f"the lasso of a wide model has more than {self.in_play} features in play; use larger "
                                  "penalties or ridge")
        self.phase = "entries"

    def intercepts(self) -> np.ndarray:
        return np.array([(self.sums[t, self.q - 1] - self.sums[t] @ self.b[:, c]) / self.n[t]
                         for c, (_, t, _) in enumerate(self.problems)])

    def _errors(self, y, diag, part):
        q, v = self.q, self.ask()[0]
        self.sse = np.maximum(np.einsum("ic,kic->kc", v, y), 0.0)
        self.phase = "done"

    # -------- the answer

    def solved(self) -> list[dict]:
        """One dictionary per model: penalty, coefficients, scores, held-out errors by penalty and fold."""
        out = []
        for name, (method, columns, alphas) in self.models.items():
            cells, alphas = [], [float(a) for a in alphas]
            for c, (other, t, alpha) in enumerate(self.problems):
                if other == name and t < self.k:
                    n, total = self.fold_n[t], self.fold_y[t]
                    sst = self.fold_yy[t] - total ** 2 / n
                    sse = self.sse[t, c]
                    cells.append((alpha, t, sse / n, ratio(sst if sst > CONSTANT * self.fold_yy[t] else 0.0, sse)))
            cells.sort(key=lambda x: (x[1], -x[0]))
            alpha = best_alpha(method, cells, alphas) if cells else None
            c = self.problems.index((name, self.k, alpha))
            live = self.yy[self.k] > CONSTANT * self.fold_yy.sum()
            out.append({"model": name, "alpha": alpha, "mse_min": min((x[2] for x in cells), default=None),
                        "r2": ratio(self.yy[self.k] if live else 0.0, float(self.sse[:, c].sum())),
                        "coef": self.b[columns, c], "intercept": float(self.intercepts()[c]),
                        "n": float(self.n[self.k]), "path": cells})
        return out


# ------------------------------------------------------------------ all seeds

def _row(seed: int, state: Seed) -> pa.Table:
    busy = state.phase != "done"
    v, wanted = state.ask() if busy else (np.zeros((0, 1)), np.zeros(0, np.int64))
    values = (seed, pickle.dumps(state), v.shape[1], np.ascontiguousarray(v).tobytes(), wanted.tolist(), busy)
    return pa.table([pa.array([x], f.type) for x, f in zip(values, _STATE)], schema=_STATE)


def solve_wide(tiles: DataFrame, columns: list[str], centres: list[float],
               models: dict[str, tuple[str, list[str], tuple]], seeds: list[int], k: int, tile: int) -> DataFrame:
    """What `solve.solve_replicates` gives, from a table of `tiles.TILES`. Of several least squares solutions it is the
    shortest in units of the features' deviations (the narrow path: of the features themselves). A round is
    one job for all seeds that are not done."""
    q = len(columns) + 1
    blocks = -(-q // tile)
    place = {c: i for i, c in enumerate(columns, start=1)}
    centre = dict(zip(columns, centres))
    plan = {name: (method, np.array([place[f] for f in features]), alphas)
            for name, (method, features, alphas) in models.items()}
    tiles, limits = staged(tiles, "tiles", compression="none"), (JOIN, IN_PLAY)
    spark = tiles.sparkSession

    def begin(batches):
        for batch in batches:
            for seed in batch.column("seed").to_pylist():
                yield from _row(seed, Seed(q, blocks * tile, k, plan, *limits)).to_batches()

    def step(state: pa.Table, table: pa.Table) -> pa.Table:
        row = state.to_pylist()[0]
        if not row["busy"]:
            return state
        own = pickle.loads(row["state"])
        own.answer(*_assembled(table, blocks, k, tile, row["r"], np.array(row["wanted"], np.int64)))
        return _row(row["seed"], own)

    # as Arrow data: lists of rows would pass Python workers of another kind, which stay
    numbers = spark.createDataFrame(pa.table({"seed": pa.array(map(int, seeds), pa.int64())})).repartition(
        min(len(seeds), 2 * spark.sparkContext.defaultParallelism), "seed")
    state = staged(numbers.mapInArrow(begin, STATE), "state")
    while True:
        open_, size = state.where("busy").agg(
            F.count("*"), F.sum(F.length("v") + 4 * F.size("wanted"))).first()
        if not open_:
            break
        given = answers(tiles, state, k, tile, size)
        state = staged(state.groupBy("seed").cogroup(given.withColumnRenamed("seed", "of").groupBy("of"))
                       .applyInArrow(step, STATE), "state")

    def finish(batches):
        for batch in batches:
            for seed, raw in zip(batch.column("seed").to_pylist(), batch.column("state").to_pylist()):
                out = []
                for got in pickle.loads(raw).solved():
                    features = models[got["model"]][1]
                    shift = centre[columns[-1]] - sum(centre[f] * b for f, b in zip(features, got["coef"]))
                    out.append(got | {
                        "seed": seed, "coef": got["coef"] + 0.0, "intercept": got["intercept"] + shift,
                        "column_names": features, "path": [dict(zip(_CELL.names, c)) for c in got["path"]]})
                yield from pa.Table.from_pylist(out, _SOLVED).to_batches()

    return state.mapInArrow(finish, SOLVED)
