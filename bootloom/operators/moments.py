"""Weighted moments of the resamples: everything the fits need, in one pass.

With z = (1, features, target) about the overall column means, each (seed, fold) is reduced
to its Gram matrix ``sum w z z'``. Training moments of a cross-validation fold are total
minus fold, so all penalties, folds, refits and in-sample scores come from this one table.

The table is long: (seed, fold, i, j0, g0, g1, ...) holds G[i, j0], G[i, j0 + 1], ... in up
to BLOCK plain double columns, which keeps the partial sums in Spark's hash aggregate for
models of any width. Blocks wholly below the diagonal are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.frames import ROW_ID, FrameStats, packed, unpacked
from .resample import POISSON, bundles, cell_size, poisson_array_weights, unbundled, with_draws

BLOCK = 64
# Up to this many columns the products z_i z_j are laid out once and all weights are applied
# by one matrix product; beyond it the rows of each resample are gathered instead.
NARROW = 16
# Products laid out at once, in values.
SLAB = 1 << 23
# Bytes of partial Gram matrices a task may hold; wider models take their seeds in batches.
PARTIAL_BYTES = 256 << 20


def block_width(columns: int) -> int:
    return min(BLOCK, columns + 1)


def _schema(columns: int) -> str:
    return "seed long, fold int, i int, j0 int, " + ", ".join(
        f"g{b} double" for b in range(block_width(columns)))


def design(x: np.ndarray, centres: list[float]) -> np.ndarray:
    """(rows x (1 + columns)) array: ones, then each column about its centre."""
    return np.column_stack([np.ones(len(x)), x - np.asarray(centres)])


class _Grams:
    """Gram matrices of one block of rows under many weight vectors."""

    def __init__(self, z: np.ndarray):
        self.z, self.q = z, z.shape[1]
        self.upper = np.triu_indices(self.q)
        self.slab = max(1, SLAB // len(self.upper[0]))
        self.all = self._products(slice(None)) if self.q <= NARROW and len(z) <= self.slab else None

    def _products(self, rows: slice) -> np.ndarray:
        z = self.z[rows]
        return z[:, self.upper[0]] * z[:, self.upper[1]]

    def under(self, w: np.ndarray) -> np.ndarray:
        """(weights x rows) -> (weights x q x q)."""
        out = np.zeros((len(w), self.q, self.q))
        if self.q <= NARROW:
            flat = np.zeros((len(w), len(self.upper[0])))
            for lo in range(0, len(self.z), self.slab):
                rows = slice(lo, lo + self.slab)
                products = self._products(rows) if self.all is None else self.all
                flat += w[:, rows].astype(np.float64) @ products
            out[:, self.upper[0], self.upper[1]] = flat
            out[:, self.upper[1], self.upper[0]] = flat
        else:
            for b, weight in enumerate(w):
                hit = np.flatnonzero(weight)
                for lo in range(0, len(hit), self.slab):
                    at = hit[lo:lo + self.slab]
                    part = self.z[at]
                    out[b] += (part * weight[at, None]).T @ part
        return out


def _long(seeds: np.ndarray, grams: np.ndarray) -> pa.Table:
    """(seeds x folds x q x q) -> the long block layout, without blocks below the diagonal."""
    s, k, q, _ = grams.shape
    width = block_width(q - 1)
    blocks = -(-q // width)
    padded = np.zeros((s, k, q, blocks * width))
    padded[..., :q] = grams
    i, j = np.nonzero((np.arange(blocks) + 1) * width > np.arange(q)[:, None])
    cells = padded.reshape(s, k, q, blocks, width)[:, :, i, j].reshape(-1, width)
    arrays = [np.repeat(np.asarray(seeds, dtype=np.int64), k * len(i)),
              np.tile(np.repeat(np.arange(k, dtype=np.int32), len(i)), s),
              np.tile(i.astype(np.int32), s * k), np.tile((j * width).astype(np.int32), s * k)]
    names = ["seed", "fold", "i", "j0"] + [f"g{b}" for b in range(width)]
    return pa.table(arrays + list(np.ascontiguousarray(cells.T)), names=names)


def moments(df: DataFrame, stats: FrameStats, columns: list[str], seeds: list[int], k: int,
            sampling: str, row_id: str = ROW_ID) -> DataFrame:
    """The moment table of every (seed, fold) over `columns` (features, then target).

    All seeds go in one pass over the data unless the Gram matrices of that many would not
    fit in a task. Then the rows are still shuffled once: they are written with their draws, and a
    task takes its share of them through the seeds in batches. Poisson weights, which move no
    rows, go over the table once for each batch.
    """
    centres = stats.centres(columns)
    at_once = max(1, PARTIAL_BYTES // (k * (len(columns) + 1) ** 2 * 8))
    batches = [seeds[s:s + at_once] for s in range(0, len(seeds), at_once)]
    if sampling == POISSON:
        partial = None
        for batch in batches:
            part = _poisson_partials(df, columns, centres, batch, k, row_id)
            partial = part if partial is None else partial.unionByName(part)
    elif len(batches) == 1:
        partial = _drawn_partials(df, stats, columns, centres, seeds, k, sampling, row_id)
    else:
        partial = _bundled_partials(df, stats, columns, centres, batches, k, sampling, row_id)
    return partial.groupBy("seed", "fold", "i", "j0").agg(
        *[F.sum(f"g{b}").alias(f"g{b}") for b in range(block_width(len(columns)))])


def _drawn_partials(df, stats, columns, centres, seeds, k, sampling, row_id) -> DataFrame:
    """Partial Gram matrices per bucket of rows."""
    def reduce(ids, x, weights) -> pa.Table:
        grams = _Grams(design(x, centres))
        parts = []
        for chunk, w in weights:
            g = grams.under(w.reshape(-1, len(ids)))
            parts.append(_long(chunk, g.reshape(len(chunk), k, grams.q, grams.q)))
        return pa.concat_tables(parts)

    return with_draws(df, stats, columns, seeds, k, sampling, reduce, _schema(len(columns)), row_id)


def _bundled_partials(df, stats, columns, centres, batches, k, sampling, row_id) -> DataFrame:
    """Partial Gram matrices per task, a batch of seeds at a time. A task keeps its share of the
    written table, which is a file split."""
    m, n, size = len(columns), stats.n, cell_size(stats.n)

    def reduce(share):
        share = [b for b in share if b.num_rows]
        for seeds in batches if share else []:
            place = {s: i for i, s in enumerate(seeds)}
            total = np.zeros((len(seeds), k, m + 1, m + 1))
            for batch in share:
                for x, weights in unbundled(batch, m, n, k, size, sampling, seeds):
                    grams = _Grams(design(x, centres))
                    for chunk, w in weights:
                        total[[place[s] for s in chunk]] += grams.under(
                            w.reshape(-1, len(x))).reshape(len(chunk), k, m + 1, m + 1)
            yield from _long(seeds, total).to_batches(max_chunksize=1 << 14)

    every = [s for batch in batches for s in batch]
    return bundles(df, stats, columns, every, k, sampling, row_id).mapInArrow(reduce, _schema(m))


def _poisson_partials(df, columns, centres, seeds, k, row_id) -> DataFrame:
    """Partial Gram matrices per task, without moving a row."""
    q = len(columns) + 1

    def reduce(batches):
        total = np.zeros((len(seeds), k, q, q))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            grams = _Grams(design(unpacked(batch, len(columns)), centres))
            ids = batch.column(row_id).to_numpy()
            done = 0
            for chunk, w in poisson_array_weights(ids, seeds, k):
                total[done:done + len(chunk)] += grams.under(
                    w.reshape(-1, batch.num_rows)).reshape(len(chunk), k, q, q)
                done += len(chunk)
        yield from _long(seeds, total).to_batches(max_chunksize=1 << 14)

    return df.select(F.col(row_id).cast("long").alias(row_id), *packed(columns)).mapInArrow(reduce, _schema(len(columns)))


def plain_moments(df: DataFrame, columns: list[str], centres: list[float]) -> np.ndarray:
    """The (q x q) Gram matrix of a table as it stands (every weight 1), on the driver: its
    size depends on the number of columns only."""
    q = len(columns) + 1
    schema = _schema(len(columns))

    def reduce(batches):
        total = np.zeros((1, 1, q, q))
        for batch in batches:
            z = design(unpacked(batch, len(columns)), centres)
            total[0, 0] += z.T @ z
        yield from _long(np.zeros(1), total).to_batches(max_chunksize=1 << 14)

    width = block_width(len(columns))
    table = df.select(*packed(columns)).mapInArrow(reduce, schema).groupBy("i", "j0").agg(
        *[F.sum(f"g{b}").alias(f"g{b}") for b in range(width)]).toPandas()
    return unpack(table, q)


def unpack(block, q: int) -> np.ndarray:
    """Gram matrix from the long layout of one (seed, fold), given as a pandas frame."""
    names = [c for c in block.columns if c[0] == "g"]
    out = np.zeros((q, -(-q // len(names)), len(names)))
    out[block["i"].to_numpy(), block["j0"].to_numpy() // len(names)] = block[names].to_numpy()
    upper = np.triu(out.reshape(q, -1)[:, :q])
    return upper + np.triu(upper, 1).T
