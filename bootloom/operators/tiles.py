"""Gram matrices of wide models, in two-dimensional tiles that live in different tasks.

The columns z = (1, features, target) are cut into blocks. A tile is the part of the Gram matrices of all seeds
and folds that one pair of blocks spans. Rows are cut into the same blocks before they are shuffled. A few
neighbouring blocks are a stripe; a task holds two stripes of a bucket of rows and the tiles they span, as many as
fit: nothing in it grows with the number of columns. Where all tiles fit, rows of many bytes are neither written nor
cut: their weights come to them by id.

Sparse rows (indices and values, as one-hot levels make them) only touch the pairs of columns that are both
there. Their task keeps its share of the rows and takes it through as many tiles and seeds at a time as fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.memory import give_back, read_ahead
from ..functions.scratch import is_dealt, staged
from ..sources.frames import ROW_ID, FrameStats, packed, unpacked
from .index import BUCKET
from .moments import BLOCK, PARTIAL_BYTES, design
from .resample import (MAX_TASKS, MIN_CELL, POISSON, bucketed_draws, bundle_bytes, bundle_draws, cell_size,
                       poisson_array_weights, row_weights, unbundle_draws, weigh)

# Columns of a tile, bytes of one block of columns of a bucket of rows, and blocks of a stripe at most.
TILE = 512
ROWS_BYTES = 8 << 20
STRIPE = 8
# Bytes of all rows up to which they are written in blocks though a task can hold all tiles, and rows of such a task
# that are multiplied at once.
BLOCKED_BYTES = 32 << 20
ROWS_AT_ONCE = 1024
# Arrow batches that are read while such a task multiplies.
AHEAD = 12
# Pairs of entries of sparse rows that are laid out at once.
PAIRS_AT_ONCE = 1 << 21


TILES = "seed long, c1 int, c2 int, g binary"
_TILES = pa.schema([("seed", pa.int64()), ("c1", pa.int32()), ("c2", pa.int32()), ("g", pa.binary())])


def block_count(q: int, tile: int) -> int:
    return -(-q // tile)


def _tiles(seeds, total: np.ndarray, at: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(seeds x folds x tile x tile) of the blocks ``at``, a row of ``TILES`` per seed."""
    for seed, own in zip(seeds, total):
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
            (int(seed), int(at[0]), int(at[1]), np.ascontiguousarray(own).tobytes()), _TILES)], schema=_TILES)


def _summed(parts: DataFrame) -> DataFrame:
    """One row per tile; a task adds up the parts of a tile as they come."""
    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in parts:
            for at in range(batch.num_rows):
                g = np.frombuffer(batch.column("g")[at].as_buffer())
                if total is None:
                    key, total = [batch.column(c)[at].as_py() for c in ("seed", "c1", "c2")], g.copy()
                else:
                    total += g
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
            (*key, total.tobytes()), _TILES)], schema=_TILES)

    return parts.groupBy("seed", "c1", "c2").applyInArrow(add, TILES)


def as_moments(tiles: DataFrame, k: int, tile: int) -> DataFrame:
    """The long layout of `moments.moments`: a row per column i and up to BLOCK columns from j0 on, without those
    wholly below the diagonal or wholly zero."""
    width = min(BLOCK, tile)
    names = [f"g{b}" for b in range(width)]

    def rows(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                seed, c1, c2 = (batch.column(c)[at].as_py() for c in ("seed", "c1", "c2"))
                cells = np.frombuffer(batch.column("g")[at].as_buffer()).reshape(k, tile, tile // width, width)
                i = np.arange(tile)[:, None] + c1 * tile
                j = np.arange(tile // width) * width + c2 * tile
                one, two = np.nonzero((j + width > i) & (cells != 0).any(axis=(0, 3)))
                flat = np.ascontiguousarray(cells[:, one, two].reshape(-1, width).T)
                yield from pa.table(
                    [np.full(k * len(one), seed), np.repeat(np.arange(k, dtype=np.int32), len(one)),
                     np.tile(i[one, 0].astype(np.int32), k), np.tile(j[two].astype(np.int32), k), *flat],
                    names=["seed", "fold", "i", "j0", *names]).to_batches(1 << 14)

    return tiles.mapInArrow(rows, "seed long, fold int, i int, j0 int, " + ", ".join(f"{g} double" for g in names))


# ------------------------------------------------------------------ dense rows

def striped(blocks: int, seeds: int, k: int, tile: int) -> tuple[int, int]:
    """(blocks of a stripe, seeds of a batch) whose tiles a task can hold and that send the rows to the fewest tasks:
    a block of rows goes to each pair of stripes and each batch of seeds that it has a part in."""
    room = max(1, PARTIAL_BYTES // (k * tile * tile * 8))
    ways = []
    for side in range(1, min(blocks, STRIPE) + 1):
        spanned = side * side if side < blocks else side * (side + 1) // 2
        if spanned <= room or side == 1:
            at_once = min(max(1, room // spanned), seeds)
            ways.append((-(-blocks // side) * -(-seeds // at_once), side, at_once))
    return min(ways)[1:]


def dense_tiles(df: DataFrame, stats: FrameStats, columns: list[str], seeds: list[int], k: int, sampling: str,
                row_id: str = ROW_ID, tile: int = TILE) -> DataFrame:
    """The tiles of the Gram matrices of `moments.moments`, ``TILES``. A row is shuffled once in blocks of columns; after that
    a block goes to every pair of stripes it is in, so that it meets every other one of its bucket. Where there is one
    pair for all seeds, rows of more than ``BLOCKED_BYTES`` are multiplied where they are."""
    spark, m, n, size = df.sparkSession, len(columns), stats.n, cell_size(stats.n)
    q = m + 1
    blocks = block_count(q, tile)
    side, at_once = striped(blocks, len(seeds), k, tile)
    if side == blocks and at_once == len(seeds) and n * blocks * tile * 8 > BLOCKED_BYTES:
        return _tiles_in_place(df, stats, columns, seeds, k, sampling, row_id, tile)
    centres = stats.centres(columns)
    goal = max(MIN_CELL // 2, ROWS_BYTES // (8 * tile))
    rows = df.select(F.col(row_id).cast("long").alias(row_id), *packed(columns))
    bucketed, draws = bucketed_draws(rows, stats, seeds, k, sampling if sampling != POISSON else "exact", goal, row_id)

    def cut(batches):
        give_back()
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.pad(design(unpacked(batch, m), centres), ((0, 0), (0, blocks * tile - q)))
            ids, bucket = batch.column(row_id).to_numpy(), batch.column(BUCKET).to_numpy()
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                own = ids[part].tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([bucket[part[0]]] * blocks), pa.array(np.arange(blocks, dtype=np.int32)),
                    pa.array([own] * blocks, pa.binary()),
                    pa.array([z[part, c * tile:(c + 1) * tile].tobytes() for c in range(blocks)], pa.binary())],
                    names=["b", "c", "ids", "x"])

    def merge(table: pa.Table) -> pa.Table:
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in table["ids"].to_pylist()])
        order = np.argsort(ids)
        if not np.all(np.diff(ids[order])):
            raise ValueError(f"{row_id} is not unique")
        x = np.concatenate([np.frombuffer(x).reshape(-1, tile) for x in table["x"].to_pylist()])[order]
        return pa.table({"b": table["b"].slice(0, 1), "c": table["c"].slice(0, 1),
                         "ids": pa.array([ids[order].tobytes()], pa.binary()),
                         "x": pa.array([x.tobytes()], pa.binary())})

    shape = "b long, c int, ids binary, x binary"
    by_size = n * blocks * tile * 8 // (128 << 20)
    tasks = min(max(by_size, 3 * spark.sparkContext.defaultParallelism), MAX_TASKS)
    held = staged(bucketed.mapInArrow(cut, shape).repartition(tasks, "b", "c").groupBy("b", "c").applyInArrow(
        merge, shape), "blocks")
    stripes = block_count(blocks, side)
    batches = [seeds[s:s + at_once] for s in range(0, len(seeds), at_once)]
    # a task's tiles are at most as many bytes as its rows, and no more tasks than keep the cores busy
    pairs = stripes * (stripes + 1) // 2 * len(batches)
    by_rows = n * stripes // (len(batches[0]) * k * tile * (blocks + 1) // 2)
    chunks = max(1, min(-(-3 * spark.sparkContext.defaultParallelism // pairs), by_rows))
    met = held.withColumn("pair", F.expr(
        f"explode(transform(sequence(0, {stripes - 1}), t -> struct(least(c div {side}, t) AS s1, greatest(c div {side}, t) AS s2)))"))
    if sampling != POISSON:   # a bucket's draws come as a block before its first
        met = met.unionByName(bundle_draws(draws).select(
            F.col("hit_bucket").alias("b"), F.lit(-1).alias("c"), F.lit(None).cast("binary").alias("ids"),
            F.col("draws").alias("x"), F.expr(
                f"explode(flatten(transform(sequence(0L, {stripes - 1}L), s -> transform(sequence(s, {stripes - 1}L), "
                "t -> struct(s AS s1, t AS s2)))))").alias("pair")))
    key = ["s1", "s2", "batch"]
    met = met.select("b", "c", "ids", "x", "pair.*", F.explode(F.sequence(F.lit(0), F.lit(len(batches) - 1))).alias(
        "batch"), F.pmod(F.xxhash64("b"), F.lit(chunks)).alias("chunk"))
    met = met.repartition(min(max(tasks, pairs * chunks), MAX_TASKS), *key, "chunk").sortWithinPartitions(
        *key, "b", "c").select(*key, "b", "c", "ids", "x")

    def weights_of(ids, draws, own):
        if sampling == POISSON:
            return poisson_array_weights(ids, own, k)
        drawn = unbundle_draws(draws, own) if draws is not None else None
        return weigh(sampling, drawn, n, k, size, len(ids)) if drawn is not None and drawn.num_rows else ()

    def add(total, every, own, bucket):
        """The products of a bucket's blocks, weighed for the seeds ``own``."""
        ids, draws, x = bucket["ids"], bucket["draws"], bucket["x"]
        place = {s: i for i, s in enumerate(own)}
        for chunk, w in weights_of(ids, draws, own) if x else ():
            for s, by_fold in zip(chunk.tolist(), w):
                for f, one in enumerate(by_fold):
                    hit = np.flatnonzero(one)
                    weight, y = one[hit, None], {}
                    for number, (c1, c2) in enumerate(every):
                        if c1 not in y:   # pairs are in the order of their first block
                            y = {c1: (x[c1][hit] * weight).T}
                        total[place[s], f, number] += y[c1] @ x[c2][hit]

    def multiply(met):
        give_back()
        now, total, every, bucket = None, None, (), None
        for part in met:
            for at in range(part.num_rows):
                s1, s2, batch, b, c = (part.column(name)[at].as_py() for name in (*key, "b", "c"))
                if bucket is not None and ((s1, s2, batch) != now or b != bucket["b"]):
                    add(total, every, batches[now[2]], bucket)
                    bucket = None
                if (s1, s2, batch) != now:
                    for number, pair in enumerate(every):
                        yield from _tiles(batches[now[2]], total[:, :, number], pair)
                    now = s1, s2, batch
                    one, two = (range(s * side, min((s + 1) * side, blocks)) for s in (s1, s2))
                    every = [(c1, c2) for c1 in one for c2 in two if c1 <= c2]
                    total = np.zeros((len(batches[batch]), k, len(every), tile, tile))
                bucket = bucket or {"b": b, "ids": None, "draws": None, "x": {}}
                if c < 0:
                    bucket["draws"] = part.column("x")[at]
                else:
                    bucket["ids"] = np.frombuffer(part.column("ids")[at].as_buffer(), np.int64)
                    bucket["x"][c] = np.frombuffer(part.column("x")[at].as_buffer()).reshape(-1, tile)
        if bucket is not None:
            add(total, every, batches[now[2]], bucket)
            for number, pair in enumerate(every):
                yield from _tiles(batches[now[2]], total[:, :, number], pair)
        total = bucket = None
        give_back()

    parts = met.mapInArrow(multiply, TILES)
    return parts if chunks == 1 else _summed(parts)


def _tiles_in_place(df: DataFrame, stats: FrameStats, columns: list[str], seeds: list[int], k: int, sampling: str,
                    row_id: str, tile: int) -> DataFrame:
    """The tiles where a task can hold all of them. Rows that are dealt by id stay in their partitions; a task takes
    the products of its share and gives out each tile once."""
    m, n = len(columns), stats.n
    q, slots = m + 1, df.sparkSession.sparkContext.defaultParallelism
    blocks = block_count(q, tile)
    every = [(a, b) for a in range(blocks) for b in range(a, blocks)]
    centres = np.asarray(stats.centres(columns))
    # a task's tiles are at most as many bytes as its rows, and no more tasks than run at once
    chunks = max(1, min(slots, n // (len(seeds) * k * tile * (blocks + 1) // 2)))
    rows = df.select(F.col(row_id).cast("long").alias(row_id), *packed(columns))
    if sampling != POISSON:
        if chunks > 1 and not is_dealt(rows, row_id):
            rows = rows.repartition(min(max(n * blocks * tile * 8 // (128 << 20), 3 * slots), MAX_TASKS), row_id)
        rows = rows.join(row_weights(df, stats, seeds, k, sampling, row_id).hint("shuffle_hash"), row_id)

    def weights_of(batch) -> np.ndarray:
        """(rows x seeds x folds)."""
        if sampling == POISSON:
            return np.concatenate([w for _, w in poisson_array_weights(
                batch.column(row_id).to_numpy(), seeds, k)]).transpose(2, 0, 1)
        return np.frombuffer(b"".join(batch.column("w").to_pylist()), np.int32).reshape(-1, len(seeds), k)

    def add(total, x, w, hold):
        """The products of rows, weighed by roots of the weights on either side."""
        product = np.empty((tile, tile))
        for s, f in np.ndindex(len(seeds), k):
            hit = np.flatnonzero(w[:, s, f])
            own = np.take(x, hit, axis=0, out=hold[:len(hit)], mode="clip")
            own *= np.sqrt(w[hit, s, f])[:, None]
            for number, (a, b) in enumerate(every):
                one = own[:, a * tile:(a + 1) * tile]
                two = one if a == b else own[:, b * tile:(b + 1) * tile]
                total[s, f, number] += np.matmul(one.T, two, out=product)

    def multiply(batches):
        give_back()
        total, held = None, 0
        for batch in read_ahead(batches, AHEAD):
            if total is None:
                total = np.zeros((len(seeds), k, len(every), tile, tile))
                x, hold = np.zeros((ROWS_AT_ONCE, blocks * tile)), np.empty((ROWS_AT_ONCE, blocks * tile))
                x[:, 0], w = 1.0, np.zeros((ROWS_AT_ONCE, len(seeds), k), np.int32)
            z, own = (unpacked(batch, m), weights_of(batch)) if batch.num_rows else ((), ())
            at = 0
            while at < len(z):
                take = min(len(z) - at, ROWS_AT_ONCE - held)
                np.subtract(z[at:at + take], centres, out=x[held:held + take, 1:q])
                w[held:held + take] = own[at:at + take]
                at, held = at + take, held + take
                if held == ROWS_AT_ONCE:
                    add(total, x, w, hold)
                    held = 0
        if total is not None:
            add(total, x[:held], w[:held], hold)
            x = hold = None
            for number, pair in enumerate(every):
                yield from _tiles(seeds, total[:, :, number], pair)
        total = None
        give_back()

    parts = rows.coalesce(chunks).mapInArrow(multiply, TILES)
    return parts if chunks == 1 else _summed(parts)


# ------------------------------------------------------------------ sparse rows

class SparsePairs:
    """Products of the entries of sparse rows that are both there, for pairs of blocks of columns."""

    def __init__(self, index: np.ndarray, value: np.ndarray, ends: np.ndarray):
        """Entries of all rows behind one another, sorted by index in a row; ``ends`` as row offsets."""
        self.index, self.value, self.ends = index, value, ends

    def products(self):
        """``(row, i, j, value)`` with i <= j, some at a time: rows of equally many entries are taken together."""
        count = np.diff(self.ends)
        for c in np.unique(count[count > 0]).tolist():
            rows = np.flatnonzero(count == c)
            one, two = np.triu_indices(c)
            step = max(1, PAIRS_AT_ONCE // len(one))
            for lo in range(0, len(rows), step):
                own = rows[lo:lo + step]
                at = self.ends[own][:, None] + np.arange(c)
                i, x = self.index[at], self.value[at]
                yield np.repeat(own, len(one)), i[:, one].ravel(), i[:, two].ravel(), (x[:, one] * x[:, two]).ravel()

    def add(self, total: np.ndarray, tiles: np.ndarray, tile: int, weights) -> None:
        """Add to ``total[seed, fold, tile, i, j]`` for the tiles whose number by block pair is in ``tiles`` (-1:
        not among them); ``weights`` gives (place of the seeds, W[seed, fold, row])."""
        flat = total.reshape(*total.shape[:2], -1)
        ready = []
        for row, i, j, x in self.products():
            number = tiles[i // tile, j // tile]
            key = (number.astype(np.int64) * tile + i % tile) * tile + j % tile
            order = np.argsort(key[number >= 0], kind="stable")
            pick = np.flatnonzero(number >= 0)[order]
            if len(pick):
                key = key[pick]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                ready.append((key[first], first, row[pick], x[pick]))
        for places, w in weights:
            for s, by_fold in zip(places, w):
                for f, one in enumerate(by_fold):
                    one = one.astype(float)
                    for key, first, row, x in ready:
                        flat[s, f, key] += np.add.reduceat(x * one[row], first)


def _centred(total: np.ndarray, pairs: list[tuple[int, int]], sums: np.ndarray, means: np.ndarray, tile: int):
    """Turn sums of z z' into sums of (z - mean)(z - mean)': ``sums[seed, fold]`` are those of z, whose first
    entry is the weight."""
    for number, (a, b) in enumerate(pairs):
        one, two = slice(a * tile, (a + 1) * tile), slice(b * tile, (b + 1) * tile)
        n = sums[:, :, :1, None]
        total[:, :, number] += (n * means[one, None] * means[None, two] - means[one, None] * sums[:, :, None, two]
                                - sums[:, :, one, None] * means[None, two])
        if a == b:
            upper = np.triu(total[:, :, number])
            total[:, :, number] = upper + np.triu(upper, 1).swapaxes(-1, -2)


def sparse_tiles(rows: DataFrame, stats: FrameStats, means: np.ndarray, seeds: list[int], k: int, sampling: str,
                 row_id: str = ROW_ID, tile: int = TILE) -> DataFrame:
    """The tiles over sparse rows ``(row_id, _i array<int>, _v array<double>)``. Column 0 is the constant;
    entries are sorted by column, and values of columns that are there in most rows are best centred already
    (their mean in ``means``, which has one number a column, is 0 then). The tiles are centred by ``means``.

    ``stats`` needs the number of rows and the range of ids only. A task keeps its share of the written rows, a
    file split, and takes it through batches of seeds and tiles of ``PARTIAL_BYTES``.
    """
    n, size, q = stats.n, cell_size(stats.n), len(means)
    blocks = block_count(q, tile)
    means = np.pad(np.asarray(means, float), (0, blocks * tile - q))
    every = [(a, b) for a in range(blocks) for b in range(a, blocks)]
    room = max(1, PARTIAL_BYTES // (k * tile * tile * 8))
    batches = ([(seeds[s:s + room // len(every)], every) for s in range(0, len(seeds), room // len(every))]
               if room >= len(every) else
               [([s], every[p:p + room]) for s in seeds for p in range(0, len(every), room)])
    held = rows.select(F.col(row_id).cast("long").alias(row_id), "_i", "_v")
    if sampling != POISSON:
        held = staged(_sparse_bundles(held, stats, seeds, k, sampling, row_id), "sparse")
    columns = ["ids", "ends", "index", "value"]

    def bundled(batch):
        if sampling == POISSON:
            yield (batch.column(row_id).to_numpy(), *_sparse_arrays(batch), None)
            return
        for at in range(batch.num_rows):
            kinds = (np.int64, np.int64, np.int32, np.float64)
            arrays = [np.frombuffer(batch.column(c)[at].as_buffer(), t) for c, t in zip(columns, kinds)]
            yield (*arrays, batch.column("draws")[at])

    def reduce(share):
        share = [b for b in share if b.num_rows]
        for own, pairs in batches if share else []:
            tiles = np.full((blocks, blocks), -1, np.int32)
            for number, (a, b) in enumerate(pairs):
                tiles[a, b] = number
            total = np.zeros((len(own), k, len(pairs), tile, tile))
            sums = np.zeros((len(own), k, blocks * tile))
            place = {s: i for i, s in enumerate(own)}
            for batch in share:
                for ids, ends, index, value, draws in bundled(batch):
                    if sampling == POISSON:
                        weights = list(poisson_array_weights(ids, own, k))
                    else:
                        draws = unbundle_draws(draws, own)
                        weights = list(weigh(sampling, draws, n, k, size, len(ids))) if draws.num_rows else []
                    weights = [([place[int(s)] for s in chunk], w) for chunk, w in weights]
                    SparsePairs(index, value, ends).add(total, tiles, tile, weights)
                    row = np.repeat(np.arange(len(ids)), np.diff(ends))
                    for places, w in weights:
                        for s, by_fold in zip(places, w):
                            for f, one in enumerate(by_fold):
                                sums[s, f] += np.bincount(index, value * one[row], blocks * tile)
            _centred(total, pairs, sums, means, tile)
            for number, at in enumerate(pairs):
                yield from _tiles(own, total[:, :, number], at)

    return _summed(held.mapInArrow(reduce, TILES))


def _sparse_arrays(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row offsets, indices, values) of an Arrow batch or table of sparse rows."""
    index, value = (table.column(c) for c in ("_i", "_v"))
    if isinstance(index, pa.ChunkedArray):
        index, value = index.combine_chunks(), value.combine_chunks()
    ends = index.offsets.to_numpy().astype(np.int64)
    return ends - ends[0], index.flatten().to_numpy(), value.flatten().to_numpy()


def _sparse_bundles(rows: DataFrame, stats: FrameStats, seeds, k, sampling, row_id) -> DataFrame:
    """Buckets of sparse rows with the draws that hit them, one row each."""
    spark = rows.sparkSession
    goal = max(MIN_CELL // 2, min(1 << 16, stats.n // (3 * spark.sparkContext.defaultParallelism)))
    bucketed, draws = bucketed_draws(rows, stats, seeds, k, sampling, goal, row_id)
    kind = "ids binary, ends binary, index binary, value binary, draws binary"

    def bundle(table: pa.Table, draws: pa.Table) -> pa.Table:
        if not table.num_rows or not draws.num_rows:
            return schema.empty_table()
        ids = table[row_id].to_numpy()
        order = np.argsort(ids)
        if not np.all(np.diff(ids[order])):
            raise ValueError(f"{row_id} is not unique")
        ends, index, value = _sparse_arrays(table.take(pa.array(order)))
        raw = [x.tobytes() for x in (ids[order], ends, index.astype(np.int32), value)]
        return pa.table([pa.array([x], pa.binary()) for x in (*raw, bundle_bytes(draws))], schema=schema)

    schema = pa.schema([(f.split()[0], pa.binary()) for f in kind.split(", ")])
    tasks = min(max(stats.n * 128 // (128 << 20), 3 * spark.sparkContext.defaultParallelism), MAX_TASKS)
    return (bucketed.repartition(tasks, BUCKET).groupBy(BUCKET)
            .cogroup(draws.repartition(tasks, "hit_bucket").groupBy("hit_bucket")).applyInArrow(bundle, kind))
