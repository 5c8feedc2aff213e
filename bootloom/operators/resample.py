"""Bootstrap resamples: n draws with replacement per seed, as row weights.

Drawing n rows out of n for every seed is done in two steps that together are exactly the
multinomial of n independent draws, without ever shuffling the n draws:

1. Positions 0..n-1 are cut into equal cells. A flat range of (seed, draw) numbers is
   hashed to a cell and counted per (seed, cell, fold), with partial counts on the map side.
2. Within a cell the counted draws are spread over its positions by a second hash. This
   happens where the rows of the cell are, so the rows are shuffled once for all seeds and
   the draws themselves never leave the task that uses them.

Folds are cut over the draw numbers, as k-fold cross-validation over the resampled table
would do, so copies of a row can be in different folds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import hashing
from ..functions.scratch import staged
from ..sources.frames import ROW_ID, FrameStats, packed, unpacked
from .index import BUCKET, bucket_rows, bucket_table

EXACT, POISSON, NUMPY = "exact", "poisson", "numpy"
SAMPLINGS = (EXACT, POISSON, NUMPY)

# Smallest cell and the number of cells at most. The cell size depends on n
# alone, so equal seeds and equal n give equal resamples for every model and cluster.
MIN_CELL = 1 << 12
MAX_CELLS = 1 << 21

# Tasks of one stage at most: map tasks times reduce tasks is what a shuffle has to track.
MAX_TASKS = 1 << 16

# Draws hashed and counted by one task of step 1 (some seconds of work), and the groups it
# counts into: Spark's compiled aggregation keeps the first 2^16 in a map of its own, which
# is several times faster than the general one.
DRAWS_PER_TASK = 1 << 27
GROUPS_PER_TASK = 50_000

# Weights laid out at once in a task (seeds x folds x rows): small enough for a core's cache.
WEIGHTS_AT_ONCE = 1 << 18


def seed_list(seed_start: int, n_boot: int) -> list[int]:
    if n_boot < 1:
        raise ValueError("n_boot must be at least 1")
    return list(range(seed_start, seed_start + n_boot))


def seed_frame(spark: SparkSession, seeds: Iterable[int]) -> DataFrame:
    return spark.createDataFrame([(int(s),) for s in seeds], "seed long")


def cell_size(n: int) -> int:
    return max(MIN_CELL, math.ceil(n / MAX_CELLS))


def fold_bounds(n: int, k: int) -> list[int]:
    """First draw of each fold, then n: contiguous folds, the first n mod k one longer."""
    if not 1 <= k <= n:
        raise ValueError(f"cannot cut {n} draws into {k} folds")
    return [f * (n // k) + min(f, n % k) for f in range(k + 1)]


def fold_of(draw: Column, n: int, k: int) -> Column:
    bounds = fold_bounds(n, k)
    out = F.lit(k - 1)
    for f in reversed(range(k - 1)):
        out = F.when(draw < bounds[f + 1], f).otherwise(out)
    return out


# ---------------------------------------------------------------- step 1: draws per cell

def _seed_at(index: Column, seeds: list[int]) -> Column:
    if seeds == list(range(seeds[0], seeds[0] + len(seeds))):
        return index + F.lit(seeds[0]).cast("long")
    return F.element_at(F.array(*[F.lit(s).cast("long") for s in seeds]), (index + 1).cast("int"))


def draw_numbers(spark: SparkSession, seeds: list[int], n: int, blocks: int = 1) -> DataFrame:
    """(nth, seed, draw) for draw = 0..n-1 of every seed, the nth of the list, from one flat
    range; `blocks` is the number of groups the draws of a seed will be counted in."""
    total = len(seeds) * n
    wanted = max(math.ceil(total / DRAWS_PER_TASK),
                 math.ceil(len(seeds) * blocks / GROUPS_PER_TASK))
    tasks = max(spark.sparkContext.defaultParallelism, min(wanted, MAX_TASKS))
    nth = F.expr(f"id div {n}")
    return spark.range(0, total, 1, tasks).select(
        nth.alias("nth"), _seed_at(nth, seeds).alias("seed"), (F.col("id") % n).alias("draw"))


def cell_counts(spark: SparkSession, seeds: list[int], n: int, k: int) -> DataFrame:
    """(seed, cell, fold, n_draws): how many draws of each fold fall into each cell.

    Seed, cell and fold are counted as one long, which is what the compiled aggregation is
    fastest at, and taken apart again afterwards.
    """
    size = cell_size(n)
    blocks = math.ceil(n / size) * k
    cell = F.expr(f"(shiftrightunsigned(xxhash64(seed, draw), 1) % {n}) div {size}")
    key = F.col("nth") * blocks + cell * k + fold_of(F.col("draw"), n, k)
    counted = draw_numbers(spark, seeds, n, blocks).groupBy(key.alias("key")).agg(
        F.count("*").cast("int").alias("n_draws"))
    # coalesce: `div` and `%` count as nullable, and a null check on a join key would be
    # pushed down to every draw
    return counted.select(
        _seed_at(F.expr(f"key div {blocks}"), seeds).alias("seed"),
        F.expr(f"coalesce(cast((key % {blocks}) div {k} as int), 0)").alias("cell"),
        F.expr(f"cast(key % {k} as int)").alias("fold"), "n_draws")


# ---------------------------------------------------------------- step 2: draws in a cell

def resample(spark: SparkSession, seeds: list[int], n: int, k: int = 3) -> DataFrame:
    """Every single draw: (seed, fold, cell, draw_in_cell, position). B * n rows.

    The draws of a cell are numbered through its folds, so that the resample is the same
    whatever the number of folds.
    """
    size = cell_size(n)
    before = Window.partitionBy("seed", "cell").orderBy("fold").rowsBetween(
        Window.unboundedPreceding, -1)
    draws = (cell_counts(spark, seeds, n, k)
             .withColumn("first", F.coalesce(F.sum("n_draws").over(before), F.lit(0)))
             .select("seed", "fold", F.col("cell").cast("long").alias("cell"),
                     F.explode(F.sequence("first", F.col("first") + F.col("n_draws") - 1))
                     .alias("draw_in_cell")))
    first = F.col("cell") * size
    place = hashing.nonneg_hash("seed", "cell", "draw_in_cell") % F.least(F.lit(size), n - first)
    return draws.select("*", (first + place).alias("position"))


def _cell_weights(draws: pa.Table, n: int, k: int, size: int, offset: int, rows: int
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Weights of one bucket's rows, a few seeds at a time: (seeds, W[seed, fold, row])."""
    seed, fold = draws["seed"].to_numpy(), draws["fold"].to_numpy()
    cell, count = draws["cell"].to_numpy().astype(np.int64), draws["n_draws"].to_numpy()
    order = np.lexsort((fold, cell, seed))
    seed, cell, fold, count = seed[order], cell[order], fold[order], count[order]
    state = hashing.hash_array(cell, hashing.hash_array(seed))
    width = np.minimum(size, n - cell * size)
    # The number of draws before each line, less those before the first line of its cell.
    before = np.cumsum(count) - count
    opens = np.append(True, (np.diff(seed) != 0) | (np.diff(cell) != 0))
    earlier = before - before[opens][np.cumsum(opens) - 1]

    seeds, first = np.unique(seed, return_index=True)
    first = np.append(first, len(seed))
    step = max(1, WEIGHTS_AT_ONCE // (k * rows))
    for s in range(0, len(seeds), step):
        part = slice(first[s], first[min(s + step, len(seeds))])
        times, chunk = count[part], seeds[s:s + step]
        ordinal = np.arange(times.sum()) + np.repeat(earlier[part] - (before[part] - before[part][0]), times)
        hashes = hashing.hash_array(ordinal, np.repeat(state[part], times))
        place = (hashes >> np.uint64(1)).astype(np.int64) % np.repeat(width[part], times)
        row = place + np.repeat(cell[part] * size - offset, times)
        block = np.repeat(np.searchsorted(chunk, seed[part]) * k + fold[part], times)
        inside = (row >= 0) & (row < rows)
        flat = np.bincount(block[inside] * rows + row[inside], minlength=len(chunk) * k * rows)
        yield chunk, flat.reshape(len(chunk), k, rows)


def _position_weights(draws: pa.Table, n: int, k: int, size: int, offset: int, rows: int
                      ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same from explicit draws (seed, fold, position)."""
    seed, fold = draws["seed"].to_numpy(), draws["fold"].to_numpy()
    row = draws["position"].to_numpy() - offset
    order = np.argsort(seed, kind="stable")
    seed, fold, row = seed[order], fold[order], row[order]
    seeds, first = np.unique(seed, return_index=True)
    first = np.append(first, len(seed))
    step = max(1, WEIGHTS_AT_ONCE // (k * rows))
    for s in range(0, len(seeds), step):
        part = slice(first[s], first[min(s + step, len(seeds))])
        chunk = seeds[s:s + step]
        block = np.searchsorted(chunk, seed[part]) * k + fold[part]
        flat = np.bincount(block * rows + row[part], minlength=len(chunk) * k * rows)
        yield chunk, flat.reshape(len(chunk), k, rows)


def numpy_draws(spark: SparkSession, seeds: list[int], n: int, k: int = 3,
                segment: int = 1 << 24) -> DataFrame:
    """Replay of NumPy's legacy stream: `RandomState(seed).randint(0, n, n)` per seed.

    Opt-in, for results that must line up with resamples drawn that way. Such a stream cannot
    be entered in the middle, so the task of a segment steps over what comes before (cheap,
    nothing is kept) and hands out its own segment only.
    """
    bounds = np.array(fold_bounds(n, k)[1:])
    chunk = min(segment, 1 << 20)
    parts = spark.createDataFrame([(int(s), lo) for s in seeds for lo in range(0, n, segment)],
                                  "seed long, first long")

    def draw(batches):
        for batch in batches:
            for seed, first in zip(*batch.to_pydict().values()):
                stream = np.random.RandomState(seed)
                for lo in range(0, min(first + segment, n), chunk):
                    d = np.arange(lo, min(lo + chunk, n))
                    position = stream.randint(0, high=n, size=len(d))
                    if lo >= first:
                        yield pa.RecordBatch.from_pydict({
                            "seed": np.full(len(d), seed), "draw": d,
                            "fold": np.searchsorted(bounds, d, side="right").astype(np.int32),
                            "position": position.astype(np.int64)})

    tasks = min(len(seeds) * math.ceil(n / segment), 8 * spark.sparkContext.defaultParallelism)
    return parts.repartition(tasks).mapInArrow(
        draw, "seed long, draw long, fold int, position long")


# ---------------------------------------------------------------- draws meet rows

def task_count(spark: SparkSession, n: int, columns: int, buckets: int) -> int:
    """Shuffle partitions for n rows: about 128 MB each, at least what keeps all cores busy
    and at most MAX_TASKS. Larger partitions only sort with spills: a task takes up one
    bucket at a time."""
    by_size = min(math.ceil(n * (columns + 2) * 8 / (128 << 20)), MAX_TASKS)
    return max(1, min(max(by_size, 3 * spark.sparkContext.defaultParallelism), buckets))


def bucket_goal(spark: SparkSession, n: int, columns: int, blocks: int) -> int:
    """Wanted rows per bucket: a few MB, more where the output of a bucket (`blocks` Gram
    matrices) would otherwise outweigh its rows, less where cores would go idle."""
    width = 8 * (columns + 2)
    goal = max((4 << 20) // width, min(2 * blocks * (columns + 3), (64 << 20) // width))
    idle = n // (3 * spark.sparkContext.defaultParallelism)
    return max(min(goal, idle), MIN_CELL // 2)


def bucketed_draws(df: DataFrame, stats: FrameStats, seeds: list[int], k: int, sampling: str, goal: int,
                   row_id: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the bucket they are in, and the draws that hit each bucket."""
    spark, n = df.sparkSession, stats.n
    bucketed = bucket_rows(df, stats, goal, row_id)
    buckets = bucket_table(bucketed, stats, row_id)
    size = cell_size(n)
    cells = buckets.select(
        F.col(BUCKET).alias("hit_bucket"), F.col("_offset").alias("offset"),
        F.col("_bucket_rows").alias("n_rows"),
        F.explode(F.expr(f"sequence(cast(_offset div {size} as int), "
                         f"cast((_offset + _bucket_rows - 1) div {size} as int))")).alias("cell"))
    if sampling == EXACT:
        draws = (cell_counts(spark, seeds, n, k).join(cells, "cell")
                 .select("hit_bucket", "offset", "seed", "cell", "fold", "n_draws"))
    else:
        draws = (numpy_draws(spark, seeds, n, k)
                 .withColumn("cell", F.expr(f"cast(position div {size} as int)"))
                 .join(cells, "cell")
                 .where("position between offset and offset + n_rows - 1")
                 .select("hit_bucket", "offset", "seed", "fold", "position"))
    return bucketed, draws


def _meet(df: DataFrame, stats: FrameStats, columns: list[str], seeds: list[int], k: int,
          sampling: str, blocks: int, row_id: str, function, schema: str) -> DataFrame:
    """Bring the rows of each bucket and the draws that hit it together, and apply
    ``function(ids, x, draws)`` to both: ids and columns in position order, and a table."""
    spark, n = df.sparkSession, stats.n
    goal = bucket_goal(spark, n, len(columns), blocks)
    bucketed, draws = bucketed_draws(df.select(F.col(row_id).cast("long").alias(row_id), *packed(columns)),
                                     stats, seeds, k, sampling, goal, row_id)
    tasks = task_count(spark, n, len(columns), max(1, 2 * n // goal))

    def apply(rows: pa.Table, draws: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or draws.num_rows == 0:
            return out_schema.empty_table()
        ids = rows[row_id].to_numpy()
        order = np.argsort(ids)
        if not np.all(np.diff(ids[order])):
            raise ValueError(f"{row_id} is not unique")
        return function(ids[order], unpacked(rows, len(columns))[order] if columns else None, draws)

    out_schema = _arrow_schema(schema)
    return (bucketed.repartition(tasks, BUCKET).groupBy(BUCKET)
            .cogroup(draws.repartition(tasks, "hit_bucket").groupBy("hit_bucket"))
            .applyInArrow(apply, schema))


def weigh(sampling: str, draws: pa.Table, n: int, k: int, size: int, rows: int):
    """Weights of a bucket of `rows` rows from its draws in cells of a size."""
    weights = _cell_weights if sampling == EXACT else _position_weights
    return weights(draws, n, k, size, draws["offset"][0].as_py(), rows)


def with_draws(df: DataFrame, stats: FrameStats, columns: list[str], seeds: list[int], k: int,
               sampling: str, function, schema: str, row_id: str = ROW_ID) -> DataFrame:
    """Apply ``function(ids, x, weights)`` to each bucket: the ids and columns of its rows in
    position order and an iterator of (seeds, W[seed, fold, row])."""
    n, size = stats.n, cell_size(stats.n)

    def weighed(ids, x, draws) -> pa.Table:
        return function(ids, x, weigh(sampling, draws, n, k, size, len(ids)))

    return _meet(df, stats, columns, seeds, k, sampling, len(seeds) * k, row_id, weighed, schema)


def bundle_bytes(draws: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, draws.schema) as out:
        out.write_table(draws)
    return sink.getvalue().to_pybytes()


def bundle_draws(draws: DataFrame) -> DataFrame:
    """(hit_bucket, draws): the draws of each bucket as one value."""
    def bundle(table: pa.Table) -> pa.Table:
        return pa.table({"hit_bucket": table["hit_bucket"].slice(0, 1),
                         "draws": pa.array([bundle_bytes(table.drop_columns("hit_bucket"))], pa.binary())})

    return draws.groupBy("hit_bucket").applyInArrow(bundle, "hit_bucket long, draws binary")


def unbundle_draws(draws: pa.Scalar, seeds: list[int]) -> pa.Table:
    """The draws of some seeds."""
    table = pa.ipc.open_stream(draws.as_buffer()).read_all()
    return table.filter(pc.is_in(table["seed"], value_set=pa.array(seeds, pa.int64())))


def bundles(df: DataFrame, stats: FrameStats, columns: list[str], seeds: list[int], k: int,
            sampling: str, row_id: str = ROW_ID) -> DataFrame:
    """The buckets with their draws in a written table, one row of a few MB each, for work that
    goes over them more than once. `unbundled` takes them apart."""
    def bundle(ids, x, draws) -> pa.Table:
        return pa.table([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
                         pa.array([bundle_bytes(draws)], pa.binary())], names=["x", "draws"])

    return staged(_meet(df, stats, columns, seeds, k, sampling, 0, row_id, bundle,
                        "x binary, draws binary"), "bundles")


def unbundled(batch, columns: int, n: int, k: int, size: int, sampling: str, seeds: list[int]
              ) -> Iterator[tuple[np.ndarray, Iterator]]:
    """(x, weights) of each bundle of an Arrow batch, weights for some of the seeds only; `size` is
    the `cell_size` the draws were counted with."""
    for x, draws in zip(batch.column("x"), batch.column("draws")):
        x = np.frombuffer(x.as_buffer()).reshape(-1, columns)
        draws = unbundle_draws(draws, seeds)
        if draws.num_rows:
            yield x, weigh(sampling, draws, n, k, size, len(x))


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in
                      (f.strip().split(" ") for f in ddl.split(","))])


def resample_weights(df: DataFrame, stats: FrameStats, seeds: list[int], k: int = 3,
                     sampling: str = EXACT, row_id: str = ROW_ID) -> DataFrame:
    """(seed, row_id, fold, w): the rows of every resample with their multiplicities."""
    if sampling == POISSON:
        return poisson_weights(df, seeds, k, row_id)
    schema = f"seed long, {row_id} long, fold int, w int"

    def emit(ids, x, weights) -> pa.Table:
        parts = []
        for chunk, w in weights:
            s, f, r = np.nonzero(w)
            parts.append(pa.table([chunk[s], ids[r], f.astype(np.int32),
                                   w[s, f, r].astype(np.int32)],
                                  names=["seed", row_id, "fold", "w"]))
        return pa.concat_tables(parts)

    return with_draws(df, stats, [], seeds, k, sampling, emit, schema, row_id)


def row_weights(df: DataFrame, stats: FrameStats, seeds: list[int], k: int, sampling: str,
                row_id: str = ROW_ID) -> DataFrame:
    """(row_id, w): the rows that were drawn, with their multiplicities as an int32 per seed and fold."""
    place = {s: i for i, s in enumerate(seeds)}

    def emit(ids, x, weights) -> pa.Table:
        every = np.zeros((len(ids), len(seeds), k), np.int32)
        for chunk, w in weights:
            every[:, [place[s] for s in chunk.tolist()]] = w.transpose(2, 0, 1)
        hit = np.flatnonzero(every.any(axis=(1, 2)))
        ends = np.arange(len(hit) + 1, dtype=np.int64) * (4 * len(seeds) * k)
        w = pa.Array.from_buffers(pa.large_binary(), len(hit), [
            None, pa.py_buffer(ends), pa.py_buffer(every[hit].tobytes())]).cast(pa.binary())
        return pa.table([pa.array(ids[hit]), w], names=[row_id, "w"])

    return with_draws(df, stats, [], seeds, k, sampling, emit, f"{row_id} long, w binary", row_id)


def poisson_weights(df: DataFrame, seeds: list[int], k: int = 3,
                    row_id: str = ROW_ID) -> DataFrame:
    """One-pass stand-in for the exact resample: an independent Poisson(1) weight per
    (seed, row), so the size is n only on average and all copies of a row share a fold.
    Needs no shuffle at all, and so cannot notice repeated ids; opt-in."""
    each = df.select(row_id, F.explode(F.sequence(F.lit(0).cast("long"),
                                                  F.lit(len(seeds) - 1).cast("long"))).alias("nth"))
    return each.select(row_id, _seed_at(F.col("nth"), seeds).alias("seed")).select(
        "seed", row_id, (hashing.spare("seed", row_id) % k).cast("int").alias("fold"),
        hashing.poisson_weight(hashing.uniform("seed", row_id)).alias("w")).where("w > 0")


def poisson_array_weights(ids: np.ndarray, seeds: list[int], k: int
                          ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Array form of `poisson_weights` for a batch of rows."""
    step = max(1, WEIGHTS_AT_ONCE // (k * len(ids)))
    for s in range(0, len(seeds), step):
        chunk = np.asarray(seeds[s:s + step], dtype=np.int64)
        state = hashing.hash_array(ids[None, :], hashing.hash_array(chunk)[:, None])
        w = hashing.poisson_array(hashing.uniform_array(state))
        fold = (state & np.uint64(hashing.SPARE_BITS)).astype(np.int16) % k
        yield chunk, np.stack([np.where(fold == f, w, 0) for f in range(k)], axis=1)


def fold_assign(indexed: DataFrame, n: int, k: int = 3) -> DataFrame:
    """The fold of each draw number, for a table whose `position` plays the draw number."""
    return indexed.withColumn("fold", fold_of(F.col("position"), n, k))
