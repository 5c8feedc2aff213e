import numpy as np
import pytest
from pyspark.sql import functions as F

from bootloom.functions import hashing
from bootloom.operators import index, resample as rs
from bootloom.sources.frames import FrameStats, frame_stats


def ids_frame(spark, ids):
    return spark.createDataFrame([(int(i),) for i in ids], "row_id long")


def stats_of(df):
    return frame_stats(df, [])


# ------------------------------------------------------------------ hashing

def test_array_hash_equals_spark(spark):
    rows = [(0, 0), (1, 7), (2 ** 40, 3), (-5, 12), (2 ** 63 - 1, -1)]
    df = spark.createDataFrame(rows, "a long, b long")
    want = [r[0] for r in df.select(F.xxhash64("a", "b")).collect()]
    a, b = np.array(rows).T
    got = hashing.hash_array(b, hashing.hash_array(a)).astype(np.int64)
    assert got.tolist() == want


def test_poisson_array_equals_column(spark):
    u = np.linspace(0, 1, 1001)[:-1].tolist() + hashing.POISSON_1_CDF
    df = spark.createDataFrame([(x,) for x in u], "u double")
    want = [r[0] for r in df.select(hashing.poisson_weight(F.col("u"))).collect()]
    assert hashing.poisson_array(np.array(u)).tolist() == want


# ------------------------------------------------------------------ dense index

LAYOUTS = {
    "dense": np.arange(5000),
    "gaps": np.arange(0, 50000, 7),
    "negative": np.arange(-3000, 3000, 2),
    "outlier": np.append(np.arange(6000), 2 ** 61),
    "clusters": np.concatenate([np.arange(3000), 2 ** 40 + np.arange(3000) * 5,
                                2 ** 60 + np.arange(3000) ** 2]),
    "single": np.array([17]),
    "random": np.unique(np.random.default_rng(3).integers(0, 2 ** 62, 4000)),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_dense_index_is_the_rank(spark, layout):
    ids = np.random.default_rng(1).permutation(LAYOUTS[layout])
    df = ids_frame(spark, ids)
    got = {r["row_id"]: r["position"]
           for r in index.dense_index(df, stats_of(df), wanted=256).collect()}
    assert got == {int(v): i for i, v in enumerate(np.sort(ids))}


@pytest.mark.parametrize("layout", ["outlier", "clusters", "random"])
def test_no_bucket_is_overfull(spark, layout):
    df = ids_frame(spark, LAYOUTS[layout])
    buckets = index.bucket_table(index.bucket_rows(df, stats_of(df), 256), stats_of(df))
    assert buckets.agg(F.max("_bucket_rows")).first()[0] <= 4 * 256


@pytest.mark.parametrize("ids", [[1, 2, 2, 3], [5] * 5000 + list(range(10 ** 9, 10 ** 9 + 9))])
def test_repeated_ids_are_an_error(spark, ids):
    df = ids_frame(spark, ids)
    with pytest.raises(Exception, match="not unique"):
        rs.resample_weights(df, stats_of(df), [0]).collect()


# ------------------------------------------------------------------ draws

def test_folds_are_contiguous_and_the_first_are_longer(spark):
    assert rs.fold_bounds(7, 3) == [0, 3, 5, 7]
    got = [r[0] for r in spark.range(7).select(rs.fold_of(F.col("id"), 7, 3)).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2]
    with pytest.raises(ValueError):
        rs.fold_bounds(2, 3)


@pytest.fixture
def small_cells(monkeypatch):
    """Many cells in a small table."""
    monkeypatch.setattr(rs, "MIN_CELL", 256)


@pytest.mark.parametrize("n", [7, 256, 257, 5000])
def test_every_seed_draws_n_rows_in_whole_folds(spark, small_cells, n):
    df = ids_frame(spark, range(n))
    w = rs.resample_weights(df, stats_of(df), [0, 1, 2])
    sizes = {(r["seed"], r["fold"]): r["s"] for r in
             w.groupBy("seed", "fold").agg(F.sum("w").alias("s")).collect()}
    bounds = rs.fold_bounds(n, 3)
    assert sizes == {(s, f): bounds[f + 1] - bounds[f] for s in range(3) for f in range(3)}


def test_weights_equal_the_listed_draws(spark, small_cells):
    n, seeds = 3000, [3, 4, 9]
    df = ids_frame(spark, np.arange(n) * 11 + 5)
    listed = rs.resample(spark, seeds, n).groupBy(
        "seed", (F.col("position") * 11 + 5).alias("row_id"), "fold").agg(
        F.count("*").cast("int").alias("w"))
    weights = rs.resample_weights(df, stats_of(df), seeds)
    assert weights.exceptAll(listed).count() == 0 and listed.exceptAll(weights).count() == 0


def test_layout_changes_nothing(spark, small_cells, monkeypatch):
    df = ids_frame(spark, np.arange(4000) * 3)
    want = sorted(map(tuple, rs.resample_weights(df, stats_of(df), [0, 1]).collect()))
    monkeypatch.setattr(rs, "bucket_goal", lambda *a: 100)
    monkeypatch.setattr(rs, "WEIGHTS_AT_ONCE", 1)
    got = rs.resample_weights(df.repartition(13), stats_of(df), [0, 1])
    assert sorted(map(tuple, got.collect())) == want


def test_resample_does_not_depend_on_the_other_seeds_or_on_k(spark, small_cells):
    df = ids_frame(spark, range(2500))
    both = rs.resample_weights(df, stats_of(df), [5, 6], k=3)
    alone = rs.resample_weights(df, stats_of(df), [6], k=3)
    assert sorted(map(tuple, both.where("seed = 6").collect())) == sorted(map(tuple, alone.collect()))

    def totals(w):
        return {r["row_id"]: r["w"] for r in w.groupBy("row_id").agg(F.sum("w").alias("w")).collect()}
    assert totals(alone) == totals(rs.resample_weights(df, stats_of(df), [6], k=5))


@pytest.mark.parametrize("cell", [128, 4096])
def test_draws_are_uniform_and_independent(spark, monkeypatch, cell):
    """Chi-square over positions, and the variance of row weights, as for a multinomial."""
    monkeypatch.setattr(rs, "MIN_CELL", cell)
    n, b = 3000, 200
    counts = np.zeros(n)
    square = 0.0
    df = ids_frame(spark, range(n))
    w = rs.resample_weights(df, stats_of(df), list(range(b))).groupBy("seed", "row_id").agg(
        F.sum("w").alias("w")).toPandas()
    np.add.at(counts, w["row_id"].to_numpy(), w["w"].to_numpy())
    square = (w["w"] ** 2).sum() / (n * b)
    chi = ((counts - b) ** 2 / b).sum()
    assert abs(chi - (n - 1)) < 5 * np.sqrt(2 * n)
    assert abs(square - (2 - 1 / n)) < 0.02          # E w^2 = 1 + (1 - 1/n)
    assert abs(len(w) / (n * b) - (1 - np.exp(-1))) < 0.005


def test_many_draws_use_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(rs, "DRAWS_PER_TASK", 1000)
    assert rs.draw_numbers(spark, [0, 1], 20000).rdd.getNumPartitions() == 40
    assert rs.draw_numbers(spark, [0, 1], 2000, 2_000_000).rdd.getNumPartitions() == 80


# ------------------------------------------------------------------ other samplings

def test_numpy_stream_is_replayed(spark):
    n, seeds = 2100, [0, 7]
    want = {s: np.random.RandomState(s).randint(0, high=n, size=n) for s in seeds}
    got = rs.numpy_draws(spark, seeds, n, segment=512).toPandas().sort_values(["seed", "draw"])
    for s in seeds:
        assert got[got["seed"] == s]["position"].tolist() == want[s].tolist()
    df = ids_frame(spark, np.arange(n) * 2)
    w = rs.resample_weights(df, stats_of(df), seeds, sampling=rs.NUMPY).groupBy(
        "seed", "row_id").agg(F.sum("w").alias("w")).toPandas()
    for s in seeds:
        part = w[w["seed"] == s]
        full = np.zeros(n, dtype=int)
        full[part["row_id"].to_numpy() // 2] = part["w"].to_numpy()
        assert full.tolist() == np.bincount(want[s], minlength=n).tolist()


def test_poisson_weights_array_equals_column(spark, monkeypatch):
    monkeypatch.setattr(rs, "WEIGHTS_AT_ONCE", 5000)
    ids = np.arange(0, 3000, 3)
    df = ids_frame(spark, ids)
    want = sorted(map(tuple, rs.poisson_weights(df, [2, 5], 3).collect()))
    got = []
    for chunk, w in rs.poisson_array_weights(ids, [2, 5], 3):
        s, f, r = np.nonzero(w)
        got += list(zip(chunk[s].tolist(), ids[r].tolist(), f.tolist(), w[s, f, r].tolist()))
    assert sorted(got) == want
    assert abs(sum(g[3] for g in got) / (2 * len(ids)) - 1) < 0.1


def test_task_numbers_are_bounded(spark):
    assert rs.task_count(spark, 10 ** 13, 10, 10 ** 6) == rs.MAX_TASKS
    assert rs.task_count(spark, 10 ** 4, 3, 5) == 5


@pytest.mark.parametrize("n", [10 ** 6, 10 ** 12, 10 ** 15])
def test_rows_of_a_bucket_do_not_grow_with_the_data(n):
    assert 2048 <= 1 << index._shift_for(n, 0, n - 1, 4096) <= 4096
    assert 2048 <= n / (1 << 63) * (1 << index._shift_for(n, 0, (1 << 63) - 1, 4096)) <= 4096
    assert FrameStats(1, 0, 0, {}).centres([]) == []


def test_buckets_that_are_split_again_and_again_keep_their_order(spark):
    """Clusters in clusters: every splitting leaves a part too full."""
    ids = sorted({-(1 << 62), (1 << 62) + 5, *range(3000), *range(1 << 40, (1 << 40) + 2000),
                  *range(-(1 << 20), -(1 << 20) + 900)})
    df = ids_frame(spark, ids)
    buckets = index.bucket_table(index.bucket_rows(df, stats_of(df), 64), stats_of(df)).collect()
    assert max(b["_bucket_rows"] for b in buckets) <= 4 * 64
    assert sum(b["_bucket_rows"] for b in buckets) == len(ids)
    got = index.dense_index(df, stats_of(df), wanted=64).orderBy("row_id").collect()
    assert [(r["row_id"], r["position"]) for r in got] == [(x, i) for i, x in enumerate(ids)]


@pytest.mark.parametrize("wanted", [1, 64, 1 << 14])
def test_hashed_ids_have_positions(spark, wanted):
    """Ids over all 64 bits, with both ends."""
    df = spark.range(3000).selectExpr("xxhash64(id) AS row_id").unionByName(spark.createDataFrame(
        [(-(1 << 63),), ((1 << 63) - 1,)], "row_id long"))
    got = index.dense_index(df, stats_of(df), wanted=wanted).orderBy("row_id").collect()
    assert [r["position"] for r in got] == list(range(3002))
