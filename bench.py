"""Benchmark: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the tables and cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import warnings

warnings.simplefilter("ignore")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from bootloom import (Model, bagged_predict, ci_summary, coef_table, metric_dist,  # noqa: E402
                      one_hot, predict, selection_freq, split_rows)
from bootloom.functions.scratch import scratch_path  # noqa: E402
from bootloom.functions.ship import ship_package  # noqa: E402
from bootloom.operators import resample as rs  # noqa: E402
from bootloom.operators.index import dense_index  # noqa: E402
from bootloom.plans import fit, tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
GRID = (5.0, 500.0, 5000.0)
FULL = ("qty", "lines", "disc")


def run(df) -> None:
    """Compute every row and column of a frame without collecting it."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", str(CPUS))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    times: dict[str, float] = {}

    def timed(name, action, runs=3):
        """The median of some runs; the first of them warms the path."""
        took = []
        for _ in range(runs):
            start = time.perf_counter()
            action()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 3)

    # The input of a run is a feature table, so that is made once, in one file per core.
    base = scratch_path(spark, "bench")

    def stored(name, df):
        timed(f"build_{name}", lambda: df.repartition(CPUS).write.parquet(f"{base}/{name}"), runs=1)
        return spark.read.parquet(f"{base}/{name}")

    orders = stored("orders", tables.orders_reg(spark, SF_DIR))
    test = split_rows(orders, "test")
    lasso = {"full": Model("lasso", FULL, GRID)}
    # Start the Python workers and let the JVM compile before anything is timed.
    run(fit.fit_bootstrap(orders, "y", lasso, n_boot=2))

    def whole(models, n_boot, sampling):
        records = fit.fit_bootstrap(orders, "y", models, n_boot=n_boot, sampling=sampling)
        ci_summary(metric_dist(records, test, "y")).collect()

    for n_boot in (20, 100):
        for sampling in ("exact", "poisson"):
            timed(f"lasso_cv_{sampling}_b{n_boot}", lambda: whole(lasso, n_boot, sampling))
    timed("three_methods_b100", lambda: whole(
        {m: Model(m, FULL, GRID if m == "lasso" else None) for m in ("linear", "lasso", "ridge")},
        100, "exact"))

    # The stages of one run, each from the tables up to its own result.
    prepared = {}
    timed("stage_prepare", lambda: prepared.update(p=fit.prepare(orders, "y", lasso, n_boot=20)))
    p = prepared["p"]
    timed("stage_dense_index", lambda: run(dense_index(p.rows.select("row_id"), p.stats)))
    timed("stage_cell_counts_b20", lambda: run(rs.cell_counts(spark, p.seeds, p.stats.n, p.k)))
    timed("stage_weights_b20", lambda: run(rs.resample_weights(p.rows, p.stats, p.seeds)))
    timed("stage_moments_b20", lambda: run(p.moments()))
    timed("stage_solve_b20", lambda: run(p.solved()))

    # Scoring from records that are there already.
    records = spark.createDataFrame(fit.to_records(p).collect(), fit.RECORD)
    timed("metrics_b20", lambda: run(metric_dist(records, test, "y")))
    timed("metrics_rows_b20", lambda: run(metric_dist(records, test, "y", via="rows")))
    timed("predict_b20", lambda: run(predict(records, test)))
    timed("bagged_predict_b20", lambda: run(bagged_predict(records, test)))
    timed("selection_freq_b20", lambda: selection_freq(coef_table(records)).collect())

    for m in (50, 100, 300):
        wide = stored(f"orders_m{m}", tables.orders_expanded(spark, SF_DIR, m))
        models = {"wide": Model("lasso", None, GRID)}
        for sampling in ("exact", "poisson"):
            timed(f"lasso_cv_{sampling}_m{m}_b20",
                  lambda: run(fit.fit_bootstrap(wide, "y", models, n_boot=20, sampling=sampling)))

    # Gram matrices that go through the tasks in several batches of seeds.
    wide = stored("orders_m1000", tables.orders_expanded(spark, SF_DIR, 1000))
    timed("linear_exact_m1000_b20", lambda: run(fit.fit_bootstrap(
        wide, "y", {"wide": Model("linear")}, n_boot=20)), runs=1)

    # About as many columns out of one-hot levels.
    levels = stored("orders_levels", tables.orders_levels(spark, SF_DIR).join(
        spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr(
            "CAST(o_orderkey AS LONG) AS row_id", "concat('c', o_custkey % 990) AS customer"), "row_id"))
    sparse = {}
    timed("one_hot_m1000", lambda: sparse.update(s=one_hot(
        levels, "y", ["qty", "lines", "disc"], [("orderstatus",), ("priority",), ("customer",)])), runs=1)
    timed("moments_one_hot_m1000_b20", lambda: run(fit.prepare(
        sparse["s"], "y", {"wide": Model("linear")}, n_boot=20).tiles()))
    timed("linear_one_hot_m1000_b20", lambda: run(fit.fit_bootstrap(
        sparse["s"], "y", {"wide": Model("linear")}, n_boot=20)), runs=1)

    # Gram matrices in tiles, and a solver over them.
    timed("linear_tiles_m4000_b2", lambda: run(fit.fit_bootstrap(
        tables.part_wide(spark, SF_DIR, 4000), "y", {"wide": Model("linear")}, n_boot=2, k=1)), runs=1)

    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
