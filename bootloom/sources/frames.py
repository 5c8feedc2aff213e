"""Loading, aligning and splitting the feature table and the target column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.scratch import WRITING, scratch_path, settings

# Names under which a saved row index appears in a feature or target file
# (a blank CSV header reads as `_c0`).
INDEX_NAMES = ("_c0", "Unnamed: 0", "index")
TEST_COLUMN = "test_set"
# Spark compiles aggregations of up to 100 fields; an average takes two.
CODEGEN_COLUMNS = 40
# Columns beyond which a row is packed outside of Spark's code for whole stages: that is one method with all of
# them, which takes the driver hundreds of MB for a few thousand columns.
COMPILED_COLUMNS = 500
ROW_ID = "row_id"


def read_table(spark: SparkSession, path: str, schema=None, row_id: str = ROW_ID,
               format: str | None = None) -> DataFrame:
    """Read a feature or target table from CSV (with header) or Parquet, which is told from
    the end of the path unless `format` says it.

    A saved row index becomes ``row_id`` and is never a predictor. Without one, rows are
    numbered in file order, which is how the two files correspond.
    """
    if format not in (None, "csv", "parquet"):
        raise ValueError(f"format must be csv or parquet, not {format!r}")
    parquet = format == "parquet" or format is None and path.rstrip("/").endswith(".parquet")
    if parquet:
        df = spark.read.parquet(path)
    else:
        reader = spark.read.option("header", True)
        df = (reader.schema(schema) if schema is not None
              else reader.option("inferSchema", True)).csv(path)
    if row_id not in df.columns:
        saved = [c for c in INDEX_NAMES if c in df.columns]
        df = (df.withColumn(row_id, F.col(f"`{saved[0]}`").cast("long")) if saved
              else number_indexed_rows(df, row_id) if parquet else number_rows(df, row_id))
    df = df.drop(*INDEX_NAMES)
    return df.select(row_id, *[f"`{c}`" for c in df.columns if c != row_id])


def number_indexed_rows(scan: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """The same for Parquet files, which know the number of each row in its file: only the files' row counts are
    taken, nothing is written, and the numbers do not depend on where a scan cuts the files."""
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    files = scan.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count("*").alias("_n")).select(
        "_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    return rows.join(files, F.col("_file") == F.col("_path")).withColumn(
        row_id, F.col("_before") + F.col("_at")).drop("_path", "_file", "_before", "_at")


def number_rows(scan: DataFrame, row_id: str = ROW_ID) -> DataFrame:
    """Number the rows of a file scan 0..n-1 in the order of files and of rows in them.

    The built-in increasing id numbers the rows of each file block without gaps, and the blocks'
    row counts say where a block begins. Both are taken from one scan, which is written to the
    scratch folder: a second scan may cut the files at other places.
    """
    path = scratch_path(scan.sparkSession, "numbered")
    scan.select("*", F.monotonically_increasing_id().alias("_id"),
                F.col("_metadata.file_path").alias("_path"),
                F.col("_metadata.file_block_start").alias("_start")).write.parquet(path)
    tagged = scan.sparkSession.read.parquet(path)
    # one row per file block
    blocks = tagged.groupBy("_path", "_start").agg(F.min("_id").alias("_first"),
                                                   F.count("*").alias("_n"))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_path", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0))
                                               - F.col("_first")).alias("_shift"))
    return (tagged.join(blocks, ["_path", "_start"])
            .withColumn(row_id, F.col("_id") + F.col("_shift"))
            .drop("_path", "_start", "_id", "_shift"))


def align(features: DataFrame, target: DataFrame, row_id: str = ROW_ID,
          check: bool = True) -> DataFrame:
    """Join the target to the features one to one on ``row_id``.

    ``check`` verifies that every id occurs exactly once on both sides. Either side is grouped by id,
    and the join needs that same grouping, so both are shuffled once; an id that is missing or
    repeated fails the job that reads the rows.
    """
    if not check:
        return features.join(target, row_id)

    def single(df, side):
        """One row per id: how many there were, and the other columns of one of them."""
        others = [f"`{c}`" for c in df.columns if c != row_id]
        return df.groupBy(row_id).agg(F.count("*").alias(f"_n_{side}"),
                                      F.first(F.struct(F.lit(1).alias("_there"), *others)).alias(f"_{side}"))

    joined = single(features, "features").join(single(target, "target"), row_id, "full")
    wrong = F.raise_error(F.concat(
        F.lit(f"features and target do not match one to one: {row_id} "),
        F.coalesce(F.col(row_id).cast("string"), F.lit("NULL")), F.lit(" is missing or repeated")))
    fits = (F.col("_n_features") == 1) & (F.col("_n_target") == 1) & F.col(row_id).isNotNull()
    return joined.where(F.when(fits, True).otherwise(wrong.cast("boolean"))).select(
        row_id, *[F.col(f"_{side}")[c].alias(c) for side, df in (("features", features), ("target", target))
                  for c in df.columns if c != row_id])


def split_rows(df: DataFrame, split: str = "train") -> DataFrame:
    """Keep the training rows, the test rows or (any other flag) all rows; drop the marker.

    A table without the marker column is used whole.
    """
    if TEST_COLUMN in df.columns and split in ("train", "test"):
        df = df.where(F.col(TEST_COLUMN) == (0 if split == "train" else 1))
    return df.drop(TEST_COLUMN)


def feature_names(df: DataFrame, target: str, row_id: str = ROW_ID) -> list[str]:
    """Every column that is neither the id, the target nor the split marker."""
    return [c for c in df.columns if c not in {row_id, target, TEST_COLUMN}]


def double_sql(name: str) -> str:
    """A column as a double, in SQL: one expression for many columns is one call."""
    return "CAST(`" + name.replace("`", "``") + "` AS DOUBLE)"


def as_double(name: str) -> Column:
    return F.expr(double_sql(name))


def packed(columns: list[str]) -> list[Column]:
    """The columns as one array of doubles, `_x`: one vector to hand to a task instead of
    many (nothing at all for no columns). Where there are many, the first goes through a higher-order function:
    code for whole stages has none, so executors compile the columns, in small methods, and the driver nothing."""
    x = list(map(double_sql, columns))
    if len(x) > COMPILED_COLUMNS:
        x[0] = f"transform(array({x[0]}), v -> v)[0]"
    return [F.expr(f"array({', '.join(x)})").alias("_x")] if x else []


def unpacked(batch, m: int) -> np.ndarray:
    """(rows x m) array of the `_x` of an Arrow batch or table; missing values are NaN."""
    x = batch.column("_x")
    if isinstance(x, pa.ChunkedArray):
        x = x.combine_chunks()
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, m)


@dataclass(frozen=True)
class FrameStats:
    """Size, id range and column means of a table, from one pass over it."""
    n: int
    min_id: int
    max_id: int
    means: dict[str, float]

    def centres(self, columns: list[str]) -> list[float]:
        return [self.means[c] for c in columns]


def frame_stats(df: DataFrame, columns: list[str], row_id: str = ROW_ID) -> FrameStats:
    """Count, id range and means; missing values are an error, as in any least-squares fit."""
    ids = df[row_id].cast("long") if row_id in df.columns else F.lit(0).cast("long")
    if len(columns) <= CODEGEN_COLUMNS:
        values = [as_double(c) for c in columns]
        # A sum is finite only if every one of its terms is.
        total = sum(values[1:], values[0]) if values else F.lit(0.0)
        missing = total.isNull() | F.isnan(total) | (F.abs(total) == float("inf"))
        row = df.agg(
            F.count("*").alias("n"), F.min(ids).alias("lo"), F.max(ids).alias("hi"),
            F.count(ids).alias("ids"), F.count_if(missing).alias("missing"),
            *[F.avg(v).alias(f"mean_{i}") for i, v in enumerate(values)]).first()
        n, lo, hi, known, bad = row["n"], row["lo"], row["hi"], row["ids"], row["missing"]
        means = [row[f"mean_{i}"] for i in range(len(columns))]
    else:
        n, lo, hi, known, bad, means = _wide_stats(df, columns, ids)
    if bad or known != n:
        raise ValueError(f"{bad} rows have a missing or infinite feature or target value and "
                         f"{n - known} have no {row_id}")
    if n == 0:
        raise ValueError("no rows to fit or score")
    return FrameStats(n, int(lo), int(hi), dict(zip(columns, means)))


def _wide_stats(df: DataFrame, columns: list[str], ids: Column):
    """The same for many columns: too many aggregates for compiled code in one row, so each
    task sums its batches as arrays and hands on one row per column."""
    m = len(columns)

    def reduce(batches):
        total, n, known, bad, lo, hi = np.zeros(m), 0, 0, 0, None, None
        for batch in batches:
            x = unpacked(batch, m)
            id_column = batch.column("id").drop_null().to_numpy()
            total += x.sum(axis=0)
            n, known = n + len(x), known + len(id_column)
            bad += int((~np.isfinite(x.sum(axis=1))).sum())
            if len(id_column):
                lo = min(int(id_column.min()), lo if lo is not None else int(id_column.min()))
                hi = max(int(id_column.max()), hi if hi is not None else int(id_column.max()))
        yield pa.RecordBatch.from_pydict({
            "j": np.arange(m, dtype=np.int32), "s": total, "n": np.full(m, n),
            "ids": np.full(m, known), "missing": np.full(m, bad),
            "lo": pa.array([lo] * m, pa.int64()), "hi": pa.array([hi] * m, pa.int64())})

    parts = df.select(ids.alias("id"), *packed(columns)).mapInArrow(
        reduce, "j int, s double, n long, ids long, missing long, lo long, hi long")
    with settings(df.sparkSession, WRITING):
        rows = parts.groupBy("j").agg(
            *[F.sum(c).alias(c) for c in ("s", "n", "ids", "missing")],
            F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("j").collect()
    if not rows:
        return 0, None, None, 0, 0, [0.0] * m
    first = rows[0]
    return (first["n"], first["lo"], first["hi"], first["ids"], first["missing"],
            [r["s"] / max(first["n"], 1) for r in rows])
