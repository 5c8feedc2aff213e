"""Fit records: one JSON object per (model, seed), written, extended and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from . import commits

ENGINE_VERSION = "bootloom 0.1"

_NUMBERS = T.ArrayType(T.DoubleType())

RECORD = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("seed", T.LongType()),
    T.StructField("alpha", T.DoubleType()),
    T.StructField("random_state", T.IntegerType()),
    T.StructField("training_feats", T.StringType()),
    T.StructField("training_targets", T.StringType()),
    T.StructField("cv", T.IntegerType()),
    T.StructField("engine_version", T.StringType()),
    T.StructField("mse_min", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("coef", _NUMBERS),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("column_names", T.ArrayType(T.StringType())),
    T.StructField("settings", T.StringType()),  # what the fit was asked for, as JSON
])

# Other names a record may use for the same field.
SYNONYMS = {"training_feats": "training_data", "training_targets": "training_labels",
            "engine_version": "sklearn_version"}


def write_records(records: DataFrame, path: str) -> None:
    """Write JSON lines, one folder per model; an existing path is an error."""
    records.write.partitionBy("model").mode("errorifexists").json(path, ignoreNullFields=False)


def append_records(records: DataFrame, path: str, once: bool = False) -> int:
    """Add JSON lines to a record folder (made if absent) as one commit, and say how many. Runs can add at the same time.

    With ``once`` a (model, seed) that is committed already, by whomever, is left out. Readers see all of a commit or
    nothing of it.
    """
    spark = records.sparkSession
    commits.begin(spark, path)
    written = f"{path}/_adding-{uuid.uuid4().hex}"
    records.write.partitionBy("model").json(written, ignoreNullFields=False)
    while True:
        number, files = commits.committed(spark, path)
        added = _lines(spark, written, commits.data_files(spark, written))
        if once:
            held = _lines(spark, path, files).select("model", "seed")
            fresh = added.join(held, ["model", "seed"], "left_anti")
            if fresh.count() < added.count():
                again = f"{path}/_adding-{uuid.uuid4().hex}"
                fresh.select(added.columns).write.partitionBy("model").json(again, ignoreNullFields=False)
                commits.remove(spark, written)
                written, added = again, _lines(spark, again, commits.data_files(spark, again))
        n = added.count()
        if not n:
            commits.remove(spark, written)
            return 0
        names = commits.place(spark, written, path)
        if commits.commit(spark, path, number + 1, names):
            return n
        # another run has committed meanwhile: look again with its files
        added = _lines(spark, path, names)
        written = f"{path}/_adding-{uuid.uuid4().hex}"
        added.write.partitionBy("model").json(written, ignoreNullFields=False)
        for name in names:
            commits.remove(spark, f"{path}/{name}")


def _lines(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The lines of some files of a record folder."""
    if not files:
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("basePath", path).json([f"{path}/{f}" for f in files])


def read_records(spark: SparkSession, path) -> DataFrame:
    """Read a record file or folder with the fixed schema; older field names are accepted.

    Every record gets a (model, seed) of its own. Without a model it has the name of its file,
    or of the folder where the file is one of several parts; without a seed it has a negative
    number, unique in what is read but not the same from one reading to another. Of a folder that was
    appended to, the committed files are read.
    """
    extra = [T.StructField(other, T.StringType()) for other in SYNONYMS.values()]
    reader = spark.read.schema(T.StructType(RECORD.fields + extra))
    files = commits.committed(spark, path)[1] if isinstance(path, str) else None
    raw = reader.json(path) if files is None else (
        reader.option("basePath", path).json([f"{path}/{f}" for f in files]))
    file = F.regexp_replace("_metadata.file_path", "/part-[^/]*$", "")
    name = F.regexp_extract(file, r"([^/]+?)(?:\.[A-Za-z0-9]+)*/*$", 1)
    number = -1 - F.monotonically_increasing_id()
    own = {"model": F.when(F.col("model").isNotNull(), F.col("model")).when(F.lit(True), name),
           "seed": F.when(F.col("seed").isNotNull(), F.col("seed")).when(F.lit(True), number)}
    own |= {f: F.coalesce(f, other) for f, other in SYNONYMS.items()}
    return raw.select(*[own.get(f.name, F.col(f.name)).alias(f.name) for f in RECORD.fields])


def unique_records(records: DataFrame) -> DataFrame:
    """The records, with an error in the plan where (model, seed) repeats or a seed is missing:
    what is computed per replicate would mix them up."""
    copies = F.count("*").over(Window.partitionBy("model", "seed"))
    wrong = F.raise_error(F.concat(F.lit("records need a seed each, unique by model: "),
                                   F.coalesce("model", F.lit("NULL")), F.lit(", "),
                                   F.coalesce(F.col("seed").cast("string"), F.lit("NULL"))))
    return records.withColumn("_copies", copies).withColumn("seed", F.when(
        F.col("seed").isNull() | (F.col("_copies") > 1), wrong.cast("long")).otherwise(
        F.col("seed"))).drop("_copies")


def missing_seeds(spark: SparkSession, wanted: DataFrame, path: str) -> DataFrame:
    """The (model, seed) pairs of `wanted` that a record folder does not hold yet."""
    done = read_records(spark, path).select("model", "seed")
    return wanted.join(done, ["model", "seed"], "left_anti")


def as_json(records: DataFrame) -> DataFrame:
    """(model, seed, record): each record as the JSON text a sink writes."""
    return records.select("model", "seed", F.to_json(
        F.struct(*[f.name for f in RECORD.fields]), {"ignoreNullFields": "false"}).alias("record"))


def merge_records(spark: SparkSession, path: str, merged: str) -> None:
    """Rewrite a record folder as a single text file, for tools that read just one.

    Records are small (one per model and seed); reading them back never needs this.
    """
    as_json(read_records(spark, path)).select("record").coalesce(1).write.text(merged)
