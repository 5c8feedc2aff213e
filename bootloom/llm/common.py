"""Reading, row keys and intermediate tables shared by the corpus operators."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scratch import ROW_GROUP, scratch_path, settings

BATCH_ROWS = 512
BATCH_BYTES = 4 << 20
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What holds while an intermediate table is written: few texts at a time go to Python workers, as a text can be
#: long, and Spark removes the shuffle files of the write when it has ended.
WRITING = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
           "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Scratch folders made within the innermost ``passing`` of this thread.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: the plan so far runs once, and a
    lost executor costs no more than the tasks it was running."""
    return _written(df, folder(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with settings(spark, WRITING):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, name: str) -> str:
    """A new scratch folder; it goes with the ``passing`` around it, else with the application."""
    path = scratch_path(spark, name)
    if _made.get() is not None:
        _made.get().append(path)
    return path


@contextmanager
def passing(spark: SparkSession):
    """Scratch folders made within go at the end, and no others."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settled(spark: SparkSession, name: str, build) -> DataFrame:
    """The rows of ``build()`` in a written table, without the scratch folders behind them."""
    path = folder(spark, name)
    with passing(spark):
        return _written(build(), path)


def local(spark: SparkSession, rows: pd.DataFrame, schema: str) -> DataFrame:
    """A table of the driver's rows. They go as Arrow data: lists of rows would pass Python workers of another kind
    than those of the corpus operators, which stay on the executors like these."""
    return spark.createDataFrame(pa.Table.from_pandas(rows, preserve_index=False), schema)


def pick(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the wanted columns under own names, so that no other column can clash."""
    return df.select(*[(_column(c) if isinstance(c, str) else c).alias(n)
                       for n, c in columns.items()])


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """``(uid, id, text)``: ``uid`` is a unique long in the order of the ids. With ``whole``
    also ``row``, a struct of all input columns.

    Unique integer ids are used as they are. Where ids repeat, are NULL or are no integers, rows
    are numbered by (id with NULL first, hash of the text) once, in a written table, so each
    row counts as a document of its own and later scans agree on its number. NULL text is "".
    """
    names = ["id", "text", *(["row"] if whole else [])]
    df = pick(docs, id=id_col, text=F.coalesce(_column(text_col).cast("string"), F.lit("")),
              row=F.struct(*[_column(c) for c in docs.columns])).select(*names)
    if isinstance(df.schema["id"].dataType, INTEGERS):
        bad = df.groupBy("id").count().where("count > 1 OR id IS NULL")
        if bad.isEmpty():
            return df.select(F.col("id").cast("long").alias("uid"), *names)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    return stage(df.repartitionByRange(parts(df.sparkSession), *order)
                 .sortWithinPartitions(*order, "text")
                 .select(F.monotonically_increasing_id().alias("uid"), *names), "numbered")
