"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_folders: dict[tuple[str, str], str] = {}
_local: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``,
    in one folder for the application.

    Only a local session, which has one machine by definition, may go without the
    setting; it then gets a folder of its own. Folders go when the driver's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local[0] if _local else tempfile.mkdtemp(prefix="bootloom-")
        _local[:] = [base]
    application = spark.sparkContext.applicationId
    if (base, application) not in _folders:
        _folders[base, application] = f"{base.rstrip('/')}/{application}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders[base, application])
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{_folders[base, application]}/{name}-{uuid.uuid4().hex}"


#: What holds while a table is written: Python workers get few MB of rows at a time, as rows can be wide, and Spark
#: removes the shuffle files of the write when it has ended.
WRITING = {"spark.sql.execution.arrow.maxBytesPerBatch": 2 << 20,
           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Session settings that are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Bytes of a row group: its writer and each of its readers hold one.
ROW_GROUP = 8 << 20


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows in a written table of their own: what is behind them runs once."""
    path = scratch_path(df.sparkSession, name)
    with settings(df.sparkSession, WRITING):
        df.write.option("parquet.block.size", ROW_GROUP).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Logical leaves that each pass may read anew: files, and rows that are part of the plan. A cached table is
# none, as blocks that were evicted are computed again.
STORED = {"LogicalRelation", "DataSourceV2ScanRelation", "HiveTableRelation", "LocalRelation", "Range",
          "OneRowRelation"}


def computed_once(df: DataFrame, name: str = "rows") -> DataFrame:
    """`df` itself if it is stored rows under filters and projections, dealt anew or not, which each pass may read
    anew; else (joins, aggregations, several inputs, cached tables) its rows in a written table."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter", "RepartitionByExpression"):
        plan = plan.children().head()
    return df if plan.nodeName() in STORED else staged(df, name)


# Rows of a partition, about: at least and at most.
DEALT_ROWS = 1 << 12, 1 << 18


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows in partitions by a key: enough to keep the cores busy, however few splits the files make."""
    n, (least, most) = df.count(), DEALT_ROWS
    tasks = max(min(3 * df.sparkSession.sparkContext.defaultParallelism, n // least), -(-n // most), 1)
    return df.repartition(tasks, key)


def is_dealt(df: DataFrame, key: str) -> bool:
    """Whether the rows are in partitions by this key alone."""
    kind = df._jdf.queryExecution().sparkPlan().outputPartitioning().toString()
    return re.fullmatch(rf"hashpartitioning\({re.escape(key)}#\d+L?, \d+\)", kind) is not None
