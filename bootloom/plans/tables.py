"""Regression tables made from the test tables, as the queries and the bench use them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scratch import dealt
from ..sources.sparse import Sparse, one_hot
from .fit import Model

# Levels of the categorical columns.
ORDER_STATUS = ["F", "O", "P"]
ORDER_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

MODELS = {
    "reduced": Model("lasso", ("qty",), (5.0, 500.0, 5000.0)),
    "full": Model("lasso", ("qty", "lines", "disc"), (5.0, 500.0, 5000.0)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value explained by what is in the order; one row in five is a test row."""
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("double")).alias("qty"),
        F.count("*").cast("double").alias("lines"),
        F.avg(F.col("l_discount").cast("double")).alias("disc"),
        F.sum(price.cast("double")).alias("y"))
    orders = table(spark, sf_dir, "orders")
    zero = F.lit(0.0)
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").cast("long").alias("row_id"),
        *[F.coalesce(c, zero).alias(c) for c in ("qty", "lines", "disc", "y")],
        F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0).alias("test_set"))


def orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one-hot status and priority and two products: collinear on purpose."""
    levels = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("row_id"),
        *[(F.col("o_orderstatus") == s).cast("double").alias(f"orderstatus_{s}")
          for s in ORDER_STATUS],
        *[(F.col("o_orderpriority") == p).cast("double").alias(f"priority_{i}")
          for i, p in enumerate(ORDER_PRIORITY, start=1)])
    return (orders_reg(spark, sf_dir).join(levels, "row_id")
            .withColumn("qty_lines", F.col("qty") * F.col("lines"))
            .withColumn("qty_disc", F.col("qty") * F.col("disc")))


def orders_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with status and priority as they are, for sparse rows."""
    levels = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("row_id"), F.col("o_orderstatus").alias("orderstatus"),
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("priority"))
    return orders_reg(spark, sf_dir).join(levels, "row_id")


def part_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part price: one feature with signal (the key) and one without (the size)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("row_id"),
        F.col("p_partkey").cast("double").alias("partkey"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").cast("double").alias("y"))


def part_wide(spark: SparkSession, sf_dir: str, m: int) -> DataFrame:
    """Part price explained by m mixtures of the key and the size: wide, and of two dimensions. The rows are dealt
    by id while they are narrow."""
    return dealt(part_line(spark, sf_dir), "row_id").select("row_id", "y", *[
        F.expr(f"{math.cos(i)!r}D * partkey + {math.sin(i)!r}D * size").alias(f"mix_{i}") for i in range(m)])


def orders_one_hot(spark: SparkSession, sf_dir: str, split: str = "train", levels: Sparse | None = None) -> Sparse:
    """Order value by quantity, status and priority, as sparse rows."""
    return one_hot(orders_levels(spark, sf_dir), "y", ["qty"], [("orderstatus",), ("priority",)], split=split,
                   levels=levels)


def events_null(spark: SparkSession, sf_dir: str, event_types: list[str]) -> DataFrame:
    """Event values explained by type and hour: almost no signal."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("long").alias("row_id"),
        *[(F.col("event_type") == e).cast("double").alias(f"event_type_{e}") for e in event_types],
        F.hour("ts").cast("double").alias("hour"),
        F.col("value").cast("double").alias("y"))


def orders_expanded(spark: SparkSession, sf_dir: str, m: int) -> DataFrame:
    """`orders_reg` with m features: the three it has and waves over a mix of them."""
    mix = F.col("qty") + 1.618 * F.col("lines") + 31.4 * F.col("disc")
    return orders_reg(spark, sf_dir).select(
        "*", *[F.cos(mix * (0.137 * (i + 1))).alias(f"wave_{i}") for i in range(m - 3)])
