"""Connected components of a table of links, in rounds that end as stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that is not the smallest of its component.

    ``links`` has two long columns. Each round hangs every node's larger neighbours on its
    smallest one, then every node and its smaller neighbours on the smallest of these; the number
    of rounds grows with the logarithm of the size. A round is written to the shared folder.
    """
    a, b = links.columns
    edges = common.stage(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(
            edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        root = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(root, "v")
        edges = common.stage(
            small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(root.select("v", F.col("m").alias("u"))).distinct(), "stars")
        last, state = state, _state(edges)
        if state == last:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")),
                           F.sum(F.xxhash64("u", "v") % 1000003)).first())
