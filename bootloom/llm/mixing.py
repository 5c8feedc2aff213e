"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document has the key -log(u) / w with u from a hash of its id and w its quality weight; the
documents of a source in ascending order of it are a weighted sample without replacement at any
length. A source's target is filled with whole epochs first, then with the documents whose running
sum of sizes fits the rest.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import common

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2.0
SEED = 20240607
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0.1 and 1: highest for texts whose words have about six characters on average."""
    return F.greatest(F.lit(0.1), F.exp(-F.abs(F.length(F.coalesce(text, F.lit(""))) / F.greatest(
        size, F.lit(1)) - 7) / 7))


def targets(sizes: pd.DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> pd.DataFrame:
    """Adds ``target`` to one row per source (``source``, ``size``).

    Sources in code point order, NULL last, have the weights in turn and share ``budget`` times all
    sizes. A target stops at ``most`` times its source's size; what is over is shared again by
    weight until none is above.
    """
    named = sizes[sizes["source"].notna()]
    order = [*sorted(named.index, key=lambda i: named["source"][i].encode()), *sizes.index[sizes["source"].isna()]]
    out = sizes.loc[order].reset_index(drop=True)
    weight = [weights[i % len(weights)] for i in range(len(out))]
    size = out["size"].astype(float).tolist()
    left, open_, target = budget * sum(size), set(range(len(out))), [0.0] * len(out)
    while open_:
        total = sum(weight[i] for i in sorted(open_))
        share = {i: left * weight[i] / total for i in open_}
        over = [i for i in sorted(open_) if share[i] > most * size[i]]
        for i in over or open_:
            target[i] = most * size[i] if over else share[i]
        if not over:
            break
        left -= sum(target[i] for i in over)
        open_ -= set(over)
    out["target"] = target
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weight: Column | None = None, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST,
        seed: int = SEED) -> DataFrame:
    """``(doc_id, size, source_size, target, epochs, taken)`` per row.

    ``size`` is the number of words (NULL text: 0). ``epochs`` says how often the mix holds the row,
    ``taken`` = epochs * size. NULL is a source of its own. Equal ids draw equal keys; they are
    ordered by size then. Sums are taken over ranges of the sorted keys, so that a source of any
    size is spread over tasks; the table of sources (one row each) is on the driver.
    """
    spark = docs.sparkSession
    text = common._column(text_col).cast("string")
    size = word_count(text)
    rows = common.pick(docs, doc_id=id_col, source=common._column(source_col).cast("string"), size=size,
                       weight=quality_weight(text, size) if weight is None else weight)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + 0.5) * F.lit(2.0 ** -53)
    rows = rows.select("doc_id", "source", "size", (-F.log(u) / F.col("weight")).alias("key"))
    order = [F.col("source").asc_nulls_last(), "key", "doc_id", "size"]
    rows = rows.repartitionByRange(common.parts(spark), *order).sortWithinPartitions(*order)
    part = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()),
                         T.StructField("before", T.LongType())])

    def running(batches):
        from pyspark import TaskContext
        last, total = (), 0
        for pdf in batches:
            source = pdf["source"].astype(object).where(pdf["source"].notna(), None)
            fresh = (source != source.shift()) & ~(source.isna() & source.shift().isna())
            if len(pdf):
                fresh.iloc[0] = (source.iloc[0],) != last
            sums = pdf["size"].cumsum() + (total if len(pdf) and not fresh.iloc[0] else 0)
            base = (sums - pdf["size"]).where(fresh).ffill().fillna(0)
            pdf["part"] = TaskContext.get().partitionId()
            pdf["before"] = (sums - pdf["size"] - base).astype("int64")
            if len(pdf):
                last, total = (source.iloc[-1],), int(pdf["before"].iloc[-1] + pdf["size"].iloc[-1])
            yield pdf

    ranged = common.stage(rows.mapInPandas(running, part), "ranged")
    # one row per source and range it reaches into: ranges and sources, not documents
    cells = ranged.groupBy("source", "part").agg(F.sum("size").alias("cell")).toPandas()
    cells = cells.sort_values("part", kind="stable")
    cells["offset"] = cells.groupby("source", dropna=False)["cell"].cumsum() - cells["cell"]
    sizes = targets(cells.groupby("source", dropna=False, as_index=False)["cell"].sum().rename(
        columns={"cell": "size"}), weights, budget, most)
    cells = cells.merge(sizes.rename(columns={"size": "source_size"}), on="source", how="left")
    cells["source"] = cells["source"].astype(object).where(cells["source"].notna(), None)
    small = common.local(spark, cells[["source", "part", "offset", "source_size", "target"]].rename(
        columns={"source": "s", "part": "p"}), "s string, p int, offset long, source_size long, target double")
    joined = ranged.join(small, ranged["source"].eqNullSafe(small["s"]) & (ranged["part"] == small["p"]))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    # the document in which the rest ends is taken if more than half of it fits
    extra = (F.col("offset") + F.col("before") + F.col("size") / 2.0 < rest).cast("long")
    return joined.withColumn("whole", whole).withColumn("epochs", F.col("whole") + extra).select(
        "doc_id", "size", "source_size", "target", F.col("epochs").cast("long").alias("epochs"),
        (F.col("epochs") * F.col("size")).cast("long").alias("taken"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))
