"""Predictions for sparse rows, without coefficients on the driver.

The coefficients that are not zero become inverted lists, feature -> (replicate, value), in parts of bounded size;
the rows become chunks of entries. Each chunk meets each part, as every row is wanted under every replicate, and in
a task an entry only meets the list of its own feature. A replicate without features keeps its intercept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.scratch import staged
from ..sources.sparse import Sparse
from .score import _kept

# Coefficients and replicates of a part, entries of a chunk of rows, about; products laid out at once in a task.
PART_COEFS, PART_REPLICATES = 1 << 20, 1 << 10
CHUNK_ENTRIES = 1 << 20
PRODUCTS = 1 << 21

LISTS = "part int, models array<string>, seeds array<long>, intercepts binary, feature binary, replicate binary, coef binary"
CHUNK = "chunk int, ids binary, ends binary, feature binary, value binary"


def _table(values: tuple, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def inverted_lists(records: DataFrame, names: list[str], shift: np.ndarray) -> tuple[DataFrame, int]:
    """``LISTS`` of a record table, written, and the number of parts. ``shift`` is what was taken off each column's
    values; it goes to the intercepts."""
    spark = records.sparkSession
    kept = _kept(records)
    known = spark.createDataFrame([(c,) for c in names], "feature string")
    unknown = kept.select(F.explode("column_names").alias("feature")).distinct().join(known, "feature", "left_anti")
    unknown = [r[0] for r in unknown.limit(5).collect()]
    if unknown:
        raise ValueError(f"the rows to score lack the features {unknown}")
    filled = F.filter(F.arrays_zip(F.col("column_names").alias("f"), F.col("coef").alias("c")), lambda e: e["c"] != 0)
    kept = kept.select("model", "seed", "intercept", filled.alias("e"))
    total = kept.agg(F.count("*"), F.sum(F.size("e"))).first()
    if not total[0]:
        raise ValueError("no records to work with")
    parts = max(-(-total[0] // PART_REPLICATES), -(-(total[1] or 0) // PART_COEFS))
    place = {c: i for i, c in enumerate(names)}
    schema = _arrow(LISTS)

    def invert(table: pa.Table) -> pa.Table:
        models, seeds = table["model"].to_pylist(), table["seed"].to_pylist()
        entries = table["e"].combine_chunks()
        feature = np.array([place[f] for f in entries.flatten().field("f").to_pylist()], np.int32)
        coef = entries.flatten().field("c").to_numpy(zero_copy_only=False).astype(float)
        owner = np.repeat(np.arange(len(seeds), dtype=np.int32), np.diff(entries.offsets.to_numpy()))
        intercept = table["intercept"].to_numpy() + np.bincount(owner, coef * shift[feature], len(seeds))
        order = np.argsort(feature, kind="stable")
        return _table((table["part"][0].as_py(), models, seeds, intercept.tobytes(), feature[order].tobytes(),
                       owner[order].tobytes(), coef[order].tobytes()), schema)

    kept = kept.withColumn("part", F.pmod(F.xxhash64("model", "seed"), F.lit(parts)).cast("int"))
    return staged(kept.groupBy("part").applyInArrow(invert, LISTS), "lists"), parts


def row_chunks(rows: Sparse) -> DataFrame:
    """``CHUNK`` of sparse rows, written: entries by row."""
    total = rows.rows.agg(F.sum(F.size("_i"))).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_ENTRIES))
    schema, row_id = _arrow(CHUNK), rows.row_id

    def pack(table: pa.Table) -> pa.Table:
        index, value = table["_i"].combine_chunks(), table["_v"].combine_chunks()
        ends = index.offsets.to_numpy().astype(np.int64)
        return _table((table["chunk"][0].as_py(), table[row_id].to_numpy().tobytes(), (ends - ends[0]).tobytes(),
                       index.flatten().to_numpy().astype(np.int32).tobytes(), value.flatten().to_numpy().tobytes()), schema)

    numbered = rows.rows.withColumn("chunk", F.pmod(F.xxhash64(row_id), F.lit(chunks)).cast("int"))
    return staged(numbered.groupBy("chunk").applyInArrow(pack, CHUNK), "chunks")


def predict_sparse(records: DataFrame, rows: Sparse, target: bool = False) -> DataFrame:
    """(model, row_id, seed, prediction[, target]): every sparse row under every replicate, as `score.predict` gives
    for the same table with all its columns. Features that a record has and the rows lack are an error."""
    spark, names = records.sparkSession, rows.names
    shift = np.array([0.0, *[rows.stats.means[c] for c in names[1:]]]) - rows.rest
    lists, parts = inverted_lists(records, names, shift)
    chunks = row_chunks(rows)
    # a part meets its chunks in several tasks
    salts = max(1, -(-3 * spark.sparkContext.defaultParallelism // parts))
    left = chunks.select("*", (F.col("chunk") % salts).alias("salt"),
                         F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("of"))
    right = lists.select(*[F.col(c).alias(f"l_{c}") for c in lists.columns],
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("l_salt"))
    met = left.join(right, (F.col("of") == F.col("l_part")) & (F.col("salt") == F.col("l_salt"))).drop(
        "of", "salt", "l_salt", "l_part")
    last, row_id = len(names) - 1, rows.row_id
    out = f"model string, `{row_id}` long, seed long, prediction double" + (f", `{names[-1]}` double" if target else "")
    columns = ["model", row_id, "seed", "prediction", *([names[-1]] if target else [])]

    def work(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                raw = {c: batch.column(c)[at] for c in batch.schema.names}
                array = lambda c, kind: np.frombuffer(raw[c].as_buffer(), kind)
                ids, ends = array("ids", np.int64), array("ends", np.int64)
                feature, value = array("feature", np.int32), array("value", float)
                models, seeds = pa.array(raw["l_models"].as_py(), pa.string()), np.array(raw["l_seeds"].as_py(), np.int64)
                intercept, own = array("l_intercepts", float), array("l_feature", np.int32)
                replicate, coef = array("l_replicate", np.int32), array("l_coef", float)
                begin = np.searchsorted(own, np.arange(last + 2))
                size, b = np.diff(begin)[feature], len(seeds)
                upto = np.append(0, np.cumsum(size))[ends]      # products before each row
                lo = 0
                while lo < len(ids):
                    room = np.searchsorted(upto, upto[lo] + PRODUCTS, "right") - 1
                    hi = int(max(lo + 1, min(room, lo + max(1, PRODUCTS // b), len(ids))))
                    e = slice(ends[lo], ends[hi])
                    count = size[e]
                    stop = np.cumsum(count)
                    k = np.repeat(begin[feature[e]] - stop + count, count) + np.arange(stop[-1] if len(stop) else 0)
                    row = np.repeat(np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1])), count)
                    p = np.bincount(row * b + replicate[k], coef[k] * np.repeat(value[e], count), (hi - lo) * b)
                    p = p.reshape(hi - lo, b) + intercept
                    data = [models.take(pa.array(np.tile(np.arange(b), hi - lo))), np.repeat(ids[lo:hi], b),
                            np.tile(seeds, hi - lo), p.ravel()]
                    if target:   # the last entry of a row is the target
                        data.append(np.repeat(value[ends[lo + 1:hi + 1] - 1] + shift[last], b))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in data], names=columns)
                    lo = hi

    return met.mapInArrow(work, out)
