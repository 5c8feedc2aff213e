"""Feature tables whose columns are mostly zero, as (indices, values) by row: one-hot levels and their products.

A term is a tuple of columns. Its categorical columns make one feature per combination of their values; its
numeric columns multiply that feature. So ("status",) is a one-hot column, ("status", "priority") are the
combinations of two, ("status", "price") is a price of its own for each status. A missing value has no level: the row
has zeros there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scratch import computed_once
from .frames import ROW_ID, FrameStats, as_double, frame_stats, split_rows


@dataclass(frozen=True)
class Sparse:
    """Rows ``(row_id, _i, _v)``: the entries of (1, features, target) that are not zero, by column.

    ``names`` has "1", the features and the target. Numeric columns and the target are centred, as they are there in
    every row; ``rest`` is the mean that is left, zero for these. ``stats`` has the means of all as they were.
    """
    rows: DataFrame
    names: list[str]
    rest: np.ndarray
    stats: FrameStats
    row_id: str

    def places(self, names: list[str]) -> list[int]:
        place = {c: i for i, c in enumerate(self.names)}
        return [place[c] for c in names]

    def only(self, at: list[int]) -> DataFrame:
        """The rows with the columns ``at`` alone, numbered in that order (which must be ascending)."""
        if at == list(range(len(self.names))):
            return self.rows
        number = np.full(len(self.names), -1, np.int32)
        number[at] = np.arange(len(at))
        kind, row_id = self.rows.schema, self.row_id

        def pick(batches):
            for batch in batches:
                index, value = batch.column("_i"), batch.column("_v")
                ends = index.offsets.to_numpy()
                i, v = index.flatten().to_numpy(), value.flatten().to_numpy()
                kept = number[i] >= 0
                upto = np.append(0, np.cumsum(kept))[ends - ends[0]].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(row_id), pa.ListArray.from_arrays(upto, number[i[kept]]),
                     pa.ListArray.from_arrays(upto, v[kept])], names=kind.names)

        return self.rows.mapInArrow(pick, kind)


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _times(numbers: list[str]) -> Column:
    out = F.lit(1.0)
    for c in numbers:
        out = out * as_double(c)
    return out


def one_hot(df: DataFrame, target: str, numeric: list[str], terms: list[tuple[str, ...]], *, split: str = "train",
            row_id: str = ROW_ID, levels: "Sparse | None" = None) -> Sparse:
    """Sparse rows of a table with numeric and categorical columns.

    Features are ``numeric``, then the levels of each term in the order of their names, ``column_value`` joined by ":"
    (numeric factors by their name). ``levels`` takes names and centres from other rows, so that a test table has the
    columns of the training table; values that are not among them have no level. Missing or infinite
    numbers are an error, in ``numeric``, factors and target.
    """
    for term in terms:
        if all(_is_number(df, c) for c in term):
            raise ValueError(f"the term {term} has no categorical column")
    kinds = {c: _is_number(df, c) for term in terms for c in term}
    factors = [c for c, number in kinds.items() if number]
    wanted = list(dict.fromkeys([*numeric, target, *kinds]))
    marker = [c for c in ("test_set",) if c in df.columns]
    rows = computed_once(split_rows(df.select(F.col(row_id).cast("long").alias(row_id), *map(_quoted, wanted),
                                              *map(_quoted, marker)), split))
    stats = frame_stats(rows, list(dict.fromkeys([*numeric, *factors, target])), row_id)
    centre = dict(stats.means) if levels is None else levels.stats.means
    names, means = ["1", *numeric], [0.0] * (1 + len(numeric))
    entries = [F.struct(F.lit(0).alias("i"), F.lit(1.0).alias("v"))]
    entries += [F.struct(F.lit(i).alias("i"), (as_double(c) - F.lit(centre[c])).alias("v"))
                for i, c in enumerate(numeric, start=1)]
    every = {} if levels is None else {name: i for i, name in enumerate(levels.names)}
    for t, term in enumerate(terms):
        keys = [c for c in term if not kinds[c]]
        value = _times([c for c in term if kinds[c]])
        name = F.concat_ws(":", *[F.lit(c) if kinds[c] else F.concat(F.lit(f"{c}_"), _quoted(c).cast("string"))
                                  for c in term])
        there = F.lit(True)
        for c in keys:
            there = there & _quoted(c).isNotNull()
        rows = rows.withColumn(f"_name{t}", F.when(there, name)).withColumn(f"_value{t}", value)
        # one row per feature of the model, whose names each record and the driver hold
        found = rows.where(F.col(f"_name{t}").isNotNull()).groupBy(f"_name{t}").agg(
            F.sum(f"_value{t}").alias("s")).orderBy(f"_name{t}").collect()
        if levels is None:
            numbered = [(r[0], len(names) + i) for i, r in enumerate(found)]
            names += [r[0] for r in found]
            means += [r[1] / stats.n for r in found]
        else:
            numbered = [(r[0], every[r[0]]) for r in found if r[0] in every]
        table = df.sparkSession.createDataFrame(numbered, f"_name{t} string, _at{t} int")
        rows = rows.join(F.broadcast(table), f"_name{t}", "left")
        entries.append(F.when((F.col(f"_at{t}").isNotNull()) & (F.col(f"_value{t}") != 0), F.struct(
            F.col(f"_at{t}").alias("i"), F.col(f"_value{t}").alias("v"))))
    if levels is not None:
        names, means = levels.names[:-1], list(levels.rest[:-1])
    entries.append(F.struct(F.lit(len(names)).alias("i"), (as_double(target) - F.lit(centre[target])).alias("v")))
    held = F.filter(F.array(*entries), lambda e: e.isNotNull())
    rows = rows.select(row_id, held.alias("_e")).select(row_id, F.col("_e.i").alias("_i"), F.col("_e.v").alias("_v"))
    rest = np.array([*means, 0.0])
    whole = {c: centre.get(c, 0.0) + r for c, r in zip([*names, target], rest)} if levels is None else centre
    return Sparse(computed_once(rows), [*names, target], rest,
                  FrameStats(stats.n, stats.min_id, stats.max_id, whole), row_id)
