"""How filters on documents work together, for every order in which they could be applied.

A document is reduced to the set of filters it fails, a bit mask. Per part of the corpus there are at most 2^n
mask cells with counts. A walk over all subsets of filters in Gray-code order switches one filter at a time: each
cell counts its active failures, and the running survivors change by the cells whose counter leaves or comes
back to zero. Every order's every step is the difference of two of the 2^n stored states.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .textops import U, find_words, hash_spans, mix, slices, text_bytes

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 2
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|")] = True
DUPLICATE = 1 << FILTERS.index("E")


def _per_text(inside: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many bytes of each text are ``inside``."""
    upto = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=upto[1:])
    return np.diff(upto[offs])


def text_failures(array: pa.Array) -> np.ndarray:
    """Bits of the filters that look at one text alone (A to D), by text."""
    data, offs = text_bytes(array)
    words = find_words(data, offs)
    n = words.counts()
    h = mix(hash_spans(data, words.start, words.length) + mix(words.doc.astype(U) + U(1)))
    _, first = np.unique(h, return_index=True)
    distinct = np.bincount(words.doc[first], minlength=len(n))
    upper = _per_text((data >= 65) & (data <= 90), offs)
    points = _per_text((data & 0xC0) != 0x80, offs)
    fails = (n < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * upper > UPPER_PERCENT * points,
             _per_text(SYMBOLS[data], offs) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def document_failures(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``(doc_id, part, mask, digest)`` per row: failures of the text alone, and a 128-bit digest of it."""
    df = common.pick(docs, doc_id=id_col, part=F.coalesce(common._column(part_col).cast("string"), F.lit("")),
                     text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))

    def work(batches):
        for batch in slices(batches, "text"):
            data, offs = text_bytes(batch.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            digests = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(text_failures(batch.column("text"))),
                 pa.array(digests, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(work, f"doc_id {kind}, part string, mask int, digest binary")


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the set of filters they fail.

    A text fails E if its bytes are those of a row with a smaller id. Such rows aren't looked for one by one:
    per digest the rows of the smallest id are kept by aggregation, and a cell's others are all but these. So
    a text that a third of all rows hold is pre-aggregated, and nothing is joined back on it.
    """
    flags = common.pick(labels, doc_id="doc_id", good=(common._column("quality") == 1).cast("int"),
                        toxic=(common._column("toxic") == 1).cast("int")).where("doc_id IS NOT NULL")
    flags = flags.groupBy("doc_id").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("good", "toxic")])
    rows = document_failures(docs, id_col, text_col, part_col).join(flags, "doc_id", "left").select(
        "doc_id", "part", "mask", "digest", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    rows = common.stage(rows, "failures")
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    counted = [F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    every = rows.groupBy("part", "mask").agg(*counted)
    # rows of one id and text differ by part only
    same = (rows.where("doc_id IS NOT NULL").groupBy("digest", "doc_id", "part", "mask").agg(*counted)
            .groupBy("digest", "doc_id").agg(F.collect_list(F.struct("part", "mask", "n", "good", "toxic")).alias("c")))
    firsts = same.groupBy("digest").agg(F.min_by("c", "doc_id").alias("c")).selectExpr("inline(c)")
    passing = firsts.unionByName(rows.where("doc_id IS NULL").groupBy("part", "mask").agg(*counted))
    failing = every.unionByName(passing.select("part", "mask", *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")]))
    cells = passing.unionByName(failing.withColumn("mask", F.col("mask").bitwiseOR(F.lit(DUPLICATE))))
    return cells.groupBy("part", "mask").agg(*sums)


def gray_states(masks: np.ndarray, counts: np.ndarray, n_filters: int) -> np.ndarray:
    """``states[subset]``: sums of ``counts`` over the cells that pass all filters of the subset."""
    states = np.zeros((1 << n_filters, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    running, subset = counts.sum(axis=0), 0
    states[0] = running
    for step in range(1, 1 << n_filters):
        f = (step & -step).bit_length() - 1
        subset ^= 1 << f
        hit = (masks >> f & 1).astype(bool)
        if subset >> f & 1:
            running = running - counts[hit & (failing == 0)].sum(axis=0)
            failing += hit
        else:
            failing -= hit
            running = running + counts[hit & (failing == 0)].sum(axis=0)
        states[subset] = running
    return states


def order_steps(states: np.ndarray, names: str) -> dict[str, list]:
    """Columns of one row per order and step, from the states of all subsets."""
    n, full = len(names), len(states) - 1
    total = states[:, 0]
    alone = [int(total[full ^ 1 << f] - total[full]) for f in range(n)]
    shapley = [sum(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) * int(total[s] - total[s | 1 << f])
                   for s in range(full + 1) if not s >> f & 1) for f in range(n)]
    out: dict[str, list] = {c: [] for c in COLUMNS}
    for order in permutations(range(n)):
        before, name = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            values = (name, step, int(total[after]), removed, int(total[0] - total[1 << f]) - removed, alone[f],
                      good, toxic, shapley[f])
            for column, value in zip(out.values(), values):
                column.append(value)
            before = after
    return out


COLUMNS = {"filter_order": pa.string(), "step": pa.int32(), "kept": pa.int64(), "removed": pa.int64(),
           "redundant": pa.int64(), "unique_fails": pa.int64(), "good_lost": pa.int64(), "toxic_lost": pa.int64(),
           "shapley": pa.int64()}


def interactions(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """From ``(part, mask, n, good, toxic)``, bit i of ``mask`` for the i-th of ``names``: one row per part, order
    of the filters and step, with the counts of the audit. ``shapley`` is the filter's removals summed over
    all orders. A part is one row of at most 2^n cells, and its walk is independent of the others'."""
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def walk(batches):
        for batch in batches:
            for part, own in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                masks = np.array([c["mask"] for c in own], np.int64)
                counts = np.array([[c["n"], c["good"], c["toxic"]] for c in own], np.int64)
                columns = order_steps(gray_states(masks, counts, len(names)), names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(columns["step"])),
                     *[pa.array(columns[c], kind) for c, kind in COLUMNS.items()]], names=["part", *COLUMNS])

    return parts.mapInArrow(walk, "part string, filter_order string, step int, kept long, removed long, "
                                  "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    NULL texts are empty and equal to empty ones; a NULL part is "". A row with a NULL id never fails E and makes no
    other fail; rows of one id and text don't make each other fail, and count one by one. Where labels repeat an
    id, one that says so is enough; rows without labels are neither good nor toxic. Without documents there are
    no rows. Other columns are left out. Distinct words of a text are told apart by 64-bit hashes.
    """
    return interactions(failure_cells(docs, labels, id_col, text_col, part_col))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, (len(w) < 200)::INTEGER + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INTEGER
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INTEGER
  + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
  + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INTEGER AS m FROM d),
l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS g, max((toxic = 1)::INTEGER) AS x FROM labels
  WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS MATERIALIZED (SELECT part, m, count(*) AS n, sum(coalesce(g, 0)) AS g, sum(coalesce(x, 0)) AS x
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS MATERIALIZED (SELECT part, k, sum(CASE WHEN m & k = 0 THEN n ELSE 0 END) AS n,
  sum(CASE WHEN m & k = 0 THEN g ELSE 0 END) AS g, sum(CASE WHEN m & k = 0 THEN x ELSE 0 END) AS x
  FROM c, (SELECT unnest(range(32)) AS k) GROUP BY ALL),
a AS (SELECT unnest(range(5)) AS i),
o AS (SELECT [p.i, q.i, r.i, u.i, v.i] AS o FROM a p, a q, a r, a u, a v
  WHERE len(list_distinct([p.i, q.i, r.i, u.i, v.i])) = 5),
e AS MATERIALIZED (SELECT o, array_to_string(list_transform(o, lambda i: chr((65 + i)::INTEGER)), '') AS filter_order, step,
  o[step] AS i, list_sum(list_transform(o[1:step - 1], lambda i: (1 << i)::BIGINT)) AS b
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
z AS (SELECT filter_order, step, i, coalesce(b, 0)::BIGINT AS b, (coalesce(b, 0) + (1 << i))::BIGINT AS k,
  (1 << i)::BIGINT AS one FROM e),
r AS MATERIALIZED (SELECT y.part, filter_order, step, i, y.n AS kept, y0.n - y.n AS removed, f0.n - f1.n AS fails,
  n1.n - n0.n AS alone, y0.g - y.g AS good_lost, y0.x - y.x AS toxic_lost
  FROM z JOIN s y ON y.k = z.k JOIN s y0 ON y0.part = y.part AND y0.k = z.b
  JOIN s f0 ON f0.part = y.part AND f0.k = 0 JOIN s f1 ON f1.part = y.part AND f1.k = z.one
  JOIN s n0 ON n0.part = y.part AND n0.k = 31 JOIN s n1 ON n1.part = y.part AND n1.k = 31 - z.one)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
 (fails - removed)::BIGINT AS redundant, alone::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
 toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, i))::BIGINT AS shapley FROM r
"""
