"""Hard negatives by inner product, searched in cover trees over norm-augmented vectors.

With one more component sqrt(M^2 - |x|^2) every candidate lies on a sphere of radius M, the largest norm, so a
large inner product with an anchor is a small distance to it, and the triangle inequality over a node's covering
radius bounds the inner products below the node from both sides.

The top level of the tree is a net of centres; each cell of it has trees of bounded size below, in which radii
halve from level to level. An anchor goes to the trees of cells whose bounds reach what it still wants, first to
those of its best cell, so that the others have a score to beat. In a tree nodes are taken best first, those
whose bounds are outside every window are skipped, and the rows of leaves are scored exactly, in integers.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import common

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
CENTRES = 256          # cells of the top level at most; fuller cells have several trees
TREE_ROWS = 4096       # rows of a tree, about, and anchors that meet it at once
NET_SAMPLE = 4096      # rows that the centres are chosen from; every row is indexed
LEAF = 64
AT_ONCE = 512          # rows of leaves that are scored together
TRIES = 32             # new centres in a row without company that end a net; the rest goes to leaves by distance
SALTS = 64
EXACT = float(1 << 53)


# ------------------------------------------------------------------ vectors

def pack_vector(v: np.ndarray) -> bytes:
    """Integers in 16 or 64 bits, whichever hold them; equal vectors have equal bytes."""
    narrow = not len(v) or (-32768 <= v.min() and v.max() <= 32767)
    return b"\x02" + v.astype("<i2").tobytes() if narrow else b"\x08" + v.astype("<i8").tobytes()


def unpack_vectors(raw: list[bytes]) -> np.ndarray:
    """(vectors x dimensions) integers; shorter ones end in zeros."""
    rows = [np.frombuffer(b, "<i2" if b[:1] == b"\x02" else "<i8", offset=1) for b in raw]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (a, b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b, however large the components."""
    a, b = _widened(a, b)
    most = math.sqrt(_squares(a).max(initial=0) * _squares(b).max(initial=0))
    if most < EXACT / 2:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


def _squares(a: np.ndarray) -> np.ndarray:
    return np.square(a.astype(float)).sum(axis=1)


def _augmented(a: np.ndarray, m2: float) -> np.ndarray:
    return np.sqrt(np.maximum(m2 - _squares(a), 0.0))


def _distances(a: np.ndarray, b: np.ndarray, m2: float) -> np.ndarray:
    """Distances between augmented candidates."""
    a, b = _widened(a, b)
    x, y = _augmented(a, m2), _augmented(b, m2)
    square = (_squares(a)[:, None] + _squares(b) - 2 * (a.astype(float) @ b.astype(float).T)
              + np.square(x[:, None] - y))
    return np.sqrt(np.maximum(square, 0.0))


def bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray, inner: np.ndarray, m2: float):
    """(lowest, highest) inner product of each anchor with what lies between the inner and the outer radius of each
    node, a little widened for rounding."""
    q, centres = _widened(q, centres)
    total = _squares(q)[:, None] + m2
    d = np.sqrt(np.maximum(total - 2 * (q.astype(float) @ centres.astype(float).T), 0.0))
    near = np.maximum(np.maximum(d - radius, inner - d), 0.0)
    slack = 1e-6 * total + 1e-3
    return (total - np.square(d + radius)) / 2 - slack, (total - np.square(near)) / 2 + slack


# ------------------------------------------------------------------ one tree

def build_tree(x: np.ndarray, m2: float) -> dict[str, np.ndarray]:
    """A cover tree over rows: ``order`` puts the rows of each node next to each other; node i has a centre (a row), the
    outer and inner radius about it, rows begin:end, and children first:last (none in a leaf)."""
    order = np.arange(len(x))
    nodes: list[list] = []

    def distances(rows, centre):
        return _distances(x[rows], x[centre:centre + 1], m2)[:, 0]

    def add(centre, begin, end, d):
        nodes.append([centre, d.max(initial=0.0), d.min(initial=np.inf), begin, end, 0, 0, False])

    add(0, 0, len(x), distances(order, 0))
    at = 0
    while at < len(nodes):
        centre, radius, _, begin, end, _, _, final = nodes[at]
        if end - begin > LEAF and radius > 0 and not final:
            rows, groups, alone = order[begin:end].copy(), [], 0
            c = centre if (rows == centre).any() else rows[0]
            while len(rows) and alone < TRIES:
                d = distances(rows, c)
                near = d <= radius / 2
                groups.append((c, rows[near], d[near], False))
                alone = alone + 1 if near.sum() < 4 else 0
                rows = rows[~near]
                c = rows[0] if len(rows) else c
            lone = [g for g in groups if len(g[1]) < 4]
            groups = [g for g in groups if len(g[1]) >= 4]
            rest = np.concatenate([rows, *[g[1] for g in lone]])
            d = distances(rest, centre)
            by = np.argsort(d, kind="stable")
            groups += [(centre, rest[by[i:i + LEAF]], d[by[i:i + LEAF]], True) for i in range(0, len(rest), LEAF)]
            nodes[at][5] = len(nodes)
            for c, own, d, last in groups:
                order[begin:begin + len(own)] = own
                add(c, begin, begin + len(own), d)
                nodes[-1][7] = last
                begin += len(own)
            nodes[at][6] = len(nodes)
        at += 1
    table = np.array([n[:7] for n in nodes], float)
    # radii a little wider, for rounding
    slack = 1e-6 * math.sqrt(m2) + 1e-9
    return {"order": order, "centre": table[:, 0].astype(np.int64), "radius": table[:, 1] + slack,
            "inner": np.maximum(table[:, 2] - slack, 0.0),
            **{c: table[:, i].astype(np.int64) for i, c in ((3, "begin"), (4, "end"), (5, "first"), (6, "last"))}}


class Tree:
    """Rows of a cell with labels and ids (up to ``POSITIVES + 1`` smallest ids a row), in the order of a cover tree."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: list[list[int]], m2: float):
        built = build_tree(vectors, m2)
        order = built.pop("order")
        self.__dict__.update(built)
        self.m2, self.centres = m2, vectors[self.centre]
        self.vectors, self.labels, self.ids = vectors[order], labels[order], [ids[i] for i in order]
        self.float_rows = self.vectors.astype(float)
        self.most = float(_squares(self.vectors).max(initial=0))

    def descend(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, windows: list[tuple], wanted, own=None):
        """For each window (lowest, highest score) the best ``(-score, id)`` of the rows that ``wanted(labels)`` selects,
        best first; ``low`` and ``high`` are the anchor's bounds of all nodes. ``own`` is an id left out. Leaves are
        scored some ``AT_ONCE`` rows at a time, so that what they hold raises the floor for the next."""
        found: list[list[tuple]] = [[] for _ in windows]
        exact = math.sqrt(float(_squares(q[None])[0]) * self.most) < EXACT / 2
        floor, most = (np.array(x, float if exact else object) for x in zip(*windows))
        top, keep = float(most.max()), NEGATIVES if own is None else POSITIVES
        point = q.astype(float)

        def alive(nodes):
            return ((high[nodes, None] >= floor) & (low[nodes, None] <= most)).astype(bool).any(axis=1)

        heap = [(-min(high[0], top), 0)]
        while heap:
            leaves, rows = [], 0
            while heap and rows < AT_ONCE:
                bound, node = heapq.heappop(heap)
                if -bound < floor.min():
                    heap = []
                elif self.last[node] > self.first[node]:
                    kids = np.arange(self.first[node], self.last[node])
                    kids = kids[alive(kids)]
                    for pair in zip(np.negative(np.minimum(high[kids], top)).tolist(), kids.tolist()):
                        heapq.heappush(heap, pair)
                else:
                    leaves.append(node)
                    rows += self.end[node] - self.begin[node]
            leaves = np.array(leaves, np.int64)
            leaves = leaves[alive(leaves)]
            if not len(leaves):
                continue
            at = np.concatenate([np.arange(a, b) for a, b in zip(self.begin[leaves], self.end[leaves])])
            at = at[wanted(self.labels[at])]
            scores = self.float_rows[at] @ point if exact else products(q[None], self.vectors[at])[0]
            for j in range(len(windows)):
                hit = np.flatnonzero(((scores >= floor[j]) & (scores <= most[j])).astype(bool))
                if len(hit) > keep + 1:   # one more, as a row may be the anchor's own
                    hit = hit[scores[hit] >= np.sort(scores[hit])[-keep - 1]]
                if not len(hit):
                    continue
                more = [(-int(scores[i]), k) for i in hit for k in self.ids[at[i]]
                        if k != own or not scores_own(self.vectors[at[i]], q)]
                found[j] = heapq.nsmallest(keep, found[j] + more)
                if len(found[j]) == keep:
                    floor[j] = max(floor[j], -found[j][-1][0])
        return found


def scores_own(v: np.ndarray, q: np.ndarray) -> bool:
    """Whether a row's vector is the anchor's."""
    v, q = _widened(v[None], q[None])
    return bool((v == q).all())


# ------------------------------------------------------------------ tables

def prepared(embeddings: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """``(id, label, vector)`` of the rows that take part, ``vector`` packed; equal rows once."""
    v = common._column(vector_col)
    rows = common.pick(embeddings, id=common._column(id_col).cast("long"), label=label.cast("long"), v=v)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    whole = F.transform("v", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))

    def pack(batches):
        for batch in batches:
            lists = batch.column("v")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"),
                 pa.array([pack_vector(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                names=["id", "label", "vector"])

    return rows.select("id", "label", whole.alias("v")).mapInArrow(
        pack, "id long, label long, vector binary").distinct()


def candidate_points(rows: DataFrame) -> DataFrame:
    """``(label, vector, ids)``: copies of a vector under one label are one point with its smallest ids. As ties go
    by id, no search can return more of them; copies are cut down by salted groups before they meet."""
    at_most = POSITIVES + 1
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for keys in (["label", "vector", "salt"], ["label", "vector"]):
        salted = salted.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).where(
            F.col("k") <= at_most)
    return salted.groupBy("label", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def net(vectors: np.ndarray, m2: float, most: int) -> np.ndarray:
    """Centres that are far from each other: each next one is the row farthest from those before."""
    chosen, nearest = [0], _distances(vectors, vectors[:1], m2)[:, 0]
    while len(chosen) < most and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(vectors, vectors[chosen[-1]:chosen[-1] + 1], m2)[:, 0])
    return vectors[chosen]


class Index:
    """The top level on the driver (at most ``CENTRES`` cells), and the written tables of points by cell and tree."""

    def __init__(self, points: DataFrame):
        spark = points.sparkSession
        points = common.stage(points, "points")

        def norms(batches):
            for batch in batches:
                v = unpack_vectors(batch.column("vector").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(_squares(v))], names=["n2"])

        total = points.select("vector").mapInArrow(norms, "n2 double").agg(F.count("*"), F.max("n2")).first()
        self.n, self.m2 = int(total[0]), float(total[1] or 0.0)
        if not self.n:
            return
        sample = points.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(NET_SAMPLE).toPandas()
        self.centres = centres = net(unpack_vectors(sample["vector"].tolist()), self.m2,
                                     min(CENTRES, -(-self.n // TREE_ROWS)))
        m2 = self.m2

        def assign(batches):
            for batch in batches:
                d = _distances(unpack_vectors(batch.column("vector").to_pylist()), centres, m2)
                cell = d.argmin(axis=1) if batch.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(cell)), cell]), *batch.columns],
                    names=["cell", "d", *batch.schema.names])

        self.points = common.stage(points.mapInArrow(
            assign, "cell int, d double, label long, vector binary, ids array<long>"), "cells")
        cells = self.points.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("r")).toPandas()
        self.radius = np.zeros(len(centres))
        self.trees = np.zeros(len(centres), np.int64)
        at = cells["cell"].to_numpy(np.int64)
        self.radius[at] = cells["r"].to_numpy(float) + 1e-6 * math.sqrt(m2) + 1e-9
        self.trees[at] = -(-cells["n"].to_numpy(np.int64) // TREE_ROWS)
        number = spark.createDataFrame([(int(c), int(t)) for c, t in enumerate(self.trees)], "cell int, trees long")
        self.points = self.points.join(F.broadcast(number), "cell").select(
            "cell", F.pmod(F.xxhash64("vector", "label"), F.col("trees")).alias("tree"), "label", "vector", "ids")

    def search(self, anchors: DataFrame, first: bool | None, result: str, look) -> DataFrame:
        """``look(tree, anchors, low, high)`` for each tree and the anchors whose windows its cell's bounds reach.

        ``anchors`` has ``aid``, ``vector``, ``low``, ``high`` (the scores that matter) and what ``look`` reads.
        ``first`` picks an anchor's best cell alone (True), all but that (False), or all (None).
        """
        centres, radius, trees, m2 = self.centres, self.radius, self.trees, self.m2
        kind = anchors.schema
        names = kind.names

        def route(batches):
            for batch in batches:
                q = unpack_vectors(batch.column("vector").to_pylist())
                low, high = bounds(q, centres, radius, np.zeros(len(centres)), m2)
                high = np.where(trees > 0, high, -np.inf)
                hit = (high >= batch.column("low").to_numpy()[:, None]) & (
                    low <= batch.column("high").to_numpy()[:, None])
                if first is not None and batch.num_rows:
                    best = np.zeros_like(hit)
                    best[np.arange(len(q)), high.argmax(axis=1)] = True
                    hit &= best if first else ~best
                row, cell = np.nonzero(hit)
                row, cell, count = np.repeat(row, trees[cell]), np.repeat(cell, trees[cell]), trees[cell]
                tree = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                own = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(tree), *own.columns],
                                                 names=["of", "at", *names])

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind.fields)
        routed = common.stage(anchors.mapInArrow(route, f"of int, at long, {fields}"), "routed")
        # a tree meets anchors in blocks of bounded size
        blocks = routed.groupBy("of", "at").agg(F.count("*").alias("n"))
        blocks = blocks.select("of", "at", F.ceil(F.col("n") / TREE_ROWS).alias("blocks"))
        routed = routed.join(blocks, ["of", "at"]).withColumn("block", F.pmod(F.xxhash64("aid"), F.col("blocks")))
        met = self.points.join(blocks.select(F.col("of").alias("cell"), F.col("at").alias("tree"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part")), ["cell", "tree"])

        def work(left, right):
            table = left.to_pydict()
            rows = right.to_pylist()
            if not rows or not left.num_rows:
                return schema.empty_table()
            tree = Tree(unpack_vectors(table["vector"]), np.array(table["label"], np.int64), table["ids"], m2)
            q = unpack_vectors([r["vector"] for r in rows])
            low, high = bounds(q, tree.centres, tree.radius, tree.inner, m2)
            wide = _widened(q, tree.vectors)[0]
            tree.float_rows, tree.vectors = (_widened(x, wide)[0] for x in (tree.float_rows, tree.vectors))
            out = [x for i, r in enumerate(rows) for x in look(tree, wide[i], r, low[i], high[i])]
            return pa.table([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

        schema = to_arrow_schema(StructType.fromDDL(result))
        return met.groupBy("cell", "tree", "part").cogroup(routed.groupBy("of", "at", "block")).applyInArrow(work, result)


def _best(df: DataFrame, keys: list[str], score: str, tie: str, most: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= most)


def hard_negatives(embeddings: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` selects anchors by ``id``. Vectors are floor(256 x). An anchor's positives are its best
    ``POSITIVES`` other rows of the same label; for each, the best ``NEGATIVES`` rows of other labels score between
    ``LOW_PERCENT`` percent and all of the positive's score. Equal scores go by id.

    Rows with a NULL id or label, a NULL vector or a component that is NULL or not finite take no part. Equal rows are
    one row; other rows that share an id are rows (and anchors) of their own. A vector that is shorter than another
    ends in zeros, and an empty one scores 0 with all. A negative positive score has an empty window. Other columns
    are left out. Every row is indexed; only the top level's centres come from a sample of ``NET_SAMPLE`` rows, and
    no row's result depends on them.
    """
    spark = embeddings.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = common.stage(prepared(embeddings, id_col, label, vector_col), "rows")
    index = Index(candidate_points(rows))
    if not index.n:
        return spark.createDataFrame([], result)
    asked = rows.where(anchors).select(
        F.monotonically_increasing_id().alias("aid"), F.col("id").alias("anchor_id"), "label", "vector",
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
    asked = common.stage(asked, "anchors")

    def positives(tree, q, row, low, high):
        own, mine = row["label"], row["anchor_id"]
        found = tree.descend(q, low, high, [(row["low"], math.inf)], lambda labels: labels == own, mine)[0]
        return [(row["aid"], mine, -s, i) for s, i in found]

    kind = "aid long, anchor_id long, positive_score long, positive_id long"
    early = common.stage(index.search(asked, True, kind, positives), "early")
    beat = _best(early, ["aid"], "positive_score", "positive_id", POSITIVES, "k").where(F.col("k") == POSITIVES).select(
        "aid", F.col("positive_score").cast("double").alias("beat"))
    later = asked.join(beat, "aid", "left").withColumn("low", F.coalesce("beat", "low")).drop("beat")
    late = index.search(later, False, kind, positives)
    chosen = common.stage(_best(early.unionByName(late), ["aid"], "positive_score", "positive_id", POSITIVES, "j"),
                          "positives")

    score = F.col("positive_score")
    windows = chosen.where(score >= 0).groupBy("aid").agg(
        F.array_sort(F.collect_list(F.struct("j", "positive_id", "positive_score"))).alias("positives"),
        (F.floor(F.min(score) * (LOW_PERCENT / 100.0)) - 1).cast("double").alias("low"), F.max(score).cast("double").alias("high"))
    seeking = asked.drop("low", "high").join(windows, "aid")

    def negatives(tree, q, row, low, high):
        own, pairs = row["label"], row["positives"]
        spans = [(-(-LOW_PERCENT * p["positive_score"] // 100), p["positive_score"]) for p in pairs]
        found = tree.descend(q, low, high, spans, lambda labels: labels != own)
        return [(row["aid"], p["j"], row["anchor_id"], p["positive_id"], p["positive_score"], -s, i)
                for p, best in zip(pairs, found) for s, i in best]

    mined = index.search(seeking, None, "aid long, j int, anchor_id long, positive_id long, positive_score long, "
                                        "negative_score long, negative_id long", negatives)
    return _best(mined, ["aid", "j"], "negative_score", "negative_id", NEGATIVES, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(common.table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


ORACLE = r"""
WITH e AS MATERIALIZED (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))), 0) = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, a.label AS own, b.id, b.label,
  list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE label <> own AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
