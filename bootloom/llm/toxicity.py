"""Toxic passages by maximum-scoring segments of token log-odds.

Every token's score is its log-odds between toxic and other labelled texts, shrunk by a Dirichlet prior that gives
it some texts at the common rate; what speaks for a clean text is negative and counts too. A linear scan finds
every maximal segment of a text, and extreme-value statistics say how far a segment's score is beyond what clean
text of that length has. A logistic curve over these, fitted on the labelled texts, gives the document's score. A
labelled text is measured by the counts of the others, without its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import common
from .textops import ALNUM, LOWER, find_words, hash_spans, signed, slices, text_bytes

FIT_ROWS = 100_000   # labelled rows that are fitted on, a hash sample where there are more; and as many
FIT_TOKENS = 1 << 23  # as keep the sample's distinct tokens at this or fewer (halved until they are)
PRIOR = 10.0         # texts at the common rate that every token is given
DRIFT = 0.5          # what every token costs a segment
EULER = 0.5772156649
FEATURES = 4


@dataclass
class Model:
    """Sorted token hashes with the numbers of toxic and clean texts that hold them, the null distribution's
    parameters, and the curve."""

    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    rate: float = 0.5       # share of toxic ones in all (token, text) pairs
    decay: float = 1.0
    scale: float = 1.0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))

    def odds(self, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
        """Shrunken log-odds of tokens in so many toxic and clean texts; 0 without any."""
        return np.log((toxic + PRIOR * self.rate) / (clean + PRIOR * (1 - self.rate))) - math.log(
            self.rate / (1 - self.rate))

    def scores(self, h: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Log-odds of tokens, by hash; ``own`` is the label of the text each is in, if the text was counted."""
        key, inverse = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.tokens, key), len(self.tokens) - 1)
        known = self.tokens[at] == key
        toxic, clean = (np.where(known, x[at], 0).astype(float) for x in (self.toxic, self.clean))
        if own is None:
            return self.odds(toxic, clean)[inverse]
        return self.odds(np.maximum(toxic[inverse] - own, 0), np.maximum(clean[inverse] - (1 - own), 0))

    def evidence(self, score: float, n: int) -> float:
        """-log of the expected number of clean segments of this score in n tokens."""
        return self.decay * score - math.log(self.scale * max(n, 1))


def maximal_segments(before: list[float], after: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, last) places of positive tokens, from the sums
    of all scores before and after each positive token. A segment knows the last one before it that begins
    lower, so none is looked at twice on the way back."""
    low, high, first, lower, last = [], [], [], [], []
    for i, (a, b) in enumerate(zip(before, after)):
        begin, j = i, len(low) - 1
        while True:
            while j >= 0 and low[j] >= a:
                j = lower[j]
            if j < 0 or high[j] >= b:
                break
            a, begin, to = low[j], first[j], j
            j = lower[j]
            for x in (low, high, first, lower, last):
                del x[to:]
        for x, value in zip((low, high, first, lower, last), (a, b, begin, j, i)):
            x.append(value)
    return [(b - a, f, e) for a, b, f, e in zip(low, high, first, last)]


def _tokens(batch):
    data, offs = text_bytes(batch.column("text"))
    data = LOWER[data]
    words = find_words(data, offs, ALNUM)
    return hash_spans(data, words.start, words.length), words


def segments_of(model: Model, h: np.ndarray, words, y: np.ndarray | None = None) -> list[list[tuple[float, int, int]]]:
    """By row: (score, first word, last word) of its maximal segments; ``y`` by row for texts that were counted."""
    out: list[list[tuple[float, int, int]]] = [[] for _ in range(len(words.first) - 1)]
    if not len(model.tokens) or not len(h):
        return out
    score = model.scores(h, None if y is None else y[words.doc]) - DRIFT
    hits = np.flatnonzero(score > 0)
    total = np.cumsum(score)
    rows = words.doc[hits]
    cut = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(hits) else []
    for a, b in zip(cut, np.append(cut[1:], len(hits)) if len(hits) else []):
        own, row = hits[a:b], rows[a]
        first = words.first[row]
        found = maximal_segments((total[own] - score[own]).tolist(), total[own].tolist())
        out[row] = [(s, int(own[i] - first), int(own[j] - first)) for s, i, j in found]
    return out


def features(model: Model, segments, n: int) -> tuple[float, float, float]:
    """Evidence of the best segment, summed evidence of the significant ones, and whether any is."""
    if not segments:
        return 0.0, 0.0, 0.0
    every = [model.evidence(s, n) for s, _, _ in segments]
    return (max(-20.0, min(50.0, max(every))), math.log1p(sum(max(0.0, e) for e in every)), 1.0)


def _labelled(docs: DataFrame, labels: DataFrame, label: str, fit: Column, most: int) -> DataFrame:
    """``(text, y)`` of some ``most`` rows to fit on; the labels are of bounded size, so they are sent."""
    rows = common.pick(labels, doc_id="doc_id", y=label).where("doc_id IS NOT NULL AND y IS NOT NULL")
    rows = rows.where(fit).groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y"))
    n = rows.count()
    if n > most:
        limit = int(2 ** 62 * (most / n))
        rows = rows.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 2) < limit)
    texts = common.pick(docs, doc_id="doc_id",
                        text=F.coalesce(common._column("text").cast("string"), F.lit("")))
    return texts.join(F.broadcast(rows), "doc_id").select("text", "y")


def token_counts(labelled: DataFrame) -> DataFrame:
    """``(token, a, b)``, written: in how many toxic and clean texts each token is."""
    def count(batches):
        for batch in slices(batches, "text"):
            h, words = _tokens(batch)
            y = batch.column("y").to_numpy()
            # texts that hold a token, so that one text repeating it counts once
            order = np.lexsort([words.doc, h])
            h, doc = h[order], words.doc[order]
            new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[:len(h)]
            key, inverse = np.unique(h[new], return_inverse=True)
            toxic = np.bincount(inverse, weights=y[doc[new]], minlength=len(key)).astype(np.int64)
            every = np.bincount(inverse, minlength=len(key))
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(toxic), pa.array(
                every - toxic)], names=["token", "toxic", "clean"])

    return common.stage(labelled.mapInArrow(count, "token long, toxic long, clean long").groupBy("token").agg(
        F.sum("toxic").cast("int").alias("a"), F.sum("clean").cast("int").alias("b")), "tokens")


def token_model(counts: DataFrame) -> Model:
    """A model without curve; ``FIT_TOKENS`` bounds what is fetched."""
    table = counts.toArrow()
    tokens = table["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    model = Model(tokens[order], *(table[c].to_numpy()[order] for c in ("a", "b")))
    toxic, clean = int(model.toxic.sum()), int(model.clean.sum())
    if not toxic or not clean:
        return Model()
    model.rate = toxic / (toxic + clean)
    model.decay = _decay(model.odds(model.toxic, model.clean) - DRIFT, model.clean / clean)
    return model


def _decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(x * score)) = 1 over clean tokens."""
    f = lambda x: float(np.sum(shares * np.exp(x * scores)) - 1)
    high = 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    low = high
    while f(low) >= 0 and low > 1e-6:
        low /= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic",
        rows: Column | None = None) -> Model:
    """A model from the labelled rows that ``rows`` (over doc_id) selects, all of them by default.

    Without both classes among them the score is the share of label 1. NULL and empty texts count as
    texts without tokens. Where labels repeat an id the largest label holds, and where documents repeat
    one, each of them is a text with its label. Labels with a NULL id, or of documents that are not there, and
    NULL labels are left out.
    """
    spark, most = docs.sparkSession, FIT_ROWS
    while True:
        labelled = common.stage(_labelled(docs, labels, label, F.lit(True) if rows is None else rows, most), "labelled")
        counts = token_counts(labelled)
        if counts.count() <= FIT_TOKENS or most <= 1:
            break
        most //= 2
    model = token_model(counts)
    shared = spark.sparkContext.broadcast(model)   # bounded by FIT_TOKENS

    def measure(batches):
        own = shared.value
        for batch in slices(batches, "text"):
            h, words = _tokens(batch)
            n = words.counts()
            found = segments_of(own, h, words, batch.column("y").to_numpy())
            best = [max((s for s, _, _ in x), default=0.0) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(n), pa.array(best), pa.array([[s for s, _, _ in x] for x in found],
                                                                          pa.list_(pa.float64()))],
                names=["y", "n", "best", "segments"])

    measured = common.stage(labelled.mapInArrow(measure, "y int, n long, best double, segments array<double>"), "measured")
    # at most FIT_ROWS rows of a few numbers
    null = measured.where("y = 0").select("n", "best").toPandas()
    if (null["best"] > 0).any():
        # Gumbel: the mean of decay * best - log(scale * n) is Euler's number; texts without a
        # positive token count as having the score 0
        model.scale = float(np.exp(np.mean(model.decay * null["best"] - np.log(np.maximum(null["n"], 1))) - EULER))

    def weigh(batches):
        for batch in batches:
            raw = [features(model_scale, [(s, 0, 0) for s in x], k) for x, k in zip(
                batch.column("segments").to_pylist(), batch.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("y"), *[pa.array([r[i] for r in raw], pa.float64())
                                                                   for i in range(FEATURES - 1)]],
                                             names=["y", "x0", "x1", "x2"])

    model_scale = Model(decay=model.decay, scale=model.scale)
    sample = measured.mapInArrow(weigh, "y int, x0 double, x1 double, x2 double").toPandas()
    model.curve = _logistic(sample[["x0", "x1", "x2"]].to_numpy(float), sample["y"].to_numpy(float))
    shared.unpersist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps for a logistic curve with a small ridge; constant where there is one class."""
    if not len(y) or y.min() == y.max():
        out = np.zeros(FEATURES)
        out[0] = 30.0 if len(y) and y[0] else -30.0
        return out
    z = np.column_stack([np.ones(len(y)), x])
    b = np.zeros(z.shape[1])
    ridge = np.diag([1e-9, 1e-2, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (y - p) - ridge @ b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return b


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          spans: bool = False) -> DataFrame:
    """The input rows as ``(doc_id, score, predicted)``, without a shuffle; with ``spans`` also
    ``passages``: first and last word, evidence of the significant segments. NULL and empty texts have no
    tokens and get the score of texts without a toxic token. Ids are only passed on."""
    df = common.pick(docs, doc_id=id_col, text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))
    kind = df.select("doc_id").schema.add("score", "double").add("predicted", "integer")
    passage = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("evidence", pa.float64())]))
    if spans:
        kind = kind.add("passages", T.ArrayType(T.StructType.fromDDL("first int, last int, evidence double")))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        own = shared.value
        for batch in slices(batches, "text"):
            h, words = _tokens(batch)
            n = words.counts()
            found = segments_of(own, h, words)
            z = np.array([(1.0, *features(own, x, int(k))) for x, k in zip(found, n)])
            p = 1 / (1 + np.exp(-np.clip(z @ own.curve, -30, 30)))
            columns = [batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            if spans:
                columns.append(pa.array([[{"first": a, "last": b, "evidence": own.evidence(s, int(k))}
                                          for s, a, b in x if own.evidence(s, int(k)) > 0]
                                         for x, k in zip(found, n)], passage))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted",
                                                             "passages"][:len(columns)])

    return df.mapInArrow(work, kind)


def is_toxic(model: Model, text: Column, threshold: float = 0.5) -> Column:
    """The verdict as a column, for filters that keep whole rows; NULL text counts as empty."""
    shared = SparkSession.active().sparkContext.broadcast(model)   # bounded by FIT_TOKENS

    @F.arrow_udf("boolean")
    def verdict(texts: pa.Array) -> pa.Array:
        own, out = shared.value, []
        for batch in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text"):
            h, words = _tokens(batch)
            z = np.array([(1.0, *features(own, x, int(k))) for x, k in zip(
                segments_of(own, h, words), words.counts())])
            out.append(1 / (1 + np.exp(-np.clip(z @ own.curve, -30, 30))) >= threshold)
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return verdict(F.coalesce(text.cast("string"), F.lit("")))


def held_out(column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels"), rows=~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
