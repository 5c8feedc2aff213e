"""Quality rules, and robust multivariate outliers of text statistics.

Every text has a vector of transformed statistics. Location and scatter of its language and source
come from the three quarters of its vectors that have the smallest covariance determinant, found by
concentration steps from the medians until the determinant falls no more, each of them one sum over all rows
by group and distance class. Languages and the whole table have estimates too, and every estimate is drawn
towards the one above it, the less the more texts it rests on. A share or mean that is taken over few words or lines is known less well than one over many:
the scatter a text is held against is the one between texts and the counting error of the text's own
statistics. Vectors that are too far by their Mahalanobis distance are rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common
from .textops import SPACE, find_words, hash_spans, mix, ngram_starts, ngrams, slices, text_bytes

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NOT_LINE_END = np.ones(256, bool)
NOT_LINE_END[10] = False

KEPT_SHARE = 0.75   # of a group's vectors, the share that the estimates rest on
SETTLED = 1e-3      # a group is done when a step lowers its log determinant by less
BINS = 8            # distance classes for each doubling of 1 + squared distance
FEATURES = {        # transformed statistic
    "x0": "ln(word_chars / n_words)",
    "x1": "sqrt(n_symbols / word_chars)",
    "x2": "sqrt(n_dup_lines / greatest(n_lines, 1))",
    "x3": "sqrt(n_repeat_words / n_words)",
    "x4": "ln(n_words)",
}
# Variance of each statistic by counting alone: that of ln(mean) is cv^2 / n, of the root of a share 1 / (4 n), of
# the log of a count 1 / n. The symbols of a word come together, and so do the repeated words of a line.
COUNTS = {          # squared variation of a text's word lengths, and one over its words and lines
    "v": "greatest(word_squares * n_words / (CAST(word_chars AS double) * word_chars) - 1, 0)",
    "per_word": "1 / n_words",
    "per_line": "1 / greatest(n_lines, 1)",
}
ERRORS = "array({v} * per_word, per_word / 4, per_line / 4, per_line / 4, per_word)"
N = len(FEATURES)
PARENT = N * (N + 3) // 2   # texts that the estimate above counts as: the numbers in a location and scatter
NORMAL = 1 - 1e-6   # share of normal vectors within the cut


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, word_squares)`` per row; the last is the sum of squared word lengths. NULL text has no words."""
    df = common.pick(docs, doc_id=id_col, lang=common._column(lang_col).cast("string"),
                     source=common._column(source_col).cast("string"),
                     text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "word_squares"]
    kind = df.drop("text").schema
    for name in names:
        kind = kind.add(name, "long")

    def work(batches):
        for batch in slices(batches, "text"):
            data, offs = text_bytes(batch.column("text"))
            words = find_words(data, offs)
            h = hash_spans(data, words.start, words.length)
            inside = SPACE[data]
            lines = find_words(data, offs, NOT_LINE_END)
            filled = _sums(inside, np.stack([lines.start, lines.start + lines.length])) > 0
            line_doc = lines.doc[filled]
            key = mix(hash_spans(data, lines.start[filled], lines.length[filled])) + line_doc.astype(np.uint64)
            n = batch.num_rows
            chars = _sums((data & 0xC0) != 0x80, np.stack([words.start, words.start + words.length]))
            n_lines = np.bincount(line_doc, minlength=n)
            first = np.unique(key, return_index=True)[1]
            columns = [words.counts(), _sums(inside & ((data & 0xC0) != 0x80), np.stack([offs[:-1], offs[1:]])),
                       _sums(SYMBOLS[data], np.stack([offs[:-1], offs[1:]])),
                       n_lines - np.bincount(line_doc[first], minlength=n), _repeated(h, words, n), n_lines,
                       np.bincount(words.doc, weights=chars.astype(float) ** 2, minlength=n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), batch.column("source"),
                 *[pa.array(c.astype(np.int64)) for c in columns]],
                names=["doc_id", "lang", "source", *names])

    return df.mapInArrow(work, kind)


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return total[ends[1]] - total[ends[0]]


def _repeated(h: np.ndarray, words, rows: int) -> np.ndarray:
    """Words by row that are in a three-word window found twice or more in the row."""
    at = ngram_starts(words, 3)
    key = mix(ngrams(h, 3)[at]) + words.doc[at].astype(np.uint64)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = at[order[twice]]
    covered = np.zeros(len(h), bool)
    for i in range(3):
        covered[at + i] = True
    return np.bincount(words.doc[covered], minlength=rows)


def _chi2(x: float, k: int) -> float:
    """The chi-square distribution function for an odd k."""
    out = math.erf(math.sqrt(x / 2))
    for j in range(1, k, 2):
        out -= (x / 2) ** (j / 2) * math.exp(-x / 2) / math.gamma(j / 2 + 1)
    return out


def _quantile(share: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, k) < share else (low, mid)
    return high


def _beyond(d: float, n: int) -> float:
    """The share of normal vectors whose squared distance from estimates over n > N others is over d: a tail
    of the beta distribution, as Hotelling's T^2 has an F one."""
    x = d * n / (n * n - 1)
    left, c = 1 / (1 + x), (n - N) / 2
    w = (np.arange(20_000) + 0.5) / 20_000
    area = math.log(np.mean((1 - left * w ** (1 / c)) ** (N / 2 - 1)) / c) + c * math.log(left)
    return math.exp(area + math.lgamma(n / 2) - math.lgamma(N / 2) - math.lgamma(c))


def _cut(n: int) -> float:
    """The squared distance that NORMAL of all normal vectors are within, for estimates over n of them: the
    chi-square quantile, 35.9, where n is large; no distance is too large where n texts span no scatter."""
    if n > 1_000_000:
        return _quantile(NORMAL, N)
    if n <= N:
        return math.inf
    low, high = 0.0, 1.0
    while _beyond(high, n) > 1 - NORMAL:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if _beyond(mid, n) > 1 - NORMAL else (low, mid)
    return high


def _correction(share: float) -> float:
    """What the covariance of the innermost share of a normal sample is too small by."""
    return share / _chi2(_quantile(share, N), N + 2)


def _groups() -> list[Column]:
    """The names of a row's groups: all rows, its language, its language and source. NULL is one of its own."""
    name = lambda *columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return [F.lit("{}"), name("lang"), name("lang", "source")]


def _mahalanobis(x: pa.Array, mean: pa.Array, scatter: pa.Array, errors: pa.Array) -> pa.Array:
    flat = lambda column, *shape: column.flatten().to_numpy(zero_copy_only=False).reshape(-1, *shape)
    gap = flat(x, N) - flat(mean, N)
    cov = flat(scatter, N, N) + flat(errors, N)[:, :, None] * np.eye(N)
    return pa.array((gap * np.linalg.solve(cov, gap[:, :, None])[:, :, 0]).sum(axis=1))


def _distance() -> Column:
    """Squared Mahalanobis distance from columns x0.., per_word, per_line, mean, scatter (flat) and v_mean;
    rows without them have the distance 0."""
    vector = lambda sql, n, other: F.expr(f"IF(x0 IS NULL OR v_mean IS NULL, array_repeat({other}D, {n}), {sql})")
    return F.arrow_udf(_mahalanobis, "double")(vector(f"array({', '.join(FEATURES)})", N, 0), vector("mean", N, 0),
                                               vector("scatter", N * N, 0), vector(ERRORS.format(v="v_mean"), N, 1))


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and spreads from the quartiles."""
    third = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(N)]
    flat = ", ".join(f"pow((q{i}[2] - q{i}[0]) / 1.349, 2)" if i == j else "0D" for i in range(N) for j in range(N))
    return rows.groupBy("g").agg(*third, F.percentile_approx("v", 0.5, 1000).alias("v_mean"),
                                 F.count("*").alias("members")).select(
        "g", "members", F.expr(f"array({', '.join(f'q{i}[1]' for i in range(N))})").alias("mean"),
        F.expr(f"array({flat})").alias("scatter"), "v_mean", F.lit(math.inf).alias("fit"), F.lit(True).alias("moving"))


def _core(n: float) -> int:
    """Of n vectors, how many the estimates rest on; not all of them if there are two or more."""
    return max(1, math.floor(KEPT_SHARE * n))


def _between(cov: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """The scatter between texts: what their covariance has beyond the counting errors."""
    size, axes = np.linalg.eigh(cov - np.diag(errors))
    return (axes * np.maximum(size, 0)) @ axes.T


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: the estimates over the share of each moving group that is nearest to the last ones, where their
    determinant is smaller. Distances are sorted by classes; the class in which the share ends counts in part."""
    seen = rows.join(estimates.where("moving"), "g").withColumn("d", _distance())
    bins = seen.groupBy("g", F.least(F.floor(F.log2(1 + F.col("d")) * BINS), F.lit(1000)).cast("int").alias("b")).agg(
        F.count("*").alias("n"), *[F.sum(x).alias(f"s_{x}") for x in (*FEATURES, *COUNTS)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i in range(N) for j in range(i, N)])
    factor = _correction(KEPT_SHARE)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("b")
        n = pdf["n"].to_numpy(float)
        total = n.sum()
        share = np.clip((_core(total) - (np.cumsum(n) - n)) / n, 0, 1)
        take = (share * n).sum()
        mean = np.array([(share * pdf[f"s_{x}"]).sum() for x in FEATURES]) / take
        v, a, l = [(share * pdf[f"s_{x}"]).sum() / take for x in COUNTS]
        cov = np.zeros((N, N))
        for i in range(N):
            for j in range(i, N):
                cov[i, j] = cov[j, i] = (share * pdf[f"s{i}_{j}"]).sum() / take - mean[i] * mean[j]
        errors = np.array([v * a, a / 4, l / 4, l / 4, a])
        between = _between(cov * factor, errors)
        # bounded below by the counting errors, so every group settles
        fit = np.linalg.slogdet(between + np.diag(errors))[1]
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "mean": [mean.tolist()], "scatter": [between.ravel().tolist()],
                             "v_mean": [v], "fit": [fit]})

    found = bins.groupBy("g").applyInPandas(
        solve, "g string, mean array<double>, scatter array<double>, v_mean double, fit double")
    old, new = F.struct("mean", "scatter", "v_mean", "fit"), F.struct("n.mean", "n.scatter", "n.v_mean", "n.fit")
    last = estimates.select("g", "members", old.alias("old"))
    return last.join(found.select("g", F.struct("mean", "scatter", "v_mean", "fit").alias("n")), "g", "left").select(
        "g", "members", F.when(F.col("n.fit") < F.col("old.fit"), new).otherwise(F.col("old")).alias("e"),
        F.coalesce(F.col("n.fit") < F.col("old.fit") - SETTLED, F.lit(False)).alias("moving")).select(
        "g", "members", "e.*", "moving")


def _drawn(names: DataFrame, estimates: DataFrame) -> DataFrame:
    """``(g, mean, scatter, v_mean)`` of the last groups in ``names(g0, g1, g2)``: every estimate is the mean of the
    group's own, which counts as often as it has members, and of the drawn one above it, which counts PARENT times."""
    own = estimates.select("g", "members", "mean", "scatter", "v_mean")
    out = own.where("g = '{}'").select(F.col("g").alias("above"), "mean", "scatter", "v_mean")
    pull = f"(members * x + {PARENT} * y) / (members + {PARENT})"
    for i in (1, 2):
        links = names.select(F.col(f"g{i - 1}").alias("above"), F.col(f"g{i}").alias("g")).distinct()
        up = links.join(out.toDF("above", "m", "s", "w"), "above").drop("above")
        out = own.join(up, "g").select(
            F.col("g").alias("above"), F.expr(f"zip_with(mean, m, (x, y) -> {pull})").alias("mean"),
            F.expr(f"zip_with(scatter, s, (x, y) -> {pull})").alias("scatter"),
            F.expr(pull.replace("x", "v_mean").replace("y", "w")).alias("v_mean"))
    return out.withColumnRenamed("above", "g")


def judge(stats: DataFrame) -> DataFrame:
    """Adds ``base_failed``, ``distance`` and ``kept`` to the output of ``statistics``.

    The base rules reject texts of under 50 words and those more than half of whose words repeat. The
    estimates rest on texts that pass them. NULL is a language or source of its own.
    """
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    stats = common.stage(stats.withColumn("base_failed", base), "statistics")
    columns = FEATURES | COUNTS
    groups = _groups()
    vectors = stats.where("NOT base_failed").select("lang", "source", *[
        F.expr(sql).alias(x) for x, sql in columns.items()])
    rows = common.stage(vectors.select(F.explode(F.array(*groups)).alias("g"), *columns), "vectors")
    estimates = common.stage(_start(rows), "estimates")
    while not estimates.where("moving").isEmpty():
        estimates = common.stage(_concentrate(rows, estimates), "estimates")
    names = vectors.select("lang", "source").distinct().select(*[g.alias(f"g{i}") for i, g in enumerate(groups)])
    members = estimates.where("g = '{}'").first()
    cut = _cut(_core(members["members"]) if members else 0)
    full = stats.withColumn("g", groups[2]).join(_drawn(names, estimates), "g", "left").withColumns(
        {x: F.expr(f"CASE WHEN NOT base_failed THEN {sql} END") for x, sql in columns.items()})
    distance = F.when(~F.col("base_failed"), _distance())
    return full.withColumn("distance", distance).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut))


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(statistics(common.table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
