"""Coefficient and info tables, and the summaries taken over replicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def coef_table(records: DataFrame) -> DataFrame:
    """(model, seed, feature, is_intercept, coef). The intercept is told apart by its flag,
    so a feature may be called `intercept` as well."""
    entries = F.concat(
        F.transform(F.arrays_zip("column_names", "coef"), lambda e: F.struct(
            e["column_names"].alias("feature"), F.lit(False).alias("is_intercept"),
            e["coef"].alias("coef"))),
        F.array(F.struct(F.lit("intercept").alias("feature"), F.lit(True).alias("is_intercept"),
                         F.col("intercept").alias("coef"))))
    return records.select("model", "seed", F.inline(entries))


def coef_wide(records: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row per (model, seed), one column per feature plus `intercept`; a feature a record
    does not have is NULL."""
    coefs = coef_table(records)
    if features is None:
        features = sorted(r["feature"] for r in coefs.where("not is_intercept")
                          .select("feature").distinct().collect())
    if "intercept" in features:
        raise ValueError("a feature called 'intercept' needs the long form, coef_table")
    return coefs.groupBy("model", "seed").pivot("feature", features + ["intercept"]).agg(
        F.first("coef"))


def info_table(records: DataFrame) -> DataFrame:
    return records.select("model", "seed", "r2", "mse_min", "cv", "engine_version",
                          "random_state", "training_feats", "training_targets", "alpha")


def _tails(level: float) -> tuple[float, float]:
    if not 0 < level < 100:
        raise ValueError("level must be between 0 and 100")
    return (100 - level) / 200, 1 - (100 - level) / 200


def _distribution(value: str, level: float, prefix: str = "") -> list:
    lower, upper = _tails(level)
    return [F.avg(value).alias(f"{prefix}mean"), F.stddev_pop(value).alias(f"{prefix}se"),
            F.percentile(value, lower).alias(f"{prefix}lower"),
            F.percentile(value, upper).alias(f"{prefix}upper")]


def ci_summary(metrics: DataFrame, values=("rmse", "r2"), level: float = 95.0) -> DataFrame:
    """Mean, standard error (population) and percentile interval of each metric per model."""
    return metrics.groupBy("model").agg(
        *[c for v in values for c in _distribution(v, level, f"{v}_")])


def error_bars(summary: DataFrame, values=("rmse", "r2")) -> DataFrame:
    """Ends of the mean +- SE bar and lengths of the two arms of the interval bar."""
    cols = [F.col("model")]
    for v in values:
        mean, se = F.col(f"{v}_mean"), F.col(f"{v}_se")
        cols += [mean.alias(f"{v}_mean"), (mean - se).alias(f"{v}_se_from"),
                 (mean + se).alias(f"{v}_se_to"),
                 (mean - F.col(f"{v}_lower")).alias(f"{v}_ci_below"),
                 (F.col(f"{v}_upper") - mean).alias(f"{v}_ci_above")]
    return summary.select(*cols)


def coef_ci(coefs: DataFrame, level: float = 95.0) -> DataFrame:
    """Mean, SE and percentile interval of every parameter."""
    return coefs.groupBy("model", "feature", "is_intercept").agg(*_distribution("coef", level))


def selection_freq(coefs: DataFrame, include_intercept: bool = False) -> DataFrame:
    """(model, feature, is_intercept, p_nonzero): share of a feature's replicates in which its
    coefficient is not zero."""
    kept = coefs if include_intercept else coefs.where("not is_intercept")
    return kept.groupBy("model", "feature", "is_intercept").agg(
        F.avg((F.col("coef") != 0).cast("double")).alias("p_nonzero"))


def selection_rank(freq: DataFrame, k: int | None = None, descending: bool = False) -> DataFrame:
    """Features by selection frequency (ascending by default, names break ties); `k` keeps
    the first ones."""
    p = F.desc("p_nonzero") if descending else F.asc("p_nonzero")
    ordered = freq.orderBy(p, "feature", "model")
    return ordered if k is None else ordered.limit(k)


def selection_count(freq: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per model: number of features, and of those selected in more than `threshold`."""
    return freq.groupBy("model").agg(
        F.count("*").alias("n_features"),
        F.count_if(F.col("p_nonzero") > threshold).alias("n_selected"))


def feature_subset(table: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the named features; an unknown name is an error when the rows are computed."""
    wanted = table.sparkSession.createDataFrame([(n,) for n in sorted(set(names))], "feature string")
    rows = wanted.join(table.withColumn("_there", F.lit(True)), "feature", "left")
    unknown = F.raise_error(F.concat(F.lit("unknown features: "), "feature")).cast("string")
    return rows.withColumn("feature", F.when(F.col("_there").isNull(), unknown).otherwise(
        F.col("feature"))).select(*[f"`{c}`" for c in table.columns])


def feature_match(table: DataFrame, text: str) -> DataFrame:
    """Rows of the features whose name contains a text."""
    return table.where(F.col("feature").contains(text))


def compare_models(metrics: DataFrame, first: str, second: str, metric: str = "r2",
                   level: float = 95.0) -> DataFrame:
    """Distribution of `first` minus `second` over the seeds both have, and the share of
    replicates in which it is above zero. Equal seeds are equal resamples, so this is paired."""
    def only(model):
        own = F.when(F.col("model") == model, F.col(metric))
        return F.when(F.col("seed").isNull() | (F.count(own) > 1), F.raise_error(F.lit(
            "pairing needs one value for each model and seed")).cast("double")).otherwise(F.max(own))

    paired = metrics.where(F.col("model").isin(first, second)).groupBy("seed").agg(
        only(first).alias("a"), only(second).alias("b"))
    diff = paired.where("a is not null and b is not null").select((F.col("a") - F.col("b"))
                                                                  .alias("d"))
    return diff.agg(F.count("*").alias("n_pairs"), *_distribution("d", level, "diff_"),
                    F.avg((F.col("d") > 0).cast("double")).alias("share_above_zero")).select(
        F.lit(first).alias("first"), F.lit(second).alias("second"), F.lit(metric).alias("metric"),
        "*")
