"""Bootstrap inference for linear models on Spark DataFrames."""

from .operators.score import metric_dist, bagged_predict, predict
from .operators.sparse_score import predict_sparse
from .operators.summary import (ci_summary, coef_ci, coef_table, coef_wide, compare_models, error_bars,
                                feature_match, feature_subset, info_table, selection_count,
                                selection_freq, selection_rank)
from .plans.fit import Model, cv_path, extend_run, fit_bootstrap, prepare
from .sources.frames import align, read_table, split_rows
from .sources.sparse import one_hot
from .sources.records import append_records, read_records, write_records

__all__ = [
    "Model", "align", "append_records", "bagged_predict", "ci_summary", "coef_ci", "coef_table", "coef_wide",
    "compare_models", "cv_path", "error_bars", "extend_run", "feature_match", "feature_subset",
    "fit_bootstrap", "info_table", "metric_dist", "one_hot", "predict", "predict_sparse", "prepare", "read_records",
    "read_table", "selection_count", "selection_freq", "selection_rank", "split_rows",
    "write_records",
]
