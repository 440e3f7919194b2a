"""Column-expression helpers (all built-in Spark functions, codegen-friendly)."""

from cadence.functions.arrays import (argmax, dot, log_softmax_at, output_switch,
                                      predictions_match, scalar_predictions_match, softmax)
from cadence.functions.columns import (categorical_columns, datetime_columns, is_missing,
                                       nan_to_null, numeric_columns, round_doubles)
from cadence.functions.hashing import hash32, hash_bucket, hash_fraction, row_key
from cadence.functions.stats import count_if, ratio, ratio_or_zero

__all__ = [
    "argmax", "dot", "log_softmax_at", "output_switch", "predictions_match",
    "scalar_predictions_match", "softmax", "categorical_columns", "datetime_columns",
    "is_missing", "nan_to_null", "numeric_columns", "round_doubles", "hash32", "hash_bucket",
    "hash_fraction", "row_key", "count_if", "ratio", "ratio_or_zero",
]
