"""Array expressions over prediction / logit columns.

All of them are built-in higher-order functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(arr: Column) -> Column:
    """0-based index of the largest element, first index on ties; NULL for empty arrays."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def _with_scalar(arr: Column, scalar: Column, fn) -> Column:
    """Element-wise ``fn(x, scalar)``. The scalar rides in as a second array so the lambda
    only reads its own arguments: an outer reference inside a lambda body is re-evaluated
    per element, which turns an inlined (expensive) scalar into O(n^2) work."""
    return F.zip_with(arr, F.array_repeat(scalar, F.size(arr)), fn)


def softmax(logits: Column) -> Column:
    """Numerically stable softmax: exp(x - max) / sum(exp(x - max))."""
    ex = _with_scalar(logits, F.array_max(logits), lambda x, m: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return _with_scalar(ex, total, lambda x, t: x / t)


def log_softmax_at(logits: Column, idx: Column) -> Column:
    """log p[idx] via log-sum-exp, for cross-entropy from logits."""
    m = F.array_max(logits)
    shifted = _with_scalar(logits, m, lambda x, mm: F.exp(x - mm))
    lse = m + F.log(F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x))
    return F.element_at(logits, idx + 1) - lse


def dot(x: Column, w: Column) -> Column:
    """Sum of x_i * w_i over two equally long arrays (linear logit, B03)."""
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def output_switch(out: Column) -> tuple[Column, Column]:
    """Width > 1 gives (argmax class, softmax probabilities); width 1 gives the raw value
    and NULL probabilities."""
    multi = F.size(out) > 1
    pred = F.when(multi, argmax(out).cast("double")).otherwise(F.element_at(out, 1))
    probs = F.when(multi, softmax(out))
    return pred, probs


def predictions_match(a: Column, b: Column, threshold: float = 0.1, rtol: float = 1e-5) -> Column:
    """H01 on array<double> predictions: same length and every |a-b| <= threshold + rtol*|b|."""
    close = F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= F.lit(threshold) + F.lit(rtol) * F.abs(y)),
                     lambda ok: ok)
    return F.when(F.size(a) != F.size(b), F.lit(False)).otherwise(close)


def scalar_predictions_match(a: Column, b: Column, threshold: float = 0.1) -> Column:
    """H01 on scalar predictions: |a - b| <= threshold."""
    return F.abs(a - b) <= F.lit(threshold)
