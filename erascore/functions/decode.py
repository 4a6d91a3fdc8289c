"""Prediction post-processing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class-score thresholds of the two-rule decoder and the number of classes.
THRESHOLDS = (0.1, 0.48)
N_CLASSES = 5


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp01(p) -> Column:
    """Below 0 -> 0, above 1 -> 1; NaN and NULL stay as they are (Spark orders NaN above 1)."""
    p = _c(p)
    return (F.when(F.isnan(p), p).when(p < 0, F.lit(0.0)).when(p > 1, F.lit(1.0)).otherwise(p))


def argmax_decode(scores, n_classes: int = N_CLASSES) -> Column:
    """R2: arg-max class (first index wins ties) divided by ``n_classes - 1``."""
    s = _c(scores)
    return ((F.array_position(s, F.array_max(s)) - 1) / F.lit(float(n_classes - 1)))


def threshold_decode(scores, thresholds: tuple[float, float] = THRESHOLDS) -> Column:
    """Start at class 2; if p2 <= t0 choose 0 or 4 by p0 >= p4; then if p2 <= t1 choose 1 or 3 by
    p1 >= p3 (the second rule wins when both apply); divided by 4.

    A comparison involving NaN is false, as in NumPy, so NaN inputs are turned to NULL first and
    NULL comparisons fall through like false ones."""
    s = _c(scores)

    def p(i):
        v = F.element_at(s, i + 1).cast("double")
        return F.when(~F.isnan(v), v)

    t0, t1 = thresholds
    sel1 = F.coalesce(p(2) <= F.lit(t1), F.lit(False))
    sel0 = F.coalesce(p(2) <= F.lit(t0), F.lit(False))
    is1 = sel1 & F.coalesce(p(1) >= p(3), F.lit(False))
    is3 = sel1 & F.coalesce(p(3) > p(1), F.lit(False))
    is0 = sel0 & F.coalesce(p(0) >= p(4), F.lit(False))
    is4 = sel0 & F.coalesce(p(4) > p(0), F.lit(False))
    cls = (F.when(is1, F.lit(1)).when(is3, F.lit(3)).when(is0, F.lit(0)).when(is4, F.lit(4))
            .otherwise(F.lit(2)))
    return cls / F.lit(4.0)


def first_output(scores) -> Column:
    """Regression models emit a score matrix; keep column 0."""
    return F.element_at(_c(scores), 1)


def flatten_prediction(p) -> Column:
    """One-element prediction arrays become scalars (scalars pass through)."""
    return F.element_at(_c(p), 1)


def autoencoder_output(outputs, field: str = "target") -> Column:
    """The second output (the target head) of a two-output model."""
    return _c(outputs).getField(field)
