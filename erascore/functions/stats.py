"""Aggregate expressions with the reference's missing-value conventions.

Spark's ``corr`` raises on zero variance under ANSI mode and silently drops NULL pairs, while the
reference uses two conventions: ``np.corrcoef`` (any missing value -> NaN) and pandas ``corrwith``
(pairwise drop). Both are written here as moment ratios, which stay algebraic (partial aggregation
on the map side) and return NULL instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is zero or NULL (never raises)."""
    return num / F.nullif(den, F.lit(0.0))


def present(x) -> Column:
    """Not NULL and not NaN: the reference's notion of a present value."""
    x = _c(x)
    return x.isNotNull() & ~F.isnan(x)


def varies(x: Column) -> Column:
    """Whether a group's present values differ. Merged partial moments leave rounding noise on a constant,
    so zero variance is told by ``min = max``, not by a computed variance."""
    return F.min(x) < F.max(x)


def corr_strict(a, b) -> Column:
    """Pearson correlation; NULL if any value of either side is missing (NULL or NaN), or on zero
    variance."""
    a, b = _c(a), _c(b)
    n = F.count(F.lit(1))
    complete = (n == F.count(F.when(present(a), 1))) & (n == F.count(F.when(present(b), 1)))
    value = safe_ratio(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when(complete & varies(a) & varies(b), value)


def corr_pairwise(a, b) -> Column:
    """Pearson correlation over rows where both sides are present (pandas ``corrwith``)."""
    a, b = _c(a), _c(b)
    both = present(a) & present(b)
    a2 = F.when(both, a)
    b2 = F.when(both, b)
    return F.when(varies(a2) & varies(b2), safe_ratio(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2)))


def nan_to_null(col) -> Column:
    """Spark treats NaN as a value (NaN > 1 is true, NaN = NaN); convert it to NULL at ingest."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def mean_strict(x) -> Column:
    """np.mean: NULL if any input is missing (unlike ``avg`` which skips)."""
    x = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(F.when(present(x), 1)), F.avg(x))


def std_pop_strict(x) -> Column:
    x = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(F.when(present(x), 1)), F.stddev_pop(x))


def round6(col) -> Column:
    """Rounded double without negative zero, for cross-engine value comparison."""
    return F.round(_c(col).cast("double"), 6) + F.lit(0.0)
