"""Per-era least-squares neutralization.

N1 removes from a score its least-squares projection on a set of neutralizer columns, per era and
without intercept, then divides by the population std of the result in that era. No era is moved into one process:

* every task factors its rows of ``[E | S | 1]`` (``factors.partial_factors``: a triangular factor per era, at most k + m + 1
  rows), and the factors of an era are merged pairwise;
* ``beta`` per era is the minimum-norm least-squares solution from that factor, of the quality of ``pinv(E)`` -- the normal
  equations, which square the condition number, are never formed -- and the residual std comes from the same factor;
* residuals per row through a join of ``(beta, std)`` (one row per era), broadcast when the era
  count (known from the size check of the input) is under the broadcast limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import present
from . import factors, ranking
from .sizing import bounded_broadcast, broadcast_if_at_most

SMALL_K = 16  # coefficients that are applied as generated terms; longer vectors in one loop over the row's vector


def _vector(neutralizers: Sequence[str] | str) -> Column:
    return (F.col(neutralizers).cast("array<double>") if isinstance(neutralizers, str)
            else F.array(*[F.col(c).cast("double") for c in neutralizers]))


def _complete(scores: Sequence[str], neutralizers: Sequence[str] | str, k: int) -> Column:
    """Whether a row takes part: every score and every neutralizer present (not NULL, not NaN)."""
    ok = F.lit(True)
    for c in scores:
        ok = ok & present(F.col(c))
    if isinstance(neutralizers, str):
        x = F.col(neutralizers)
        return ok & F.coalesce((F.size(x) == k) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)), F.lit(False))
    for c in neutralizers:
        ok = ok & present(F.col(c).cast("double"))
    return ok


def _balanced_sum(terms: list):
    """Sum as a balanced expression tree (depth log2(k)): stays in generated code, no per-row lambda."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def _width(df: DataFrame, neutralizers: Sequence[str] | str) -> int:
    """How many neutralizers there are; of a vector column, its longest length (one aggregation)."""
    if not isinstance(neutralizers, str):
        return len(neutralizers)
    return int(df.agg(F.max(F.size(neutralizers)).alias("k")).first()["k"] or 0)


def era_coefficients(scored: DataFrame, scores: Sequence[str] | str, neutralizers: Sequence[str] | str,
                     era: str = "era", proportion: float = 1.0, width: int | None = None) -> DataFrame:
    """Per era: ``beta`` (minimum-norm least squares of ``E beta ~= s`` for every score column, m
    blocks of k values) and ``std`` of the whole residual matrix, from one pass of factors over the complete rows.

    With the factor R of ``[E | S | 1]``, a residual's coordinates are ``v = R_s - proportion R_E beta``: its sum of squares is
    ``v'v``, its sum ``R_1'v``."""
    scores = [scores] if isinstance(scores, str) else list(scores)
    k = _width(scored, neutralizers) if width is None else width
    m = len(scores)
    complete = scored.where(_complete(scores, neutralizers, k))
    row = F.concat(_vector(neutralizers), F.array(*[F.col(c).cast("double") for c in scores], F.lit(1.0)))
    parts = factors.partial_factors(complete, era, row, k + m + 1)
    schema = T.StructType([T.StructField(era, scored.schema[era].dataType), T.StructField("beta", T.ArrayType(T.DoubleType())),
                           T.StructField("std", T.DoubleType())])

    def solve(kind, key, n, rows):
        import pyarrow as pa

        beta = factors.least_squares(rows, k, list(range(k, k + m)), n)
        v = rows[:, k:k + m] - proportion * (rows[:, :k] @ beta)
        mean = float((rows[:, k + m] @ v).sum()) / (n * m)
        var = max(float((v * v).sum()) / (n * m) - mean * mean, 0.0)
        yield pa.RecordBatch.from_pydict({era: pa.array([key], type=kind), "beta": pa.array([beta.T.ravel()], type=pa.list_(pa.float64())),
                                          "std": pa.array([var ** 0.5])})

    return factors.merged(parts, era, k + m + 1, solve, schema)


def neutralize(df: DataFrame, columns: str | Sequence[str], neutralizers: Sequence[str] | str, era: str = "era",
               tiebreak: Sequence[str] = ("row_idx",), proportion: float = 1.0, normalize: bool = True,
               out: str | Sequence[str] | None = None, n_eras: int | None = None, **kw) -> DataFrame:
    """``df`` plus the neutralized score columns (``out``; by default the inputs are replaced).

    ``neutralizers`` is a list of columns or the name of one ``array`` column with a vector per row. Per era, each
    score column (as ``(rank_first - 0.5) / n`` when ``normalize``) loses its least-squares projection on the
    neutralizers (no intercept) times ``proportion``; the result is divided by the population std of the whole score
    matrix of that era, as in the reference.

    Missing values, at any width: a row with a missing score or neutralizer (NULL, NaN, or a vector of another length
    than the longest) takes no part in the fit, the count or the std, and its result is NULL; the other rows of
    its era are neutralized among themselves. (Fill missing features first, as the load step does, to keep such rows.)

    Plan: the scored rows are read twice -- once for the per-era factors, one join with the per-era
    ``(beta, std)`` table, broadcast where its bytes are few -- and keep their era partitioning, so a following per-era
    rank needs no new exchange.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    outs = columns if out is None else ([out] if isinstance(out, str) else list(out))
    neutralizers = neutralizers if isinstance(neutralizers, str) else list(neutralizers)
    k = _width(df, neutralizers)
    base = df
    scores = [f"_score{c}" for c in range(len(columns))]
    if normalize:
        kw = dict(kw)
        if len(columns) > 1 and kw.get("strategy", "auto") == "auto":
            kw["strategy"] = ranking.choose_strategy(df, [era])
        for col, sc in zip(columns, scores):
            base = ranking.unif(base, col, [era], list(tiebreak), out=sc, **kw)
    else:
        for col, sc in zip(columns, scores):
            base = base.withColumn(sc, F.col(col).cast("double"))
    coef = era_coefficients(base, scores, neutralizers, era, proportion, k)
    if n_eras is None:
        n_eras = ranking.group_stats(df, [era])[1]
    # one row per era of k * m coefficients: the era count (from the input's group statistics) bounds the bytes
    coef = broadcast_if_at_most(coef.select(F.col(era).alias("_coef_era"), F.col("beta").alias("_beta"), F.col("std").alias("_std")),
                                n_eras, 64 + 8 * k * len(columns))
    res = base.join(coef, F.col(era) == F.col("_coef_era"), "left")
    ok = _complete(scores, neutralizers, k)
    outputs = []
    for ci, (sc, name) in enumerate(zip(scores, outs)):
        if isinstance(neutralizers, list) and k <= SMALL_K:
            fitted = _balanced_sum([F.col(c).cast("double") * F.element_at("_beta", ci * k + j + 1)
                                    for j, c in enumerate(neutralizers)])
        else:  # one loop over the row's vector, not k generated terms
            own = F.slice("_beta", ci * k + 1, k)
            fitted = F.aggregate(F.zip_with(_vector(neutralizers), own, lambda x, b: x * b), F.lit(0.0), lambda acc, v: acc + v)
        value = (F.col(sc) - F.lit(proportion) * fitted) / F.nullif(F.col("_std"), F.lit(0.0))
        outputs.append(F.when(ok, value).alias(name))
    cols = [c for c in df.columns if c not in outs]
    return res.select(*cols, *outputs)


def neutralize_series(df: DataFrame, series: str, by: str, proportion: float = 1.0,
                      group_cols: Sequence[str] = (), out: str = "neutralized") -> DataFrame:
    """``series - proportion * (a + b * by)`` with the least-squares line fitted on the whole
    frame (or per group). The coefficient table has one row per group (broadcast)."""
    group_cols = list(group_cols)
    agg = [F.regr_slope(F.col(series), F.col(by)).alias("_b"),
           F.regr_intercept(F.col(series), F.col(by)).alias("_a")]
    if group_cols:
        coef = bounded_broadcast(df.groupBy(*group_cols).agg(*agg))
        joined = df.join(coef, group_cols, "left")
    else:
        fit = df.agg(*agg).first()  # one row: slope and intercept of the whole frame
        joined = df.select("*", F.lit(fit["_b"]).cast("double").alias("_b"), F.lit(fit["_a"]).cast("double").alias("_a"))
    return (joined.withColumn(out, F.col(series) - F.lit(proportion) * (F.col("_a") + F.col("_b") * F.col(by)))
                  .drop("_a", "_b"))


def feature_neutral_mean(df: DataFrame, features: Sequence[str] | str, pred: str = "prediction",
                         target: str = "target", era: str = "era", tiebreak: Sequence[str] = ("row_idx",),
                         **kw) -> DataFrame:
    """Neutralize the prediction against all features (columns, or one vector column) per era, then mean of
    the per-era rank correlation of the result with the target."""
    from .metrics import era_corr, with_strategy

    names = [features] if isinstance(features, str) else list(features)
    cols = list(dict.fromkeys([era, pred, target, *names, *tiebreak]))
    kw = with_strategy(df, [era], kw)
    n_eras = ranking.group_stats(df, [era])[1]  # cached by the size check above
    neutral = neutralize(df.select(*cols), pred, features, era, tiebreak, out="neutral_sub",
                         n_eras=n_eras, **kw)
    per_era = era_corr(neutral, "neutral_sub", target, era, tiebreak, **kw)
    return per_era.agg(F.avg("corr").alias("feature_neutral_mean"))
