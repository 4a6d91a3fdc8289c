"""Linear fits from mergeable factors: a per-era ledger, windows and feature subsets from one scan, and least absolute deviation.

The ledger holds one triangular factor (``factors``) of ``[features | 1 | target]`` per era. Any set of eras is fitted from their
entries alone, and any subset of the features too, since a factor's columns keep all inner products; an era that is added
costs a scan of its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import present
from ..session import scratch_path
from . import factors

SCORE = "score"  # output column of fitted models (inputs may already carry a ``prediction``)
_TERMS = 16  # coefficients applied as generated terms; more in one loop over an array


def _checked(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(present(value), value).otherwise(F.raise_error(F.lit(f"missing value in {name}")).cast("double"))


def _row(features: Sequence[str], target: str) -> Column:
    return F.array(*[_checked(c) for c in features], F.lit(1.0), _checked(target))


def linear_score(features: Sequence[str], beta: Column) -> Column:
    """``beta`` (array: coefficients, then the intercept) applied to the feature columns."""
    k = len(features)
    if k <= _TERMS:
        total = F.element_at(beta, k + 1)
        for j, c in enumerate(features):
            total = total + F.col(c).cast("double") * F.element_at(beta, j + 1)
        return total
    products = F.zip_with(F.array(*[F.col(c).cast("double") for c in features], F.lit(1.0)), beta, lambda x, b: x * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


@dataclass
class LinearModel:
    """A fitted linear model; ``transform`` adds its ``score`` to the rows."""
    features: list[str]
    coefficients: np.ndarray
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        beta = F.array(*[F.lit(float(b)) for b in (*self.coefficients, self.intercept)])
        return df.withColumn(SCORE, linear_score(self.features, beta))


# ------------------------------------------------------------------------------------ the ledger

def era_ledger(df: DataFrame, features: Sequence[str], target: str = "target", era: str = "era") -> DataFrame:
    """(era, n, row): every era's factor of ``[features | 1 | target]``. Missing values raise, as in the fits."""
    return factors.group_factors(df, era, _row(features, target), len(features) + 2).select(era, "n", "row")


def write_ledger(df: DataFrame, path: str, features: Sequence[str], target: str = "target", era: str = "era") -> None:
    """Add the eras of ``df`` to the ledger at ``path``. An era that it already has raises ValueError (a second entry would
    count its rows twice)."""
    spark = df.sparkSession
    new = era_ledger(df, features, target, era)
    staged = scratch_path(spark, "ledger")  # factored once, then checked and added
    new.write.parquet(staged)
    new = spark.read.schema(new.schema).parquet(staged)
    old = read_ledger(spark, path)
    if old is not None:
        known = new.select(era).distinct().join(old.select(F.col(era).alias("_known")), F.col(era).eqNullSafe(F.col("_known")), "left_semi")
        if not known.isEmpty():
            raise ValueError("the ledger already has some of these eras")
    new.write.mode("append").parquet(path)


def read_ledger(spark, path: str) -> DataFrame | None:
    """The ledger at ``path``, None where there is none yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.parquet(path)


def solve_ledger(ledger: DataFrame, group: str, features: Sequence[str], subsets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """(group, fit, n, beta) from ledger rows that carry a group column (a training window): one fit for each subset
    of the features (of all, where None); ``beta`` ends with the intercept. An era counts in every group that its rows name."""
    features, q = list(features), len(features) + 2
    fits = [[*(features.index(c) for c in s), q - 2] for s in (subsets or [features])]
    parts = ledger.select(group, F.lit(0).alias("salt"), "n", "row")
    schema = T.StructType([T.StructField(group, ledger.schema[group].dataType), T.StructField("fit", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("beta", T.ArrayType(T.DoubleType()))])

    def solve(kind, key, n, rows):
        import pyarrow as pa

        betas = []
        for cols in fits:
            own = rows[:, [*cols, q - 1]]
            betas.append(factors.least_squares(own, len(cols), [len(cols)], n)[:, 0])
        yield pa.RecordBatch.from_pydict({
            group: pa.array([key] * len(fits), type=kind), "fit": pa.array(range(len(fits)), pa.int32()),
            "n": pa.array([n] * len(fits), pa.int64()), "beta": pa.array([b.tolist() for b in betas], pa.list_(pa.float64()))})

    return factors.merged(parts, group, q, solve, schema)


def fit_subsets(df: DataFrame, subsets: Sequence[Sequence[str]], target: str = "target") -> list[LinearModel]:
    """One least-squares model for each subset of columns, all from one scan of ``df``."""
    features = list(dict.fromkeys(c for s in subsets for c in s))
    parts = factors.partial_factors(df.withColumn("_all", F.lit(0)), "_all", _row(features, target), len(features) + 2)
    fits = solve_ledger(parts, "_all", features, subsets).collect()  # a row for each subset
    if not fits:
        raise ValueError("no rows to fit")
    return [LinearModel(list(s), np.array(r["beta"][:-1]), float(r["beta"][-1]))
            for s, r in zip(subsets, sorted(fits, key=lambda r: r["fit"]), strict=True)]


# ------------------------------------------------------------------------------------ least absolute deviation

#: Passes that only narrow the width; the least width, of the first mean error; a step's lengths that are tried.
_PLAIN, _LOWEST, _LENGTHS = 10, 1e-9, (0.0, *(2.0 ** j for j in range(-4, 9)))
_STILL = 1e-9


def absolute_fit(df: DataFrame, features: Sequence[str], target: str = "target", max_passes: int = 120) -> LinearModel:
    """The linear model of least mean absolute error, by reweighted least squares with a line search.

    A pass over the rows weighs each with the inverse of its residual (not below a width that falls tenfold, to 1e-9 of the
    first mean error); the factor of the weighted rows gives the step to the next coefficients. After ten such steps, each is
    tried at fourteen lengths from none to 256 times its own, all in one pass, and the length of least absolute error is taken: plain
    reweighting creeps where the rows on both sides of the fit nearly balance. It ends when two steps in a row gain less than
    1e-9 of the loss, or after ``max_passes``. Missing values raise; no rows raise ValueError."""
    spark, k = df.sparkSession, len(features) + 1
    path = scratch_path(spark, "absolute-fit")
    df.select(_row(features, target).alias("row")).write.parquet(path)  # read every pass
    rows = spark.read.parquet(path).select("row", F.lit(0).alias("_all"))
    kind = T.StructType([T.StructField("_all", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("values", T.ArrayType(T.DoubleType()))])

    def a_pass(weigh, made, finish):
        def solve(key_kind, key, n, factor):
            import pyarrow as pa

            yield pa.RecordBatch.from_pydict({"_all": pa.array([key], type=key_kind), "n": pa.array([n]),
                                              "values": pa.array([finish(factor, n).tolist()], pa.list_(pa.float64()))})

        parts = factors.partial_factors(rows, "_all", F.col("row"), k + 1, weigh, made)
        return factors.merged(parts, "_all", made, solve, kind).first()

    def step_from(beta, width):
        def weigh(values):
            error = values[:, k] - values[:, :k] @ beta
            return np.column_stack([values[:, :k], error]) / np.sqrt(np.maximum(np.abs(error), width))[:, None]

        return np.array(a_pass(weigh, k + 1, lambda factor, n: factors.least_squares(factor, k, [k], n)[:, 0])["values"])

    def losses(beta, step):
        def weigh(values):
            error, along = values[:, k] - values[:, :k] @ beta, values[:, :k] @ step
            return np.sqrt(np.abs(error[:, None] - along[:, None] * np.array(_LENGTHS)))

        return np.array(a_pass(weigh, len(_LENGTHS), lambda factor, n: np.append((factor ** 2).sum(axis=0), n))["values"])

    start = a_pass(None, k + 1, lambda factor, n: factors.least_squares(factor, k, [k], n)[:, 0])
    if start is None:
        raise ValueError("no rows to fit")
    beta = np.array(start["values"])
    first = losses(beta, np.zeros(k))
    scale = first[0] / first[-1]
    width, passes, still = max(scale, 1e-300), 2, 0
    while scale and passes < max_passes and still < 2:
        step, passes = step_from(beta, width), passes + 1
        width = max(width / 10, _LOWEST * scale)
        if passes <= _PLAIN + 2:
            beta = beta + step
            continue
        found, passes = losses(beta, step)[:-1], passes + 1
        best = int(found.argmin())
        still = still + 1 if found[0] - found[best] <= _STILL * found[best] else 0
        beta = beta + _LENGTHS[best] * step
    return LinearModel(list(features), beta[:-1], float(beta[-1]))
