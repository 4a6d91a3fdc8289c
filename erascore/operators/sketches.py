"""Stored sketches of the predictions (A22, A16 over any range of eras without their rows).

One row per (role, era): a KLL sketch of the predictions for quantiles and ranks, an HLL sketch of the ids for distinct counts, and
the exact count, sum, sum of squares about the era's mean, minimum and maximum. Rows of sketches merge, so a report over any
set of eras reads a few kilobytes each; the exact report (``metrics.describe_predictions``) stays beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import present

#: KLL's k: quantiles are off by at most about 0.7 % of the rows (k = 400, single-sided, 99 % sure).
QUANTILE_K = 400
#: HLL's log2 of the registers: distinct counts have a standard error of about 0.8 %.
DISTINCT_LG = 14


def era_sketches(df: DataFrame, pred: str = "prediction", id_col: str = "id", dataset: str = "dataset", era: str = "era") -> DataFrame:
    """(dataset, era, n_rows, n, mean, m2, min, max, quantiles, ids). Missing predictions (NULL, NaN) count in ``n_rows`` only."""
    p = F.when(present(F.col(pred)), F.col(pred).cast("double"))
    return df.groupBy(dataset, era).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(p).alias("n"), F.avg(p).alias("mean"), (F.var_pop(p) * F.count(p)).alias("m2"),
        F.min(p).alias("min"), F.max(p).alias("max"), F.kll_sketch_agg_double(p, F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_sketch_agg(F.col(id_col).cast("string"), F.lit(DISTINCT_LG)).alias("ids"))


def describe_sketches(sketches: DataFrame, by: list[str] = ("dataset",), era: str = "era") -> DataFrame:
    """A22 and A16 from stored sketches, for each value of ``by`` (all together where empty): n_rows, n_eras, n_ids (estimated), count,
    mean, std (sample), min, p25, p50, p75 (estimated), max. Moments are merged about their common mean, so count, mean, std
    and extremes are exact."""
    merged = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.count_distinct(era).alias("n_eras"), F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("n_ids"),
        F.sum("n").alias("count"), F.sum(F.col("mean") * F.col("n")).alias("_s"), F.sum("m2").alias("_m2"),
        # the spread of the eras' means, weighted: n * var of mean
        (F.sum(F.col("n") * F.col("mean") * F.col("mean"))).alias("_q"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("_k"))
    some = F.col("count") > 0
    mean = F.when(some, F.col("_s") / F.col("count"))
    between = F.greatest(F.col("_q") - F.col("_s") * mean, F.lit(0.0))
    std = F.when(F.col("count") > 1, F.sqrt((F.col("_m2") + between) / (F.col("count") - 1)))
    quantile = {name: F.when(some, F.kll_sketch_get_quantile_double("_k", F.lit(q))) for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    return merged.select(*by, "n_rows", "n_eras", "n_ids", "count", mean.alias("mean"), std.alias("std"), "min",
                         *[c.alias(name) for name, c in quantile.items()], "max")


def share_below(sketches: DataFrame, bounds: list[float], by: list[str] = ("dataset",)) -> DataFrame:
    """For each value of ``by`` and each bound the estimated share of predictions at or below it (a histogram's cumulative counts)."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("_n"), F.kll_merge_agg_double("quantiles").alias("_k"))
    some = F.col("_n") > 0
    each = F.array(*[F.struct(F.lit(float(b)).alias("bound"), F.when(some, F.kll_sketch_get_rank_double("_k", F.lit(float(b)))).alias("share"))
                     for b in bounds])
    return merged.select(*by, F.explode(each).alias("_e")).select(*by, "_e.bound", "_e.share")
