"""Evaluation plans: the reports that combine the per-era metrics.

Plan shape: the per-era aggregates (correlation, MMC, feature exposure, feature-neutral
correlation) are each one distributed rank + one partial aggregation keyed by era. Their outputs
have one row per era (persisted, tiny) and are reduced to one-row aggregates, which are assembled
into the report row; nothing but size checks runs before the row is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics, neutralize
from ..operators.sizing import keep


def _one_row(*frames: DataFrame) -> DataFrame:
    """Side by side values of one-row aggregates, as one lazy row: each row is packed as a struct, and one
    aggregation over the few rows picks them apart."""
    packed = None
    for i, f in enumerate(frames):
        mine = [F.struct(*f.columns) if j == i else F.lit(None).cast(g.select(F.struct(*g.columns)).schema[0].dataType)
                for j, g in enumerate(frames)]
        row = f.select(*[c.alias(f"r{j}") for j, c in enumerate(mine)])
        packed = row if packed is None else packed.unionByName(row)
    whole = packed.agg(*[F.first(f"r{i}", ignorenulls=True).alias(f"r{i}") for i in range(len(frames))])
    return whole.select(*[F.col(f"r{i}")[c].alias(c) for i, f in enumerate(frames) for c in f.columns])


def validation_report(valid: DataFrame, features: Sequence[str] | str, pred: str = "prediction",
                      target: str = "target", example: str = "example_preds", era: str = "era",
                      tiebreak: Sequence[str] = ("row_idx",), **kw) -> DataFrame:
    """Corr mean/std, Sharpe, payout, max drawdown, max feature exposure, feature neutral mean,
    MMC mean, corr+MMC Sharpe and its difference to the Sharpe, correlation with the example."""
    kw = metrics.with_strategy(valid, [era], kw)
    # One rank pass serves every per-era number: the correlation of unif(pred) with the target equals
    # the correlation of rank_pct(pred) (same order, affine scores), so corr, MMC and the correlation
    # with the example come out of the same aggregation.
    # one row per era, read by three consumers: keep it in memory (recomputable, deterministic)
    per_era = keep(metrics.mmc_per_era(valid, pred, example, target, era, tiebreak, **kw))
    # corr mean/std/Sharpe/payout, MMC summary and the example correlation: one aggregation
    summary = per_era.agg(*metrics.corr_report_aggs(), *metrics.mmc_summary_aggs(),
                          F.avg("corr_example").alias("corr_with_example"))
    dd = metrics.max_drawdown(per_era, era=era)
    fe = metrics.max_feature_exposure(valid, features, pred, era)
    fnm = neutralize.feature_neutral_mean(valid, features, pred, target, era, tiebreak, **kw)
    row = _one_row(summary, dd, fe, fnm)
    return row.select(
        "corr_mean", "corr_std", "sharpe", "payout", "max_drawdown", "max_feature_exposure",
        "feature_neutral_mean", "mmc_mean", "corr_plus_mmc_sharpe",
        (F.col("corr_plus_mmc_sharpe") - F.col("sharpe")).alias("corr_plus_mmc_diff"),
        "corr_with_example")


def train_report(train: DataFrame, pred: str = "prediction", target: str = "target", era: str = "era",
                 tiebreak: Sequence[str] = ("row_idx",), **kw) -> DataFrame:
    """In-sample correlation mean, std and payout."""
    kw = metrics.with_strategy(train, [era], kw)
    per_era = metrics.era_corr(train, pred, target, era, tiebreak, **kw)
    s = per_era.agg(F.avg("corr").alias("corr_mean"), F.stddev_pop("corr").alias("corr_std"),
                    F.avg(metrics.clip_payout(F.col("corr"))).alias("payout"))
    return s
