"""Query registrations: ranking, metrics, neutralization and joins over the ``tourney`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import sqlgen
from .functions.decode import clamp01
from .operators import joins, metrics, neutralize, ranking, scans, sketches
from .plans import evaluation
from .session import scratch_path
from .sources import layout
from .sources.fixtures import FEATURES, tourney, tourney_missing, vec, with_views
from .suite import (_era_corr_sql, r6, register, rounded, sql_corr_pairwise, sql_corr_strict,
                    sql_rank_pct, sql_unif)

VALID = "dataset = 'valid'"


def _valid(spark, sf):
    return tourney(spark, sf).where(F.col("dataset") == "valid")


# ----------------------------------------------------------------------------- W: ranking

@register("rank_pct_first", with_views(f"""
SELECT id, era, cast({sql_rank_pct('prediction')} AS DOUBLE) AS rank_pct FROM tourney""", "tourney"))
def q_rank_pct_first(spark, sf):
    t = tourney(spark, sf).select("id", "era", "prediction", "row_idx")
    # exact integer ratios: identical doubles in both engines, no rounding needed.
    # Forced onto the skew-safe range plan (the size check would pick the window plan here).
    return ranking.rank_pct_first(t, "prediction", ["era"], ["row_idx"], strategy="range").select("id", "era", "rank_pct")


@register("unif", with_views(f"""
SELECT id, era, cast({sql_unif('prediction')} AS DOUBLE) AS unif FROM tourney""", "tourney"))
def q_unif(spark, sf):
    t = tourney(spark, sf).select("id", "era", "prediction", "row_idx")
    return ranking.unif(t, "prediction", ["era"], ["row_idx"]).select("id", "era", "unif")


@register("row_position", with_views("""
SELECT id, cast(row_number() OVER (ORDER BY era, row_idx) - 1 AS BIGINT) AS row_pos FROM tourney""", "tourney"))
def q_row_position(spark, sf):
    t = tourney(spark, sf).select("id", "era", "row_idx")
    return ranking.row_position(t, ["era", "row_idx"]).select("id", "row_pos")


@register("global_rank", with_views("""
SELECT id, cast(row_number() OVER (ORDER BY prediction ASC NULLS LAST, row_idx) AS BIGINT) AS rank
FROM tourney""", "tourney"))
def q_global_rank(spark, sf):
    t = tourney(spark, sf).select("id", "prediction", "row_idx")
    return ranking.global_rank(t, "prediction", ["row_idx"], strategy="range").select("id", "rank")


_CUM_SQL = f"""
WITH e AS ({_era_corr_sql('tourney')}),
c AS (SELECT era, corr,
             CASE WHEN corr IS NOT NULL THEN product(corr + 1)
                  OVER (ORDER BY era ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cum_value
      FROM e)
"""


@register("cumulative_value", with_views(_CUM_SQL + f"""
SELECT era, {r6('corr')} AS corr, {r6('cum_value')} AS cum_value FROM c""", "tourney"))
def q_cumulative_value(spark, sf):
    per_era = metrics.era_corr(tourney(spark, sf))
    return rounded(ranking.cumulative_value(per_era, "corr"))


@register("rolling_max", with_views(_CUM_SQL + f"""
SELECT era, {r6('cum_value')} AS cum_value,
       {r6('max(cum_value) OVER (ORDER BY era ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)')} AS rolling_max
FROM c""", "tourney"))
def q_rolling_max(spark, sf):
    per_era = ranking.cumulative_value(metrics.era_corr(tourney(spark, sf)), "corr")
    return rounded(ranking.rolling_max(per_era, "cum_value", window=100).select("era", "cum_value", "rolling_max"))


_MODELS = ["prediction", "example_preds", "feature_mix"]
_SERIES_SQL = "WITH s AS (" + " UNION ALL ".join(f"""
  SELECT '{m}' AS model, era, {sql_corr_strict('r', 'target')} AS corr FROM (
    SELECT era, target, {sql_rank_pct(m)} AS r FROM tourney) GROUP BY era""" for m in _MODELS) + """),
v AS (SELECT *, CASE WHEN corr IS NOT NULL THEN product(corr + 1) OVER (PARTITION BY model ORDER BY era) END AS cum_value FROM s)"""


@register("cumulative_values", with_views(_SERIES_SQL + f"""
SELECT model, era, {r6('cum_value')} AS cum_value,
       {r6('max(cum_value) OVER (PARTITION BY model ORDER BY era ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS rolling_max FROM v""", "tourney"))
def q_cumulative_values(spark, sf):
    """W5 and W6 for the series of several models at once, in blocks of four and seven eras."""
    t = tourney(spark, sf)
    parts = [metrics.era_corr(t, pred=m).select(F.lit(m).alias("model"), "era", "corr") for m in _MODELS]
    series = parts[0].unionByName(parts[1]).unionByName(parts[2])
    values = scans.cumulative_values(series, "corr", ["model"], block=4)
    return rounded(scans.rolling_maxima(values, "cum_value", ["model"], window=7).select("model", "era", "cum_value", "rolling_max"))


@register("era_table_corr", with_views(f"""
SELECT era, {r6(sql_corr_strict('r', 'target'))} AS corr FROM (
  SELECT era, target, {sql_rank_pct('prediction')} AS r FROM tourney) GROUP BY era""", "tourney"))
def q_era_table_corr(spark, sf):
    """A3 over a co-partitioned era table: written once, read without an exchange."""
    t = tourney(spark, sf).select("id", "row_idx", "era", "target", "prediction")
    table = layout.write_era_table(t, scratch_path(spark, "era_table"), order=["prediction", "row_idx"])
    return rounded(metrics.era_corr(table))


# ----------------------------------------------------------------------------- A: metrics

@register("rank_corr", with_views(f"""
SELECT dataset, {r6(sql_corr_strict('r', 'target'))} AS corr FROM (
  SELECT dataset, target, {sql_rank_pct('prediction', 'dataset')} AS r FROM tourney
) GROUP BY dataset""", "tourney"))
def q_rank_corr(spark, sf):
    """A1: Correlation(prediction, target) over each role as a whole."""
    t = tourney(spark, sf)
    return rounded(metrics.era_corr(t, era="dataset"))


@register("corr_overall", with_views(f"""
SELECT {r6(sql_corr_strict('r', 'target'))} AS corr FROM (
  SELECT target, {sql_rank_pct('prediction', '')} AS r FROM tourney WHERE dataset <> 'live')""", "tourney"))
def q_corr_overall(spark, sf):
    """A2: the correlation over all train + validation rows (global rank)."""
    t = tourney(spark, sf).where(F.col("dataset") != "live")
    return rounded(metrics.rank_corr(t))


@register("era_corr", with_views(f"SELECT era, {r6('corr')} AS corr FROM ({_era_corr_sql('tourney')})", "tourney"))
def q_era_corr(spark, sf):
    return rounded(metrics.era_corr(tourney(spark, sf)))


@register("era_corr_range", with_views(f"SELECT era, {r6('corr')} AS corr FROM ({_era_corr_sql('tourney')})", "tourney"))
def q_era_corr_range(spark, sf):
    """A3 on the skew-safe range plan (what the size check picks when one era is too large)."""
    return rounded(metrics.era_corr(tourney(spark, sf), strategy="range"))


@register("era_corr_missing", with_views(
    f"SELECT era, {r6('corr')} AS corr FROM ({_era_corr_sql('tourney_missing')})", "tourney_missing"))
def q_era_corr_missing(spark, sf):
    """A1 missing-value rule: an era with any missing target has no correlation."""
    return rounded(metrics.era_corr(tourney_missing(spark, sf)))


_SUMMARY_SQL = f"""
SELECT {r6('avg(corr)')} AS corr_mean, {r6('stddev_pop(corr)')} AS corr_std,
       {r6('avg(corr) / nullif(stddev_pop(corr), 0)')} AS sharpe
FROM ({_era_corr_sql('tourney')})"""


@register("corr_mean_std_sharpe", with_views(_SUMMARY_SQL, "tourney"))
def q_corr_summary(spark, sf):
    return rounded(metrics.corr_summary(metrics.era_corr(tourney(spark, sf))))


@register("payout", with_views(f"""
SELECT {r6('avg(CASE WHEN corr IS NOT NULL THEN greatest(least(corr, 0.25), -0.25) END)')} AS payout
FROM ({_era_corr_sql('tourney')})""", "tourney"))
def q_payout(spark, sf):
    return rounded(metrics.payout(metrics.era_corr(tourney(spark, sf))))


@register("max_drawdown", with_views(_CUM_SQL + f"""
SELECT {r6('-max((rm - cum_value) / nullif(rm, 0))')} AS max_drawdown FROM (
  SELECT cum_value, max(cum_value) OVER (ORDER BY era ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS rm FROM c)
""", "tourney"))
def q_max_drawdown(spark, sf):
    return rounded(metrics.max_drawdown(metrics.era_corr(tourney(spark, sf))))


def _long_sql(view: str, cols: str, where: str = "") -> str:
    parts = [f"SELECT {cols}, '{f}' AS feature, cast({f} AS DOUBLE) AS fvalue FROM {view} {where}" for f in FEATURES]
    return " UNION ALL ".join(parts)


@register("feature_exposure", with_views(f"""
WITH r AS (SELECT *, {sql_rank_pct('prediction', '')} AS rk FROM tourney WHERE {VALID}),
l AS ({_long_sql('r', 'rk')})
SELECT feature, {r6(sql_corr_strict('rk', 'fvalue'))} AS exposure FROM l GROUP BY feature""", "tourney"))
def q_feature_exposure(spark, sf):
    return rounded(metrics.feature_exposure(_valid(spark, sf), FEATURES))


@register("max_feature_exposure", with_views(f"""
WITH l AS ({_long_sql('tourney_missing', 'era, prediction', 'WHERE ' + VALID)}),
pe AS (SELECT era, feature, abs({sql_corr_pairwise('fvalue', 'prediction')}) AS a FROM l GROUP BY era, feature),
m AS (SELECT era, max(a) AS mx FROM pe GROUP BY era)
SELECT {r6('avg(mx)')} AS max_feature_exposure FROM m""", "tourney_missing"))
def q_max_feature_exposure(spark, sf):
    t = tourney_missing(spark, sf).where(F.col("dataset") == "valid")
    return rounded(metrics.max_feature_exposure(t, FEATURES))


def _neutral_sql(view_where: str, proportion: float = 1.0, normalize: bool = True) -> str:
    k = len(FEATURES)
    score = sql_unif("prediction") if normalize else "prediction"
    fitted = " + ".join(f"beta{j} * {FEATURES[j]}" for j in range(k))
    return f"""
s AS (SELECT id, era, row_idx, target, {', '.join(FEATURES)}, {score} AS sc FROM tourney {view_where}),
g AS (SELECT era, {sqlgen.gram_sums(FEATURES, 'sc')} FROM s GROUP BY era),
beta AS (SELECT era, {sqlgen.cramer_solution(k)} FROM g),
res AS (SELECT s.*, sc - {proportion!r} * ({fitted}) AS resid FROM s JOIN beta USING (era)),
neu AS (SELECT id, era, row_idx, target,
               resid / nullif(stddev_pop(resid) OVER (PARTITION BY era), 0) AS neutral FROM res)"""


@register("neutralize", with_views(f"""WITH {_neutral_sql('')}
SELECT id, era, {r6('neutral')} AS neutral FROM neu""", "tourney"))
def q_neutralize(spark, sf):
    t = tourney(spark, sf)
    n = neutralize.neutralize(t, "prediction", FEATURES, out="neutral")
    return rounded(n.select("id", "era", "neutral"))


@register("partial_neutralize", with_views(f"""WITH {_neutral_sql('', 0.5)}
SELECT id, era, {r6('neutral')} AS neutral FROM neu""", "tourney"))
def q_partial_neutralize(spark, sf):
    t = tourney(spark, sf)
    n = neutralize.neutralize(t, "prediction", FEATURES, proportion=0.5, out="neutral")
    return rounded(n.select("id", "era", "neutral"))


@register("neutralize_collinear", with_views(f"""WITH {_neutral_sql('')}
SELECT id, era, {r6('neutral')} AS neutral FROM neu""", "tourney"))
def q_neutralize_collinear(spark, sf):
    """N1 with a repeated feature and one that differs from another by a ten-millionth of a third: they span what the features span,
    so the result is that of the features alone."""
    t = (tourney(spark, sf).withColumn("feature_twice", F.col("feature_user"))
         .withColumn("feature_near", F.col("feature_hour") + 1e-7 * F.col("feature_mix")))
    n = neutralize.neutralize(t, "prediction", [*FEATURES, "feature_twice", "feature_near"], out="neutral")
    return rounded(n.select("id", "era", "neutral"))


@register("feature_neutral_mean", with_views(f"""WITH {_neutral_sql('WHERE ' + VALID)},
pe AS (SELECT era, {sql_corr_strict('r', 'target')} AS corr FROM (
         SELECT era, target, {sql_rank_pct('neutral')} AS r FROM neu) GROUP BY era)
SELECT {r6('avg(corr)')} AS feature_neutral_mean FROM pe""", "tourney"))
def q_feature_neutral_mean(spark, sf):
    return rounded(neutralize.feature_neutral_mean(_valid(spark, sf), FEATURES))


@register("neutralize_series", with_views(f"""
SELECT id, {r6('prediction - (regr_intercept(prediction, example_preds) OVER () '
              '+ regr_slope(prediction, example_preds) OVER () * example_preds)')} AS neutralized
FROM tourney""", "tourney"))
def q_neutralize_series(spark, sf):
    t = tourney(spark, sf).select("id", "prediction", "example_preds")
    return rounded(neutralize.neutralize_series(t, "prediction", "example_preds").select("id", "neutralized"))


_MMC_ERA_SQL = f"""
uv AS (SELECT era, target, {sql_unif('prediction')} AS u, {sql_unif('example_preds')} AS v
       FROM tourney WHERE {VALID}),
pe AS (SELECT era,
         CASE WHEN count(*) = count(u) AND count(*) = count(v) AND count(*) = count(target) THEN
           (covar_samp(u, target) - covar_pop(u, v) / nullif(var_pop(v), 0) * covar_samp(v, target))
           / (0.29e0 * 0.29e0) END AS mmc,
         {sql_corr_strict('u', 'target')} AS corr,
         {sql_corr_strict('u', 'v')} AS corr_example
       FROM uv GROUP BY era)"""


@register("mmc", with_views(f"""WITH {_MMC_ERA_SQL}
SELECT era, {r6('mmc')} AS mmc, {r6('corr')} AS corr, {r6('corr_example')} AS corr_example FROM pe""", "tourney"))
def q_mmc(spark, sf):
    return rounded(metrics.mmc_per_era(_valid(spark, sf)))


def _strict(agg: str, x: str) -> str:
    return f"CASE WHEN count(*) = count({x}) THEN {agg}({x}) END"


@register("mmc_sharpe", with_views(f"""WITH {_MMC_ERA_SQL}
SELECT {r6(_strict('avg', 'mmc'))} AS mmc_mean,
       {r6(_strict('avg', 'mmc') + ' / nullif(' + _strict('stddev_pop', 'mmc') + ', 0)')} AS mmc_sharpe
FROM pe""", "tourney"))
def q_mmc_sharpe(spark, sf):
    s = metrics.mmc_summary(metrics.mmc_per_era(_valid(spark, sf)))
    return rounded(s.select("mmc_mean", "mmc_sharpe"))


@register("corr_plus_mmc", with_views(f"""WITH {_MMC_ERA_SQL},
vs AS (SELECT avg(corr) / nullif(stddev_pop(corr), 0) AS sharpe FROM ({_era_corr_sql('tourney', where='WHERE ' + VALID)})),
cm AS (SELECT {_strict('avg', 'corr + mmc')} AS m, {_strict('stddev_pop', 'corr + mmc')} AS s FROM pe)
SELECT {r6('m')} AS corr_plus_mmc_mean, {r6('m / nullif(s, 0)')} AS corr_plus_mmc_sharpe,
       {r6('m / nullif(s, 0) - sharpe')} AS corr_plus_mmc_diff
FROM cm, vs""", "tourney"))
def q_corr_plus_mmc(spark, sf):
    s = metrics.mmc_summary(metrics.mmc_per_era(_valid(spark, sf)))
    return rounded(s.select("corr_plus_mmc_mean", "corr_plus_mmc_sharpe", "corr_plus_mmc_diff"))


@register("corr_with_example", with_views(f"""WITH {_MMC_ERA_SQL}
SELECT {r6('avg(corr_example)')} AS corr_with_example FROM pe""", "tourney"))
def q_corr_with_example(spark, sf):
    return rounded(metrics.corr_with_example(metrics.mmc_per_era(_valid(spark, sf))))


@register("dataset_counts", with_views("""
SELECT dataset, count(*) AS n_rows, cast(4 AS INTEGER) AS n_features, cast(1 AS INTEGER) AS n_targets,
       count(DISTINCT era) AS n_eras
FROM tourney GROUP BY dataset""", "tourney"))
def q_dataset_counts(spark, sf):
    t = tourney(spark, sf).select("dataset", "era", "target", *FEATURES)
    return metrics.dataset_counts(t)


@register("decile_histogram", with_views("""
WITH p AS (SELECT CASE WHEN row_idx % 17 = 0 THEN NULL WHEN row_idx % 13 = 0 THEN 'NaN'::DOUBLE ELSE prediction - 0.2e0 END AS p
           FROM tourney),
c AS (SELECT CASE WHEN p IS NULL OR isnan(p) THEN 11 WHEN p < 0 THEN -1 ELSE cast(least(floor(p * 10), 10) AS INTEGER) END AS bucket,
             count(*) AS n FROM p GROUP BY 1),
b AS (SELECT cast(range AS INTEGER) AS bucket FROM range(-1, 12))
SELECT b.bucket, CASE WHEN b.bucket = 11 THEN 'missing' WHEN b.bucket = -1 THEN 'below' WHEN b.bucket = 10 THEN '100'
                      ELSE cast(b.bucket AS VARCHAR) || '0' END AS label, cast(coalesce(c.n, 0) AS BIGINT) AS n
FROM b LEFT JOIN c USING (bucket)""", "tourney"))
def q_decile_histogram(spark, sf):
    """A17 over all rows, with negative, NULL and NaN predictions; the counts add up to the rows."""
    p = (F.when(F.col("row_idx") % 17 == 0, F.lit(None)).when(F.col("row_idx") % 13 == 0, F.lit(float("nan")))
          .otherwise(F.col("prediction") - F.lit(0.2)))
    return metrics.decile_histogram(tourney(spark, sf).select(p.alias("prediction")))


# ----------------------------------------------------------------------------- reports

@register("validation_report", with_views(f"""WITH {_MMC_ERA_SQL},
ec AS ({_era_corr_sql('tourney', where='WHERE ' + VALID)}),
c AS (SELECT era, corr, CASE WHEN corr IS NOT NULL THEN product(corr + 1)
        OVER (ORDER BY era ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cv FROM ec),
dd AS (SELECT -max((rm - cv) / nullif(rm, 0)) AS max_drawdown FROM (
        SELECT cv, max(cv) OVER (ORDER BY era ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS rm FROM c)),
sm AS (SELECT avg(corr) AS corr_mean, stddev_pop(corr) AS corr_std,
              avg(corr) / nullif(stddev_pop(corr), 0) AS sharpe,
              avg(CASE WHEN corr IS NOT NULL THEN greatest(least(corr, 0.25), -0.25) END) AS payout FROM ec),
l AS ({_long_sql('tourney', 'era, prediction', 'WHERE ' + VALID)}),
fe AS (SELECT avg(mx) AS max_feature_exposure FROM (
        SELECT era, max(a) AS mx FROM (
          SELECT era, feature, abs({sql_corr_pairwise('fvalue', 'prediction')}) AS a FROM l GROUP BY era, feature)
        GROUP BY era)),
{_neutral_sql('WHERE ' + VALID)},
fnm AS (SELECT avg(corr) AS feature_neutral_mean FROM (
         SELECT era, {sql_corr_strict('r', 'target')} AS corr FROM (
           SELECT era, target, {sql_rank_pct('neutral')} AS r FROM neu) GROUP BY era)),
mm AS (SELECT {_strict('avg', 'mmc')} AS mmc_mean,
              {_strict('avg', 'corr + mmc')} / nullif({_strict('stddev_pop', 'corr + mmc')}, 0) AS cps,
              avg(corr_example) AS corr_with_example FROM pe)
SELECT {r6('corr_mean')} AS corr_mean, {r6('corr_std')} AS corr_std, {r6('sharpe')} AS sharpe,
       {r6('payout')} AS payout, {r6('max_drawdown')} AS max_drawdown,
       {r6('max_feature_exposure')} AS max_feature_exposure, {r6('feature_neutral_mean')} AS feature_neutral_mean,
       {r6('mmc_mean')} AS mmc_mean, {r6('cps')} AS corr_plus_mmc_sharpe,
       {r6('cps - sharpe')} AS corr_plus_mmc_diff, {r6('corr_with_example')} AS corr_with_example
FROM sm, dd, fe, fnm, mm""", "tourney"))
def q_validation_report(spark, sf):
    return rounded(evaluation.validation_report(_valid(spark, sf), FEATURES))


@register("train_report", with_views(f"""
WITH ec AS ({_era_corr_sql('tourney', where="WHERE dataset = 'train'")})
SELECT {r6('avg(corr)')} AS corr_mean, {r6('stddev_pop(corr)')} AS corr_std,
       {r6('avg(CASE WHEN corr IS NOT NULL THEN greatest(least(corr, 0.25), -0.25) END)')} AS payout
FROM ec""", "tourney"))
def q_train_report(spark, sf):
    t = tourney(spark, sf).where(F.col("dataset") == "train")
    return rounded(evaluation.train_report(t))


# ----------------------------------------------------------------------------- J: joins

@register("align_example_preds", with_views(f"""
SELECT v.id, v.era, {r6('v.prediction')} AS prediction, {r6('e.example_preds')} AS example_preds
FROM (SELECT id, era, prediction FROM tourney WHERE {VALID}) v
JOIN (SELECT id, example_preds FROM tourney) e USING (id)""", "tourney"))
def q_align_example_preds(spark, sf):
    t = tourney(spark, sf)
    example = t.select("id", "example_preds")
    valid = t.where(F.col("dataset") == "valid").select("id", "era", "prediction")
    return rounded(joins.align_example_preds(valid, example, check=False))


@register("side_by_side", with_views(f"""
SELECT coalesce(e.id, v.id) AS id, {r6('e.example_preds')} AS example_preds, {r6('v.prediction')} AS prediction, v.era
FROM (SELECT id, example_preds FROM tourney WHERE era % 2 = 0) e
FULL OUTER JOIN (SELECT id, era, prediction FROM tourney WHERE {VALID}) v USING (id)""", "tourney"))
def q_side_by_side(spark, sf):
    t = tourney(spark, sf)
    example = t.where(F.col("era") % 2 == 0).select("id", "example_preds")
    valid = t.where(F.col("dataset") == "valid").select("id", "era", "prediction")
    return rounded(joins.side_by_side(example, valid))


@register("max_feature_exposure_wide", with_views(f"""
WITH l AS (SELECT era, cast(y[1] AS DOUBLE) AS p, unnest(range(len(x))) AS pos, cast(unnest(x) AS DOUBLE) AS v FROM vec),
pe AS (SELECT era, pos, abs({sql_corr_pairwise('v', 'p')}) AS a FROM l GROUP BY era, pos),
m AS (SELECT era, max(a) AS mx FROM pe GROUP BY era)
SELECT {r6('avg(mx)')} AS max_feature_exposure FROM m""", "vec"))
def q_max_feature_exposure_wide(spark, sf):
    """A8 over a feature vector column (64 embedding values per row), the wide-data layout."""
    v = vec(spark, sf).select("era", F.element_at("y", 1).cast("double").alias("prediction"), "x")
    return rounded(metrics.max_feature_exposure(v, "x"))


def _neutral2_sql() -> str:
    k = len(FEATURES)
    parts = []
    for c, col in enumerate(["prediction", "example_preds"]):
        parts.append(f"g{c} AS (SELECT era, {sqlgen.gram_sums(FEATURES, 'sc' + str(c))} FROM s GROUP BY era)")
        sol = sqlgen.cramer_solution(k).replace(" AS beta", f" AS b{c}_")
        parts.append(f"beta{c} AS (SELECT era, {sol} FROM g{c})")
    fitted = [" + ".join(f"b{c}_{j} * {FEATURES[j]}" for j in range(k)) for c in range(2)]
    return with_views(f"""
WITH s AS (SELECT id, era, {', '.join(FEATURES)}, {sql_unif('prediction')} AS sc0, {sql_unif('example_preds')} AS sc1
           FROM tourney),
{', '.join(parts)},
r AS (SELECT s.id, s.era, sc0 - ({fitted[0]}) AS r0, sc1 - ({fitted[1]}) AS r1
      FROM s JOIN beta0 USING (era) JOIN beta1 USING (era)),
sd AS (SELECT era, stddev_pop(v) AS sd FROM (SELECT era, r0 AS v FROM r UNION ALL SELECT era, r1 AS v FROM r) GROUP BY era)
SELECT id, era, {r6('r0 / nullif(sd, 0)')} AS n_pred, {r6('r1 / nullif(sd, 0)')} AS n_example
FROM r JOIN sd USING (era)""", "tourney")


@register("neutralize_columns", _neutral2_sql())
def q_neutralize_columns(spark, sf):
    """N1 with two score columns: each neutralized, both divided by the std of the era's whole matrix."""
    t = tourney(spark, sf)
    n = neutralize.neutralize(t, ["prediction", "example_preds"], FEATURES, out=["n_pred", "n_example"])
    return rounded(n.select("id", "era", "n_pred", "n_example"))


@register("feature_exposure_wide", with_views(f"""
WITH r AS (SELECT id, x, {sql_rank_pct('p', '', 'id')} AS rk FROM (SELECT id, x, cast(y[1] AS DOUBLE) AS p FROM vec)),
l AS (SELECT rk, unnest(range(len(x))) AS pos, cast(unnest(x) AS DOUBLE) AS v FROM r)
SELECT printf('x[%d]', pos) AS feature, {r6(sql_corr_strict('rk', 'v'))} AS exposure FROM l GROUP BY pos""", "vec"))
def q_feature_exposure_wide(spark, sf):
    """A7 over a feature vector column (64 embedding values), the wide-data layout."""
    v = vec(spark, sf).select("id", F.element_at("y", 1).cast("double").alias("prediction"), "x")
    return rounded(metrics.feature_exposure(v, "x", tiebreak=["id"]))


@register("max_feature_exposure_constant", with_views(f"""
WITH l AS ({_long_sql('tourney', 'era, prediction')}),
pe AS (SELECT era, feature, abs({sql_corr_pairwise('fvalue', 'prediction')}) AS a FROM l GROUP BY era, feature),
m AS (SELECT era, max(a) AS mx FROM pe GROUP BY era)
SELECT {r6('avg(mx)')} AS max_feature_exposure FROM m""", "tourney"))
def q_max_feature_exposure_constant(spark, sf):
    """A8 with a constant among the features: it has no exposure, so the result is that of the others."""
    t = tourney(spark, sf).withColumn("feature_constant", F.lit(1000.1))
    return rounded(metrics.max_feature_exposure(t, [*FEATURES, "feature_constant"]))


@register("neutralize_wide", "SELECT vec_id % 2 AS era, count(*) AS n_rows, true AS orthogonal, true AS unit_std FROM embeddings GROUP BY 1")
def q_neutralize_wide(spark, sf):
    """N1 against a vector of 64 features: the result is orthogonal to each of them and has unit std in its era."""
    v = vec(spark, sf).select("id", (F.col("id") % 2).alias("era"), F.element_at("y", 1).cast("double").alias("prediction"), "x")
    out = neutralize.neutralize(v, "prediction", "x", out="neutral", tiebreak=["id"])
    per = out.groupBy("era").agg(F.count("neutral").alias("n_rows"), (F.abs(F.stddev_pop("neutral") - 1) < 1e-9).alias("unit_std"))
    dots = out.select("era", F.posexplode("x").alias("j", "v"), "neutral").groupBy("era", "j").agg(F.sum(F.col("v") * F.col("neutral")).alias("dot"))
    flat = dots.groupBy("era").agg((F.max(F.abs("dot")) < 1e-6).alias("orthogonal"))
    return per.join(flat, "era").select("era", "n_rows", "orthogonal", "unit_std")


_BIG_TB = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@register("era_corr_lineitem", with_views(f"""
SELECT era, {r6(sql_corr_strict('r', 'target'))} AS corr FROM (
  SELECT era, target, {sql_rank_pct('prediction', 'era', _BIG_TB)} AS r FROM tourney_big
) GROUP BY era""", "tourney_big"))
def q_era_corr_lineitem(spark, sf):
    """A3 over the lineitem view: one era per ship month, a four-column tie-break."""
    from .sources.fixtures import BIG_TIEBREAK, tourney_big
    return rounded(metrics.era_corr(tourney_big(spark, sf), tiebreak=BIG_TIEBREAK))


@register("sketch_report", with_views("""
SELECT dataset, count(*) AS n_rows, count(DISTINCT era) AS n_eras, count(prediction) AS count, round(avg(prediction), 6) + 0.0 AS mean,
       round(stddev_samp(prediction), 6) + 0.0 AS std, round(min(prediction), 6) + 0.0 AS min, round(max(prediction), 6) + 0.0 AS max,
       true AS ids_near, true AS p25_near, true AS p50_near, true AS p75_near
FROM tourney WHERE era % 3 <> 0 GROUP BY dataset""", "tourney"))
def q_sketch_report(spark, sf):
    """A22 and A16 from stored sketches, of two eras in three: exact where the sketches are, and the estimates held against the rows --
    ids within 4 %, and the share of rows below each quartile within 2 %."""
    t = tourney(spark, sf)
    path = scratch_path(spark, "sketches")
    sketches.era_sketches(t).write.parquet(path)
    told = sketches.describe_sketches(spark.read.parquet(path).where(F.col("era") % 3 != 0))
    rows = t.where(F.col("era") % 3 != 0).join(F.broadcast(told.select("dataset", "p25", "p50", "p75")), "dataset")  # a row for each role
    held = [F.avg((F.col("prediction") < F.col(q)).cast("double")).alias(f"{q}_lo") for q in ("p25", "p50", "p75")]
    held += [F.avg((F.col("prediction") <= F.col(q)).cast("double")).alias(f"{q}_hi") for q in ("p25", "p50", "p75")]
    true = rows.groupBy("dataset").agg(F.countDistinct("id").alias("_ids"), *held)
    near = [((F.col(f"{q}_lo") <= p + 0.02) & (F.col(f"{q}_hi") >= p - 0.02)).alias(f"{q}_near") for q, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    return rounded(told.join(true, "dataset").select("dataset", "n_rows", "n_eras", "count", "mean", "std", "min", "max",
                                                     (F.abs(F.col("n_ids") / F.col("_ids") - 1) < 0.04).alias("ids_near"), *near))
