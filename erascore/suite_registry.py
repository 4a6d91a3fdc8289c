"""Query registrations: losses, training-log and registry operators, ensemble pivot, run plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import joins, metrics, registry
from .sources import readers as src
from .sources.fixtures import FIVE_SCORES_SQL, five_scores, tourney, with_views
from .sources.tables import read_table
from .functions.stats import round6
from .suite import r6, register, rounded


def r6_col(name: str):
    return round6(F.col(name)).alias(name)
from .suite_etl import _CONFIG_SQL, _config_lines

T = "tourney"


@register("loss_metrics", with_views(f"""
SELECT dataset, {r6('avg(abs(target - prediction))')} AS mae, {r6('avg(pow(target - prediction, 2))')} AS mse,
       {r6('avg(abs(target - prediction)) + 0.1e0 * avg(abs(feature_hour - example_preds))')} AS weighted_loss
FROM tourney GROUP BY dataset""", T))
def q_loss_metrics(spark, sf):
    t = tourney(spark, sf)
    out = metrics.loss_metrics(t, "target", "prediction", F.abs(F.col("feature_hour") - F.col("example_preds")),
                               epsilon=0.1, group_cols=["dataset"])
    return rounded(out)


@register("class_accuracy", with_views(f"""
SELECT {r6('avg(cast(list_position(p, list_max(p)) - 1 = label % 5 AS INTEGER))')} AS accuracy
FROM (SELECT vec_id AS id, {FIVE_SCORES_SQL} AS p, label FROM embeddings)""", "class_scores"))
def q_class_accuracy(spark, sf):
    e = read_table(spark, sf, "embeddings").select(five_scores().alias("p"),
                                                   (F.col("label") % 5).alias("y"))
    return rounded(metrics.class_accuracy(e, "y", "p"))


def _epoch_log(spark, sf) -> DataFrame:
    """Per (model, trial, epoch) monitored value derived from the events (counts, so ties occur)."""
    ev = read_table(spark, sf, "events")
    return ev.groupBy(F.col("event_type").alias("model"), (F.col("user_id") % 3 + 1).cast("int").alias("trial"),
                      F.dayofmonth("ts").cast("int").alias("epoch")).agg(F.count(F.lit(1)).alias("value"))


_LOG_SQL = """
log AS (SELECT event_type AS model, cast(user_id % 3 + 1 AS INTEGER) AS trial,
               cast(extract(day FROM ts) AS INTEGER) AS epoch, count(*) AS value FROM events GROUP BY 1, 2, 3),
best AS (SELECT model, trial, epoch AS best_epoch, value AS best_value FROM (
           SELECT *, row_number() OVER (PARTITION BY model, trial ORDER BY value, epoch) AS rn FROM log) WHERE rn = 1)"""


@register("best_epoch", f"WITH {_LOG_SQL}\nSELECT model, trial, best_epoch, best_value FROM best")
def q_best_epoch(spark, sf):
    return registry.best_epoch(_epoch_log(spark, sf))


_FILES_SQL = """(SELECT printf('%sv%dr%dt%d', event_type, cast(user_id % 7 + 1 AS INTEGER), 1,
                       cast(event_id % 3 + 1 AS INTEGER)) AS prefix,
                printf('%sv%dr%dt%d-e%d', event_type, cast(user_id % 7 + 1 AS INTEGER), 1,
                       cast(event_id % 3 + 1 AS INTEGER), cast(event_id % 50 AS INTEGER)) AS name, ts AS mtime
         FROM events)"""


def _files(spark, sf) -> DataFrame:
    ev = read_table(spark, sf, "events")
    v, t, e = (F.col("user_id") % 7 + 1).cast("int"), (F.col("event_id") % 3 + 1).cast("int"), (F.col("event_id") % 50).cast("int")
    return ev.select(F.format_string("%sv%dr%dt%d", "event_type", v, F.lit(1), t).alias("prefix"),
                     F.format_string("%sv%dr%dt%d-e%d", "event_type", v, F.lit(1), t, e).alias("name"),
                     F.col("ts").alias("mtime"))


@register("latest_epoch_file", f"""
SELECT prefix, name AS file, cast(regexp_extract(name, '-e([0-9]+)', 1) AS INTEGER) AS epoch FROM (
  SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY mtime DESC, name DESC) AS rn FROM {_FILES_SQL})
WHERE rn = 1""")
def q_latest_epoch_file(spark, sf):
    return registry.latest_epoch_file(_files(spark, sf))


@register("best_epoch_table", f"""WITH {_LOG_SQL},
models AS (SELECT DISTINCT event_type AS model FROM events),
own AS (SELECT model, trial, best_epoch AS epoch FROM best WHERE model IN ('click', 'view')),
fb AS (SELECT trial, best_epoch AS epoch FROM best WHERE model = 'purchase'),
grid AS (SELECT model, cast(trial AS INTEGER) AS trial FROM models, range(1, 42) r(trial))
SELECT g.model, g.trial,
       cast(coalesce(CASE WHEN g.model IN (SELECT model FROM own) THEN o.epoch ELSE f.epoch END, 1) AS INTEGER) AS epoch,
       CASE WHEN g.model IN (SELECT model FROM own) THEN 'own' ELSE 'fallback' END AS source
FROM grid g LEFT JOIN own o ON o.model = g.model AND o.trial = g.trial LEFT JOIN fb f ON f.trial = g.trial""")
def q_best_epoch_table(spark, sf):
    best = registry.best_epoch(_epoch_log(spark, sf)).withColumnRenamed("best_epoch", "epoch")
    models = read_table(spark, sf, "events").select(F.col("event_type").alias("model")).distinct()
    own = best.where(F.col("model").isin("click", "view")).select("model", "trial", "epoch")
    fallback = best.where(F.col("model") == "purchase").select("trial", "epoch")
    return registry.best_epoch_table(models, own, fallback)


@register("step_cleanup_candidates", """
WITH e AS (SELECT event_id AS id, event_type AS model, cast(floor(extract(day FROM ts) / 14) AS INTEGER) AS step,
                  cast(event_id % 50 AS INTEGER) AS epoch FROM events),
log AS (SELECT model, step, epoch, count(*) AS value FROM e GROUP BY 1, 2, 3),
best AS (SELECT model, step, epoch AS best_epoch FROM (
           SELECT *, row_number() OVER (PARTITION BY model, step ORDER BY value, epoch) AS rn FROM log) WHERE rn = 1)
SELECT e.id, e.model, e.step, e.epoch FROM e JOIN best USING (model, step) WHERE e.epoch <> best.best_epoch""")
def q_step_cleanup_candidates(spark, sf):
    ev = read_table(spark, sf, "events")
    entries = ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("model"),
                        F.floor(F.dayofmonth("ts") / F.lit(14)).cast("int").alias("step"),
                        (F.col("event_id") % 50).cast("int").alias("epoch"))
    log = entries.groupBy("model", "step", "epoch").agg(F.count(F.lit(1)).alias("value"))
    best = registry.best_epoch(log, keys=["model", "step"])
    return registry.step_cleanup_candidates(entries, best).select("id", "model", "step", "epoch")


@register("ensemble_wide", with_views("""
SELECT id, prediction AS trial_m0, example_preds AS trial_m1, feature_k AS trial_m2 FROM tourney""", T))
def q_ensemble_wide(spark, sf):
    t = tourney(spark, sf)
    trials = F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(0).alias("dim"), F.col(c).alias("prediction"))
                       for i, c in enumerate(["prediction", "example_preds", "feature_k"])])
    long = t.select("id", F.explode(trials).alias("s")).select("id", "s.trial", "s.dim", "s.prediction")
    return joins.ensemble_wide(long, tag="m", trials=[0, 1, 2], dims=1)


@register("model_run_plan", _CONFIG_SQL + """,
m AS (SELECT * FROM (VALUES ('click'), ('view')) v(run_model))
SELECT m.run_model, g.model, g.version, g.rev, g.epoch FROM g JOIN m ON starts_with(g.model, m.run_model)""")
def q_model_run_plan(spark, sf):
    config = src.read_run_config(spark, _config_lines(spark, sf))
    models = spark.createDataFrame([("click",), ("view",)], "model string")
    return joins.model_run_plan(models, config).select("run_model", "model", "version", "rev", "epoch")


def _sql_quantile(q: float) -> str:
    pos = f"{q!r}e0 * (n - 1)"
    lo = f"max(CASE WHEN pos0 = floor({pos}) THEN v END)"
    hi = f"max(CASE WHEN pos0 = ceil({pos}) THEN v END)"
    fr = f"max(CASE WHEN pos0 = floor({pos}) THEN {pos} - floor({pos}) END)"
    return f"{lo} + ({hi} - {lo}) * {fr}"


@register("describe_predictions", with_views(f"""
WITH p AS (SELECT row_idx, CASE WHEN row_idx % 17 = 0 THEN NULL WHEN row_idx % 13 = 0 THEN 'NaN'::DOUBLE ELSE prediction - 0.2e0 END AS v FROM tourney),
r AS (SELECT v, row_number() OVER (ORDER BY v, row_idx) - 1 AS pos0, count(*) OVER () AS n FROM p WHERE v IS NOT NULL AND NOT isnan(v))
SELECT count(v) AS count, {r6('avg(v)')} AS mean, {r6('stddev_samp(v)')} AS std, min(v) AS min,
       {_sql_quantile(0.25)} AS p25, {_sql_quantile(0.5)} AS p50, {_sql_quantile(0.75)} AS p75, max(v) AS max
FROM r""", T))
def q_describe_predictions(spark, sf):
    """A22 over all rows, with negative, NULL and NaN predictions. Quartiles are interpolated with the same formula
    in both engines and compared unrounded; mean and std are rounded."""
    p = (F.when(F.col("row_idx") % 17 == 0, F.lit(None)).when(F.col("row_idx") % 13 == 0, F.lit(float("nan")))
          .otherwise(F.col("prediction") - F.lit(0.2)))
    d = metrics.describe_predictions(tourney(spark, sf).select(p.alias("prediction"), "row_idx"), tiebreak=["row_idx"])
    return d.select("count", r6_col("mean"), r6_col("std"), "min", "p25", "p50", "p75", "max")
