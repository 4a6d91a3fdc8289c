"""Training logs and model-file registries.

Each is a grouped aggregation over a log or registry DataFrame; "first wins" tie rules are
expressed as ``min``/``max`` over structs, which are deterministic (``min_by`` is not on ties).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import epoch_from_key
from ..sources.sinks import path_exists
from .sizing import bounded_broadcast

N_STEPS = 41  # fixed value: the least number of trials in a best-epoch table


def best_epoch(log: DataFrame, keys: Sequence[str] = ("model", "trial"), epoch: str = "epoch",
               value: str = "value", mode: str = "min") -> DataFrame:
    """The epoch with the lowest (``min``) or highest (``max``) monitored value per run; on equal
    values the earlier epoch wins. Missing values never win."""
    v = F.col(value) if mode == "min" else -F.col(value)
    best = F.min(F.struct(v.alias("v"), F.col(epoch).alias("e")))
    out = (log.where(F.col(value).isNotNull())
              .groupBy(*keys).agg(best.alias("_b"))
              .select(*keys, F.col("_b.e").alias("best_epoch"),
                      (F.col("_b.v") if mode == "min" else -F.col("_b.v")).alias("best_value")))
    return out


def latest_epoch_file(files: DataFrame, prefix_col: str = "prefix", name: str = "name",
                      mtime: str = "mtime") -> DataFrame:
    """Per model prefix, the newest file (latest ``mtime``, then the larger name) and the epoch
    parsed from it."""
    newest = F.max(F.struct(F.col(mtime).alias("t"), F.col(name).alias("n")))
    return (files.groupBy(prefix_col).agg(newest.alias("_m"))
                 .select(prefix_col, F.col("_m.n").alias("file"), epoch_from_key(F.col("_m.n")).alias("epoch")))


def best_epoch_table(models: DataFrame, own: DataFrame, fallback: DataFrame, n_trials: int = N_STEPS,
                     model: str = "model") -> DataFrame:
    """Per model and trial 1..n the best epoch: from the model's own table when it has one, else
    from the fallback table, else 1. n is ``n_trials``, or the highest trial of either table where that is more.

    ``own``: (model, trial, epoch); ``fallback``: (trial, epoch). Tables are small (models x trials)."""
    last = own.select("trial").unionByName(fallback.select("trial")).agg(F.greatest(F.max("trial"), F.lit(n_trials)).alias("last"))
    last = max(n_trials, last.first()["last"] or 0)  # one number
    trials = F.explode(F.sequence(F.lit(1), F.lit(last))).alias("trial")
    grid = models.select(model, trials)
    has_own = own.select(model).distinct().withColumn("_has_own", F.lit(True))
    out = (grid.join(has_own, model, "left")
               .join(own.withColumnRenamed("epoch", "_own"), [model, "trial"], "left")
               .join(bounded_broadcast(fallback.withColumnRenamed("epoch", "_fb")), "trial", "left"))
    has_fb = fallback.limit(1).count() > 0  # one-row probe of a metadata-sized table
    epoch = F.when(F.col("_has_own"), F.col("_own"))
    src = F.when(F.col("_has_own"), F.lit("own"))
    if has_fb:
        epoch = epoch.otherwise(F.col("_fb"))
        src = src.otherwise(F.lit("fallback"))
    else:
        epoch = epoch.otherwise(F.lit(1))
        src = src.otherwise(F.lit("default"))
    return out.select(model, "trial", F.coalesce(epoch, F.lit(1)).cast("int").alias("epoch"), src.alias("source"))


def read_best_epochs(spark: SparkSession, folder: str, name: str, fallback: str | None = None) -> DataFrame:
    """The best-epoch table ``(trial, epoch, source)`` of a model: its own headered CSV ``<folder>/<name>.csv``
    (columns trial, epoch), else that of ``fallback``, else an empty table."""
    for candidate, source in ((name, "own"), (fallback, "fallback")):
        path = f"{folder.rstrip('/')}/{candidate}.csv"
        if candidate is not None and path_exists(spark, path):
            rows = spark.read.option("header", True).csv(path)
            return rows.select(F.col("trial").cast("int").alias("trial"), F.col("epoch").cast("int").alias("epoch"), F.lit(source).alias("source"))
    return spark.createDataFrame([], "trial int, epoch int, source string")


def step_cleanup_candidates(entries: DataFrame, best: DataFrame, keys: Sequence[str] = ("model", "step"),
                            epoch: str = "epoch") -> DataFrame:
    """Registry entries of a step other than that step's best epoch (listed, never deleted)."""
    keys = list(keys)
    return (entries.join(best.select(*keys, F.col("best_epoch")), keys, "inner")
                   .where(F.col(epoch) != F.col("best_epoch"))
                   .drop("best_epoch"))
