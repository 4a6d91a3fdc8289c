"""Joins and unions of the tournament frames.

Predictions stay attached to their ``id`` end to end, so no operator pairs rows by position.
Both sides of the id joins grow with the data, so they are left to the planner (sort-merge or
shuffled hash, AQE skew splitting); only tables with a fixed size bound are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingIdsError(ValueError):
    pass


def align_example_preds(valid: DataFrame, example: DataFrame, id_col: str = "id",
                        example_col: str = "example_preds", check: bool = True) -> DataFrame:
    """Attach example predictions to every validation row; a missing id is an error.

    The check is a ``left_anti`` join that must be empty (one extra pass, only when ``check``)."""
    if check:
        missing = valid.select(id_col).join(example.select(id_col), id_col, "left_anti").limit(1).count()
        if missing:
            raise MissingIdsError("validation ids without example predictions")
    return valid.join(example.select(id_col, example_col), id_col, "inner")


def side_by_side(example: DataFrame, preds: DataFrame, id_col: str = "id") -> DataFrame:
    """Column-wise concatenation aligned on the id (outer)."""
    return example.join(preds, id_col, "full_outer")


def union_train_valid(train: DataFrame, valid_part: DataFrame) -> DataFrame:
    """Append rows of validation to train, matching columns by name."""
    return train.unionByName(valid_part, allowMissingColumns=True)


def attach_predictions(frame: DataFrame, preds: DataFrame, id_col: str = "id", check: bool = True) -> DataFrame:
    """Predictions joined back to their rows by id (the reference pairs them by batch position).

    ``check``: every row must receive exactly one prediction. Rows and predictions are counted per id in one
    aggregation over the ids alone, which reads the predictions once more."""
    if check:
        both = frame.select(F.col(id_col), F.lit(0).alias("p")).unionByName(preds.select(F.col(id_col), F.lit(1).alias("p")))
        per_id = both.groupBy(id_col).agg(F.sum("p").alias("n"), F.sum(1 - F.col("p")).alias("rows"))
        bad = per_id.where((F.col("n") > 1) | ((F.col("rows") > 0) & (F.col("n") == 0)))
        if not bad.isEmpty():
            raise MissingIdsError("rows without exactly one prediction")
    return frame.join(preds, id_col, "left")


def ensemble_wide(long_scores: DataFrame, id_col: str = "id", trial_col: str = "trial",
                  dim_col: str = "dim", value_col: str = "prediction", tag: str = "",
                  trials: Sequence[int] = (), dims: int = 1) -> DataFrame:
    """One column per (trial, output dim) named ``trial_<tag><trial*dims+d>``.

    The pivot values are passed explicitly (known from the model list), which avoids the extra
    distinct-values job and bounds the output width."""
    n = F.col(trial_col) * F.lit(dims) + F.col(dim_col)
    names = [f"trial_{tag}{t * dims + d}" for t in trials for d in range(dims)]
    keyed = long_scores.withColumn("_name", F.concat(F.lit(f"trial_{tag}"), n.cast("string")))
    return keyed.groupBy(id_col).pivot("_name", names).agg(F.first(value_col))


def model_run_plan(models: DataFrame, config: DataFrame, model_col: str = "model",
                   config_model_col: str = "model") -> DataFrame:
    """One run per (model in the list, config row whose model name starts with it).

    A name's prefixes are few, so every config name is unfolded into those whose lengths the list has, and the prefix condition becomes
    an equi-join that any number of names may take part in; a null name on either side runs nothing, an empty
    one is every name's prefix. The lengths are a few numbers, whatever the list (a model name's longest length at most)."""
    names = models.select(F.col(model_col).alias("run_model")).where("run_model IS NOT NULL")
    lengths = sorted(r[0] for r in names.select(F.char_length("run_model")).distinct().collect())
    given = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    fitting = F.filter(given, lambda n: n <= F.char_length(F.col(config_model_col)))
    prefixed = config.select("*", F.explode(F.transform(fitting, lambda n: F.substring(F.col(config_model_col), F.lit(1), n))).alias("_prefix"))
    joined = prefixed.join(names, F.col("_prefix") == F.col("run_model"))
    return joined.select("run_model", *[F.col(f"`{c}`") for c in config.columns])
