"""The reference's two batch lifecycles as Spark plans.

training_etl (the prepare/ETL path): tournament rows -> missing values to NULL -> era number ->
feature order -> ``x``/``y`` vectors -> exact random holdout -> optional balance filter -> parquet
shards per role (and era). One job: the only shuffles are the holdout's rank and the era clustering
of the writer.

live_scoring (the predict path): live rows -> zero targets -> transform chain -> model -> decode /
clamp -> submission file, plus the decile histogram of the written predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import metrics, models, projections, splits
from ..sources import sinks
from ..sources.readers import normalize_missing


def training_examples(df: DataFrame, features: Sequence[str], targets: Sequence[str], split: float = 0.2,
                      seed: int = 0, balance: bool = False, id_col: str = "id", era: str = "era") -> DataFrame:
    """Rows -> ``(id, era, dataset, x, y)`` examples with an exact ``split`` share in ``valid``."""
    rows = normalize_missing(df).withColumn(era, projections.era_number(F.col(era).cast("string")))
    ex = projections.assemble_xy(rows, features, targets, keep=[id_col, era])
    ex = splits.random_holdout_exact(ex, split, id_col=id_col, seed=seed)
    if balance:
        ex = ex.where((F.col("dataset") != "train") | splits.balance_keep(F.col(era), F.element_at("y", 1)))
    return ex


def training_etl(df: DataFrame, out: str, features: Sequence[str], targets: Sequence[str], split: float = 0.2,
                 shard_rows: int = sinks.DEFAULT_SHARD_ROWS, by_era: bool = False, **kw) -> None:
    ex = training_examples(df, features, targets, split, **kw)
    if by_era:
        sinks.write_shards_by_era(ex, out, shard_rows)
    else:
        sinks.write_shards(ex, out, shard_rows)


def live_predictions(live: DataFrame, model, features: Sequence[str], arch: str = "NR",
                     fill: float = 0.5, id_col: str = "id", chain: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Live rows -> ``(id, keep..., prediction)``: missing features filled, the transform chain applied, scored,
    decoded, clamped to [0, 1].

    With a ``chain`` the model sees the transformed vector (a layer list, or two for AE; fitted column models take no
    chain), and the live examples carry zero targets through it as in training; a chain with ``Sparse`` made class
    scores, which are decoded by their largest, otherwise the first output is the prediction."""
    kept = [id_col, *[c for c in keep if c != id_col]]
    filled = projections.fill_missing_const(normalize_missing(live), list(features), fill)
    if not chain:
        return models.batch_score(model, filled, features, arch, id_col, keep=keep)
    x, _ = vectors.apply_chain(F.array(*[F.col(c).cast("double") for c in features]), F.array(F.lit(0.0)), chain, training=False)
    rows = filled.select(*kept, x.alias("_chained"))
    sparse = any(step.name == "Sparse" for step in vectors.parse_spec(chain))
    return models.batch_score(model, rows, "_chained", arch, id_col, keep=keep, decode="argmax" if sparse else "first")


def live_scoring(live: DataFrame, model, features: Sequence[str], folder: str, name: str, version: int,
                 round_number: int, arch: str = "NR", chain: str = "") -> tuple[str, DataFrame]:
    """Write the submission and return its path with the decile histogram of what was written."""
    preds = live_predictions(live, model, features, arch, chain=chain)
    path = sinks.write_submission(preds, folder, name, version, round_number)
    return path, metrics.decile_histogram(read_submission(live.sparkSession, path))


def read_submission(spark, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("id string, prediction double").csv(path)


def example_vectors(shards: DataFrame, spec: str, training: bool = True) -> DataFrame:
    """Shard rows with the transform chain applied to ``x`` (and ``y`` when training)."""
    x, y = vectors.apply_chain(F.col("x"), F.col("y"), spec, training=training)
    return shards.select("id", "era", x.alias("x"), y.alias("y"))


def load_tournament(spark, base: str, feature_prefix: str = "feature", target: str = "target",
                    fill: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The evaluation load step: train, validation and live role files (``read_role``) with missing
    features filled with ``fill`` in every role and missing validation targets filled too."""
    from ..sources.readers import read_role

    train = read_role(spark, base, "train")
    valid = read_role(spark, base, "validation", dataset="valid")
    live = read_role(spark, base, "live")
    feats = projections.columns_by_prefix(train, feature_prefix)
    return (projections.fill_missing_const(train, feats, fill),
            projections.fill_missing_const(valid, feats + [target], fill),
            projections.fill_missing_const(live, feats, fill))
