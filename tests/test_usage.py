"""The README usage examples, run on the smallest fixtures."""

from pyspark.sql import functions as F

from erascore.functions import vectors
from erascore.operators import metrics, models, neutralize, projections, splits
from erascore.plans import evaluation
from erascore.session import scratch_path
from erascore.sources import sinks
from erascore.sources.fixtures import FEATURES, tourney, vec


def test_readme_examples(spark, sf_dir):
    df = tourney(spark, sf_dir)
    valid = df.where(F.col("dataset") == "valid")
    per_era = metrics.era_corr(df, pred="prediction", target="target", era="era", tiebreak=["row_idx"])
    assert metrics.corr_summary(per_era).first().corr_std >= 0
    assert metrics.max_drawdown(per_era).first().max_drawdown <= 0
    n = neutralize.neutralize(df, "prediction", FEATURES, era="era", tiebreak=["row_idx"], proportion=1.0)
    assert n.count() == df.count()
    assert evaluation.validation_report(valid, FEATURES).count() == 1

    ex = projections.assemble_xy(df, FEATURES, ["target"], keep=["id", "era"])
    ex = splits.random_holdout_exact(ex, 0.2, seed=1)
    path = scratch_path(spark, "usage_shards")
    sinks.write_shards_by_era(ex, path, shard_rows=4096)
    assert spark.read.parquet(path).count() == df.count()

    x, _ = vectors.apply_chain(F.col("x"), F.col("y"), "NaN,0.5,0.5|Slice,0,64|YX,8,8")
    assert len(vec(spark, sf_dir).select(x.alias("m")).first().m) == 8

    m = models.regressor_fit(df.where(F.col("dataset") == "train"), FEATURES)
    preds = models.batch_score(m, df.where(F.col("dataset") == "live"), FEATURES, "NR")
    out = sinks.write_submission(preds, scratch_path(spark, "usage_subs"), "mlp", 1, 30)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["id", "prediction"] and back.count() == preds.count()
