"""Segmented scans, stored sketches and co-partitioned tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from erascore.operators import metrics, scans, sketches
from erascore.session import scratch_path
from erascore.sources import layout


def _series(spark):
    rng = np.random.default_rng(6)
    rows = []
    for name, n in (("a", 230), ("b", 1), (None, 40), ("c", 101)):
        for i in range(n):
            rows.append((name, i * 3, None if rng.random() < 0.1 else float(rng.normal() / 20)))
    return spark.createDataFrame(rows, "model string, era int, corr double").repartition(5), pd.DataFrame(rows, columns=["model", "era", "corr"])


@pytest.mark.parametrize("strategy", ["window", "range"])
@pytest.mark.parametrize("window", [1, 7, 100])
def test_scans_of_many_series(spark, strategy, window):
    df, pdf = _series(spark)
    got = scans.cumulative_values(df, "corr", ["model"], block=11, strategy=strategy)
    got = scans.rolling_maxima(got, "cum_value", ["model"], window=window, strategy=strategy)
    assert got.columns == ["model", "era", "corr", "cum_value", "rolling_max"]
    got = got.toPandas().sort_values("era")
    assert len(got) == len(pdf)
    for name, g in pdf.groupby("model", dropna=False):
        own = got[got["model"].isna()] if not isinstance(name, str) else got[got["model"] == name]
        cum = (g["corr"] + 1).cumprod()
        assert np.allclose(own["cum_value"].astype(float), cum.astype(float), equal_nan=True)
        assert np.allclose(own["rolling_max"].astype(float), cum.rolling(window, min_periods=1).max(), equal_nan=True)


def test_drawdowns_equal_the_single_one(spark):
    df, _ = _series(spark)
    many = {r["model"]: r["max_drawdown"] for r in scans.drawdowns(df, ["model"]).collect()}
    for name in ("a", "c"):
        one = metrics.max_drawdown(df.where(F.col("model") == name).drop("model")).first()["max_drawdown"]
        assert abs(many[name] - one) < 1e-12
    assert set(many) == {"a", "b", "c", None}
    assert scans.drawdowns(df.limit(0), ["model"]).count() == 0


def test_sketches_of_era_ranges(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") % 20).cast("int").alias("era"), F.lit("valid").alias("dataset"),
                               F.when(F.col("id") % 50 != 0, (F.hash("id") % 1000) / 7.0 + 1e6).alias("prediction"))
    path = scratch_path(spark, "sketches")
    sketches.era_sketches(df).write.parquet(path)
    stored = spark.read.parquet(path)
    for few in (stored.where("era < 5"), stored):
        rows = df.where("era < 5") if few is not stored else df
        got, p = sketches.describe_sketches(few).first(), rows.where("prediction IS NOT NULL").toPandas()["prediction"]
        assert got["n_rows"] == rows.count() and got["count"] == len(p) and got["n_eras"] == rows.select("era").distinct().count()
        assert abs(got["mean"] - p.mean()) < 1e-9 * 1e6 and abs(got["std"] - p.std()) < 1e-6 * p.std()
        assert got["min"] == p.min() and got["max"] == p.max() and abs(got["n_ids"] / rows.count() - 1) < 0.04
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert (p < got[name]).mean() - 0.02 <= q <= (p <= got[name]).mean() + 0.02
        for r in sketches.share_below(few, [1e6 - 50.0, 1e6, 1e6 + 1e9]).collect():
            assert abs(r["share"] - (p <= r["bound"]).mean()) < 0.02
    gone = sketches.describe_sketches(sketches.era_sketches(df.withColumn("prediction", F.lit(float("nan"))))).first()
    assert gone["count"] == 0 and gone["mean"] is None and gone["p50"] is None and gone["n_rows"] == n
    assert sketches.describe_sketches(stored, by=[]).count() == 1


def test_era_tables_move_nothing(spark):
    df = spark.range(4000).select((F.col("id") % 13).cast("int").alias("era"), F.col("id").alias("row_idx"), (F.hash("id") % 97).cast("double").alias("prediction"),
                                  (F.hash("id", F.lit(1)) % 5 / 4).alias("target"))
    path = scratch_path(spark, "era-table")
    table = layout.write_era_table(df, path, order=["prediction"])
    again = layout.open_era_table(spark, path)
    want = {r["era"]: r["corr"] for r in metrics.era_corr(df).collect()}
    for t in (table, again):
        out = metrics.era_corr(t, strategy="window")
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r["era"]: r["corr"] for r in out.collect()}
        assert got.keys() == want.keys() and all(abs(got[e] - want[e]) < 1e-12 for e in want)
    assert layout.write_era_table(df.limit(10), path, buckets=3).count() == 10
