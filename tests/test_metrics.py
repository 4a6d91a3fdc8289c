"""Metrics against direct NumPy/pandas forms of the reference's definitions, plus properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from erascore.operators import metrics, neutralize


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 1200
    pdf = pd.DataFrame({
        "row_idx": np.arange(n),
        "era": rng.integers(1, 7, n),
        "f1": rng.random(n), "f2": rng.random(n), "f3": rng.random(n),
    })
    pdf["prediction"] = np.round(0.3 * pdf.f1 + 0.7 * rng.random(n), 2)  # ties
    pdf["target"] = np.round(rng.random(n) * 4) / 4
    pdf["example_preds"] = rng.random(n)
    return spark.createDataFrame(pdf), pdf


def _ref_corr(d):
    r = d["prediction"].rank(pct=True, method="first")
    return np.corrcoef(r, d["target"])[0, 1]


def _unif(s):
    return (s.rank(method="first") - 0.5) / len(s)


def test_era_corr(frame):
    df, pdf = frame
    got = metrics.era_corr(df).toPandas().set_index("era")["corr"].sort_index()
    exp = pdf.sort_values("row_idx").groupby("era")[["prediction", "target"]].apply(_ref_corr)
    assert np.allclose(got.values, exp.values, atol=1e-12)


def test_summary_payout_drawdown(frame):
    df, pdf = frame
    per = metrics.era_corr(df)
    exp = pdf.groupby("era")[["prediction", "target"]].apply(_ref_corr)
    s = metrics.corr_summary(per).first()
    assert np.isclose(s.corr_mean, exp.mean()) and np.isclose(s.corr_std, exp.std(ddof=0))
    assert np.isclose(s.sharpe, exp.mean() / exp.std(ddof=0))
    assert np.isclose(metrics.payout(per).first().payout, exp.clip(-0.25, 0.25).mean())
    rm = (exp + 1).cumprod().rolling(100, min_periods=1).max()
    dv = (exp + 1).cumprod()
    dd = metrics.max_drawdown(per).first().max_drawdown
    assert np.isclose(dd, -((rm - dv) / rm).max()) and dd <= 0


def test_mmc_matches_least_squares(frame):
    df, pdf = frame
    got = metrics.mmc_per_era(df).toPandas().set_index("era").sort_index()
    for era, x in pdf.groupby("era"):
        u, v = _unif(x["prediction"]).values, _unif(x["example_preds"]).values
        ex = np.column_stack([v, np.full(len(v), u.mean())])
        resid = u - ex @ np.linalg.lstsq(ex, u, rcond=None)[0]
        mmc = np.cov(resid, x["target"])[0, 1] / 0.29 ** 2
        assert np.isclose(got.loc[era, "mmc"], mmc, atol=1e-12)
        assert np.isclose(got.loc[era, "corr"], np.corrcoef(pd.Series(u).rank(pct=True, method="first"),
                                                            x["target"])[0, 1])


def test_neutralize_matches_pinv(frame):
    df, pdf = frame
    feats = ["f1", "f2", "f3"]
    for wide in (False, True):
        given = F.array(*feats) if wide else None
        got = neutralize.neutralize(df.withColumn("x", given) if wide else df, "prediction", "x" if wide else feats, out="n").toPandas().set_index("row_idx")
        for era, x in pdf.groupby("era"):
            s = _unif(x["prediction"]).values.reshape(-1, 1)
            e = x[feats].values
            s = s - e.dot(np.linalg.pinv(e).dot(s))
            s = s / s.std(ddof=0)
            assert np.allclose(got.loc[x["row_idx"], "n"].values, s.ravel(), atol=1e-9)


def test_neutralized_is_orthogonal(frame):
    df, _ = frame
    feats = ["f1", "f2"]
    n = neutralize.neutralize(df, "prediction", feats, out="n")
    dots = n.groupBy("era").agg(*[F.sum(F.col("n") * F.col(f)).alias(f) for f in feats]).toPandas()
    assert np.allclose(dots[feats].values, 0, atol=1e-8)


def test_rank_corr_invariant_under_monotone_map(frame):
    df, _ = frame
    a = metrics.era_corr(df).orderBy("era").toPandas()["corr"]
    b = metrics.era_corr(df.withColumn("prediction", F.exp(F.col("prediction") * 3))).orderBy("era").toPandas()["corr"]
    assert np.allclose(a, b)


def test_missing_rules(spark):
    rows = [(1, 0.1, 0.0, 0), (1, 0.5, None, 1), (1, 0.9, 1.0, 2), (2, 0.2, 0.0, 3), (2, 0.4, 1.0, 4)]
    df = spark.createDataFrame(rows, "era int, prediction double, target double, row_idx int")
    per = {r.era: r.corr for r in metrics.era_corr(df).collect()}
    assert per[1] is None and np.isclose(per[2], 1.0)
    # mean skips the missing era, payout does not turn it into +-0.25
    assert np.isclose(metrics.corr_summary(metrics.era_corr(df)).first().corr_mean, 1.0)
    assert np.isclose(metrics.payout(metrics.era_corr(df)).first().payout, 0.25)


def test_feature_exposure_pairwise(spark):
    rows = [(1, 0.1, 0.2, 0), (1, 0.5, None, 1), (1, 0.9, 0.7, 2), (1, 0.3, 0.1, 3)]
    df = spark.createDataFrame(rows, "era int, prediction double, f double, row_idx int")
    got = metrics.era_feature_exposure(df, ["f"]).first().abs_exposure
    d = pd.DataFrame(rows, columns=["era", "p", "f", "i"])
    assert np.isclose(got, abs(d["f"].corr(d["p"])))


def test_quantiles_exact(spark):
    vals = np.random.default_rng(2).random(101)
    df = spark.createDataFrame(pd.DataFrame({"prediction": vals, "i": np.arange(101)}))
    d = metrics.describe_predictions(df, tiebreak=["i"], strategy="range").first()
    s = pd.Series(vals)
    assert np.isclose(d.p25, s.quantile(0.25)) and np.isclose(d.p50, s.median()) and np.isclose(d.p75, s.quantile(0.75))
    assert d["count"] == 101 and np.isclose(d["std"], s.std())


def test_array_features_equal_columns(frame):
    df, _ = frame
    arr = df.withColumn("x", F.array("f1", "f2", "f3"))
    a = metrics.max_feature_exposure(arr, "x").first()[0]
    b = metrics.max_feature_exposure(df, ["f1", "f2", "f3"]).first()[0]
    assert np.isclose(a, b)
    ea = sorted(r.exposure for r in metrics.feature_exposure(arr, "x").collect())
    eb = sorted(r.exposure for r in metrics.feature_exposure(df, ["f1", "f2", "f3"]).collect())
    assert np.allclose(ea, eb)


def test_file_position(spark, sf_dir):
    from erascore.sources.tables import read_table, with_file_position
    ev = with_file_position(read_table(spark, sf_dir, "events")).select("event_id", "_file", "_row")
    rows = ev.orderBy("_row").limit(3).collect()
    assert [r._row for r in rows] == [0, 1, 2]


def test_nan_is_missing(spark):
    nan = float("nan")
    rows = [(1, 0.1, 0.0, 0), (1, nan, 1.0, 1), (1, 0.9, 1.0, 2), (1, 0.5, 0.0, 3),
            (2, 0.2, 0.0, 4), (2, 0.4, nan, 5), (2, 0.3, 1.0, 6)]
    df = spark.createDataFrame(rows, "era int, prediction double, target double, row_idx int")
    from erascore.operators import ranking
    r = {x.row_idx: x.rank_pct for x in ranking.rank_pct_first(df, "prediction", ["era"], ["row_idx"]).collect()}
    pdf = pd.DataFrame(rows, columns=["era", "p", "t", "i"])
    exp = pdf.groupby("era")["p"].rank(pct=True, method="first")
    for i, v in exp.items():
        assert (r[i] is None and np.isnan(v)) or np.isclose(r[i], v)
    per = {x.era: x.corr for x in metrics.era_corr(df).collect()}
    assert per[1] is None and per[2] is None  # any missing prediction or target -> no correlation


def test_exposure_arrow_equals_explode(spark):
    rng = np.random.default_rng(11)
    n, k = 600, 40
    x = rng.random((n, k))
    x[rng.random((n, k)) < 0.05] = np.nan
    p = rng.random(n)
    p[rng.random(n) < 0.03] = np.nan
    cols = [f"f{i}" for i in range(k)]
    pdf = pd.DataFrame(x, columns=cols)
    pdf["prediction"], pdf["era"] = p, rng.integers(1, 5, n)
    df = spark.createDataFrame(pdf)
    a = metrics.era_feature_exposure(df, cols, method="arrow").toPandas().set_index(["era", "feature"]).sort_index()
    b = metrics.era_feature_exposure(df, cols, method="explode").toPandas().set_index(["era", "feature"]).sort_index()
    assert np.allclose(a["abs_exposure"].astype(float), b["abs_exposure"].astype(float), atol=1e-10)
    for era, g in pdf.groupby("era"):
        exp = g[cols].corrwith(g["prediction"]).abs().max()
        got = a.loc[era, "abs_exposure"].astype(float).max()
        assert np.isclose(got, exp)


def test_range_plan_matches_window_plan_in_composites(frame):
    df, _ = frame
    for fn in (lambda s: metrics.mmc_per_era(df, strategy=s),
               lambda s: neutralize.neutralize(df, "prediction", ["f1", "f2"], out="n", strategy=s)
               .select("row_idx", "n")):
        a = fn("range").toPandas()
        b = fn("window").toPandas()
        key = a.columns[0]
        a, b = a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
        assert np.allclose(a.values.astype(float), b.values.astype(float), atol=1e-12)


def test_neutralize_twice_is_once_up_to_scale(frame):
    df, _ = frame
    feats = ["f1", "f2", "f3"]
    once = neutralize.neutralize(df, "prediction", feats, out="n1", normalize=False)
    twice = neutralize.neutralize(once, "n1", feats, out="n2", normalize=False)
    pdf = twice.select("era", "n1", "n2").toPandas()
    for _, g in pdf.groupby("era"):
        assert np.allclose(g["n1"], g["n2"] * (g["n1"].std(ddof=0) / g["n2"].std(ddof=0)), atol=1e-9)


def test_unif_mean_is_half(frame):
    from erascore.operators import ranking
    df, _ = frame
    m = ranking.unif(df, "prediction", ["era"], ["row_idx"]).groupBy("era").agg(F.avg("unif").alias("m")).toPandas()
    assert np.allclose(m["m"], 0.5)


def test_neutralize_two_columns_matches_matrix_form(frame):
    df, pdf = frame
    feats = ["f1", "f2", "f3"]
    for wide in (False, True):
        given = df.withColumn("x", F.array(*feats)) if wide else df
        got = neutralize.neutralize(given, ["prediction", "example_preds"], "x" if wide else feats, out=["n1", "n2"]).toPandas().set_index("row_idx")
        for era, x in pdf.groupby("era"):
            s = np.column_stack([_unif(x["prediction"]).values, _unif(x["example_preds"]).values])
            e = x[feats].values
            s = s - e.dot(np.linalg.pinv(e).dot(s))
            s = s / s.std(ddof=0)
            assert np.allclose(got.loc[x["row_idx"], ["n1", "n2"]].values, s, atol=1e-9)


def test_single_row_and_constant_eras(spark):
    rows = [(1, 0.3, 1.0, 0),                                   # one row: no correlation
            (2, 0.5, 0.0, 1), (2, 0.5, 1.0, 2), (2, 0.5, 0.5, 3),  # constant prediction still ranks by position
            (3, 0.2, 0.5, 4), (3, 0.7, 0.5, 5)]                 # constant target: zero variance
    df = spark.createDataFrame(rows, "era int, prediction double, target double, row_idx int")
    per = {r.era: r.corr for r in metrics.era_corr(df).collect()}
    assert per[1] is None and per[3] is None
    exp = np.corrcoef([1 / 3, 2 / 3, 1.0], [0.0, 1.0, 0.5])[0, 1]
    assert np.isclose(per[2], exp)
    mm = {r.era: r.mmc for r in metrics.mmc_per_era(
        df.withColumn("example_preds", F.col("row_idx") * 0.1)).collect()}
    assert mm[1] is None  # covariance of one row is undefined


def test_missing_example_id_raises(spark):
    from erascore.operators import joins
    valid = spark.createDataFrame([("a", 1, 0.1), ("b", 1, 0.2)], "id string, era int, prediction double")
    example = spark.createDataFrame([("a", 0.5)], "id string, example_preds double")
    with pytest.raises(joins.MissingIdsError):
        joins.align_example_preds(valid, example)
    ok = joins.align_example_preds(valid.where(F.col("id") == "a"), example)
    assert ok.count() == 1


def test_feature_exposure_arrow_equals_explode(spark):
    rng = np.random.default_rng(5)
    n, k = 400, 36
    x = rng.random((n, k))
    x[rng.random((n, k)) < 0.002] = np.nan  # a few features get a missing value -> no exposure
    cols = [f"f{i}" for i in range(k)]
    pdf = pd.DataFrame(x, columns=cols)
    pdf["prediction"], pdf["row_idx"] = np.round(rng.random(n), 2), np.arange(n)
    df = spark.createDataFrame(pdf)
    a = metrics.feature_exposure(df, cols, method="arrow").toPandas().set_index("feature").sort_index()
    b = metrics.feature_exposure(df, cols, method="explode").toPandas().set_index("feature").sort_index()
    assert a["exposure"].isna().equals(b["exposure"].isna())
    assert np.allclose(a["exposure"].dropna().astype(float), b["exposure"].dropna().astype(float), atol=1e-10)
