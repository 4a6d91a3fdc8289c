"""Linear fits from factors against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from erascore.functions import vectors
from erascore.operators import leastsquares, models
from erascore.session import scratch_path


def _frame(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.laplace(size=n)
    rows = [(i, i % 9, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "row_idx long, era int, a double, b double, c double, target double").repartition(5), x, y


def test_subsets_from_one_scan(spark):
    df, x, y = _frame(spark)
    for names, model in zip((["a"], ["c", "b"], ["a", "b", "c"]), leastsquares.fit_subsets(df, [["a"], ["c", "b"], ["a", "b", "c"]]), strict=True):
        cols = np.c_[x[:, ["abc".index(n) for n in names]], np.ones(len(x))]
        want = np.linalg.lstsq(cols, y, rcond=None)[0]
        assert np.allclose([*model.coefficients, model.intercept], want)
    assert model.transform(df).columns[-1] == "score"


def test_ledger_windows_overlap_and_grow(spark):
    df, x, y = _frame(spark)
    path = scratch_path(spark, "ledger-test")
    assert leastsquares.read_ledger(spark, path) is None
    leastsquares.write_ledger(df.where("era < 5"), path, ["a", "b", "c"])
    leastsquares.write_ledger(df.where("era >= 5"), path, ["a", "b", "c"])
    with pytest.raises(ValueError, match="already"):
        leastsquares.write_ledger(df.where("era = 5"), path, ["a", "b", "c"])
    ledger = leastsquares.read_ledger(spark, path)
    # expanding windows: an era counts in every window from its own on
    windows = ledger.select("*", F.explode(F.sequence("era", F.lit(8))).alias("upto"))
    fits = {r["upto"]: r for r in leastsquares.solve_ledger(windows, "upto", ["a", "b", "c"]).collect()}
    era = np.arange(len(x)) % 9
    for upto in range(9):
        own = era <= upto
        want = np.linalg.lstsq(np.c_[x[own], np.ones(own.sum())], y[own], rcond=None)[0]
        assert fits[upto]["n"] == own.sum() and np.allclose(fits[upto]["beta"], want)


def test_walk_forward_from_a_stored_ledger(spark):
    df, *_ = _frame(spark)
    ledger = leastsquares.era_ledger(df, ["a", "b"])
    direct = models.walk_forward_fit(df, ["a", "b"], block=2).orderBy("step").collect()
    stored = models.walk_forward_fit(df, ["a", "b"], block=2, ledger=ledger).orderBy("step").collect()
    fitted = models.walk_forward_fit(df, ["a", "b"], block=2, fit=lambda tr: models.regressor_fit(tr, ["a", "b"])).orderBy("step").collect()
    assert len(direct) == 4
    for d, s, f in zip(direct, stored, fitted, strict=True):
        assert d["step"] == s["step"] == f["step"] and d["n_train"] == f["n_train"] and d["n_valid"] == f["n_valid"] == s["n_valid"]
        assert abs(d["valid_corr_mean"] - f["valid_corr_mean"]) < 1e-9 and abs(d["valid_corr_mean"] - s["valid_corr_mean"]) < 1e-9
    assert [r["step"] for r in models.walk_forward_fit(df, ["a", "b"], block=2, steps=2).collect()] == [0, 1]


def test_absolute_error_is_optimal(spark):
    df, x, y = _frame(spark)
    model = models.regressor_fit(df, ["a", "b", "c"], loss="absoluteError")
    cols = np.c_[x, np.ones(len(x))]
    beta = np.array([*model.coefficients, model.intercept])

    def loss(b):
        return np.abs(y - cols @ b).sum()

    rng = np.random.default_rng(9)
    least = loss(beta)
    for size in (1e-1, 1e-2, 1e-3):
        assert all(loss(beta + size * rng.normal(size=4)) > least * (1 - 1e-6) for _ in range(200))
    assert least < loss(np.linalg.lstsq(cols, y, rcond=None)[0])
    # at the optimum the signs of the residuals balance but for the rows that are fitted exactly
    r = y - cols @ beta
    exact = np.abs(r) < 1e-2
    assert (np.abs(np.sign(r[~exact]) @ cols[~exact]) <= np.abs(cols[exact]).sum(axis=0) + 0.5).all()


def test_absolute_error_of_an_exact_fit_and_of_no_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "a double, target double")
    model = leastsquares.absolute_fit(df, ["a"])
    assert abs(model.coefficients[0] - 2) < 1e-9 and abs(model.intercept - 1) < 1e-8
    with pytest.raises(ValueError):
        leastsquares.absolute_fit(df.limit(0), ["a"])


def test_missing_values_raise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, target double")
    with pytest.raises(Exception, match="missing value in a"):
        leastsquares.fit_subsets(df, [["a"]])


def test_ensembles_of_networks(spark):
    rng = np.random.default_rng(3)
    net = [models.DenseLayer(rng.normal(size=(2, 4)), rng.normal(size=4), "relu"), models.DenseLayer(rng.normal(size=(4, 5)), rng.normal(size=5), "softmax")]
    other = [models.DenseLayer(rng.normal(size=(2, 5)), rng.normal(size=5), "softmax")]
    head = [models.DenseLayer(rng.normal(size=(2, 1)), rng.normal(size=1), "sigmoid")]
    x = rng.normal(size=(40, 2))
    df = spark.createDataFrame([(str(i), float(a), float(b)) for i, (a, b) in enumerate(x)], "id string, a double, b double")
    out = models.ensemble_wide_score([net, other], df, ["a", "b"], "MLP")
    assert "Exchange" not in out._jdf.queryExecution().toString()
    got = {r["id"]: r for r in out.collect()}
    for t, layers in enumerate((net, other)):
        want = models.forward(x, layers).argmax(axis=1) / 4
        assert np.allclose([got[str(i)][f"trial_{t}"] for i in range(40)], want)
    auto = models.ensemble_score([(other, head), (other, head)], df.withColumn("v", F.array("b", "a")), "v", "AE")
    want = models.forward(x[:, ::-1], head)[:, 0]
    assert all(abs(r["prediction"] - want[int(r["id"])]) < 1e-12 for r in auto.collect()) and auto.count() == 80


def test_ensemble_members(spark):
    assert vectors.parse_member("m1, MLP ,3,p,YX") == vectors.Member("m1", "MLP", 3, "p", "YX")
    assert vectors.parse_member("-") is None and vectors.parse_member(" ") is None and vectors.parse_member(None) is None
    for bad in ("a,b,c", "a,b,x,d,e"):
        with pytest.raises(ValueError):
            vectors.parse_member(bad)
    rows = spark.createDataFrame([("m1, MLP ,3,p,YX",), ("-",), (None,)], "s string").select(vectors.member_column("s").alias("m")).collect()
    assert [None if r["m"] is None else tuple(r["m"]) for r in rows] == [("m1", "MLP", 3, "p", "YX"), None, None]
    with pytest.raises(Exception, match="five fields"):
        spark.createDataFrame([("a,b",)], "s string").select(vectors.member_column("s").alias("m")).collect()
