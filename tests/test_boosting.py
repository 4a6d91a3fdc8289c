"""Boosted trees against a plain implementation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from erascore.operators import boosting
from erascore.session import scratch_path


def _plain(x, y, n_trees, depth, rate, l2):
    out = np.full(len(y), y.mean())
    for _ in range(n_trees):
        r, leaf = y - out, np.zeros(len(y))

        def grow(rows, level):
            g, n = r[rows].sum(), len(rows)
            leaf[rows] = g / (n + l2)
            best = (0.0, None)
            if level < depth:
                for f in range(x.shape[1]):
                    v = np.where(np.isnan(x[rows, f]), -np.inf, x[rows, f])
                    for c in np.unique(v)[:-1]:
                        left = v <= c
                        gl, nl = r[rows][left].sum(), left.sum()
                        gain = gl * gl / (nl + l2) + (g - gl) ** 2 / (n - nl + l2) - g * g / (n + l2)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
            if best[1] is not None:
                grow(rows[best[1]], level + 1)
                grow(rows[~best[1]], level + 1)

        grow(np.arange(len(y)), 0)
        out += rate * leaf
    return out


def _frame(spark):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 12, (300, 3)) / 4.0
    x[rng.random(300) < 0.1, 1] = np.nan
    y = np.where(np.isnan(x[:, 1]), 2.0, x[:, 0] * (x[:, 1] > 1)) + rng.normal(size=300) / 3
    rows = [(i, float(a), None if np.isnan(b) else float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, target double").repartition(4), x, y


def test_equals_plain_boosting(spark):
    df, x, y = _frame(spark)
    model = boosting.boost(df, ["a", "b", "c"], n_trees=3, depth=3, rate=0.5, column_share=1.0)
    want = _plain(x, y, 3, 3, 0.5, 1.0)
    got = {r["id"]: r["score"] for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(300)], want)


def test_resumes_after_a_loss_and_folds(spark, monkeypatch):
    df, x, _ = _frame(spark)
    ledger = scratch_path(spark, "boost")
    args = dict(depth=2, rate=0.3, column_share=0.67, seed=4)
    whole = boosting.boost(df, ["a", "b", "c"], n_trees=4, **args)
    monkeypatch.setattr(boosting, "FOLD_EVERY", 2)
    boosting.boost(df, ["a", "b", "c"], n_trees=1, ledger=ledger, **args)
    grown, real = [], boosting._grown

    def counted(*a):
        if len(grown) == 2:
            raise RuntimeError("lost")
        grown.append(1)
        return real(*a)

    monkeypatch.setattr(boosting, "_grown", counted)
    with pytest.raises(RuntimeError, match="lost"):
        boosting.boost(df, ["a", "b", "c"], n_trees=4, ledger=ledger, **args)
    monkeypatch.setattr(boosting, "_grown", real)
    again = boosting.boost(df, ["a", "b", "c"], n_trees=4, ledger=ledger, **args)
    assert len(again.trees) == 4 and np.allclose(again.predict(x), whole.predict(x))
    assert [t.feature for t in again.trees] == [t.feature for t in whole.trees]
    with pytest.raises(ValueError, match="other settings"):
        boosting.boost(df, ["a", "b"], n_trees=4, ledger=ledger, **args)
    with pytest.raises(ValueError, match="no rows"):
        boosting.boost(df.limit(0), ["a"], n_trees=1)


def test_columns_are_drawn_for_each_tree(spark):
    df, *_ = _frame(spark)
    model = boosting.boost(df, ["a", "b", "c"], n_trees=5, depth=2, rate=0.3, column_share=0.34)
    used = [{f for f in t.feature if f >= 0} for t in model.trees]
    assert all(len(u) == 1 for u in used) and len(set.union(*used)) > 1
    none = boosting.boost(df.withColumn("one", F.lit(1.0)), ["one"], n_trees=1, column_share=1.0)
    assert none.trees[0].feature[0] == -1
