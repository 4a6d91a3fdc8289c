"""One behaviour at every size: plans chosen by width or size give the same values, and nothing is lost."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from erascore.operators import factors, joins, metrics, models, neutralize, ranking, registry, splits
from erascore.plans import evaluation, pipelines
from erascore.sources import readers
from erascore.streaming import rounds

NAN = float("nan")


def _frame(spark, missing=True, eras=3, n=60, k=4):
    rnd = np.random.default_rng(11)
    rows = []
    for i in range(eras * n):
        x = [float(v) for v in rnd.normal(size=k)]
        x[1] += 1e8        # an offset costs no digits
        x[2] = 0.1         # a constant has no correlation
        p = float(rnd.random())
        if missing and i % 17 == 0:
            x[0] = None if i % 2 else NAN
        if missing and i % 23 == 0:
            p = None if i % 2 else NAN
        rows.append((i, i % eras, p, float(rnd.integers(5)) / 4, *x))
    return spark.createDataFrame(rows, "row_idx long, era long, prediction double, target double, " + ", ".join(f"f{j} double" for j in range(k)))


FEATS = ["f0", "f1", "f2", "f3"]


def _same(a, b, within=1e-9):
    assert set(a) == set(b)
    for key in a:
        assert (a[key] is None) == (b[key] is None), key
        if a[key] is not None:
            assert abs(a[key] - b[key]) < within, (key, a[key], b[key])


def test_exposure_paths_agree(spark):
    df = _frame(spark).withColumn("x", F.array(*FEATS))

    def per(features, method):
        rows = metrics.era_feature_exposure(df, features, method=method).collect()
        return {(r["era"], r["feature"].replace("x[", "f").rstrip("]")): r["abs_exposure"] for r in rows}

    one = per(FEATS, "explode")
    assert one[0, "f2"] is None and one[0, "f1"] is not None
    _same(one, per(FEATS, "arrow"), 1e-6)
    _same(one, per("x", "arrow"), 1e-6)
    whole = {r["feature"]: r["exposure"] for r in metrics.feature_exposure(df, FEATS, method="explode").collect()}
    _same(whole, {r["feature"]: r["exposure"] for r in metrics.feature_exposure(df, FEATS, method="arrow").collect()}, 1e-6)
    pd_ = df.select("era", "prediction", "f1").toPandas()
    for era, g in pd_.groupby("era"):
        assert abs(abs(g["prediction"].corr(g["f1"])) - one[era, "f1"]) < 1e-6


def test_missing_vectors_count_as_missing(spark):
    rows = [(i, 0.1 * (i % 7), [float(i), float(i * i % 5)] if i % 9 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "row_idx long, prediction double, x array<double>").repartition(4)
    assert all(r["exposure"] is None for r in metrics.feature_exposure(df, "x").collect())


@pytest.mark.parametrize("normalize", [True, False])
def test_neutralization_paths_agree(spark, normalize):
    df = _frame(spark).withColumn("f1", F.col("f1") - 1e8).withColumn("x", F.array(*FEATS))

    def run(neutralizers):
        out = neutralize.neutralize(df, "prediction", neutralizers, out="n", normalize=normalize)
        return {r["row_idx"]: r["n"] for r in out.collect()}

    small = run(FEATS)
    _same(small, run("x"))
    gone = {r["row_idx"] for r in df.collect() if any(v is None or v != v for v in (r["prediction"], *(r[f] for f in FEATS)))}
    assert gone and {i for i, v in small.items() if v is None} == gone
    # the rows left are the least-squares residual of their era
    pdf = neutralize.ranking.unif(df, "prediction", ["era"], ["row_idx"], out="u").toPandas() if normalize else df.withColumn("u", F.col("prediction")).toPandas()
    for _, g in pdf.groupby("era"):
        g = g[[small[i] is not None for i in g["row_idx"]]]
        e, s = g[FEATS].to_numpy(float), g["u"].to_numpy(float)
        r = s - e @ (np.linalg.pinv(e) @ s)
        assert np.allclose(r / r.std(), [small[i] for i in g["row_idx"]], atol=1e-6)


def test_factors_handed_on_early_change_nothing(spark, monkeypatch):
    df = _frame(spark, missing=False).withColumn("f1", F.col("f1") - 1e8)
    want = {r["row_idx"]: r["n"] for r in neutralize.neutralize(df, "prediction", FEATS, out="n").collect()}
    monkeypatch.setattr(factors, "HELD_VALUES", 1)
    monkeypatch.setattr(factors, "_STRETCH", 3)
    monkeypatch.setattr(factors, "_SALTED_FROM", 0)  # merged in two steps
    _same(want, {r["row_idx"]: r["n"] for r in neutralize.neutralize(df, "prediction", FEATS, out="n").collect()})


def test_near_collinear_neutralizers_stay_orthogonal(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    near = x[:, 0] + 3e-8 * x[:, 2]  # condition 5e7: its square is beyond doubles
    rows = [(i, i % 2, float(rng.random()), *map(float, x[i]), float(near[i]), float(x[i, 1])) for i in range(400)]
    df = spark.createDataFrame(rows, "row_idx long, era int, prediction double, a double, b double, c double, d double, e double").repartition(5)
    pdf = neutralize.neutralize(df, "prediction", list("abcde"), out="n").toPandas()
    for _, g in pdf.groupby("era"):
        assert np.abs(g[list("abcde")].to_numpy().T @ g["n"].to_numpy()).max() < 1e-6
        assert abs(g["n"].std(ddof=0) - 1) < 1e-9


def test_more_neutralizers_than_rows(spark):
    rows = [(i, None if i < 3 else "b", float(i % 3), [float((i * j) % 7) for j in range(1, 9)]) for i in range(6)]
    df = spark.createDataFrame(rows, "row_idx long, era string, prediction double, x array<double>")
    out = neutralize.neutralize(df, "prediction", "x", out="n", proportion=0.5)
    assert out.count() == 6 and all(r["n"] is None or r["n"] == r["n"] for r in out.collect())
    none = neutralize.neutralize(df.limit(0), "prediction", "x", out="n")
    assert none.count() == 0


def test_factors_merge_to_the_factor_of_all_rows(spark):
    import numpy as np

    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.array(*[F.sin(F.col("id") * k).cast("double") for k in (1, 2, 5)], F.lit(1.0)).alias("v"))
    led = factors.group_factors(df.repartition(6), "g", F.col("v"), 4).collect()
    for g in range(3):
        r = np.array([x["row"] for x in led if x["g"] == g])
        a = np.array([x["v"] for x in df.where(F.col("g") == g).collect()])
        assert len(r) <= 4 and np.allclose(r.T @ r, a.T @ a) and sum(x["n"] for x in led if x["g"] == g) == len(a)


def test_report_over_a_vector_equals_columns(spark):
    df = _frame(spark, missing=False).withColumn("f1", F.col("f1") - 1e8).withColumn("example_preds", F.col("f3")).withColumn("x", F.array(*FEATS))
    a = evaluation.validation_report(df, FEATS).first().asDict()
    _same(a, evaluation.validation_report(df, "x").first().asDict())


def test_exact_splits_do_not_move_the_payload(spark, monkeypatch):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.array(F.col("id") * 1.0).alias("x"))
    want = sorted((r["id"] for r in df.collect()), key=lambda i: (__import__("hashlib").md5(f"{i}3".encode()).hexdigest(), i))
    out = splits.random_holdout_exact(df, 0.2, seed=3)
    assert {r["id"] for r in out.where("dataset = 'valid'").collect()} == set(want[:1000])
    assert "Exchange" not in out._jdf.queryExecution().toString()
    monkeypatch.setattr(splits, "FEW_ROWS", 1)  # every histogram is refined
    monkeypatch.setattr(splits, "PREFIX", 1)
    out = splits.three_way_split(df, 0.5, 0.25, seed=3)
    got = {p: {r["id"] for r in out.where(F.col("dataset") == p).collect()} for p in ("train", "valid", "test")}
    assert got == {"train": set(want[:2500]), "valid": set(want[2500:3750]), "test": set(want[3750:])}
    empty = df.limit(0)
    assert splits.random_holdout_exact(empty, 0.2).collect() == [] == splits.three_way_split(empty, 0.5, 0.2).collect()


def test_head_and_tail_with_missing_order_values(spark):
    rows = [(i, None if i % 5 == 0 else NAN if i % 7 == 0 else float(-i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, v double").withColumn("x", F.array("id"))
    order = sorted(rows, key=lambda r: (r[1] is None or r[1] != r[1], r[1] if r[1] is not None and r[1] == r[1] else 0, r[0]))
    for share in (0.0, 0.3, 0.9, 1.0):
        out = splits.head_tail_split(df, share, ["v", "id"])
        assert {r["id"] for r in out.where("part = 'head'").collect()} == {r[0] for r in order[:int(100 * share)]}
        assert "Exchange" not in out._jdf.queryExecution().toString()


def test_approximate_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    a, b = ({r["id"]: r["dataset"] for r in splits.three_way_split(df.repartition(n), 0.5, 0.3, exact=False).collect()} for n in (1, 7))
    assert a == b and 800 < sum(v == "train" for v in a.values()) < 1200


def test_quantiles_skip_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (NAN,), (None,)], "prediction double")
    r = metrics.describe_predictions(df).first()
    assert (r["count"], r["p25"], r["p50"], r["p75"], r["max"]) == (4, 1.75, 2.5, 3.25, 4.0)


def test_wide_payload_is_joined_back(spark, monkeypatch):
    df = _frame(spark, missing=False)
    want = {r["row_idx"]: r["rn"] for r in ranking.group_row_number(df, ["era"], "prediction", ["row_idx"], out="rn", strategy="window").collect()}
    for carried in (0, 10**6):
        monkeypatch.setattr(ranking, "CARRIED_BYTES", carried)
        out = ranking.group_row_number(df, ["era"], "prediction", ["row_idx"], out="rn", strategy="range")
        assert {r["row_idx"]: r["rn"] for r in out.collect()} == want and "f3" in out.columns


def test_walk_forward_reaches_the_last_era(spark):
    df = spark.createDataFrame([(i, i // 4, float(i % 5), float(i % 3)) for i in range(4 * 100)], "row_idx long, era long, f double, target double")
    steps = {r["step"] for r in splits.era_walk_forward(df, block=2).select("step").distinct().collect()}
    assert steps == set(range(50))
    seen = []

    def fit(train, epoch):
        seen.append(epoch)
        return models.regressor_fit(train, ["f"])

    out = models.walk_forward_fit(df.where("era < 8"), ["f"], block=2, fit=fit, epochs=2).orderBy("step").collect()
    assert [r["step"] for r in out] == [0, 1, 2] and {r["epoch"] for r in out} == {1} and sorted(seen) == [1, 1, 1, 2, 2, 2]


def test_best_epoch_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("trial,epoch\n1,5\n60,7\n")
    (tmp_path / "base.csv").write_text("trial,epoch\n1,2\n")

    def read(name, fallback=None):
        return sorted(tuple(r) for r in registry.read_best_epochs(spark, str(tmp_path), name, fallback).collect())

    assert read("a", "base") == [(1, 5, "own"), (60, 7, "own")] and read("b", "base") == [(1, 2, "fallback")] and read("b") == []
    models_ = spark.createDataFrame([("a",)], "model string")
    own = registry.read_best_epochs(spark, str(tmp_path), "a").select(F.lit("a").alias("model"), "trial", "epoch")
    table = registry.best_epoch_table(models_, own, registry.read_best_epochs(spark, str(tmp_path), "base").select("trial", "epoch"))
    assert {r["trial"]: r["epoch"] for r in table.collect()}[60] == 7


def test_shards_under_two_folders(spark, tmp_path):
    for name, era in (("one", 1), ("two", 2)):
        spark.createDataFrame([(era * 10,)], "v long").withColumn("era", F.lit(era)).write.partitionBy("era").parquet(str(tmp_path / name))
    out = readers.read_shards(spark, f"{tmp_path}/one/era=* {tmp_path}/two/era=*")
    assert sorted((r["v"], r["era"]) for r in out.collect()) == [(10, 1), (20, 2)]


def test_late_rounds_and_redeliveries(spark, tmp_path):
    source, sink, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    schema = spark.createDataFrame([], "id string, v double, round int").schema
    deliveries = [(30, range(5)), (25, range(5)), (21, range(5)), (30, range(3, 8)), (1, range(2)), (21, range(5))]
    for turn, (rnd, ids) in enumerate(deliveries):
        rows = [(str(i), float(turn), rnd) for i in ids] * 2
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        if turn in (2, 5):  # a scheduled run after some deliveries, one file per micro-batch
            rounds.stream_score(spark, source, schema, sink, ckpt, lambda b: b.select("round", "id", "v"), max_files_per_trigger=1)
    got = sorted((r["round"], r["id"]) for r in spark.read.parquet(sink).collect())
    assert got == sorted({(rnd, str(i)) for rnd, ids in deliveries for i in ids})


def test_chain_decode_and_heads(spark):
    rnd = np.random.default_rng(5)
    first = models.DenseLayer(rnd.normal(size=(2, 3)), rnd.normal(size=3), "relu")
    norm = models.BatchNormLayer(*(np.abs(rnd.normal(size=3)) + 0.1 for _ in range(4)))
    five, head = models.DenseLayer(rnd.normal(size=(3, 5)), np.zeros(5), "softmax"), models.DenseLayer(np.ones((3, 1)) * 0.1, np.zeros(1), "sigmoid")
    live = spark.createDataFrame([("a", 7, 0.2, None, 0.4), ("b", 8, NAN, 0.5, 0.6)], "id string, round int, f0 double, f1 double, f2 double")
    x = np.array([[0.5, 0.4], [0.5, 0.6]])
    classes = models.forward(x, [first, norm, five]).argmax(1) / 4
    got = pipelines.live_predictions(live, [first, norm, five], ["f0", "f1", "f2"], "MLP", chain="NaN,0.5,0.5|Slice,1,2|Sparse,5,0", keep=["round"])
    assert [(r["id"], r["round"], r["prediction"]) for r in got.orderBy("id").collect()] == [("a", 7, classes[0]), ("b", 8, classes[1])]
    got = pipelines.live_predictions(live, ([first], [first, norm, head]), ["f0", "f1", "f2"], "AE", chain="NaN,0.5,0.5|Slice,1,2")
    assert np.allclose([r["prediction"] for r in got.orderBy("id").collect()], models.forward(x, [first, norm, head])[:, 0])


def test_ensemble_is_one_pass(spark):
    train = spark.createDataFrame([(str(i), float(i % 5), float(i % 3), float(i % 7) / 7) for i in range(60)], "id string, a double, b double, target double")
    fitted = [models.regressor_fit(train, fs) for fs in (["a"], ["b"], ["a", "b"])]
    out = models.ensemble_wide_score(fitted, train, [["a"], ["b"], ["a", "b"]], "NR")
    assert "Exchange" not in out._jdf.queryExecution().toString() and out.columns == ["id", "trial_0", "trial_1", "trial_2"]
    long = models.ensemble_score(fitted, train, [["a"], ["b"], ["a", "b"]], "NR")
    assert {(r["id"], r["trial"]): r["prediction"] for r in long.collect()} == {(r["id"], t): r[f"trial_{t}"] for r in out.collect() for t in range(3)}


def test_run_plan_joins_by_prefix(spark):
    names = spark.createDataFrame([("a",), ("ab",), (None,), ("abc",), ("zz",), ("",), ("ab",)], "model string")
    config = spark.createDataFrame([("abd", 1), ("a", 2), (None, 3), ("z", 4), ("ab", 5)], "model string, _prefix int")
    config = config.withColumnRenamed("_prefix", "n")
    got = sorted((r["run_model"], r["n"]) for r in joins.model_run_plan(names, config).collect())
    want = [(m, n) for (m,) in [tuple(r) for r in names.collect()] for c, n in [tuple(r) for r in config.collect()]
            if m is not None and c is not None and c.startswith(m)]
    assert got == sorted(want)
    assert joins.model_run_plan(names.limit(0), config).count() == 0
    many = spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("model"))
    plan = joins.model_run_plan(many, many.select("model", F.lit(1).alias("x")))
    assert "NestedLoop" not in plan._jdf.queryExecution().toString()
    assert plan.where("run_model = 'm1'").count() == 11111
