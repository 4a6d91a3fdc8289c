"""Splits, shards, vectors, decoders, registry and model scoring on small literals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from erascore.functions import decode, vectors
from erascore.operators import models, projections, registry, splits
from erascore.session import scratch_path
from erascore.sources import sinks
from erascore.sources import readers as src


def test_exact_split_sizes(spark):
    df = spark.range(0, 1003).select(F.col("id").cast("string").alias("id"))
    out = splits.random_holdout_exact(df, 0.2, seed=3).groupBy("dataset").count().collect()
    assert {r.dataset: r["count"] for r in out} == {"valid": 200, "train": 803}
    three = splits.three_way_split(df, 0.5, 0.3, seed=1).groupBy("dataset").count().collect()
    assert {r.dataset: r["count"] for r in three} == {"train": 501, "valid": 300, "test": 202}
    with pytest.raises(ValueError):
        splits.three_way_split(df, 0.8, 0.3)


def test_balance_filter_nan_rules(spark):
    rows = [(4, 0.5), (5, 0.5), (5, None), (6, None), (6, 0.1), (7, 0.5), (7, 0.9)]
    df = spark.createDataFrame(rows, "era int, target double")
    kept = sorted((r.era, r.target) for r in splits.balance_filter(df).collect())
    assert kept == [(4, 0.5), (5, None), (6, 0.1), (7, 0.9)]


def test_walk_forward_assignment(spark):
    df = spark.createDataFrame([(e,) for e in range(1, 60)], "era int")
    out = splits.era_walk_forward(df).groupBy("step", "role").agg(F.min("era").alias("lo"), F.max("era").alias("hi"))
    got = {(r.step, r.role): (r.lo, r.hi) for r in out.collect()}
    assert got[(0, "train")] == (1, 13) and got[(0, "valid")] == (14, 27) and got[(1, "train")] == (14, 27)


def test_shards_keep_every_row(spark):
    df = spark.range(0, 2500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("era"),
                                     F.when(F.col("id") % 5 == 0, "valid").otherwise("train").alias("dataset"))
    path = scratch_path(spark, "t_shards")
    sinks.write_shards_by_era(df, path, shard_rows=300)
    back = spark.read.parquet(path)
    assert back.count() == 2500 and back.select("id").distinct().count() == 2500
    per_file = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 300


def test_vectors_roundtrip_and_errors(spark):
    df = spark.createDataFrame([(list(map(float, range(12))),)], "x array<float>")
    flat = df.select(F.flatten(vectors.reshape2("x", 3, 4)).alias("f")).first().f
    assert flat == list(map(float, range(12)))
    t = df.select(vectors.reshape_transpose("x", 3, 4).alias("m")).first().m
    assert t == np.arange(12).reshape(4, 3).T.tolist()
    with pytest.raises(Exception):
        df.select(vectors.vec_slice("x", 8, 8)).collect()
    with pytest.raises(ValueError):
        vectors.parse_spec("Slice,1")
    with pytest.raises(ValueError):
        vectors.apply_chain(F.col("x"), F.col("x"), "Bogus,1,2")
    assert vectors.parse_spec("-") == []


def test_decoders(spark):
    rows = [([0.1, 0.2, 0.05, 0.3, 0.35],), ([0.3, 0.1, 0.9, 0.1, 0.1],), ([0.5, float("nan"), 0.05, 0.1, 0.2],)]
    df = spark.createDataFrame(rows, "p array<double>")
    th = [r[0] for r in df.select(decode.threshold_decode("p")).collect()]
    assert th == [0.75, 0.5, 0.0]
    am = [r[0] for r in df.select(decode.argmax_decode("p")).collect()]
    assert am[0] == 1.0 and am[1] == 0.5
    c = spark.createDataFrame([(-0.2,), (1.3,), (float("nan"),), (0.4,)], "p double")
    vals = [r[0] for r in c.select(decode.clamp01("p")).collect()]
    assert vals[0] == 0.0 and vals[1] == 1.0 and np.isnan(vals[2]) and vals[3] == 0.4


def test_best_epoch_rules(spark):
    log = spark.createDataFrame([("m", 1, 1, 0.5), ("m", 1, 2, 0.4), ("m", 1, 3, 0.4), ("m", 1, 4, 0.6)],
                                "model string, trial int, epoch int, value double")
    assert registry.best_epoch(log).first().best_epoch == 2
    assert registry.best_epoch(log, mode="max").first().best_epoch == 4
    models_df = spark.createDataFrame([("a",), ("b",)], "model string")
    own = spark.createDataFrame([("a", 1, 7)], "model string, trial int, epoch int")
    fb = spark.createDataFrame([], "trial int, epoch int")
    t = {(r.model, r.trial): (r.epoch, r.source) for r in registry.best_epoch_table(models_df, own, fb).collect()}
    assert t[("a", 1)] == (7, "own") and t[("b", 5)] == (1, "default") and len(t) == 82


def test_run_config_prefix(spark):
    path = scratch_path(spark, "t_conf")
    lines = ["model path arch version rev trial epoch batch transform",
             "cnn  p NR 1 1 1 35 8192 NaN,2,2", "cnn2 p NR 1 1 1 5 8192 -", "mlp p NR 1 2 1 98 8192 -"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = sorted(r.model for r in src.read_run_config(spark, path, model_prefix="cnn").collect())
    assert got == ["cnn", "cnn2"]


def test_feature_order(spark):
    sets = spark.createDataFrame([(0, 0, "f3"), (0, 1, "f1"), (1, 0, "f1"), (1, 1, "f2")],
                                 "trait_ord int, pos int, feature string")
    assert projections.ordered_features(sets, ["f0", "f1", "f2", "f3", "f4"]) == ["f3", "f1", "f2", "f0", "f4"]


def test_mlp_forward_matches_mllib(spark):
    rng = np.random.default_rng(0)
    rows = [(str(i), *map(float, rng.random(3)), float(rng.integers(0, 5)) / 4) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double, target double")
    m = models.classifier_fit(df, ["a", "b", "c"], hidden=(6,), max_iter=30)
    layers = models.mllib_mlp_layers(m)
    ours = models.mlp_score(df.select("id", F.array("a", "b", "c").alias("x")), "x", layers).toPandas().set_index("id")
    from pyspark.ml.functions import vector_to_array
    ref = m.transform(df).select("id", vector_to_array("_probability").alias("p")).toPandas().set_index("id")
    assert np.allclose(np.stack(ours.loc[ref.index, "scores"].values), np.stack(ref["p"].values), atol=1e-9)


def test_nan_rules_in_filters_and_histogram(spark):
    from erascore.operators import metrics
    nan = float("nan")
    df = spark.createDataFrame([(5, nan), (6, nan), (7, 0.9)], "era int, target double")
    kept = sorted(r.era for r in splits.balance_filter(df).collect())
    assert kept == [5, 7]  # NaN kept where the rule is "not 0.5", dropped where it is "< 0.25 or > 0.75"
    p = spark.createDataFrame([(0.05,), (nan,), (1.0,), (None,)], "prediction double")
    h = {r.label: r.n for r in metrics.decile_histogram(p).collect()}
    assert h["00"] == 1 and h["100"] == 1 and h["missing"] == 2 and sum(h.values()) == 4


def test_era_filter_prunes_shard_partitions(spark, capsys):
    df = spark.range(0, 600).select(F.col("id").cast("string").alias("id"), (F.col("id") % 6).alias("era"),
                                    F.lit("train").alias("dataset"), F.rand(1).alias("v"))
    path = scratch_path(spark, "t_prune")
    sinks.write_shards_by_era(df, path, shard_rows=1000)
    q = src.read_shards(spark, f"{path}/dataset=*").where(F.col("era") == 3).select("id", "v")
    q.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(era" in plan and "(era" in plan
    assert "ReadSchema: struct<id:string,v:double>" in plan
    assert q.count() == 100


def test_round_stream_polling_mode(spark):
    from pyspark.sql import types as T
    from erascore.streaming import rounds
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("arrival", T.TimestampType()),
                           T.StructField("v", T.DoubleType()), T.StructField("round", T.IntegerType())])
    src_dir, sink, ckpt = (scratch_path(spark, n) for n in ("t_rounds", "t_sink", "t_ckpt"))
    rows = spark.range(0, 300).select(F.col("id").cast("string").alias("id"),
                                      F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("arrival"),
                                      (F.col("id") / 300.0).alias("v"), (F.col("id") % 3).cast("int").alias("round"))
    rows.write.partitionBy("round").parquet(src_dir)
    rows.where(F.col("round") == 2).write.mode("append").partitionBy("round").parquet(src_dir)  # re-delivery
    q = rounds.stream_score(spark, src_dir, schema, sink, ckpt, lambda b: b.select("round", "id", "v"),
                            available_now=False, poll_seconds=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.parquet(sink)
    assert out.count() == 300 and out.select("id").distinct().count() == 300
