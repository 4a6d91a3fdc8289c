"""Query registrations: splits, projections, readers and writers.

Writer queries write what Spark derives from the driver tables into the shared scratch folder,
read it back with the library's readers and return what they read, so the check covers the
round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import projections, splits
from .session import scratch_path
from .sources import releases, sinks, snapshots
from .sources import readers as src
from .sources.fixtures import FEATURES, tourney, tourney_missing, vec, with_views
from .sources.tables import read_table
from .functions.stats import round6
from .suite import r6, register
from .suite_vectors import explode1

T = "tourney"


def _t(spark, sf):
    return tourney(spark, sf)


# ----------------------------------------------------------------------------- F: splits

@register("every_nth_era", with_views("SELECT id, era FROM tourney WHERE era % 4 = 0", T))
def q_every_nth_era(spark, sf):
    return splits.every_nth_era(_t(spark, sf), 4).select("id", "era")


@register("balance_filter", with_views("""
SELECT id, era, target FROM tourney_missing
WHERE CASE era % 4 WHEN 0 THEN true
               WHEN 1 THEN coalesce(target <> 0.5, true)
               ELSE coalesce(target < 0.25 OR target > 0.75, false) END""", "tourney_missing"))
def q_balance_filter(spark, sf):
    return splits.balance_filter(tourney_missing(spark, sf)).select("id", "era", "target")


@register("random_holdout_exact", with_views("""
SELECT id, CASE WHEN row_number() OVER (ORDER BY md5(id || '7'), id) <= floor(count(*) OVER () * 0.2e0)
           THEN 'valid' ELSE 'train' END AS dataset
FROM tourney WHERE dataset = 'train'""", T))
def q_random_holdout_exact(spark, sf):
    t = _t(spark, sf).where(F.col("dataset") == "train").select("id")
    return splits.random_holdout_exact(t, 0.2, seed=7)


@register("head_holdout", with_views("""
SELECT id, CASE WHEN row_number() OVER (ORDER BY row_idx) <= floor(count(*) OVER () * 0.2e0)
           THEN 'valid' ELSE 'train' END AS dataset
FROM tourney WHERE dataset = 'valid'""", T))
def q_head_holdout(spark, sf):
    t = _t(spark, sf).where(F.col("dataset") == "valid").select("id", "row_idx")
    return splits.head_holdout(t, 0.2, ["row_idx"]).select("id", "dataset")


@register("no_split", with_views("""
SELECT id, CASE WHEN era <= 20 THEN 'train' ELSE 'valid' END AS dataset FROM tourney WHERE dataset <> 'live'""", T))
def q_no_split(spark, sf):
    t = _t(spark, sf)
    train = t.where(F.col("era") <= 20).select("id")
    valid = t.where((F.col("era") > 20) & (F.col("dataset") != "live")).select("id")
    return splits.no_split(train, valid)


@register("mask_select", with_views("SELECT id, era FROM tourney WHERE dataset = 'valid'", T))
def q_mask_select(spark, sf):
    return splits.mask_select(_t(spark, sf), "valid").select("id", "era")


@register("three_way_split", with_views("""
SELECT id, CASE WHEN rn <= floor(n * 0.7e0) THEN 'train'
                WHEN rn <= floor(n * 0.7e0) + floor(n * 0.2e0) THEN 'valid' ELSE 'test' END AS dataset
FROM (SELECT id, row_number() OVER (ORDER BY md5(id || '11'), id) AS rn, count(*) OVER () AS n FROM tourney)""", T))
def q_three_way_split(spark, sf):
    return splits.three_way_split(_t(spark, sf).select("id"), 0.7, 0.2, seed=11)


@register("era_walk_forward", with_views("""
SELECT id, cast(floor(era / 14) AS INTEGER) AS step, 'train' AS role FROM tourney
UNION ALL
SELECT id, cast(floor(era / 14) - 1 AS INTEGER) AS step, 'valid' AS role FROM tourney WHERE floor(era / 14) >= 1""", T))
def q_era_walk_forward(spark, sf):
    return splits.era_walk_forward(_t(spark, sf).select("id", "era")).select("id", "step", "role")


@register("head_tail_split", with_views("""
SELECT id, CASE WHEN row_number() OVER (ORDER BY row_idx) <= floor(count(*) OVER () * 0.5e0)
           THEN 'head' ELSE 'tail' END AS part
FROM tourney WHERE dataset = 'valid'""", T))
def q_head_tail_split(spark, sf):
    t = _t(spark, sf).where(F.col("dataset") == "valid").select("id", "row_idx")
    return splits.head_tail_split(t, 0.5, ["row_idx"]).select("id", "part")


@register("union_train_valid", with_views("""
SELECT id, dataset FROM tourney WHERE dataset = 'train'
UNION ALL
SELECT id, 'valid' AS dataset FROM (
  SELECT id, row_number() OVER (ORDER BY row_idx) AS rn, count(*) OVER () AS n FROM tourney WHERE dataset = 'valid')
WHERE rn <= floor(n * 0.5e0)""", T))
def q_union_train_valid(spark, sf):
    """Train plus the head half of validation."""
    from .operators import joins
    t = _t(spark, sf)
    train = t.where(F.col("dataset") == "train").select("id", "dataset")
    valid = splits.head_tail_split(t.where(F.col("dataset") == "valid").select("id", "row_idx", "dataset"),
                                   0.5, ["row_idx"])
    head = valid.where(F.col("part") == "head").select("id", "dataset")
    return joins.union_train_valid(train, head)


# ----------------------------------------------------------------------------- P: projections

@register("select_by_prefix", with_views(f"SELECT id, {', '.join(FEATURES)} FROM tourney", T))
def q_select_by_prefix(spark, sf):
    return projections.select_by_prefix(_t(spark, sf), "feature", keep=["id"])


@register("select_contiguous_range", with_views(
    "SELECT id, feature_user, target, feature_hour FROM tourney", T))
def q_select_contiguous_range(spark, sf):
    t = _t(spark, sf).select("id", "feature_user", "target", "feature_hour", "prediction")
    return t.select("id", *projections.contiguous_range(t, "feature"))


@register("assemble_xy", with_views("""
SELECT id, cast(pos AS INTEGER) AS pos, cast(value AS DOUBLE) AS value FROM (
  SELECT id, unnest(range(5)) AS pos,
         unnest([cast(feature_user AS FLOAT), cast(feature_hour AS FLOAT), cast(feature_mix AS FLOAT),
                 cast(feature_k AS FLOAT), cast(target AS FLOAT)]) AS value FROM tourney)""", T))
def q_assemble_xy(spark, sf):
    ex = projections.assemble_xy(_t(spark, sf), FEATURES, ["target"])
    return explode1(ex, F.concat("x", "y"))


@register("live_targets_zero", with_views("""
SELECT id, 0 AS pos, 0e0 AS value FROM tourney WHERE dataset = 'live'""", T))
def q_live_targets_zero(spark, sf):
    live = _t(spark, sf).where(F.col("dataset") == "live").select("id", projections.live_targets_zero(1).alias("y"))
    return explode1(live, F.col("y"))


@register("era_number", with_views("""
SELECT id, CASE WHEN dataset = 'live' THEN 0 ELSE era END::BIGINT AS era_num FROM tourney""", T))
def q_era_number(spark, sf):
    t = _t(spark, sf)
    text = F.when(F.col("dataset") == "live", F.lit("X")).otherwise(F.lpad(F.col("era").cast("string"), 4, "0"))
    return t.select("id", projections.era_number(text).alias("era_num"))


@register("pick_target", with_views("SELECT id, cast(cast(example_preds AS FLOAT) AS DOUBLE) AS y FROM tourney", T))
def q_pick_target(spark, sf):
    t = _t(spark, sf)
    ex = projections.assemble_xy(t, FEATURES, ["target", "example_preds", "feature_k"], keep=["id"])
    return ex.select("id", projections.pick_target("y", 1).cast("double").alias("y"))


@register("xy_matrices", with_views("""
SELECT id, cast(pos AS INTEGER) AS pos, value, y FROM (
  SELECT id, unnest(range(4)) AS pos, unnest([feature_user, feature_hour, feature_mix, feature_k]) AS value,
         target AS y FROM tourney)""", T))
def q_xy_matrices(spark, sf):
    m = projections.xy_matrices(_t(spark, sf), FEATURES)
    return m.select("id", F.posexplode("x").alias("pos", "value"), "y")


@register("fill_missing_const", with_views("""
SELECT id, coalesce(feature_user, 0.5) AS feature_user, coalesce(target, 0.5) AS target FROM tourney_missing""",
                                           "tourney_missing"))
def q_fill_missing_const(spark, sf):
    t = tourney_missing(spark, sf).select("id", "feature_user", "target")
    return projections.fill_missing_const(t, ["feature_user", "target"], 0.5)


@register("autoencoder_pair", with_views("""
SELECT id, pos, cast(v AS DOUBLE) AS x, cast(y[1] AS DOUBLE) AS y0
FROM (SELECT id, unnest(range(len(x))) AS pos, unnest(x) AS v, y FROM vec)""", "vec"))
def q_autoencoder_pair(spark, sf):
    v = vec(spark, sf).select("id", projections.autoencoder_pair().alias("label"))
    return v.select("id", F.posexplode("label.x").alias("pos", "x"), F.element_at("label.y", 1).cast("double").alias("y0")).withColumn("x", F.col("x").cast("double"))


# ----------------------------------------------------------------------------- S: sources / sinks

def _write_roles(spark, sf) -> str:
    base = scratch_path(spark, "roles")
    t = _t(spark, sf)
    for role, file in (("train", "train"), ("valid", "validation"), ("live", "live")):
        t.where(F.col("dataset") == role).drop("dataset").write.mode("overwrite").parquet(f"{base}/{file}.parquet")
    return base


@register("scan_tournament", with_views("SELECT id, era, dataset, target FROM tourney", T))
def q_scan_tournament(spark, sf):
    base = _write_roles(spark, sf)
    parts = [src.read_role(spark, base, "train"), src.read_role(spark, base, "validation", dataset="valid"),
             src.read_role(spark, base, "live")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("id", "era", "dataset", "target")


@register("scan_typed_csv", with_views(f"""
SELECT id, {', '.join(f'cast(cast({c} AS FLOAT) AS DOUBLE) AS {c}' for c in FEATURES + ['target'])} FROM tourney""", T))
def q_scan_typed_csv(spark, sf):
    path = scratch_path(spark, "typed_csv")
    _t(spark, sf).select("id", "era", *FEATURES, "target").write.option("header", True).csv(path)
    df = src.read_typed_csv(spark, path)
    return df.select("id", *[F.col(c).cast("double").alias(c) for c in FEATURES + ["target"]])


@register("scan_example_preds", with_views("SELECT id, example_preds FROM tourney", T))
def q_scan_example_preds(spark, sf):
    path = scratch_path(spark, "example_preds")
    (_t(spark, sf).select("id", F.col("example_preds").alias("prediction"))
        .write.option("header", True).csv(path))
    return src.read_example_preds(spark, path)


def _embedding_features(spark, sf) -> DataFrame:
    """Feature metadata derived from the embeddings: trait t holds the dimensions whose mean over
    the rows with ``label % 8 = t`` is positive, in dimension order."""
    e = read_table(spark, sf, "embeddings")
    dims = e.select((F.col("label") % 8).alias("t"), F.posexplode("embedding").alias("j", "v"))
    means = dims.groupBy("t", "j").agg(F.avg("v").alias("m"))
    chosen = means.where(F.col("m") > 0).select(
        "t", "j", F.format_string("feature_%02d", F.col("j")).alias("feature"))
    names = F.create_map(*[x for i, n in enumerate(src.TRAITS) for x in (F.lit(i), F.lit(n))])
    sets = chosen.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("j", "feature"))).alias("s"))
    return sets.select(names[F.col("t")].alias("trait"), F.transform("s", lambda x: x["feature"]).alias("features"))


def _write_feature_json(spark, sf) -> str:
    path = scratch_path(spark, "features_json")
    sets = _embedding_features(spark, sf)
    doc = sets.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("trait", "features")))
                                      .alias("feature_sets"))).alias("value"))
    doc.write.text(path)  # one JSON document (8 traits x at most 64 names)
    return path


_TRAIT_SQL = "[" + ", ".join(f"'{t}'" for t in src.TRAITS) + "]"
_FEATURE_SETS_SQL = f"""
WITH d AS (SELECT label % 8 AS t, unnest(range(len(embedding))) AS j, unnest(embedding) AS v FROM embeddings),
m AS (SELECT t, j FROM d GROUP BY t, j HAVING avg(v) > 0),
s AS (SELECT cast(t AS INTEGER) AS trait_ord, {_TRAIT_SQL}[t + 1] AS trait,
             cast(row_number() OVER (PARTITION BY t ORDER BY j) - 1 AS INTEGER) AS pos,
             printf('feature_%02d', j) AS feature, j FROM m)"""


@register("scan_feature_sets", _FEATURE_SETS_SQL + "\nSELECT trait_ord, trait, pos, feature FROM s")
def q_scan_feature_sets(spark, sf):
    return src.read_feature_sets(spark, _write_feature_json(spark, sf))


@register("order_by_feature_set", _FEATURE_SETS_SQL + """,
f AS (SELECT j FROM range(64) r(j)),
firsts AS (SELECT feature, min(trait_ord * 1000 + pos) AS k FROM s GROUP BY feature)
SELECT printf('feature_%02d', j) AS feature,
       cast(row_number() OVER (ORDER BY coalesce(k, 1073741824000), j) - 1 AS INTEGER) AS position
FROM f LEFT JOIN firsts ON firsts.feature = printf('feature_%02d', j)""")
def q_order_by_feature_set(spark, sf):
    sets = src.read_feature_sets(spark, _write_feature_json(spark, sf))
    names = [f"feature_{j:02d}" for j in range(64)]
    return projections.feature_order(sets, names).select("feature", F.col("position").cast("int"))


_CONFIG_SQL = """
WITH g AS (SELECT event_type || CASE WHEN user_id % 3 = 0 THEN '' ELSE cast(user_id % 3 AS VARCHAR) END AS model,
                  cast(user_id % 3 + 1 AS INTEGER) AS version, cast(count(*) % 7 AS INTEGER) AS rev,
                  cast(count(DISTINCT extract(day FROM ts)) AS INTEGER) AS epoch
           FROM events GROUP BY 1, 2)"""


def _config_lines(spark, sf) -> str:
    ev = read_table(spark, sf, "events")
    model = F.concat("event_type", F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise((F.col("user_id") % 3).cast("string")))
    g = ev.groupBy(model.alias("model"), (F.col("user_id") % 3 + 1).cast("int").alias("version")).agg(
        (F.count(F.lit(1)) % 7).cast("int").alias("rev"),
        F.countDistinct(F.dayofmonth("ts")).cast("int").alias("epoch"))
    lines = g.select(F.concat_ws("\t", "model", F.lit("models"), F.lit("NR"), F.col("version").cast("string"),
                                 F.col("rev").cast("string"), F.lit("1"), F.col("epoch").cast("string"),
                                 F.lit("8192"), F.lit("NaN,0.5,0.5|Slice,0,4")).alias("value"))
    header = spark.createDataFrame([("\t".join(src.CONFIG_COLUMNS),)], "value string")
    path = scratch_path(spark, "run_config")
    header.unionByName(lines).write.text(path)
    return path


@register("scan_run_config", _CONFIG_SQL + """
SELECT model, 'models' AS path, 'NR' AS arch, version, rev, 1 AS trial, epoch, 8192 AS batch,
       'NaN,0.5,0.5|Slice,0,4' AS transform
FROM g WHERE starts_with(model, 'click')""")
def q_scan_run_config(spark, sf):
    return src.read_run_config(spark, _config_lines(spark, sf), model_prefix="click")


def _shards_by_era(spark, sf, shard_rows: int = 100) -> str:
    path = scratch_path(spark, "shards_era")
    t = _t(spark, sf)
    ex = projections.assemble_xy(t, FEATURES, ["target"], keep=["id", "era", "dataset"])
    sinks.write_shards_by_era(ex, path, shard_rows=shard_rows)
    return path


@register("scan_shards_by_glob", with_views("""
SELECT id, era, dataset FROM tourney
WHERE (dataset = 'train' AND cast(era AS VARCHAR) LIKE '1%') OR (dataset = 'valid' AND cast(era AS VARCHAR) LIKE '2%')""", T))
def q_scan_shards_by_glob(spark, sf):
    base = _shards_by_era(spark, sf)
    df = src.read_shards(spark, f"{base}/dataset=train/era=1* {base}/dataset=valid/era=2*")
    return df.select("id", F.col("era").cast("int").alias("era"), "dataset")


def _written_rows(back: DataFrame, shard_rows: int) -> DataFrame:
    """Every row read back, and whether its file keeps the limit."""
    rows = back.withColumn("_f", F.input_file_name())
    per_file = rows.groupBy("_f").agg((F.count(F.lit(1)) <= shard_rows).alias("file_within_limit"))
    xs = [round6(F.element_at("x", i + 1)).alias(f"x{i}") for i in range(len(FEATURES))]
    return rows.join(per_file, "_f").select("id", F.col("era").cast("int").alias("era"), "dataset", *xs,
                                            round6(F.element_at("y", 1)).alias("y0"), "file_within_limit")


_WRITTEN_SQL = with_views(f"""
SELECT id, era, dataset, {', '.join(f"{r6(f'cast({f} AS FLOAT)')} AS x{i}" for i, f in enumerate(FEATURES))},
       {r6('cast(target AS FLOAT)')} AS y0, true AS file_within_limit FROM tourney""", T)


@register("write_shards", _WRITTEN_SQL)
def q_write_shards(spark, sf):
    path = scratch_path(spark, "shards")
    ex = projections.assemble_xy(_t(spark, sf), FEATURES, ["target"], keep=["id", "era", "dataset"])
    sinks.write_shards(ex, path, shard_rows=500)
    return _written_rows(spark.read.parquet(path), 500)


@register("write_shards_by_era", _WRITTEN_SQL)
def q_write_shards_by_era(spark, sf):
    return _written_rows(spark.read.parquet(_shards_by_era(spark, sf, 100)), 100)


@register("write_submission", with_views("SELECT id, prediction FROM tourney WHERE dataset = 'live'", T))
def q_write_submission(spark, sf):
    folder = scratch_path(spark, "submissions")
    live = _t(spark, sf).where(F.col("dataset") == "live")
    path = sinks.write_submission(live, folder, "mlp", 1, 30)
    assert path.endswith("mlpv1r30.csv")
    return spark.read.option("header", True).schema("id string, prediction double").csv(path)


@register("write_validation_preds", with_views("SELECT id, prediction FROM tourney WHERE dataset = 'valid'", T))
def q_write_validation_preds(spark, sf):
    folder = scratch_path(spark, "validation_preds")
    valid = _t(spark, sf).where(F.col("dataset") == "valid")
    path = sinks.write_validation_preds(valid, folder, "mlp", 1, 2)
    assert path.endswith("mlpv1r2_test.csv")
    return spark.read.option("header", True).schema("id string, prediction double").csv(path)


_VERSIONS = ["4.1", "4.2", "4.3", "5.0", "3.9"]
_ROLES = ["train", "validation", "live", "meta_model", "features"]


@register("dataset_path", f"""
SELECT event_id AS id, CASE
  WHEN r = 'meta_model' THEN 'v' || v2 || '/meta_model.parquet'
  WHEN r = 'features' THEN 'v' || v2 || '/features.json'
  ELSE 'v' || v2 || '/' || r || CASE WHEN v2 IN ('4.2', '4.3') THEN '_int8' ELSE '' END || '.parquet' END AS path
FROM (SELECT event_id, CASE WHEN v IN ('4.1', '4.2', '4.3', '5.0') THEN v ELSE '5.0' END AS v2, r FROM (
  SELECT event_id, {"[" + ", ".join(repr(v) for v in _VERSIONS) + "]"}[event_id % 5 + 1] AS v,
         {"[" + ", ".join(repr(r) for r in _ROLES) + "]"}[user_id % 5 + 1] AS r FROM events))""")
def q_dataset_path(spark, sf):
    ev = read_table(spark, sf, "events")
    v = F.element_at(F.array(*[F.lit(x) for x in _VERSIONS]), (F.col("event_id") % 5 + 1).cast("int"))
    r = F.element_at(F.array(*[F.lit(x) for x in _ROLES]), (F.col("user_id") % 5 + 1).cast("int"))
    return ev.select(F.col("event_id").alias("id"), sinks.dataset_path(v, r).alias("path"))


@register("write_if_absent", with_views("SELECT id, era FROM tourney WHERE era <= 10", T))
def q_write_if_absent(spark, sf):
    path = scratch_path(spark, "if_absent")
    t = _t(spark, sf).select("id", "era")
    sinks.write_if_absent(t.where(F.col("era") <= 10), path)
    sinks.write_if_absent(t.where(F.col("era") > 10), path)  # present: skipped
    return spark.read.parquet(path)


@register("publish_snapshot", with_views("""
SELECT 1 AS snapshot, id, era FROM tourney WHERE era <= 10 UNION ALL SELECT 2, id, era FROM tourney""", T))
def q_publish_snapshot(spark, sf):
    """S8 and S12 as snapshots: a first one, a write that never commits, an attempt that finds one present, and a second one by
    era; both read back by their commits, checked against their manifests."""
    path = scratch_path(spark, "snapshots")
    t = _t(spark, sf).select("id", "era", "dataset")
    snapshots.publish_if_absent(t.where(F.col("era") <= 10), path)
    t.where(F.col("era") > 10).write.parquet(f"{path}/data/killed")
    snapshots.publish_if_absent(t.where(F.col("era") > 10), path)
    snapshots.publish(t, path, lambda rows, to: sinks.write_shards_by_era(rows, to, shard_rows=1000))
    parts = [snapshots.read_snapshot(spark, path, n, verify=True).select(F.lit(n).alias("snapshot"), "id", F.col("era").cast("int").alias("era")) for n in (1, 2)]
    return parts[0].unionByName(parts[1])


@register("load_data", with_views("""
SELECT id, dataset, coalesce(feature_user, 0.5) AS feature_user,
       CASE WHEN dataset = 'valid' THEN coalesce(target, 0.5) ELSE target END AS target
FROM tourney_missing""", "tourney_missing"))
def q_load_data(spark, sf):
    """S1 + P9 as the evaluation load step: role files of the missing-value view read back, features
    filled in every role, targets filled in validation only."""
    from .plans import pipelines
    base = scratch_path(spark, "roles_missing")
    t = tourney_missing(spark, sf)
    for role, file in (("train", "train"), ("valid", "validation"), ("live", "live")):
        t.where(F.col("dataset") == role).drop("dataset").write.mode("overwrite").parquet(f"{base}/{file}.parquet")
    train, valid, live = pipelines.load_tournament(spark, base)
    cols = ["id", "dataset", "feature_user", "target"]
    return train.select(*cols).unionByName(valid.select(*cols)).unionByName(live.select(*cols))


@register("read_release", with_views("""
SELECT id, era, dataset, feature_hour FROM (SELECT id, era, CASE dataset WHEN 'valid' THEN 'validation' ELSE dataset END AS dataset, feature_hour FROM tourney)
WHERE era >= 4 AND era <= 29""", T))
def q_read_release(spark, sf):
    """S1 and S11 as a data source: a release of era folders and plain files, read with the filter on the era pushed down."""
    path = scratch_path(spark, "release")
    rows = _t(spark, sf).select("id", "era", "dataset", "feature_hour")
    for role, own in (("train", "train"), ("validation", "valid"), ("live", "live")):
        part = rows.where(F.col("dataset") == own).drop("dataset").write
        (part if role == "live" else part.partitionBy("era")).parquet(f"{path}/v5/{role}.parquet")
    releases.register(spark)
    read = spark.read.format(releases.NAME).option("version", "v5").load(path)
    return read.where("era >= 4 AND era <= 29").select("id", "era", "dataset", "feature_hour")
