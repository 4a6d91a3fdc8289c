"""Query registrations: vector transforms, decoders and naming functions.

Vector results are compared as exploded rows ``(id, pos..., value)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import decode, naming, vectors
from .sources.fixtures import class_scores, tourney, vec, with_views
from .sources.tables import read_table
from .suite import register


def explode1(df: DataFrame, arr: Column) -> DataFrame:
    return (df.select("id", F.posexplode(arr).alias("pos", "value"))
              .select("id", "pos", F.col("value").cast("double").alias("value")))


def explode2(df: DataFrame, arr: Column) -> DataFrame:
    return (df.select("id", F.posexplode(arr).alias("i", "row"))
              .select("id", "i", F.posexplode("row").alias("j", "value"))
              .select("id", "i", "j", F.col("value").cast("double").alias("value")))


def explode3(df: DataFrame, arr: Column) -> DataFrame:
    return (df.select("id", F.posexplode(arr).alias("i", "m"))
              .select("id", "i", F.posexplode("m").alias("j", "row"))
              .select("id", "i", "j", F.posexplode("row").alias("k", "value"))
              .select("id", "i", "j", "k", F.col("value").cast("double").alias("value")))


def sql_explode1(expr: str, src: str = "vec") -> str:
    return with_views(f"""
SELECT id, cast(pos AS INTEGER) AS pos, cast(value AS DOUBLE) AS value FROM (
  SELECT id, unnest(range(len(v))) AS pos, unnest(v) AS value FROM (SELECT id, {expr} AS v FROM {src}))""", "vec")


def sql_explode2(expr: str) -> str:
    return with_views(f"""
SELECT id, cast(i AS INTEGER) AS i, cast(j AS INTEGER) AS j, cast(value AS DOUBLE) AS value FROM (
  SELECT id, i, unnest(range(len(r))) AS j, unnest(r) AS value FROM (
    SELECT id, unnest(range(len(m))) AS i, unnest(m) AS r FROM (SELECT id, {expr} AS m FROM vec)))""", "vec")


def sql_explode3(expr: str) -> str:
    return with_views(f"""
SELECT id, cast(i AS INTEGER) AS i, cast(j AS INTEGER) AS j, cast(k AS INTEGER) AS k,
       cast(value AS DOUBLE) AS value FROM (
  SELECT id, i, j, unnest(range(len(r))) AS k, unnest(r) AS value FROM (
    SELECT id, i, unnest(range(len(m))) AS j, unnest(m) AS r FROM (
      SELECT id, unnest(range(len(t))) AS i, unnest(t) AS m FROM (SELECT id, {expr} AS t FROM vec))))""", "vec")


# NaN-bearing vectors derived from the embeddings: elements below -0.3 become NaN.
NAN_BELOW = -0.3


def _with_nans(x: Column) -> Column:
    return F.transform(x, lambda v: F.when(v < F.lit(NAN_BELOW), F.lit(float("nan")).cast("float")).otherwise(v))


_NAN_SQL = f"list_transform(x, lambda v: CASE WHEN v < {NAN_BELOW}e0 THEN 'NaN'::FLOAT ELSE v END)"


@register("vec_fill_nan", sql_explode1(
    f"list_transform({_NAN_SQL}, lambda v: CASE WHEN isnan(v) THEN 0.5::FLOAT ELSE v END)"))
def q_vec_fill_nan(spark, sf):
    v = vec(spark, sf)
    return explode1(v, vectors.fill_nan(_with_nans(F.col("x")), 0.5))


@register("vec_slice", sql_explode1("x[9:56]"))
def q_vec_slice(spark, sf):
    return explode1(vec(spark, sf), vectors.vec_slice("x", 8, 48))


@register("vec_even", sql_explode1("list_transform(range(0, 64, 2), lambda i: x[i + 1])[1:32]"))
def q_vec_even(spark, sf):
    return explode1(vec(spark, sf), vectors.vec_even("x", 0, 32))


@register("vec_pad", sql_explode1("list_concat(x, x[1:16])"))
def q_vec_pad(spark, sf):
    return explode1(vec(spark, sf), vectors.vec_pad("x", 0, 16))


_C6_FLAT = "list_concat(x[1:56], flatten(list_transform(x[57:60], lambda v: [v, v, v, v])))"


@register("vec_c6", sql_explode3(
    f"list_transform(range(4), lambda i: list_transform(range(3), lambda j: "
    f"list_transform(range(6), lambda k: ({_C6_FLAT})[k * 12 + i * 3 + j + 1])))"))
def q_vec_c6(spark, sf):
    return explode3(vec(spark, sf), vectors.vec_c6("x", 4, 3, head=56, tail=4, times=4))


@register("vec_zero_pad_rows", sql_explode2(
    "[list_concat(x[1:8], list_transform(range(16), lambda k: 0::FLOAT)), "
    "list_concat(x[9:24], list_transform(range(8), lambda k: 0::FLOAT)), "
    "list_concat(x[25:44], list_transform(range(4), lambda k: 0::FLOAT)), "
    "list_concat(x[45:64], list_transform(range(4), lambda k: 0::FLOAT))]"))
def q_vec_zero_pad_rows(spark, sf):
    return explode2(vec(spark, sf), vectors.vec_zero_pad_rows("x", 4, 24, [0, 8, 24, 44, 64]))


@register("vec_reshape", sql_explode2("list_transform(range(8), lambda i: x[i * 8 + 1:i * 8 + 8])"))
def q_vec_reshape(spark, sf):
    return explode2(vec(spark, sf), vectors.reshape2("x", 8, 8))


@register("vec_reshape3", sql_explode3(
    "list_transform(range(4), lambda i: list_transform(range(4), lambda j: x[i * 16 + j * 4 + 1:i * 16 + j * 4 + 4]))"))
def q_vec_reshape3(spark, sf):
    """V7 ``YXZ,4,4,4`` (``ZYX`` has the same layout)."""
    return explode3(vec(spark, sf), vectors.reshape3("x", 4, 4, 4))


@register("vec_reshape_transpose", sql_explode2(
    "list_transform(range(4), lambda i: list_transform(range(16), lambda j: x[j * 4 + i + 1]))"))
def q_vec_reshape_transpose(spark, sf):
    return explode2(vec(spark, sf), vectors.reshape_transpose("x", 4, 16))


@register("target_to_class_scale", sql_explode1("list_transform(y, lambda v: v * 4::FLOAT)"))
def q_target_to_class_scale(spark, sf):
    return explode1(vec(spark, sf), vectors.class_scale("y", 5))


CHAIN_SPEC = "NaN,0.5,0.5|Slice,8,48|YX,6,8"


@register("transform_chain", sql_explode2(
    f"list_transform(range(6), lambda i: (list_transform({_NAN_SQL}, lambda v: CASE WHEN isnan(v) THEN 0.5::FLOAT ELSE v END)"
    ")[9:56][i * 8 + 1:i * 8 + 8])"))
def q_transform_chain(spark, sf):
    v = vec(spark, sf)
    x, _ = vectors.apply_chain(_with_nans(F.col("x")), F.col("y"), CHAIN_SPEC)
    return explode2(v, x)


# ----------------------------------------------------------------------------- R: decoders

@register("clamp01", with_views("""
SELECT id, CASE WHEN isnan(p) THEN p WHEN p < 0 THEN 0.0 WHEN p > 1 THEN 1.0 ELSE p END AS prediction
FROM (SELECT id, prediction * 1.2e0 - 0.1e0 AS p FROM tourney)""", "tourney"))
def q_clamp01(spark, sf):
    t = tourney(spark, sf).select("id", (F.col("prediction") * F.lit(1.2) - F.lit(0.1)).alias("p"))
    return t.select("id", decode.clamp01("p").alias("prediction"))


@register("argmax_decode", with_views("""
SELECT id, (list_position(p, list_max(p)) - 1) / 4e0 AS prediction FROM class_scores""", "class_scores"))
def q_argmax_decode(spark, sf):
    return class_scores(spark, sf).select("id", decode.argmax_decode("p").alias("prediction"))


def _shifted(p: Column) -> Column:
    return F.transform(p, lambda v: v.cast("double") + F.lit(0.5))


@register("threshold_decode", with_views("""
SELECT id, CASE WHEN q[3] <= 0.48e0 AND q[2] >= q[4] THEN 1
                WHEN q[3] <= 0.48e0 AND q[4] > q[2] THEN 3
                WHEN q[3] <= 0.1e0 AND q[1] >= q[5] THEN 0
                WHEN q[3] <= 0.1e0 AND q[5] > q[1] THEN 4
                ELSE 2 END / 4e0 AS prediction
FROM (SELECT id, list_transform(p, lambda v: cast(v AS DOUBLE) + 0.5e0) AS q FROM class_scores)""", "class_scores"))
def q_threshold_decode(spark, sf):
    c = class_scores(spark, sf)
    return c.select("id", decode.threshold_decode(_shifted(F.col("p"))).alias("prediction"))


@register("first_output", with_views("""
SELECT id, cast(p[1] AS DOUBLE) AS prediction FROM class_scores""", "class_scores"))
def q_first_output(spark, sf):
    return class_scores(spark, sf).select("id", decode.first_output("p").cast("double").alias("prediction"))


@register("flatten_prediction", with_views("SELECT id, prediction FROM tourney", "tourney"))
def q_flatten_prediction(spark, sf):
    nested = tourney(spark, sf).select("id", F.array("prediction").alias("p"))
    return nested.select("id", decode.flatten_prediction("p").alias("prediction"))


@register("autoencoder_output", with_views("SELECT id, cast(y[1] AS DOUBLE) AS prediction FROM vec", "vec"))
def q_autoencoder_output(spark, sf):
    outputs = vec(spark, sf).select("id", F.struct(F.col("x").alias("reconstruction"), F.col("y").alias("target")).alias("o"))
    return outputs.select("id", F.element_at(decode.autoencoder_output("o"), 1).cast("double").alias("prediction"))


# ----------------------------------------------------------------------------- C: naming

def _registry(spark, sf) -> DataFrame:
    """Model-file registry rows derived from the events: one model file per event."""
    ev = read_table(spark, sf, "events")
    return ev.select(
        F.col("event_id").alias("id"), F.col("ts"), F.col("event_type").alias("name"),
        (F.col("user_id") % 7 + 1).cast("int").alias("version"),
        F.dayofmonth("ts").cast("int").alias("revision"),
        (F.col("event_id") % 3 + 1).cast("int").alias("trial"),
        (F.col("event_id") % 50).cast("int").alias("epoch"),
        (F.col("event_id") % 4).cast("int").alias("step"))


_REGISTRY_SQL = """(SELECT event_id AS id, ts, event_type AS name, cast(user_id % 7 + 1 AS INTEGER) AS version,
  cast(extract(day FROM ts) AS INTEGER) AS revision, cast(event_id % 3 + 1 AS INTEGER) AS trial,
  cast(event_id % 50 AS INTEGER) AS epoch, cast(event_id % 4 AS INTEGER) AS step FROM events)"""


@register("model_key", f"""
SELECT id, printf('%s/%sv%dr%dt%d-e%d%s', 'models', name, version, revision, trial, epoch, '.keras') AS model_key
FROM {_REGISTRY_SQL}""")
def q_model_key(spark, sf):
    r = _registry(spark, sf)
    return r.select("id", naming.model_key(F.lit("models"), "name", "version", "revision", "trial", "epoch",
                                           F.lit(".keras")).alias("model_key"))


@register("model_full_name", f"""
SELECT id, CASE WHEN step <> 0 THEN printf('%sv%dr%ds%d', name, version, revision, step)
                ELSE printf('%sv%dr%d', name, version, revision) END AS full_name
FROM {_REGISTRY_SQL}""")
def q_model_full_name(spark, sf):
    r = _registry(spark, sf)
    return r.select("id", naming.model_full_name("name", "version", "revision", "step").alias("full_name"))


@register("epoch_from_key", f"""
SELECT id, CASE WHEN regexp_extract(k, '-e([0-9]+)', 1) <> '' THEN cast(regexp_extract(k, '-e([0-9]+)', 1) AS INTEGER) END AS epoch
FROM (SELECT id, CASE WHEN id % 5 = 0 THEN name || 'v1' ELSE printf('%sv%dr%dt%d-e%d', name, version, revision, trial, epoch) END AS k
      FROM {_REGISTRY_SQL})""")
def q_epoch_from_key(spark, sf):
    r = _registry(spark, sf)
    key = F.when(F.col("id") % 5 == 0, F.concat("name", F.lit("v1"))).otherwise(
        F.format_string("%sv%dr%dt%d-e%d", "name", "version", "revision", "trial", "epoch"))
    return r.select("id", naming.epoch_from_key(key).alias("epoch"))


@register("is_weekday", "SELECT event_id AS id, isodow(ts) <= 5 AS is_weekday FROM events")
def q_is_weekday(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"), naming.is_weekday("ts").alias("is_weekday"))


@register("round_dir_name", "SELECT event_id AS id, strftime(ts, '%Yd%j') AS round_dir FROM events")
def q_round_dir_name(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"), naming.round_dir_name("ts").alias("round_dir"))


def _spec_text() -> Column:
    return F.concat(F.lit("NaN,"), (F.col("user_id") % 3).cast("string"), F.lit(",0|Slice,0,"),
                    (F.col("event_id") % 64 + 1).cast("string"), F.lit("|YX,"),
                    F.length("event_type").cast("string"), F.lit(",1"))


@register("parse_spec", """
SELECT id, cast(step AS INTEGER) AS step, split_part(e, ',', 1) AS name,
       array_to_string(string_split(e, ',')[2:4], ',') AS args FROM (
  SELECT id, unnest(range(len(es))) AS step, unnest(es) AS e FROM (
    SELECT event_id AS id, string_split('NaN,' || cast(user_id % 3 AS VARCHAR) || ',0|Slice,0,' ||
           cast(event_id % 64 + 1 AS VARCHAR) || '|YX,' || cast(length(event_type) AS VARCHAR) || ',1', '|') AS es
    FROM events))""")
def q_parse_spec(spark, sf):
    ev = read_table(spark, sf, "events")
    parsed = ev.select(F.col("event_id").alias("id"), vectors.spec_column(_spec_text()).alias("steps"))
    return (parsed.select("id", F.posexplode("steps").alias("step", "s"))
                  .select("id", "step", F.col("s.name").alias("name"), F.array_join("s.args", ",").alias("args")))


@register("ensemble_spec", """
SELECT id, CASE WHEN spec <> '-' THEN split_part(spec, ',', 1) END AS model, CASE WHEN spec <> '-' THEN split_part(spec, ',', 2) END AS arch,
       CASE WHEN spec <> '-' THEN cast(split_part(spec, ',', 3) AS INTEGER) END AS version,
       CASE WHEN spec <> '-' THEN split_part(spec, ',', 4) END AS predict, CASE WHEN spec <> '-' THEN split_part(spec, ',', 5) END AS transform
FROM (SELECT event_id AS id, CASE WHEN event_id % 4 = 0 THEN '-' ELSE
        event_type || ',MLP,' || cast(user_id % 9 AS VARCHAR) || ',p' || cast(event_id % 3 AS VARCHAR) || ',YX' END AS spec FROM events)""")
def q_ensemble_spec(spark, sf):
    """The members of ensembles, one spec for each event, none for every fourth."""
    ev = read_table(spark, sf, "events")
    spec = F.when(F.col("event_id") % 4 == 0, "-").otherwise(F.concat(
        "event_type", F.lit(",MLP,"), (F.col("user_id") % 9).cast("string"), F.lit(",p"), (F.col("event_id") % 3).cast("string"), F.lit(",YX")))
    return ev.select(F.col("event_id").alias("id"), vectors.member_column(spec).alias("m")).select("id", "m.*")
