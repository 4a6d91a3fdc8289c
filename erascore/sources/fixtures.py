"""Tournament-shaped views over the driver tables.

Each view exists twice: as a Spark DataFrame built with the DataFrame API (what the library
consumes) and as SQL text for DuckDB (the correctness oracle). Literals are written as ``149e0``
in the SQL so that both engines divide in double precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

FEATURES = ["feature_user", "feature_hour", "feature_mix", "feature_k"]

# Event type -> target level.
TARGET_LEVELS = [("click", 0.0), ("error", 0.25), ("purchase", 0.5), ("signup", 0.75)]
TARGET_OTHER = 1.0


def _target_expr() -> F.Column:
    expr = None
    for name, level in TARGET_LEVELS:
        cond = F.col("event_type") == name
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(TARGET_OTHER)).cast("double")


def tourney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, row_idx, era, dataset, target, features, prediction, example_preds (one row per event)."""
    ev = read_table(spark, sf_dir, "events")
    era = F.dayofmonth("ts").cast("int")
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_id").alias("row_idx"),
        era.alias("era"),
        F.when(era <= 20, "train").when(era <= 29, "valid").otherwise("live").alias("dataset"),
        _target_expr().alias("target"),
        ((F.col("user_id") % 150) / F.lit(149.0)).alias("feature_user"),
        (F.hour("ts") / F.lit(23.0)).alias("feature_hour"),
        (((F.col("event_id") * 37) % 101) / F.lit(100.0)).alias("feature_mix"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("double") / F.lit(99.0)).alias("feature_k"),
        (F.col("value") / F.lit(500.0)).alias("prediction"),
        (((F.col("event_id") * 7919) % 1009) / F.lit(1008.0)).alias("example_preds"),
    )


def tourney_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tourney with NULL targets (event_id % 17 = 0) and NULL feature_user (event_id % 13 = 0)."""
    t = tourney(spark, sf_dir)
    return (t.withColumn("target", F.when(F.col("row_idx") % 17 != 0, F.col("target")))
             .withColumn("feature_user", F.when(F.col("row_idx") % 13 != 0, F.col("feature_user"))))


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Example shards: id, era, x = embedding (64 floats), y = [label / 9]."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        (F.lit(1) + F.col("vec_id") % 8).cast("long").alias("era"),
        F.col("embedding").alias("x"),
        F.array((F.col("label") / F.lit(9.0)).cast("float")).alias("y"),
    )


def five_scores() -> F.Column:
    """Five class scores from all values of ``embedding``: every fifth value's millionths summed as whole numbers (so that
    no engine's order of addition shows)."""
    def score(c: int) -> F.Column:
        own = F.filter("embedding", lambda v, i: i % 5 == c)
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, v: acc + F.round(v.cast("double") * 1e6).cast("long")) / F.lit(1e6)

    return F.array(*[score(c) for c in range(5)])


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and its five class scores."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), five_scores().alias("p"))


def tourney_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bench-sized tournament over lineitem: era = month index of the ship date."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        ((F.year("l_shipdate") - 1990) * 12 + F.month("l_shipdate")).cast("int").alias("era"),
        (F.col("l_extendedprice") / F.lit(105000.0)).alias("prediction"),
        (((F.col("l_partkey") + F.col("l_suppkey")) % 5) / F.lit(4.0)).alias("target"),
        F.col("l_discount").alias("feature_discount"),
        F.col("l_tax").alias("feature_tax"),
        (F.col("l_quantity") / F.lit(50.0)).alias("feature_qty"),
        ((F.col("l_orderkey") * 7919 % 1009) / F.lit(1008.0)).alias("example_preds"),
    )


BIG_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BIG_FEATURES = ["feature_discount", "feature_tax", "feature_qty"]

# ---------------------------------------------------------------- DuckDB oracle text

TOURNEY_SQL = """
SELECT cast(event_id AS VARCHAR) AS id,
       event_id AS row_idx,
       cast(extract(day FROM ts) AS INTEGER) AS era,
       CASE WHEN extract(day FROM ts) <= 20 THEN 'train'
            WHEN extract(day FROM ts) <= 29 THEN 'valid' ELSE 'live' END AS dataset,
       cast(CASE event_type WHEN 'click' THEN 0.0 WHEN 'error' THEN 0.25 WHEN 'purchase' THEN 0.5
                            WHEN 'signup' THEN 0.75 ELSE 1.0 END AS DOUBLE) AS target,
       (user_id % 150) / 149e0 AS feature_user,
       hour(ts) / 23e0 AS feature_hour,
       ((event_id * 37) % 101) / 100e0 AS feature_mix,
       cast(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 99e0 AS feature_k,
       value / 500e0 AS prediction,
       ((event_id * 7919) % 1009) / 1008e0 AS example_preds
FROM events
"""

TOURNEY_MISSING_SQL = """
SELECT id, row_idx, era, dataset,
       CASE WHEN row_idx % 17 <> 0 THEN target END AS target,
       CASE WHEN row_idx % 13 <> 0 THEN feature_user END AS feature_user,
       feature_hour, feature_mix, feature_k, prediction, example_preds
FROM tourney
"""

VEC_SQL = """
SELECT vec_id AS id, cast(1 + vec_id % 8 AS BIGINT) AS era, embedding AS x,
       [cast(label / 9e0 AS FLOAT)] AS y
FROM embeddings
"""

FIVE_SCORES_SQL = "[" + ", ".join(
    f"cast(list_sum(list_transform(embedding[{c}:len(embedding):5], lambda v: cast(round(cast(v AS DOUBLE) * 1e6) AS BIGINT))) AS DOUBLE) / 1e6"
    for c in range(1, 6)) + "]"
CLASS_SCORES_SQL = f"""
SELECT vec_id AS id, {FIVE_SCORES_SQL} AS p FROM embeddings
"""

TOURNEY_BIG_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       cast((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS INTEGER) AS era,
       l_extendedprice / 105000e0 AS prediction,
       ((l_partkey + l_suppkey) % 5) / 4e0 AS target,
       l_discount AS feature_discount, l_tax AS feature_tax, l_quantity / 50e0 AS feature_qty,
       ((l_orderkey * 7919 % 1009) / 1008e0) AS example_preds
FROM lineitem
"""

_VIEWS = {
    "tourney": TOURNEY_SQL,
    "tourney_missing": TOURNEY_MISSING_SQL,
    "vec": VEC_SQL,
    "class_scores": CLASS_SCORES_SQL,
    "tourney_big": TOURNEY_BIG_SQL,
}
_DEPENDS = {"tourney_missing": ["tourney"]}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the CTEs it names, dependencies first."""
    ordered: list[str] = []
    for v in views:
        for d in _DEPENDS.get(v, []) + [v]:
            if d not in ordered:
                ordered.append(d)
    ctes = ",\n".join(f"{v} AS ({_VIEWS[v]})" for v in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
