"""Readers for tournament tables, CSV files, feature metadata and run configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import nan_to_null

# The eight trait names of the feature metadata, in the order they are used.
TRAITS = ("intelligence", "charisma", "strength", "dexterity", "constitution", "wisdom", "agility", "serenity")

ROLE_FILES = {"train": "train", "validation": "validation", "valid": "validation",
              "tournament": "tournament", "live": "live"}


def normalize_missing(df: DataFrame, prefixes: Sequence[str] = ("feature", "target")) -> DataFrame:
    """NaN -> NULL in the numeric feature/target columns (NULL logic is then explicit everywhere)."""
    out = []
    for f in df.schema.fields:
        if f.name.startswith(tuple(prefixes)) and isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(nan_to_null(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_role(spark: SparkSession, base: str, role: str, dataset: str | None = None) -> DataFrame:
    """``<base>/<role>.parquet`` with a ``dataset`` literal column and NaN -> NULL."""
    path = f"{base.rstrip('/')}/{ROLE_FILES.get(role, role)}.parquet"
    df = spark.read.parquet(path)
    return normalize_missing(df).withColumn("dataset", F.lit(dataset or role))


def read_typed_csv(spark: SparkSession, path: str, feature_prefix: str = "feature",
                   target_prefix: str = "target") -> DataFrame:
    """Headered CSV; ``feature*`` / ``target*`` columns as float32, others as text.

    The header is read once (a one-line job) to build an explicit schema, so the data pass does not
    infer types."""
    header = spark.read.option("header", True).csv(path).columns
    fields = []
    for c in header:
        typ = T.FloatType() if c.startswith((feature_prefix, target_prefix)) else T.StringType()
        fields.append(T.StructField(c, typ, True))
    return spark.read.option("header", True).schema(T.StructType(fields)).csv(path)


def read_example_preds(spark: SparkSession, path: str, id_col: str = "id", pred_col: str = "prediction",
                       out: str = "example_preds") -> DataFrame:
    """S3: example predictions CSV ``id,prediction`` -> ``(id, example_preds)``."""
    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField(pred_col, T.DoubleType())])
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.select(id_col, nan_to_null(F.col(pred_col)).alias(out))


def read_feature_sets(spark: SparkSession, path: str, traits: Sequence[str] = TRAITS) -> DataFrame:
    """Feature metadata JSON -> rows ``(trait_ord, trait, pos, feature)`` for the chosen traits."""
    schema = "feature_sets map<string, array<string>>"
    meta = spark.read.option("multiLine", True).schema(schema).json(path)
    order = F.create_map(*[x for i, t in enumerate(traits) for x in (F.lit(t), F.lit(i))])
    sets = meta.select(F.explode("feature_sets").alias("trait", "features"))
    return (sets.where(F.col("trait").isin(list(traits)))
                .select(order[F.col("trait")].alias("trait_ord"), "trait",
                        F.posexplode("features").alias("pos", "feature")))


CONFIG_COLUMNS = ("model", "path", "arch", "version", "rev", "trial", "epoch", "batch", "transform")
CONFIG_INT = ("version", "rev", "trial", "epoch", "batch")


def read_run_config(spark: SparkSession, path: str, columns: Sequence[str] = CONFIG_COLUMNS,
                    int_columns: Sequence[str] = CONFIG_INT, model_prefix: str | None = None) -> DataFrame:
    """Whitespace-separated configuration rows; the header row (first field equal to the first
    column name) is dropped; ``model_prefix`` keeps rows whose model starts with it (a prefix match,
    so ``cnn`` also selects ``cnn2``)."""
    lines = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"))
    lines = lines.where((F.size("f") >= len(columns)) & (F.element_at("f", 1) != F.lit(columns[0])))
    cols = []
    for i, c in enumerate(columns):
        v = F.element_at("f", i + 1)
        cols.append((v.cast("int") if c in int_columns else v).alias(c))
    out = lines.select(*cols)
    if model_prefix is not None:
        out = out.where(F.col(columns[0]).startswith(model_prefix))
    return out


def read_shards(spark: SparkSession, patterns: str | Sequence[str]) -> DataFrame:
    """One or several (space-separated) path globs -> one frame. Era-partitioned shard folders
    expose ``era`` as a partition column, so era filters prune whole folders."""
    if isinstance(patterns, str):
        patterns = patterns.split()
    by_base: dict[str, list[str]] = {}
    for p in patterns:
        by_base.setdefault(_base(p), []).append(p)
    out = None
    for base, own in by_base.items():
        part = spark.read.option("basePath", base).parquet(*own)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _base(pattern: str) -> str:
    """The folder above a glob's wildcards and partition folders."""
    cut = min([pattern.find(ch) for ch in "*?[" if ch in pattern] or [len(pattern)])
    base = pattern[:cut]
    if "=" in base:
        base = base[:base.find("=")]
    return base.rsplit("/", 1)[0]
