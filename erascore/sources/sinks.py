"""Writers: example shards, submissions and the dataset catalog.

Shards are parquet, one folder per role (and per era), with a bounded number of rows per file.
Every input row is written exactly once (the reference's by-era writer reopens and overwrites
shards; that is not reproduced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_SHARD_ROWS = 4096


def write_shards(df: DataFrame, path: str, shard_rows: int = DEFAULT_SHARD_ROWS, dataset: str = "dataset",
                 mode: str = "overwrite") -> None:
    """One folder per role, a new file every ``shard_rows`` rows (``maxRecordsPerFile``)."""
    (df.write.mode(mode).option("maxRecordsPerFile", shard_rows)
       .partitionBy(dataset).parquet(path))


def write_shards_by_era(df: DataFrame, path: str, shard_rows: int = DEFAULT_SHARD_ROWS,
                        dataset: str = "dataset", era: str = "era", mode: str = "overwrite") -> None:
    """A file series per (role, era).

    The rows are clustered with a range shuffle on (role, era, row hash): range partitioning cannot
    split one key value, so the deterministic hash of the whole row is the last sort key -- a hot era
    then spans several writer tasks (each writing its own files of at most ``shard_rows`` rows),
    while small eras still land in one or two tasks. The hash is a pure function of the row, so a
    recomputed task writes the same rows."""
    split = F.xxhash64(*[F.col(c) for c in df.columns])
    (df.repartitionByRange(F.col(dataset), F.col(era), split)
       .write.mode(mode).option("maxRecordsPerFile", shard_rows)
       .partitionBy(dataset, era).parquet(path))


def submission_name(name: str, version: int, revision: int, suffix: str = "") -> str:
    return f"{name}v{version}r{revision}{suffix}.csv"


def write_submission(preds: DataFrame, folder: str, name: str, version: int, revision: int,
                     id_col: str = "id", pred_col: str = "prediction", suffix: str = "",
                     mode: str = "overwrite") -> str:
    """Headered CSV ``id,prediction`` under ``<folder>/<name>v<ver>r<rev>.csv`` (a folder of part
    files written in parallel)."""
    path = f"{folder.rstrip('/')}/{submission_name(name, version, revision, suffix)}"
    preds.select(id_col, pred_col).write.mode(mode).option("header", True).csv(path)
    return path


def write_validation_preds(preds: DataFrame, folder: str, name: str, version: int, revision: int,
                           **kw) -> str:
    """Validation predictions, suffix ``_test``."""
    return write_submission(preds, folder, name, version, revision, suffix="_test", **kw)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store its scheme names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def write_finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end: its success marker is there (or, where the session's writers leave none, the
    path itself)."""
    marks = spark._jsc.hadoopConfiguration().getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True)
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS" if marks else path)


def write_if_absent(df: DataFrame, path: str, force: bool = False, fmt: str = "parquet") -> None:
    """Write only when the target is not there whole yet, or always with ``force``. What a killed write left is
    written anew (``snapshots.publish_if_absent`` keeps readers from ever seeing such a state)."""
    if force or not write_finished(df.sparkSession, path):
        df.write.mode("overwrite").format(fmt).save(path)


# ------------------------------------------------------------------------- S11: dataset catalog

# Data release versions and their file suffix.
VERSION_SUFFIX = {"4.1": "", "4.2": "_int8", "4.3": "_int8", "5.0": ""}
DEFAULT_VERSION = "5.0"
ROLE_PREFIX = {"train": "train", "validation": "validation", "live": "live"}


def dataset_path(version: Column, role: Column, default_version: str = DEFAULT_VERSION) -> Column:
    """``v<version>/<prefix><suffix>.parquet``; an unknown version keeps the default one;
    ``meta_model`` has no suffix and ``features`` is a JSON file."""
    known = version.isin(list(VERSION_SUFFIX))
    ver = F.when(known, version).otherwise(F.lit(default_version))
    suffix = F.lit("")
    for v, s in VERSION_SUFFIX.items():
        suffix = F.when(ver == v, F.lit(s)).otherwise(suffix)
    prefix = F.lit(None).cast("string")
    for r, p in ROLE_PREFIX.items():
        prefix = F.when(role == r, F.lit(p)).otherwise(prefix)
    data = F.format_string("v%s/%s%s.parquet", ver, prefix, suffix)
    return (F.when(role == "meta_model", F.format_string("v%s/meta_model.parquet", ver))
             .when(role == "features", F.format_string("v%s/features.json", ver))
             .otherwise(data))
