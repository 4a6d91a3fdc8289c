"""Atomic publication of tables (S7, S8, S12): staged write, manifest, one commit.

A published table is a folder of snapshots::

    <path>/data/<id>/        the files of one write, complete or not
    <path>/manifests/<id>/   parquet: file, rows and digest of every file of that write
    <path>/commits/<n>.json  names the write that is snapshot n

Readers follow the newest commit, so a write that was killed at any point leaves the snapshot before it as it was. Manifests
are made by Spark from the files as they were read back, and are themselves tables: any number of files will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class TornWriteError(RuntimeError):
    """Files of a snapshot are missing, changed or more than its manifest says."""


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _commits(spark: SparkSession, path: str) -> dict[int, dict]:
    """Every whole commit; a commit file that was cut off while it was written does not count."""
    fs, folder = _fs(spark, f"{path}/commits")
    if not fs.exists(folder):
        return {}
    found = {}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.endswith(".json") or not name[:-5].isdigit():
            continue
        stream = fs.open(status.getPath())
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            commit = json.loads(text)
            found[int(name[:-5])] = {"id": str(commit["id"]), "rows": int(commit["rows"]), "files": int(commit["files"])}
        except (ValueError, KeyError, TypeError):
            continue
    return found


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    """file (relative to the write), rows and digest (of the rows as a multiset) of every data file."""
    table = spark.read.parquet(folder)
    # the column list is not hashed as a struct of everything: maps have no hash, their entries do
    parts = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in table.dtypes]
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/(.*)$", 1)
    return table.select(name.alias("file"), F.xxhash64(*parts).alias("h")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("digest"))


def current(spark: SparkSession, path: str) -> int | None:
    """The number of the newest snapshot, None where nothing was ever published."""
    return max(_commits(spark, path.rstrip("/")), default=None)


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> int:
    """Write ``df`` as the next snapshot of ``path`` and return its number.

    ``write(df, folder)`` is any of the shard writers (plain Parquet where None). Two publishers at once get numbers of their
    own: the commit file is created, never overwritten, and the loser takes the next number."""
    spark, path = df.sparkSession, path.rstrip("/")
    own = uuid.uuid4().hex
    folder = f"{path}/data/{own}"
    (write or (lambda rows, to: rows.write.parquet(to)))(df, folder)
    _measured(spark, folder).write.parquet(f"{path}/manifests/{own}")
    total = spark.read.parquet(f"{path}/manifests/{own}").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).first()
    body = json.dumps({"id": own, "rows": total["rows"] or 0, "files": total["files"]})
    number = (current(spark, path) or 0) + 1
    while True:
        fs, target = _fs(spark, f"{path}/commits/{number:08d}.json")
        if not fs.exists(target):
            try:
                stream = fs.create(target, False)
            except Exception as failure:  # another publisher came first
                if "exists" not in str(failure).lower():
                    raise
            else:
                try:
                    stream.write(bytearray(body.encode()))
                finally:
                    stream.close()
                return number
        number += 1


def read_snapshot(spark: SparkSession, path: str, number: int | None = None, verify: bool = False) -> DataFrame:
    """The rows of a snapshot, the newest where ``number`` is None. ``verify`` reads every file and compares it with the
    manifest first: TornWriteError where they differ. FileNotFoundError where there is no such snapshot."""
    path = path.rstrip("/")
    commits = _commits(spark, path)
    number = max(commits, default=None) if number is None else number
    if number not in commits:
        raise FileNotFoundError(f"{path} has no snapshot {number}")
    own = commits[number]["id"]
    folder = f"{path}/data/{own}"
    if verify:
        said = spark.read.parquet(f"{path}/manifests/{own}").toDF("said_file", "said_rows", "said_digest")
        try:
            is_now = _measured(spark, folder)
            both = is_now.join(said, F.col("file") == F.col("said_file"), "full_outer")
            wrong = both.where(~(F.col("rows").eqNullSafe(F.col("said_rows")) & F.col("digest").eqNullSafe(F.col("said_digest"))))
            first = wrong.select(F.coalesce("file", "said_file").alias("file")).first()
        except Exception as failure:
            raise TornWriteError(f"snapshot {number} of {path} cannot be read") from failure
        if first is not None:
            raise TornWriteError(f"snapshot {number} of {path}: {first['file']} is not as its manifest says")
    return spark.read.parquet(folder)


def publish_if_absent(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None, force: bool = False) -> bool:
    """S12 over snapshots: publish unless there is one already, or always with ``force``; whether it did. A write that never
    committed does not count as present."""
    if not force and current(df.sparkSession, path) is not None:
        return False
    publish(df, path, write)
    return True


def delete_uncommitted(spark: SparkSession, path: str) -> int:
    """Delete the files of writes that no commit names (of killed publishers; run it while none is at work); how many there were."""
    path, kept, gone = path.rstrip("/"), {c["id"] for c in _commits(spark, path.rstrip("/")).values()}, 0
    for part in ("data", "manifests"):
        fs, folder = _fs(spark, f"{path}/{part}")
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            if status.getPath().getName() not in kept:
                fs.delete(status.getPath(), True)
                gone += part == "data"
    return gone
