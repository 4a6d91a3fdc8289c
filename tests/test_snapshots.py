"""Published snapshots: torn writes, killed publishers, several at once."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from erascore.session import scratch_path
from erascore.sources import sinks, snapshots
from erascore.streaming import rounds


def _rows(spark, n, more=0):
    return spark.range(n).select("id", (F.col("id") % 3 + more).alias("era"), F.lit("train").alias("dataset"), F.create_map(F.lit("k"), "id").alias("m"))


def test_a_killed_write_leaves_the_old_snapshot(spark):
    path = scratch_path(spark, "snap")
    assert snapshots.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path)
    assert snapshots.publish(_rows(spark, 50), path) == 1

    def dies(rows, to):
        rows.write.parquet(to)
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        snapshots.publish(_rows(spark, 70), path, dies)
    with open(f"{path}/commits/00000002.json", "w") as cut:  # a commit cut off while it was written
        cut.write('{"id": "abc", "ro')
    assert snapshots.current(spark, path) == 1 and snapshots.read_snapshot(spark, path, verify=True).count() == 50
    assert not snapshots.publish_if_absent(_rows(spark, 9), path)
    assert snapshots.publish_if_absent(_rows(spark, 9), path, force=True)
    assert snapshots.read_snapshot(spark, path).count() == 9 and snapshots.read_snapshot(spark, path, 1).count() == 50
    assert snapshots.delete_uncommitted(spark, path) == 1 and snapshots.read_snapshot(spark, path, 1, verify=True).count() == 50


@pytest.mark.parametrize("how", ["lost", "changed", "added", "cut"])
def test_torn_files_are_found(spark, how):
    path = scratch_path(spark, "torn")
    snapshots.publish(_rows(spark, 60).drop("m"), path, lambda rows, to: sinks.write_shards_by_era(rows, to, shard_rows=7))
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet"))
    assert len(files) > 3
    if how == "lost":
        os.remove(files[0])
    elif how == "changed":
        os.replace(files[1], files[0])
    elif how == "added":
        with open(files[0], "rb") as a, open(files[0].replace("part-", "part-9"), "wb") as b:
            b.write(a.read())
    else:
        with open(files[0], "r+b") as f:
            f.truncate(os.path.getsize(files[0]) // 2)
        crc = os.path.join(os.path.dirname(files[0]), f".{os.path.basename(files[0])}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.raises(snapshots.TornWriteError):
        snapshots.read_snapshot(spark, path, verify=True)


def test_publishers_at_once_get_numbers_of_their_own(spark):
    path = scratch_path(spark, "many")
    with ThreadPoolExecutor(3) as pool:
        numbers = list(pool.map(lambda n: snapshots.publish(_rows(spark, n), path), (5, 6, 7)))
    assert sorted(numbers) == [1, 2, 3]
    assert sorted(snapshots.read_snapshot(spark, path, n, verify=True).count() for n in numbers) == [5, 6, 7]


def test_write_if_absent_writes_a_half_written_target_anew(spark):
    path = scratch_path(spark, "half")
    sinks.write_if_absent(spark.range(5), path)
    sinks.write_if_absent(spark.range(8), path)
    assert spark.read.parquet(path).count() == 5
    os.remove(f"{path}/_SUCCESS")
    sinks.write_if_absent(spark.range(8), path)
    assert spark.read.parquet(path).count() == 8
    sinks.write_if_absent(spark.range(2), path, force=True)
    assert spark.read.parquet(path).count() == 2


def test_gate_keeps_the_first_delivery(spark):
    rows = [(1, "a", 5, 0.5, [1.0]), (1, "a", 3, 0.9, [2.0]), (1, "a", 3, 0.7, [9.0]), (2, "a", 1, None, None), (2, "a", 1, 0.1, [3.0])]
    batch = spark.createDataFrame(rows, "round int, id string, at int, x double, v array<double>").repartition(3)
    got = sorted(tuple(r) for r in rounds.round_gate(batch, None, order=["at"]).collect())
    assert got == [(1, "a", 3, 0.7, [9.0]), (2, "a", 1, None, None)]
    written = spark.createDataFrame([(2, "a")], "round int, id string")
    assert [r["round"] for r in rounds.round_gate(batch, written).collect()] == [1]
    assert rounds.round_gate(batch.select("round", "id"), None).count() == 2
