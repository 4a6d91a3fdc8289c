"""The release source against plain Parquet reads, and what its filters leave to read."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from erascore.session import scratch_path
from erascore.sources import releases


def _release(spark):
    path = scratch_path(spark, "release")
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), (F.col("id") % 8 + 1).cast("int").alias("era"),
                                   F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 4).alias("feature_a"),
                                   F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.lit(0.5)).alias("other"))
    rows.write.partitionBy("era").parquet(f"{path}/v5/train.parquet")
    rows.where("era < 3").repartitionByRange(2, "era").write.parquet(f"{path}/v5/live.parquet")
    spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit(99).alias("era"), F.lit(0.0).alias("feature_a"), F.lit(0.0).alias("other")).coalesce(1).write.parquet(f"{path}/v6/train.parquet")
    releases.register(spark)
    return path, rows


def test_rows_roles_versions_and_missing_values(spark):
    path, rows = _release(spark)
    got = spark.read.format(releases.NAME).option("version", "v5").option("roles", "train,live").load(path)
    assert sorted(got.columns) == ["dataset", "era", "feature_a", "id", "other"]
    assert got.where("dataset = 'train'").count() == 400 and got.where("dataset = 'live'").count() == 100
    assert got.where("feature_a IS NULL").count() == 100 and got.where("isnan(other)").count() == rows.where("isnan(other) AND era < 3").count() + rows.where("isnan(other)").count()
    want = rows.where("era IN (2, 5)").select("id", "era").exceptAll(got.where("dataset = 'train' AND era IN (2, 5)").select("id", "era"))
    assert want.count() == 0
    assert [r["era"] for r in spark.read.format(releases.NAME).option("version", "v6").option("roles", "train").load(path).collect()] == [99] * 3
    narrow = spark.read.format(releases.NAME).schema("id string, dataset string").option("version", "v5").option("roles", "live").load(path)
    assert narrow.columns == ["id", "dataset"] and narrow.distinct().count() == 100
    with pytest.raises(Exception, match="no table validation"):
        spark.read.format(releases.NAME).option("version", "v5").load(path).count()


def test_filters_on_the_era_choose_what_is_read(spark):
    path, _ = _release(spark)

    def eras(*filters):
        reader = releases.ReleaseReader(path, "v5", ["train", "live"], None)
        assert list(reader.pushFilters(list(filters))) == list(filters)  # Spark applies them all the same
        found = reader.partitions()
        return {releases._era_of(p.file) for p in found if p.role == "train"}, sum(p.role == "live" for p in found)

    assert eras() == (set(range(1, 9)), 2)
    assert eras(EqualTo(("era",), 2)) == ({2}, 1)
    assert eras(In(("era",), (1, 7, 40))) == ({1, 7}, 1)
    assert eras(GreaterThan(("era",), 2), LessThanOrEqual(("era",), 4)) == ({3, 4}, 0)
    assert eras(EqualTo(("id",), "4")) == (set(range(1, 9)), 2)
    got = spark.read.format(releases.NAME).option("version", "v5").option("roles", "train").load(path).where("era = 3")
    of_era = [f for f in releases._files(path, "v5", "train") if "/era=3/" in f]
    assert got.rdd.getNumPartitions() == len(of_era) < len(releases._files(path, "v5", "train"))  # the other eras have no task
    assert got.count() == 50
    assert spark.read.format(releases.NAME).option("version", "v5").option("roles", "train").load(path).where("era = 77").count() == 0
