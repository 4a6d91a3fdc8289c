"""The gate by keyed state: late, repeated and conflicting deliveries, restarts."""

from pyspark.sql import functions as F

from erascore.session import scratch_path
from erascore.streaming import rounds


def _deliver(spark, folder, rows):
    spark.createDataFrame(rows, "round int, id string, at long, v double").coalesce(1).write.mode("append").parquet(folder)


def test_each_key_passes_once_over_restarts(spark):
    source, sink, state = (scratch_path(spark, n) for n in ("src", "sink", "state"))
    schema = spark.createDataFrame([], "round int, id string, at long, v double").schema

    def run(keyed, sink, state):
        rounds.stream_score(spark, source, schema, sink, state, lambda b: b, order=["at"], max_files_per_trigger=1, keyed=keyed)
        return sorted((r["round"], r["id"], r["at"], r["v"]) for r in spark.read.parquet(sink).collect())

    nan = float("nan")
    _deliver(spark, source, [(5, "a", 2, 1.0), (5, "a", 1, 9.0), (5, "a", 1, 3.0), (5, "b", None, nan), (5, "b", 7, 1.0), (6, "a", 1, None)])
    assert [x[:3] for x in run(True, sink, state)] == [(5, "a", 1), (5, "b", None), (6, "a", 1)]
    _deliver(spark, source, [(5, "a", 0, 0.0), (4, "a", 3, 1.0), (6, "a", 1, 5.0), (6, "c", 1, 5.0), (4, "a", 3, 0.5)])
    _deliver(spark, source, [(4, "a", 0, 0.0), (6, "c", 0, 5.0), (1, "z", 0, 5.0)])
    got = run(True, sink, state)
    assert [x[:3] for x in got] == [(1, "z", 0), (4, "a", 3), (5, "a", 1), (5, "b", None), (6, "a", 1), (6, "c", 1)]
    assert [x[3] for x in got if x[:2] in ((4, "a"), (5, "a"))] == [0.5, 3.0]
    assert repr(run(True, sink, state)) == repr(got)  # nothing new: nothing written
    plain = run(False, scratch_path(spark, "sink"), scratch_path(spark, "state"))
    assert repr(plain) == repr(got)


def test_the_gate_reads_no_sink(spark):
    source, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    _deliver(spark, source, [(r, str(i), i, 0.0) for r in range(3) for i in range(20)] * 2)
    stream = rounds.keyed_gate(rounds.read_rounds(spark, source, spark.read.parquet(source).schema))
    q = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == 60 == out.select("round", "id").distinct().count()
    assert out.where(F.col("at") != F.col("id").cast("long")).count() == 0


def test_keys_are_looked_up_without_python(spark):
    """The state is Spark's own: at two calls from Python a key, a million keys were not done after 110 seconds."""
    source = scratch_path(spark, "src")
    _deliver(spark, source, [(1, "a", 1, 0.0)])
    plan = rounds.keyed_gate(rounds.read_rounds(spark, source, spark.read.parquet(source).schema))._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "TransformWithState" not in plan


def test_first_of_a_batch_among_many(spark):
    """Thousands of conflicting deliveries in one batch, nulls, NaN, structs and null keys among them."""
    source, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    at = F.when(F.col("i") % 11 == 0, None).otherwise(F.hash("i") % 50)
    v = F.when(F.col("i") % 7 == 0, float("nan")).when(F.col("i") % 5 == 0, None).otherwise((F.hash("i", F.lit(1)) % 9).cast("double"))
    rows = spark.range(6000).withColumnRenamed("id", "i").select(
        F.when(F.col("i") % 13 > 0, F.col("i") % 3).cast("int").alias("round"), (F.col("i") % 997).cast("string").alias("id"),
        at.alias("at"), v.alias("v"), F.struct(v.alias("x"), F.array(at).alias("y")).alias("s"))
    rows.write.parquet(source)
    q = rounds.keyed_gate(rounds.read_rounds(spark, source, rows.schema), order=["at"]).writeStream.format("parquet").option("path", sink) \
        .option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(repr(r) for r in spark.read.parquet(sink).collect())
    assert got == sorted(repr(r) for r in rounds.round_gate(rows, None, order=["at"]).collect())
    assert len(got) > 3000
