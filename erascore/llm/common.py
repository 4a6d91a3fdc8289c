"""Shared helpers of the training-data operators: shared folders, staged tables, components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import prepare_session


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares (``spark.checkpoint.dir``; the session's own
    checkpoint folder where that is unset, as in tests)."""
    base = prepare_session(spark)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends there, so a
    lost executor costs a reread, and several consumers share one computation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``staged``, and aggregates of the rows written, observed in the same job."""
    seen = Observation()
    watched = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    out = staged(watched, name)
    return out, seen.get


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables staged inside are deleted at the end, but for the last one: the result that all others led to. Nothing
    else that reads them may leave the block unwritten."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        paths = _SCRATCH.pop()
        for path in paths[:-1]:
            delete_path(spark, path)
        if _SCRATCH:
            _SCRATCH[-1] += paths[-1:]


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few given rows as a table of literals."""
    fields = StructType.fromDDL(schema).fields
    each = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*each)))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote into the shared folder and needs no more."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def sized(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """``df`` in no more tasks than its (known) rows call for; a table of many rows keeps the session's width."""
    tasks = max(1, -(-rows // per_task))
    return df.coalesce(tasks) if tasks < shuffle_width(df.sparkSession) else df


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) of every node in ``edges`` (columns a, b): label is the smallest node of its
    component. Alternating large-star / small-star rounds, each a pre-aggregated minimum and a join,
    so that a hub costs one partial minimum per task and a join that adaptive execution may split.

    Nulls are no nodes; loops name a node alone; an empty table gives an empty result. Raises when
    ``max_rounds`` do not suffice (the rounds needed grow with the square of the logarithm)."""
    named = edges.select(F.col("a"), F.col("b")).where("a IS NOT NULL AND b IS NOT NULL")
    nodes = named.select(F.col("a").alias("node")).union(named.select("b")).distinct()
    cur = named.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur, state = staged_with(cur, "edges", **_signature())
    for _ in range(max_rounds):
        if state["n"] == 0:
            break
        n = 2 * state["n"]
        both = cur.union(cur.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = sized(both.groupBy("u").agg(F.min("v").alias("m")), n).select("u", F.least("m", "u").alias("m"))
        large = sized(both.join(least, "u"), n).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = sized(large.where("a <> b").distinct(), n)
        joined = sized(large.join(sized(large.groupBy("a").agg(F.min("b").alias("m")), n), "a"), n)
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(joined.select(F.col("a"), F.col("m"))).where("a <> b").distinct())
        cur, new = staged_with(sized(small, n), "edges", **_signature())
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = cur.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    return nodes.join(found, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _signature() -> dict[str, Column]:
    """What tells one round's edges from another's; counted while they are written."""
    return {"n": F.count(F.lit(1)), "s": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), "t": F.bit_xor(F.xxhash64("b", "a"))}
