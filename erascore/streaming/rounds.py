"""Live rounds as a file stream.

The reference polls a web service every 300 seconds and then processes the round's live file once.
Here new round files landing in a folder are the stream: the file source reads each file once (tracked
in the checkpoint), and every micro-batch is compared with what the sink already holds, scored and
written. Rounds may come late, out of order or twice: no watermark is used, so a row is left out only
where the same ``(round, id)`` was written before, never because of its age. The state of that comparison is the
sink itself, read for the batch's rounds only.

``keyed_gate`` keeps that comparison in keyed state instead (one entry per ``(round, id)`` in RocksDB, checkpointed with the
query): the sink is never read, and a row costs one state lookup whatever was written before. The lookup is Spark's own
(``dropDuplicates``); which of a batch's deliveries stays is settled before it, by hashed slices of the keys.

The writer is idempotent (one output folder per batch id, overwritten on replay, and never compared with
itself), so a restarted query after an executor or driver failure does not duplicate output.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.sinks import path_exists

POLL_SECONDS = 300  # fixed value: the reference's poll interval


def read_rounds(spark: SparkSession, folder: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of round files (parquet) as they arrive."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def round_gate(batch: DataFrame, written: DataFrame | None, keys: Sequence[str] = ("round", "id"), order: Sequence[str] = ()) -> DataFrame:
    """The rows of a batch that were not delivered before: once per key, and none of ``written``.

    Of several deliveries of a key within a batch the first stays: by the columns ``order`` (of arrival), then by all other columns in
    their order, so a replay takes the same one. The columns must be of orderable types (no maps)."""
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    first = [c for c in order if c in rest]
    ranked = F.struct(*first, *[c for c in rest if c not in first])
    once = batch.groupBy(*keys).agg(F.min(ranked).alias("_first")).select(*[c if c in keys else F.col(f"_first.`{c}`").alias(c) for c in batch.columns]) if rest else batch.distinct()
    return once if written is None else once.join(written.select(*keys), keys, "left_anti")


def _rank(value) -> tuple:
    """Orders values as Spark does: nulls first, NaN last."""
    if value is None:
        return (0,)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    if isinstance(value, dict):  # a struct, as Arrow gives it
        value = tuple(value.values())
    return (1, tuple(map(_rank, value))) if isinstance(value, (list, tuple)) else (1, value)


SLICES = 1024  # hashed slices of the keys; one holds its part of a batch's different keys at a time
_HASH = "__gate_hash"


def _first_of_batch(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first delivery of each key within a micro-batch, by the columns ``order``, nulls first and NaN last."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            _, place, count = np.unique(table.column(_HASH).to_numpy(), return_inverse=True, return_counts=True)
            several = count[place] > 1  # the same key, or as seldom as not keys of one hash
            best: dict[tuple, tuple] = {}
            at = np.flatnonzero(several)
            for i, row in zip(at.tolist(), table.take(at).to_pylist() if len(at) else [], strict=True):
                key, rank = tuple(_rank(row[c]) for c in keys), tuple(_rank(row[c]) for c in order)
                if key not in best or rank < best[key][0]:
                    best[key] = (rank, i)
            several[[i for _, i in best.values()]] = False
            kept = table.take(np.flatnonzero(~several))
        if kept is not None:
            yield from kept.drop_columns([_HASH, "__gate_slice"]).to_batches()

    hashed = stream.withColumn(_HASH, F.xxhash64(*keys))
    return hashed.withColumn("__gate_slice", F.pmod(_HASH, F.lit(SLICES))).groupBy("__gate_slice").applyInArrow(rows, stream.schema)


class _FirstDelivery(StatefulProcessor):
    """Passes on the first delivery of a key, and remembers that it did."""

    def __init__(self, order: Sequence[str], forget_after_ms: int | None):
        self.order, self.forget_after_ms = list(order), forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("seen", T.BooleanType())]), self.forget_after_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = min(rows, key=lambda r: tuple(_rank(r[c]) for c in self.order), default=None)
        if best is not None and not self.seen.exists():
            self.seen.update((True,))
            yield best

    def close(self) -> None:
        pass


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_gate(stream: DataFrame, keys: Sequence[str] = ("round", "id"), order: Sequence[str] = (), forget_after_ms: int | None = None) -> DataFrame:
    """T2 as keyed state: the rows of a stream that were not delivered before, once per key.

    The same row as ``round_gate`` takes of several deliveries. State is kept for ever, so no delivery is too late; with
    ``forget_after_ms`` an entry is dropped that long after it was made, and a later delivery of the key counts as new: such entries
    are kept by a stateful processor in Python, at two calls to the state a key. Sets the session's state store to RocksDB."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rest = [c for c in stream.columns if c not in keys]
    first = [c for c in order if c in rest]
    ranked = [*first, *[c for c in rest if c not in first]]
    if forget_after_ms is None:
        return (_first_of_batch(stream, keys, ranked) if rest else stream).dropDuplicates(list(keys))
    return stream.groupBy(*keys).transformWithState(
        statefulProcessor=_FirstDelivery(ranked, forget_after_ms), outputStructType=stream.schema, outputMode="Append", timeMode="ProcessingTime")


def _written(batch: DataFrame, folder: str, batch_id: int, keys: Sequence[str], fmt: str) -> DataFrame | None:
    """Keys that earlier batches wrote for the rounds of this one (partition-pruned by round)."""
    spark = batch.sparkSession
    if not path_exists(spark, folder):
        return None
    rounds = [r[0] for r in batch.select(keys[0]).distinct().collect()]  # the rounds of one micro-batch
    schema = T.StructType([T.StructField("batch", T.LongType()), *[T.StructField(k, batch.schema[k].dataType) for k in keys]])
    reader = spark.read.option("header", True).option("enforceSchema", False) if fmt == "csv" else spark.read
    if fmt == "csv":  # the written columns come from the header; only the keys are kept
        seen = reader.csv(folder).select("batch", *[F.col(k).cast(batch.schema[k].dataType).alias(k) for k in keys])
    else:
        seen = reader.schema(schema).parquet(folder)
    return seen.where((F.col("batch") < batch_id) & F.col(keys[0]).isin(rounds)).select(*keys)


def idempotent_sink(folder: str, score: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ("round",),
                    keys: Sequence[str] | None = None, fmt: str = "parquet", order: Sequence[str] = ()):
    """foreachBatch writer: gate the batch (where ``keys`` are given), score it, write it under
    ``batch=<id>`` (overwrite on replay). ``fmt="csv"`` writes submission files with a header."""
    folder = folder.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if keys is None else round_gate(batch, _written(batch, folder, batch_id, keys, fmt), keys, order)
        out = score(rows).write.mode("overwrite").partitionBy(*partition_by)
        out = out.option("header", True) if fmt == "csv" else out
        out.format(fmt).save(f"{folder}/batch={batch_id}")
    return write


def stream_score(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
                 score: Callable[[DataFrame], DataFrame], available_now: bool = True,
                 poll_seconds: int = POLL_SECONDS, keys: Sequence[str] | None = ("round", "id"), fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, order: Sequence[str] = (), keyed: bool = False):
    """Rounds -> gate -> score -> submission files; ``keyed`` gates by state instead of by what the sink holds. ``available_now`` processes what has arrived
    and stops (a scheduled run); otherwise it polls every ``poll_seconds`` and the running
    ``StreamingQuery`` is returned (``stop()`` it to end)."""
    stream = read_rounds(spark, source, schema, max_files_per_trigger)
    if keyed and keys is not None:
        stream, keys = keyed_gate(stream, keys, order), None
    writer = (stream.writeStream
              .foreachBatch(idempotent_sink(sink, score, keys=keys, fmt=fmt, order=order))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{poll_seconds} seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
