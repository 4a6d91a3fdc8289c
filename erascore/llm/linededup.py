"""Line deduplication against levelled, sorted runs of line keys.

A ledger holds runs: tables of (h1, h2, docs), bucketed and sorted by the 128-bit key hash, each with the
number of documents its batches had per key. A new batch is counted, merge-anti-joined with the runs' keys
that are already frequent, and written as a run of its own at level 0. Two runs of a level are merged by
a sort-merge join (no shuffle: both are bucketed alike) into one of the next level, so n batches leave at
most log2 n runs. When every batch is in, each document loses the lines whose key is frequent.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; the key of an empty line
is never counted. A row is a document: repeated rows count as often as they come.

Defined cases: a null or empty text is one empty line, which stays; an empty table gives an empty result;
a text that loses all lines becomes empty; further columns, whatever their names, are kept by ``dedup_lines``
and ignored by ``line_report``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import delete_path, shared_path, shuffle_width, staged

MIN_DOCS = 10
BATCHES = 4
#: Frequent keys up to here (16 bytes each) are sent to the tasks as one sorted array; beyond, they are joined.
BROADCAST_KEYS = 2_000_000


def line_keys(text: str | None) -> list[bytes]:
    return [line.strip() for line in (text or "").encode().lower().split(b"\n")]


def _hashes(keys: list[bytes]):
    """The 128-bit hashes of keys as two arrays of int64; (0, 0) for the empty key."""
    import numpy as np
    import xxhash

    raw = b"".join(xxhash.xxh3_128_digest(k) if k else bytes(16) for k in keys)
    both = np.frombuffer(raw, "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def key_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h1, h2): a row for each document and each different non-empty key in it."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: list[bytes] = []
            for value in batch.column(0):
                out += {*line_keys(value.as_py())} - {b""}
                if len(out) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _hashes(out)], ["h1", "h2"])
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _hashes(out)], ["h1", "h2"])

    return docs.select(F.col(text).cast("string")).mapInArrow(rows, "h1 long, h2 long")


class LineRuns:
    """The ledger. Its tables lie in the shared folder and are named in the session's catalogue only to be read
    by bucket."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark, self.min_docs, self.width = spark, min_docs, shuffle_width(spark)
        self.runs: list[tuple[int, str, str]] = []  # level, table, path

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        path = shared_path(self.spark, name)
        (counts.write.bucketBy(self.width, "h1", "h2").sortBy("h1", "h2").format("parquet").option("path", path).saveAsTable(name))
        self.runs.append((level, name, path))

    def _drop(self, run: tuple[int, str, str]) -> None:
        self.runs.remove(run)
        self.spark.sql(f"DROP TABLE {run[1]}")
        delete_path(self.spark, run[2])

    def add(self, batch: DataFrame, text: str = "text") -> None:
        """Count a batch, leave out what the runs know as frequent, add the rest as a run, and compact."""
        counts = key_rows(batch, text).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"))
        counts = counts.repartition(self.width, "h1", "h2")
        for _, name, _ in self.runs:
            known = self.spark.table(name).where(F.col("docs") >= self.min_docs)
            counts = counts.join(known.hint("merge"), ["h1", "h2"], "left_anti")
        self._write(counts, 0)
        self.compact()

    def compact(self, down_to: int | None = None) -> None:
        """Merge two runs of one level while there are any; with ``down_to``, until so many runs are left."""
        while True:
            self.runs.sort()
            pair = next(((a, b) for a, b in zip(self.runs, self.runs[1:]) if a[0] == b[0]), None)  # noqa: B905
            if pair is None and down_to is not None and len(self.runs) > down_to:
                pair = self.runs[0], self.runs[1]
            if pair is None:
                return
            a, b = (self.spark.table(name).withColumnRenamed("docs", f"docs_{side}") for side, (_, name, _) in zip("ab", pair, strict=True))
            merged = a.join(b.hint("merge"), ["h1", "h2"], "full_outer").select(
                "h1", "h2", (F.coalesce("docs_a", F.lit(0)) + F.coalesce("docs_b", F.lit(0))).alias("docs"))
            self._write(merged, pair[1][0] + 1)
            for run in pair:
                self._drop(run)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents."""
        self.compact(down_to=1)
        if not self.runs:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        return self.spark.table(self.runs[0][1]).where(F.col("docs") >= self.min_docs).select("h1", "h2")

    def close(self) -> None:
        for run in list(self.runs):
            self._drop(run)


def _cleaned(text: str, dropped) -> tuple[str, int, int]:
    lines = text.split("\n")
    kept = [line for line, gone in zip(lines, dropped, strict=True) if not gone]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _with_lines(docs: DataFrame, text: str, mapper) -> DataFrame:
    fields = [StructField(f.name, StringType() if f.name == text else f.dataType, True) for f in docs.schema.fields]
    return docs.mapInArrow(mapper, StructType([*fields, StructField("__n_lines", LongType()), StructField("__n_dropped", LongType())]))


def _mapper(text: str, flags):
    """Batches with ``text`` cleaned, n_lines and n_dropped appended; flags(hashes, batch) tells the lines to drop."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            at = whole.schema.get_field_index(text)
            for begin in range(0, max(whole.num_rows, 1), 1000):
                batch = whole.slice(begin, 1000)
                texts = [x or "" for x in batch.column(at).to_pylist()]
                keys = [line_keys(x) for x in texts]
                gone, out, done = flags([k for ks in keys for k in ks], batch, keys), [], 0
                for x, ks in zip(texts, keys, strict=True):
                    out.append(_cleaned(x, gone[done:done + len(ks)]))
                    done += len(ks)
                clean, n, dropped = zip(*out, strict=True) if out else ((), (), ())
                names = [n for n in batch.schema.names if n != "__gone"]
                cols = [pa.array(clean, pa.string()) if n == text else batch.column(batch.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(dropped, pa.int64())],
                                                 [*names, "__n_lines", "__n_dropped"])

    return run


def drop_lines(docs: DataFrame, frequent: DataFrame, text: str = "text", broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` without the lines whose key is in ``frequent``; adds __n_lines and __n_dropped.

    Up to ``broadcast_keys`` keys are sent to the tasks; beyond, the texts' different keys are joined with
    them and the hits return to the text by its digest. Both give the same rows."""
    spark = docs.sparkSession
    docs = docs.withColumn(text, F.col(text).cast("string"))
    if frequent.count() <= broadcast_keys:
        import numpy as np

        table = frequent.toArrow()
        known = np.rec.fromarrays([table["h1"].to_numpy(), table["h2"].to_numpy()], dtype=[("h1", "i8"), ("h2", "i8")])
        sent = spark.sparkContext.broadcast(np.sort(known, order=["h1", "h2"]))

        def flags(keys, batch, per_doc):
            h1, h2 = _hashes(keys)
            known = sent.value
            if not len(known):
                return np.zeros(len(keys), bool)
            # equal first halves are next to one another: look from the first on for as long as any match
            at, end = np.searchsorted(known.h1, h1, "left"), np.searchsorted(known.h1, h1, "right")
            hit = np.zeros(len(keys), bool)
            for step in range(int((end - at).max(initial=0))):
                live = at + step < end
                hit[live] |= known.h2[at[live] + step] == h2[live]
            return hit

        return _with_lines(docs, text, _mapper(text, flags))
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = list({*line_keys(value.as_py())} - {b""})
                h1, h2 = _hashes(keys)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(h1), pa.array(h2)], ["digest", "h1", "h2"])

    each = docs.select(digest.alias("digest"), F.col(text)).mapInArrow(rows, "digest string, h1 long, h2 long")
    hits = each.join(frequent, ["h1", "h2"], "left_semi").distinct().groupBy("digest").agg(
        F.collect_list(F.struct("h1", "h2")).alias("__gone"))
    hits = hits.withColumnRenamed("digest", "__digest")
    joined = docs.withColumn("__key", digest).join(hits, F.col("__key") == F.col("__digest"), "left").drop("__key", "__digest")

    def marked(keys, batch, per_doc):
        h1, h2 = _hashes(keys)
        out, done = [], 0
        for gone, ks in zip(batch.column(batch.schema.get_field_index("__gone")).to_pylist(), per_doc, strict=True):
            known = {(g["h1"], g["h2"]) for g in gone or ()}
            out += [(int(a), int(b)) in known for a, b in zip(h1[done:done + len(ks)], h2[done:done + len(ks)], strict=True)]
            done += len(ks)
        return out

    fields = [StructField(f.name, StringType() if f.name == text else f.dataType, True) for f in docs.schema.fields]
    return joined.mapInArrow(_mapper(text, marked), StructType([*fields, StructField("__n_lines", LongType()), StructField("__n_dropped", LongType())]))


def frequent_keys(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Feed ``docs`` to a ledger in batches; the staged table of frequent keys."""
    ledger = LineRuns(docs.sparkSession, min_docs)
    only = docs.select(F.col(text).cast("string").alias("text"))
    for b in range(batches):
        ledger.add(only.where(F.pmod(F.xxhash64("text"), F.lit(batches)) == b))
    found = staged(ledger.frequent(), "line-frequent")
    ledger.close()
    return found


def dedup_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, batches: int = BATCHES,
                broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` with cleaned texts, and __n_lines, __n_dropped."""
    return drop_lines(docs, frequent_keys(docs, text, min_docs, batches), text, broadcast_keys)


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    out = dedup_lines(docs.select("doc_id", "text"), min_docs=min_docs)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.col("text"), 256).alias("kept_sha256"))
