"""Vector codes: product quantization of integer vectors by active-entry Lloyd rounds, exact in integers.

Vectors are scaled to integers, cut into equal parts, and each part position has a codebook of its own. A round assigns
every part to the nearest entry (ties to the lower index) and moves the entries to the floored means of their parts.
The assignment and its exact distance are stored with the vector: a part whose entry has not moved since compares
that distance with the moved entries only, since all others are where they were and had lost already; a part whose
entry did move rescans the codebook. Each round is one pass over the vectors, written to the shared folder with its sums; the
codebooks (entries x dimensions numbers) are all that reaches the driver.

Defined cases: rows whose vector is null, or holds a null, a NaN or an infinity, are dropped; the first vector in order of vec_id gives the
number of dimensions, and a vector of another length keeps its row with a null code and error; ties of vec_id are ordered by vector; null
vec_ids come last and are coded like any other; fewer vectors than entries give as many entries; an empty table gives an empty
result; further columns are ignored. A length that cannot be cut into equal parts, and components so large that the error
does not fit a long, raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_path, scratch, shared_path, staged, staged_with

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
_ROWS = 16_384  # vectors held at once by a task
_STATE = "vec_id long, label string, vec binary, code binary, dist binary, part int, entry int, n long, sums array<long>"


def scaled(rows: DataFrame) -> DataFrame:
    """vec_id, label and the components times ``SCALE``, floored, of the rows whose vector is whole and finite."""
    usable = F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    # a component beyond a long would wrap: it is cut to 2**62, which the size check refuses
    most = float(1 << 62)
    number = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(most)), F.lit(-most))).cast("long")
    return (rows.where(usable)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                    F.transform("embedding", number).alias("v")))


def nearest(points, entries):
    """(index, squared distance) of the nearest entry to each point, ties to the lower index; whole numbers throughout."""
    import numpy as np

    exact = _exact_type(points, entries)
    p, e = points.astype(exact), entries.astype(exact)
    # |p|^2 - 2pe + |e|^2 in doubles is exact while every term is below 2**53; else in 64-bit integers
    d = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None, :]
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best].astype(np.int64)


def _exact_type(points, entries):
    import numpy as np

    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    return np.float64 if 4 * max(points.shape[1], 1) * most * most < 1 << 53 else np.int64


def reassign(points, entries, moved, code, dist):
    """(code, dist) after the entries named in ``moved`` (ascending) moved: see the module's text. ``code`` -1: none yet."""
    import numpy as np

    code, dist = code.copy(), dist.copy()
    has_moved = np.zeros(len(entries) + 1, bool)
    has_moved[moved] = True
    has_moved[-1] = True  # an unassigned part rescans
    stale = has_moved[code]
    again = np.flatnonzero(stale)
    if len(again):
        code[again], dist[again] = nearest(points[again], entries)
    fixed = np.flatnonzero(~stale)
    if len(fixed) and len(moved):
        at, d = nearest(points[fixed], entries[moved])
        at = moved[at]
        better = (d < dist[fixed]) | ((d == dist[fixed]) & (at < code[fixed]))
        code[fixed[better]], dist[fixed[better]] = at[better], d[better]
    return code, dist


def _round(books, moved, width: int):
    """A pass over the state: new codes and distances, then a row of sums for each entry that a task has used."""
    parts = len(books)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        fields = [("vec_id", pa.int64()), ("label", pa.string()), ("vec", pa.binary()), ("code", pa.binary()), ("dist", pa.binary()),
                  ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]
        schema = pa.schema(fields)
        sums = [np.zeros((len(b), width), np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                some = batch.slice(start, _ROWS)
                n = some.num_rows
                vecs = np.frombuffer(b"".join(some.column("vec").to_pylist()), "<i8").reshape(n, parts, width)
                codes = np.frombuffer(b"".join(some.column("code").to_pylist()), "<i2").reshape(n, parts).astype(np.int64)
                dists = np.frombuffer(b"".join(some.column("dist").to_pylist()), "<i8").reshape(n, parts).copy()
                for p in range(parts):
                    codes[:, p], dists[:, p] = reassign(vecs[:, p], books[p], moved[p], codes[:, p], dists[:, p])
                    np.add.at(sums[p], codes[:, p], vecs[:, p])
                    counts[p] += np.bincount(codes[:, p], minlength=len(books[p]))
                empty = [pa.nulls(n, t) for _, t in fields[5:]]
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), some.column("vec"),
                     pa.array([c.tobytes() for c in codes.astype("<i2")], pa.binary()),
                     pa.array([d.tobytes() for d in dists.astype("<i8")], pa.binary()), *empty], schema=schema)
        used = [(p, e, int(counts[p][e]), sums[p][e]) for p in range(parts) for e in np.flatnonzero(counts[p])]
        if used:
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(used), t) for _, t in fields[:5]], pa.array([u[0] for u in used], pa.int32()),
                 pa.array([u[1] for u in used], pa.int32()), pa.array([u[2] for u in used], pa.int64()),
                 pa.array([u[3].tolist() for u in used], pa.list_(pa.int64()))], schema=schema)

    return run


def _moved_entries(state: DataFrame, books):
    """The codebooks after a round's sums, and for each part the entries that moved."""
    import numpy as np

    sums = (state.where("n IS NOT NULL").select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
            .groupBy("part", "entry", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    new = [b.copy() for b in books]
    for r in sums.collect():  # parts x entries x width numbers at most
        new[r["part"]][r["entry"], r["at"]] = r["s"] // r["n"]
    return new, [np.flatnonzero((a != b).any(axis=1)) for a, b in zip(new, books, strict=True)]


def codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """(coded, books): vec_id, label, code (binary, an unsigned byte for each part) and error of every kept row (both null where
    the length differs); and the final codebooks, one integer array (entries x part width) for each part."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    import numpy as np

    spark = rows.sparkSession
    kept, seen = staged_with(scaled(rows), "codes-kept", most=F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = kept.orderBy(*order).limit(1).collect()
    dims = len(first[0]["v"]) if first else 0
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    width = dims // parts
    if dims * (2 * int(seen["most"] or 0)) ** 2 >= 1 << 62:
        raise ValueError("components are so large that the error does not fit a long")
    whole = kept.where(F.size("v") == dims)
    seeds = whole.orderBy(*order).limit(entries).select("v").collect()
    start = np.array([r["v"] for r in seeds], dtype=np.int64).reshape(len(seeds), parts, width)
    books = [start[:, p].copy() for p in range(parts)]
    moved = [np.arange(len(seeds)) for _ in range(parts)]

    def as_state(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(n, dims)
            none, zero = np.full(parts, -1, "<i2").tobytes(), np.zeros(parts, "<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in flat], pa.binary()), pa.array([none] * n, pa.binary()),
                 pa.array([zero] * n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.list_(pa.int64()))], names=[f.split()[0] for f in _STATE.split(", ")])

    state, before = whole.mapInArrow(as_state, _STATE), None
    for turn in range(rounds + 1):
        path = shared_path(spark, "codes-state")
        state.where("vec IS NOT NULL").mapInArrow(_round(books, moved, width), _STATE).write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(_STATE).parquet(path)
        if before:
            delete_path(spark, before)  # a round's table is read by the next one only
        before = path
        if turn < rounds:
            books, moved = _moved_entries(state, books)

    def read_back(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            code = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i2").reshape(n, parts).astype(np.uint8)
            dist = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i8").reshape(n, parts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary()),
                                              pa.array(dist.sum(axis=1, dtype=np.int64))], names=["vec_id", "label", "code", "error"])

    coded = state.where("vec IS NOT NULL").select("vec_id", "label", "code", "dist").mapInArrow(read_back, "vec_id long, label string, code binary, error long")
    other = kept.where(F.size("v") != dims).select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = staged(coded.unionByName(other), "codes-coded")
    delete_path(spark, before)
    return coded, books


def code_report(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (hex), error, label_error (the sum over equal labels, nulls together) and codebooks_sha256."""
    with scratch(rows.sparkSession):
        coded, books = codes(rows, parts, entries, rounds)
        digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
        totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
        out = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
        return staged(out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                                 F.lit(digest).alias("codebooks_sha256")), "codes-report")
