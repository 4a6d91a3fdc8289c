"""Triangular factors of tall matrices, one per group: the mergeable state of least squares.

The rows of a group form a tall matrix A. Its triangular factor R (``A = QR``, Q orthonormal and never formed) keeps all that a
least-squares fit needs -- ``R'R = A'A`` -- without squaring the condition number as the normal equations do. A task
factors the rows it has, a stretch at a time; factors are merged by stacking and factoring again, in any order, so the
factor of many groups together (the eras of a training window, say) comes from theirs without their rows.

A factor is at most q rows of q numbers (q columns), and never more rows than it was made from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers (128 MB) that a task holds before it hands its factors on.
HELD_VALUES = 16_000_000
#: Rows that are gathered before they are factored, at least (and four times the columns).
_STRETCH = 2048
#: Factors of more numbers than this are merged in two steps, within salts of their tasks first.
_SALTED_FROM, _SALTS = 100_000, 64


def compress(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of ``rows``, or the rows themselves where they are as few."""
    return np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows


class Factor:
    """The factor of the rows given so far, and their number."""

    def __init__(self, q: int):
        self.q, self.n, self.held, self.waiting = q, 0, [], 0

    def add(self, rows: np.ndarray, n: int) -> None:
        self.n += n
        self.held.append(rows)
        self.waiting += len(rows)
        if self.waiting >= max(_STRETCH, 4 * self.q):
            self.rows()

    def rows(self) -> np.ndarray:
        if len(self.held) != 1 or self.waiting > self.q:
            self.held = [compress(np.concatenate(self.held))] if self.held else [np.zeros((0, self.q))]
            self.waiting = len(self.held[0])
        return self.held[0]


def _schema(df: DataFrame, group: str) -> T.StructType:
    return T.StructType([T.StructField(group, df.schema[group].dataType), T.StructField("salt", T.IntegerType()),
                         T.StructField("n", T.LongType()), T.StructField("row", T.ArrayType(T.DoubleType()))])


def _batch(schema, group: str, kind, key, salt: int, factor: Factor):
    import pyarrow as pa

    rows = factor.rows()
    if not len(rows):  # a group of rows without columns still has its number
        rows = np.zeros((1, factor.q))
    n = np.zeros(len(rows), np.int64)
    n[0] = factor.n  # the number of rows stands in the first
    return pa.RecordBatch.from_pydict({
        group: pa.array([key] * len(rows), type=kind), "salt": pa.array(np.full(len(rows), salt, np.int32)), "n": pa.array(n),
        "row": pa.array(list(rows), type=pa.list_(pa.float64()))})


def partial_factors(df: DataFrame, group: str, vector: Column, q: int, weigh: Callable | None = None,
                    made: int | None = None) -> DataFrame:
    """Rows (group, salt, n, row) of every task's factors of its rows ``vector`` (q numbers, all present), or of what
    ``weigh`` makes of a matrix of them (``made`` numbers a row)."""
    schema, width = _schema(df, group), made or q

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        salt, held, kind = TaskContext.get().partitionId() % _SALTS, {}, None
        for rb in batches:
            if not rb.num_rows:
                continue
            kind = rb.column(0).type
            values = rb.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, q)
            values = values if weigh is None else weigh(values)
            coded = rb.column(0).dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
            for k, key in enumerate(coded.dictionary.to_pylist()):
                own = values[order[cuts[k]:cuts[k + 1]]]
                held.setdefault(key, Factor(width)).add(own, len(own))
            if sum(f.waiting for f in held.values()) * width > HELD_VALUES:
                if sum(len(f.rows()) for f in held.values()) * width > HELD_VALUES // 2:
                    for key, factor in held.items():
                        yield _batch(schema, group, kind, key, salt, factor)
                    held = {}
        for key, factor in held.items():
            yield _batch(schema, group, kind, key, salt, factor)

    return df.select(F.col(group), vector.alias("_row")).mapInArrow(run, schema)


def _merge(parts: DataFrame, group: str, q: int, by: list[str], finish: Callable, schema: T.StructType) -> DataFrame:
    """Factor rows sorted by ``by``, merged one group at a time; ``finish(kind, key, salt, factor)`` makes the batches."""

    def run(batches: Iterator) -> Iterator:
        now, factor, kind = None, None, None
        for rb in batches:
            if not rb.num_rows:
                continue
            kind = rb.column(0).type
            keys = list(zip(rb.column(0).to_pylist(), rb.column(1).to_pylist() if len(by) > 1 else [0] * rb.num_rows, strict=True))
            ns = rb.column(2).to_numpy()
            values = rb.column(3).flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, q)
            start = 0
            while start < len(keys):
                end = start + 1
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                if factor is None or keys[start] != now:
                    if factor is not None:
                        yield from finish(kind, now[0], now[1], factor)
                    now, factor = keys[start], Factor(q)
                factor.add(values[start:end].copy(), int(ns[start:end].sum()))
                start = end
        if factor is not None:
            yield from finish(kind, now[0], now[1], factor)

    return parts.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def merged(parts: DataFrame, group: str, q: int, finish: Callable, schema: T.StructType) -> DataFrame:
    """Every group's partial factors merged, handed to ``finish(kind, key, n, R)``, which yields Arrow batches of ``schema``.

    One group's factor is in memory at a time. Large factors are merged within salts first, so that no task gets one
    from every other task."""
    if q * q > _SALTED_FROM:
        same = _schema(parts, group)
        parts = _merge(parts, group, q, [group, "salt"], lambda kind, key, salt, f: [_batch(same, group, kind, key, salt, f)], same)
    return _merge(parts, group, q, [group], lambda kind, key, salt, f: finish(kind, key, f.n, f.rows()), schema)


def group_factors(df: DataFrame, group: str, vector: Column, q: int) -> DataFrame:
    """(group, n, row) of each group's factor: a ledger that further rows' factors may be added to."""
    parts = partial_factors(df, group, vector, q)
    same = _schema(parts, group)

    def finish(kind, key, n, rows):
        factor = Factor(q)
        factor.add(rows, n)
        yield _batch(same, group, kind, key, 0, factor)

    return merged(parts, group, q, finish, same)


def least_squares(rows: np.ndarray, k: int, targets: list[int], n: int) -> np.ndarray:
    """Minimum-norm coefficients (k x targets) of the first k columns for the given columns, from a factor of n rows."""
    if not k:
        return np.zeros((0, len(targets)))
    cut = max(n, k) * np.finfo(np.float64).eps
    return np.linalg.lstsq(rows[:, :k], rows[:, targets], rcond=cut)[0]
