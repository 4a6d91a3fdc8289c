"""Boosted regression trees from gradient histograms (M1), resumable tree by tree.

The rows are read once: each feature becomes a byte, the bin of its value among at most 254 cuts from a quantile sketch, and the binned
table is written to the shared folder. A level of a tree is one pass over that table: every task sums the residuals per
(node, feature, bin), the sums of a (node, feature) are merged and give its best cut, and only the best cut of each node (at
most 2**depth rows) reaches the driver. Columns are drawn once a tree. The children's values come with the cut, so a tree of depth d
is d passes. Every finished tree is a row of the ledger; a run that was lost goes on behind its last one.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import present
from ..session import scratch_path
from .leastsquares import SCORE

MAX_CUTS = 254
#: Trees that are evaluated anew in every pass before the table is written with their sum.
FOLD_EVERY = 25
_HISTOGRAM = "node int, feature int, sums array<double>, counts array<long>"
_CUT = "node int, feature int, gain double, cut int, g double, n long, gl double, nl long"


@dataclass
class Tree:
    """Nodes by heap index (children of i: 2i + 1, 2i + 2). ``feature`` -1 marks a leaf; a row goes left if its value is missing or
    at most ``threshold`` (its bin at most ``cut``)."""
    feature: list[int]
    cut: list[int]
    threshold: list[float]
    value: list[float]

    def leaves(self, goes_left, n: int) -> np.ndarray:
        feature, node = np.array(self.feature), np.zeros(n, np.int64)
        for _ in range((len(self.feature) + 1).bit_length() - 2):
            inner = np.flatnonzero(feature[node] >= 0)
            left = goes_left(inner, node[inner], feature[node[inner]])
            node[inner] = 2 * node[inner] + 2 - left
        return node

    def of_values(self, x: np.ndarray) -> np.ndarray:
        threshold = np.array(self.threshold)

        def goes_left(rows, nodes, features):
            v = x[rows, features]
            return np.isnan(v) | (v <= threshold[nodes])

        return np.array(self.value)[self.leaves(goes_left, len(x))]

    def nodes_of_bins(self, bins: np.ndarray) -> np.ndarray:
        cut = np.array(self.cut)
        return self.leaves(lambda rows, nodes, features: bins[rows, features] <= cut[nodes], len(bins))


@dataclass
class BoostedModel:
    """``transform`` adds the model's ``score`` to the rows."""
    features: list[str]
    base: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self.rate * tree.of_values(x)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        model = df.sparkSession.sparkContext.broadcast(self)  # the model's size, whatever the data

        def score(x: pd.Series) -> pd.Series:
            rows = np.array(x.tolist(), dtype=np.float64).reshape(len(x), -1) if len(x) else np.zeros((0, len(model.value.features)))
            return pd.Series(model.value.predict(rows))

        given = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.features])
        return df.withColumn(SCORE, F.pandas_udf(score, "double")(given))


def _cuts(df: DataFrame, features: Sequence[str], max_cuts: int) -> list[list[float]]:
    """Ascending cuts of every feature, values that occur in it, from one quantile sketch each."""
    shares = [(i + 1) / (max_cuts + 1) for i in range(max_cuts)]
    out: list[list[float]] = []
    for start in range(0, len(features), 200):  # so many sketches a pass
        some = features[start:start + 200]
        value = [F.when(present(F.col(c).cast("double")), F.col(c).cast("double")) for c in some]
        row = df.agg(*[F.percentile_approx(v, shares, 20_000).alias(f"c{i}") for i, v in enumerate(value)]).first()
        out += [sorted(set(row[f"c{i}"] or [])) for i in range(len(some))]
    return out


def _binned(df: DataFrame, features: Sequence[str], target: str, cuts: list[list[float]]) -> DataFrame:
    given = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])
    k = len(features)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        edges = [np.array(c) for c in cuts]
        for rb in batches:
            n = rb.num_rows
            x = rb.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, k)
            bins = np.empty((n, k), np.uint8)
            for j in range(k):  # missing: bin 0; at most the first cut: 1
                bins[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(edges[j], x[:, j]))
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), rb.column(1)], names=["bins", "y"])

    rows = df.where(present(F.col(target).cast("double"))).select(given.alias("x"), F.col(target).cast("double").alias("y"))
    return rows.mapInArrow(run, "bins binary, y double")


def _read(rb, k: int, trees: list[Tree], rate: float):
    """Bins, and residuals after ``trees``, of a batch (bins, y, fitted)."""
    bins = np.frombuffer(b"".join(rb.column(0).to_pylist()), np.uint8).reshape(rb.num_rows, k)
    fitted = rb.column(2).to_numpy().copy()
    for tree in trees:
        fitted += rate * np.array(tree.value)[tree.nodes_of_bins(bins)]
    return bins, rb.column(1).to_numpy() - fitted, fitted


def _level(table: DataFrame, k: int, recent: list[Tree], rate: float, tree: Tree, columns: list[int], nodes: list[int], l2: float) -> list:
    """The best cut of each of ``nodes`` over ``columns``; nodes without one that gains are left out."""
    size = MAX_CUTS + 2

    def histograms(batches: Iterator) -> Iterator:
        import pyarrow as pa

        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))
        sums = np.zeros((len(columns), len(nodes) * size))
        counts = np.zeros((len(columns), len(nodes) * size), np.int64)
        for rb in batches:
            bins, left, _ = _read(rb, k, recent, rate)
            at = place[tree.nodes_of_bins(bins)]
            rows = np.flatnonzero(at >= 0)
            at, left = at[rows] * size, left[rows]
            for i, c in enumerate(columns):
                index = at + bins[rows, c]
                sums[i] += np.bincount(index, weights=left, minlength=sums.shape[1])
                counts[i] += np.bincount(index, minlength=sums.shape[1])
        for j, node in enumerate(nodes):
            own = slice(j * size, (j + 1) * size)
            some = [i for i in range(len(columns)) if counts[i, own].any()]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([node] * len(some), pa.int32()), "feature": pa.array([columns[i] for i in some], pa.int32()),
                "sums": pa.array([sums[i, own] for i in some], pa.list_(pa.float64())),
                "counts": pa.array([counts[i, own] for i in some], pa.list_(pa.int64()))})

    def cuts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def best(key, s, c):
            gl, nl = np.cumsum(s)[:-1], np.cumsum(c)[:-1]
            g, n = s.sum(), int(c.sum())
            gain = np.where((nl > 0) & (nl < n), gl * gl / (nl + l2) + (g - gl) ** 2 / (n - nl + l2) - g * g / (n + l2), -1.0)
            at = int(gain.argmax())
            return (*key, float(gain[at]), at, float(g), n, float(gl[at]), int(nl[at]))

        now, s, c, out = None, None, None, []
        for rb in batches:
            for node, feature, a, b in zip(*[rb.column(i).to_pylist() for i in range(2)], rb.column(2), rb.column(3), strict=True):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                if (node, feature) == now:
                    s, c = s + a, c + b
                    continue
                if now is not None:
                    out.append(best(now, s, c))
                now, s, c = (node, feature), a, b
        if now is not None:
            out.append(best(now, s, c))
        names = [f.split()[0] for f in _CUT.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
        cols = list(zip(*out, strict=True)) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds, strict=True)], names=names)

    parts = table.mapInArrow(histograms, _HISTOGRAM).repartition("node", "feature").sortWithinPartitions("node", "feature")
    every = parts.mapInArrow(cuts, _CUT).where("gain > 0")
    # of equal gains the lower feature, then the lower cut
    return [r["b"] for r in every.groupBy("node").agg(F.max_by(F.struct("*"), F.struct("gain", -F.col("feature"), -F.col("cut"))).alias("b")).collect()]


def boost(train: DataFrame, features: Sequence[str], target: str = "target", n_trees: int = 6000, depth: int = 8, rate: float = 0.007,
          column_share: float = 0.1, l2: float = 1.0, seed: int = 0, max_cuts: int = MAX_CUTS, ledger: str | None = None) -> BoostedModel:
    """``n_trees`` trees for the squared error, each over its own draw of ``column_share`` of the columns (one at least). Rows without a
    target are left out; a missing feature lies below all its values.

    ``ledger`` names a folder for the finished trees: a later call with the same settings takes up what is there, also for more
    trees than before. Other settings over the same ledger raise ValueError, as do no rows."""
    spark, features = train.sparkSession, list(features)
    k = len(features)
    settings = {"features": features, "target": target, "depth": depth, "rate": rate, "column_share": column_share, "l2": l2, "seed": seed, "max_cuts": max_cuts}
    ledger = ledger or scratch_path(spark, "boost-ledger")
    known = _ledger_rows(spark, ledger)
    if known:
        start = json.loads(known[-1])
        if start["settings"] != settings:
            raise ValueError("the ledger belongs to other settings")
        cuts, base = start["cuts"], start["base"]
    else:
        base = train.where(present(F.col(target).cast("double"))).agg(F.avg(F.col(target).cast("double")).alias("m")).first()["m"]
        if base is None:
            raise ValueError("no rows to fit")
        cuts = _cuts(train, features, max_cuts)
        _add(spark, ledger, -1, json.dumps({"settings": settings, "cuts": cuts, "base": base}))
    model = BoostedModel(features, base, rate, [Tree(**json.loads(known[t])) for t in sorted(t for t in known if t >= 0)][:n_trees])
    path = scratch_path(spark, "boost-rows")
    _binned(train, features, target, cuts).withColumn("fitted", F.lit(float(base))).write.parquet(path)
    table, folded = spark.read.parquet(path), 0
    while len(model.trees) < n_trees:
        recent = model.trees[folded:]
        if len(recent) >= FOLD_EVERY:
            table, folded, recent = _folded(table, k, recent, rate), len(model.trees), []
        number = len(model.trees)
        columns = sorted(random.Random(f"{seed}/{number}").sample(range(k), max(1, int(column_share * k))))
        tree = _grown(table, k, recent, rate, columns, depth, l2, cuts)
        _add(spark, ledger, number, json.dumps(tree.__dict__))
        model.trees.append(tree)
    return model


def _grown(table: DataFrame, k: int, recent: list[Tree], rate: float, columns: list[int], depth: int, l2: float, cuts: list[list[float]]) -> Tree:
    size = 2 ** (depth + 1) - 1
    tree, nodes = Tree([-1] * size, [0] * size, [0.0] * size, [0.0] * size), [0]
    for level in range(depth):
        found = _level(table, k, recent, rate, tree, columns, nodes, l2)
        nodes = []
        for r in found:
            i, own = r["node"], cuts[r["feature"]]
            if level == 0:
                tree.value[0] = r["g"] / (r["n"] + l2)
            tree.feature[i], tree.cut[i] = r["feature"], r["cut"]
            # cut 0 parts the missing from all others, and one behind the last cut nothing
            tree.threshold[i] = float("-inf") if r["cut"] == 0 else own[r["cut"] - 1]
            tree.value[2 * i + 1] = r["gl"] / (r["nl"] + l2)
            tree.value[2 * i + 2] = (r["g"] - r["gl"]) / (r["n"] - r["nl"] + l2)
            nodes += [2 * i + 1, 2 * i + 2]
        if not nodes:
            break
    return tree


def _folded(table: DataFrame, k: int, trees: list[Tree], rate: float) -> DataFrame:
    """The table with the sum of ``trees`` in what is fitted."""
    spark, path = table.sparkSession, scratch_path(table.sparkSession, "boost-rows")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for rb in batches:
            _, _, fitted = _read(rb, k, trees, rate)
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(fitted)], names=["bins", "y", "fitted"])

    table.mapInArrow(run, "bins binary, y double, fitted double").write.parquet(path)
    return spark.read.parquet(path)


def _add(spark, ledger: str, number: int, body: str) -> None:
    spark.createDataFrame([(number, body)], "number int, body string").coalesce(1).write.mode("append").parquet(ledger)


def _ledger_rows(spark, ledger: str) -> dict[int, str]:
    """Entries by number (a tree each, -1 the start), whole ones only: an append commits its file or leaves none."""
    from ..sources.sinks import path_exists

    if not path_exists(spark, ledger):
        return {}
    found = {r["number"]: r["body"] for r in spark.read.schema("number int, body string").parquet(ledger).collect()}
    whole = {}
    for number in range(-1, len(found)):  # a gap ends it
        if number not in found:
            break
        whole[number] = found[number]
    return whole
