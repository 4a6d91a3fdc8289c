"""Filters, samples and splits.

Exact-size splits need a place in a global order, not the order itself: the row at which the split falls is
selected first, then every row is compared with it, so the rows themselves are neither shuffled nor cached. For the
hash order the row is found through histograms of hash prefixes (map-side combined, at most 65,536 rows each); for
other orders by ranking the ordering columns alone. The reference's random choice is unseeded; here the order is a
hash of ``(id, seed)`` so a split is reproducible and a lost task recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ranking

PREFIX = 4  # hex digits by which a histogram of hashes gets finer
FEW_ROWS = 20_000  # of one prefix: few enough to sort


def every_nth_era(df: DataFrame, n: int = 4, era: str = "era") -> DataFrame:
    """keep rows of eras divisible by ``n`` (a pushed-down filter on the era column)."""
    return df.where(F.col(era) % n == 0)


def balance_keep(era: Column, y0: Column, low: float = 0.25, high: float = 0.75, mid: float = 0.5) -> Column:
    """F2 predicate on the first target value, by ``era % 4``:
    0 keep all; 1 drop ``y0 == 0.5`` (a missing value is kept); 2 and 3 keep ``y0 < 0.25 or y0 > 0.75``
    (a missing value is dropped)."""
    r = era % 4
    y0 = F.when(~F.isnan(y0), y0)  # NaN is missing (Spark orders NaN above 0.75)
    return (F.when(r == 0, F.lit(True))
             .when(r == 1, F.coalesce(y0 != F.lit(mid), F.lit(True)))
             .otherwise(F.coalesce((y0 < F.lit(low)) | (y0 > F.lit(high)), F.lit(False))))


def balance_filter(df: DataFrame, era: str = "era", y0: Column | str = "target") -> DataFrame:
    """era-dependent balancing of the training examples."""
    y = F.col(y0) if isinstance(y0, str) else y0
    return df.where(balance_keep(F.col(era), y))


def hash_order(id_col: str, seed: int | str) -> Column:
    """Deterministic pseudo-random order key: md5 of ``id || seed`` (same text in DuckDB)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def _hash_cuts(df: DataFrame, id_col: str, seed: int | str, fractions: Sequence[float]) -> list[Column]:
    """For each fraction a predicate that holds for exactly ``int(fraction * n)`` rows: the first by (hash, id).

    A prefix with many rows is split by further digits; the ids are unique, so at full length a prefix is one id."""
    # a missing id has no hash and comes last
    h = F.coalesce(hash_order(id_col, seed), F.lit("~"))
    keys = df.select(h.alias("_h"), F.col(id_col).alias("_id"))

    def histogram(prefix: str) -> list[tuple[str, int]]:
        part = keys.where(F.col("_h").startswith(prefix)) if prefix else keys
        found = part.groupBy(F.substring("_h", 1, len(prefix) + PREFIX).alias("p")).count().collect()
        return sorted((r["p"], r["count"]) for r in found)

    whole = histogram("")
    n = sum(c for _, c in whole)

    def cut(k: int) -> Column:
        if k <= 0:
            return F.lit(False)
        if k >= n:
            return F.lit(True)
        bins, left = whole, k
        while True:
            for prefix, count in bins:
                if left <= count:
                    break
                left -= count
            if count <= FEW_ROWS or len(prefix) >= 32:
                break
            bins = histogram(prefix)
        part = keys.where(F.col("_h").startswith(prefix)).orderBy("_h", "_id").limit(left)
        at = part.agg(F.max(F.struct("_h", "_id")).alias("at")).first()["at"]
        return ranking.up_to([h, F.col(id_col)], [at["_h"], at["_id"]])

    return [cut(int(n * f)) for f in fractions]


def random_holdout_exact(df: DataFrame, split: float, id_col: str = "id", seed: int = 0,
                         out: str = "dataset", train: str = "train", valid: str = "valid") -> DataFrame:
    """exactly ``int(split * n)`` rows go to ``valid``, chosen by the hash order, the rest ``train``."""
    held, = _hash_cuts(df, id_col, seed, [float(split)])
    return df.withColumn(out, F.when(held, F.lit(valid)).otherwise(F.lit(train)))


def three_way_split(df: DataFrame, train_frac: float, valid_frac: float, id_col: str = "id", seed: int = 0,
                    out: str = "dataset", exact: bool = True) -> DataFrame:
    """train / valid / test fractions (must sum to at most 1).

    exact: counts ``int(train*n)``, ``int(valid*n)`` by the hash order; otherwise each row by its hash alone
    (no job beforehand, sizes approximate, the same rows however the data are partitioned)."""
    if train_frac + valid_frac > 1.0 + 1e-12:
        raise ValueError("train + valid splits must be <= 1.0")
    if not exact:
        u = F.conv(F.substring(hash_order(id_col, seed), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
        return df.withColumn(out, F.when(u < train_frac, "train").when(u < train_frac + valid_frac, "valid")
                             .otherwise("test"))
    n = df.select(id_col).count()
    n_train, n_valid = int(n * float(train_frac)), int(n * float(valid_frac))
    first, both = _hash_cuts(df, id_col, seed, [(n_train + 0.5) / n, (n_train + n_valid + 0.5) / n]) if n else (F.lit(False),) * 2
    return df.withColumn(out, F.when(first, "train").when(both, "valid").otherwise("test"))


def head_tail_split(df: DataFrame, split: float, order_cols: Sequence[str], out: str = "part",
                    head: str = "head", tail: str = "tail") -> DataFrame:
    """the first ``int(n * split)`` rows in ``order_cols`` order vs the remainder."""
    order_cols = list(order_cols)
    n = df.select(order_cols[0]).count()
    k = int(n * float(split))
    if 0 < k < n:
        cols = [F.col(c) for c in order_cols]
        if isinstance(df.schema[order_cols[0]].dataType, (T.FloatType, T.DoubleType)):
            cols[0] = F.when(~F.isnan(cols[0]), cols[0])
        first = ranking.up_to(cols, ranking.rows_at(df, order_cols, [k])[k])
    else:
        first = F.lit(k >= n)
    return df.withColumn(out, F.when(first, F.lit(head)).otherwise(F.lit(tail)))


def head_holdout(df: DataFrame, split: float, order_cols: Sequence[str], out: str = "dataset") -> DataFrame:
    """the first ``int(split * n)`` rows of the validation file are validation, the rest train
    (the reference's mask marks them the other way round while printing these counts)."""
    return head_tail_split(df, split, order_cols, out=out, head="valid", tail="train")


def no_split(train: DataFrame, valid: DataFrame, out: str = "dataset") -> DataFrame:
    """whole train file -> train, whole validation file -> valid."""
    return (train.withColumn(out, F.lit("train"))
                 .unionByName(valid.withColumn(out, F.lit("valid")), allowMissingColumns=True))


def mask_select(df: DataFrame, mode: str, dataset: str = "dataset") -> DataFrame:
    """rows of one role; the live role takes every row."""
    if mode in ("live", "test"):
        return df
    return df.where(F.col(dataset) == mode)


def era_walk_forward(df: DataFrame, era: str = "era", block: int = 14, steps: int | None = None) -> DataFrame:
    """F8: for step s, train eras [block*s, block*s + block) and validation eras of the next block.

    Each row belongs to the train side of step ``era // block`` and the validation side of step
    ``era // block - 1``, so the assignment is a generator (at most two output rows per input row),
    not a join. Every era takes part; ``steps`` keeps the first so many steps only."""
    s = F.floor(F.col(era) / F.lit(block)).cast("int")
    pairs = F.array(F.struct(s.alias("step"), F.lit("train").alias("role")),
                    F.struct((s - 1).alias("step"), F.lit("valid").alias("role")))
    exploded = df.select("*", F.explode(pairs).alias("_sr")).where(F.col("_sr.step") >= 0)
    if steps is not None:
        exploded = exploded.where(F.col("_sr.step") < steps)
    return exploded.select("*", F.col("_sr.step").alias("step"), F.col("_sr.role").alias("role")).drop("_sr")
