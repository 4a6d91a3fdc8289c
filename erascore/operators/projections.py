"""Column selection and example assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def columns_by_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names starting with ``prefix``, in file order."""
    return [c for c in df.columns if c.startswith(prefix)]


def select_by_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *columns_by_prefix(df, prefix))


def contiguous_range(df: DataFrame, prefix: str) -> list[str]:
    """Every column from the first to the last one matching ``prefix`` (foreign columns in
    between included). The reference skips a match at index 0; that is not reproduced."""
    idx = [i for i, c in enumerate(df.columns) if c.startswith(prefix)]
    if not idx:
        return []
    return df.columns[idx[0]:idx[-1] + 1]


def feature_order(sets: DataFrame, all_features: Sequence[str]) -> DataFrame:
    """``(feature, position)``: trait 1 features first, then trait 2 features not yet placed, ...,
    then the features of no trait in file order.

    ``sets`` has rows ``(trait_ord, pos, feature)``. Only names present in ``all_features`` count.
    The frame is metadata-sized (features x traits)."""
    spark = sets.sparkSession
    names = spark.createDataFrame([(f, i) for i, f in enumerate(all_features)], "feature string, file_pos int")
    first = sets.groupBy("feature").agg(F.min(F.struct("trait_ord", "pos")).alias("_first"))
    placed = names.join(first, "feature", "left")
    key = F.struct(F.coalesce(F.col("_first.trait_ord"), F.lit(1 << 30)).alias("t"),
                   F.coalesce(F.col("_first.pos"), F.col("file_pos")).alias("p"))
    w = Window.orderBy(key)  # metadata-sized (one row per feature column)
    return placed.select("feature", (F.row_number().over(w) - 1).alias("position"))


def ordered_features(sets: DataFrame, all_features: Sequence[str]) -> list[str]:
    """P3 as a name list for ``select`` (metadata, one row per feature column)."""
    rows = feature_order(sets, all_features).orderBy("position").collect()
    return [r["feature"] for r in rows]


def assemble_xy(df: DataFrame, features: Sequence[str], targets: Sequence[str],
                keep: Sequence[str] = ("id", "era")) -> DataFrame:
    """Feature columns -> ``x array<float>``, target columns -> ``y array<float>``."""
    x = F.array(*[F.col(c).cast("float") for c in features])
    y = F.array(*[F.col(c).cast("float") for c in targets])
    return df.select(*keep, x.alias("x"), y.alias("y"))


def live_targets_zero(n_targets: int) -> Column:
    """P5: all-zero ``y`` of the given width for live rows."""
    return F.array_repeat(F.lit(0.0).cast("float"), n_targets)


def era_number(era) -> Column:
    """Era text -> integer; ``X`` (live) and anything non-numeric -> 0."""
    e = F.col(era) if isinstance(era, str) else era
    return F.coalesce(e.try_cast("bigint"), F.lit(0).cast("bigint"))


def pick_target(y, idx: int) -> Column:
    """Target by 0-based index of ``y`` (NULL when out of range)."""
    yy = F.col(y) if isinstance(y, str) else y
    return F.try_element_at(yy, F.lit(idx + 1))


def xy_matrices(df: DataFrame, features: Sequence[str], target: str = "target",
                keep: Sequence[str] = ("id",)) -> DataFrame:
    """``x`` = feature vector, ``y`` = the target column."""
    return df.select(*keep, F.array(*[F.col(c) for c in features]).alias("x"), F.col(target).alias("y"))


def fill_missing_const(df: DataFrame, columns: Sequence[str], value: float = 0.5) -> DataFrame:
    """NULL and NaN in the given columns -> ``value``."""
    cols = set(columns)
    out = []
    for f in df.schema.fields:
        if f.name in cols:
            c = F.col(f.name)
            out.append(F.when(c.isNull() | F.isnan(c), F.lit(value)).otherwise(c).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def autoencoder_pair(x: str = "x", y: str = "y") -> Column:
    """P10: the label of a reconstruction model is the pair (x, y)."""
    return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
