"""Segmented scans: running products and sliding maxima of many series at once, each of any length.

A series is named by its group columns and ordered by one column without repeats. Its rows are numbered without bringing a series into
one task (``ranking``), and the numbers cut it into blocks. Within a block an ordinary window does the work; between
blocks only one row each is carried:

* a running product is that of the block's rows times the product of the blocks before;
* the maximum of the last w rows, with blocks of w, is that of the block so far and that of the block before from w - 1 rows back:
  a prefix maximum and a suffix maximum, met by an equi-join on the position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranking

BLOCK = 100_000  # rows of a running product's block


def _numbered(df: DataFrame, groups: Sequence[str], order: str, **kw) -> DataFrame:
    """``df`` with ``_pos``, the 0-based position in its series."""
    numbered = ranking.group_row_number(df, list(groups), order, [], out="_no", **kw)
    return numbered.withColumn("_pos", F.col("_no") - 1).drop("_no", "_no_n", "_no_nvalid")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def cumulative_values(df: DataFrame, value: str, groups: Sequence[str], order: str = "era", out: str = "cum_value", block: int = BLOCK, **kw) -> DataFrame:
    """W5 for every series: the product of ``value + 1`` up to each row; rows with a missing value stay missing but keep their
    place. A null order comes last; with no groups the table is one series."""
    groups = list(groups)
    rows = _numbered(df, groups, order, **kw).withColumn("_block", F.floor(F.col("_pos") / F.lit(block)).cast("long"))
    factor = F.col(value).cast("double") + F.lit(1.0)
    own = Window.partitionBy(*groups, "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.product(factor).over(own))
    sums = rows.groupBy(*groups, "_block").agg(F.product(factor).alias("_p"))  # a row for each block
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_g{i}" for i in range(len(groups))]
    carried = sums.select(*[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)], F.col("_block").alias("_of"),
                          F.coalesce(F.product("_p").over(before), F.lit(1.0)).alias("_carry"))
    joined = rows.join(carried, _same([*groups, "_block"], [*names, "_of"]), "left")
    result = F.when(F.col(value).isNotNull(), F.col("_own") * F.col("_carry")).alias(out)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out], result)


def rolling_maxima(df: DataFrame, value: str, groups: Sequence[str], order: str = "era", window: int = 100, out: str = "rolling_max", **kw) -> DataFrame:
    """W6 for every series: the maximum of the last ``window`` rows, missing only where all of them are. No task holds more than
    ``window`` rows of a series together."""
    groups = list(groups)
    rows = _numbered(df, groups, order, **kw).withColumn("_block", F.floor(F.col("_pos") / F.lit(window)).cast("long"))
    of_block = Window.partitionBy(*groups, "_block").orderBy("_pos")
    rows = rows.withColumn("_upto", F.max(value).over(of_block.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_from", F.max(value).over(of_block.rowsBetween(0, Window.unboundedFollowing)))
    names = [f"_g{i}" for i in range(len(groups))]
    # the rest of the block before, seen from the row that comes window - 1 later; a block's first row stands alone on its own block
    rest = rows.where(F.col("_pos") % window != 0).select(
        *[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)], (F.col("_pos") + (window - 1)).alias("_at"), F.col("_from").alias("_rest"))
    joined = rows.join(rest, _same([*groups, "_pos"], [*names, "_at"]), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.greatest("_upto", "_rest").alias(out))


def drawdowns(per_era: DataFrame, groups: Sequence[str], corr: str = "corr", era: str = "era", window: int = 100, **kw) -> DataFrame:
    """A6 for every series: the largest fall of the cumulative value below its maximum of the last ``window`` eras, as a share of it."""
    from ..functions.stats import safe_ratio

    groups = list(groups)
    value = cumulative_values(per_era.select(*groups, era, corr), corr, groups, era, out="_value", **kw)
    top = rolling_maxima(value, "_value", groups, era, window, out="_top", **kw)
    return top.groupBy(*groups).agg((-F.max(safe_ratio(F.col("_top") - F.col("_value"), F.col("_top")))).alias("max_drawdown"))
