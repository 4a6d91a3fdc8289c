"""Ranking, position and cumulative operators.

Ties in the reference are broken by row position (``rank(method="first")``). Spark rows have no
position, so every rank takes explicit tie-break columns that together with the ranked column are
unique.

Skew: an era may hold a third of all rows, so a ``Window.partitionBy(era)`` (one task per era) is
only used when a size check proves every group small. ``strategy="auto"`` (the default) first runs
one column-pruned aggregation (row count per group, map-side combined, one number returned) and
takes the window plan -- one exchange on the group keys plus a sort, shared by every rank over the
same groups -- when the largest group, rows times row width, is at most ``spark.erascore.rank.maxGroupBytes``
(default 128 MB). A rank without groups always takes the range plan, at any size.

The range plan carries only what orders the rows: ``(group, value, tiebreak)`` is range-partitioned, which
splits a hot era over many tasks, rows are numbered inside each partition with ``monotonically_increasing_id``
(partition index in the high bits, position in the low 33 bits), and per-(partition, group) offsets from a
small count table are added. A few narrow columns ride along; a wide payload comes back by a join on (group,
tiebreak), which must be unique together, as every tie-break has to be. The offset table has at most ``partitions + groups`` rows; it is
counted before it is broadcast (``sizing.bounded_broadcast``), with a shuffled join beyond the limit.

The numbered keys are read twice (for the counts and for the join), so they are materialized once:
two separate range shuffles would each draw their own sample (the sample seed depends on the RDD
id) and split rows differently. By default they are persisted (memory and disk); recomputing a lost
block reuses the same range partitioner and the unique sort key, so the numbering is identical.
``materialize="checkpoint"`` writes them to the shared checkpoint folder instead, which also cuts
the lineage and does not depend on the cache: use it when the session's cache may be cleared
between building the result and running it (both branches must read the same numbered rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions
from .sizing import bounded_broadcast, keep, row_bytes

MAX_GROUP_BYTES_CONF = "spark.erascore.rank.maxGroupBytes"
DEFAULT_MAX_GROUP_BYTES = 128 << 20
CARRIED_BYTES = 160  # a payload up to here is range-partitioned with its keys
_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _orders(group_cols: Sequence[str], value_cols: Sequence[str], tiebreak: Sequence[str],
            descending: bool) -> list[Column]:
    out = [F.col(g).asc_nulls_last() for g in group_cols]
    for v in value_cols:
        out.append(F.col(v).desc_nulls_last() if descending else F.col(v).asc_nulls_last())
    out += [F.col(t).asc_nulls_last() for t in tiebreak]
    return out


_GROUP_STATS: dict = {}


def group_stats(df: DataFrame, group_cols: Sequence[str]) -> tuple[int, int]:
    """(rows of the largest group, number of groups): one partial aggregation over the group columns
    only. Remembered per input plan -- the values steer plan choices (window or range plan, broadcast
    or shuffle), never results, so a stale entry after the data changed only costs speed."""
    narrow = df.select(*group_cols) if group_cols else df
    # the whole plan's text beside its hash: equal hashes alone must not steer another plan
    key = (df.sparkSession._jsparkSession.sessionUUID(), narrow.semanticHash(), str(narrow.schema), tuple(group_cols))
    if key not in _GROUP_STATS:
        if not group_cols:
            _GROUP_STATS[key] = (df.count(), 1)
        else:
            row = df.groupBy(*group_cols).count().agg(F.max("count"), F.count(F.lit(1))).first()
            _GROUP_STATS[key] = (int(row[0] or 0), int(row[1] or 0))
    return _GROUP_STATS[key]


def clear_group_stats() -> None:
    _GROUP_STATS.clear()


def largest_group(df: DataFrame, group_cols: Sequence[str]) -> int:
    return group_stats(df, group_cols)[0]


def choose_strategy(df: DataFrame, group_cols: Sequence[str]) -> str:
    """``window`` when the largest group's bytes fit one task, else ``range``; always ``range`` without groups."""
    if not group_cols:
        return "range"
    limit = int(df.sparkSession.conf.get(MAX_GROUP_BYTES_CONF, str(DEFAULT_MAX_GROUP_BYTES)))
    return "window" if largest_group(df, group_cols) * row_bytes(df.schema) <= limit else "range"


def group_row_number(df: DataFrame, group_cols: Sequence[str], value_col: str, tiebreak: Sequence[str],
                     out: str = "rn", descending: bool = False, num_partitions: int | None = None,
                     strategy: str = "auto", materialize: str = "persist") -> DataFrame:
    """1-based row number of ``value_col`` (NULLs last, ties by ``tiebreak``) within each group.

    Also adds ``<out>_n`` (rows in the group) and ``<out>_nvalid`` (non-NULL ``value_col`` in the group).
    ``strategy="window"`` is the single-task-per-group window form, kept for cross-checks and for
    callers that know their groups are small.
    """
    group_cols, tiebreak = list(group_cols), list(tiebreak)
    if strategy == "auto":  # on the caller's plan, so the cached group statistics are found
        strategy = choose_strategy(df, group_cols)
    if isinstance(df.schema[value_col].dataType, (T.FloatType, T.DoubleType)):
        # NaN is a missing value (pandas), not the largest number (Spark): rank it as NULL
        df = df.withColumn(value_col, F.when(~F.isnan(value_col), F.col(value_col)))
    orders = _orders(group_cols, [value_col], tiebreak, descending)
    n_col, nv_col = f"{out}_n", f"{out}_nvalid"
    if strategy == "window":
        w_order = Window.partitionBy(*group_cols).orderBy(*orders[len(group_cols):])
        w_all = Window.partitionBy(*group_cols)
        return (df.withColumn(out, F.row_number().over(w_order).cast("long"))
                  .withColumn(n_col, F.count(F.lit(1)).over(w_all))
                  .withColumn(nv_col, F.count(F.col(value_col)).over(w_all)))
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")

    needed = list(dict.fromkeys([*group_cols, value_col, *tiebreak]))
    extra = T.StructType([f for f in df.schema.fields if f.name not in needed])
    if extra.fields and row_bytes(extra) > CARRIED_BYTES:
        unique = list(dict.fromkeys([*group_cols, *tiebreak]))
        numbered = group_row_number(df.select(*needed), group_cols, value_col, tiebreak, out, descending, num_partitions,
                                    "range", materialize).select(*unique, out, n_col, nv_col)
        same = None
        for u in unique:
            each = F.col(f"d.{u}").eqNullSafe(F.col(f"n.{u}"))
            same = each if same is None else same & each
        if same is not None:
            return df.alias("d").join(numbered.alias("n"), same).select(
                *[F.col(f"d.{c}") for c in df.columns], *[F.col(f"n.{c}") for c in (out, n_col, nv_col)])
    n = num_partitions or shuffle_partitions(df.sparkSession)
    staged = (df.repartitionByRange(n, *orders)
                .sortWithinPartitions(*orders)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
                .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK))))
    if materialize == "checkpoint":
        staged = staged.checkpoint(eager=True)
    else:
        staged = keep(staged)
    counts = staged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.count(F.col(value_col)).alias("_cntv"),
        F.min("_pos").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    offsets = counts.select(
        "_pid", *group_cols, "_first",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(whole).alias(n_col),
        F.sum("_cntv").over(whole).alias(nv_col))
    cond = F.col("s._pid") == F.col("o._pid")
    for g in group_cols:
        cond = cond & F.col(f"s.{g}").eqNullSafe(F.col(f"o.{g}"))
    # at most partitions + groups rows; broadcast after a size check (a shuffled join beyond it)
    joined = staged.alias("s").join(bounded_broadcast(offsets).alias("o"), cond, "inner")
    carried = [F.col(f"s.{c}") for c in df.columns]
    return joined.select(
        *carried,
        (F.col("o._off") + F.col("s._pos") - F.col("o._first") + 1).alias(out),
        F.col(f"o.{n_col}").alias(n_col),
        F.col(f"o.{nv_col}").alias(nv_col))


def rows_at(df: DataFrame, order_cols: Sequence[str], ranks: Sequence[int]) -> dict[int, tuple]:
    """The ``order_cols`` of the rows at some 1-based ranks of the order (NULL and, in the first column, NaN last).
    Only the ordering columns are moved; one row per rank reaches the driver."""
    order_cols = list(order_cols)
    ranked = group_row_number(df.select(*order_cols), [], order_cols[0], order_cols[1:], out="_at", strategy="range")
    return {r["_at"]: tuple(r[c] for c in order_cols) for r in ranked.where(F.col("_at").isin(list(ranks))).collect()}


def up_to(cols: Sequence[Column], row: Sequence) -> Column:
    """Whether a row comes at or before ``row`` in the order of ``cols``, NULL last: a filter without a shuffle."""
    out = F.lit(True)
    for c, v in reversed(list(zip(cols, row, strict=True))):
        if v is None:
            out = c.isNotNull() | (c.isNull() & out)
        else:
            out = F.coalesce(c < F.lit(v), F.lit(False)) | (c.eqNullSafe(F.lit(v)) & out)
    return out


def rank_pct_first(df: DataFrame, value_col: str, group_cols: Sequence[str], tiebreak: Sequence[str],
                   out: str = "rank_pct", **kw) -> DataFrame:
    """Pandas ``rank(pct=True, method="first")`` per group; NULL stays NULL."""
    tmp = f"_{out}_rn"
    r = group_row_number(df, group_cols, value_col, tiebreak, out=tmp, **kw)
    return r.withColumn(out, F.when(F.col(value_col).isNotNull(),
                                    F.col(tmp) / F.col(f"{tmp}_nvalid"))) \
            .drop(tmp, f"{tmp}_n", f"{tmp}_nvalid")


def unif(df: DataFrame, value_col: str, group_cols: Sequence[str], tiebreak: Sequence[str],
         out: str = "unif", **kw) -> DataFrame:
    """``(rank_first - 0.5) / len`` per group, where len counts missing rows too."""
    tmp = f"_{out}_rn"
    r = group_row_number(df, group_cols, value_col, tiebreak, out=tmp, **kw)
    return r.withColumn(out, F.when(F.col(value_col).isNotNull(),
                                    (F.col(tmp) - F.lit(0.5)) / F.col(f"{tmp}_n"))) \
            .drop(tmp, f"{tmp}_n", f"{tmp}_nvalid")


def row_position(df: DataFrame, order_cols: Sequence[str], out: str = "row_pos", **kw) -> DataFrame:
    """0-based position of each row in ``order_cols`` order, distributed."""
    order_cols = list(order_cols)
    r = group_row_number(df, [], order_cols[0], order_cols[1:], out="_rp", **kw)
    return r.withColumn(out, F.col("_rp") - 1).drop("_rp", "_rp_n", "_rp_nvalid")


def global_rank(df: DataFrame, value_col: str, tiebreak: Sequence[str], out: str = "rank", **kw) -> DataFrame:
    """Ungrouped 1-based position rank without collapsing to one partition."""
    r = group_row_number(df, [], value_col, tiebreak, out="_gr", **kw)
    return r.withColumn(out, F.when(F.col(value_col).isNotNull(), F.col("_gr"))) \
            .drop("_gr", "_gr_n", "_gr_nvalid")


def global_rank_pct(df: DataFrame, value_col: str, tiebreak: Sequence[str], out: str = "rank_pct",
                    **kw) -> DataFrame:
    return rank_pct_first(df, value_col, [], tiebreak, out=out, **kw)


def cumulative_value(per_era: DataFrame, value_col: str, era_col: str = "era", out: str = "cum_value") -> DataFrame:
    """``cumprod(value + 1)`` in era order; missing eras stay missing but keep their place.

    Runs on one row per era (after per-era aggregation), so the unpartitioned window is bounded.
    """
    w = Window.orderBy(era_col).rowsBetween(Window.unboundedPreceding, 0)
    return per_era.withColumn(
        out, F.when(F.col(value_col).isNotNull(), F.product(F.col(value_col) + F.lit(1.0)).over(w)))


def rolling_max(per_era: DataFrame, value_col: str, era_col: str = "era", window: int = 100,
                out: str = "rolling_max") -> DataFrame:
    """Max over the last ``window`` eras (rows), at least one present value."""
    w = Window.orderBy(era_col).rowsBetween(-(window - 1), 0)
    return per_era.withColumn(out, F.max(value_col).over(w))
