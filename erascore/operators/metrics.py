"""Era-grouped evaluation metrics.

Every per-era metric is an algebraic aggregate (moment sums) on top of a distributed per-era rank,
so Spark combines partially on the map side and a hot era never lands in one task. The per-era
result has one row per era; the summary statistics over it (mean, std, Sharpe, drawdown) run on
that tiny frame.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import corr_pairwise, corr_strict, mean_strict, present, safe_ratio, std_pop_strict
from . import ranking

# Fixed values from the reference's metric definitions.
PAYOUT_CLIP = 0.25
MMC_SCALE = 0.29 ** 2
DRAWDOWN_WINDOW = 100


def _tb(tiebreak) -> list[str]:
    return [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)


def ranked_for_corr(df: DataFrame, pred: str = "prediction", era: str | None = "era",
                    tiebreak: Sequence[str] | str = ("row_idx",), out: str = "pred_rank", **kw) -> DataFrame:
    groups = [era] if era else []
    return ranking.rank_pct_first(df, pred, groups, _tb(tiebreak), out=out, **kw)


def era_corr(df: DataFrame, pred: str = "prediction", target: str = "target", era: str = "era",
             tiebreak: Sequence[str] | str = ("row_idx",), out: str = "corr", **kw) -> DataFrame:
    """A3 (A1 per era): Pearson(rank_pct_first(pred), target); any missing value -> NULL."""
    kw = with_strategy(df, [era], kw)
    cols = [era, pred, target] + _tb(tiebreak)
    r = ranked_for_corr(df.select(*dict.fromkeys(cols)), pred, era, tiebreak, out="_r", **kw)
    return r.groupBy(era).agg(corr_strict("_r", target).alias(out))


def rank_corr(df: DataFrame, pred: str = "prediction", target: str = "target",
              tiebreak: Sequence[str] | str = ("row_idx",), out: str = "corr", **kw) -> DataFrame:
    """A1/A2: the same correlation over all rows (global distributed rank), one row."""
    kw = with_strategy(df, [], kw)
    cols = [pred, target] + _tb(tiebreak)
    r = ranked_for_corr(df.select(*dict.fromkeys(cols)), pred, None, tiebreak, out="_r", **kw)
    return r.agg(corr_strict("_r", target).alias(out))


def corr_report_aggs(corr: str = "corr", bound: float = PAYOUT_CLIP) -> list[Column]:
    c = F.col(corr)
    return [F.avg(c).alias("corr_mean"), F.stddev_pop(c).alias("corr_std"),
            safe_ratio(F.avg(c), F.stddev_pop(c)).alias("sharpe"), F.avg(clip_payout(c, bound)).alias("payout")]


def corr_report(per_era: DataFrame, corr: str = "corr", bound: float = PAYOUT_CLIP) -> DataFrame:
    """A4 + A5 in one aggregation: corr_mean, corr_std, sharpe, payout."""
    return per_era.agg(*corr_report_aggs(corr, bound))


def corr_summary(per_era: DataFrame, corr: str = "corr", prefix: str = "corr") -> DataFrame:
    """A4: mean, population std and Sharpe over eras; missing eras skipped."""
    return per_era.agg(
        F.avg(corr).alias(f"{prefix}_mean"),  # per-era values are NULL (never NaN) when missing
        F.stddev_pop(corr).alias(f"{prefix}_std"),
        safe_ratio(F.avg(corr), F.stddev_pop(corr)).alias("sharpe"))


def clip_payout(c: Column, bound: float = PAYOUT_CLIP) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(bound)), F.lit(-bound)))


def payout(per_era: DataFrame, corr: str = "corr", bound: float = PAYOUT_CLIP) -> DataFrame:
    """A5: mean of the per-era correlation clipped to +/-bound (NULL eras skipped, not clipped)."""
    return per_era.agg(F.avg(clip_payout(F.col(corr), bound)).alias("payout"))


def max_drawdown(per_era: DataFrame, corr: str = "corr", era: str = "era",
                 window: int = DRAWDOWN_WINDOW) -> DataFrame:
    """-max((rolling_max - value) / rolling_max) of the cumulative value ``cumprod(corr + 1)``."""
    v = ranking.cumulative_value(per_era.select(era, corr), corr, era, out="_value")
    v = ranking.rolling_max(v, "_value", era, window, out="_rmax")
    return v.agg((-F.max(safe_ratio(F.col("_rmax") - F.col("_value"), F.col("_rmax")))).alias("max_drawdown"))


def _stack(features: Sequence[str], name_col: str = "feature", value_col: str = "fvalue") -> Column:
    """(feature name, value) pairs as an array of structs, for a codegen'd generate + partial agg."""
    return F.explode(F.array(*[F.struct(F.lit(f).alias(name_col), F.col(f).cast("double").alias(value_col))
                              for f in features])).alias("_kv")


def long_features(df: DataFrame, keep: Sequence[str], features: Sequence[str] | str) -> DataFrame:
    """``(keep..., feature, fvalue)`` rows. ``features`` is a list of columns, or the name of one
    ``array`` column holding the whole feature vector (wide data: the feature is its position)."""
    if isinstance(features, str):
        return (df.select(*keep, F.posexplode(features).alias("_pos", "_v"))
                  .select(*keep, F.format_string("%s[%d]", F.lit(features), F.col("_pos")).alias("feature"),
                          F.col("_v").cast("double").alias("fvalue")))
    return (df.select(*keep, _stack(features))
              .select(*keep, F.col("_kv.feature").alias("feature"), F.col("_kv.fvalue").alias("fvalue")))


def _feature_cols(features: Sequence[str] | str) -> list[str]:
    return [features] if isinstance(features, str) else list(features)


def feature_exposure(df: DataFrame, features: Sequence[str] | str, pred: str = "prediction",
                     tiebreak: Sequence[str] | str = ("row_idx",), method: str = "auto", **kw) -> DataFrame:
    """Per feature, Pearson(global rank_pct(pred), feature) over the whole set; any missing
    value of the feature or the prediction -> no exposure. Wide inputs (vectors, more than
    ``WIDE_FEATURES`` columns) use the Arrow moment path."""
    kw = with_strategy(df, [], kw)
    cols = [pred, *_feature_cols(features)] + _tb(tiebreak)
    r = ranked_for_corr(df.select(*dict.fromkeys(cols)), pred, None, tiebreak, out="_r", **kw)
    if method == "auto":
        method = "arrow" if isinstance(features, str) or len(features) > WIDE_FEATURES else "explode"
    if method == "explode":
        return (long_features(r, ["_r"], features)
                .groupBy("feature").agg(corr_strict("_r", "fvalue").alias("exposure")))
    m = _feature_moments_arrow(r.withColumn("_all", F.lit(0)), features, "_r", "_all")
    strict = F.when((F.col("n") == F.col("rows")) & (F.col("n") > 0), F.col("corr"))
    return m.select(_feature_name(features).alias("feature"), strict.alias("exposure"))


WIDE_FEATURES = 32  # above it Arrow batches are faster than exploded rows; both give the same values
_HELD_VALUES = 4_000_000  # numbers that a task holds before it hands its partial moments on
_MOMENTS = ("rows", "n", "mx", "mp", "cxx", "cpp", "cxp", "lx", "hx", "lp", "hp")


def _feature_moments_arrow(df: DataFrame, features: Sequence[str] | str, pred: str, era: str) -> DataFrame:
    """Per (era, feature) ``rows``, ``n`` and ``corr`` over rows where both the feature and the prediction
    are present (``_era``, ``j``: the feature's place).

    Each Arrow batch is reduced to centred moments (means, sums of squares about them, smallest and largest
    values) of each era in it, merged within the task by the pairwise formula and handed on when the task holds
    too many. Spark then merges the tasks' moments about their common mean, so an offset of any size costs no
    digits; a constant is told by smallest = largest."""
    names = [features] if isinstance(features, str) else list(features)
    x = F.col(features).cast("array<double>") if isinstance(features, str) else \
        F.array(*[F.col(c).cast("double") for c in names])
    packed = df.select(F.col(era).alias("_era"), F.col(pred).cast("double").alias("_p"), x.alias("_x"))
    era_type = df.schema[era].dataType
    schema = T.StructType([T.StructField("_era", era_type), T.StructField("j", T.IntegerType())] +
                          [T.StructField(m, T.DoubleType()) for m in _MOMENTS])

    def matrix(lst, n: int) -> np.ndarray:
        import pyarrow.compute as pc
        lens = pc.list_value_length(lst).to_numpy(zero_copy_only=False)
        width = max(1, int(np.nanmax(lens))) if n and lst.null_count < n else 1
        if lst.null_count == 0 and n and (lens == width).all():
            return lst.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, width)
        mat = np.full((n, width), np.nan)  # ragged or missing vectors: pad with NaN (= missing)
        for i, v in enumerate(lst.to_pylist()):
            if v is not None:
                mat[i, :len(v)] = [np.nan if e is None else e for e in v]
        return mat

    def of_rows(mat: np.ndarray, p: np.ndarray) -> dict:
        ok = ~np.isnan(mat) & ~np.isnan(p)[:, None]
        n = ok.sum(0).astype(np.float64)
        div = np.maximum(n, 1.0)
        both = np.broadcast_to(p[:, None], mat.shape)
        mx = np.where(ok, mat, 0.0).sum(0) / div
        mp = np.where(ok, both, 0.0).sum(0) / div
        dx, dp = np.where(ok, mat - mx, 0.0), np.where(ok, both - mp, 0.0)
        return {"rows": np.full(mat.shape[1], float(len(mat))), "n": n, "mx": mx, "mp": mp,
                "cxx": (dx * dx).sum(0), "cpp": (dp * dp).sum(0), "cxp": (dx * dp).sum(0),
                "lx": np.where(ok, mat, np.inf).min(0, initial=np.inf), "hx": np.where(ok, mat, -np.inf).max(0, initial=-np.inf),
                "lp": np.where(ok, both, np.inf).min(0, initial=np.inf), "hp": np.where(ok, both, -np.inf).max(0, initial=-np.inf)}

    def widened(m: dict, width: int) -> dict:
        fill = {"lx": np.inf, "lp": np.inf, "hx": -np.inf, "hp": -np.inf}
        more = width - len(m["n"])
        return m if not more else {k: np.concatenate([v, np.full(more, m["rows"][:1].sum() if k == "rows" else fill.get(k, 0.0))])
                                   for k, v in m.items()}

    def merged(a: dict, b: dict) -> dict:
        width = max(len(a["n"]), len(b["n"]))
        a, b = widened(a, width), widened(b, width)
        n = a["n"] + b["n"]
        share = b["n"] / np.maximum(n, 1.0)
        dx, dp = b["mx"] - a["mx"], b["mp"] - a["mp"]
        w = a["n"] * share
        return {"rows": a["rows"] + b["rows"], "n": n, "mx": a["mx"] + dx * share, "mp": a["mp"] + dp * share,
                "cxx": a["cxx"] + b["cxx"] + dx * dx * w, "cpp": a["cpp"] + b["cpp"] + dp * dp * w, "cxp": a["cxp"] + b["cxp"] + dx * dp * w,
                "lx": np.minimum(a["lx"], b["lx"]), "hx": np.maximum(a["hx"], b["hx"]),
                "lp": np.minimum(a["lp"], b["lp"]), "hp": np.maximum(a["hp"], b["hp"])}

    def moments(batches):
        import pyarrow as pa
        held: dict = {}

        def out(kind):
            for key, m in held.items():
                width = len(m["n"])
                yield pa.RecordBatch.from_pydict({"_era": pa.array([key] * width, type=kind),
                                                  "j": pa.array(np.arange(width, dtype=np.int32)), **{k: m[k] for k in _MOMENTS}})

        kind = None
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            kind = rb.column(0).type
            p = rb.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            mat = matrix(rb.column(2), n)
            places: dict = {}
            for i, key in enumerate(rb.column(0).to_pylist()):
                places.setdefault(key, []).append(i)
            for key, rows in places.items():
                m = of_rows(mat[rows], p[rows])
                held[key] = merged(held[key], m) if key in held else m
            if sum(len(m["n"]) for m in held.values()) * len(_MOMENTS) > _HELD_VALUES:
                yield from out(kind)
                held = {}
        if held:
            yield from out(kind)

    parts = packed.mapInArrow(moments, schema)
    # merged about the mean of all parts: the window and the aggregation share one exchange on (era, feature)
    own = Window.partitionBy("_era", "j")
    total = F.greatest(F.sum("n").over(own), F.lit(1.0))
    parts = parts.withColumn("_mx", F.sum(F.col("n") * F.col("mx")).over(own) / total) \
                 .withColumn("_mp", F.sum(F.col("n") * F.col("mp")).over(own) / total)
    dx, dp = F.col("mx") - F.col("_mx"), F.col("mp") - F.col("_mp")
    sums = parts.groupBy("_era", "j").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("cxx"),
        F.sum(F.col("cpp") + F.col("n") * dp * dp).alias("cpp"), F.sum(F.col("cxp") + F.col("n") * dx * dp).alias("cxp"),
        F.min("lx").alias("lx"), F.max("hx").alias("hx"), F.min("lp").alias("lp"), F.max("hp").alias("hp"))
    differ = (F.col("lx") < F.col("hx")) & (F.col("lp") < F.col("hp"))
    # a vector that is missing or short lacks the feature: the era's rows are those of any feature
    return sums.select("_era", "j", F.max("rows").over(Window.partitionBy("_era")).alias("rows"), "n",
                       F.when(differ, safe_ratio(F.col("cxp"), F.sqrt(F.col("cxx")) * F.sqrt(F.col("cpp")))).alias("corr"))


def era_feature_exposure(df: DataFrame, features: Sequence[str] | str, pred: str = "prediction",
                         era: str = "era", method: str = "auto") -> DataFrame:
    """Per (era, feature): |Pearson(feature, raw pred)| with pairwise missing-value drop.

    ``method``: ``explode`` stacks (feature, value) pairs into the aggregation pipeline (JVM,
    codegen'd); ``arrow`` reduces Arrow batches to moment vectors with NumPy (wide feature sets:
    array columns or more than ``WIDE_FEATURES`` columns); ``auto`` chooses by width."""
    if method == "auto":
        method = "arrow" if isinstance(features, str) or len(features) > WIDE_FEATURES else "explode"
    if method == "explode":
        return (long_features(df.select(era, pred, *_feature_cols(features)), [era, pred], features)
                .groupBy(era, "feature").agg(F.abs(corr_pairwise("fvalue", pred)).alias("abs_exposure")))
    m = _feature_moments_arrow(df, features, pred, era)
    corr = F.abs(F.col("corr"))
    return m.select(F.col("_era").alias(era), _feature_name(features).alias("feature"), corr.alias("abs_exposure"))


def _feature_name(features: Sequence[str] | str) -> Column:
    if isinstance(features, str):
        return F.format_string("%s[%d]", F.lit(features), F.col("j"))
    return F.element_at(F.array(*[F.lit(n) for n in features]), F.col("j") + 1)


def max_feature_exposure(df: DataFrame, features: Sequence[str] | str, pred: str = "prediction",
                         era: str = "era", method: str = "auto") -> DataFrame:
    """Mean over eras of the max over features of |corr(feature, pred)|."""
    per = era_feature_exposure(df, features, pred, era, method)
    per_era = per.groupBy(era).agg(F.max("abs_exposure").alias("max_exposure"))
    return per_era.agg(F.avg("max_exposure").alias("max_feature_exposure"))


def with_strategy(df: DataFrame, groups: Sequence[str], kw: dict) -> dict:
    """Decide the rank plan once for an operator that ranks several times over the same groups."""
    if kw.get("strategy", "auto") == "auto":
        kw = dict(kw, strategy=ranking.choose_strategy(df, groups))
    return kw


def unif_pair(df: DataFrame, pred: str, example: str, era: str, tiebreak, **kw) -> DataFrame:
    """Both uniform scores (W2) per era: ``u`` for the prediction and ``v`` for the example."""
    tb = _tb(tiebreak)
    kw = with_strategy(df, [era], kw)
    u = ranking.unif(df, pred, [era], tb, out="u", **kw)
    return ranking.unif(u, example, [era], tb, out="v", **kw)


def mmc_per_era(df: DataFrame, pred: str = "prediction", example: str = "example_preds",
                target: str = "target", era: str = "era", tiebreak: Sequence[str] | str = ("row_idx",),
                **kw) -> DataFrame:
    """A10/A12/A13 per era in one aggregation.

    mmc: residual of unif(pred) on [unif(example), 1] by least squares, ``cov(residual, target)``
    (ddof 1) / 0.29^2, in closed form ``(cov(u,t) - slope(u~v) * cov(v,t)) / 0.0841``.
    corr: Pearson(rank_pct(unif(pred)), target) -- the same order as the raw prediction.
    corr_example: Pearson of the two uniform scores.
    """
    kw = with_strategy(df, [era], kw)
    cols = [era, pred, example, target] + _tb(tiebreak)
    uv = unif_pair(df.select(*dict.fromkeys(cols)), pred, example, era, tiebreak, **kw)
    slope = safe_ratio(F.covar_pop("u", "v"), F.var_pop("v"))
    mmc = (F.covar_samp("u", target) - slope * F.covar_samp("v", target)) / F.lit(MMC_SCALE)
    n = F.count(F.lit(1))
    complete = (n == F.count("u")) & (n == F.count("v")) & (n == F.count(F.when(present(target), 1)))
    return uv.groupBy(era).agg(
        F.when(complete, mmc).alias("mmc"),
        corr_strict("u", target).alias("corr"),
        corr_strict("u", "v").alias("corr_example"))


def mmc_summary(per_era: DataFrame) -> DataFrame:
    """A10-A12 summary from the per-era frame of ``mmc_per_era``: NumPy mean/std (missing values
    propagate) of mmc and corr + mmc, and the difference of the corr + mmc Sharpe to the correlation
    Sharpe (which skips missing eras, like pandas)."""
    return per_era.agg(*mmc_summary_aggs())


def mmc_summary_aggs() -> list[Column]:
    cpm = F.col("corr") + F.col("mmc")
    cps = safe_ratio(mean_strict(cpm), std_pop_strict(cpm))
    sharpe = safe_ratio(F.avg("corr"), F.stddev_pop("corr"))
    return [mean_strict("mmc").alias("mmc_mean"),
            safe_ratio(mean_strict("mmc"), std_pop_strict("mmc")).alias("mmc_sharpe"),
            mean_strict(cpm).alias("corr_plus_mmc_mean"),
            cps.alias("corr_plus_mmc_sharpe"),
            (cps - sharpe).alias("corr_plus_mmc_diff")]


def corr_with_example(per_era: DataFrame) -> DataFrame:
    """Mean over eras of the uniform-score correlation with the example predictions."""
    return per_era.agg(F.avg("corr_example").alias("corr_with_example"))


def dataset_counts(df: DataFrame, dataset: str = "dataset", era: str = "era",
                   feature_prefix: str = "feature", target_prefix: str = "target") -> DataFrame:
    """Rows, feature and target column counts and the true distinct era count per role."""
    n_feat = sum(1 for c in df.columns if c.startswith(feature_prefix))
    n_targ = sum(1 for c in df.columns if c.startswith(target_prefix))
    return df.groupBy(dataset).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(n_feat).cast("int").alias("n_features"),
        F.lit(n_targ).cast("int").alias("n_targets"),
        F.countDistinct(era).alias("n_eras"))


def decile_histogram(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Count of predictions per 0.d bucket (d = 0..9) plus the 1.0 bucket, and one bucket each for values
    below 0 (-1) and missing ones (11), so the counts add up to the rows; empty buckets show 0.

    The bucket list is a 13-row literal range joined by broadcast (fixed size)."""
    spark = df.sparkSession
    p = F.col(pred)
    bucket = (F.when(~present(p), F.lit(11)).when(p < 0, F.lit(-1))
               .otherwise(F.least(F.floor(p * F.lit(10.0)), F.lit(10))).cast("int"))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    buckets = spark.range(-1, 12).select(F.col("id").cast("int").alias("bucket"))
    label = (F.when(F.col("bucket") == 11, F.lit("missing")).when(F.col("bucket") == -1, F.lit("below"))
              .when(F.col("bucket") == 10, F.lit("100")).otherwise(F.concat(F.col("bucket").cast("string"), F.lit("0"))))
    return (F.broadcast(buckets).join(counts, "bucket", "left")
            .select("bucket", label.alias("label"), F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def loss_metrics(df: DataFrame, y: str, p: str, input_loss: Column | None = None,
                 epsilon: float = 0.0, group_cols: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE and the weighted loss ``1.0 * target_loss + epsilon * input_loss`` (MAE based)."""
    mae = F.avg(F.abs(F.col(y) - F.col(p)))
    mse = F.avg(F.pow(F.col(y) - F.col(p), 2))
    aggs = [mae.alias("mae"), mse.alias("mse")]
    if input_loss is not None:
        aggs.append((mae + F.lit(epsilon) * F.avg(input_loss)).alias("weighted_loss"))
    return df.groupBy(*group_cols).agg(*aggs)


def class_accuracy(df: DataFrame, y_class: str, scores: str) -> DataFrame:
    """Share of rows whose arg-max class equals the label class."""
    argmax = F.array_position(F.col(scores), F.array_max(F.col(scores))) - 1
    return df.agg(F.avg((argmax == F.col(y_class)).cast("int")).alias("accuracy"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], tiebreak: Sequence[str] = (),
                    extra_aggs: Sequence[Column] = (), **kw) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``) without collecting a
    group: the non-missing values get a distributed global rank, and one aggregation picks the values
    at the two neighbouring ranks of each requested position (conditional aggregates) and
    interpolates. Columns ``q0, q1, ...`` in the order of ``probs`` plus ``extra_aggs``."""
    ranked = ranking.group_row_number(df.select(value, *tiebreak).where(present(value)),
                                      [], value, list(tiebreak), out="_q", **kw)
    pos0 = F.col("_q") - 1
    n1 = F.col("_q_n") - 1
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * n1
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when(pos0 == lo, F.col(value))).alias(f"_lo{i}"),
                 F.max(F.when(pos0 == hi, F.col(value))).alias(f"_hi{i}"),
                 F.max(F.when(pos0 == lo, pos - lo)).alias(f"_fr{i}")]
    out = ranked.agg(*aggs, *extra_aggs)
    qs = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(f"q{i}")
          for i in range(len(probs))]
    return out.select(*qs, *[F.col(c) for c in out.columns if not c.startswith("_")])


def describe_predictions(df: DataFrame, pred: str = "prediction", tiebreak: Sequence[str] = (),
                         **kw) -> DataFrame:
    """Count, mean, sample std, min, quartiles (exact, interpolated), max of the predictions --
    one rank pass and one aggregation (missing predictions are not counted, as in pandas)."""
    c = F.col(pred)
    extra = [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
             F.min(c).alias("min"), F.max(c).alias("max")]
    q = exact_quantiles(df, pred, [0.25, 0.5, 0.75], tiebreak, extra_aggs=extra, **kw)
    return q.select("count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
                    F.col("q2").alias("p75"), "max")
