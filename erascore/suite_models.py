"""Query registrations: model fitting / scoring and the round stream.

Least-squares regression has an exact oracle (normal equations solved by Cramer's rule in SQL), a single
tree of depth one is checked against the best cut in SQL, networks against the same pass written in SQL.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import sqlgen
from .operators import boosting, joins, leastsquares, models
from .session import scratch_path
from .sources.fixtures import FEATURES, tourney, with_views
from .sources.tables import read_table
from .streaming import rounds
from .suite import r6, register, rounded, sql_corr_strict, sql_rank_pct

TR = "dataset = 'train'"


def _train(spark, sf) -> DataFrame:
    return tourney(spark, sf).where(F.col("dataset") == "train")


def _valid(spark, sf) -> DataFrame:
    return tourney(spark, sf).where(F.col("dataset") == "valid")


_OLS_COLS = FEATURES + ["1e0"]
_OLS_FIT = f"""
g AS (SELECT {sqlgen.gram_sums(_OLS_COLS, 'target')} FROM tourney WHERE {TR}),
beta AS (SELECT {sqlgen.cramer_solution(len(_OLS_COLS))} FROM g)"""
_OLS_PRED = " + ".join(f"beta{j} * {c}" for j, c in enumerate(FEATURES)) + f" + beta{len(FEATURES)}"


@register("regressor_fit", with_views(f"""WITH {_OLS_FIT}
SELECT id, {r6(_OLS_PRED)} AS prediction FROM tourney, beta WHERE dataset = 'valid'""", "tourney"))
def q_regressor_fit(spark, sf):
    m = models.regressor_fit(_train(spark, sf), FEATURES)
    return rounded(m.transform(_valid(spark, sf)).select("id", F.col(models.SCORE).alias("prediction")))


@register("batch_score", with_views(f"""WITH {_OLS_FIT}
SELECT id, {r6(f'CASE WHEN p < 0 THEN 0 WHEN p > 1 THEN 1 ELSE p END')} AS prediction
FROM (SELECT id, {_OLS_PRED} AS p FROM tourney, beta WHERE dataset = 'live')""", "tourney"))
def q_batch_score(spark, sf):
    m = models.regressor_fit(_train(spark, sf), FEATURES)
    live = tourney(spark, sf).where(F.col("dataset") == "live")
    return rounded(models.batch_score(m, live, FEATURES, "NR"))


@register("attach_predictions", with_views(f"""WITH {_OLS_FIT}
SELECT id, era, {r6(f'CASE WHEN p < 0 THEN 0 WHEN p > 1 THEN 1 ELSE p END')} AS prediction
FROM (SELECT id, era, {_OLS_PRED} AS p FROM tourney, beta)""", "tourney"))
def q_attach_predictions(spark, sf):
    """Scored ids joined back to the rows of all roles (era kept from the rows, not from the scorer)."""
    m = models.regressor_fit(_train(spark, sf), FEATURES)
    rows = tourney(spark, sf)
    preds = models.batch_score(m, rows, FEATURES, "NR")
    return rounded(joins.attach_predictions(rows.select("id", "era"), preds))


@register("gbt_fit", with_views(f"""
WITH h AS (SELECT feature_hour AS h, count(*) AS n, sum(target) AS s FROM tourney WHERE {TR} GROUP BY 1),
c AS (SELECT h, lead(h) OVER w AS nx, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
      FROM h WINDOW w AS (ORDER BY h)),
b AS (SELECT (h + nx) / 2 AS cut, sl / nl AS below, (st - sl) / (nt - nl) AS above FROM c WHERE nx IS NOT NULL
      ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, cut LIMIT 1)
SELECT id, {r6('CASE WHEN feature_hour <= cut THEN below ELSE above END')} AS prediction
FROM tourney, b WHERE dataset = 'valid'""", "tourney"))
def q_gbt_fit(spark, sf):
    """M1 with one tree of depth one and rate one over the feature whose values all get a cut of their own."""
    m = models.gbt_fit(_train(spark, sf), ["feature_hour"], n_trees=1, depth=1, rate=1.0, column_sample="all")
    return rounded(m.transform(_valid(spark, sf)).select("id", F.col(models.SCORE).alias("prediction")))


_BOOSTED = ["feature_hour", "feature_mix"]


def _boosted_sql(n_trees: int, depth: int, rate: float) -> str:
    """The trees level by level: sums by (node, feature, value), running sums, the best cut of each node, its children's values."""
    steps = [f"""z0 AS MATERIALIZED (SELECT id, dataset, target AS y, {_BOOSTED[0]} AS x0, {_BOOSTED[1]} AS x1,
  (SELECT avg(target) FROM tourney WHERE {TR}) AS f, 0 AS node, 0e0 AS val FROM tourney)"""]
    last = "z0"
    for t in range(n_trees):
        for level in range(depth):
            at = f"{t}_{level}"
            steps.append(f"""h{at} AS (SELECT node, j, v, sum(y - f) AS s, count(*) AS c FROM (
  SELECT node, y, f, 0 AS j, x0 AS v FROM {last} WHERE {TR} UNION ALL SELECT node, y, f, 1, x1 FROM {last} WHERE {TR}) GROUP BY node, j, v)""")
            steps.append(f"""r{at} AS (SELECT *, sum(s) OVER w AS gl, sum(c) OVER w AS nl, sum(s) OVER a AS g, sum(c) OVER a AS n FROM h{at}
  WINDOW w AS (PARTITION BY node, j ORDER BY v), a AS (PARTITION BY node, j))""")
            steps.append(f"""b{at} AS MATERIALIZED (SELECT * FROM (SELECT *, gl * gl / (nl + 1) + (g - gl) * (g - gl) / (n - nl + 1) - g * g / (n + 1) AS gain FROM r{at} WHERE nl < n)
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, j, v) = 1)""")
            right = "CASE WHEN b.j = 0 THEN z.x0 > b.v ELSE z.x1 > b.v END"
            steps.append(f"""z{at} AS MATERIALIZED (SELECT z.* REPLACE (CASE WHEN b.node IS NULL THEN -1 WHEN {right} THEN 2 * z.node + 2 ELSE 2 * z.node + 1 END AS node,
  CASE WHEN b.node IS NULL THEN z.val WHEN {right} THEN (b.g - b.gl) / (b.n - b.nl + 1) ELSE b.gl / (b.nl + 1) END AS val)
  FROM {last} z LEFT JOIN b{at} b ON b.node = z.node)""")
            last = f"z{at}"
        steps.append(f"z{t + 1} AS MATERIALIZED (SELECT * REPLACE (f + {rate}e0 * val AS f, 0 AS node, 0e0 AS val) FROM {last})")
        last = f"z{t + 1}"
    return with_views(f"WITH {', '.join(steps)} SELECT id, {r6('f')} AS prediction FROM {last} WHERE dataset = 'valid'", "tourney")


@register("boosted_trees", _boosted_sql(3, 2, 0.5))
def q_boosted_trees(spark, sf):
    """M1 by gradient histograms: three trees of depth two over two features, the second call taking up the first one's ledger."""
    train, ledger = _train(spark, sf), scratch_path(spark, "trees")
    for n in (1, 3):
        m = boosting.boost(train, _BOOSTED, n_trees=n, depth=2, rate=0.5, column_share=1.0, ledger=ledger)
    return rounded(m.transform(_valid(spark, sf)).select("id", F.col(models.SCORE).alias("prediction")))


def _sum(terms):
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


@register("classifier_fit", with_views("SELECT id, true AS agrees FROM tourney WHERE dataset = 'valid'", "tourney"))
def q_classifier_fit(spark, sf):
    """M3: the fitted network's decoded scores against the forward pass of its exported weights, written as columns."""
    m = models.classifier_fit(_train(spark, sf), FEATURES, hidden=(8,), max_iter=50)
    first, last = models.mllib_mlp_layers(m)
    valid = _valid(spark, sf)
    hidden = [1 / (1 + F.exp(-(_sum([F.col(f) * F.lit(float(first.weights[i, j])) for i, f in enumerate(FEATURES)]) + F.lit(float(first.bias[j])))))
              for j in range(len(first.bias))]
    rows = valid.select("id", *[h.alias(f"h{j}") for j, h in enumerate(hidden)])
    scores = F.array(*[_sum([F.col(f"h{j}") * F.lit(float(last.weights[j, k])) for j in range(len(first.bias))]) + F.lit(float(last.bias[k]))
                       for k in range(len(last.bias))])
    own = rows.select("id", ((F.array_position(scores, F.array_max(scores)) - 1) / F.lit(4.0)).alias("own"))
    scored = models.batch_score(m, valid, FEATURES, "NC")
    return scored.join(own, "id").select("id", (F.col("prediction") == F.col("own")).alias("agrees"))


@register("classifier_balance", with_views(f"""
SELECT cast(round(target * 4) AS INTEGER) AS class, count(*) AS n, true AS balanced, true AS below_chance
FROM tourney WHERE {TR} GROUP BY 1""", "tourney"))
def q_classifier_balance(spark, sf):
    """M3's fit: where the loss is least, its slope along the output biases is none, so the mean probability of each class is the
    class's share (within a hundredth here), and the mean log loss lies below that of the shares alone."""
    train = _train(spark, sf)
    m = models.classifier_fit(train, FEATURES, hidden=(8,), max_iter=500)
    label = F.round(F.col("target") * 4).cast("int")
    scored = m.transform(train).select(label.alias("class"), vector_to_array("_probability").alias("p"))
    n_all = F.sum("n").over(Window.partitionBy())  # five rows
    sums = scored.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(-F.log(F.element_at("p", F.col("class") + 1))).alias("loss"),
                                       *[F.sum(F.element_at("p", k + 1)).alias(f"p{k}") for k in range(models.N_CLASSES)])
    each = sums.select("class", "n", "loss", n_all.alias("all"), F.sum("loss").over(Window.partitionBy()).alias("whole"),
                       F.array(*[F.sum(f"p{k}").over(Window.partitionBy()) for k in range(models.N_CLASSES)]).alias("mass"))
    share, chance = F.col("n") / F.col("all"), F.sum(-F.col("n") * F.log(F.col("n") / F.col("all"))).over(Window.partitionBy())
    return each.select("class", "n", (F.abs(F.element_at("mass", F.col("class") + 1) / F.col("all") - share) < 0.01).alias("balanced"),
                       (F.col("whole") <= chance * (1 + 1e-9)).alias("below_chance"))


_WF_SQL = with_views(f"""
WITH tr AS (SELECT *, cast(floor(era / 14) AS INTEGER) AS step FROM tourney),
g AS (SELECT step, count(*) AS n_train, {sqlgen.gram_sums(_OLS_COLS, 'target')} FROM tr GROUP BY step),
beta AS (SELECT step, n_train, {sqlgen.cramer_solution(len(_OLS_COLS))} FROM g),
va AS (SELECT *, cast(floor(era / 14) AS INTEGER) - 1 AS step FROM tourney),
sc AS (SELECT va.step, va.era, va.row_idx, va.target, {_OLS_PRED} AS score FROM va JOIN beta USING (step)),
pe AS (SELECT step, era, count(*) AS n, {sql_corr_strict('r', 'target')} AS corr FROM (
         SELECT step, era, target, {sql_rank_pct('score', 'step, era')} AS r FROM sc) GROUP BY step, era)
SELECT pe.step, beta.n_train, sum(pe.n) AS n_valid, 1 AS epoch, {r6('avg(pe.corr)')} AS valid_corr_mean
FROM pe JOIN beta USING (step) WHERE pe.step >= 0 GROUP BY pe.step, beta.n_train""", "tourney")


# A fixed network for the forward-pass check: weights follow a rule (not a fit), so the same pass
# can be written in SQL. 4 inputs -> 6 ReLU units -> 5 softmax classes -> arg-max / 4.
_HIDDEN, _CLASSES = 6, 5


def _rule_weights():
    import math
    w1 = [[round(math.sin(3 * i + 7 * j + 1), 3) for j in range(_HIDDEN)] for i in range(len(FEATURES))]
    b1 = [round(math.cos(j + 1) / 4, 3) for j in range(_HIDDEN)]
    w2 = [[round(math.sin(5 * j + 2 * k + 3), 3) for k in range(_CLASSES)] for j in range(_HIDDEN)]
    b2 = [round(math.cos(2 * k + 1) / 4, 3) for k in range(_CLASSES)]
    return w1, b1, w2, b2


def _rule_layers():
    import numpy as np
    w1, b1, w2, b2 = _rule_weights()
    return [models.DenseLayer(np.array(w1), np.array(b1), "relu"),
            models.DenseLayer(np.array(w2), np.array(b2), "softmax")]


def _forward_sql_of(keys: str, features: list[str] = FEATURES) -> str:
    """The rule-defined network's decoded class for every row, beside the columns ``keys``."""
    w1, b1, w2, b2 = _rule_weights()
    hidden = [f"greatest({' + '.join(f'({w1[i][j]!r}e0) * {f}' for i, f in enumerate(features))} + ({b1[j]!r}e0), 0) AS h{j}"
              for j in range(_HIDDEN)]
    logits = [" + ".join(f"({w2[j][k]!r}e0) * h{j}" for j in range(_HIDDEN)) + f" + ({b2[k]!r}e0)" for k in range(_CLASSES)]
    arr = "[" + ", ".join(logits) + "]"
    return f"""
SELECT {keys}, (list_position({arr}, list_max({arr})) - 1) / 4e0 AS prediction
FROM (SELECT {keys}, {', '.join(hidden)} FROM tourney)"""


@register("mlp_forward", with_views(_forward_sql_of("id"), "tourney"))
def q_mlp_forward(spark, sf):
    """M4 with a rule-defined network: the Arrow-batch forward pass and its arg-max decode."""
    return models.batch_score(_rule_layers(), tourney(spark, sf), FEATURES, "MLP")


# The same network with a batch normalization behind the hidden layer, its parameters by rule too.
def _rule_norm():
    import math
    return ([round(1 + math.sin(j) / 3, 3) for j in range(_HIDDEN)], [round(math.cos(2 * j) / 5, 3) for j in range(_HIDDEN)],
            [round(abs(math.sin(j + 2)) / 2, 3) for j in range(_HIDDEN)], [round(0.2 + abs(math.cos(j)), 3) for j in range(_HIDDEN)])


def _norm_sql() -> str:
    w1, b1, w2, b2 = _rule_weights()
    gamma, beta, mean, var = _rule_norm()
    hidden = [f"greatest({' + '.join(f'({w1[i][j]!r}e0) * {f}' for i, f in enumerate(FEATURES))} + ({b1[j]!r}e0), 0) AS h{j}"
              for j in range(_HIDDEN)]
    normed = [f"({gamma[j]!r}e0) * (h{j} - ({mean[j]!r}e0)) / sqrt({var[j]!r}e0 + 0.001e0) + ({beta[j]!r}e0) AS g{j}" for j in range(_HIDDEN)]
    logits = [" + ".join(f"({w2[j][k]!r}e0) * g{j}" for j in range(_HIDDEN)) + f" + ({b2[k]!r}e0)" for k in range(_CLASSES)]
    arr = "[" + ", ".join(logits) + "]"
    return with_views(f"""
SELECT id, era, (list_position({arr}, list_max({arr})) - 1) / 4e0 AS prediction
FROM (SELECT id, era, {', '.join(normed)} FROM (SELECT id, era, {', '.join(hidden)} FROM tourney))""", "tourney")


def _norm_layers():
    import numpy as np
    first, last = _rule_layers()
    return [first, models.BatchNormLayer(*map(np.array, _rule_norm())), last]


@register("mlp_score", _norm_sql())
def q_mlp_score(spark, sf):
    """M4 with a batch-normalized network given from outside; the era comes through beside the id."""
    return models.batch_score(_norm_layers(), tourney(spark, sf), FEATURES, "MLP", keep=["era"])


@register("walk_forward_fit", _WF_SQL)
def q_walk_forward_fit(spark, sf):
    """M6 with least-squares fits: exact oracle (per-step normal equations in SQL)."""
    t = tourney(spark, sf).select("id", "row_idx", "era", "target", *FEATURES)
    return rounded(models.walk_forward_fit(t, FEATURES))


_SUBSETS = [FEATURES[:2], FEATURES[1:3], FEATURES[2:]]


def _ensemble_sql() -> str:
    ctes, cols = [], []
    for t, fs in enumerate(_SUBSETS):
        c = fs + ["1e0"]
        ctes.append(f"g{t} AS (SELECT {sqlgen.gram_sums(c, 'target')} FROM tourney WHERE {TR})")
        sol = sqlgen.cramer_solution(len(c)).replace(" AS beta", f" AS b{t}_")
        ctes.append(f"s{t} AS (SELECT {sol} FROM g{t})")
        pred = " + ".join(f"b{t}_{j} * {f}" for j, f in enumerate(fs)) + f" + b{t}_{len(fs)}"
        cols.append(f"{r6(f'CASE WHEN ({pred}) < 0 THEN 0 WHEN ({pred}) > 1 THEN 1 ELSE ({pred}) END')} AS trial_lr{t}")
    return with_views("WITH " + ",\n".join(ctes) + f"""
SELECT id, {', '.join(cols)} FROM tourney, s0, s1, s2 WHERE dataset = 'valid'""", "tourney")


@register("ensemble_score", _ensemble_sql())
def q_ensemble_score(spark, sf):
    """M7: three least-squares trial models fitted in one scan, a column per trial, scored in one pass over the rows."""
    train, valid = _train(spark, sf), _valid(spark, sf)
    fitted = leastsquares.fit_subsets(train, _SUBSETS)
    return rounded(models.ensemble_wide_score(fitted, valid, _SUBSETS, "NR", tag="lr"))


@register("ensemble_networks", with_views(f"""
SELECT id, p.prediction AS trial_n0, p.prediction AS trial_n1, q.prediction AS trial_n2 FROM
({_forward_sql_of('id')}) p JOIN ({_forward_sql_of('id', [FEATURES[1], FEATURES[0], *FEATURES[2:]])}) q USING (id)""", "tourney"))
def q_ensemble_networks(spark, sf):
    """M7 with networks: three trials in one pass over the rows, the last with two features exchanged."""
    swapped = [FEATURES[1], FEATURES[0], *FEATURES[2:]]
    return models.ensemble_wide_score([_rule_layers()] * 3, tourney(spark, sf), [FEATURES, FEATURES, swapped], "MLP", tag="n")


@register("walk_forward_ledger", _WF_SQL)
def q_walk_forward_ledger(spark, sf):
    """M6 from a stored ledger that was written in two parts: the even eras, then the odd ones."""
    t = tourney(spark, sf).select("id", "row_idx", "era", "target", *FEATURES)
    path = scratch_path(spark, "eras")
    for rest in (0, 1):
        leastsquares.write_ledger(t.where(F.col("era") % 2 == rest), path, FEATURES)
    return rounded(models.walk_forward_fit(t, FEATURES, ledger=leastsquares.read_ledger(spark, path)))


_LEVELS = "floor(4 * example_preds + 6 * feature_hour) / 4e0"
_SIXTHS = "least(cast(floor(feature_hour * 6) AS INTEGER), 5)"


@register("regressor_fit_absolute", with_views(f"""
WITH t AS (SELECT id, dataset, {_SIXTHS} AS g, {_LEVELS} AS y FROM tourney),
m AS (SELECT g, median(y) AS prediction FROM t WHERE dataset <> 'live' GROUP BY g)
SELECT id, {r6('prediction')} AS prediction FROM t JOIN m USING (g)""", "tourney"))
def q_regressor_fit_absolute(spark, sf):
    """M2 with mean absolute error over indicators of the day's sixths: the fit of each is the median of its rows."""
    sixth = F.least(F.floor(F.col("feature_hour") * 6), F.lit(5))
    y = F.floor(4 * F.col("example_preds") + 6 * F.col("feature_hour")) / 4
    rows = tourney(spark, sf).select("id", "dataset", y.alias("y"), *[(sixth == g).cast("double").alias(f"in{g}") for g in range(6)])
    names = [f"in{g}" for g in range(6)]
    m = models.regressor_fit(rows.where("dataset <> 'live'"), names, "y", loss="absoluteError")
    return rounded(m.transform(rows).select("id", F.col(models.SCORE).alias("prediction")))


# ----------------------------------------------------------------------------- streaming

_ROUND_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("arrival", T.TimestampNTZType()),
    *[T.StructField(f, T.DoubleType()) for f in FEATURES], T.StructField("round", T.IntegerType())])


LATE, TWICE = 11, (7, 30)


def _round_files(spark, sf) -> str:
    """All 30 days as rounds, one folder each, delivered out of order: the days from the 11th on, then the earlier ones
    as a backfill, then two days once more."""
    folder = scratch_path(spark, "rounds")
    ev = read_table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), F.col("ts").alias("arrival"))
    rows = tourney(spark, sf).join(ev, "id").select("id", "arrival", *FEATURES, F.col("era").alias("round"))
    half = F.pmod(F.xxhash64("id"), F.lit(2))  # two files a round; the join before keeps its width
    for part in (F.col("round") >= LATE, F.col("round") < LATE, F.col("round").isin(*TWICE)):
        rows.where(part).repartition("round", half).write.mode("append").partitionBy("round").parquet(folder)
    return folder


def _run_stream(spark, sf, score, gate: bool = True, fmt: str = "parquet", keyed: bool = False) -> str:
    """The sink after several micro-batches of a few files each."""
    source, sink = _round_files(spark, sf), scratch_path(spark, "round_sink")
    rounds.stream_score(spark, source, _ROUND_SCHEMA, sink, scratch_path(spark, "round_ckpt"), score,
                        keys=("round", "id") if gate else None, fmt=fmt, max_files_per_trigger=20, keyed=keyed)
    return sink


def _sink_rows(spark, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch").withColumn("round", F.col("round").cast("int"))


@register("stream_new_rounds", with_views("""
SELECT era AS round, id, CASE WHEN era IN (7, 30) THEN 2 ELSE 1 END AS n_delivered FROM tourney""", "tourney"))
def q_stream_new_rounds(spark, sf):
    """Every delivered file is read once, whenever it comes; the re-delivered rounds count twice."""
    out = _sink_rows(spark, _run_stream(spark, sf, lambda b: b.select("round", "id"), gate=False))
    return out.groupBy("round", "id").agg(F.count(F.lit(1)).cast("int").alias("n_delivered"))


@register("round_gate", with_views("SELECT era AS round, id FROM tourney", "tourney"))
def q_round_gate(spark, sf):
    """Every row of every round once, late and repeated deliveries included."""
    return _sink_rows(spark, _run_stream(spark, sf, lambda b: b.select("round", "id"))).select("round", "id")


@register("round_gate_keyed", with_views("SELECT era AS round, id FROM tourney", "tourney"))
def q_round_gate_keyed(spark, sf):
    """T2 by keyed state: the same rows, without reading the sink."""
    return _sink_rows(spark, _run_stream(spark, sf, lambda b: b.select("round", "id"), keyed=True)).select("round", "id")


_CHAIN = "NaN,0.5,0.5|Slice,0,4|Sparse,5,0"


@register("stream_score", with_views(f"""SELECT era AS round, id, prediction FROM ({_forward_sql_of('era, id')}) ORDER BY ALL""", "tourney"))
def q_stream_score(spark, sf):
    """Rounds -> gate -> missing features filled -> transform chain -> network -> class decode -> submission files
    per round, read back from their CSV."""
    from .plans import pipelines
    layers = _rule_layers()

    def score(batch: DataFrame) -> DataFrame:
        return pipelines.live_predictions(batch, layers, FEATURES, "MLP", chain=_CHAIN, keep=["round"])

    sink = _run_stream(spark, sf, score, fmt="csv")
    out = spark.read.option("header", True).schema("id string, prediction double, batch long, round int").csv(sink)
    return out.select("round", "id", "prediction")


# ----------------------------------------------------------------------------- lifecycle plans

@register("training_etl", with_views(f"""
SELECT id, era, CASE WHEN row_number() OVER (ORDER BY md5(id || '5'), id) <= floor(count(*) OVER () * 0.2e0)
                     THEN 'valid' ELSE 'train' END AS dataset,
       {', '.join(f"{r6(f'cast({f} AS FLOAT)')} AS x{i}" for i, f in enumerate(FEATURES))}, {r6('cast(target AS FLOAT)')} AS y0
FROM tourney WHERE dataset <> 'live'""", "tourney"))
def q_training_etl(spark, sf):
    """The ETL path: examples with an exact 20 % holdout written as shards, and every row read back."""
    from .plans import pipelines
    rows = tourney(spark, sf).where(F.col("dataset") != "live").drop("dataset")
    out = scratch_path(spark, "etl")
    pipelines.training_etl(rows, out, FEATURES, ["target"], split=0.2, seed=5, shard_rows=1000)
    back = spark.read.parquet(out)
    xs = [F.element_at("x", i + 1).cast("double").alias(f"x{i}") for i in range(len(FEATURES))]
    return rounded(back.select("id", "era", "dataset", *xs, F.element_at("y", 1).cast("double").alias("y0")))


@register("live_scoring", with_views(f"""WITH {_OLS_FIT},
p AS (SELECT id, CASE WHEN p < 0 THEN 0 WHEN p > 1 THEN 1 ELSE p END AS p
      FROM (SELECT id, {_OLS_PRED} AS p FROM tourney, beta WHERE dataset = 'live'))
SELECT id, {r6('p')} AS prediction, count(*) OVER (PARTITION BY least(floor(p * 10), 10)) AS in_bucket FROM p""", "tourney"))
def q_live_scoring(spark, sf):
    """The predict path: live rows scored and written as a submission; every written row with the size of its
    bucket in the decile histogram of the file."""
    from .plans import pipelines
    model = models.regressor_fit(_train(spark, sf), FEATURES)
    live = tourney(spark, sf).where(F.col("dataset") == "live")
    path, hist = pipelines.live_scoring(live, model, FEATURES, scratch_path(spark, "live"), "lr", 1, 30)
    rows = pipelines.read_submission(spark, path)
    bucket = F.least(F.floor(F.col("prediction") * 10), F.lit(10)).cast("int")
    sized = rows.withColumn("bucket", bucket).join(F.broadcast(hist), "bucket")  # 13 buckets
    return rounded(sized.select("id", "prediction", F.col("n").alias("in_bucket")))
