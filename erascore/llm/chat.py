"""Chat formatting of reply trees, in DataFrame functions only.

Messages form trees: each names its parent. Branches (root-to-leaf paths) are found by iterative
self-joins that double the reach of an ancestor pointer, so a thread of ``d`` turns takes ``log2 d``
rounds. Branches are ranked within their tree by mean score; each chosen one becomes one string.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn. Inside roles and texts a backslash is
doubled, and one is put after the first character of anything that could be read as a control string
(``<|``, ``<s>``, ``</s>``, ``<<SYS>>``, ``<</SYS>>``, ``[INST]``, ``[/INST]``); ``unescape`` undoes both.

Defined cases: a null text or role is empty; a null tree, or a null message id, is no message; repeated message ids
in a tree keep the first by (role, text); a missing parent makes a root; messages whose ancestors run in
a circle have no root and are left out; equal scores rank by the leaf's id; a null or NaN score counts as zero;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The control strings of common chat templates, each matched at its first character.
CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def branches(messages: DataFrame, top: int | None = None) -> DataFrame:
    """(tree, leaf, msg, depth, score, branch): the messages of the ``top`` best branches of each tree (all
    where None), root at depth 0; ``messages`` has tree, msg, parent and score, one row per message.

    Rows carry ids only. ``jump`` k maps a message to its ancestor 2**k above; the sums of scores
    double along. The chosen leaves are then expanded downwards through the same tables."""
    rows = messages.select("tree", "msg", "parent", F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("score"))
    ids = rows.select("tree", F.col("msg").alias("parent"), F.lit(True).alias("known"))
    known = rows.join(ids, ["tree", "parent"], "left")
    known = staged(known.select("tree", "msg", F.when(F.col("known"), F.col("parent")).alias("anc"), "score"), "chat-nodes")
    # depth and total: of the stretch from the message to its root once `anc` is null
    reach = known.select("tree", "msg", "anc", F.lit(1).cast("long").alias("span"), F.col("score").alias("total"))
    longest = known.groupBy("tree").count().agg(F.max("count")).first()[0] or 0  # no path has more turns
    jumps = []
    while 2 ** len(jumps) < 2 * longest:
        jump = reach.where("anc IS NOT NULL").select("tree", "msg", "anc")
        if jump.isEmpty():
            break
        jumps.append(jump)
        up = reach.select("tree", F.col("msg").alias("anc"), F.col("anc").alias("next"),
                          F.col("span").alias("up_span"), F.col("total").alias("up_total"))
        reach = staged(reach.join(up, ["tree", "anc"], "left").select(
            "tree", "msg", F.col("next").alias("anc"), (F.col("span") + F.coalesce("up_span", F.lit(0))).alias("span"),
            (F.col("total") + F.coalesce("up_total", F.lit(0.0))).alias("total")), "chat-reach")
    parents = known.where("anc IS NOT NULL").select("tree", F.col("anc").alias("msg")).distinct()
    done = reach.where("anc IS NULL")  # an ancestry that never ends is a circle
    leaves = done.join(parents, ["tree", "msg"], "left_anti").select(
        "tree", F.col("msg").alias("leaf"), (F.col("total") / F.col("span")).alias("mean_score"), "span")
    if top is not None:
        order = Window.partitionBy("tree").orderBy(F.desc("mean_score"), F.asc("leaf"))
        leaves = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= top)
    else:
        leaves = leaves.withColumn("branch", F.lit(None).cast("int"))
    path = leaves.select("tree", "leaf", "mean_score", "branch", F.col("leaf").alias("msg"), (F.col("span") - 1).alias("depth"))
    for k, jump in enumerate(jumps):
        above = path.join(jump, ["tree", "msg"]).select(
            "tree", "leaf", "mean_score", "branch", F.col("anc").alias("msg"), (F.col("depth") - 2**k).alias("depth"))
        path = staged(path.unionByName(above), "chat-path")
    return path


def format_trees(messages: DataFrame, top: int | None = None) -> DataFrame:
    """One row per chosen branch: tree, leaf, branch, mean_score, n_turns, formatted, loss_spans.

    ``messages``: tree, msg, parent, role, text, score. ``loss_spans`` has the (start, end) code points of
    each assistant text in ``formatted``."""
    first = F.min(F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                           F.col("parent"), F.col("score").cast("double").alias("score"))).alias("row")
    rows = staged(messages.where("tree IS NOT NULL AND msg IS NOT NULL").groupBy("tree", "msg").agg(first)
                  .select("tree", "msg", "row.*"), "chat-messages")
    path = branches(rows.select("tree", "msg", "parent", "score"), top)
    turns = path.join(rows.select("tree", "msg", "role", "text"), ["tree", "msg"])
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    turns = turns.withColumn("head", head).withColumn("body", escape(F.col("text")))
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(END)))
    so_far = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.char_length("piece")).over(so_far), F.lit(0)) + F.char_length("head")
    turns = turns.withColumn("start", at).withColumn("end", F.col("start") + F.char_length("body"))
    whole = turns.groupBy("tree", "leaf").agg(
        F.first("branch").alias("branch"), F.first("mean_score").alias("mean_score"), F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("start", "end")))).alias("loss_spans"))
    return whole.select("tree", "leaf", "branch", "mean_score", "n_turns",
                        F.array_join("pieces.piece", "").alias("formatted"), "loss_spans")


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    body = F.filter(F.split(formatted, r"<\|im_end\|>", -1), lambda p: p != "")
    turns = F.transform(body, lambda p: F.split(F.substr(p, F.lit(len(START) + 1)), r"<\|im_sep\|>", 2))
    return F.transform(turns, lambda t: F.struct(unescape(t[0]).alias("role"), unescape(t[1]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def chain_of_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each turn answers the one before.
    Rows of equal turn follow one another by role and text; repeated rows are repeated turns."""
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    msg = F.row_number().over(order).cast("long")
    return conversations.select(F.col("conv_id").alias("tree"), msg.alias("msg"), (msg - 1).alias("parent"),
                                "role", "text", F.lit(0.0).alias("score"))
