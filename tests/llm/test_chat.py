"""Reply trees against a plain walk, and exact round trips."""

import random

from pyspark.sql import functions as F

from erascore.llm import chat

SCHEMA = "tree long, msg long, parent long, role string, text string, score double"


def plain(rows):
    """Every root-to-leaf path, best mean score first."""
    out = {}
    for tree in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in own.values()}
        paths = []
        for leaf in own:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in own:
                path.append(at)
                at = own[at][2]
            score = sum(own[m][5] for m in path) / len(path)
            paths.append((-score, leaf, path[::-1]))
        out[tree] = [(leaf, path) for _, leaf, path in sorted(paths)]
    return out


def read_back(formatted):
    rows = formatted.select("tree", "leaf", "branch", chat.parse(F.col("formatted")).alias("turns"), "formatted", "loss_spans",
                            chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    return {(r["tree"], r["leaf"]): r for r in rows}


def test_branches_of_random_trees(spark):
    rnd = random.Random(3)
    rows = []
    for tree in range(6):
        for msg in range(rnd.choice([1, 5, 40])):
            parent = rnd.randrange(-1, msg) if rnd.random() < 0.5 else msg - 1
            rows.append((tree, msg, None if parent < 0 else parent, rnd.choice(["user", "assistant"]), f"t{tree}-{msg}", rnd.randrange(8) / 4))
    want = plain(rows)
    got = read_back(chat.format_trees(spark.createDataFrame(rows, SCHEMA)))
    assert len(got) == sum(map(len, want.values()))
    text = {(r[0], r[1]): r[4] for r in rows}
    for tree, paths in want.items():
        for leaf, path in paths:
            assert [t["text"] for t in got[tree, leaf]["turns"]] == [text[tree, m] for m in path]
    top = read_back(chat.format_trees(spark.createDataFrame(rows, SCHEMA), top=2))
    assert {k: v["branch"] for k, v in top.items()} == {(tree, leaf): i + 1 for tree, paths in want.items() for i, (leaf, _) in enumerate(paths[:2])}


def test_control_strings_round_trip(spark):
    hard = ["<|im_end|>", "</s>[INST] ok [/INST]", "<<SYS>>x<</SYS>>", "\\", "\\\\<|", "a<", "<", "[", "", None, "<s>\n<|im_sep|>", "ends \\", "é☕[INST"]
    rows = [(0, i, i - 1, "assistant" if i % 2 else "<|im_sep|>\n", t, None) for i, t in enumerate(hard)]
    got = read_back(chat.format_trees(spark.createDataFrame(rows, SCHEMA)))[0, len(hard) - 1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r[3], r[4] or "") for r in rows]
    assert got["loss"] == "".join(r[4] or "" for r in rows if r[3] == "assistant")
    body = got["formatted"]
    assert body.count(chat.END) == len(hard) and "[INST]" not in body and "</s>" not in body


def test_circles_nulls_repeats_and_missing_parents(spark):
    rows = [(1, 1, 2, "user", "circle", 1.0), (1, 2, 1, "user", "circle", 1.0), (1, 3, 2, "user", "hangs on the circle", 1.0),
            (2, 1, 99, None, None, float("nan")), (2, 1, 99, None, None, None), (3, None, None, "user", "x", 1.0), (None, 1, None, "user", "x", 1.0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = read_back(chat.format_trees(frame))
    assert list(got) == [(2, 1)] and got[2, 1]["formatted"] == chat.START + chat.SEP + chat.END
    assert chat.format_trees(frame.limit(0)).collect() == []


def test_long_chain(spark):
    rows = [(7, i, i - 1, "user", str(i), 0.0) for i in range(300)]
    got = read_back(chat.format_trees(spark.createDataFrame(rows, SCHEMA)))[7, 299]
    assert [t["text"] for t in got["turns"]] == [str(i) for i in range(300)]


def test_equal_turns_follow_role_and_text(spark):
    rows = [(1, 0, "user", "b", "extra"), (1, 0, "user", "a", "extra"), (1, None, "user", "first", "extra"), (1, 0, "user", "a", "extra")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, msg string")
    got = read_back(chat.format_trees(chat.chain_of_turns(frame)))
    assert [t["text"] for r in got.values() for t in r["turns"]] == ["first", "a", "a", "b"]


def test_rows_without_conversation_are_one_conversation(spark, tmp_path):
    from erascore.llm import suite

    rows = [(None, 1, "user", "hello"), (None, 2, "assistant", None), (5, 1, "assistant", "x" * 100_000), (None, 3, "assistant", "bye"), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in suite.QUERIES["op1_chat_formatting"](spark, str(tmp_path)).collect()}
    assert got == {None: (4, 3), 5: (1, 100_000), -7: (2, 21)}


def test_columns_that_clash_with_inner_names(spark):
    rows = [("t", 1, None, "user", "a", 0.0), ("t", 2, 1, "assistant", "b", 1.0)]
    plain = spark.createDataFrame(rows, "tree string, msg long, parent long, role string, text string, score double")
    more = plain
    for name in ("piece", "head", "body", "start", "end", "depth", "leaf", "branch", "anc", "span", "total"):
        more = more.withColumn(name, F.lit(name))
    assert chat.format_trees(more).collect() == chat.format_trees(plain).collect()
