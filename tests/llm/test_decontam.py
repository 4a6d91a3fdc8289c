"""Retrieval and verification against brute force over all passages and documents."""

import random
import re
from collections import Counter

import numpy as np

from erascore.llm import decontam as D
from erascore.llm import suite

from .frames import documents


def test_common_words_is_the_lcs():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert D.common_words(a, b) == table[-1][-1]


def test_answers():
    assert D.answer_of("What is it? Answer: the blue door.") == ["the", "blue", "door"]
    assert D.answer_of("First part. The last one holds.") == ["the", "last", "one", "holds"]
    assert D.answer_of(None) == [] == D.answer_of("...")


def test_svd_equals_numpy(spark):
    rnd = np.random.default_rng(1)
    a = rnd.normal(size=(12, 30)) * (rnd.random((12, 30)) < 0.4)
    rows = [(int(i), f"w{j}", float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    right, values = D.randomised_svd(spark.createDataFrame(rows, "row long, word string, value double"), 12)
    assert np.allclose(values, np.linalg.svd(a, compute_uv=False), rtol=1e-5)
    v = np.zeros((30, 12))
    for r in right.collect():
        v[int(r["word"][1:])] = r["vec"]
    assert np.allclose(a @ v @ v.T, a, atol=1e-5)


def brute(docs, items):
    """Every (document, passage) of which some stretch of words holds the passage's share in order."""
    out = set()
    for doc, text in docs:
        words = D.words_of(text)
        for item, passage in items:
            want, reply = D.words_of(passage), D.answer_of(passage)
            if len(want) < D.MIN_WORDS:
                continue
            common = set(want)
            for i in range(0, max(1, len(words) - len(want) // 2), max(1, len(want) // 6)):
                part = words[i:i + len(want) + len(want) // 3]
                if sum(w in common for w in part) < D.PARAPHRASE * len(want):
                    continue
                lcs = D.common_words(want, part) / len(want)
                if lcs >= D.COPY or lcs >= D.PARAPHRASE and reply and D.common_words(reply, part) / len(reply) >= D.ANSWER:
                    out.add((doc, item))
                    break
    return out


def test_copies_and_paraphrases_are_found_and_nothing_else(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rnd, planted = random.Random(8), []
    for k, (item, passage) in enumerate(items):  # with other words put in, the answer left alone
        words = passage.split()
        for i in rnd.sample(range(len(words) // 2), len(words) // 8):
            words[i] = f"other{k}"
        host = docs[k][1].split(" ")
        at = rnd.randrange(len(host) + 1)
        planted.append((10_000 + k, " ".join([*host[:at], *words, *host[at:]])))
    frame = spark.createDataFrame(docs + planted, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, bench).collect()}
    want = brute(docs + planted, items)
    assert {d for d, _ in planted} <= {d for d, _ in want}
    assert len(want & got) >= 0.99 * len(want) and not got - want
    split = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, bench, block=15).collect()}
    assert split == got  # the blocks a benchmark is taken in change nothing
    scans = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, bench, scan_words=900).collect()}
    assert scans == got  # nor the scans


def test_every_exact_copy_of_the_query(spark, sf_dir):
    got = {(r["doc_id"], r["item_id"]) for r in suite.QUERIES["op5_decontamination"](spark, sf_dir).collect()}

    def flat(s):
        return " " + re.sub(r"\W+", " ", s.lower()).strip() + " "

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    copies = {(d["doc_id"], i["item_id"]) for d in docs for i in items if flat(i["text"]) in flat(d["text"])}
    assert copies and copies <= got


def test_awkward_rows(spark, sf_dir):
    frame = documents(spark)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too few words"), (None, "word5 item5 word6 item6 word7 item7 word8 item8 word9 item9"),
                                   (4, "word5 item5 word6 item6 word7 item7 word8 item8 word9 item9")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, bench).collect()}
    assert got == {(4, 4), (4, None)}
    assert D.contaminated(frame.limit(0), bench).collect() == [] == D.contaminated(frame, bench.limit(0)).collect()


def test_changed_copies_are_found_whichever_words_were_changed(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    often = Counter(w for _, t in docs for w in set(D.words_of(t)))
    rnd, planted = random.Random(5), []
    for k, (item, passage) in enumerate(items):
        words, reply = D.words_of(passage), len(D.answer_of(passage))
        rare = sorted(range(len(words)), key=lambda i: (often[words[i]], i))
        body = range(len(words) - reply)  # the answer, which comes last, is left alone
        changes = [rare[:int(0.15 * len(words))], rare[:int(0.2 * len(words))], rnd.sample(body, min(len(body), int(0.35 * len(words)))),
                   [i for i in rare if i in body][:int(0.4 * len(words))]]
        for c, places in enumerate(changes):
            host = docs[k % len(docs)][1].split(" ")
            at = rnd.randrange(len(host) + 1)
            text = [f"other{k}" if i in places else w for i, w in enumerate(words)]
            planted.append((10_000 + 10 * k + c, " ".join([*host[:at], *text, *host[at:]])))
    frame = spark.createDataFrame(docs + planted, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs + planted, items)
    assert len({d for d, _ in want} & {d for d, _ in planted}) >= 0.9 * len(planted)
    assert want <= got


def test_long_passages_are_found_at_every_length(spark):
    rnd, words = random.Random(6), [f"w{i}" for i in range(3000)]
    items = [(n + k, " ".join(rnd.choices(words, k=n)) + ".") for n in (300, 500, 800, 1000, 1500, 2000) for k in range(2)]
    docs = [(0, " ".join(rnd.choices(words, k=5000)))]
    for item, passage in items:
        host, text = rnd.choices(words, k=900), passage.split()
        at = rnd.randrange(900)
        docs.append((item, " ".join([*host[:at], *text, *host[at:]])))
        for i in rnd.sample(range(len(text)), int(0.15 * len(text))):
            text[i] = "other"
        docs.append((-item, " ".join([*host[:at], *text, *host[at:]])))
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, i) for i, _ in items for d in (i, -i)}
    assert all(r["lcs"] == 1 for r in found if r["doc_id"] > 0)


def changed(items, often, seed):
    """(passage, words) of each passage whole, and with 15 to 40 % of its words replaced, the rarest or any, spread or not."""
    rnd = random.Random(seed)
    for k, (_, passage) in enumerate(items):
        words, reply = D.words_of(passage), len(D.answer_of(passage))
        rare = sorted(range(len(words)), key=lambda i: (often[words[i]], i))
        body = range(len(words) - reply)
        for places in ([], rare[:int(0.2 * len(words))], rnd.sample(body, min(len(body), int(0.35 * len(words)))),
                       [i for i in rare if i in body][:int(0.4 * len(words))]):
            yield k, [f"other{k}" if i in places else w for i, w in enumerate(words)]


def test_recall_with_dimensions_left_out(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.1")
    hosts = [D.words_of(r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").orderBy("doc_id").limit(600).select("text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{root}/benchmark.parquet").orderBy("item_id").collect()]
    assert D.rank_for(len(items)) < len(items)
    often = Counter(w for words in hosts for w in set(words))
    rnd, docs, want = random.Random(3), [], set()
    for n, (k, words) in enumerate(changed(items, often, 12)):
        host = hosts[n % len(hosts)][:400]
        at = rnd.randrange(len(host) + 1)
        docs.append((n, " ".join([*host[:at], *words, *host[at:]])))
        lcs = D.common_words(D.words_of(items[k][1]), words) / len(words)
        reply = D.answer_of(items[k][1])
        if lcs >= D.COPY or lcs >= D.PARAPHRASE and reply and D.common_words(reply, words) >= D.ANSWER * len(reply):
            want.add((n, items[k][0]))
    docs += [(100_000 + i, " ".join(words)) for i, words in enumerate(hosts)]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    recall = {c: np.mean([x in got for x in want if x[0] % 4 == c]) for c in range(4)}
    print("recall whole, 20 % rarest, 35 % any, 40 % rarest:", recall)
    assert len(want) > 0.9 * 4 * len(items)
    assert recall[0] == 1 and min(recall.values()) >= 0.97


def test_short_passages_are_found_word_for_word(spark):
    items = [(1, "Blue whales sing."), (2, "whales"), (3, "sing blue whales"), (4, "a a a b")]
    docs = [(1, "There blue, whales sing!"), (2, "sing"), (3, "a a a a b"), (4, "Blue whales"), (5, "a a b")]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (1, 2), (4, 2), (3, 4)}


def test_the_space_decides(spark):
    """A window that shows nothing of a passage in the space is no candidate, whatever words they share."""
    words = [f"w{i}" for i in range(12)]
    items, known, weight = [(1, words, [])], {w: i for i, w in enumerate(words)}, dict.fromkeys(words, 1.0)
    text = [np.array([*[12] * 30, *range(12), *[12] * 30])]
    true = {w: np.array([1 / 12**0.5, 0.0]) for w in words}
    assert set(D.candidates(text, D.space_of(items, known, true, weight, 0.6))) == {(0, 0)}
    space = D.space_of(items, known, true, weight, 0.6)
    other = space._replace(matrix=np.ascontiguousarray(space.matrix[:, ::-1]))
    assert D.candidates(text, other) == {}
