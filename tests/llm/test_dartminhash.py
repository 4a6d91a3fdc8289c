"""Signatures against exact similarity, classes against all pairs."""

import random
from collections import defaultdict

import numpy as np

from erascore.llm import dartminhash as D

from .frames import documents
from .test_components import union_find


def brute_classes(rows):
    """(doc_id, text) -> class id by comparing every pair of different texts."""
    words = D.Words()
    texts = sorted({t or "" for _, t in rows})
    sets = [D.shingles(t, words) for t in texts]
    links = [(i, i) for i in range(len(texts))]
    holders = defaultdict(list)
    for i, (elements, _) in enumerate(sets):
        for e in elements.tolist():
            holders[e].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links += [(a, b) for a, b in pairs if D.weighted_jaccard(sets[a], sets[b]) >= D.THRESHOLD]
    label = union_find(links)
    number = {t: label[i] for i, t in enumerate(texts)}
    first = {}
    for d, t in rows:
        k = number[t or ""]
        if d is not None:
            first[k] = min(first.get(k, d), d)
    return sorted(((d, first.get(number[t or ""])) for d, t in rows), key=repr)


def test_agreement_is_weighted_jaccard():
    rnd, words = random.Random(4), D.Words()
    for n, edits, repeats in ((3, 1, 1), (40, 2, 1), (400, 30, 1), (60, 3, 9)):
        seen = []
        for _ in range(20):
            a = [f"w{rnd.randrange(3000)}" for _ in range(n)] * repeats
            b = list(a)
            for _ in range(edits):
                b[rnd.randrange(len(b))] = f"x{rnd.random()}"
            x, y = D.shingles(" ".join(a), words), D.shingles(" ".join(b), words)
            sig = D.signatures([x, y], 256)
            seen.append((sig[0] == sig[1]).mean() - D.weighted_jaccard(x, y))
        assert abs(np.mean(seen)) < 0.03


def test_signature_does_not_depend_on_company():
    words = D.Words()
    sets = [D.shingles(" ".join(f"w{i * j % 91}" for i in range(n)), words) for j, n in ((3, 1), (5, 7), (7, 300), (11, 20_000))]
    together = D.signatures(sets, 125)
    for s, row in zip(sets, together, strict=True):
        assert (D.signatures([s], 125)[0] == row).all()


def test_classes_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rnd = random.Random(9)
    extra = []
    for k in range(40):  # a large group of near copies, not all of which resemble one another
        t = rows[7][1].split(" ")
        for _ in range(len(t) // 45):
            t[rnd.randrange(len(t))] = f"new{k}"
        extra.append((90_000 + k, " ".join(t)))
    rows += extra + extra[:3]
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == brute_classes(rows)


def test_awkward_documents(spark):
    frame = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    got = D.near_duplicates(frame).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == brute_classes(rows)
    assert D.near_duplicates(frame.limit(0)).collect() == []


def test_heads_keep_one_of_each_class_and_all_columns(spark):
    frame = documents(spark)
    kept = D.class_heads(frame)
    assert kept.schema == frame.schema
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    classes = len({c if c is not None else (c, d) for d, c in brute_classes(rows)})
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) and "other text, same id" in texts and "no id" in texts
    assert len(texts) >= classes


def _edited(rng, base, n):
    out = list(base)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.random()}"
    return " ".join(out)


def test_summaries_lose_no_link_and_leave_few_others():
    """Copies of one text whose similarity lies around the threshold: signatures alone let nearly all of them through."""
    rng, words = random.Random(5), D.Words()
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = [_edited(rng, base, rng.randrange(1, 9)) for _ in range(120)]
    texts += [_edited(rng, [f"w{i % 7}" for i in range(n)], 2) for n in (40, 300, 600)] + ["a " * n for n in (3, 100, 560, 650, 700, 900)]
    long = [f"v{rng.randrange(10**6)}" for _ in range(760)]
    texts += [_edited(rng, long[:n], 3) for n in (500, 520, 560, 630, 644, 645, 650, 700, 760)]
    sets = [D.shingles(t, words) for t in texts]
    sig = np.concatenate([D.signatures([s], D.BANDS * D.ROWS) for s in sets])
    opened = D._opened(D.summaries(sets, sig), D.THRESHOLD)
    i, j = np.triu_indices(len(sets), 1)
    near = D.may_link(opened, opened, i, j)
    exact = np.array([D.weighted_jaccard(sets[a], sets[b]) for a, b in zip(i, j, strict=True)])
    assert near[exact >= D.THRESHOLD].all()
    loose = (exact < D.THRESHOLD) & (exact > 0.65)
    agreeing = (sig[i] == sig[j]).mean(axis=1) >= D.AGREE
    assert near[loose].sum() < 0.2 * agreeing[loose].sum()


def test_group_of_copies_around_the_threshold(spark):
    """Hundreds of copies that are mostly not similar to one another: classes equal those of all pairs."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(i, _edited(rng, base, rng.randrange(1, 12))) for i in range(300)]
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == brute_classes(rows)


def _named(monkeypatch):
    """What each round's pairs were counted at."""
    seen, real = [], D.staged_with

    def watched(df, name, **metrics):
        out, found = real(df, name, **metrics)
        if name == "near-pairs":
            seen.append(found)
        return out, found

    monkeypatch.setattr(D, "staged_with", watched)
    return seen


def test_pairs_grow_with_the_texts(spark, monkeypatch):
    """A group of copies around the threshold and one of long texts below it: after the first round, each text is named in a few pairs
    with a class, not with all of its members, and texts that are not similar in hardly any."""
    rng, seen = random.Random(8), _named(monkeypatch)
    base, long = ([f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (150, 800))
    texts = [_edited(rng, base, rng.randrange(1, 8)) for _ in range(200)] + [_edited(rng, long, rng.randrange(10, 15)) for _ in range(100)]
    rows = list(enumerate(texts))
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == brute_classes(rows)
    assert sum(x["n"] for x in seen) < 6 * len(rows)


def test_held_back_pairs_are_named_later(spark, monkeypatch):
    """One pair of two classes at a time, which signatures often name wrongly in long texts; leaders in many blocks and batches."""
    rng, seen = random.Random(3), _named(monkeypatch)
    monkeypatch.setattr(D, "_TRIES", 1)
    monkeypatch.setattr(D, "_BLOCK", 5)
    monkeypatch.setattr(D, "_PAIRS", 16)
    long = [f"w{rng.randrange(10**6)}" for _ in range(2300)]
    rows = [(i, _edited(rng, long, rng.randrange(10, 100))) for i in range(60)]
    base = [f"v{rng.randrange(10**6)}" for _ in range(90)]
    rows += [(100 + i, _edited(rng, base, rng.randrange(1, 6))) for i in range(60)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == brute_classes(rows)
    assert sum(x["held"] for x in seen) > 0
