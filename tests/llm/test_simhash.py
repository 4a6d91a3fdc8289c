"""SimHash fingerprints and components against all pairs."""

import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from erascore.llm import simhash, suite
from erascore.sources.tables import read_table

from .frames import documents, empty


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        k = find(p)
        least[k] = min((x for x in (least.get(k), doc) if x is not None), default=None)
    return sorted(((doc, f"{p:016x}", least[find(p)]) for (doc, _), p in zip(rows, prints, strict=True)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = brute(rows)
    assert found(suite.QUERIES["op11_simhash"](spark, sf_dir)) == want
    assert any(doc != head for doc, _, head in want)


def test_awkward_rows(spark):
    docs = documents(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(simhash.near_duplicates(docs)) == want
    assert simhash.near_duplicates(empty(spark, docs)).count() == 0


def test_groups_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(simhash.near_duplicates(docs)) == brute(rows)


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=600), max_size=6))
@settings(max_examples=40, deadline=None)
def test_majority_bits(runs):
    flat = np.array([h for r in runs for h in r], dtype=np.uint64)
    want = [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r) > len(r)) for r in runs]
    assert simhash.majority_bits(flat, [len(r) for r in runs]).tolist() == want


def components(nodes, pairs):
    root = {n: n for n in nodes}
    for a, b in pairs:
        a, b = root[a], root[b]
        root = {n: min(a, b) if r in (a, b) else r for n, r in root.items()}
    return root


def test_list_forest_both_ways(monkeypatch):
    rng = random.Random(3)
    members = sorted({0x1122334455000000 | sum(1 << rng.randrange(24) for _ in range(rng.randrange(7))) for _ in range(150)})
    pairs = [(a, b) for i, a in enumerate(members) for b in members[i + 1:] if (a ^ b).bit_count() <= 3]
    want = components(members, pairs)
    for lookup in (simhash._LOOKUP, 0):
        monkeypatch.setattr(simhash, "_LOOKUP", lookup)
        got = [(int(a), int(b)) for a, b in simhash.list_forest(np.array(members, np.uint64))]
        assert len(got) < len(members)
        assert components(members, got) == want


def test_links_split_over_batches_and_flushes(spark, monkeypatch):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for _ in range(200)}
    prints = sorted(p & (1 << 64) - 1 for p in prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if (a ^ b).bit_count() <= 3]
    assert components(prints, got) == components(prints, pairs)
