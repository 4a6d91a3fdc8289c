"""Cross-tokenizer alignment against the tokenizers themselves and plain interval comparison."""

import hashlib
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from erascore.llm import alignment, packing, suite
from erascore.sources.tables import read_table

from .frames import documents, empty

PATHS = tuple(map(suite.tokenizer_path, suite.ALIGNED))


@lru_cache
def tools():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return alignment.TokenPairs(*PATHS), a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute_tokens(text):
    pairs, a, b = tools()
    if not text:
        return [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    letters = {chr(v): k for k, v in packing._byte_letters().items()}
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
    whole = (" " + text).encode("utf-8")
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    return list(zip(ids_a, bytes_a, strict=True)), list(zip(ids_b, bytes_b, strict=True))


def brute(rows):
    each, counts = [], Counter()
    for doc, text in rows:
        a, b = brute_tokens(text)
        spans, links = [], []
        for side in (a, b):
            at, out = 0, []
            for i, raw in side:
                out.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(out)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        members = [([], []) for _ in ends]
        for side in (0, 1):
            for _, e, i in spans[side]:
                members[bisect_left(ends, e)][side].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in members]
        starts = [s for s, _, _ in spans[1]]
        for s, e, i in spans[0]:
            links += [(i, j) for t, f, j in spans[1][max(bisect_left(starts, s) - 1, 0):bisect_left(starts, e)] if f > s and t < e]
        each.append((doc, len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        counts.update(set(links))
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(top.get(i, 0), n)
    return sorted(((doc, n_a, n_b, n_groups, len(links), sum(counts[x] == top[x[0]] for x in links), sum(counts[x] for x in links), digest)
                   for doc, n_a, n_b, n_groups, links, digest in each), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


TEXTS = st.lists(st.sampled_from([*"aAthesnßÉz'St0½².,<|>&\t\n\x85\xa0  \x1c▁\0\r", "Σ", "\u0301", "é", "日", "ſ", "\u3000", "🎉", "</s>", "<|endoftext|>"]),
                 max_size=40).map("".join)


@given(TEXTS)
@settings(max_examples=400, deadline=None)
def test_ids_are_the_tokenizers(text):
    want = brute_tokens(text)
    assert [x[0] for x in tools()[0].encode([text])] == [[i for i, _ in side] for side in want]


@given(st.lists(st.integers(1, 60), max_size=40), st.lists(st.integers(1, 60), max_size=40))
@settings(max_examples=300, deadline=None)
def test_common_ends_and_overlaps(one, other):
    a, b = sorted({*one, 100}), sorted({*other, 100})
    at_a, at_b = alignment.common_ends(a, b)
    common = sorted(set(a) & set(b))
    assert [a[i] for i in at_a] == common and [b[j] for j in at_b] == common
    import numpy as np

    i, j = alignment.overlaps(np.array(a), np.array(b))
    spans = [list(zip([0, *x], x, strict=False)) for x in (a, b)]
    want = [(p, q) for p, (s, e) in enumerate(spans[0]) for q, (t, f) in enumerate(spans[1]) if s < f and t < e]
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_very_long_stretches_and_the_other_library():
    pairs, a, _ = tools()
    assert pairs.ranked is not None
    for text in ("x" * 20_000, " " * 5_000 + "y", "ab" * 600 + " c", "é" * 3_000):
        assert pairs.ids_a(text) == a.encode(text, add_special_tokens=False).ids
        assert [len(x[0]) for x in pairs.encode([text])] == [len(x) for x in brute_tokens(text)]


def test_long_one_to_one_stretches():
    a = list(range(1, 5001))
    b = [x for x in a if x not in (17, 1800, 1801, 4097)]
    at_a, at_b = alignment.common_ends(a, b)
    assert [a[i] for i in at_a] == b and at_b.tolist() == list(range(len(b)))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert found(suite.QUERIES["op13_token_alignment"](spark, sf_dir)) == brute(rows)


def test_awkward_rows_in_small_blocks(spark):
    docs = documents(spark)
    extra = spark.createDataFrame([(50, "</s> <|endoftext|>"), (51, " two  blanks \n and a line end \n"), (52, "퟿ ▁ x"), (53, "🎉🎉 日本")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(alignment.alignment_report(docs, *PATHS)) == want
    assert found(alignment.alignment_report(docs.coalesce(1), *PATHS, block_links=1)) == want
    assert alignment.alignment_report(empty(spark, docs), *PATHS).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert found(alignment.alignment_report(nothing, *PATHS)) == brute([(1, None), (2, "")])
