"""Packing against the tokenizer itself."""

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from erascore.llm import packing, suite

from .frames import documents

PATH = suite.tokenizer_path()


@lru_cache
def both():
    return packing.WordIds(PATH), Tokenizer.from_file(PATH)


@given(st.text(alphabet=st.sampled_from(list("aAbßÉµªz'sSt0½²._,<|>&\t\n\x85\xa0 \x1c") + ["Σ", "ς", "\u0301", "é", "日", "İ", "ſ"]), max_size=30))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_tokenizers(text):
    words, own = both()
    assert np.frombuffer(words.encode(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


def test_special_tokens_inside_texts():
    words, own = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for text in ("a<|endoftext|>b", "<|ENDOFTEXT|>", "x <|startoftext|> y", "O'Neil's don't"):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


def test_bounded_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 3)
    words, own = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    text = "some words and some more words, and again some other words"
    assert np.frombuffer(words.encode(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_slots_place_every_piece_once(histogram):
    slots = packing.shortest_pack_first(histogram, 64)
    ranks, filled = defaultdict(list), defaultdict(list)
    for length, rank, n, first, used in slots:
        for i in range(n):
            ranks[length].append(rank + i)
            filled[first + i].append((used, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert sorted(filled) == list(range(len(filled)))
    for parts in filled.values():
        at = 0
        for used, length in sorted(parts):
            assert used == at
            at += length
        assert at <= 64


def brute(rows):
    own = Tokenizer.from_file(PATH)
    return [(d, [*own.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]


def check(packed, rows, capacity):
    pieces = defaultdict(list)
    filled = defaultdict(list)
    for r in packed:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for doc, ids in brute(rows):
        want[doc, len(ids)].append(ids)
    assert set(pieces) == set(want)
    for name, docs in want.items():
        crcs = sorted((s, min(capacity, len(ids) - s), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes())) for ids in docs for s in range(0, len(ids), capacity))
        assert sorted(pieces[name]) == crcs
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(capacity - sum(n for _, n in p) for p in filled.values())


def test_awkward_documents(spark):
    frame = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    check(packing.with_crc(packing.pack(frame, PATH, capacity=64)).collect(), rows, 64)
    assert packing.pack(frame.limit(0), PATH).collect() == []


def test_whole_table_with_little_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    packed = suite.QUERIES["op2_packing"](spark, sf_dir).collect()
    padding = check(packed, rows, 4096)
    assert padding <= 0.05 * sum(r["length"] for r in packed)


def test_places_joined_without_a_broadcast(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    spark.conf.set("spark.erascore.broadcast.maxBytes", "0")
    try:
        packed = packing.pack(docs.repartition(5), PATH, 64).collect()
    finally:
        spark.conf.unset("spark.erascore.broadcast.maxBytes")
    check(packed, rows, 64)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in packed)
