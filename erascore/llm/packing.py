"""Sequence packing: shortest-pack-first over the length histogram.

Documents become pieces of at most ``capacity`` ids (a longer document is cut every ``capacity`` ids).
The histogram of piece lengths -- at most ``capacity`` rows, whatever the corpus -- is packed on the driver:
lengths are placed longest first, each into the shortest packs that exist, many equal packs at a time,
so that a pattern's count changes, not single packs. The slots that result are joined back to the pieces
by (length, rank); a task ranks the pieces it tokenizes and the tasks before it shift its ranks, so a length that holds a third
of all pieces is ranked by all of them.

Defined cases: a null or empty text has only its end id; repeated rows and repeated ids are documents of
their own; an empty table gives an empty result; further columns are ignored; a document of any length is
cut, none is dropped.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import sys
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.sizing import broadcast_if_at_most
from .common import staged, text_or_empty

CAPACITY = 4096
END_ID = 2
#: ``ids`` are little-endian unsigned 32-bit numbers (``numpy.frombuffer(ids, "<u4")``).
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, task long, own long"

#: Character classes of Latin-1 as Unicode has them; fixed values of the tokenizer's split pattern.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_CACHED = 50_000  # in a memory, and as many from before
_LONGEST = 500  # characters of a word that the library of ranks gets


def _byte_letters() -> dict[int, int]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return dict(zip(plain, plain, strict=True)) | {b: 256 + i for i, b in enumerate(rest)}


class Remembered(dict):
    """A bounded memory of ``make(key)``: when full, what was asked for since the last time stays, the rest goes."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key: str):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= _CACHED:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Ids of texts. A Latin-1 text is split into words here and all its words are merged at once by the library that reads merges as
    ranks; of any other text, stretches between blanks are taken one by one, since no token spans a blank, and what is not ASCII
    or may hold a special token goes to the tokenizer whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model, letters = self.tokenizer.model, _byte_letters()

        def word(w: str) -> tuple:
            as_bytes = w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(letters)
            return tuple([t.id for t in model.tokenize(as_bytes)])

        self.words = Remembered(word)
        self._read_ranks()

    def _read_ranks(self) -> None:
        """Merges as ranks. A word's last byte and the word's end are one symbol from the start: a zero byte stands for the end and
        its merges come before all others."""
        import numpy as np
        import tiktoken

        spec = json.loads(self.tokenizer.to_str())["model"]
        to_byte = {chr(v): k for k, v in _byte_letters().items()}

        def spelled(token: str) -> bytes:
            inner = token.removesuffix(spec["end_of_word_suffix"])
            return bytes(to_byte[c] for c in inner) + b"\0" * (inner != token)

        letters, suffix = _byte_letters(), spec["end_of_word_suffix"]
        order = [*[chr(letters[b]) + suffix for b in range(256)], *[chr(letters[b]) for b in range(256)],
                 *["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["merges"]]]
        ranks: dict[bytes, int] = {}
        ids = np.zeros(len(order), "<u4")
        for rank, token in enumerate(order):
            if spelled(token) not in ranks:
                ranks[spelled(token)], ids[rank] = rank, spec["vocab"][token]
        self.ids = ids
        self.ranked = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The text's ids, as little-endian unsigned 32-bit numbers."""
        try:
            text.encode("latin-1")
            plain = "<|" not in text
        except UnicodeEncodeError:
            plain = False
        if plain:
            words = _WORDS.findall(text.lower())
            if not words:
                return b""
            if "\0" in text or max(map(len, words)) > _LONGEST:
                return _as_bytes(chain.from_iterable(map(self.words.__getitem__, words)))
            return self.ids[self.ranked.encode_to_numpy("\0".join(words) + "\0", disallowed_special=())].tobytes()
        return b"".join(self.encode(stretch) if stretch.isascii() and "<|" not in stretch
                        else _as_bytes(self.tokenizer.encode(stretch, add_special_tokens=False).ids)
                        for stretch in text.replace("\n", " ").split(" ") if stretch)


def _as_bytes(ids: Iterable[int]) -> bytes:
    raw = array("I", ids)
    if sys.byteorder == "big":
        raw.byteswap()
    return raw.tobytes()


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One memory for all tasks of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def tokenized(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Pieces of every document's ids: doc_id, start, length, ids (null unless kept), ids_crc32, doc_tokens, and which of
    its task's pieces of that length each is (task, own)."""

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        words, task, end = word_ids(tokenizer), TaskContext.get().partitionId(), _as_bytes([end_id])
        schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in (f.split()[0] for f in PIECE_SCHEMA.split(", "))])
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows, held = [[] for _ in schema], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = words.encode(text.as_py()) + end
                n = len(raw) // 4
                for start in range(0, n, capacity):
                    part = raw[4 * start:4 * (start + capacity)] if n > capacity else raw
                    length = len(part) // 4
                    piece = (doc, start, length, part if keep_ids else None, crc32(part), n, task, seen[length])
                    seen[length] += 1
                    for col, value in zip(rows, piece, strict=True):
                        col.append(value)
                held += n if keep_ids else 1
                if held > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)
                    rows, held = [[] for _ in schema], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(pieces, StructType.fromDDL(PIECE_SCHEMA))


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, count, first sequence, offset): the pieces of that length with these ranks go to
    as many consecutive sequences, at that offset.

    Open packs are kept as runs of equal packs (used, first sequence, packs). Longest lengths come first; each
    is put on the shortest run while it fits, splitting the run when fewer pieces are left than packs."""
    open_runs: list[tuple[int, int, int]] = []
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if open_runs and open_runs[0][0] + length <= capacity:
                used, first, packs = heapq.heappop(open_runs)
                taken = min(packs, left)
                if packs > taken:
                    heapq.heappush(open_runs, (used, first + taken, packs - taken))
            else:
                used, first, taken = 0, sequences, left
                sequences += taken
            slots.append((length, rank, taken, first, used))
            if used + length < capacity:
                heapq.heappush(open_runs, (used + length, first, taken))
            rank, left = rank + taken, left - taken
    return slots


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Every piece and its place: doc_id, start, length, ids (where kept), ids_crc32, doc_tokens, sequence_id, offset.

    A piece's rank among those of its length is its rank in its task and the number of such pieces in the tasks before; so no piece
    is moved. The numbers, one for each task and length it has, are broadcast up to the session's limit, beyond which
    they are joined."""
    pieces = staged(tokenized(docs, tokenizer, capacity, end_id, keep_ids), "packing-pieces", "zstd")
    sizes = staged(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "packing-sizes")
    histogram = {r["length"]: (r["n"], r["tasks"]) for r in
                 sizes.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("tasks")).collect()}
    slots = shortest_pack_first({k: n for k, (n, _) in histogram.items()}, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("length").alias("in_length"), F.col("task").alias("in_task"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = broadcast_if_at_most(bases, sum(tasks for _, tasks in histogram.values()), 48)
    ranked = pieces.join(bases, (F.col("length") == F.col("in_length")) & (F.col("task") == F.col("in_task")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("own"))
    places = docs.sparkSession.createDataFrame(slots or [(0, 0, 0, 0, 0)], "slot_length long, first_rank long, n long, first_sequence long, used long")
    placed = ranked.join(F.broadcast(places),  # a few rows for each length at most
                         (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank"))
                         & (F.col("rank") < F.col("first_rank") + F.col("n")))
    return placed.select("doc_id", "start", "length", *["ids"] * keep_ids, "ids_crc32", "doc_tokens",
                         (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
                         F.col("used").alias("offset"))


def with_crc(packed: DataFrame) -> DataFrame:
    """The pieces without their ids."""
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
