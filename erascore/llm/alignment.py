"""Cross-tokenizer alignment: where two tokenizations of a text end together, and which of their tokens overlap.

Tokens are compared by the byte offsets at which they end. The aligner runs along the diagonal: while tokens correspond one to one the
two arrays of ends are equal at a constant index shift, so it compares ever longer stretches at that shift (twice as long
each time) and jumps over them whole; where they part it steps to the next common end, which closes an irregular group, and
goes on at the new shift. All overlapping pairs are then the stretches between neighbouring ends of either side.

Counts over the corpus -- in how many documents a pair of ids is linked -- are summed from blocks: a task gathers the links of a
bounded number of tokens, numbers the distinct pairs, and passes on one row for each with its number of documents. The counts
come back to a block the same way, so neither a document's links nor the table of pairs is ever broadcast or held whole.

Defined cases: a null or empty text, and a text whose joined token bytes on either side differ from a space and the text, has no
tokens: zeros and an empty digest; a null or repeated doc_id keeps its row, each row being a document; an empty table gives an empty
result; further columns are ignored; a text of any length is aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, staged
from .packing import _byte_letters

BLOCK = 1_000_000  # links of a block, at least; a block is cut between documents
_BATCH = 200_000  # characters that are aligned at once, at least
_SINGLE = 4  # tokens compared one by one before stretches are
_LONG = re.compile(r"\S{1000}|\s{200}")
#: How byte-level vocabularies split a text; a fixed value.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ID_BITS = 20  # of an id; a pair is the id by A, then that by B

_ROWS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at binary, times binary, "
         "pair long, number int, docs long")


class TokenPairs:
    """Ids of texts by both tokenizers, and the bytes of every id. A's merges are run by the library that reads them as ranks, where
    the file is such (ids in the order of the merges, the split pattern of byte-level vocabularies), else by A's own."""

    def __init__(self, path_a: str, path_b: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        to_byte = {chr(v): k for k, v in _byte_letters().items()}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.bytes_a), len(pieces)) > 1 << _ID_BITS:
            raise ValueError(f"a vocabulary has more than {1 << _ID_BITS} ids")
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.ranked = self._ranked()
        # an id in a digest's text, and what follows it: nothing, or a mark; those of B after those of A
        self.written = [f"{i}{mark}" for t in (self.bytes_a, self.bytes_b) for i in range(len(t)) for mark in ("", ",", "|", ";")]

    def _ranked(self):
        import tiktoken

        spec = json.loads(self.a.to_str())
        plain = spec["model"]["vocab"]
        merges = [plain.get("".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        splits = {k: v for k, v in (spec["pre_tokenizer"] or {}).items() if k != "trim_offsets"}
        if (spec["normalizer"] is not None or splits != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
                or None in merges or merges != sorted(merges) or len(merges) + 256 != len(plain) or min(merges, default=256) < 256):
            return None
        return tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks={self.bytes_a[i]: i for i in plain.values()}, special_tokens={})

    def ids_a(self, text: str) -> list:
        # the other library's pattern engine is not made for very long stretches
        if self.ranked is None or _LONG.search(text):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def encode(self, texts: list) -> tuple[list, list]:
        """Lists of ids by A and by B; both empty where either does not spell a space and the text."""
        texts = [t or "" for t in texts]
        all_a = [self.ids_a(" " + t) if t else [] for t in texts]
        all_b = self.b.encode(texts, num_threads=1) if texts else []
        for k, t in enumerate(texts):
            whole = (" " + t).encode()
            same = not t or b"".join(map(self.bytes_b.__getitem__, all_b[k])) == whole
            if same and t and self.ranked is None:  # merges of bytes keep them all
                same = b"".join(map(self.bytes_a.__getitem__, all_a[k])) == whole
            if not same:
                all_a[k] = all_b[k] = []
        return all_a, all_b


@lru_cache(maxsize=1)
def token_pairs(path_a: str, path_b: str) -> TokenPairs:
    """One memory for all tasks of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return TokenPairs(path_a, path_b)


def common_ends(a: list, b: list):
    """Indexes (i, j), as arrays, at which ascending ends ``a[i] == b[j]``; both arrays end at the same place.

    Diagonal run skipping, as the module's text says: single steps at first, then stretches that double."""
    import numpy as np

    n = len(a)
    a, b = [*a, -1], [*b, -2]  # which end every run
    first, shift, length = [], [], []
    i = j = 0
    while i < n:
        start = i
        while i - start < _SINGLE and a[i] == b[j]:  # the shift is j - i
            i, j = i + 1, j + 1
        if i - start == _SINGLE:
            step = _SINGLE
            while a[i:i + step] == b[j:j + step]:
                i, j, step = i + step, j + step, 2 * step
            while step > 1:  # the last stretch was too long: halve it
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i, j = i + step, j + step
        if i > start:
            first.append(start)
            shift.append(j - i)
            length.append(i - start)
        if i >= n:
            break
        x, y = a[i], b[j]
        while x != y:  # an irregular group: up to the next common end
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        first.append(i)
        shift.append(j - i)
        length.append(1)
        i, j = i + 1, j + 1
    length = np.array(length, np.int64)
    at = np.repeat(np.array(first, np.int64) - (np.cumsum(length) - length), length) + np.arange(length.sum())
    return at, at + np.repeat(np.array(shift, np.int64), length)


def overlaps(ends_a, ends_b):
    """(i, j) of all tokens that overlap, as arrays: one for each stretch between neighbouring ends."""
    import numpy as np

    size = int(ends_a[-1]) + 1 if len(ends_a) else 0
    a, b = np.zeros(size, bool), np.zeros(size, bool)
    a[ends_a], b[ends_b] = True, True
    ends = np.flatnonzero(a | b)
    return np.cumsum(a)[ends] - a[ends], np.cumsum(b)[ends] - b[ends]


def group_texts(tokens: TokenPairs, ids_a, ids_b, at_a, at_b, docs_of_groups) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document; groups end at the indexes ``at_a``, ``at_b``."""
    import numpy as np

    n, m = len(ids_a), len(ids_b)
    # in the text a group's tokens by A come first: those of B move behind them
    group_a = np.repeat(np.arange(len(at_a)), np.diff(at_a, prepend=-1))
    group_b = np.repeat(np.arange(len(at_b)), np.diff(at_b, prepend=-1))
    before_b = np.concatenate([[0], at_b[:-1] + 1])
    marks_a, marks_b = np.ones(n, np.int64), np.ones(m, np.int64)
    marks_a[at_a], marks_b[at_b] = 2, 3
    last = np.cumsum(docs_of_groups) - 1
    marks_b[at_b[last]] = 0
    codes = np.empty(n + m, np.int64)
    codes[np.arange(n) + before_b[group_a]] = 4 * ids_a + marks_a
    codes[np.arange(m) + (at_a + 1)[group_b]] = 4 * (ids_b + len(tokens.bytes_a)) + marks_b
    text, out, start = list(map(tokens.written.__getitem__, codes.tolist())), [], 0
    for end in (at_a[last] + at_b[last] + 2).tolist():
        out.append("".join(text[start:end]))
        start = end
    return out


def _aligned(tokens: TokenPairs, texts: list) -> tuple:
    """For each text (n_a, n_b, n_groups, n_links, digest), and the document number and pair of every link."""
    import numpy as np

    both = tokens.encode(texts)
    sizes = np.array([[len(x) for x in side] for side in both], np.int64).reshape(2, -1).T
    ids_a, ids_b = (np.fromiter(chain.from_iterable(side), np.int64, int(n)) for side, n in zip(both, sizes.sum(axis=0), strict=True))
    ends_a, ends_b = np.cumsum(tokens.length_a[ids_a]), np.cumsum(tokens.length_b[ids_b])  # over all texts: each ends on a common end
    at_a, at_b = common_ends(ends_a.tolist(), ends_b.tolist())
    last_a = np.cumsum(sizes[:, 0])
    groups = np.diff(np.searchsorted(at_a, last_a, "left"), prepend=0)
    some = np.flatnonzero(groups)
    digests = [""] * len(texts)
    for k, text in zip(some.tolist(), group_texts(tokens, ids_a, ids_b, at_a, at_b, groups[some]), strict=True):
        digests[k] = hashlib.sha256(text.encode()).hexdigest()
    i, j = overlaps(ends_a, ends_b)
    link_docs = np.searchsorted(last_a, i, "right")
    pairs = ids_a[i] << _ID_BITS | ids_b[j]
    links = np.bincount(link_docs, minlength=len(texts))
    return sizes, groups, links, digests, link_docs, pairs


def aligned(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK) -> DataFrame:
    """Rows of documents (their figures, and their distinct links as numbers in their block and how often each) and of blocks'
    pairs (pair, number, docs)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        tokens = token_pairs(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, types[t]) for n, t in (f.split() for f in _ROWS.split(", "))])
        rows: list[tuple] = []
        pairs_held: list = []
        times_held: list = []
        links = 0

        def done():
            sizes = [len(p) for p in pairs_held]
            pairs = np.concatenate(pairs_held)
            times = np.concatenate(times_held).astype("<i4")
            known, number = np.unique(pairs, return_inverse=True)
            docs_of = np.bincount(number, minlength=len(known))
            number, cuts = number.astype("<i4"), np.concatenate([[0], np.cumsum(sizes)])
            at = [number[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
            often = [times[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
            n, cols = len(rows), list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:7], strict=True)],
                 pa.array(at, pa.binary()), pa.array(often, pa.binary()), *[pa.nulls(n, f.type) for f in list(schema)[9:]]], schema=schema)
            k = len(known)
            if k:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * k, pa.int64()), *[pa.nulls(k, f.type) for f in list(schema)[1:9]],
                     pa.array(known), pa.array(np.arange(k, dtype=np.int32)), pa.array(docs_of)], schema=schema)

        def take(ids, texts):
            nonlocal links
            sizes, groups, n_links, digests, link_docs, pairs = _aligned(tokens, texts)
            keys = np.sort(link_docs << 2 * _ID_BITS | pairs)  # at most as many documents as a batch has rows
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            link_docs, pairs = keys[first] >> 2 * _ID_BITS, keys[first] & (1 << 2 * _ID_BITS) - 1
            times, cuts = np.diff(first, append=len(keys)), np.searchsorted(link_docs, np.arange(len(texts) + 1))
            for k, doc in enumerate(ids):
                rows.append((doc, int(sizes[k, 0]), int(sizes[k, 1]), int(groups[k]), int(n_links[k]), digests[k]))
                pairs_held.append(pairs[cuts[k]:cuts[k + 1]])
                times_held.append(times[cuts[k]:cuts[k + 1]])
            links += len(pairs)

        for batch in batches:
            ids, texts, chars = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append(text.as_py())
                chars += len(texts[-1] or "")
                if chars >= _BATCH:
                    take(ids, texts)
                    ids, texts, chars = [], [], 0
                    if links >= block_links:
                        yield from done()
                        rows, pairs_held, times_held, links, block = [], [], [], 0, block + 1
            if ids:
                take(ids, texts)
        if rows:
            yield from done()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, _ROWS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, count (documents that hold it linked) and best (whether no pair of its A id has a higher count)."""
    counts = blocks.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("count"))
    most = counts.groupBy(F.shiftright("pair", _ID_BITS).alias("id")).agg(F.max("count").alias("most"))
    return counts.join(most, F.shiftright("pair", _ID_BITS) == F.col("id")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    with scratch(docs.sparkSession):
        blocks = staged(aligned(docs, path_a, path_b, block_links), "alignment-blocks", "zstd")
        counts = staged(pair_counts(blocks), "alignment-counts")
        known = (blocks.where("pair IS NOT NULL").select("block", "number", "pair").join(counts, "pair")
                 .select(F.col("block").alias("of"), "number", "count", "best"))
        rows = blocks.where("pair IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times")
        rows = rows.withColumnRenamed("block", "in_block")

        def scored(left, right):
            import numpy as np
            import pyarrow as pa

            order = right.column("number").to_numpy()
            count, best = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            count[order], best[order] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
            sums = [[], []]
            for at, times in zip(left.column("at"), left.column("times"), strict=True):
                number, n = np.frombuffer(at.as_py(), "<i4"), np.frombuffer(times.as_py(), "<i4").astype(np.int64)
                sums[0].append(int((best[number] * n).sum()))
                sums[1].append(int((count[number] * n).sum()))
            kept = [left.column(c).combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            return pa.Table.from_arrays([*kept, pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), left.column("groups_sha256").combine_chunks()],
                                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        out = rows.groupBy("in_block").cogroup(known.groupBy("of")).applyInArrow(
            scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
        return staged(out, "alignment-report")
