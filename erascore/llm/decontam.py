"""Benchmark decontamination by latent semantic retrieval.

Benchmark passages form TF-IDF matrices (document frequencies over all documents, the root of the idf as weight), one for each
block of passages. The leading right singular vectors are found by a randomised SVD on Spark: a range finder
``Y = A (A' A G)`` on distributed sparse rows, with only the small Gram matrices on the driver. Each word then has a
latent vector. Documents are read as overlapping windows a third longer than the passage, one from every ``STEP``-th word on.
Candidates are the windows near the passage by the cosine in the latent space. The bound is each passage's own: a window that
verification could accept holds ``PARAPHRASE`` of the passage's words, and shows at least as much of the passage as those of
its words that weigh least; ``SLACK`` of that is asked for, as the dimensions left out blur it.

A candidate is verified on the document's words around it: by the words in common, then by the longest common subsequence with
the passage (``COPY`` of its words or more: a copy), or as a paraphrase (``PARAPHRASE`` or more, and the passage's answer found
whole and in order). The answer is what follows the last ``Answer:`` or ``A:``, else the last sentence.

A space is fitted on a block of at most ``BLOCK`` passages, and one scan of the documents serves the blocks of
``SCAN_WORDS`` words of passages, so what is sent to the tasks is bounded; every word of every document is searched.

Defined cases: null or wordless texts and items contain nothing; a passage of fewer than ``MIN_WORDS`` words is a copy where
its words stand in a document in a row; repeated rows of the benchmark count once, of the documents once per doc_id; empty
tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, staged, text_or_empty

OVERSAMPLE, SEED = 8, 7
#: Dimensions of a block's space: this share of its passages; all of them up to MIN_RANK passages.
RANK_SHARE, MIN_RANK = 0.8, 64
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.9
#: Passages of fewer words are sought word for word. BLOCK passages share a latent space, SCAN_WORDS words of passages a scan.
MIN_WORDS, BLOCK, SCAN_WORDS = 8, 256, 100_000
#: What a candidate must show of the least that a verified window would show were no dimension left out.
SLACK = 0.85
#: Windows begin at every STEP-th word.
STEP = 8
#: Blocks of STEP words whose windows are held at a time.
SEGMENT = 4096
_WORD = re.compile(r"\w+")
#: Latin-1 characters as they are in words, else a space.
_LETTERS = bytes(c if _WORD.match(chr(c)) else 32 for c in range(256))


def words_of(text: str | None) -> list[str]:
    """``\\w+`` of the lower-cased text; Latin-1 texts, the most, are split without the pattern."""
    text = (text or "").lower()
    try:
        return text.encode("latin-1").translate(_LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(text)


def answer_of(text: str | None) -> list[str]:
    text = (text or "").rstrip()
    marked = re.split(r"(?i)\b(?:answer|a)\s*:", text)
    if len(marked) > 1:
        return words_of(marked[-1])
    sentences = [s for s in re.split(r"[.!?]+(?=\s|$)", text) if words_of(s)]
    return words_of(sentences[-1]) if sentences else []


def common_words(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows over ``a``."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def document_frequencies(docs: DataFrame, vocabulary) -> DataFrame:
    """(word, docs): in how many documents each word of the broadcast vocabulary occurs; counted per task first."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = vocabulary.value
        count = dict.fromkeys(known, 0)
        total = 0
        for batch in batches:
            for text in batch.column(0):
                total += 1
                for w in known.keys() & words_of(text.as_py()):
                    count[w] += 1
        found = {w: n for w, n in count.items() if n} | {"": total}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "docs"])

    each = docs.select(text_or_empty().alias("text")).mapInArrow(rows, "word string, docs long")
    return each.groupBy("word").agg(F.sum("docs").alias("docs"))


def _sum_vectors(df: DataFrame, key: str, terms: str = "term") -> DataFrame:
    """The sum of the vectors of each key: coordinates are summed one by one, so that Spark combines them per task."""
    flat = df.select(key, F.posexplode(terms).alias("k", "v"))
    summed = flat.groupBy(key, "k").agg(F.sum("v").alias("v"))
    return summed.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("vec"))


def _gram(vectors: DataFrame, size: int) -> np.ndarray:
    """The sum of the outer products of the vectors: one small matrix from each task, added here."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        acc = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).flatten(), float).reshape(batch.num_rows, size)
                acc += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([acc.ravel().tolist()], pa.list_(pa.float64()))], ["m"])

    parts = vectors.select("vec").mapInArrow(rows, "m array<double>").select(F.posexplode("m").alias("k", "v"))
    summed = parts.groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size * size)
    for r in summed:
        out[r["k"]] = r["v"]
    return out.reshape(size, size)


def _times(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """Each vector times a small matrix."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column(1).flatten(), float).reshape(batch.num_rows, matrix.shape[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((x @ matrix).tolist(), pa.list_(pa.float64()))], [key, "vec"])

    return vectors.select(key, "vec").mapInArrow(rows, f"{vectors.select(key).schema.simpleString()[7:-1].replace(':', ' ')}, vec array<double>")


def _inverse_root(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (largest first) above noise, and the matrix that makes the gram's vectors orthonormal."""
    value, vec = np.linalg.eigh(gram)
    keep = value > max(value.max(initial=0) * 1e-10, 1e-300)
    value, vec = value[keep][::-1], vec[:, keep][:, ::-1]
    return value, vec / np.sqrt(value)


def randomised_svd(entries: DataFrame, rank: int, oversample: int = OVERSAMPLE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Right singular vectors (word, vec) and singular values of the sparse matrix ``entries`` (row, word, value).

    One power iteration. Rows and word vectors stay distributed; the driver sees Gram matrices of the rank's size."""
    size = rank + oversample

    def gauss(word):
        import xxhash

        return np.random.Generator(np.random.Philox(xxhash.xxh64_intdigest(word, seed))).standard_normal(size)

    def seeds(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([gauss(w).tolist() for w in batch.column(0).to_pylist()], pa.list_(pa.float64()))], ["word", "vec"])

    def rows_of(word_vectors: DataFrame) -> DataFrame:
        weighed = entries.join(word_vectors, "word").select("row", F.transform("vec", lambda v: v * F.col("value")).alias("term"))
        return staged(_sum_vectors(weighed, "row"), "svd-rows")

    def words_from(row_vectors: DataFrame) -> DataFrame:
        weighed = entries.join(row_vectors, "row").select("word", F.transform("vec", lambda v: v * F.col("value")).alias("term"))
        return staged(_sum_vectors(weighed, "word"), "svd-words")

    omega = entries.select("word").distinct().mapInArrow(seeds, "word string, vec array<double>")
    sketch = rows_of(words_from(rows_of(omega)))
    _, basis = _inverse_root(_gram(sketch, size))
    q = staged(_times(sketch, "row", basis), "svd-q")
    b = words_from(q)  # B' = A' Q, a vector for each word
    value, right = _inverse_root(_gram(b, basis.shape[1]))
    return staged(_times(b, "word", right[:, :rank]), "svd-right"), np.sqrt(value[:rank])


class Space(NamedTuple):
    """The latent space of a block of passages, and what verification asks of each."""

    number: np.ndarray  # the row of each word sent to the tasks
    matrix: np.ndarray  # weighted latent vectors of the words; the last row, of unknown words, is zero
    unit: np.ndarray  # latent vectors of the passages, of length one
    norm: np.ndarray  # their lengths before
    least: np.ndarray  # the share of its length that a passage must show in a window
    blocks: np.ndarray  # blocks of a window
    need: np.ndarray  # words in common without which no window is verified
    times: np.ndarray  # (passage, word): how often it has it
    passages: list  # (item_id, words, answer)


def space_of(items: list[tuple], known: dict[str, int], latent: dict[str, np.ndarray], weight: dict[str, float],
             need_share: float, slack: float = SLACK) -> Space:
    """The space of ``items`` (item_id, words, answer); ``latent``: word -> vector.

    A window that is verified holds at least ``need_share`` of the passage's words. The least it then shows of the passage is
    what the passage's lightest words show: that, times ``slack``, is asked of a candidate."""
    names = sorted(latent)
    own = {w: i for i, w in enumerate(names)}
    number = np.full(len(known) + 1, len(names), np.int32)
    number[[known[w] for w in names]] = np.arange(len(names))
    rank = len(latent[names[0]])
    matrix = np.array([latent[w] * weight[w] for w in names] + [np.zeros(rank)], np.float32)
    vec, least, blocks, need = [], [], [], []
    times = np.zeros((len(items), len(names) + 1), np.uint16)
    for i, (_, words, _) in enumerate(items):
        vec.append(matrix[[own[w] for w in words]].sum(axis=0))
        for w, n in Counter(words).items():
            times[i, own[w]] = min(n, 65_535)
        need.append(next(n for n in range(len(words) + 1) if n / len(words) >= need_share))
        light = sorted(words, key=lambda w: (weight[w], w))[:need[-1]]
        square = max(float(vec[-1] @ vec[-1]), 1e-30)
        least.append(slack * max(float(matrix[[own[w] for w in light]].sum(axis=0) @ vec[-1]) / square, 0.0))
        blocks.append(-(-(len(words) + len(words) // 3 + STEP - 1) // STEP))
    vec = np.array(vec, np.float32)
    norm = np.maximum(np.sqrt((vec**2).sum(axis=1)), 1e-15)
    return Space(number, matrix, vec / norm[:, None], norm, np.array(least, np.float32), np.array(blocks), np.array(need), times, items)


def in_common(laid: np.ndarray, low: np.ndarray, high: np.ndarray, width: int, item: np.ndarray, space: Space) -> np.ndarray:
    """How many words of its passage, with their number in it, each stretch [low, high) of at most ``width`` words has;
    where even all places of such words are too few, their number."""
    out = np.empty(len(item), np.int64)
    unknown, step = len(space.matrix) - 1, max(1, 500_000 // width)
    times = space.times.ravel()
    for at in range(0, len(item), step):
        part = slice(at, at + step)
        words = laid.take(low[part, None] + np.arange(width), mode="clip")
        words[np.arange(width) >= (high - low)[part, None]] = unknown
        held = times.take(words + item[part, None] * (unknown + 1)) > 0
        out[part] = np.count_nonzero(held, axis=1)
        able = np.flatnonzero(out[part] >= space.need[item[part]])
        key, count = np.unique((able[:, None] * (unknown + 1) + words[able])[held[able]], return_counts=True)
        who, word = np.divmod(key, unknown + 1)
        kept = np.minimum(count, space.times[item[part][who], word])
        out[at + able] = np.bincount(who, kept, minlength=len(words))[able].astype(np.int64)
    return out


def candidates(at: list[np.ndarray], space: Space) -> dict:
    """(text, passage) -> (words in common, first word, end, cosine) of the windows near the passage in the latent space.

    A window begins at each block of STEP words and is a third longer than the passage. It is a candidate where its
    cosine to the passage, for a window longer than the passage taken as if it were as long, reaches ``least``; then where it
    has, with half a passage around it, the words in common that a verdict needs."""
    unknown = len(space.matrix) - 1
    sizes = np.array([-(-len(x) // STEP) for x in at])
    first = np.cumsum(sizes) - sizes
    total, longest = int(sizes.sum()), int(space.blocks.max())
    laid = np.full(total * STEP, unknown, np.int32)
    for begin, x in zip(first * STEP, at, strict=True):
        laid[begin:begin + len(x)] = space.number[x]
    asked = space.least * space.norm
    owner = np.repeat(np.arange(len(at)), sizes)
    bound = (first + sizes)[owner]  # the block behind a block's text
    found: dict = {}
    for lo in range(0, total, SEGMENT):
        hi, top = min(lo + SEGMENT, total), min(lo + SEGMENT + longest, total)
        sums = np.zeros((top - lo + 1, space.matrix.shape[1]), np.float32)
        for some in range(lo, top, 64):
            end = min(some + 64, top)
            vectors = space.matrix.take(laid[some * STEP:end * STEP], axis=0)
            vectors.reshape(end - some, STEP, -1).sum(axis=1, out=sums[some - lo + 1:end - lo + 1])
        np.cumsum(sums, axis=0, out=sums)
        start = np.arange(lo, hi)
        for blocks in np.unique(space.blocks):
            mine = np.flatnonzero(space.blocks == blocks)
            end = np.minimum(start + blocks, bound[lo:hi])
            window = sums[end - lo] - sums[:hi - lo]
            length = np.sqrt(np.einsum("ij,ij->i", window, window))
            shown = window @ space.unit[mine].T
            block, which = np.divmod(np.flatnonzero(shown >= asked[mine]), len(mine))
            near = shown[block, which] >= space.least[mine][which] * length[block]
            block, which = block[near], which[near]
            if not len(block):
                continue
            item, text = mine[which], owner[lo + block]
            around = np.array([len(space.passages[i][1]) // 2 for i in mine])[which]
            low = np.maximum((lo + block) * STEP - around, first[text] * STEP)
            high = np.minimum(end[block] * STEP + around, bound[lo + block] * STEP)
            common = in_common(laid, low, high, int((high - low).max()), item, space)
            for j in np.flatnonzero(common >= space.need[item]):
                begin = int(lo + block[j] - first[text[j]]) * STEP
                cosine = float(shown[block[j], which[j]] / max(length[block[j]], 1e-15))
                place = (int(common[j]), begin, begin + int(end[block[j]] - lo - block[j]) * STEP, cosine)
                found.setdefault((int(text[j]), int(item[j])), []).append(place)
    return found


def verbatim(at: np.ndarray, anchors: dict) -> set:
    """The short passages that a text holds word for word. anchors: a word of each -> (its place, the words, the passage)."""
    found: set = set()
    for place in np.flatnonzero(np.isin(at, list(anchors))) if anchors else ():
        for before, words, item in anchors[int(at[place])]:
            begin = int(place) - before
            if item not in found and begin >= 0 and at[begin:begin + len(words)].tolist() == words:
                found.add(item)
    return found


def verdict(words: list[str], passage: list[str], reply: list[str], ranges: list, copy: float, paraphrase: float, answer: float) -> tuple | None:
    """The best (lcs, answer) of the windows that hold the passage; those with the most words in common are tried first."""
    best = None
    for common, begin, end, _ in sorted(ranges, reverse=True):
        if best and (common < best[0] * len(passage) or best[0] == 1 and best[1] == (1 if reply else 0)):
            break
        around = words[max(0, begin - len(passage) // 2):end + len(passage) // 2]
        lcs = common_words(passage, around) / len(passage)
        got = common_words(reply, around) / len(reply) if reply else 0.0
        if lcs >= copy or lcs >= paraphrase and got >= answer:
            best = max(best or (), (lcs, got))
    return best


def search(docs: DataFrame, spaces: list[Space], known: dict[str, int], short: list[tuple],
           copy: float = COPY, paraphrase: float = PARAPHRASE, answer: float = ANSWER) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, kind): the best verified window of each document and passage.

    short: (item_id, words) of the passages sought word for word. All is sent to the tasks."""
    anchors: dict = {}
    for item_id, words in short:
        place = max(range(len(words)), key=lambda i: (len(words[i]), -i))  # a long word is rarely a common one
        anchors.setdefault(known[words[place]], []).append((place, [known[w] for w in words], item_id))
    sent = docs.sparkSession.sparkContext.broadcast((known, spaces, anchors))

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known, spaces, anchors = sent.value
        unknown = len(known)

        def verified(texts: list[tuple]) -> pa.RecordBatch:
            out: list[tuple] = []
            for doc, _, at in texts:
                out += [(doc, item_id, 1.0, 1.0, 1.0, "copy") for item_id in verbatim(at, anchors)]
            for space in spaces if texts else ():
                for (t, i), ranges in candidates([x[2] for x in texts], space).items():
                    item_id, passage, reply = space.passages[i]
                    best = verdict(texts[t][1], passage, reply, ranges, copy, paraphrase, answer)
                    if best:
                        kind = "copy" if best[0] >= copy else "paraphrase"
                        out.append((texts[t][0], item_id, round(max(r[3] for r in ranges), 4), round(best[0], 4), round(best[1], 4), kind))
            cols = zip(*out, strict=True) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "cosine", "lcs", "answer", "kind"])

        for batch in batches:
            held, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                if words:
                    held.append((doc, words, np.fromiter(map(known.get, words, repeat(unknown)), np.int64, len(words))))
                    size += len(words)
                if size > 40_000:
                    yield verified(held)
                    held, size = [], 0
            yield verified(held)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    hits = texts.mapInArrow(rows, "doc_id long, item_id long, cosine double, lcs double, answer double, kind string")
    best = F.max(F.struct("lcs", "answer", "cosine", "kind")).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.lcs", "best.answer", "best.kind")


def _groups(bench: DataFrame, words: int) -> Iterator[list[tuple]]:
    """The passages (item_id, words, answer) that one scan of the documents serves: as many as ``words`` words, one at least."""
    group, size = [], 0
    for r in bench.toLocalIterator():
        found = words_of(r["text"])
        if group and size + len(found) > words:
            yield group
            group, size = [], 0
        if found:
            group.append((r["item_id"], found, answer_of(r["text"])))
            size += len(found)
    if group:
        yield group


def rank_for(items: int, share: float = RANK_SHARE, least: int = MIN_RANK) -> int:
    return min(items, max(least, int(np.ceil(share * items))))


def contaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK, share: float = RANK_SHARE, least: int = MIN_RANK,
                 scan_words: int = SCAN_WORDS) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, kind) of every document that holds a benchmark passage."""
    spark: SparkSession = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).distinct()
    bench = staged(bench.orderBy("item_id", "text"), "decontam-passages")
    out = None
    for group in _groups(bench, scan_words):
        known = {w: i for i, w in enumerate(dict.fromkeys(w for _, words, _ in group for w in words))}
        vocabulary = spark.sparkContext.broadcast(dict.fromkeys(known))
        counts = {r["word"]: r["docs"] for r in document_frequencies(docs, vocabulary).collect()}  # the group's words
        total = counts.get("", 0)
        weight = {w: float(np.sqrt(np.log((1 + total) / (1 + counts.get(w, 0))) + 1e-3)) for w in known}
        whole = [x for x in group if len(x[1]) >= MIN_WORDS]
        spaces = []
        for at in range(0, len(whole), block):
            items = whole[at:at + block]
            tf = [(row, w, n * weight[w]) for row, (_, words, _) in enumerate(items) for w, n in Counter(words).items()]
            with scratch(spark):
                entries = staged(spark.createDataFrame(tf, "row long, word string, value double"), "svd-entries")
                right, _ = randomised_svd(entries, rank_for(len(items), share, least))
                latent = {r["word"]: np.array(r["vec"]) for r in right.collect()}  # the block's words
            spaces.append(space_of(items, known, latent, weight, min(COPY, PARAPHRASE)))
        hits = search(docs, spaces, known, [x[:2] for x in group if len(x[1]) < MIN_WORDS])
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs double, answer double, kind string")
    return out
