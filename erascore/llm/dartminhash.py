"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification.

A text is the weighted set of its five-word shingles (weight: how often one occurs). DartMinHash throws
darts: a Poisson process of hashed points over (shingle, weight, rank), the same for every text. A text is hit by the
darts within the weights of its shingles and within the first ranks that its total weight calls for; each dart
names a coordinate of the signature, and the earliest rank of a coordinate is kept. Two texts agree in a
coordinate with the probability of their weighted Jaccard similarity. The work is that of the text's length
plus the darts, not their product.

Bands of coordinates make buckets. Inside a bucket no pairs are enumerated: each round verifies the members
against a few leaders, joins what is similar into components, and keeps only the buckets whose members still
lie in several components, without the leaders that were tried. Of the pairs of two components a few are named, as one
link joins them; where that does not, their leaders stay and more are named. Rounds end when no bucket is left, so
every pair of a bucket was either found in one component, ruled out by its summaries or compared. Summaries of texts of up to
``BINNED`` shingles count these by bins, which bounds what two texts share from above and rules out no pair at the threshold; longer ones
are ruled out by their signatures (``AGREE``): but for 2e-5 of those at the threshold, the components are those that all pairs would give.

Words are ``\\w+`` of the lower-cased text; a text of one to four words is one shingle; a text without words
equals only the same text. Equal texts are one node. Similarity of ``threshold`` or more, computed exactly,
is a link. A class is a component; its id is its smallest doc_id.

Defined cases: a null text is empty; a null doc_id gets the class of its text (null only where all are); repeated rows
come back as often as they came in; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, scratch, sized, staged, staged_with, text_or_empty

SHINGLE, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8**5)**25 = 5e-5.
BANDS, ROWS = 25, 5
#: Pairs whose signatures agree less than this are not verified: 4.2 standard deviations below the threshold, which a
#: pair at the threshold misses with probability 2e-5.
AGREE = THRESHOLD - 4.2 * (THRESHOLD * (1 - THRESHOLD) / (BANDS * ROWS)) ** 0.5
#: Texts of up to so many shingles (repeats included) are compared by counts in coarse, then in fine bins, longer ones by signatures.
BINNED, _BINS = 2048, (256, 2048)
_GATHERED = 4096  # pairs whose bins are held at once
_PAIRS = 2**16  # pairs that are compared at once
_BLOCK = 1024  # members of a bucket that meet its leaders in one task
#: Pairs of the same two classes that a task names in a round.
_TRIES = 8
_WORD = re.compile(r"\w+")
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's different shingles, sorted, and their weights."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(size, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for i in range(size):
        out = _mix(out * _GOLD + h[i:len(h) - size + 1 + i])
    return np.unique(out, return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    union = int(a[1].sum() + b[1].sum()) - both
    return both / union if union else 0.0


def _slices() -> Iterator[tuple[int, float, float]]:
    """The rank axis: 0, 1/16, 1/8, ... 16, 32, 48, ... with a number for each slice."""
    low, high, number = 0.0, 2.0**-4, 0
    while True:
        yield number, low, high
        low, number = high, number + 1
        high = min(2 * high, high + 16.0)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """For each weighted set (none empty) and coordinate the hash of the earliest dart.

    Whether a strip (an element's w-th unit of weight) has darts in a slice of ranks, and where, follows from hashes
    of (element, w, slice) alone. Slices are added until a set's expected darts reach k ln k + 2k
    and each of its coordinates has one."""
    n_sets, totals = len(sets), np.array([int(w.sum()) for _, w in sets])
    weights = np.concatenate([w for _, w in sets])
    strip = np.repeat(np.concatenate([e for e, _ in sets]), weights)
    nth = np.arange(len(strip)) - np.repeat(np.cumsum(weights) - weights, weights)
    strip = _mix(strip + nth.astype(np.uint64) * _GOLD)
    owner = np.repeat(np.arange(n_sets), totals)
    rank, name = np.full(n_sets * k, np.inf), np.zeros(n_sets * k, np.uint64)
    enough = (k * np.log(k) + 2 * k) / totals
    for number, low, high in _slices():
        active = (low < enough) | np.isinf(rank.reshape(n_sets, k)).any(axis=1)
        if not active.any():
            return name.reshape(n_sets, k)
        if not active.all():
            here = active[owner]
            strip, owner = strip[here], owner[here]
        mean = high - low
        base = _mix(strip ^ _mix(np.full(1, number + 1, np.uint64)))
        u, n = _unit(base), np.zeros(len(base), np.int64)
        live, p, step = np.arange(len(base)), np.exp(-mean), 0  # Poisson by inversion
        acc = p
        while len(live := live[u[live] > acc]) and p > 1e-300:
            n[live] += 1
            step += 1
            p *= mean / step
            acc += p
        serial = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        dart = _mix(np.repeat(base, n) + (serial.astype(np.uint64) + np.uint64(1)) * _GOLD)
        at = low + mean * _unit(_mix(dart ^ _M1))
        place = np.repeat(owner, n) * k + (_mix(dart ^ _M2) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, at))[::-1]  # the earliest is written last
        best, names = np.full(n_sets * k, np.inf), np.zeros(n_sets * k, np.uint64)
        best[place[order]], names[place[order]] = at[order], dart[order]
        new = best < rank
        rank[new], name[new] = best[new], names[new]


def bands(sig: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """The bucket of each band of signatures, a row for each set."""
    sig = sig.reshape(len(sig), n_bands, rows)
    out = np.tile(_mix(np.arange(n_bands, dtype=np.uint64) * _GOLD + np.uint64(1)), (len(sig), 1))
    for r in range(rows):
        out = _mix(out * _GOLD + sig[:, :, r])
    return out.view(np.int64)


def summaries(sets: list[tuple[np.ndarray, np.ndarray]], sig: np.ndarray, threshold: float = THRESHOLD) -> list[bytes]:
    """What each set's pairs are ruled out by: its size, then two bytes of each shingle's hash, repeats included (sizes up to
    ``BINNED``), then a byte of each coordinate (sizes that may be similar to some beyond ``BINNED``)."""
    low, out = (sig & np.uint64(255)).astype(np.uint8), []
    for (elements, weights), c in zip(sets, low, strict=True):
        n = int(weights.sum())
        hashes = np.repeat(elements >> np.uint64(48), weights).astype("<u2").tobytes() if n <= BINNED else b""
        out.append(n.to_bytes(4, "little") + hashes + (c.tobytes() if n >= threshold * BINNED else b""))
    return out


def _opened(found: list[bytes], threshold: float) -> tuple[np.ndarray, ...]:
    """Sizes, shingle counts in ``_BINS`` coarse and fine bins and what these could not hold, and coordinates of summaries; zeros where one has none."""
    sizes = np.frombuffer(b"".join([x[:4] for x in found]), "<u4").astype(np.int64)
    coarse, fine = _BINS
    counts, low = np.zeros((len(found), fine), np.uint8), np.zeros((len(found), BANDS * ROWS), np.uint8)
    has, long = np.flatnonzero(sizes <= BINNED), np.flatnonzero(sizes >= threshold * BINNED)
    for part in np.split(has, np.flatnonzero(np.diff(np.cumsum(sizes[has]) // 2**20)) + 1):  # so many hashes at once
        hashes = np.frombuffer(b"".join([found[i][4:4 + 2 * n] for i, n in zip(part, sizes[part].tolist(), strict=True)]), "<u2")
        at, n = np.unique(np.repeat(part, sizes[part]) * fine + hashes.astype(np.int64) % fine, return_counts=True)
        counts.reshape(-1)[at] = np.minimum(n, 255)
    few = np.minimum(counts.reshape(-1, fine // coarse, coarse).sum(axis=1, dtype=np.uint16), 255).astype(np.uint8)
    low[long] = np.frombuffer(b"".join([found[i][-BANDS * ROWS:] for i in long]), np.uint8).reshape(-1, BANDS * ROWS)
    return sizes, few, sizes - few.sum(axis=1, dtype=np.int64), counts, sizes - counts.sum(axis=1, dtype=np.int64), low


def may_link(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], i: np.ndarray, j: np.ndarray, threshold: float = THRESHOLD, agree: float = AGREE) -> np.ndarray:
    """Which pairs (``i`` of ``left``, ``j`` of ``right``, as opened) may be similar. Neither sizes nor bins rule out a pair that is."""
    a, b = left[0][i], right[0][j]
    out = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-6
    for counts, lost in ((1, 2), (3, 4)):  # coarse bins, then fine ones
        short = np.flatnonzero(out & (np.maximum(a, b) <= BINNED))
        for part in np.split(short, range(_GATHERED, len(short), _GATHERED)):
            x, y = i[part], j[part]
            both = np.minimum(left[counts][x], right[counts][y]).sum(axis=1, dtype=np.int64) + np.minimum(left[lost][x], right[lost][y])
            out[part] = both >= threshold * (a[part] + b[part] - both) - 1e-6
    long = np.flatnonzero(out & (np.maximum(a, b) > BINNED))
    out[long] = (left[5][i[long]] == right[5][j[long]]).mean(axis=1) >= agree
    return out


def _signed(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, buckets, sig) from (node, text): the buckets of a text's bands, and its summary."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = Words()

        def out(names, sets):
            sig = signatures(sets, BANDS * ROWS) if sets else np.empty((0, BANDS * ROWS), np.uint64)
            places = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * BANDS)
            buckets = pa.ListArray.from_arrays(places, pa.array(bands(sig).ravel() if sets else np.empty(0, np.int64)))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), buckets, pa.array(summaries(sets, sig, threshold) if sets else [], pa.binary())], ["node", "buckets", "sig"])

        for batch in batches:
            names, sets, held = [], [], 0
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                elements, weights = shingles(text.as_py(), words)
                if len(elements):
                    names.append(node)
                    sets.append((elements, weights))
                    held += int(weights.sum())
                if held > 100_000:
                    yield out(names, sets)
                    names, sets, held = [], [], 0
            yield out(names, sets)

    return texts.select("node", "text").mapInArrow(rows, "node string, buckets array<long>, sig binary")


def _compared(at: DataFrame, sized_rows: Callable[[DataFrame], DataFrame], threshold: float = THRESHOLD, tries: int = _TRIES) -> DataFrame:
    """(a, b, la, lb): pairs of a member and a leader of a bucket (at: bucket, blocks, lead, node, label, sig) that are of different
    classes and may be similar. Pairs that may not are never made into rows. A task names up to ``tries`` pairs of the same two
    classes, as one link joins them; where it holds others back, a row without a and b says so."""
    # leaders are sent to each block of their bucket, before its other members
    blocks = F.when(F.col("lead"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    each = at.select("bucket", F.explode(blocks).alias("block"), "lead", "node", "label", "sig")
    each = sized_rows(each.repartition("bucket", "block").sortWithinPartitions("bucket", "block", F.desc("lead")))

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[tuple] = set()  # a pair shares several buckets: a task names it once, as far as its memory goes
        named: dict[tuple, int] = {}  # pairs named of two classes; -1: others were held back, which is said
        kept: list[list] = [[] for _ in range(6)]  # the leaders of the last block, whose members may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            again = len(kept[0])
            cols = [k + c.to_pylist() for k, c in zip(kept, batch.columns, strict=True)]
            nodes, labels = cols[3], cols[4]
            bucket, block, lead = (np.array(c) for c in cols[:3])
            first = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])))
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(bucket))))
            n_leads = np.bincount(run, lead, len(first)).astype(np.int64)
            kept = [c[first[-1]:first[-1] + n_leads[-1]] for c in cols]
            (_, node_code), (_, code) = (np.unique(np.array(c), return_inverse=True) for c in (nodes, labels))
            opened = _opened(cols[5], threshold)
            # leaders are compared with one another in the first block, when they come
            member = np.flatnonzero(~lead | ((block == 0) & (np.arange(len(lead)) >= again)))
            pairs_before = np.cumsum(n_leads[run[member]])
            for part in np.split(member, np.flatnonzero(np.diff(pairs_before // _PAIRS)) + 1):
                n = n_leads[run[part]]
                i = np.repeat(part, n)
                j = np.repeat(first[run[part]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                other = code[i] != code[j]
                i, j = i[other], j[other]
                near = may_link(opened, opened, i, j, threshold)
                i, j = i[near], j[near]
                once = np.unique(np.minimum(node_code[i], node_code[j]) * len(nodes) + np.maximum(node_code[i], node_code[j]), return_index=True)[1]
                i, j = i[once], j[once]
                classes = np.minimum(code[i], code[j]) * len(nodes) + np.maximum(code[i], code[j])
                order = np.argsort(classes, kind="stable")
                _, begin, size = np.unique(classes[order], return_index=True, return_counts=True)
                nth = np.arange(len(order)) - np.repeat(begin, size)
                out: list[tuple] = []
                if len(seen) >= 200_000:
                    seen.clear()
                    named.clear()
                for x, y, k in zip(i[order][nth <= tries].tolist(), j[order][nth <= tries].tolist(), nth[nth <= tries].tolist(), strict=True):
                    pair = (nodes[x], nodes[y], labels[x], labels[y])
                    pair = pair if pair[0] < pair[1] else (pair[1], pair[0], pair[3], pair[2])
                    two = (min(pair[2:]), max(pair[2:]))
                    count = named.get(two, 0)
                    if k < tries and (pair in seen or 0 <= count < tries):
                        if pair not in seen:
                            seen.add(pair)
                            named[two] = count + 1
                            out.append(pair)
                    elif count >= 0:
                        named[two] = -1
                        out.append((None, None, *two))
                cols_out = zip(*out, strict=True) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols_out], ["a", "b", "la", "lb"])

    return each.mapInArrow(rows, "a string, b string, la string, lb string")


def _similar(pairs: DataFrame, texts: DataFrame, threshold: float, n: int) -> DataFrame:
    """The classes (a, b) of the ``n`` pairs (a, b, la, lb) whose texts are at least ``threshold`` similar."""
    left = sized(pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"), n, 500)
    both = sized(left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"), n, 500)

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words, seen = Words(), {}
        for batch in batches:
            kept = []
            for a, ta, tb in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4), strict=True):
                if a not in seen:
                    if len(seen) >= 64:
                        seen.clear()
                    seen[a] = shingles(ta.as_py(), words)
                kept.append(weighted_jaccard(seen[a], shingles(tb.as_py(), words)) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2)], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.select("a", "la", "lb", "text_a", "text_b").mapInArrow(rows, "a string, b string")


def text_node() -> Column:
    """The node of a document: the digest of its text."""
    return F.md5(text_or_empty().cast("binary"))


def text_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, label) of the texts that share a bucket with another: equal labels are one class. A node that is
    not listed is a class of its own."""
    with scratch(docs.sparkSession):
        rows = docs.select(text_or_empty().alias("text")).withColumn("node", text_node())
        signed = staged(_signed(rows, threshold), "near-signatures")
        buckets = signed.select("node", F.explode("buckets").alias("bucket"))
        shared = buckets.groupBy("bucket").agg(F.min(F.xxhash64("node")).alias("low"), F.max(F.xxhash64("node")).alias("high"))
        found = buckets.join(shared.where("low <> high").select("bucket"), "bucket", "left_semi").distinct()
        found = staged(found, "near-buckets")
        live, size = staged_with(found.select("bucket", "node", F.col("node").alias("label")), "near-live", n=F.count(F.lit(1)))
        wanted = live.select("node").distinct()
        sigs = staged(signed.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("sig").alias("sig")).select("node", "sig"), "near-sigs")
        texts = staged(rows.select("node", "text").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "near-texts")
        labels = staged(sized(wanted, size["n"]).select("node", F.col("node").alias("label")), "near-labels")
        tried, step, tries = None, 0, _TRIES
        while size["n"]:
            # buckets whose members lie in several classes, and the leaders to try
            spread = live.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"))
            mixed = sized(spread, size["n"]).where("low <> high").select("bucket", "blocks")
            at, size = staged_with(sized(live.join(mixed, "bucket"), size["n"]).select("bucket", "blocks", "node", "label"), "near-mixed", n=F.count(F.lit(1)))
            if not size["n"]:
                break
            leads = _leaders(at, _width(step)).select("bucket", "node", F.lit(True).alias("lead"))
            at = staged(sized(at.join(leads, ["bucket", "node"], "left").withColumn("lead", F.coalesce("lead", F.lit(False))), size["n"]), "near-leaders")
            per_task = min(50_000, 1_000_000 // _width(step))  # rows that make so many comparisons
            pairs = _compared(at.join(sigs, "node"), lambda df, n=size["n"], each=per_task: sized(df, n, each), threshold, tries)
            pairs = sized(pairs.distinct(), size["n"])
            if tried is not None:
                pairs = sized(pairs.join(tried, ["a", "b"], "left_anti"), size["n"])
            pairs, found = staged_with(pairs, "near-pairs", n=F.count("a"), held=F.count_if(F.col("a").isNull()))
            held, pairs = pairs.where("a IS NULL").select("la", "lb"), pairs.where("a IS NOT NULL")
            tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
            links = _similar(pairs, texts, threshold, found["n"]).distinct()
            links, linked = staged_with(sized(links, found["n"]), "near-links", n=F.count(F.lit(1)))
            if linked["n"]:
                merged = staged(sized(connected_components(links), 2 * linked["n"]), "near-merged").select(F.col("node").alias("label"), F.col("label").alias("merged"))
                new = F.coalesce("merged", "label").alias("label")
                labels = staged(labels.join(merged, "label", "left").select("node", new), "near-labels")
            if found["held"]:
                # two classes that are still two, with pairs held back: their leaders stay, and more pairs are named
                if linked["n"]:
                    for c in ("la", "lb"):
                        held = held.join(merged.toDF(c, f"new_{c}"), c, "left")
                    held = held.where("coalesce(new_la, la) <> coalesce(new_lb, lb)")
                stuck = held.select(F.explode(F.array("la", "lb")).alias("label")).distinct()
                stuck, waiting = staged_with(sized(stuck, found["held"]), "near-waiting", n=F.count(F.lit(1)))
                tries = 4 * tries if waiting["n"] else tries
            # a leader is compared with all of its bucket: it needs no further round there
            rest = at.where(~F.col("lead"))
            if found["held"]:
                rest = rest.union(at.where("lead").join(stuck, "label", "left_semi").select(at.columns))
            rest = rest.select("bucket", "node", "label")
            if linked["n"]:
                rest = rest.join(merged, "label", "left").select("bucket", "node", new)
            live, size = staged_with(sized(rest, size["n"]), "near-live", n=F.count(F.lit(1)))
            step += 1
        labels = staged(labels, "near-labels")
    return labels


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size (documents)."""
    labels = text_classes(docs, threshold)
    named = docs.select("doc_id", text_node().alias("node")).join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("label"))
    classes = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    # written first, so that adaptive execution may split the join at a class that holds a third of the documents
    return named.join(staged(classes, "near-classes"), "label").select("doc_id", "class_id", "class_size")


def class_heads(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest doc_id (nulls last), then the smallest text digest."""
    labels = text_classes(docs, threshold)
    narrow = docs.select("doc_id", text_node().alias("node")).join(labels, "node", "left")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("head")
    heads = narrow.groupBy(F.coalesce("label", "node").alias("label")).agg(first).select(
        F.col("head.doc_id").alias("__head_id"), F.col("head.node").alias("__head_node"))
    named = docs.withColumn("__node", text_node())
    kept = named.join(heads, (F.col("__node") == F.col("__head_node")) & F.col("doc_id").eqNullSafe(F.col("__head_id")), "left_semi")
    return kept.dropDuplicates(["__node"]).drop("__node")


def _width(step: int) -> int:
    """Leaders tried at once: few at first, as most buckets are one class or a handful of texts; then more."""
    return min(4 * 16**step, 256)


def _leaders(at: DataFrame, width: int) -> DataFrame:
    """The leaders of each bucket, in the same order in every bucket. Nodes of no class yet come first: once all of them were
    leaders, what is left of a bucket of one large class and many loose texts is that class."""
    order = Window.partitionBy("bucket").orderBy(F.col("label") != F.col("node"), F.xxhash64("node"), "node")
    return at.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= width).drop("nth")
