"""SimHash near-duplicates: 64-bit fingerprints, a byte-position inverted index, components of linked fingerprints.

A fingerprint is eight bytes. Two that differ in at most three bits differ in at most three bytes, so they share at least
five positional bytes: the guaranteed minimum. The index posts a fingerprint under each five of its (position, byte)
entries, so only fingerprints that can reach the minimum ever meet. Within a posting list the shared positional bytes of a pair
are tallied over all eight positions, pairs that reach the minimum are kept and their bits compared.

No list is unbounded and no pair becomes a row for its own sake: a list's fingerprints are distinct and differ in three given
bytes only (2**24 at most); it is searched breadth first, each fingerprint against those not reached yet (or, in a long list,
by looking up its 2,324 possible neighbours), and a task passes on a spanning forest of what it found.

Defined cases: a null or empty text has no words and fingerprint zero, and is linked like any other; a text of one or two words is
one shingle; repeated rows and equal texts share a fingerprint; a null doc_id keeps its row but is no smallest id (a
component of null ids only has a null component_id); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, scratch, staged, text_or_empty

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Positional bytes that two fingerprints within ``MAX_BITS`` must share.
LEAST_SHARED = 8 - MAX_BITS
_HELD = 400_000  # shingles whose bits are counted at once
_LOOKUP = 20_000  # from so many fingerprints not yet reached, neighbours are looked up instead
_EDGES = 200_000  # links held before a task passes on their forest


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of ``size`` words, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z and the six blanks of ASCII
    if not words:
        return []
    joined = b" ".join(words)
    starts, ends, at = [], [], 0
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    if len(words) < size:
        return [xxh64_intdigest(joined, seed)]
    return list(map(xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends[size - 1:])), repeat(seed)))


def majority_bits(hashes, lengths):
    """The fingerprint of each consecutive run of ``hashes``: a bit is set if more than half of the run's hashes have it."""
    import numpy as np

    lengths = np.asarray(lengths, dtype=np.int64)
    out = np.zeros(len(lengths), dtype=np.uint64)
    some = np.flatnonzero(lengths)
    if not len(some):
        return out
    runs = lengths[some]
    # byte-wide counters cannot overflow within 255 hashes: a run is summed in stretches of so many
    parts = -(-runs // 255)
    first = np.cumsum(parts) - parts
    owner = np.repeat(np.arange(len(runs)), parts)
    starts = (np.cumsum(runs) - runs)[owner] + 255 * (np.arange(parts.sum()) - first[owner])
    found = np.zeros(len(runs), dtype=np.uint64)
    for bit in range(8):
        counters = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101), starts)
        counts = np.add.reduceat(counters.astype("<u8").view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
        over = 2 * counts > runs[:, None]
        for byte in range(8):
            found |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + bit)
    out[some] = found
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every row."""

    def prints(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids, hashes, lengths, done = batch.column(0), [], [], []

            def flush(hashes, lengths):
                return majority_bits(np.array(hashes, dtype=np.uint64), lengths).view(np.int64)

            for text in batch.column(1):
                new = shingle_hashes(text.as_py(), size)
                hashes += new
                lengths.append(len(new))
                if len(hashes) > _HELD:
                    done.append(flush(hashes, lengths))
                    hashes, lengths = [], []
            done.append(flush(hashes, lengths))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(done))], names=["doc_id", "fingerprint"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(prints, "doc_id long, fingerprint long")


def index_keys(fingerprint: Column) -> Column:
    """The keys of a fingerprint: each five of its positional bytes, and which positions they are."""
    keys = []
    for n, positions in enumerate(combinations(range(8), LEAST_SHARED)):
        key = F.lit(n).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fingerprint, 8 * p).bitwiseAND(F.lit(255)))
        keys.append(key)
    return F.array(*keys)


def tallied_links(one, others):
    """Which of ``others`` share the guaranteed minimum of positional bytes with ``one`` and differ in few enough bits."""
    import numpy as np

    differ = np.ascontiguousarray(others ^ one)
    shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    kept = np.flatnonzero(shared >= LEAST_SHARED)
    return kept[np.bitwise_count(differ[kept]) <= MAX_BITS]


def list_forest(members):
    """A spanning forest (pairs) of the links among one posting list's distinct fingerprints."""
    import numpy as np

    left, pairs = np.sort(members), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            if len(left) > _LOOKUP:
                near = one ^ _flips(int(np.bitwise_or.reduce(members ^ members[0])))
                at = np.searchsorted(left, near)
                at[at == len(left)] = 0
                hit = np.unique(at[left[at] == near])
            else:
                hit = tallied_links(one, left)
            if len(hit):
                pairs += [(one, x) for x in left[hit]]
                queue += list(left[hit])
                left = np.delete(left, hit)
    return pairs


def _flips(free: int):
    """All ways to flip one to ``MAX_BITS`` of the bits in which a list's members may differ."""
    import numpy as np

    bits = [1 << b for b in range(64) if free >> b & 1]
    return np.array([sum(c) for n in range(1, MAX_BITS + 1) for c in combinations(bits, n)], dtype=np.uint64)


def forest(pairs) -> list[tuple[int, int]]:
    """Pairs that connect what the given pairs connect, one for each node but a component's first."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in pairs:
        a, b = find(root.setdefault(a, a)), find(root.setdefault(b, b))
        root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in list(root) if find(x) != x]


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints (column fingerprint) exactly as all pairs within ``MAX_BITS`` do."""

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def passed_on(held):
            found = forest(held)
            cols = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(cols[:, 0]), pa.array(cols[:, 1])], names=["a", "b"])

        held: list = []
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def lists(keys, values):
            """Links of whole posting lists."""
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            sizes = ends - starts
            two = starts[sizes == 2]
            differ = values[two] ^ values[two + 1]
            two = two[(np.bitwise_count(differ) <= MAX_BITS)
                      & ((differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= LEAST_SHARED)]
            yield list(zip(values[two].tolist(), values[two + 1].tolist(), strict=True))
            for n in np.flatnonzero(sizes > 2):
                yield [(int(a), int(b)) for a, b in list_forest(values[starts[n]:ends[n]])]

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            whole = int(np.searchsorted(keys, keys[-1]))  # the last list may go on in the next batch
            if whole:
                for found in lists(keys[:whole], values[:whole]):
                    held += found
                    if len(held) > _EDGES:
                        yield passed_on(held)
                        held = []
                keys, values = keys[whole:], values[whole:]
        if len(keys):
            for found in lists(keys, values):
                held += found
        if held:
            yield passed_on(held)

    posted = prints.select(F.explode(index_keys(F.col("fingerprint"))).alias("key"), "fingerprint")
    return posted.repartition("key").sortWithinPartitions("key").mapInArrow(search, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) of every row."""
    spark = docs.sparkSession
    with scratch(spark):
        rows = staged(fingerprints(docs, size), "simhash-rows")
        heads = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("head")), "simhash-heads")
        classes = connected_components(links(heads))
        linked = staged(heads.join(classes, F.col("fingerprint") == F.col("node")).select("fingerprint", "label", "head"), "simhash-linked")
        least = linked.groupBy("label").agg(F.min("head").alias("component_id"))
        named = linked.join(least, "label").select(F.col("fingerprint").alias("node"), "component_id")
        found = heads.join(named, F.col("fingerprint") == F.col("node"), "left")
        found = found.select("fingerprint", F.coalesce("component_id", "head").alias("component_id"))
        digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
        result = rows.join(found, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
        return staged(result, "simhash-result")
