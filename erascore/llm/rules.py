"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger, a written table (``written_ledger``), keeps the measurements and one
bit per failed rule. A policy is a versioned set of rules: applying one, or asking what each of its rules alone rejects, reads only
the ledger's bits.

Words are ``[^\\x20\\x09-\\x0D]+``. Measurements: n_words; word_chars (code points in words); n_symbols (characters of
``#*$%&|<>``); n_lines (lines with a word); n_dup_lines (of them, equal to an earlier line); n_repeat_words (words in
windows of eight words that occur twice or more, the first occurrence included); n_upper, n_lower (ASCII letters).

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows are judged each; an empty table
gives an empty ledger; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import staged

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower")
WINDOW = 8
#: Bit i of ``fail_bits`` is the i-th rule: its name, and when a document fails it (SQL over the measurements).
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    ("upper_case", "n_upper + n_lower > 0 AND 2 * n_upper > n_upper + n_lower"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [n for n, _ in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
#: Repeated lines are measured but not a reason to reject: line deduplication removes them.
STANDARD = Policy("standard", 1, (*BASE.rules, "many_symbols", "word_length", "upper_case"))
STRICT = Policy("strict", 1, (*STANDARD.rules, "repeated_lines"))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def repeat_words(words: list[bytes]) -> int:
    """Words covered by windows of WINDOW words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        h = (h ^ (ids[i:n + i] + _M1)) * _M2
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[WINDOW:WINDOW + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()  # at ASCII white space
    seen: set[bytes] = set()
    lines = dups = 0
    for line in data.split(b"\n"):
        if line.strip():
            lines += 1
            dups += line in seen
            seen.add(line)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=128)
    return (len(words), len(text) - int(count[9:14].sum() + count[32]), int(count[list(b"#*$%&|<>")].sum()), lines, dups,
            repeat_words(words), int(count[65:91].sum()), int(count[97:123].sum()))


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with its measurements and fail_bits as further columns (named with ``prefix``); a row stays where it is."""
    names = [f"{prefix}{m}" for m in MEASURES]

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = [measure(t or "") for t in batch.column(at).to_pylist()]
            cols = np.array(found, np.int64).reshape(-1, len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, np.ascontiguousarray(cols))], [*batch.schema.names, *names])

    docs = docs.withColumn(text, F.col(text).cast("string"))
    out = docs.mapInArrow(rows, StructType([*docs.schema.fields, *[StructField(n, LongType()) for n in names]]))
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        own = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"{prefix}\1", fails)
        bits = bits.bitwiseOR(F.when(F.expr(own), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return out.withColumn(f"{prefix}fail_bits", bits)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and fail_bits: one row per document."""
    return measured(docs.select("doc_id", "text")).drop("text")


def written_ledger(docs: DataFrame) -> DataFrame:
    """The ledger as a table in the shared folder: each rule was evaluated once, whatever is asked of the bits afterwards."""
    return staged(ledger(docs), "quality-ledger")


def ablations(judged: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    """(policy, rule, failed, alone) of several policies over one ledger."""
    each = [ablation(judged, p).select(F.lit(f"{p.name}/{p.version}").alias("policy"), "rule", "failed", "alone") for p in policies]
    return reduce(DataFrame.unionByName, each)


def kept_documents(docs: DataFrame, policy: Policy = STANDARD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns."""
    judged = measured(docs, text, "__rule_")
    return judged.where(F.col("__rule_fail_bits").bitwiseAND(F.lit(policy.mask)) == 0).select(*docs.columns)


def rejected(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(judged: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with ``kept`` under a policy, and the policy's name and version."""
    return judged.withColumn("kept", ~rejected(policy)).withColumn("policy", F.lit(f"{policy.name}/{policy.version}"))


def ablation(judged: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """(rule, failed, alone): documents that fail each rule of the policy, and those no other rule of it rejects.

    Documents are first counted per combination of bits, at most 2**rules rows."""
    masked = judged.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = [n for n, _ in RULES]
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in policy.rules])
    wide = masked.select("bits", "n", F.explode(each).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return wide.groupBy("r.rule").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
                                      F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("alone"))


def quality_report(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    judged = apply_policy(written_ledger(docs), policy)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         rejected(BASE).alias("base_failed"), "kept", "fail_bits")
