"""Measurements against a plain count, policies and ablations against the definition."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from erascore.llm import rules as R

from .frames import documents


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines, dups = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines, dups = lines + 1, dups + (line in seen)
            seen.add(line)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, dups, len(covered),
            len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text)))


@given(st.text(alphabet="abAé#| \n\t\x0b\x1c\x85", max_size=120))
@settings(deadline=None)
def test_measurements(text):
    assert R.measure(text) == plain(text)


def test_repeated_windows():
    for text in ("a b c d e f g h " * 3, "x " * 30, "a b c d e f g h z a b c d e f g h", " ".join(map(str, range(50))), "a b c d e f g"):
        assert R.measure(text) == plain(text)


def test_ledger_policies_and_ablations(spark):
    frame = documents(spark)
    judged = R.ledger(frame).collect()
    assert len(judged) == frame.count()
    texts = Counter(plain(r["text"] or "") for r in frame.collect())
    assert Counter(tuple(r[m] for m in R.MEASURES) for r in judged) == texts
    names = [n for n, _ in R.RULES]
    for policy in (R.BASE, R.STANDARD, R.STRICT):
        kept = R.apply_policy(R.ledger(frame), policy).where("kept").count()
        assert kept == sum(not r["fail_bits"] & policy.mask for r in judged)
        got = {r["rule"]: (r["failed"], r["alone"]) for r in R.ablation(R.ledger(frame), policy).collect()}
        assert got == {n: (sum(bool(r["fail_bits"] >> names.index(n) & 1) for r in judged),
                           sum(r["fail_bits"] & policy.mask == 1 << names.index(n) for r in judged)) for n in policy.rules}


def test_empty_table(spark):
    frame = documents(spark).limit(0)
    assert R.ledger(frame).collect() == [] == R.quality_report(frame).collect() == R.ablation(R.ledger(frame)).collect()


def test_one_written_ledger_serves_every_policy(spark):
    frame = documents(spark)
    judged = R.written_ledger(frame)
    assert "MapInArrow" not in judged._jdf.queryExecution().toString()  # nothing is measured again
    got = {(r["policy"], r["rule"]): (r["failed"], r["alone"]) for r in R.ablations(judged, (R.BASE, R.STANDARD, R.STRICT)).collect()}
    for p in (R.BASE, R.STANDARD, R.STRICT):
        assert {k[1]: v for k, v in got.items() if k[0] == f"{p.name}/{p.version}"} == {
            r["rule"]: (r["failed"], r["alone"]) for r in R.ablation(R.ledger(frame), p).collect()}
