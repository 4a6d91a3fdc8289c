"""The ledger of line runs against a plain count."""

from collections import Counter

import pytest

from erascore.llm import linededup as L

from .frames import documents


def plain(texts, least):
    import re

    trim = re.compile(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$")

    def key(line):
        return trim.sub("", line).translate({i: i + 32 for i in range(65, 91)})

    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < least]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


TEXTS = ["A b\nkeep 1\n", " a B \t\nkeep 2", "a b\r\n\x0bÉ", "É\nA B", "é\na b", "\n\n", "", None, "\x1ca b", "a b\na b", "solo"] * 2


@pytest.mark.parametrize("least,batches,sent", [(3, 1, 10**6), (3, 4, 10**6), (3, 3, 0), (10**6, 2, 0)])
def test_equals_plain_count(spark, least, batches, sent):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = L.dedup_lines(frame, min_docs=least, batches=batches, broadcast_keys=sent).orderBy("doc_id").collect()
    assert [(r["text"], r["__n_lines"], r["__n_dropped"]) for r in got] == plain(TEXTS, least)


def test_runs_are_compacted_and_removed(spark):
    ledger = L.LineRuns(spark, 3)
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for n in range(1, 8):
        ledger.add(frame)
        assert len(ledger.runs) == bin(n).count("1") and len({r[0] for r in ledger.runs}) == len(ledger.runs)
    tables = [r[1] for r in ledger.runs]
    plan = spark.table(tables[0]).join(spark.table(tables[1]).hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan
    ledger.close()
    assert not ledger.runs and not any(spark.catalog.tableExists(t) for t in tables)


def test_awkward_documents(spark):
    frame = documents(spark)
    for sent in (10**6, 0):
        got = L.dedup_lines(frame, min_docs=2, broadcast_keys=sent)
        assert got.columns == [*frame.columns, "__n_lines", "__n_dropped"]
        texts = [r["text"] for r in frame.collect()]
        want = sorted(plain(texts, 2))
        assert sorted((r["text"], r["__n_lines"], r["__n_dropped"]) for r in got.collect()) == want
        assert L.dedup_lines(frame.limit(0), min_docs=2, broadcast_keys=sent).collect() == []
