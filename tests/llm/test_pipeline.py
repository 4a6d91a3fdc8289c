"""The pipeline's stages against brute force, each on the one before's rows."""

import corpus_pipeline as P
from erascore.llm import linededup, rules

from .frames import documents
from .test_dartminhash import brute_classes
from .test_decontam import brute
from .test_linededup import plain as plain_lines
from .test_packing import check


def test_stages_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def texts(frame):
        assert frame.schema == docs.schema
        return {r["doc_id"]: r["text"] for r in frame.collect()}

    one = P.quality(spark, docs, sf_dir).cache()
    names = [n for n, _ in rules.RULES]
    want = {}
    for d, t in rows.items():
        m = dict(zip(rules.MEASURES, rules.measure(t), strict=True))
        fails = {n for n, sql in rules.RULES if eval(sql.replace("AND", "and").replace("OR", "or"), {}, m)}
        if not fails & set(rules.STANDARD.rules):
            want[d] = t
    assert texts(one) == want and names and len(want) > 0.75 * len(rows)
    two = P.lines(spark, one, sf_dir).cache()
    cleaned = dict(zip(want, (x[0] for x in plain_lines(list(want.values()), linededup.MIN_DOCS)), strict=True))
    assert texts(two) == cleaned
    three = P.near(spark, two, sf_dir).cache()
    heads = {c for _, c in brute_classes(list(cleaned.items()))}
    assert texts(three) == {d: t for d, t in cleaned.items() if d in heads}
    four = P.decontaminate(spark, three, sf_dir).cache()
    kept = texts(three)
    leaking = {d for d, _ in brute(list(kept.items()), bench)}
    assert texts(four) == {d: t for d, t in kept.items() if d not in leaking} and leaking
    check(P.pack(spark, four, sf_dir).collect(), list(texts(four).items()), 4096)


def test_awkward_documents_pass_every_stage(spark, sf_dir):
    for frame in (documents(spark), documents(spark).limit(0)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, frame, sf_dir)
            assert sorted(out.columns) == sorted(frame.columns)
            assert out.count() <= frame.count()
        P.pack(spark, frame, sf_dir).collect()


def test_entry_registers_all():
    import __spark_entry__ as entry

    got = set(entry.queries())
    assert "pipeline" in got and sorted(int(n[2:].split("_")[0]) for n in got if n.startswith("op")) == list(range(1, 14))
    assert P.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
