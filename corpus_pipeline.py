"""A corpus pipeline over ``documents``: quality rules, line deduplication, near-deduplication, benchmark
decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; ``run`` writes
each stage's result as Parquet into the shared folder and rereads it as the next one's ``docs``. All but the last
return the columns of ``docs``, whatever they are.

Defined cases: verdicts follow the text, so rows with a null or repeated doc_id are judged like any other; a null text is an
empty one, which the quality rules reject; repeated rows are copies, of which near-deduplication keeps one; an empty
table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erascore.llm import dartminhash, decontam, linededup, packing, rules, suite
from erascore.llm.common import prepare_session, staged
from erascore.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    prepare_session(spark)
    return rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines found in ten or more of them."""
    prepare_session(spark)
    return linededup.dedup_lines(docs).drop("__n_lines", "__n_dropped")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that with the smallest doc_id."""
    prepare_session(spark)
    return dartminhash.class_heads(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    prepare_session(spark)
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = decontam.contaminated(docs.select(key.alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    bad = staged(found.select(F.col("doc_id").alias("__leaking")).distinct(), "pipeline-leaks")
    return docs.withColumn("__key", key).join(bad, F.col("__key") == F.col("__leaking"), "left_anti").drop("__key")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    prepare_session(spark)
    return packing.with_crc(packing.pack(docs, suite.tokenizer_path()))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("decontaminate", decontaminate), ("pack", pack)]

#: The near-duplicate, retrieval and packing stages have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
