"""Corpus pipeline over the documents table: five operators, one after another.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps, with the columns of documents (the last one: ids).  Each
stage's result is written to the shared folder and read back as the next one's
input, so that a lost executor repeats at most one stage; then the stage's own
intermediate tables go (so write a stage's result before you call the next one with
it).  A stage sees all that its predecessor kept.

SQL can't express the trained scores, the sketches and the merges; the tests hold
each stage against a brute-force version on its own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, decontaminate, line_dedup, near_dups, toxicity
from tessera.llm.written import discard, stage_tables
from tessera.plans.session import shared_path, ship_package
from tessera.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold by models of the labelled ones."""
    ship_package(spark)
    with stage_tables(docs):
        return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines like an earlier one; n_chars follows the text."""
    ship_package(spark)
    with stage_tables(docs):
        out = line_dedup.drop_lines(docs)
        if "n_chars" in out.columns:
            out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
        return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingle similarity 0.8 or more."""
    ship_package(spark)
    with stage_tables(docs):
        return near_dups.drop_near_duplicates(docs, width=5, percent=80).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ship_package(spark)
    with stage_tables(docs):
        return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (little-endian uint32) of every document."""
    ship_package(spark)
    with stage_tables(docs):
        out = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=True)
        return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("byte_bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the documents of ``sf_dir``."""
    docs, old = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        discard(spark, [old] if old else [])
        docs, old = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
