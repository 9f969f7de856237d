"""The registered ``opN_<name>`` queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..plans.session import ship_package
from ..sources.tables import table
from . import (byte_bpe, cap_filters, decontaminate, id_blocks, line_dedup, merkle, near_dups, suffix_dedup, token_counts,
               toxicity, trie, url_filter, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = build
    return fn


@query
def op1_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_suffix_dedup(spark, sf):
    return suffix_dedup.strip_repeats(table(spark, sf, "documents"))


#: the dealt rules: action, host, path
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query
def op3_url_filter(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), RULES)


ORACLE_SQL["op3_url_filter"] = url_filter.oracle_sql(RULES)


@query
def op4_line_dedup(spark, sf):
    return line_dedup.dedup_report(table(spark, sf, "documents"))


@query
def op5_id_blocks(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return id_blocks.ids_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_byte_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op7_toxicity(spark, sf):
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_near_duplicates(spark, sf):
    return near_dups.near_duplicates(table(spark, sf, "documents"), width=2, percent=80)


@query
def op9_cap_filters(spark, sf):
    return cap_filters.near_vectors(table(spark, sf, "embeddings"), cosine=0.9)


@query
def op10_decontamination(spark, sf):
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLE_SQL["op10_decontamination"] = decontaminate.ORACLE_SQL


@query
def op11_prefix_trie(spark, sf):
    return trie.prefix_trie(table(spark, sf, "conversations"), rebuild=True)


ORACLE_SQL["op11_prefix_trie"] = trie.ORACLE_SQL


@query
def op12_merkle_manifest(spark, sf):
    return merkle.manifest(table(spark, sf, "documents"))


ORACLE_SQL["op12_merkle_manifest"] = merkle.ORACLE_SQL


@query
def op13_warc(spark, sf):
    return warc.round_trip(table(spark, sf, "pages"))


ORACLE_SQL["op13_warc"] = warc.ORACLE_SQL
