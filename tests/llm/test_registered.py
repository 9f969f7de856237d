import duckdb
import pytest

import __spark_entry__ as entry
from tessera.llm import queries

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = list(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, res.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("name,table,columns", [
    ("op1_token_counts", "documents", "doc_id n_bytes n_tokens over_limit"),
    ("op2_suffix_dedup", "documents", "doc_id n_bytes n_removed n_spans kept_sha256"),
    ("op4_line_dedup", "documents", "doc_id n_lines n_removed removed_sha256"),
    ("op5_id_blocks", "documents", "doc_id start n_tokens ids_crc32"),
    ("op6_byte_bpe", "documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op7_toxicity", "documents", "doc_id held_out score predicted"),
    ("op8_near_duplicates", "documents", "doc_id n_shingles component_id kept"),
    ("op9_cap_filters", "embeddings", "vec_id n_links component_id kept")])
def test_one_row_for_each_row_of_the_table(spark, name, table, columns):
    df = entry.queries()[name](spark, SF)
    assert df.columns == columns.split()
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
