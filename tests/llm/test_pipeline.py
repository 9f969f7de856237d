import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tessera.llm import byte_bpe, written
from tests.llm import test_decontaminate, test_line_dedup, test_near_dups

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, given = docs.columns, rows(docs)
    kept = rows(corpus_pipeline.drop_toxic(spark, docs, SF))
    assert set(kept) <= set(given) and len(kept) >= .8 * len(given)

    df = spark.createDataFrame(kept, docs.schema)
    out = corpus_pipeline.drop_repeated_lines(spark, df, SF)
    assert out.columns == cols
    gone = test_line_dedup.brute([(r[0], r[1]) for r in kept], 5, 80)
    lined = rows(out)
    want = []
    for d, t, *rest in kept:
        t = "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
        want.append((d, t, *rest[:-1], len(t)))
    assert lined == sorted(want, key=repr)

    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(lined, docs.schema), SF)
    keep = {d for d, _, _, k in test_near_dups.brute([(r[0], r[1]) for r in lined], 5) if k}
    single = rows(out)
    assert out.columns == cols and single == [r for r in lined if r[0] in keep]

    out = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(single, docs.schema), SF)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in test_decontaminate.brute([(r[0], r[1]) for r in single], bench, 10) if r[2]}
    clean = rows(out)
    assert out.columns == cols and clean == [r for r in single if r[0] not in hit]

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.encode(spark, spark.createDataFrame(clean, docs.schema), SF).collect()}
    assert len(got) == len(clean)
    for d, t, *_ in clean:
        ids = enc.encode_ordinary(t)
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (got[d].n_tokens, bytes(got[d].ids), got[d].decoded_sha256) == (len(ids), data, hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == set(got)


def test_stages_called_on_older_tables_keep_their_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    second = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert first.count() and second.count()
    # a table written from the first one lets its intermediate tables go
    first.write.parquet(str(tmp_path / "kept"))
    before = set(written._LAST)
    corpus_pipeline.drop_contaminated(spark, spark.read.parquet(str(tmp_path / "kept")), SF).count()
    assert before and not before & set(written._LAST)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
