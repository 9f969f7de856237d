import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException  # noqa: F401

from tessera.operators.relational import log_rollup
from tessera.sources import text as T

# two requests of one visitor in the combined format, with fields behind the agent
LOG1 = ('192.0.2.44 - "ANNA" [03/Mar/2021:08:15:30 +0000] "GET /img/logo.png HTTP/1.1" 200 512 '
        '"https://site.example/start" "Agent/2.0 (X11; Linux)" "extra" 0.12 "-"')
LOG2 = ('192.0.2.44 - "ANNA" [03/Mar/2021:09:47:02 +0000] "GET /img/logo.png HTTP/1.1" 200 488 '
        '"https://site.example/next" "Agent/2.0 (X11; Linux)" "extra" 0.34 "-"')


def lines(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_log_rollup_sample_lines(spark):
    out = log_rollup(lines(spark, [LOG1, LOG2])).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.ip, r.user, r.n, r.bytes) == ("192.0.2.44", '"ANNA"', 2, 1000)
    assert r.query == "GET /img/logo.png HTTP/1.1"


def test_log_rollup_edge_rows(spark):
    anon = LOG1.replace('"ANNA"', '"-"')
    dash_bytes = LOG2.replace(" 200 488 ", " 200 - ")
    out = {(r.ip, r.user): (r.n, r.bytes) for r in
           log_rollup(lines(spark, [LOG1, anon, "not a log line", "", dash_bytes])).collect()}
    # unmatched, empty and anonymous lines share the null key; the anonymous bytes still count
    assert out[(None, None)] == (3, 512)
    # '-' bytes pass the pattern and count as 0
    assert out[("192.0.2.44", '"ANNA"')] == (2, 512)


def test_edges_parser(spark):
    df = T.parse_edges(lines(spark, ["a b", "a\t b  extra", "c d"]))
    assert sorted(tuple(r) for r in df.collect()) == [("a", "b"), ("a", "b"), ("c", "d")]
    with pytest.raises(Exception):
        T.parse_edges(lines(spark, ["lonely"])).collect()


def test_dense_and_labeled(spark):
    v = T.parse_dense_vectors(lines(spark, ["0.5 1.0", "2 3"])).collect()
    assert [r.features for r in v] == [[0.5, 1.0], [2.0, 3.0]]
    with pytest.raises(Exception):
        T.parse_dense_vectors(lines(spark, ["0.5  1.0"])).collect()   # empty token
    p = T.parse_labeled_points(lines(spark, ["1 1 2 3 9"]), dims=3).first()
    assert p.y == 1.0 and p.x == [1.0, 2.0, 3.0]
    with pytest.raises(Exception):
        T.parse_labeled_points(lines(spark, ["1 1 2"]), dims=3).collect()


def test_label_csv_bracket_ratings(spark):
    c = T.parse_label_csv(lines(spark, ["1.0,2 3 4"])).first()
    assert c.label == 1.0 and c.features == [2.0, 3.0, 4.0]
    b = T.parse_bracket_points(lines(spark, ["(1.0,[2.0,3.0])", "(-1, [ 4, 5.5 ])", "(0.0,[])"])).collect()
    assert [(r.label, r.features) for r in b] == [(1.0, [2.0, 3.0]), (-1.0, [4.0, 5.5]), (0.0, [])]
    with pytest.raises(Exception):
        T.parse_bracket_points(lines(spark, ["1.0,[2.0]"])).collect()
    r = T.parse_ratings(lines(spark, ["12::345::4::999"])).first()
    assert (r.user, r.item, r.rating) == (12, 345, 4.0)
    ri = T.parse_ratings(lines(spark, ["12::345::4"]), implicit=True).first()
    assert ri.rating == 1.5


def test_explode_lines_and_lengths(spark):
    df = spark.createDataFrame([(1, "ab\ncde\n")], "doc_id long, text string")
    out = T.line_lengths(T.explode_lines(df, "text", keep=("doc_id",))).orderBy("line_no").collect()
    assert [(r.line_no, r.len) for r in out] == [(0, 2), (1, 3), (2, 0)]


def test_libsvm_source(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text("1 1:0.5 3:2\n0 2:1.5\n")
    df = spark.read.format("libsvm").option("numFeatures", 3).load(str(p))
    rows = sorted((r.label, r.features.toArray().tolist()) for r in df.collect())
    assert rows == [(0.0, [0.0, 1.5, 0.0]), (1.0, [0.5, 0.0, 2.0])]
    assert isinstance(PySparkException, type)
