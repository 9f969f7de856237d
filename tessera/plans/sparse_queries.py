"""Sparse vectors: LIBSVM scans, column summary, naive Bayes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sparse as SP
from ..operators.relational import reindex_labels
from ..sources import text as T
from ..sources.tables import table
from .registry import register
from .session import cut_lineage, shared_path

# Features of a lineitem row: three measures (which may be 0 and are then left out)
# and one entry among a range of suppliers.
_MEASURES = ("l_discount", "l_tax * 10 - 0.3", "l_quantity / 25 - 1")
_SPREAD = 50
_ENTRIES_SQL = " UNION ALL ".join(f"SELECT id, {i} AS dim, CAST({m} AS DOUBLE) AS x FROM li" for i, m in enumerate(_MEASURES)) + f"""
  UNION ALL SELECT id, {len(_MEASURES)} + l_suppkey % {_SPREAD}, CAST(l_linenumber AS DOUBLE) FROM li"""
_WITH = f"""
WITH li AS (SELECT *, row_number() OVER () AS id, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM lineitem),
e AS (SELECT * FROM ({_ENTRIES_SQL}) WHERE x <> 0),
t AS (SELECT (SELECT count(*) FROM li) AS n, (SELECT max(dim) FROM e) + 1 AS d)"""


def libsvm_lines(li: DataFrame) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0"))
    entry = lambda i, x: F.when(x != 0, F.concat(F.lit(f"{i}:"), x.cast("string")))
    measures = [entry(i + 1, F.expr(f"CAST({m} AS DOUBLE)")) for i, m in enumerate(_MEASURES)]
    place = F.concat((F.col("l_suppkey") % _SPREAD + len(_MEASURES) + 1).cast("string"), F.lit(":"), F.col("l_linenumber").cast("string"))
    return li.select(F.concat_ws(" ", label, *measures, place).alias("value"))


def written_lines(spark: SparkSession, sf: str) -> str:
    path = shared_path(spark, "libsvm")
    libsvm_lines(table(spark, sf, "lineitem")).write.text(path)
    return path


@register("libsvm_infer", sql=f"""{_WITH}
SELECT li.label, count(DISTINCT li.id) AS n, any_value(t.d)::INTEGER AS size, count(e.x) AS entries, round(sum((e.dim + 1) * e.x), 4) AS weighted,
       24 AS partitions
FROM li JOIN e ON e.id = li.id CROSS JOIN t GROUP BY li.label
""")
def q_libsvm_infer(spark: SparkSession, sf: str) -> DataFrame:
    """A LIBSVM scan that infers its dimension and is dealt over 24 partitions."""
    rows = T.read_libsvm(spark, written_lines(spark, sf), min_partitions=24)
    weighted = F.aggregate(F.arrays_zip("indices", "values"), F.lit(0.0), lambda a, e: a + (e["indices"] + 1) * e["values"])
    parts = rows.rdd.getNumPartitions()
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.sum(F.size("indices")).alias("entries"),
                                     F.round(F.sum(weighted), 4).alias("weighted")).withColumn("partitions", F.lit(parts))


@register("vector_summary", sql=f"""{_WITH},
s AS (SELECT dim, count(*) AS k, avg(x) AS m, var_pop(x) AS v, max(x) AS hi, min(x) AS lo FROM e GROUP BY dim)
SELECT g.dim::INTEGER AS dim, round(coalesce(k * m / n, 0), 9) AS mean,
       round((coalesce(k * v, 0) + coalesce(k * m * m, 0) - n * coalesce(k * m / n, 0) ^ 2) / (n - 1), 6) AS variance, coalesce(k, 0) AS nnz,
       CASE WHEN k = n THEN hi ELSE greatest(coalesce(hi, 0), 0) END AS max, CASE WHEN k = n THEN lo ELSE least(coalesce(lo, 0), 0) END AS min
FROM t, LATERAL (SELECT unnest(range(0, t.d)) AS dim) g LEFT JOIN s ON s.dim = g.dim
""")
def q_vector_summary(spark: SparkSession, sf: str) -> DataFrame:
    """M0 over sparse rows read from LIBSVM text; the dimension is inferred."""
    s = SP.summary(T.read_libsvm(spark, written_lines(spark, sf)))
    return s.select("dim", F.round("mean", 9).alias("mean"), F.round("variance", 6).alias("variance"), "nnz", "max", "min")


# ================================================================ L10
_WORD = "[a-z0-9]+"
_HELD_OUT = 5
_COUNTS_SQL = f"""
WITH labelled AS (
  SELECT doc_id, any_value(quality)::DOUBLE AS label, any_value(text) AS text
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY doc_id),
w AS (SELECT doc_id, label, unnest(regexp_extract_all(lower(coalesce(text, '')), '{_WORD}')) AS word FROM labelled),
c AS (SELECT doc_id, label, word, count(*)::DOUBLE AS x FROM w GROUP BY ALL),
vocab AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS dim FROM (SELECT DISTINCT word FROM w)),
train AS (SELECT label, dim, sum(x) AS s FROM c JOIN vocab USING (word) WHERE doc_id % {_HELD_OUT} <> 0 GROUP BY label, dim),
docs AS (SELECT doc_id, label FROM labelled WHERE doc_id IN (SELECT doc_id FROM w)),
cls AS (
  SELECT label, n, mass, ln(n + 1.0) - ln((sum(n) OVER ()) + 1.0 * count(*) OVER ()) AS prior, ln(mass + (SELECT count(*) FROM vocab)) AS below
  FROM (SELECT label, count(*) AS n FROM docs WHERE doc_id % {_HELD_OUT} <> 0 GROUP BY label)
  JOIN (SELECT label, sum(s) AS mass FROM train GROUP BY label) USING (label))"""


def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, label, sparse word counts) of the labelled documents; a word's dimension
    is its rank among all words."""
    lab = table(spark, sf, "labels").where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = table(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id")
    words = docs.select("doc_id", "label", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), 0)).alias("word"))
    counts = reindex_labels(words.groupBy("doc_id", "label", "word").agg(F.count(F.lit(1)).alias("x")), "word", "dim")
    counts = cut_lineage(counts)
    size = (counts.agg(F.max("dim")).first()[0] or 0) + 1
    return cut_lineage(SP.from_counts(counts, ["doc_id", "label"], "dim", "x", size))


@register("sparse_nb_params", sql=f"""{_COUNTS_SQL}
SELECT label, dim::INTEGER AS dim, round(ln(s + 1.0) - below, 9) AS theta, round(prior, 9) AS prior FROM train JOIN cls USING (label)
""")
def q_sparse_nb_params(spark: SparkSession, sf: str) -> DataFrame:
    """Priors and the log probability of every term that a class of documents shows."""
    rows = word_vectors(spark, sf)
    model = SP.fit_naive_bayes(rows.where(F.col("doc_id") % _HELD_OUT != 0))
    return model.terms.join(F.broadcast(model.classes), "label").select("label", "dim", F.round("theta", 9).alias("theta"), F.round("prior", 9).alias("prior"))


@register("sparse_nb_predict", sql=f"""{_COUNTS_SQL},
scored AS (
  SELECT d.doc_id, d.label AS truth, cls.label, any_value(prior) + sum(x * (ln(coalesce(s, 0) + 1.0) - below)) AS score
  FROM docs d JOIN c USING (doc_id) JOIN vocab USING (word) CROSS JOIN cls LEFT JOIN train t ON t.label = cls.label AND t.dim = vocab.dim
  WHERE d.doc_id % {_HELD_OUT} = 0 GROUP BY d.doc_id, d.label, cls.label)
SELECT doc_id, any_value(truth) AS label, arg_max(label, score) AS prediction, round(max(score), 5) AS score FROM scored GROUP BY doc_id
""")
def q_sparse_nb_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out documents: their label, the likeliest class and its joint log likelihood."""
    rows = word_vectors(spark, sf)
    model = SP.fit_naive_bayes(rows.where(F.col("doc_id") % _HELD_OUT != 0))
    test = rows.where(F.col("doc_id") % _HELD_OUT == 0)
    scores = cut_lineage(model.scores(test, ["doc_id"]))
    best = scores.groupBy("doc_id").agg(F.max(F.struct("score", (-F.col("label")).alias("low"))).alias("b"))
    return best.join(test.select("doc_id", "label"), "doc_id").select("doc_id", "label", (-F.col("b.low")).alias("prediction"), F.round("b.score", 5).alias("score"))
