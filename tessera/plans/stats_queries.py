"""Statistics and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import stats as S
from ..sources.tables import table
from .registry import register

_SUMMARY_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _summary_sql() -> str:
    parts = []
    for c in _SUMMARY_COLS:
        parts.append(f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(var_samp({c}), 4) AS variance,
       CAST(sum(CASE WHEN {c} <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nnz,
       CAST(max({c}) AS DOUBLE) AS max, CAST(min({c}) AS DOUBLE) AS min FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@register("column_summary", sql=_summary_sql())
def q_column_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = S.column_summary(table(spark, sf, "lineitem"), _SUMMARY_COLS)
    return s.select("column", F.round("mean", 6).alias("mean"), F.round("variance", 4).alias("variance"),
                    "nnz", "max", "min")


@register("label_feature_corr", sql="""
SELECT 'l_quantity' AS feature, round(corr(l_extendedprice, l_quantity), 6) AS corr FROM lineitem
UNION ALL SELECT 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem
UNION ALL SELECT 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem
""")
def q_label_feature_corr(spark: SparkSession, sf: str) -> DataFrame:
    c = S.label_correlations(table(spark, sf, "lineitem"), "l_extendedprice",
                             ["l_quantity", "l_discount", "l_tax"])
    return c.select("feature", F.round("corr", 6).alias("corr"))


@register("accuracy", sql="""
WITH p AS (SELECT (list_position(embedding, list_max(embedding)) - 1) % 10 AS prediction, label FROM embeddings)
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM p
""")
def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of a fixed rule over the whole vector: predicted class = position
    of the largest component, modulo the ten classes."""
    e = table(spark, sf, "embeddings")
    pred = e.select((V.argmax("embedding") % 10).alias("prediction"), F.col("label"))
    a = S.accuracy(pred)
    return a.select("n", "correct", F.round("accuracy", 6).alias("accuracy"))


@register("auc_roc", sql="""
WITH d AS (
  SELECT CAST(d.n_chars AS DOUBLE) AS s, l.quality AS y FROM documents d JOIN labels l USING (doc_id)
), g AS (
  SELECT s, sum(CASE WHEN y > 0 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN y > 0 THEN 0 ELSE 1 END) AS q FROM d GROUP BY s
), c AS (
  SELECT s, p, q, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g
)
SELECT round(sum(p * (below + 0.5 * q)) / (sum(p) * sum(q)), 6) AS auc,
       CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(q) AS BIGINT) AS n_neg FROM c
""")
def q_auc_roc(spark: SparkSession, sf: str) -> DataFrame:
    """AUC of document length as a quality score (labels.quality)."""
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    a = S.auc_roc(d.join(lab, "doc_id"))
    return a.select(F.round("auc", 6).alias("auc"), F.col("n_pos").cast("bigint").alias("n_pos"),
                    F.col("n_neg").cast("bigint").alias("n_neg"))


@register("auc_pr", sql="""
WITH d AS (
  SELECT CAST(d.n_chars AS DOUBLE) AS s, l.quality AS y FROM documents d JOIN labels l USING (doc_id)
), g AS (
  SELECT s, sum(CASE WHEN y > 0 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN y > 0 THEN 0 ELSE 1 END) AS q FROM d GROUP BY s
), c AS (
  SELECT s, p, sum(p) OVER w AS tp, sum(q) OVER w AS fp FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)
), r AS (
  SELECT s, p, tp / (tp + fp) AS prec FROM c
)
SELECT round(sum(p * (prec + coalesce(before, prec)) / 2) / sum(p), 6) AS auc_pr,
       CAST(sum(p) AS BIGINT) AS n_pos, (SELECT CAST(sum(q) AS BIGINT) FROM g) AS n_neg
FROM (SELECT *, lag(prec) OVER (ORDER BY s DESC) AS before FROM r)
""")
def q_auc_pr(spark: SparkSession, sf: str) -> DataFrame:
    """Area under the precision-recall curve of document length as a quality score."""
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    a = S.pr_area(d.join(lab, "doc_id"))
    return a.select(F.round("auc_pr", 6).alias("auc_pr"), F.col("n_pos").cast("bigint").alias("n_pos"),
                    F.col("n_neg").cast("bigint").alias("n_neg"))
