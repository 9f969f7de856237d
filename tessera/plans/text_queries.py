"""Text sources and parsers (S1-S9) run over lines formatted from the driver
tables, so the parse work grows with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import log_rollup
from ..sources import text as T
from ..sources.tables import table
from ..plans.session import shared_path
from .registry import register


# ---------------------------------------------------------------- S1/P1/K5
@register("line_lengths", sql=r"""
SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
       CAST(length(unnest(string_split(text, chr(10)))) AS INTEGER) AS len
FROM documents
""")
def q_line_lengths(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.explode_lines(table(spark, sf, "documents"), "text", keep=("doc_id",))
    return T.line_lengths(lines).select("doc_id", F.col("line_no").cast("int").alias("line_no"), "len")


@register("line_scan", sql=r"""
SELECT CAST(length(line) AS INTEGER) AS len, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM documents) GROUP BY 1
""")
def q_line_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as text files, scanned line by line: lines of each length."""
    path = shared_path(spark, "document-lines")
    table(spark, sf, "documents").select(F.translate("text", "\r", " ").alias("value")).where("value IS NOT NULL").write.text(path)
    lines = T.line_lengths(T.read_lines(spark, path, min_partitions=2))
    return lines.groupBy(F.col("len").cast("int").alias("len")).agg(F.count(F.lit(1)).alias("n"))


def format_vector(col: str) -> F.Column:
    """array<float|double> -> "x1 x2 ..." (exact double text, so parsing
    gives back the stored value)."""
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("double").cast("string")), " ")


# ---------------------------------------------------------------- S2
@register("parse_dense_vectors", sql="""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_dims,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS elem_sum,
       round(CAST(list_min(embedding) AS DOUBLE), 6) AS elem_min,
       round(CAST(list_max(embedding) AS DOUBLE), 6) AS elem_max
FROM embeddings
""")
def q_parse_dense_vectors(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "embeddings").select("vec_id", format_vector("embedding").alias("value"))
    v = T.parse_dense_vectors(lines)
    return v.select(
        "vec_id", F.size("features").alias("n_dims"),
        F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("elem_sum"),
        F.round(F.array_min("features"), 6).alias("elem_min"),
        F.round(F.array_max("features"), 6).alias("elem_max"))


def lineitem_lr_line() -> F.Column:
    """``"y x1 x2 x3 x4 extra"`` with y = +1 for returned items, else -1."""
    y = F.when(F.col("l_returnflag") == "R", F.lit("1.0")).otherwise(F.lit("-1.0"))
    return F.concat_ws(" ", y, *[F.col(c).cast("string") for c in
                                 ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")])


# ---------------------------------------------------------------- S3
@register("parse_labeled_points", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE -1.0 END::DOUBLE AS y,
       l_quantity AS x0, l_extendedprice AS x1, l_discount AS x2, l_tax AS x3
FROM lineitem
""")
def q_parse_labeled_points(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    lines = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", lineitem_lr_line().alias("value"))
    p = T.parse_labeled_points(lines, dims=4)
    return p.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "y",
                    *[F.col("x")[i].alias(f"x{i}") for i in range(4)])


# ---------------------------------------------------------------- S5
@register("parse_label_csv", sql="""
SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(len(embedding) AS INTEGER) AS n_features,
       round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS feature_sum
FROM embeddings
""")
def q_parse_label_csv(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    lines = e.select("vec_id", F.concat(F.col("label").cast("string"), F.lit(","),
                                        format_vector("embedding")).alias("value"))
    p = T.parse_label_csv(lines)
    return p.select("vec_id", "label", F.size("features").alias("n_features"),
                    F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"))


# ---------------------------------------------------------------- S6
@register("parse_bracket_points", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS label,
       l_extendedprice AS f0, l_discount AS f1, l_tax AS f2, 3 AS n_features
FROM lineitem
""")
def q_parse_bracket_points(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    s = lambda c: F.col(c).cast("string")
    lines = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                      F.concat(F.lit("("), s("l_quantity"), F.lit(",["), s("l_extendedprice"), F.lit(","),
                               s("l_discount"), F.lit(","), s("l_tax"), F.lit("])")).alias("value"))
    p = T.parse_bracket_points(lines)
    return p.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "label",
                    *[F.col("features")[i].alias(f"f{i}") for i in range(3)],
                    F.size("features").alias("n_features"))


def ratings_lines(li: DataFrame) -> DataFrame:
    """``"supplier::part::stars::linenumber"``, stars = ceil(quantity / 10)
    in 1..5; the fourth field is ignored by the parser."""
    return li.select(F.concat_ws("::", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"),
                                 F.ceil(F.col("l_quantity") / 10).cast("string"),
                                 F.col("l_linenumber").cast("string")).alias("value"))


# ---------------------------------------------------------------- S8
@register("parse_ratings", sql="""
SELECT CAST(l_suppkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
       CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating,
       CAST(ceil(l_quantity / 10) AS DOUBLE) - 2.5 AS rating_implicit
FROM lineitem
""")
def q_parse_ratings(spark: SparkSession, sf: str) -> DataFrame:
    lines = ratings_lines(table(spark, sf, "lineitem"))
    exp = T.parse_ratings(lines)
    return exp.select("user", "item", "rating", (F.col("rating") - 2.5).alias("rating_implicit"))


def events_log_lines(events: DataFrame) -> DataFrame:
    """Access-log lines from ``events``: ip from the user id, anonymous user
    for errors, ``-`` bytes for values below 5, an unparsable line (no
    brackets around the date) for views of value >= 300."""
    uid = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), F.floor(uid / 256).cast("string"), F.pmod(uid, F.lit(256)).cast("string"))
    user = F.when(F.col("event_type") == "error", F.lit('"-"')).otherwise(F.concat(F.lit('"u'), uid.cast("string"), F.lit('"')))
    date = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))
    date_field = F.when((F.col("event_type") == "view") & (F.col("value") >= 300), date) \
                  .otherwise(F.concat(F.lit("["), date, F.lit("]")))
    nbytes = F.when(F.col("value") < 5, F.lit("-")).otherwise(F.floor("value").cast("string"))
    req = F.concat(F.lit('"GET /'), F.col("event_type"), F.lit(' HTTP/1.1"'))
    agent = F.concat(F.lit('"agent/'), F.get_json_object("props", "$.k"), F.lit('"'))
    return events.select(F.concat_ws(" ", ip, F.lit("-"), user, date_field, req, F.lit("200"), nbytes,
                                     F.lit('"-"'), agent).alias("value"))


LOG_PATTERN_SQL = T.ACCESS_LOG_PATTERN  # no quote characters: safe inside a SQL literal

# ---------------------------------------------------------------- S9/D1
LOG_ROLLUP_SQL = f"""
WITH lines AS (
  SELECT concat_ws('.', '10', '0', CAST(user_id // 256 AS VARCHAR), CAST(user_id % 256 AS VARCHAR)) AS ip0,
         '-' AS ident,
         CASE WHEN event_type = 'error' THEN '"-"' ELSE '"u' || CAST(user_id AS VARCHAR) || '"' END AS u0,
         strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS d0,
         event_type, value, props
  FROM events
), txt AS (
  SELECT concat_ws(' ', ip0, ident, u0,
           CASE WHEN event_type = 'view' AND value >= 300 THEN d0 ELSE '[' || d0 || ']' END,
           '"GET /' || event_type || ' HTTP/1.1"', '200',
           CASE WHEN value < 5 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END,
           '"-"', '"agent/' || json_extract_string(props, '$.k') || '"') AS line
  FROM lines
), parsed AS (
  SELECT regexp_matches(line, '{LOG_PATTERN_SQL}') AS m,
         regexp_extract(line, '{LOG_PATTERN_SQL}', 1) AS ip,
         regexp_extract(line, '{LOG_PATTERN_SQL}', 3) AS u,
         regexp_extract(line, '{LOG_PATTERN_SQL}', 5) AS q,
         regexp_extract(line, '{LOG_PATTERN_SQL}', 7) AS b
  FROM txt
)
SELECT CASE WHEN m AND u <> '"-"' THEN ip END AS ip,
       CASE WHEN m AND u <> '"-"' THEN u END AS "user",
       CASE WHEN m AND u <> '"-"' THEN q END AS query,
       CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CASE WHEN m THEN coalesce(TRY_CAST(b AS BIGINT), 0) ELSE 0 END) AS BIGINT) AS bytes
FROM parsed GROUP BY 1, 2, 3
"""


@register("log_rollup", sql=LOG_ROLLUP_SQL)
def q_log_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return log_rollup(events_log_lines(table(spark, sf, "events")))


# ---------------------------------------------------------------- S4
@register("libsvm_roundtrip", sql="""
SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
       CAST((l_quantity <> 0)::INT + (l_discount <> 0)::INT + (l_tax <> 0)::INT AS INTEGER) AS nnz,
       round(l_quantity + l_discount + l_tax, 6) AS feature_sum,
       3 AS n_features
FROM lineitem
""")
def q_libsvm_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write lineitem features as LIBSVM text into the shared folder, read
    them back with Spark's ``libsvm`` source (sparse vectors)."""
    li = table(spark, sf, "lineitem")
    label = F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0"))
    ent = lambda i, c: F.when(F.col(c) != 0, F.concat(F.lit(f"{i}:"), F.col(c).cast("string")))
    lines = li.select(F.concat_ws(" ", label, ent(1, "l_quantity"), ent(2, "l_discount"), ent(3, "l_tax")).alias("value"))
    path = shared_path(spark, "libsvm")
    lines.write.mode("overwrite").text(path)
    back = spark.read.format("libsvm").option("numFeatures", 3).load(path)
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("features")
    return back.select("label",
                       F.size(F.filter(arr, lambda x: x != 0)).alias("nnz"),
                       F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"),
                       F.size(arr).alias("n_features"))
