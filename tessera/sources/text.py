"""Line-oriented text sources and their parsers.

Every parser takes a DataFrame with one string column (``value`` by default,
the schema of ``spark.read.text``) so a file scan and a string column derived
from a table share one code path.  Parsing is pure column expressions: the
whole scan -> split -> cast pipeline stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The access-log pattern (nine groups: ip, identity, user,
# date-time, request, status, bytes, referer, user agent).
ACCESS_LOG_PATTERN = (
    r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) '
    r'([\d\-]+) "([^"]+)" "([^"]+)".*'
)
# Fixed value: the user field that marks an anonymous request.
ANONYMOUS_USER = '"-"'


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """``textFile(path[, minPartitions])``: one row per line, column ``value``."""
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def explode_lines(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Split a multi-line text column into one row per line (``value``) with
    its 0-based line number, like reading the text as a file."""
    return df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "value"))


def _require(cond: Column, msg: str, value: Column) -> Column:
    """Raise at run time when ``cond`` is false, else return ``value``."""
    return F.when(cond, value).otherwise(F.raise_error(F.lit(msg)))


def parse_dense_vectors(df: DataFrame, col: str = "value", out: str = "features") -> DataFrame:
    """``"0.5 1.0"`` -> ``array<double>``; split on single spaces, a bad token throws."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.split(F.col(col), " ").cast("array<double>").alias(out))


def parse_labeled_points(df: DataFrame, dims: int, col: str = "value") -> DataFrame:
    """``"y x1 ... xD"`` -> ``y double, x array<double>`` (first D after y;
    extra tokens ignored, too few throw)."""
    tok = F.split(F.col(col), " ")
    others = [c for c in df.columns if c != col]
    return df.select(
        *others,
        _require(F.size(tok) > dims, "labeled point has too few tokens",
                 tok[0].cast("double")).alias("y"),
        F.slice(tok, 2, dims).cast("array<double>").alias("x"),
    )


def parse_label_csv(df: DataFrame, col: str = "value") -> DataFrame:
    """``"label,f0 f1 f2"`` -> ``label double, features array<double>``."""
    parts = F.split(F.col(col), ",", 2)
    others = [c for c in df.columns if c != col]
    return df.select(
        *others,
        parts[0].cast("double").alias("label"),
        F.split(F.trim(parts[1]), " ").cast("array<double>").alias("features"),
    )


def parse_bracket_points(df: DataFrame, col: str = "value") -> DataFrame:
    """``"(1.0,[2.0,3.0])"`` -> ``label double, features array<double>``."""
    c = F.col(col)
    label = F.regexp_extract(c, r"^\s*\(\s*([^,\s]+)\s*,", 1)
    body = F.regexp_extract(c, r"\[([^\]]*)\]", 1)
    ok = c.rlike(r"^\s*\(\s*[^,\s]+\s*,\s*\[[^\]]*\]\s*\)\s*$")
    others = [x for x in df.columns if x != col]
    return df.select(
        *others,
        _require(ok, "malformed labeled point", label.cast("double")).alias("label"),
        F.when(F.trim(body) == "", F.array().cast("array<double>"))
         .otherwise(F.split(F.regexp_replace(body, r"\s", ""), ",").cast("array<double>"))
         .alias("features"),
    )


def parse_libsvm(df: DataFrame, num_features: int = -1, col: str = "value") -> DataFrame:
    """``"label i:x j:y ..."`` -> ``label double, size int, indices array<int>, values
    array<double>``; indices are 1-based and ascending in the text, 0-based in the result.
    Blank lines and lines that start with ``#`` are skipped, a bad token throws.

    ``num_features`` of -1 infers the dimension: a job takes the largest index of the
    scan, one number.  A given dimension is checked against each row instead."""
    others = [c for c in df.columns if c != col]
    line = F.trim(F.col(col))
    tok = F.filter(F.split(line, r"\s+"), lambda t: t != "")
    pairs = F.transform(F.slice(tok, 2, F.size(tok)), lambda t: F.split(t, ":"))
    rows = df.where((line != "") & ~line.startswith("#")).select(*others, tok[0].cast("double").alias("label"), pairs.alias("p"))
    raw = rows.select(*others, "label", F.transform("p", lambda x: _require(F.size(x) == 2, "entry is not index:value", x[0]).cast("int") - 1).alias("indices"),
                      F.transform("p", lambda x: x[1].cast("double")).alias("values"))
    first, last = F.get("indices", F.lit(0)), F.get("indices", F.size("indices") - 1)
    if num_features < 0:
        top = raw.agg(F.max(last)).first()[0]
        num_features = 0 if top is None else top + 1
    empty = F.size("indices") == 0
    ok = empty | ((first >= 0) & (last < num_features) & (F.array_sort(F.array_distinct("indices")) == F.col("indices")))
    return raw.select(*others, "label", F.lit(num_features).alias("size"),
                      _require(ok, "indices must ascend from 1 and stay within the dimension", F.col("indices")).alias("indices"), "values")


def read_libsvm(spark: SparkSession, path: str, num_features: int = -1, min_partitions: int | None = None) -> DataFrame:
    """``loadLibSVMFile(path[, numFeatures[, minPartitions]])`` as sparse rows."""
    return parse_libsvm(read_lines(spark, path, min_partitions), num_features)


def to_libsvm(df: DataFrame) -> DataFrame:
    """The text lines (``value``) of sparse rows."""
    pair = F.transform(F.arrays_zip("indices", "values"), lambda e: F.concat((e["indices"] + 1).cast("string"), F.lit(":"), e["values"].cast("string")))
    return df.select(F.concat_ws(" ", F.col("label").cast("string"), F.array_join(pair, " ")).alias("value"))


def parse_edges(df: DataFrame, col: str = "value") -> DataFrame:
    """Edge list ``"a b"`` split on any whitespace; tokens 0 and 1 are used,
    extra tokens are ignored, a single token throws."""
    tok = F.split(F.trim(F.col(col)), r"\s+")
    return df.select(
        _require(F.size(tok) >= 2, "edge line needs two tokens", tok[0]).alias("src"),
        tok[1].alias("dst"),
    )


def parse_ratings(df: DataFrame, implicit: bool = False, col: str = "value") -> DataFrame:
    """``"user::item::rating[::...]"`` -> ``user int, item int, rating double``;
    in implicit mode the rating is shifted by -2.5 (negative = dislike)."""
    tok = F.split(F.col(col), "::")
    rating = tok[2].cast("double")
    if implicit:
        rating = rating - F.lit(2.5)
    return df.select(tok[0].cast("int").alias("user"), tok[1].cast("int").alias("item"),
                     rating.alias("rating"))


def parse_access_log(df: DataFrame, col: str = "value") -> DataFrame:
    """Access-log line -> ``ip, user, query`` key and ``bytes`` stat.

    * no match: null key, bytes 0;
    * user ``"-"``: null key, but the bytes still count (key and stats are
      extracted independently);
    * bytes ``-``: the pattern accepts it, the number does not parse -> 0
      (``try_cast``; the original job aborts here);
    * bytes are summed as bigint, so no 32-bit overflow.
    """
    line = F.col(col)
    matched = line.rlike(ACCESS_LOG_PATTERN)
    g = lambda i: F.regexp_extract(line, ACCESS_LOG_PATTERN, i)
    keyed = matched & (g(3) != F.lit(ANONYMOUS_USER))
    nbytes = F.when(matched, F.coalesce(g(7).try_cast("bigint"), F.lit(0))).otherwise(F.lit(0))
    return df.select(
        F.when(keyed, g(1)).alias("ip"),
        F.when(keyed, g(3)).alias("user"),
        F.when(keyed, g(5)).alias("query"),
        nbytes.cast("bigint").alias("bytes"),
    )


def line_lengths(df: DataFrame, col: str = "value") -> DataFrame:
    """``map(_.length)``: characters per line."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.length(F.col(col)).alias("len"))
