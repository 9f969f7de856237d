"""Operator 3: URL filters by rules and by link-graph propagation.

A rule (action, host, path) fits the urls of its host and all subdomains whose
path starts with its path; the longest fitting rule decides.  Other urls are
judged by their host: trust starts at hosts in the share of their pages that rules
allow and follows the links of their pages (personalised PageRank), distrust
starts in the share that rules block and follows links backwards, to hosts that
link to bad ones.  Both are computed in ``ROUNDS`` rounds over weighted host
edges, and a host whose distrust exceeds its trust by ``LIMIT`` (1 is the distrust
of a host with all pages blocked and no links) is blocked.

Links are the absolute (or scheme-relative) href targets of the pages' html; a
relative link stays on its host and carries nothing.

Cases: a null url or one without ``://`` has empty host and path, no rule and
verdict allow; null html has no links; repeated pages count each time; with no
links hosts are judged by their seeds alone; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .written import written

DAMPING = 0.85
ROUNDS = 20
LIMIT = 0.5
#: rounds between two written tables
CUT = 5
HREF = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
Rule = tuple[str, str, str]


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return _lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, action) of the longest rule that fits, or nulls."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first, outermost
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, action = F.when(fits, h + p).otherwise(name), F.when(fits, act).otherwise(action)
    return name, action


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, share): links between different hosts, each host's shares summing to 1."""
    links = (pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1))).alias("dst"))
             .select("src", _lower(F.col("dst")).alias("dst")).filter("src <> '' AND src <> dst")
             .groupBy("src", "dst").agg(F.count("*").alias("n")))
    return links


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) from seeds (host, allowed, blocked) over edges
    (src, dst, n).  Both walks run together, told apart by ``back``."""
    two = (edges.select(F.lit(False).alias("back"), "src", "dst", "n")
           .unionByName(edges.select(F.lit(True).alias("back"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")))
    total = two.groupBy("back", "src").agg(F.sum("n").alias("total"))
    two = written(two.join(total, ["back", "src"]).select("back", "src", "dst", (F.col("n") / F.col("total")).alias("share")), "host-edges")
    seed = (seeds.select(F.lit(False).alias("back"), "host", F.col("allowed").alias("seed"))
            .unionByName(seeds.select(F.lit(True).alias("back"), "host", F.col("blocked").alias("seed"))).filter("seed > 0"))
    seed = written(seed, "host-seeds")
    rank = seed.withColumnRenamed("seed", "r")
    if two.limit(1).count():
        for i in range(rounds):
            flow = (two.join(rank.withColumnRenamed("host", "src"), ["back", "src"])
                    .select("back", F.col("dst").alias("host"), (F.col("share") * F.col("r") * damping).alias("r")))
            rank = (flow.unionByName(seed.select("back", "host", (F.col("seed") * (1 - damping)).alias("r")))
                    .groupBy("back", "host").agg(F.sum("r").alias("r")))
            if i % CUT == CUT - 1 or i == rounds - 1:
                rank = written(rank, "host-ranks")
    else:
        rank = rank.withColumn("r", F.col("r") * (1 - damping))
    scale = 1 / (1 - damping)
    side = [F.sum(F.when(F.col("back") == b, F.col("r") * scale).otherwise(0.0)).alias(n) for b, n in ((False, "trust"), (True, "distrust"))]
    return rank.groupBy("host").agg(*side)


def judge(pages: DataFrame, rules: list[Rule], limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row (page_id, url, html)."""
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("action", action)
    hosts = (rows.filter("host <> ''").groupBy("host")
             .agg(F.count("*").alias("pages"), *(F.sum((F.coalesce(F.col("action"), F.lit("")) == a).cast("long")).alias(a) for a in ("allow", "block")))
             .select("host", (F.col("allow") / F.col("pages")).alias("allowed"), (F.col("block") / F.col("pages")).alias("blocked")))
    ranks = propagate(host_edges(rows), hosts)
    bad = written(ranks.filter(F.round(F.col("distrust") - F.col("trust"), 9) >= limit).select("host", F.lit("block").alias("method")), "blocked-hosts")
    out = rows.select("page_id", "host", "path", "rule", "action").join(bad, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", "method", F.lit("allow")).alias("verdict"))


def oracle_sql(rules: list[Rule], rounds: int = ROUNDS, damping: float = DAMPING, limit: float = LIMIT) -> str:
    """The same judgement for DuckDB, the rounds written out."""
    cases = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def pick(out):
        return "CASE " + " ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{out((a, h, p))}'" for a, h, p in cases) + " END"
    steps = ["r0 AS MATERIALIZED (SELECT back, host, seed AS r FROM seed)"]
    for i in range(1, rounds + 1):
        steps.append(f"""r{i} AS MATERIALIZED (SELECT back, host, sum(r) AS r FROM (
  SELECT e.back, e.dst AS host, e.share * r.r * {damping} AS r FROM edge e JOIN r{i - 1} r ON e.back = r.back AND e.src = r.host
  UNION ALL SELECT back, host, seed * {1 - damping} FROM seed) GROUP BY ALL)""")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    href = HREF.replace("'", "''")
    return f"""
WITH u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, html, {lower.format("regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1)")} AS host,
       regexp_extract(coalesce(rest, ''), '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
p AS MATERIALIZED (SELECT *, {pick(lambda r: r[1] + r[2])} AS rule, {pick(lambda r: r[0])} AS act FROM hp),
h AS (SELECT host, avg(CASE WHEN act = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed, avg(CASE WHEN act = 'block' THEN 1.0 ELSE 0.0 END) AS blocked
      FROM p WHERE host <> '' GROUP BY host),
l AS (SELECT src, dst, count(*) AS n FROM (SELECT host AS src, {lower.format("dst")} AS dst FROM (
        SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS dst FROM p)) WHERE src <> '' AND src <> dst GROUP BY ALL),
edge AS MATERIALIZED (SELECT back, src, dst, n / sum(n) OVER (PARTITION BY back, src) AS share FROM (
        SELECT false AS back, src, dst, n FROM l UNION ALL SELECT true, dst, src, n FROM l)),
seed AS MATERIALIZED (SELECT * FROM (SELECT false AS back, host, allowed AS seed FROM h UNION ALL SELECT true, host, blocked FROM h) WHERE seed > 0),
{", ".join(steps)},
bad AS (SELECT host FROM r{rounds} GROUP BY host
        HAVING round(sum(CASE WHEN back THEN r ELSE -r END) / {1 - damping}, 9) >= {limit})
SELECT page_id, host, path, rule, CASE WHEN act IS NOT NULL THEN act WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM p
"""
