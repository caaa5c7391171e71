"""URL filters: host-suffix and path-prefix expressions, joined to rules on short hash prefixes.

Every URL is expanded to expressions of a host suffix and a path prefix, with a separator that no host holds, for the label counts and path
lengths that occur among the rules.  Expressions and rules are equi-joined on the first 32 bits of
their SHA-256 and confirmed on the whole digest.  The longest fitting rule (host and path together,
then host) wins; of two equal rules with different verdicts, block wins.

Only distinct (host, path) pairs are expanded, so a repeated URL costs one expansion; verdicts are
joined back on (host, path).  Neither side is collected: the driver learns just the sets of label
counts and path lengths among the rules, which the longest URL bounds.

Defined cases: a null URL or one without ``://`` has empty host and path and gets the default
verdict; equal URLs get equal verdicts and every input row stays; rules with a null or empty host
or null path fit nothing; no rules leaves the default everywhere; input columns named like an
output column are replaced, others are passed through; URLs of any length are expanded whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, read_table, without

ALLOW, BLOCK = "allow", "block"
#: Hex digits of the digest that expressions and rules are joined on.
PREFIX_DIGITS = 8

#: Stands between host and path where they are hashed; in a host it would end it.
BETWEEN = "?"

#: The rules of op1: (host, path, verdict).
RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All expressions of one URL: suffixes of ``labels`` labels with path prefixes of ``lengths`` characters."""
    parts = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, labels)), lambda k: k <= F.size(parts)),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + F.lit(1), k), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path)),
        lambda n: F.substring(path, F.lit(1), n),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit(BETWEEN), p))))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """``df`` with host, path, rule (null where none fits) and verdict.  ``rules``: host, path, verdict."""
    rules = rules.select(
        F.translate(F.col("host"), string.ascii_uppercase, string.ascii_lowercase).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    ).where((F.col("r_host") != "") & F.col("r_path").isNotNull() & F.col("r_verdict").isNotNull())
    shapes = rules.agg(
        F.collect_set(F.size(F.split("r_host", r"\.", -1))).alias("labels"), F.collect_set(F.length("r_path")).alias("lengths")
    ).first()
    base = without(df, ["host", "path", "rule", "verdict"])
    if url not in base.columns:
        base = df
    host, path = host_and_path(quoted(url))
    urls = base.withColumns({"__tm_host": host, "__tm_path": path})
    if not shapes["labels"]:
        judged = urls.withColumns({"__tm_rule": F.lit(None).cast("string"), "__tm_verdict": F.lit(default)})
    else:
        digest = lambda c: F.sha2(c.cast("binary"), 256)
        coded = rules.select(
            F.concat("r_host", "r_path").alias("rule"),
            (F.length("r_host") + F.length("r_path")).alias("size"),
            F.length("r_host").alias("host_size"),
            "r_verdict",
            F.concat("r_host", F.lit(BETWEEN), "r_path").alias("expr"),
        ).withColumn("r_digest", digest(F.col("expr"))).drop("expr")
        coded = coded.withColumn("short", F.substring("r_digest", 1, PREFIX_DIGITS))
        keys = urls.where(F.col("__tm_host") != "").select("__tm_host", "__tm_path").distinct()
        expanded = keys.select(
            "__tm_host", "__tm_path", F.explode(expressions(F.col("__tm_host"), F.col("__tm_path"), sorted(shapes["labels"]), sorted(shapes["lengths"]))).alias("expr")
        ).withColumn("digest", digest(F.col("expr")))
        expanded = expanded.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        best = (
            expanded.join(coded, "short")
            .where(F.col("digest") == F.col("r_digest"))
            .groupBy("__tm_host", "__tm_path")
            .agg(F.max(F.struct("size", "host_size", "r_verdict", "rule")).alias("best"))
            .select("__tm_host", "__tm_path", F.col("best.rule").alias("__tm_rule"), F.col("best.r_verdict").alias("__tm_verdict"))
        )
        judged = urls.join(best, ["__tm_host", "__tm_path"], "left").withColumn("__tm_verdict", F.coalesce("__tm_verdict", F.lit(default)))
    rest = [c for c in base.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return judged.select(
        *[quoted(c) for c in rest],
        F.col("__tm_host").alias("host"),
        F.col("__tm_path").alias("path"),
        F.col("__tm_rule").alias("rule"),
        F.col("__tm_verdict").alias("verdict"),
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
)
SELECT page_id, host, path,
  CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
       WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM split
"""
