"""Block and allow rules on URLs, found by hashes of host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hex digits of a digest on which expressions and rules are joined.
SHORT = 8
#: What a url gets that no rule fits.
DEFAULT = "allow"
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(url, _PARTS, 2)


def rules_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """(host, path, verdict) from a few rules as a relation of literals; large rule sets are DataFrames already."""
    rows = F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]))
    return spark.range(1).select(rows)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per row of pages: id_col, host, path, rule, verdict. Other columns of pages are not read.

    A url is expanded into each of its host's suffixes (as many labels as rules have) with each of its path's prefixes
    (of the lengths that rules have). Expressions and rules are joined on short hash prefixes, so that the join's key is
    small; full digests confirm. The longest rule wins (host and path together; then the longer host, then block).
    Null urls and such without ``://`` have empty host and path. Repeated rows stay. Of rules that repeat a host and
    path, block wins; rules with nulls fit nothing. Without a rule: rule is null, verdict the default.

    Spark broadcasts the rules only if they are small; else both sides are shuffled, and skewed keys are split.
    """
    known = rules.select(F.translate("host", _UPPER, _LOWER).alias("h"), F.col("path").alias("p"), "verdict").where("h is not null and p is not null and verdict is not null")
    shape = known.agg(F.max(F.size(F.split("h", r"\."))), F.collect_set(F.length("p"))).first()
    labels, lengths = shape[0] or 0, sorted(shape[1])
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    fit = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(fit, lambda n: F.sha2(F.concat(s, F.lit("\n"), F.substring(F.col("path"), F.lit(1), n)), 256))))
    spread = rows.select("row", "id", "host", "path", F.explode_outer(expressions).alias("digest")).withColumn("short", F.substring("digest", 1, SHORT))
    named = known.select(
        F.sha2(F.concat("h", F.lit("\n"), "p"), 256).alias("full"),
        F.struct((F.length("h") + F.length("p")).alias("long"), F.length("h").alias("host"), (F.col("verdict") == "block").alias("block"), F.concat("h", "p").alias("rule"), "verdict").alias("found"),
    ).withColumn("key", F.substring("full", 1, SHORT))
    met = spread.join(named, F.col("short") == F.col("key"), "left").withColumn("found", F.when(F.col("digest") == F.col("full"), F.col("found")))
    won = met.groupBy("row").agg(F.max("id").alias("id"), F.max("host").alias("host"), F.max("path").alias("path"), F.max("found").alias("won"))
    return won.select(F.col("id").alias(id_col), "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
