"""URL filters: pattern rules found through their rarest literal token.

Every rule is a regular expression over ``host || path`` and lists literal tokens
that each URL it can match holds as whole tokens. The rule is indexed under the one
of them that is rarest among the URLs at hand. The tokens of a URL fetch its candidate
rules, and only these run their regular expression. DataFrame functions only.

A URL that is null or has no ``://`` has an empty host and path and gets the verdict
of no rule. Equal URLs are judged once. No row is dropped; other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadweld.llm.tables import maybe_broadcast, upper_to_lower

#: Rules up to this number are sent to every task; more of them are shuffled by token.
BROADCAST_RULES = 100_000

RULE_SCHEMA = "rule string, verdict string, pattern string, tokens array<string>, level int, length int"


@dataclass(frozen=True)
class Rule:
    """``level`` goes before ``length`` when several rules match."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    level: int = 0

    def row(self) -> tuple:
        return (self.name, self.verdict, self.pattern, list(self.tokens), self.level, len(self.name))


def site_rule(verdict: str, site: str, level: int = 1) -> Rule:
    """A host with its subdomains and the start of a path, such as ``example.net/en/``."""
    host, slash, path = site.partition("/")
    whole = slash + path
    # The last piece of a path that goes on in the URL need not be a whole token.
    literal = host + re.sub(r"[A-Za-z0-9]+$", "", whole)
    return Rule(
        site,
        verdict,
        r"^(?:[^/]*\.)?" + "".join(c if c.isalnum() else "\\" + c for c in host + whole),
        tuple(sorted(set(re.findall(r"[a-z0-9]+", literal.lower())))),
        level,
    )


def token_rule(verdict: str, token: str) -> Rule:
    """A lower-case token anywhere in host or path."""
    return Rule(token, verdict, rf"(?i)(?:^|[^a-z0-9]){token}(?:[^a-z0-9]|$)", (token,))


def host_of(url: Column) -> Column:
    return upper_to_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rules with the token they are found by; those without any are found by the empty token."""
    wanted = rules.select("rule", F.explode("tokens").alias("token"))
    counts = (
        tokens.join(maybe_broadcast(wanted.select("token").distinct(), BROADCAST_RULES), "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("rule")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("least"))
        .select("rule", F.col("least.token").alias("token"))
    )
    return rules.join(rarest, "rule", "left").withColumn("token", F.coalesce("token", F.lit("")))


def judge_urls(
    urls: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per different URL: host, path, the winning rule, its level and the verdict."""
    spark = urls.sparkSession
    table = spark.createDataFrame([r.row() for r in rules], RULE_SCHEMA)
    different = urls.select(F.col(url).alias("url")).distinct()
    parsed = different.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    target = F.concat("host", "path")
    tokens = F.array_union(
        F.array_distinct(F.split(F.lower(target), "[^a-z0-9]+")), F.array(F.lit(""))
    )
    keyed = parsed.select("url", target.alias("target"), F.explode(tokens).alias("token"))
    index = maybe_broadcast(_indexed(table, keyed.select("token")), BROADCAST_RULES)
    best = (
        keyed.join(index, "token")
        .where(F.rlike("target", F.col("pattern")))
        .groupBy("url")
        .agg(F.max(F.struct("level", "length", "rule", "verdict")).alias("best"))
    )
    return parsed.join(best, "url", "left").select(
        "url",
        "host",
        "path",
        F.col("best.rule").alias("matched"),
        F.col("best.level").alias("level"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


#: The rules of the query, and tokens that the method blocks by itself.
SITES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BLOCKED_TOKENS = ("casino", "gambling", "porn", "viagra", "xxx")


def op7_url_filters(pages: DataFrame) -> DataFrame:
    """Verdict for every page; a tie of lengths goes to the greater rule name."""
    rules = [site_rule(v, s) for v, s in SITES] + [token_rule("block", t) for t in BLOCKED_TOKENS]
    judged = judge_urls(pages, rules).withColumnRenamed("url", "_judged")
    rows = pages.select("page_id", "url")
    # No URL is missing among the judged ones but null, which equals nothing.
    return rows.join(judged, F.col("url") == F.col("_judged"), "left").select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.when(F.col("level") == 1, F.col("matched")).alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )


_VALUES = ", ".join(f"('{v}', '{s.split('/', 1)[0]}', '/{s.split('/', 1)[1]}')" for v, s in SITES)
ORACLE = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), fits AS (
  SELECT p.host, p.path, max(struct_pack(n := length(r.host || r.path), rule := r.host || r.path, verdict := r.verdict)) AS best
  FROM (SELECT DISTINCT host, path FROM parsed) p
  JOIN (VALUES {_VALUES}) r(verdict, host, path)
    ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path
)
SELECT page_id, p.host, p.path, best.rule AS rule,
       CASE WHEN best IS NOT NULL THEN best.verdict
            WHEN regexp_matches(lower(p.host || p.path), '(^|[^a-z0-9])({"|".join(BLOCKED_TOKENS)})([^a-z0-9]|$)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM parsed p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path
"""
