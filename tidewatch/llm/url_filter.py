"""URL filters by hashed host-suffix and path-prefix expressions (operator 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import pack, small, stored, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (verdict, host, path) of the registered query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Hex digits of the digest that the join compares first (four bytes).
PREFIX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A small list of rules as a table (verdict, host, path)."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict (replaced if present).

    A rule (verdict allow or block, host, path) fits its host and all
    subdomains if the path starts with the rule's. Of the rules that fit, the
    longest (host and path together) wins; among equals a block.
    Without one, rule is null and verdict is ``default``.

    Distinct (host, path) are expanded into every host suffix and path prefix of
    a shape (labels, characters) that some rule has; the expressions meet the
    rules' on the first four bytes of the SHA-256, the full digests are then
    compared. The number of expressions depends on the rules' shapes, not on
    the url's length. Shapes are collected: at most labels x characters of the
    longest rule. The rules are broadcast if few, else shuffled.

    Null urls and those without ``://`` have empty host and path, which no
    rule fits. Repeated rows are judged alike; an empty table or an empty rule
    list gives no rule anywhere.
    """
    kept, unpack = pack(pages, "url")
    host, path = host_and_path(F.col("url"))
    split = kept.select("*", host.alias("host"), path.alias("path"))
    digest = lambda text: F.sha2(text, 256)
    listed = rules.where("host is not null and path is not null and host <> ''").select(
        F.translate("host", UPPER, UPPER.lower()).alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    )
    listed = stored(
        listed.select(
            "*",
            F.concat("rule_host", "rule_path").alias("rule"),
            F.size(F.split("rule_host", r"\.")).alias("labels"),
            F.length("rule_path").alias("letters"),
            digest(F.concat("rule_host", "rule_path")).alias("rule_digest"),
        ).select("*", F.substring("rule_digest", 1, PREFIX).alias("short")),
        "url-rules",
    )
    shapes = sorted((r.labels, r.letters) for r in listed.select("labels", "letters").distinct().collect())
    parts = F.split("host", r"\.")
    expressions = [
        F.when(
            (F.size(parts) >= labels) & (F.length("path") >= letters),
            F.concat(F.array_join(F.slice(parts, -labels, labels), "."), F.substring("path", 1, letters)),
        )
        for labels, letters in shapes
    ]
    some = F.array(*expressions) if expressions else F.array().cast("array<string>")
    asked = (
        split.select("host", "path")
        .where("host <> ''")
        .distinct()
        .select("host", "path", F.explode(F.array_compact(some)).alias("expression"))
        .select("host", "path", digest(F.col("expression")).alias("digest"))
        .select("*", F.substring("digest", 1, PREFIX).alias("short"))
    )
    confirmed = asked.join(small(listed), "short").where(F.col("digest") == F.col("rule_digest"))
    order = F.struct(F.length("rule"), F.length("rule_host"), F.col("rule_verdict"))
    found = confirmed.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "rule_verdict"), order).alias("won")
    )
    judged = split.join(found, ["host", "path"], "left").select(
        *[F.col(c) for c in kept.columns],
        "host",
        "path",
        F.col("won.rule").alias("rule"),
        F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict"),
    )
    return unpack(judged, "host", "path", "rule", "verdict")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
with rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r from pages
),
split as (
  select page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, coalesce(r, '') as r from rest)
),
rules(v, h, p) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
won as (
  select host, path, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as verdict
  from (select distinct host, path from split)
  join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by host, path
)
select page_id, split.host, split.path, rule, coalesce(verdict, 'allow') as verdict
from split left join won on split.host = won.host and split.path = won.path
"""
