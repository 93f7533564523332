"""Allow and block rules for urls, by a sort-merge range join.

A host becomes a canonical key, its labels reversed and each closed by a dot
(``blog.example.net`` -> ``net.example.blog.``), so a rule's host and all its
subdomains are the keys from the rule's key up to the same text ending in
``/`` (the character after the dot): an interval, and rule intervals either
nest or are apart.  The sorted sweep puts an event at both ends of each
interval; an event carries the stack of rules active from there on (the
interval's own and those it nests in, or only the latter at its end), and each
url takes the stack of the last event at or before its key.  Of the stack's
rules whose path starts the url's path, the longest wins.

Everything is DataFrame operations.  An interval lies within one top-level
label, so the sweep runs per label, and the urls of a label are dealt evenly
over as many sweeps as there are shuffle partitions (its few events go to each
of them); no host, however frequent, is one task's work.

Defined results: a null url, or one without ``://``, has empty host and path;
equally long fitting rules are decided by the longer host, then ``block``
before ``allow``, then the greater rule text; a url no rule fits gets the
default verdict and a null rule; repeated rows stay; a rule with a null host is
ignored and a null path is empty; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import shuffle_parts

# The rules of the query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _key(host):
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit("."))


def url_parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of every url."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return pages.select("page_id", rest.alias("_rest")).select(
        "page_id", F.translate(F.regexp_extract("_rest", "^([^/?#]*)([^?#]*)", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("_rest", "^([^/?#]*)([^?#]*)", 2).alias("path"))


def _events(rules: DataFrame) -> DataFrame:
    """(key, stack): the active rules from each interval end on.

    A host's ancestors are the label prefixes of its key, found by an equi-join,
    so a stack is as deep as hosts have labels.
    """
    own = rules.where("host IS NOT NULL").select(
        F.translate("host", _UPPER, _LOWER).alias("_host"), F.coalesce("path", F.lit("")).alias("_path"), "verdict"
    ).withColumn("_key", _key(F.col("_host")))
    rule = F.struct((F.length("_host") + F.length("_path")).alias("size"), F.length("_host").alias("host_size"),
                    F.col("verdict"), F.concat("_host", "_path").alias("rule"), F.col("_path").alias("path"))
    per_key = own.groupBy("_key").agg(F.collect_set(rule).alias("_own"))
    labels = F.split(F.expr("substring(_key, 1, length(_key) - 1)"), "\\.", -1)
    nested = per_key.select("_key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("_above"))
    above = per_key.select(F.col("_key").alias("_above"), "_own")
    stacks = (nested.join(above, "_above").groupBy("_key").agg(
        F.flatten(F.collect_list("_own")).alias("_inside"),
        F.flatten(F.collect_list(F.when(F.col("_above") != F.col("_key"), F.col("_own")))).alias("_outside")))
    ends = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit("/"))
    return stacks.select(F.explode(F.array(
        F.struct(F.col("_key").alias("key"), F.col("_inside").alias("stack")),
        F.struct(ends.alias("key"), F.col("_outside").alias("stack")))).alias("_e")).select("_e.key", "_e.stack")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    parts = shuffle_parts(pages.sparkSession)
    urls = url_parts(pages).withColumn("_key", _key(F.col("host")))
    label = F.substring_index("_key", ".", 1)
    points = urls.select("page_id", "host", "path", "_key", F.lit(1).alias("_kind"),
                         F.lit(None).cast(_STACK).alias("_stack"), label.alias("_label"),
                         F.pmod(F.xxhash64("page_id", "_key", "path"), F.lit(parts)).cast("int").alias("_sweep"))
    starts = _events(rules).select(
        F.lit(None).cast(dict(urls.dtypes)["page_id"]).alias("page_id"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), F.col("key").alias("_key"), F.lit(0).alias("_kind"),
        F.col("stack").cast(_STACK).alias("_stack"),
        F.substring_index(F.regexp_replace("key", "/$", "."), ".", 1).alias("_label"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_sweep"))
    sweep = W.partitionBy("_label", "_sweep").orderBy("_key", "_kind").rowsBetween(W.unboundedPreceding, 0)
    swept = points.unionByName(starts).withColumn("_active", F.last("_stack", ignorenulls=True).over(sweep))
    best = F.array_max(F.filter("_active", lambda r: F.startswith(F.col("path"), r["path"])))
    return (swept.where("_kind = 1").withColumn("_rule", best)
            .select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce("_rule.verdict", F.lit(default)).alias("verdict")))


_STACK = "array<struct<size:int,host_size:int,verdict:string,rule:string,path:string>>"

ORACLE = f"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN ''
                       ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(h, q, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT p.*, h || q AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC NULLS LAST, length(h) DESC) AS k
  FROM p LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM f WHERE k = 1
"""
