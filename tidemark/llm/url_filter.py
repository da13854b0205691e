"""URL filter: host-suffix and path-prefix expressions against a rule table.

Each distinct url is expanded into expressions ``host suffix + path prefix``;
a 4-byte hash prefix of each is equi-joined with the rules' and the full
SHA-256 digests then confirm the match. Of the confirmed rules the longest
wins. DataFrame functions only, no Python on the executors.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule. A host ends at ``/``, ``?``, ``#`` or the end, so a port or
user part belongs to it. Repeated urls are judged once and every row is
returned; an empty table gives an empty result; of two rules with the same host
and path ``block`` wins; rules with a null host, path or action are ignored.
A page table's further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Bits of a digest that the join compares; the whole digest confirms it.
PREFIX_HEX = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    host = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _host_suffixes(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict), one row per row of ``pages``.

    ``rules``: host, path, action. A rule fits its host and all subdomains if
    the url's path starts with the rule's path. ``default`` is the verdict of a
    url that no rule fits.
    """
    pages = pages.select(pages[id_col].alias("_id"), pages[url_col].cast("string").alias("_url"))
    rules = rules.select("host", "path", "action").where("host is not null and path is not null and action is not null")
    coded = (rules.groupBy("host", "path").agg(F.max("action").alias("action"))
             .select(F.concat("host", "path").alias("_rule"), "action", F.length(F.concat("host", "path")).alias("_long"),
                     F.sha2(_expression(F.col("host"), F.col("path")), 256).alias("_full"), F.length("path").alias("_cut"))
             .withColumn("_prefix", F.substring("_full", 1, PREFIX_HEX)))
    # a path prefix can only be a rule's if it is as long as some rule's path
    lengths = sorted(r[0] for r in coded.select("_cut").distinct().collect())
    cuts = F.array(*[F.lit(n) for n in lengths]) if lengths else F.expr("cast(array() as array<int>)")

    urls = (pages.where(F.col("_url").isNotNull()).select("_url").distinct()
            .select("_url", url_host(F.col("_url")).alias("_host"), url_path(F.col("_url")).alias("_path"))
            .where("_host <> ''"))
    prefixes = F.transform(F.filter(cuts, lambda n: n <= F.length("_path")), lambda n: F.substr(F.col("_path"), F.lit(1), n))
    expressions = F.flatten(F.transform(_host_suffixes(F.col("_host")),
                                        lambda h: F.transform(prefixes, lambda p: _expression(h, p))))
    found = (urls.select("_url", F.explode(expressions).alias("_text"))
             .select("_url", F.sha2("_text", 256).alias("_mine"))
             .withColumn("_prefix", F.substring("_mine", 1, PREFIX_HEX))
             .join(coded, "_prefix").where("_mine = _full"))
    best = F.max(F.struct("_long", "action", "_rule")).alias("_best")
    # written once, so that both sides of the join back are plain exchanges, which adaptive execution can split at a hot url
    judged = cut(found.groupBy("_url").agg(best).select("_url", "_best.*"))
    return pages.join(judged, "_url", "left").select(
        F.col("_id").alias(id_col), url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"),
        F.col("_rule").alias("rule"), F.coalesce("action", F.lit(default)).alias("verdict"))
