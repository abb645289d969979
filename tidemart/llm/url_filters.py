"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Each URL is expanded into its host suffixes times its path prefixes, each
expression is hashed, and an equi-join on the first four bytes of the digest
finds the candidate rules; the full digest then confirms them and the longest
rule wins. Only built-in functions are used.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits no rule. A rule without a host fits nothing. Of equal rules with
different actions, ``block`` wins. Repeated pages keep their rows. Empty tables
give empty results. A very long url is expanded whole, by its host and path parts.
Extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8  # four bytes of the digest, enough to make chance matches rare


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): between ``://`` and the first of ``/?#``, A-Z lower-cased; then up to ``?#``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(rule, action) rows as (rule, action, path_len, digest, short); one row per rule."""
    return (rules.where("rule is not null and instr(rule, '/') > 1")
            .groupBy("rule").agg(F.max("action").alias("action"))  # 'block' > 'allow'
            .withColumn("path_len", F.length("rule") - F.instr("rule", "/") + 1)
            .withColumn("digest", digest(F.col("rule")))
            .withColumn("short", F.substring("digest", 1, PREFIX_HEX)))


def expressions(lengths: Column) -> Column:
    """All host suffixes of ``host`` times the path prefixes of the given lengths."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    return F.flatten(F.transform(F.filter(suffixes, lambda s: s != ""),
                                 lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The distinct addresses of ``pages`` as (host, path, rule, verdict).

    ``rules`` has (rule, action): a host and a path such as ``example.net/en/``.
    Path prefixes are cut only at lengths that rules have. Rows are reduced to
    distinct (host, path) first, then expanded; the join's hot expressions (one
    host in a third of all pages) are split by AQE, and the longest rule is a
    plain maximum, combined before the shuffle.
    """
    host, path = split_url(pages[url_col])
    seen = pages.select(host.alias("host"), path.alias("path")).distinct()
    known = prepare_rules(rules)
    # a handful of small numbers: no more than the longest rule path has characters
    lengths = sorted(r[0] for r in known.select("path_len").distinct().collect())
    found = (seen.where("host <> ''")
             .select("host", "path", F.explode(expressions(F.array(*map(F.lit, lengths)).cast("array<int>"))).alias("e"))
             .select("host", "path", digest(F.col("e")).alias("full"))
             .withColumn("short", F.substring("full", 1, PREFIX_HEX)))
    hits = (found.join(known.select("short", "digest", "rule", "action"), "short")
            .where(F.col("full") == F.col("digest"))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best")))
    return (seen.join(hits, ["host", "path"], "left")
            .select("host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.action", F.lit(default)).alias("verdict")))


def filter_pages(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict."""
    host, path = split_url(pages[url_col])
    rows = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    verdicts = judge(pages, rules, url_col, default)
    return rows.join(verdicts, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict")
