"""URL allow and block rules by hashed host-suffix / path-prefix expressions.

A rule is (host, path, verdict). It fits a URL whose host is the rule's host or
a subdomain of it and whose path starts with the rule's path. Every URL is
expanded into the expressions that some rule could equal: host suffixes of at
most as many labels as the longest rule host, times path prefixes of the lengths
that rule paths have. Expressions meet rules on the first four bytes of their
SHA-256, and the full digests confirm. Of the rules that fit, the longest text
(host + path) wins; at equal length the longer host, then block before allow.

Edge cases: A-Z in a rule's host count as lower case; URLs of any length are judged
whole; a null URL or one without ``://`` has an empty host and path and fits
no rule; without a fitting rule the verdict is the default; an empty path fits
only a rule with an empty path; equal rows are all returned; of rules with equal
host and path, block counts; an empty rule table leaves the default everywhere;
an empty page table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, lower_ascii

PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/ ? #``, A-Z lower-cased; '' if there is none."""
    rest = _rest(url)
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Text from the end of the host up to ``?``, ``#`` or the end; '' if there is none."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.char_length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _rule_table(rules: DataFrame) -> DataFrame:
    """Unique rules with their digests; (host, path) given twice counts as block."""
    r = rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("rhost"), F.coalesce("path", F.lit("")).alias("rpath"),
                     (F.col("verdict") == "block").cast("int").alias("block"))
    r = r.filter(F.col("rhost") != "").groupBy("rhost", "rpath").agg(F.max("block").alias("block"))
    digest = _digest(F.col("rhost"), F.col("rpath"))
    best = F.struct((F.char_length("rhost") + F.char_length("rpath")).alias("length"),
                    F.char_length("rhost").alias("host_length"), "block",
                    F.concat("rhost", "rpath").alias("rule"))
    return r.select(F.substring(digest, 1, PREFIX_HEX).alias("short"), digest.alias("rdigest"), best.alias("fit"),
                    F.size(F.split("rhost", r"\.")).alias("labels"), F.char_length("rpath").alias("path_length"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Per row of ``pages`` (page_id, url): host, path, the winning rule and the verdict."""
    table = _rule_table(rules)
    # the number of labels and the set of path lengths of the rules: one short row
    bound = table.agg(F.max("labels").alias("labels"), F.collect_set("path_length").alias("lengths")).first()
    labels, lengths = bound["labels"] or 0, sorted(bound["lengths"])

    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.withColumn("parts", F.split("host", r"\."))
    n = F.size("parts")
    count = F.when(F.col("host") == "", F.lit(0)).otherwise(F.least(n, F.lit(labels)))
    suffixes = F.transform(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
                           lambda k: F.array_join(F.slice("parts", n - k + 1, k), "."))
    prefixes = F.array_compact(F.array(*[F.when(F.char_length("path") >= k, F.substring("path", 1, k))
                                         for k in lengths]).cast("array<string>"))
    p = p.select("page_id", "host", "path", suffixes.alias("suffixes"), prefixes.alias("prefixes"))
    expressions = F.flatten(F.transform("suffixes", lambda s: F.transform("prefixes", lambda x: _digest(s, x))))
    p = p.select("page_id", "host", "path", F.posexplode_outer(expressions).alias("k", "digest"))
    p = p.withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    # rules that share the short prefix travel together, so a row stays one row
    short = table.groupBy("short").agg(F.collect_list(F.struct("rdigest", "fit")).alias("candidates"))
    p = lookup_join(p, short, ["short"], "left")
    same = F.filter("candidates", lambda c: c["rdigest"] == F.col("digest"))
    p = p.withColumn("fit", F.get(same, F.lit(0))["fit"])
    first = (F.coalesce(F.col("k"), F.lit(0)) == 0).cast("long")
    best = p.groupBy("page_id", "host", "path").agg(F.max("fit").alias("fit"), F.sum(first).alias("copies"))
    verdict = F.when(F.col("fit").isNull(), F.lit(default)).when(F.col("fit.block") == 1, "block").otherwise("allow")
    return best.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
                       F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("col")


def filter_pages(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns."""
    verdicts = judge(pages, rules, default).filter("verdict = 'block'").select("host", "path").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")
    keyed = pages.select(row, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return lookup_join(keyed, verdicts, ["host", "path"], "left_anti").select("row.*")
