"""Operator 3: URL filter lists, by host suffixes and path prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the digest on which expressions and rules are joined; the whole digest is compared afterwards.
PREFIX_BITS = 32


def url_host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, with A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without one."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, folder).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """One row per row of pages: the key, url, host, path, rule (host and path of it, or NULL) and verdict.

    rules: host, path, verdict. A rule fits its host and all subdomains if the path starts with the rule's; the longest
    rule wins, then the longer host, then `block` over `allow`. A rule without a path fits every path. Every URL becomes expressions of a host
    suffix and a path prefix that ends in /, as many as the rules can have; they meet the rules on the first bits of a digest, then the
    whole digest and the rest of the rule's path decide. Without a fitting rule the verdict is the default. NULL URLs and
    URLs without :// have an empty host, which no rule fits. Equal (key, url) rows are judged once and then repeated, so a
    URL that makes up a third of the table costs one row; repeated rules count once, rules with a NULL host or verdict never fit. Rules are
    joined without a hint: Spark broadcasts them below its own size limit and shuffles the expressions beyond.
    """
    listed = rules.select(F.col("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    listed = listed.filter("rule_host <> '' and rule_verdict is not null").distinct()
    folder = F.regexp_extract("rule_path", r"^((?s:.*)/)?", 0)
    listed = listed.withColumn("full", _digest(F.col("rule_host"), folder)).withColumn("folders", F.size(F.split(folder, "/")) - 1)
    listed = listed.withColumn("labels", F.size(F.split("rule_host", r"\.")))
    # Two numbers: how deep the rules go. Deeper expressions could not fit any of them.
    depth = listed.agg(F.max("labels"), F.max("folders")).first()
    labels, folders = (depth[0] or 0), (depth[1] or 0)

    rows = pages.select(key, "url").groupBy(key, "url").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    pieces = F.split("path", "/")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(folders))),
        lambda k: F.concat(F.array_join(F.slice(pieces, 1, k), "/"), F.when(k > 0, "/").otherwise("")),
    )
    expressions = rows.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
    expressions = expressions.withColumn("expression", _digest(F.col("suffix"), F.col("prefix")))
    short = PREFIX_BITS // 4
    near = F.substring("expression", 1, short) == F.substring("full", 1, short)
    fits = (F.col("expression") == F.col("full")) & F.col("path").startswith(F.col("rule_path"))
    best = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"),
        F.col("rule_verdict").alias("verdict"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    met = expressions.join(listed, near, "left").withColumn("best", F.when(fits, best))
    judged = met.groupBy(key, "url").agg(F.max("best").alias("best"), F.first("copies").alias("copies"), F.first("host").alias("host"), F.first("path").alias("path"))
    judged = judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return judged.select(key, "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
