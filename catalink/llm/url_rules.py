"""URL filters by hashed host-suffix and path-prefix expressions.

Each URL is expanded into (host suffix, path prefix) expressions, an equi-join
on a short hash prefix finds candidate rules, the full SHA-256 digest confirms
them, and the longest confirmed rule decides. DataFrame functions only.

Only expression shapes that some rule has (label count of the host, length of
the path) are expanded, so a host of a thousand labels costs no more than the
rule set has shapes, and no matching rule is missed.

Defined cases: a null url, or one without ``://``, has an empty host and path
and gets no rule. Repeated rows stay repeated. An empty table gives an empty
result. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_HEX = 8
"""Hex digits of the short hash that the equi-join uses (32 bits)."""


def url_host(url: Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, ``host/path``) with their digests and shapes."""
    rows = spark.createDataFrame([(v, r) for v, r in rules], "rule_verdict string, rule string")
    host, path = F.translate(F.substring_index("rule", "/", 1), UPPER, UPPER.lower()), F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)")
    return (
        rows.select("rule_verdict", "rule", host.alias("rh"), path.alias("rp"))
        .withColumn("digest", F.sha2(F.concat_ws("\n", "rh", "rp").cast("binary"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
        .withColumn("labels", F.size(F.split("rh", r"\.")))
        .withColumn("path_len", F.length("rp"))
        # of two rules with one expression, block wins
        .groupBy("digest", "short", "labels", "path_len")
        .agg(F.max(F.struct("rule_verdict", "rule")).alias("r"))
        .select("digest", "short", "labels", "path_len", "r.rule_verdict", "r.rule")
    )


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of every row of ``pages`` (page_id, url).

    ``rules`` are (verdict, host/path) pairs held by the caller. The distinct
    shapes are read back to the driver: at most one for each rule.
    """
    spark = pages.sparkSession
    frame = rules_frame(spark, rules)
    shapes = [(r.labels, r.path_len) for r in frame.select("labels", "path_len").distinct().collect()]
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    n_labels = F.size(F.split("host", r"\."))

    def expression(labels: int, path_len: int) -> Column:
        text = F.concat_ws("\n", F.substring_index("host", ".", -labels), F.substring("path", 1, path_len))
        digest = F.sha2(text.cast("binary"), 256)
        return F.when((n_labels >= labels) & (F.length("path") >= path_len), digest)

    # the null at position 0 stands for the row itself, so that repeated rows can be counted
    digests = F.array(F.lit(None).cast("string"), *[expression(*s) for s in sorted(shapes)])
    expanded = parsed.select("page_id", "host", "path", F.posexplode(digests).alias("at", "url_digest"))
    expanded = expanded.filter((F.col("at") == 0) | F.col("url_digest").isNotNull())
    found = expanded.join(frame, F.substring("url_digest", 1, PREFIX_HEX) == F.col("short"), "left")
    fits = F.when(F.col("url_digest") == F.col("digest"), F.struct(F.length("rule").alias("n"), "rule", "rule_verdict"))
    best = found.groupBy("page_id", "host", "path").agg(F.max(fits).alias("best"), F.count_if(F.col("at") == 0).alias("copies"))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"),
    ).drop("copy")
