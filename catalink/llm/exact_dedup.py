"""Exact deduplication by skew-safe combining.

Texts are equal when they agree after every white-space character of the class
``[\\x20\\x09-\\x0D]`` is deleted. Rows are first merged inside each map task (the
map-side half of the salted aggregation), then by (digest, salt, content), and
then the winners of the salts by (digest, content): the full content is part
of the key at every stage, so a digest collision can never join two texts.
Each stage sees at most one row for each content and task, or content and
salt, so a content that a third of all rows share is no hot key.

Rows learn their winner through a join on the digest alone, which moves 32
bytes for a row; only digests that hold several contents (collisions) join on
the content too. Digests of more than a ``HOT_SHARE``th of all rows are fewer than ``HOT_SHARE``,
so they can be broadcast; their rows are dealt over salts in the join, for each of which the winner is repeated.

Defined cases: a null text counts as empty; of equal rows the one with the most
code points in the original text stays, then the smallest doc_id; a null doc_id
loses against any other. Repeated rows are members like others. An empty table
gives an empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

WHITE = " \t\n\x0b\x0c\r"
SALTS = 32
HOT_SHARE = 10_000
"""Broadcast digests at most, 32 bytes each."""
LAST_ID = "cast(9223372036854775807 as decimal(20,0))"
ID_SPAN = "cast('100000000000000000000' as decimal(21,0))"


def normalised(text: Column) -> Column:
    """The text without white space; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, content, digest and the rank by which a row wins: a number, so that the
    aggregation stays a hash aggregation. Larger is better; a null doc_id ranks last."""
    rank = F.expr(
        f"cast(length(coalesce(text, '')) as decimal(38,0)) * {ID_SPAN}"
        f" + coalesce({LAST_ID} - cast(doc_id as decimal(20,0)) + 1, cast(0 as decimal(21,0)))"
    ).cast("decimal(38,0)")
    rows = docs.select("doc_id", "text", normalised(F.col("text")).alias("content"))
    return rows.select("doc_id", "content", F.unhex(F.sha2(F.col("content").cast("binary"), 256)).alias("digest"), rank.alias("rank"))


def winner_id() -> Column:
    """The doc_id that the rank in the column ``best`` stands for."""
    rest = F.expr(f"best % {ID_SPAN}")
    return F.when(rest > 0, F.expr(f"cast({LAST_ID} + 1 - best % {ID_SPAN} as bigint)"))


def content_classes(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each distinct content: digest, content, keep_id, group_size."""
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    )
    merged = salted.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
    return merged.select("digest", "content", winner_id().alias("keep_id"), "group_size")


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs`` (doc_id, text)."""
    rows = keyed_texts(docs)
    classes = content_classes(rows, salts)
    by_digest = saved(
        classes.groupBy("digest").agg(
            F.count(F.lit(1)).alias("contents"), F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact-dedup-classes",
    )
    total = by_digest.agg(F.sum("group_size").alias("n")).first()["n"] or 0
    hot = F.col("group_size") > total / HOT_SHARE
    many = F.broadcast(by_digest.filter(hot & (F.col("group_size") > salts)).select("digest", F.lit(True).alias("many")))
    dealt = rows.select("doc_id", "digest").join(many, "digest", "left")
    dealt = dealt.select("doc_id", "digest", F.when(F.col("many"), F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(salts))).otherwise(F.lit(0)).alias("salt"))
    repeated = by_digest.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(hot & (F.col("group_size") > salts), F.lit(salts - 1)).otherwise(0).cast("bigint"))))
    found = dealt.join(repeated, ["digest", "salt"])
    out = found.filter("contents = 1").select("doc_id", "digest", "keep_id", "group_size")
    clashing = by_digest.filter("contents > 1").select("digest")
    if not clashing.isEmpty():
        several = (
            rows.join(clashing, "digest", "left_semi")
            .join(classes.join(clashing, "digest", "left_semi"), ["digest", "content"])
            .select("doc_id", "digest", "keep_id", "group_size")
        )
        out = out.unionByName(several)
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
