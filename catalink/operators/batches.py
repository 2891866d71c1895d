"""Contents that were asked for in batches, where a batch that is denied is asked for again in halves.

The halves of a batch form a tree; the code of a node is its path (0 for the first half, 1 for the second). A title's place in its batch gives the codes
of all nodes that hold it, one for each level. So the answers that may speak for a title are found by an equality join on batch and code, not by
a range join, and of those that arrived the longest code decides: the smallest batch.

Defined cases: a denied answer to a title alone denies it. A denied answer to more titles whose halves haven't arrived leaves its titles pending; so does a title
without any answer. A title that an answer doesn't mention has no content. Of several answers with one code the last counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def codes(place: Column, size: Column, levels: int) -> Column:
    """The codes of the nodes that hold a place (from 0) of a batch of ``size`` titles, from the whole batch down to the title alone.

    ``levels`` bounds the depth: at least the logarithm of the largest size, rounded up. The first half of n titles has n div 2."""
    start = F.struct(F.lit("").alias("code"), place.cast("int").alias("place"), size.cast("int").alias("size"), F.array(F.lit("")).alias("out"))

    def halved(acc: Column, _: Column) -> Column:
        half = F.floor(acc["size"] / 2).cast("int")
        first = acc["place"] < half
        code = F.concat(acc["code"], F.when(first, "0").otherwise("1"))
        down = F.struct(
            code.alias("code"),
            F.when(first, acc["place"]).otherwise(acc["place"] - half).alias("place"),
            F.when(first, half).otherwise(acc["size"] - half).alias("size"),
            F.concat(acc["out"], F.array(code)).alias("out"),
        )
        return F.when(acc["size"] > 1, down).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), start, halved, lambda acc: acc["out"])


def isolated(titles: DataFrame, answers: DataFrame, pages: DataFrame, levels: int = 9) -> DataFrame:
    """(title, content, denied, pending) of every asked title.

    ``titles``: batch, place, size, title. ``answers``: batch, code, pos, denied. ``pages``: batch, code, title, content, of answers that weren't denied."""
    asked = titles.select("batch", "title", F.posexplode(codes(F.col("place"), F.col("size"), levels)).alias("level", "code"), "size", "place")
    deepest = titles.select("batch", "title", (F.size(codes(F.col("place"), F.col("size"), levels)) - 1).alias("depth"))
    last = answers.groupBy("batch", "code").agg(F.max_by("denied", "pos").alias("denied"))
    said = asked.join(last, ["batch", "code"]).groupBy("batch", "title").agg(F.max(F.struct("level", "code", "denied")).alias("a"))
    rows = deepest.join(said, ["batch", "title"], "left").select("batch", "title", "depth", F.col("a.level").alias("level"), F.col("a.code").alias("code"), F.col("a.denied").alias("no"))
    given = rows.join(pages.select("batch", "code", "title", "content"), ["batch", "code", "title"], "left")
    alone = F.col("level") == F.col("depth")
    return given.select(
        "title",
        F.when(~F.col("no"), F.col("content")).alias("content"),
        F.coalesce(F.col("no") & alone, F.lit(False)).alias("denied"),
        F.coalesce(F.col("no") & ~alone, F.lit(True)).alias("pending"),
    )
