"""Rows from the JSON answers of a wiki: listings, category members, page contents, lock levels.

Answers are landed as rows (pos, body) in arrival order and parsed by ``from_json``; missing parts give defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas


def _parsed(answers: DataFrame, schema: str) -> DataFrame:
    return answers.withColumn("a", F.from_json("body", schema))


def _checked(answers: DataFrame, schema: str) -> DataFrame:
    return answers.withColumn("a", F.from_json("body", f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))


def accepted(answers: DataFrame, schema: str = schemas.LISTING_JSON) -> DataFrame:
    """The answers whose body is a JSON object of the schema's shape; further fields don't matter."""
    return _checked(answers, schema).filter("a is not null and a._corrupt is null and trim(body) <> ''").drop("a")


def rejected(answers: DataFrame, schema: str = schemas.LISTING_JSON) -> DataFrame:
    """The other answers with the reason: empty (null or blank) or malformed (cut off, no JSON object, a value of another type)."""
    empty = F.coalesce(F.trim("body") == "", F.lit(True))
    rows = _checked(answers, schema).filter(empty | F.col("a").isNull() | F.col("a._corrupt").isNotNull())
    return rows.withColumn("reason", F.when(empty, "empty").otherwise("malformed")).drop("a")


def listing_rows(answers: DataFrame) -> DataFrame:
    """(batch, place, id, title) of every listed page; ``batch`` is the position of the answer."""
    pages = _parsed(answers, schemas.LISTING_JSON).select(F.col("pos").alias("batch"), F.posexplode("a.query.allpages").alias("place", "p"))
    return pages.select("batch", "place", F.col("p.pageid").alias("id"), F.col("p.title").alias("title"))


def paged(answers: DataFrame) -> DataFrame:
    """(list, asked, next, pos, n): the token that each answer gives for the next one, and the rows that it lists. ``answers`` also has list and asked."""
    size = F.coalesce(F.size("a.query.allpages"), F.lit(0))
    return _parsed(answers, schemas.LISTING_JSON).select("list", "asked", F.col("a.continue.apcontinue").alias("next"), "pos", F.greatest(size, F.lit(0)).alias("n"))


def category_rows(answers: DataFrame) -> DataFrame:
    """(category, pos, place, title, page_id) of every member, in the order of answer and place; ``answers`` also has the category."""
    members = _parsed(answers, schemas.CATEGORY_JSON).select("category", "pos", F.posexplode("a.query.categorymembers").alias("place", "m"))
    return members.select("category", "pos", "place", F.col("m.title").alias("title"), F.col("m.pageid").alias("page_id"))


def content_rows(answers: DataFrame) -> DataFrame:
    """(title, content, denied): the first revision of each page; an answer with an error code denies its title."""
    parsed = _parsed(answers, schemas.CONTENT_JSON)
    pages = parsed.filter("a.error is null").select(F.explode("a.query.pages").alias("p"))
    given = pages.select(F.col("p.title").alias("title"), F.get("p.revisions", F.lit(0))["slots"]["main"]["content"].alias("content"), F.lit(False).alias("denied"))
    denied = parsed.filter("a.error is not null").select("title", F.lit(None).cast("string").alias("content"), F.lit(True).alias("denied"))
    return given.unionByName(denied)


def lock_rows(answers: DataFrame) -> DataFrame:
    """(title, allevel, missing, page_id): absent level ``none``, absent flag false."""
    pages = _parsed(answers, schemas.LOCK_JSON).select(F.explode("a.query.pages").alias("p"))
    return pages.select(
        F.col("p.title").alias("title"),
        F.coalesce("p.allevel", F.lit("none")).alias("allevel"),
        F.coalesce("p.missing", F.lit(False)).alias("missing"),
        F.col("p.pageid").alias("page_id"),
    )
