"""Provenance of local pages from category membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import month_of

#: Fixed values. Roles of the categories, first match wins: (role, status, source type).
PRECEDENCE = (
    ("created", L.STATUS_CREATED, "created"),
    ("translated", L.STATUS_CREATED, "translated"),
    ("disambiguation", L.STATUS_CREATED, "pirushon"),
    ("external_1", L.STATUS_EXTERNAL_1, "chabadpedia"),
    ("external_2", L.STATUS_EXTERNAL_2, "wikishiva"),
    ("kept", L.STATUS_KEPT, "wikipedia_deleted_kept"),
    ("split", L.STATUS_SPLIT, "split_from_wikipedia"),
)
NOT_DATED = tuple(role for role, _, _ in PRECEDENCE)
MISSING_SORT, ATTENTION, DICTIONARY = "missing_sort", "attention", "dictionary"


def direct_members(members: DataFrame, category: str | None = None, member_type: str = "page", namespace: int | None = None) -> DataFrame:
    """The direct members of a category (of all, if none is named) of a type, page or subcat, and in a namespace if one is given."""
    rows = members.filter(F.col("member_type") == member_type)
    rows = rows if category is None else rows.filter(F.col("category") == category)
    return rows if namespace is None else rows.filter(F.col("namespace") == namespace)


def category_pages(members: DataFrame) -> DataFrame:
    """(category, title) of direct page members in the main namespace."""
    return direct_members(members, namespace=0).select("category", "title").distinct()


def dated_pages(members: DataFrame, root: str) -> DataFrame:
    """(category, ordinal, title): the pages of the main namespace in the subcategories of ``root``, with the place of the subcategory in it."""
    subcategories = direct_members(members, root, "subcat").groupBy(F.col("title").alias("category")).agg(F.max("ordinal").alias("ordinal"))
    return direct_members(members, namespace=0).select("category", "title").join(subcategories, "category")


def category_union(members: DataFrame, roles: tuple[str, ...] = NOT_DATED) -> DataFrame:
    """Titles of any of the categories."""
    return category_pages(members).filter(F.col("category").isin(*roles)).select("title").distinct()


def month_map(subcategories: DataFrame) -> DataFrame:
    """(title, month): of a title in several dated subcategories the one that comes last counts; undated ones are skipped.

    ``subcategories``: category, ordinal, title."""
    dated = subcategories.withColumn("month", month_of(F.col("category"))).filter("month is not null")
    return dated.groupBy("title").agg(F.max_by("month", "ordinal").alias("month"))


def membership(members: DataFrame) -> DataFrame:
    """One boolean column for each role, one row for each title."""
    roles = (*NOT_DATED, MISSING_SORT, ATTENTION, DICTIONARY)
    # a maximum takes repeated members without a distinct before it
    return direct_members(members, namespace=0).groupBy("title").agg(*[F.max(F.col("category") == r).alias(r) for r in roles])


def _is(role: str) -> Column:
    return F.coalesce(F.col(role), F.lit(False))


def classified(pages: DataFrame, members: DataFrame, months: DataFrame, *columns: str) -> DataFrame:
    """(id, title) with status, source_type, last_update_month, needs_attention, is_dictionary_entry, and further columns of the pages that are named."""
    joined = pages.select("id", "title", *columns).join(membership(members), "title", "left").join(months, "title", "left")

    def first_match(of: int, documented: str, missing: str, unknown: str) -> Column:
        out = F.when(_is(PRECEDENCE[0][0]), PRECEDENCE[0][of])
        for entry in PRECEDENCE[1:]:
            out = out.when(_is(entry[0]), entry[of])
        return out.when(F.col("month").isNotNull(), documented).when(_is(MISSING_SORT), missing).otherwise(unknown)

    undated = _is(MISSING_SORT)
    for role in NOT_DATED:
        undated = undated | _is(role)
    return joined.select(
        "id",
        "title",
        first_match(1, L.STATUS_DOCUMENTED, L.STATUS_UNDOCUMENTED, L.STATUS_UNDOCUMENTED).alias("status"),
        first_match(2, "wikipedia_documented", "missing_sort", "unknown").alias("source_type"),
        F.when(~undated, F.col("month")).alias("last_update_month"),
        _is(ATTENTION).alias("needs_attention"),
        _is(DICTIONARY).alias("is_dictionary_entry"),
        *columns,
    )
