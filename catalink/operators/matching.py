"""The matching cascade from local pages to upstream pages as one plan.

Stages in order: manual match, hygiene key, rewrite rules, in-page template.
The three key lookups are one join: each page gives its candidate keys with a
rank, and the lowest rank that hits wins. Pages without a key for a stage
give no row, so no null keys meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import hygiene, template_value, with_rewritten
from .ingest import last_of, scanned
from .work import saved

MATCH_COLUMNS = ("upstream_id", "match_type", "maybe_deleted_upstream", "normalization_match", "normalization_method", "title_normalized")

#: The stages in which a row of the cascade may end.
STAGES = ("empty", "manual_unresolved", "manual", "exact", "hygiene", "semantic", "denied", "template", "unmatched")


def upstream_keys(upstream: DataFrame) -> DataFrame:
    """(key, upstream_id): the lowest id of each hygiene key; empty titles have no key."""
    titled = scanned(upstream).filter("title <> ''")
    return titled.select(hygiene(F.col("title")).alias("key"), "id").groupBy("key").agg(F.min("id").alias("upstream_id"))


def key_collisions(upstream: DataFrame) -> DataFrame:
    """(titles, keys, collisions) of the titled upstream pages."""
    keyed = scanned(upstream).filter("title <> ''").select(hygiene(F.col("title")).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("titles"), F.count(F.lit(1)).alias("keys"), (F.sum("n") - F.count(F.lit(1))).alias("collisions"))


def match_type_of(status: Column) -> Column:
    return F.when(status.isin(*L.NOT_IMPORTED), L.MATCH_UNRELATED).otherwise(L.MATCH_IMPORTED)


def by_title(rows: DataFrame) -> DataFrame:
    """Rows dealt by title over a fixed number of parts, which joins by title after it keep: the keys of ``with_candidates`` are much work for few bytes, and would else end up in few tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "title")


def with_candidates(local: DataFrame, content: DataFrame) -> DataFrame:
    """Local rows with the keys of the three lookups: key_0 (hygiene), key_1 (rules, if one applied), key_2 (template).

    Of several contents of one title the last one counts. ``local`` should be dealt ``by_title`` where its titles are looked up first."""
    rows = with_rewritten(scanned(local), "title", "rewritten", "applied", "key_0")
    pages = last_of(content, "title", "content", "denied").withColumnRenamed("title", "_title")
    rows = rows.join(pages, rows["title"] == F.col("_title"), "left").drop("_title")
    rows = rows.withColumn("denied", F.coalesce("denied", F.lit(False))).withColumn("value", F.when(~F.col("denied"), template_value(F.col("content")))).drop("content")
    return rows.withColumns(
        {
            "key_1": F.when(F.col("applied") != "", hygiene(F.col("rewritten"))),
            "key_2": hygiene(F.col("value")),
        }
    )


def key_hits(candidates: DataFrame, keys: DataFrame) -> DataFrame:
    """(id, hit.rank, hit.upstream_id): the first of a page's keys that an upstream page has."""
    ranked = F.array(*[F.struct(F.lit(i).alias("rank"), F.col(f"key_{i}").alias("key")) for i in range(3)])
    asked = candidates.filter("title <> ''").select("id", F.explode(F.filter(ranked, lambda x: x["key"].isNotNull())).alias("k")).select("id", "k.rank", "k.key")
    return asked.join(keys, "key").groupBy("id").agg(F.min(F.struct("rank", "upstream_id")).alias("hit"))


def prepared(local: DataFrame, upstream: DataFrame, content: DataFrame) -> DataFrame:
    """The local rows with their candidate keys and ``hit``: what the cascade finds for them without curated links."""
    # the rows are read twice: as rows, and for their keys
    rows = saved(with_candidates(local, content), "candidates")
    hits = key_hits(rows, upstream_keys(upstream)).select(F.col("id").alias("_hit_id"), "hit")
    return rows.join(hits, rows["id"] == F.col("_hit_id"), "left").drop("_hit_id")


def cascade(local: DataFrame, upstream: DataFrame, manual: DataFrame, content: DataFrame) -> DataFrame:
    """Every local row (id above 0) with its match columns and ``stage``.

    Rows in the stages empty, manual_unresolved and denied keep their values; so do, column by column, those that a
    stage doesn't set. ``manual``: local_page_id, upstream_page_id. ``content``: title, content, denied. ``upstream`` is read twice and should be a stored table."""
    return decided(prepared(local, upstream, content), upstream, manual)


def decided(rows: DataFrame, upstream: DataFrame, manual: DataFrame) -> DataFrame:
    """The cascade over ``prepared`` rows: curated links first, then the hits."""
    curated = manual.select(F.col("local_page_id").alias("_local"), F.col("upstream_page_id").alias("manual_id"))
    existing = scanned(upstream).select(F.col("id").alias("existing_id"))
    # only curated rows look for their target
    curated = curated.join(existing, curated["manual_id"] == existing["existing_id"], "left")
    rows = rows.join(curated, rows["id"] == F.col("_local"), "left")

    rank = F.col("hit.rank")
    stage = (
        F.when(F.col("title") == "", "empty")
        .when(F.col("manual_id").isNotNull() & F.col("existing_id").isNull(), "manual_unresolved")
        .when(F.col("manual_id").isNotNull(), "manual")
        .when((rank == 0) & (F.col("key_0") == F.col("title")), "exact")
        .when(rank == 0, "hygiene")
        .when(rank == 1, "semantic")
        .when(F.col("denied"), "denied")
        .when(rank == 2, "template")
        .otherwise("unmatched")
    )
    rows = rows.withColumn("stage", stage)
    at = F.col("stage")
    found, named = at.isin("manual", "exact", "hygiene", "semantic", "template"), at.isin("manual", "hygiene", "semantic", "template")
    lost = at == "unmatched"
    promoted = (at == "template") & ~F.col("status").isin(*L.NOT_IMPORTED)
    new = {
        "upstream_id": F.when(at == "manual", F.col("manual_id")).when(found, F.col("hit.upstream_id")).otherwise(F.col("upstream_id")),
        "match_type": F.when(found, match_type_of(F.col("status"))).otherwise(F.col("match_type")),
        "maybe_deleted_upstream": F.when(found, F.lit(False)).when(lost & ~F.col("status").isin(*L.MATCH_NOT_EXPECTED), F.lit(True)).otherwise(F.col("maybe_deleted_upstream")),
        "normalization_match": F.when(named, F.lit(True)).when(lost, F.lit(False)).otherwise(F.col("normalization_match")),
        "normalization_method": F.when(at == "manual", L.METHOD_MANUAL)
        .when(at == "hygiene", L.METHOD_HYGIENE)
        .when(at == "semantic", F.col("applied"))
        .when(at == "template", L.METHOD_TEMPLATE)
        .when(lost, F.lit(None))
        .otherwise(F.col("normalization_method")),
        "title_normalized": F.when(at == "hygiene", F.col("key_0"))
        .when(at == "semantic", F.col("rewritten"))
        .when(at == "template", F.col("value"))
        .when(at.isin("manual", "unmatched"), F.lit(None))
        .otherwise(F.col("title_normalized")),
        "status": F.when(promoted, L.STATUS_DOCUMENTED).otherwise(F.col("status")),
    }
    names = ["id", "title", "status", "last_update_month", *MATCH_COLUMNS, "needs_attention", "is_dictionary_entry", "source_type"]
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in names], "stage")


def references(rows: DataFrame) -> DataFrame:
    """(id, linkable, kept, found) of ``prepared`` rows, in which curated links play no part yet.

    ``found``: the upstream id that the row refers to without a link; ``kept``: with one whose target isn't there; a row without a title takes no link."""
    rank = F.col("hit.rank")
    hit = (F.col("title") != "") & (rank.isin(0, 1) | ((rank == 2) & ~F.col("denied")))
    return scanned(rows).select("id", (~F.coalesce(F.col("title") == "", F.lit(False))).alias("linkable"), F.col("upstream_id").alias("kept"), F.when(hit, F.col("hit.upstream_id")).otherwise(F.col("upstream_id")).alias("found"))


def targets(manual: DataFrame, upstream: DataFrame) -> DataFrame:
    """The links (local_page_id, upstream_page_id) with ``exists``: whether the target is an upstream page."""
    there = scanned(upstream).select(F.col("id").alias("upstream_page_id"), F.lit(True).alias("exists"))
    return saved(manual.join(there, "upstream_page_id", "left").select("local_page_id", "upstream_page_id", F.coalesce("exists", F.lit(False)).alias("exists")), "targets")


def referred(refs: DataFrame, links: DataFrame) -> DataFrame:
    """(id) of the upstream pages that the cascade makes local rows refer to, by their ``references`` and the ``targets`` of links; ids may come again."""
    rows = refs.join(links.filter("upstream_page_id is not null"), refs["id"] == links["local_page_id"], "left").withColumn("link", F.col("linkable") & F.col("exists"))
    ref = F.when(F.col("link"), F.col("upstream_page_id")).when(F.col("linkable") & ~F.col("exists"), F.col("kept")).otherwise(F.col("found"))
    return rows.select(ref.alias("id")).filter("id is not null")


def stage_counts(matched: DataFrame) -> DataFrame:
    """(stage, n)."""
    return matched.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
