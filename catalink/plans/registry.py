"""The registered catalog queries and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import text as T
from ..operators import batches, continuation, curated, deltas, ingest, locks, matching, provenance, reports
from ..operators.counters import Counters
from ..operators.work import saved, work_path
from ..sources import cursor, json_answers
from ..sources.workload import relation
from ..streaming import state_fold
from .oracle import ORACLE

#: The time of a run is a parameter; this one is that of the registered queries.
RUN_AT = "2024-06-01 12:00:00"

#: Rows of a page of a keyset scan.
PAGE_ROWS = 500

Query = Callable[[SparkSession, str], DataFrame]


class Catalogs:
    """The catalogs over the tables of one folder, each derived on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: DataFrame | None = None

    def __getitem__(self, name: str) -> DataFrame:
        return relation(self.spark, self.sf_dir, name)

    def upstream(self) -> DataFrame:
        return ingest.upsert_fold(self["upstream_log"])

    def stored_upstream(self, store: Callable[[DataFrame], DataFrame] = lambda df: saved(df, "upstream")) -> DataFrame:
        """The upstream table, folded once for all that reads it."""
        if self._stored is None:
            self._stored = store(self.upstream())
        return self._stored

    def _classified(self, pages: DataFrame, *columns: str) -> DataFrame:
        return provenance.classified(pages, self["category_members"], provenance.month_map(self["dated_subcategories"]), *columns)

    def classified(self) -> DataFrame:
        return self._classified(ingest.upsert_fold(self["local_log"]))

    def local(self) -> DataFrame:
        """Local pages with the match columns that an earlier run has left, or their defaults.

        What is found by id comes first and what is found by title after it, so that the rows are dealt by title once, for this and for the keys."""
        pages = ingest.upsert_fold(self["local_log"]).select("id", "title").join(self["earlier_matches"], "id", "left")
        rows = self._classified(matching.by_title(pages), *[c for c in pages.columns if c not in ("id", "title")])
        flags = {c: F.coalesce(c, F.lit(False)) for c in ("maybe_deleted_upstream", "normalization_match")}
        return rows.withColumns({**flags, "match_type": F.coalesce("match_type", F.lit(L.MATCH_NONE))})

    def matched(self) -> DataFrame:
        return matching.cascade(self.local(), self.stored_upstream(), self["manual_matches"], self["page_content"])

    def missing(self) -> DataFrame:
        return reports.missing_locally(self.stored_upstream(), self.matched(), self["blocked_titles"])

    def routes(self) -> DataFrame:
        return locks.routed(self.missing(), self["page_info"])


def _stage(*stages: str) -> Callable[[Catalogs], DataFrame]:
    return lambda c: c.matched().filter(F.col("stage").isin(*stages))


def _rule(i: int) -> Callable[[Catalogs], DataFrame]:
    return lambda c: c["local_log"].select("id", T.RULES[i][1](F.col("title")).alias("title"))


def _stale(c: Catalogs) -> DataFrame:
    return ingest.stale_collisions(c.upstream(), c["later_log"])


def _upsert(c: Catalogs) -> DataFrame:
    old = c["earlier_matches"].select("id", F.lit("gone").alias("title"), F.lit(L.STATUS_UNDOCUMENTED).alias("status"), "upstream_id", "match_type")
    arriving = c.classified().select("id", "title", "status")
    return ingest.upserted(old, arriving, "id", {"upstream_id": None, "match_type": L.MATCH_NONE})


def _listing(c: Catalogs) -> DataFrame:
    answers = json_answers.paged(c["paged_answers"])
    items = json_answers.listing_rows(c["paged_answers"]).withColumnRenamed("batch", "pos")
    return continuation.in_order(answers, continuation.ranked(answers), items)


def _broken(c: Catalogs) -> DataFrame:
    answers = json_answers.paged(c["paged_answers"])
    return continuation.broken(answers, continuation.ranked(answers))


def _state_fold(c: Catalogs) -> DataFrame:
    """The upstream log lands in files, and the stream folds them in several batches."""
    landing, out, checkpoint = (work_path(c.spark, f"stream-{x}") for x in ("landing", "changes", "checkpoint"))
    c["upstream_log"].select("pos", "batch", "id", "title").repartition(4, "batch").write.parquet(landing)
    state_fold.start_state_fold(c.spark, landing, out, checkpoint, 2).awaitTermination()
    return state_fold.table_of(c.spark, out)


def _cursor_load(c: Catalogs) -> DataFrame:
    """The pages of a keyset scan over the upstream table land as answers, each under the token that asks for it, and a stream follows the tokens."""
    rows = ingest.paginated(ingest.numbered(c.upstream().select("id", "title")), PAGE_ROWS)
    listed = F.sort_array(F.collect_list(F.struct(F.col("id").alias("pageid"), "title")))
    answers = rows.groupBy("page").agg(F.max("cursor").alias("cursor"), F.max("id").alias("last"), listed.alias("allpages"))
    following = F.when(F.size("allpages") == PAGE_ROWS, F.struct(F.col("last").cast("string").alias("apcontinue")))
    body = F.to_json(F.struct(F.struct("allpages").alias("query"), following.alias("continue")))
    path, out, checkpoint = (work_path(c.spark, f"cursor-{x}") for x in ("answers", "rows", "checkpoint"))
    cursor.landed(answers.select(F.when(F.col("page") > 0, F.col("cursor").cast("string")).alias("asked"), body.alias("body")), path)
    cursor.load(c.spark, path, out, checkpoint, answers=10)
    return c.spark.read.schema("batch long, place int, id long, title string").parquet(out)


def _isolated(c: Catalogs) -> DataFrame:
    pages = c["batch_pages"]
    answers = pages.groupBy("batch", "code").agg(F.max("denied").alias("denied")).withColumn("pos", F.lit(0))
    return batches.isolated(c["asked_titles"], answers, pages.filter("not denied"))


def _counters(c: Catalogs) -> DataFrame:
    """The counts of a run from the passes that write its tables."""
    counters = Counters()
    one = F.count(F.lit(1))
    dated = c["dated_subcategories"]
    months = provenance.month_of(F.col("category"))
    stages = {f"stage_{s}": F.count_if(F.col("stage") == s) for s in matching.STAGES}
    # the cascade reads the table that is written here, and doesn't fold it again
    c.stored_upstream(lambda df: counters.written(df, "upstream", upstream_rows=one))
    counters.written(c.matched(), "matched", local_rows=one, maybe_deleted=F.count_if("maybe_deleted_upstream"), **stages)
    counters.written(provenance.month_map(dated), "months", dated_titles=one)
    counters.written(dated.groupBy("category").agg(one.alias("n")), "subcategories", valid_months=F.count_if(months.isNotNull()))
    counters.written(c["page_info"], "info", locked=F.count_if(F.coalesce("allevel", F.lit("none")) != "none"))
    return c.spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counters.counts().items()])


def _rounds(c: Catalogs) -> DataFrame:
    upstream = c.stored_upstream()
    rows = matching.prepared(c.local().select("id", "title", "upstream_id"), upstream, c["page_content"])
    return curated.rounds(rows, upstream, c["manual_matches"], c["blocked_titles"], c["chained_info"]).log


def _changed(c: Catalogs) -> deltas.State:
    """A full run, then the state after changes of the upstream table."""
    state = deltas.full(c.local(), c.upstream(), c["manual_matches"], c["page_content"], c["blocked_titles"])
    changes = relation(c.spark, c.sf_dir, "upstream_changes", state.upstream)
    return deltas.after_changes(state, changes, c["manual_matches"], c["blocked_titles"])


def _bucketed(c: Catalogs) -> DataFrame:
    """The curated links in buckets on storage, with the links of a run put in."""
    path = work_path(c.spark, "curated")
    curated.bucketed(c["curated_manual"], path, "local_page_id")
    arriving = locks.to_manual(locks.routed(c.stored_upstream(), c["page_info"]))
    curated.upsert_buckets(c.spark, path, arriving.withColumn("added_at", F.lit(RUN_AT).cast("timestamp")), "local_page_id", keep=("added_at",))
    return curated.read_buckets(c.spark, path)


def _domains(c: Catalogs) -> DataFrame:
    rows = c["edited_rows"]
    return ingest.outside_domain(rows, "status", L.STATUSES).union(ingest.outside_domain(rows, "match_type", L.MATCH_TYPES)).distinct()


def _summary(c: Catalogs) -> DataFrame:
    """One pass over each catalog; the counts become one row."""
    local = c.matched().agg(F.count(F.lit(1)).alias("scanned"), F.count_if("maybe_deleted_upstream").alias("maybe_deleted"))
    counts = {
        "upstream_rows": c.upstream().agg(F.count(F.lit(1)).alias("n")),
        "dated_titles": provenance.month_map(c["dated_subcategories"]).agg(F.count(F.lit(1)).alias("n")),
        "locked": c["page_info"].agg(F.count_if(F.coalesce("allevel", F.lit("none")) != "none").alias("n")),
    }
    rows = local.select(F.explode(F.create_map(F.lit("local_rows"), "scanned", F.lit("maybe_deleted"), "maybe_deleted")).alias("name", "n"))
    for name, count in counts.items():
        rows = rows.unionByName(count.select(F.lit(name).alias("name"), "n"))
    names = ("upstream_rows", "local_rows", "dated_titles", "locked", "maybe_deleted")
    return rows.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


_QUERIES: dict[str, Callable[[Catalogs], DataFrame]] = {
    "scan_keyset_topk": lambda c: ingest.first_page(c["upstream_log"], 100, 500).select("id", "title"),
    "scan_pages": lambda c: ingest.paginated(ingest.numbered(c.upstream().select("id", "title")), PAGE_ROWS),
    "scan_requests": lambda c: ingest.page_requests(ingest.numbered(c.upstream().select("id", "title")), PAGE_ROWS),
    "upsert_fold_upstream": lambda c: c.upstream(),
    "batch_dedupe_last_wins": lambda c: ingest.batch_dedupe(c["upstream_log"]),
    "stale_collisions": _stale,
    "reload_fresh": lambda c: ingest.reloaded(c["stored_log"], c["upstream_log"].drop("batch", "checked_at"), fresh=True),
    "reload_resumed": lambda c: ingest.reloaded(c["stored_log"], c["upstream_log"].drop("batch", "checked_at"), fresh=False),
    "checked_text": lambda c: c.upstream().select("id", T.iso_text(F.col("checked_at")).alias("checked")),
    "fk_release": lambda c: ingest.release_references(c.local(), c["stale_ids"]).select("id", "title", "upstream_id", "match_type"),
    "upsert_preserving_match_cols": _upsert,
    "integrity_orphans": lambda c: ingest.orphans(c.local(), c.upstream()),
    "integrity_domains": _domains,
    "integrity_duplicates": lambda c: ingest.duplicates(c["upstream_log"], "title"),
    "category_sets": lambda c: provenance.category_pages(c["category_members"]).groupBy("category").agg(F.countDistinct("title").alias("n")),
    "category_union": lambda c: provenance.category_union(c["category_members"]),
    "category_members": lambda c: provenance.direct_members(c["category_members"], "created", "subcat").select("category", "member_type", "namespace", "title", "page_id"),
    "month_walk": lambda c: provenance.month_map(provenance.dated_pages(c["category_tree"], "dated")),
    "month_map": lambda c: provenance.month_map(c["dated_subcategories"]),
    "classify_provenance": lambda c: c.classified().select("id", "title", "status", "source_type", "last_update_month"),
    "page_flags": lambda c: c.classified().select("id", "needs_attention", "is_dictionary_entry"),
    "hygiene_titles": lambda c: c["local_log"].select("id", "title", T.hygiene(F.col("title")).alias("key")),
    **{f"rule_{i + 1}": _rule(i) for i in range(len(T.RULES))},
    "normalize_titles": lambda c: T.with_rewritten(c.local(), "title", "rewritten", "applied").select("id", "rewritten", "applied"),
    "template_extract": lambda c: c["page_content"].select("title", T.template_value(F.col("content")).alias("value")),
    "duration_format": lambda c: c.spark.read.parquet(f"{c.sf_dir}/orders.parquet").select("o_orderkey", T.duration(F.col("o_orderkey") * 7).alias("text")),
    "json_listing": lambda c: json_answers.listing_rows(c["listing_answers"]),
    "stream_fold": _state_fold,
    "cursor_listing": _cursor_load,
    "listing_in_order": _listing,
    "json_accepted": lambda c: json_answers.accepted(c["damaged_answers"]).select("pos"),
    "json_rejected": lambda c: json_answers.rejected(c["damaged_answers"]),
    "batch_isolated": _isolated,
    "run_counters": _counters,
    "curated_rounds": _rounds,
    "bucketed_upsert": _bucketed,
    "delta_key_map": lambda c: _changed(c).keys,
    "delta_matched": lambda c: _changed(c).matched,
    "delta_missing": lambda c: _changed(c).missing,
    "delta_tasks": lambda c: reports.tasks(_changed(c).matched),
    "listing_broken": _broken,
    "json_category": lambda c: json_answers.category_rows(c["category_answers"]),
    "json_content": lambda c: json_answers.content_rows(c["content_answers"]),
    "json_lock": lambda c: json_answers.lock_rows(c["lock_answers"]),
    "upstream_key_map": lambda c: matching.upstream_keys(c.upstream()),
    "key_collisions": lambda c: matching.key_collisions(c.upstream()),
    "match_manual": _stage("manual", "manual_unresolved"),
    "match_exact": _stage("exact", "hygiene"),
    "match_semantic": _stage("semantic"),
    "match_template": _stage("template", "denied"),
    "match_unmatched": _stage("unmatched"),
    "match_type": lambda c: c.classified().select("id", matching.match_type_of(F.col("status")).alias("match_type")),
    "match_cascade": lambda c: c.matched(),
    "match_stage_counts": lambda c: matching.stage_counts(c.matched()),
    "report_possibly_deleted": lambda c: reports.possibly_deleted(c.matched()),
    "report_undocumented": lambda c: reports.undocumented(c.matched()),
    "report_tasks": lambda c: reports.tasks(c.matched()),
    "report_missing": lambda c: c.missing(),
    "lock_route": lambda c: c.routes(),
    "lock_route_counts": lambda c: locks.route_counts(c.routes()),
    "lock_to_blocked": lambda c: locks.added(c["blocked_titles"].select("title", "upstream_id", "reason", "added_at"), locks.to_blocked(c.routes()), "title", F.lit(RUN_AT).cast("timestamp")),
    "lock_to_manual": lambda c: locks.added(c["curated_manual"], locks.to_manual(c.routes()), "local_page_id", F.lit(RUN_AT).cast("timestamp")),
    "run_summary": _summary,
}


def _over(query: Callable[[Catalogs], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(Catalogs(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _over(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
