"""Folds, classification, cascade, reports and locks against small tables worked out by hand or by simulation."""

import random

import pytest
from pyspark.sql import functions as F

from catalink.functions import labels as L
from catalink.operators import ingest, locks, matching, provenance, reports
from catalink.sources import json_answers

LOCAL = "id long, title string, status string, last_update_month string, upstream_id long, match_type string, maybe_deleted_upstream boolean, normalization_match boolean, normalization_method string, title_normalized string, needs_attention boolean, is_dictionary_entry boolean, source_type string"


def simulated(log):
    table = {}
    for i, title in log:
        table = {k: v for k, v in table.items() if k != i and v != title}
        table[i] = title
    return table


def test_fold_against_simulation(spark):
    draw = random.Random(1)
    logs = [[(1, "A"), (2, "A"), (2, "B")], [(1, "A"), (1, "B"), (2, "B")], []]
    logs += [[(draw.randint(1, 5), draw.choice("ABCDE")) for _ in range(draw.randint(1, 12))] for _ in range(150)]
    rows = [(1000 * n + p, 100 * n + i, f"{n}{t}") for n, log in enumerate(logs) for p, (i, t) in enumerate(log)]
    got = {(r.id, r.title) for r in ingest.upsert_fold(spark.createDataFrame(rows, "pos long, id long, title string")).collect()}
    assert got == {(100 * n + i, f"{n}{t}") for n, log in enumerate(logs) for i, t in simulated(log).items()}


def test_upsert_keeps_unsent_columns(spark):
    target = spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], "id long, title string, match_type string")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "id long, title string")
    got = ingest.upserted(target, source, "id", {"match_type": "none"})
    assert sorted(map(tuple, got.collect())) == [(1, "a", "m1"), (2, "B", "m2"), (3, "c", "none")]


def test_scan_and_batches(spark):
    log = spark.createDataFrame([(0, 0, 0, "x"), (1, 0, 5, "t"), (2, 0, 6, "t"), (3, 1, 7, "t")], "pos long, batch long, id long, title string")
    assert ingest.scanned(log).count() == 3
    assert [r.id for r in ingest.first_page(log, 5, 1).collect()] == [6]
    assert sorted((r.batch, r.title, r.id) for r in ingest.batch_dedupe(log).collect()) == [(0, "t", 6), (0, "x", 0), (1, "t", 7)]


PROVENANCE = [
    ("a", ["created", "translated"], ["2023"], (L.STATUS_CREATED, "created", None)),
    ("b", ["kept"], ["2023"], (L.STATUS_KEPT, "wikipedia_deleted_kept", None)),
    ("c", [], ["2023"], (L.STATUS_DOCUMENTED, "wikipedia_documented", "2023-11")),
    ("d", ["missing_sort"], ["2023"], (L.STATUS_DOCUMENTED, "wikipedia_documented", None)),
    ("e", ["missing_sort"], [], (L.STATUS_UNDOCUMENTED, "missing_sort", None)),
    ("f", [], [], (L.STATUS_UNDOCUMENTED, "unknown", None)),
    ("g", [], ["2023", "2024"], (L.STATUS_DOCUMENTED, "wikipedia_documented", "2024-11")),
]


def test_provenance(spark):
    pages = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(PROVENANCE)], "id long, title string")
    members = spark.createDataFrame([(c, "page", 0, t) for t, cs, _, _ in PROVENANCE for c in cs] + [("created", "subcat", 0, "f"), ("created", "page", 14, "f")], "category string, member_type string, namespace int, title string")
    dated = spark.createDataFrame([(f"עודכנו בנובמבר {y}", int(y), t) for t, _, ys, _ in PROVENANCE for y in ys] + [("undated", 9999, "g")], "category string, ordinal long, title string")
    got = {r.title: (r.status, r.source_type, r.last_update_month) for r in provenance.classified(pages, members, provenance.month_map(dated)).collect()}
    assert got == {t: want for t, _, _, want in PROVENANCE}


#: title, status -> stage, upstream_id, match type, maybe deleted, (normalized, method, title), status after
CASCADE = [
    (1, "", L.STATUS_DOCUMENTED, "empty", 77, "prev", None, (None, "pm", "pt"), L.STATUS_DOCUMENTED),
    (2, "curated", L.STATUS_CREATED, "manual", 10, L.MATCH_UNRELATED, False, (True, L.METHOD_MANUAL, None), L.STATUS_CREATED),
    (3, "gone", L.STATUS_CREATED, "manual_unresolved", 77, "prev", None, (None, "pm", "pt"), L.STATUS_CREATED),
    (4, "same", L.STATUS_DOCUMENTED, "exact", 10, L.MATCH_IMPORTED, False, (None, "pm", "pt"), L.STATUS_DOCUMENTED),
    (5, "ה–ד", L.STATUS_KEPT, "hygiene", 11, L.MATCH_IMPORTED, False, (True, L.METHOD_HYGIENE, "ה-ד"), L.STATUS_KEPT),
    (6, "קרבן אלוקים", L.STATUS_SPLIT, "semantic", 12, L.MATCH_UNRELATED, False, (True, "כתיב_אלוהים+קרבן_לקורבן", "קורבן אלוהים"), L.STATUS_SPLIT),
    (7, "denied", L.STATUS_DOCUMENTED, "denied", 77, "prev", None, (None, "pm", "pt"), L.STATUS_DOCUMENTED),
    (8, "tmpl", L.STATUS_KEPT, "template", 10, L.MATCH_IMPORTED, False, (True, L.METHOD_TEMPLATE, "same"), L.STATUS_DOCUMENTED),
    (9, "tmpl2", L.STATUS_CREATED, "template", 10, L.MATCH_UNRELATED, False, (True, L.METHOD_TEMPLATE, "same"), L.STATUS_CREATED),
    (10, "lost", L.STATUS_UNDOCUMENTED, "unmatched", 77, "prev", True, (False, None, None), L.STATUS_UNDOCUMENTED),
    (11, "lost too", L.STATUS_KEPT, "unmatched", 77, "prev", None, (False, None, None), L.STATUS_KEPT),
]


def test_cascade_truth_table(spark):
    local = spark.createDataFrame([(i, t, s, None, 77, "prev", None, None, "pm", "pt", False, False, "x") for i, t, s, *_ in CASCADE] + [(0, "same", L.STATUS_KEPT, None, None, "prev", None, None, None, None, False, False, "x")], LOCAL)
    upstream = spark.createDataFrame([(10, "same"), (11, "ה-ד"), (12, "קורבן אלוהים"), (13, "same "), (14, ""), (0, "lost")], "id long, title string")
    manual = spark.createDataFrame([(2, 10), (3, -1)], "local_page_id long, upstream_page_id long")
    page = "{{מיון ויקיפדיה|דף=[[same]]}}"
    content = spark.createDataFrame([("denied", page, True), ("tmpl", page, False), ("tmpl2", page, False), ("lost", "no", False)], "title string, content string, denied boolean")
    got = {r.id: r for r in matching.cascade(local, upstream, manual, content).collect()}
    assert set(got) == {i for i, *_ in CASCADE}
    for i, _, _, stage, uid, kind, deleted, (match, method, title), status in CASCADE:
        r = got[i]
        assert (r.stage, r.upstream_id, r.match_type, r.maybe_deleted_upstream, r.normalization_match, r.normalization_method, r.title_normalized, r.status) == (stage, uid, kind, deleted, match, method, title, status)
    counts = matching.key_collisions(upstream).first()
    assert (counts.titles, counts.keys, counts.collisions) == (4, 3, 1)


def test_reports(spark):
    rows = [(1, "a", L.STATUS_UNDOCUMENTED, True, False, False), (2, "b", L.STATUS_UNDOCUMENTED, False, False, False), (3, "c", L.STATUS_KEPT, True, True, False), (4, "d", L.STATUS_KEPT, False, False, False)]
    local = spark.createDataFrame(rows, "id long, title string, status string, maybe_deleted_upstream boolean, needs_attention boolean, is_dictionary_entry boolean")
    local = local.withColumns({"source_type": F.lit("x"), "match_type": F.lit("m"), "upstream_id": F.when(F.col("id") == 1, F.lit(100)).cast("long")})
    assert [r.id for r in reports.possibly_deleted(local).collect()] == [1]
    assert [r.id for r in reports.undocumented(local).collect()] == [1, 2]
    assert [(r.id, r.task_type) for r in reports.tasks(local).orderBy("id").collect()] == [(1, L.TASK_DELETED), (2, L.TASK_STATUS)]
    upstream = spark.createDataFrame([(100, "a"), (101, "b"), (102, "blocked")], "id long, title string")
    blocked = spark.createDataFrame([("blocked",)], "title string")
    assert [r.id for r in reports.missing_locally(upstream, local, blocked).collect()] == [101]


def test_locks(spark):
    missing = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")], "id long, title string")
    info = spark.createDataFrame([("a", None, None), ("b", "create", None), ("c", "read", 9), ("d", "edit", 8)], "title string, allevel string, page_id long")
    routes = locks.routed(missing, info).cache()
    assert {r.title: r.route for r in routes.collect()} == {"a": "open", "b": "create_locked", "c": "read_locked", "d": "unknown", "e": "not_returned"}
    curated = spark.createDataFrame([("b", 7, "old", "d1"), ("z", 6, "old", "d2")], "title string, upstream_id long, reason string, added_at string")
    got = sorted(map(tuple, locks.added(curated, locks.to_blocked(routes), "title", F.lit("now")).collect()))
    assert got == [("b", 2, L.REASON_CREATE_LOCK, "d1"), ("z", 6, "old", "d2")]
    fresh = curated.filter("title = 'z'")
    got = sorted(map(tuple, locks.added(fresh, locks.to_blocked(routes), "title", F.lit("now")).collect()))
    assert got == [("b", 2, L.REASON_CREATE_LOCK, "now"), ("z", 6, "old", "d2")]
    assert [tuple(r) for r in locks.to_manual(routes).collect()] == [(9, 3, L.REASON_READ_LOCK)]


def test_repeated_titles(spark):
    """Of several contents or answers for one title the last one counts; local rows are not multiplied."""
    info = spark.createDataFrame([(1, "a", "create", 5), (2, "a", None, 6), (0, "a", "read", 7)], "pos long, title string, allevel string, page_id long")
    missing = spark.createDataFrame([(1, "a")], "id long, title string")
    assert [(r.route, r.page_id) for r in locks.routed(missing, info).collect()] == [("open", 6)]
    assert locks.routed(missing, info.drop("pos")).count() == 1
    content = spark.createDataFrame([(1, "t", "{{מיון ויקיפדיה|דף=x}}", False), (2, "t", "none", False)], "pos long, title string, content string, denied boolean")
    local = spark.createDataFrame([(1, "t")], "id long, title string")
    assert [r.value for r in matching.with_candidates(local, content).collect()] == [None]


def test_reload(spark):
    """A fresh run forgets what is stored; a resumed one goes on from it."""
    stored = spark.createDataFrame([(-3, 1, "a"), (-2, 2, "b"), (-1, 3, "c")], "pos long, id long, title string")
    arriving = spark.createDataFrame([(1, 2, "x"), (2, 4, "c")], "pos long, id long, title string")
    names = lambda df: sorted((r.id, r.title) for r in df.collect())
    assert names(ingest.reloaded(stored, arriving, fresh=True)) == [(2, "x"), (4, "c")]
    assert names(ingest.reloaded(stored, arriving, fresh=False)) == [(1, "a"), (2, "x"), (4, "c")]


def test_json_answers(spark):
    listing = spark.createDataFrame([(0, '{"query": {"allpages": [{"title": "a", "pageid": 1}, {"title": "b", "pageid": 2}]}, "continue": {"apcontinue": "c"}}'), (1, "{}")], "pos long, body string")
    assert [(r.batch, r.id, r.title) for r in json_answers.listing_rows(listing).collect()] == [(0, 1, "a"), (0, 2, "b")]
    category = spark.createDataFrame([("k", 0, '{"query": {"categorymembers": [{"title": "a", "pageid": 1}]}}')], "category string, pos long, body string")
    assert [tuple(r) for r in json_answers.category_rows(category).collect()] == [("k", 0, 0, "a", 1)]


@pytest.mark.parametrize("name", ["orphans", "domains", "duplicates"])
def test_integrity(spark, name):
    local = spark.createDataFrame([(1, 10, "ok"), (2, 11, "bad"), (2, None, "ok")], "id long, upstream_id long, status string")
    upstream = spark.createDataFrame([(10,)], "id long")
    got = {"orphans": ingest.orphans(local, upstream).select("id"), "domains": ingest.outside_domain(local, "status", ("ok",)).select("id"), "duplicates": ingest.duplicates(local, "id").select("value")}[name]
    assert [r[0] for r in got.collect()] == [2]
