"""Rounds of curated rows, bucketed upserts and change sets against plain simulations and full runs."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from catalink.functions import labels as L
from catalink.operators import curated, deltas, matching

LOCAL = "id long, title string, status string, last_update_month string, upstream_id long, match_type string, maybe_deleted_upstream boolean, normalization_match boolean, normalization_method string, title_normalized string, needs_attention boolean, is_dictionary_entry boolean, source_type string"


def local_frame(spark, titles):
    return spark.createDataFrame([(i, t, L.STATUS_DOCUMENTED, None, None, L.MATCH_NONE, False, False, None, None, False, False, "s") for i, t in titles], LOCAL)


def content_frame(spark):
    return spark.createDataFrame([("none", None, False)], "title string, content string, denied boolean")


def simulated(local, upstream, manual, blocked, info):
    """Runs one after the other over dictionaries."""
    by_title = {t: i for i, t in sorted(upstream.items(), reverse=True)}
    manual, blocked, log = dict(manual), set(blocked), []
    while len(log) < 20:
        refs = set()
        for page, title in local.items():
            if page in manual:
                refs |= {manual[page]} & set(upstream)
            elif title in by_title:
                refs.add(by_title[title])
        missing = {i: t for i, t in upstream.items() if i not in refs and t not in blocked}
        shut = {t for t in missing.values() if info.get(t, ("",))[0] == "create"}
        taken = {}
        for i, t in sorted(missing.items(), reverse=True):
            if info.get(t, ("",))[0] == "read":
                taken[info[t][1]] = i
        taken = {p: i for p, i in taken.items() if manual.get(p) != i}
        log.append((len(log) + 1, len(missing), len(shut), len(taken)))
        if not shut and not taken:
            break
        blocked |= shut
        manual |= taken
    return log, manual, blocked


def test_rounds_equal_a_simulation(spark):
    draw = random.Random(2)
    upstream = {i: f"t{i}" for i in range(1, 120)}
    local = {1000 + i: f"t{i}" for i in range(1, 120) if draw.random() < 0.8}
    # chains: a locked page takes the local page of the title before it
    info = {f"t{i}": (draw.choice(["read", "read", "create", "none"]), 1000 + i - 1) for i in range(2, 120)}
    manual, blocked = {1005: 7, 1009: 999, 1200: 20}, {"t3"}
    log, want_manual, want_blocked = simulated(local, upstream, manual, blocked, info)
    frame = spark.createDataFrame(list(upstream.items()), "id long, title string")
    rows = matching.prepared(local_frame(spark, local.items()), frame, content_frame(spark))
    got = curated.rounds(
        rows,
        frame,
        spark.createDataFrame(list(manual.items()), "local_page_id long, upstream_page_id long"),
        spark.createDataFrame([(t,) for t in blocked], "title string"),
        spark.createDataFrame([(t, a, p) for t, (a, p) in info.items()], "title string, allevel string, page_id long"),
    )
    assert sorted(map(tuple, got.log.collect())) == log and len(log) > 2 and got.converged
    assert {tuple(r) for r in got.manual.collect()} == set(want_manual.items()) and {r.title for r in got.blocked.collect()} == want_blocked


def test_rounds_are_bounded(spark):
    """Two pages that name one local page take it from each other for ever."""
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id long, title string")
    rows = matching.prepared(local_frame(spark, [(10, "z")]), frame, content_frame(spark))
    info = spark.createDataFrame([("a", "read", 10), ("b", "read", 10)], "title string, allevel string, page_id long")
    none = spark.createDataFrame([], "title string"), spark.createDataFrame([], "local_page_id long, upstream_page_id long")
    got = curated.rounds(rows, frame, none[1], none[0], info, most=4)
    assert got.log.count() == 4 and not got.converged


def test_buckets_without_changes_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "curated")
    rows = [(i, i * 10, "old", "2024-01-01") for i in range(500)]
    schema = "local_page_id long, upstream_page_id long, reason string, added_at string"
    curated.bucketed(spark.createDataFrame(rows, schema), path, "local_page_id")
    files = lambda: {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    before = files()
    arriving = [(3, 33, "new", "2025-01-01"), (9000, 90, "new", "2025-01-01"), (9000, 91, "new", "2025-01-01"), (7, 70, "new", "2025-01-01")]
    curated.upsert_buckets(spark, path, spark.createDataFrame(arriving, schema), "local_page_id", keep=("added_at",))
    after = files()
    touched = {p.parts[0] for p in before.keys() ^ after.keys()}
    assert 1 <= len(touched) <= 3 and all(after[p] == t for p, t in before.items() if p.parts[0] not in touched)
    want = {r[0]: r for r in rows} | {3: (3, 33, "new", "2024-01-01"), 7: (7, 70, "new", "2024-01-01"), 9000: (9000, 91, "new", "2025-01-01")}
    assert sorted(map(tuple, curated.read_buckets(spark, path).collect())) == sorted(want.values())
    curated.upsert_buckets(spark, path, spark.createDataFrame([], schema), "local_page_id")
    assert files() == after


def test_changes_equal_a_full_run(spark):
    draw = random.Random(3)
    dashes = ["-", "–", "—"]
    title = lambda: f"a{draw.randrange(25)}{draw.choice(dashes)}b"
    local = local_frame(spark, [(1000 + i, title()) for i in range(40)])
    manual = spark.createDataFrame([(1001, 5), (1002, 300), (1003, 12)], "local_page_id long, upstream_page_id long")
    blocked = spark.createDataFrame([("a1-b",)], "title string")
    now = {}
    while len(now) < 40:
        now.setdefault(title(), 1 + len(now))
    now = {i: t for t, i in now.items()}
    frame = lambda rows: spark.createDataFrame(sorted(rows.items()), "id long, title string")
    state = deltas.full(local, frame(now), manual, content_frame(spark), blocked)
    for step in range(2):
        changes = []
        for i in draw.sample(sorted(now), 8):
            changes.append((i, now.pop(i), -1))
        for i in [300, *range(100 * (step + 1), 100 * (step + 1) + 6), changes[0][0]]:
            t = title()
            if t not in now.values() and i not in now:
                now[i] = t
                changes.append((i, t, 1))
        changes += [(500, "x", 1), (500, "x", -1)]
        state = deltas.after_changes(state, spark.createDataFrame(changes, "id long, title string, change int"), manual, blocked)
        want = deltas.full(local, frame(now), manual, content_frame(spark), blocked)
        for name in ("upstream", "index", "keys", "matched", "missing"):
            a, b = (getattr(s, name) for s in (state, want))
            assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), (step, name)
    assert state.matched.filter(F.col("stage") == "manual").count()
