"""The streaming fold equals the fold of the whole log, across restarts."""

import random

import pytest

from catalink.operators.ingest import upsert_fold
from catalink.sources import cursor
from catalink.streaming import state_fold
from catalink.streaming.fold import folded_table, start_fold
from catalink.streaming.state_fold import start_state_fold, table_of


def test_resumed_fold(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    rows = [(p, 0, p * 7 % 11, "abcdefg"[p * 5 % 7]) for p in range(60)]
    schema = "pos long, batch long, id long, title string"
    for part in (rows[:20], rows[20:40], rows[40:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        start_fold(spark, landing, table, checkpoint, 1).awaitTermination()
    want = sorted(map(tuple, upsert_fold(spark.createDataFrame(rows, schema)).collect()))
    assert sorted(map(tuple, folded_table(spark, table, 2).collect())) == want


def test_late_files(spark, tmp_path):
    """A file that comes late changes nothing that later rows have decided."""
    landing, table, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    schema = "pos long, batch long, id long, title string"
    parts = [[(2, 0, 2, "A"), (3, 0, 2, "B")], [(1, 0, 1, "A")], [(0, 0, 3, "C"), (5, 0, 4, "D")]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        start_fold(spark, landing, table, checkpoint, 1).awaitTermination()
    want = sorted(map(tuple, upsert_fold(spark.createDataFrame(sum(parts, []), schema)).collect()))
    assert sorted(map(tuple, folded_table(spark, table, 2).collect())) == want == [(0, 3, "C"), (3, 2, "B"), (5, 4, "D")]
    assert sorted(p.name for p in (tmp_path / "table" / "ids").iterdir()) == ["version=1", "version=2"]


def test_state_fold_equals_the_fold_of_the_whole_log(spark, tmp_path):
    """Random logs in shuffled files, a new query for each: the table of changes is that of the fold after every batch."""
    landing, out, checkpoint = (str(tmp_path / x) for x in ("landing", "out", "checkpoint"))
    draw = random.Random(4)
    schema = "pos long, batch long, id long, title string"
    rows = [(p, 0, draw.randrange(12), f"t{draw.randrange(12)}") for p in range(90)]
    draw.shuffle(rows)
    seen = []
    for part in (rows[:40], rows[40:60], rows[60:]):
        seen += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        start_state_fold(spark, landing, out, checkpoint, 1).awaitTermination()
        want = sorted(map(tuple, upsert_fold(spark.createDataFrame(seen, schema)).collect()))
        assert sorted(map(tuple, table_of(spark, out).collect())) == want
    # the log has changes, not the table again and again
    changes = spark.read.parquet(out)
    assert changes.groupBy("pos").count().filter("count > 2").count() == 0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_state_is_one_value_for_each_bucket(spark, tmp_path, monkeypatch):
    """Many keys in few buckets, in two batches: the state store is asked once a bucket, not once a key, and the table is that of the fold."""
    monkeypatch.setattr(state_fold, "BUCKETS", 3, raising=False)
    landing, out, checkpoint = (str(tmp_path / x) for x in ("landing", "out", "checkpoint"))
    draw = random.Random(5)
    schema = "pos long, batch long, id long, title string"
    rows = [(p, 0, draw.randrange(60), f't"{draw.randrange(60)}\u05d0') for p in range(200)]
    for part in (rows[:120], rows[120:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
    query = start_state_fold(spark, landing, out, checkpoint, 1)
    query.awaitTermination()
    assert sorted(map(tuple, table_of(spark, out).collect())) == sorted(map(tuple, upsert_fold(spark.createDataFrame(rows, schema)).collect()))
    assert [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators if p.numInputRows][-2:] == [3, 3]


ANSWERS = [
    (None, '{"query": {"allpages": [{"pageid": 1, "title": "a"}, {"pageid": 2, "title": "b"}]}, "continue": {"apcontinue": "c d/é={^%}"}}'),
    ("c d/é={^%}", '{"query": {}, "continue": {"apcontinue": "f"}}'),
    ("f", '{"query": {"allpages": [{"pageid": 3, "title": "f"}]}, "continue": {"apcontinue": "g"}}'),
    ("g", '{"query": {"allpages": [{"pageid": 4, "title": "g"}]}}'),
]


def listed(spark, out):
    return sorted(map(tuple, spark.read.parquet(out).select("batch", "place", "id", "title").collect()))


def test_a_stopped_load_goes_on_from_its_cursor(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "asked string, body string")
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    cursor.landed(frame(ANSWERS), whole)
    cursor.load(spark, whole, whole + "-out", whole + "-ck", answers=1)
    want = listed(spark, whole + "-out")
    assert want == [(0, 0, 1, "a"), (0, 1, 2, "b"), (2, 0, 3, "f"), (3, 0, 4, "g")]
    for rows in (ANSWERS[:2], ANSWERS[3:], ANSWERS[2:3]):
        cursor.landed(frame(rows), parts)
        cursor.load(spark, parts, parts + "-out", parts + "-ck")
    assert listed(spark, parts + "-out") == want


def test_cursors_and_progress(spark, tmp_path):
    path = str(tmp_path / "answers")
    cursor.landed(spark.createDataFrame([*ANSWERS[:3], ("g", "no json")], "asked string, body string"), path)
    (tmp_path / "good.json").write_text('{"cursor": "f", "pages": 3}')
    (tmp_path / "bad.json").write_text('{"cursor": ')
    (tmp_path / "list.json").write_text("[1]")
    at = cursor.progress(spark, str(tmp_path / "good.json"))
    assert at == {"cursor": "f", "pages": 3}
    for name in ("missing.json", "bad.json", "list.json"):
        assert cursor.progress(spark, str(tmp_path / name)) is None
    for name in ("bad.json", "list.json"):
        with pytest.raises(ValueError):
            cursor.progress(spark, str(tmp_path / name), corrupt="fail")
    cursor.load(spark, path, path + "-out", path + "-ck", start=at["cursor"], corrupt="stop")
    assert listed(spark, path + "-out") == [(0, 0, 3, "f")]
    with pytest.raises(Exception, match="is no listing"):
        cursor.load(spark, path, path + "-out2", path + "-ck2")


def test_tasks_of_a_batch_share_its_answers(spark, tmp_path):
    """A bound of few answers is one of tasks, not of batches: all answers come in one batch, several tasks read them, and a load that goes on takes what is new."""
    path, out, checkpoint = (str(tmp_path / x) for x in ("answers", "out", "checkpoint"))
    body = lambda i, last: f'{{"query": {{"allpages": [{{"pageid": {i}, "title": "t{i}"}}]}}' + ("}" if last else f', "continue": {{"apcontinue": "k{i + 1}"}}}}')
    rows = [(None if i == 0 else f"k{i}", body(i, i == 49)) for i in range(50)]
    frame = lambda some: spark.createDataFrame(some, "asked string, body string")
    cursor.landed(frame(rows[:37]), path)
    query = cursor.load(spark, path, out, checkpoint, answers=2)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [37]
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 19
    cursor.landed(frame(rows[37:]), path)
    query = cursor.load(spark, path, out, checkpoint, answers=2, tasks=3)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [6, 6, 1]
    assert listed(spark, out) == [(i, 0, i, f"t{i}") for i in range(50)]
