"""Chains of answers, numbered scans, nested batches, normal form and rejected bodies against plain Python."""

import random
import unicodedata

from pyspark.sql import functions as F

from catalink.functions.normal_form import composed
from catalink.operators import batches, continuation, ingest, work
from catalink.operators.counters import Counters
from catalink.sources import json_answers, workload


def walk(answers):
    """The chain of each list by following tokens one by one."""
    last = {}
    for name, asked, following, pos, n in sorted(answers, key=lambda a: a[3]):
        last[name, asked] = (following, pos, n)
    out = {}
    for name in {a[0] for a in answers}:
        at, rank, before, seen = None, 0, 0, set()
        while (name, at) in last and at not in seen:
            seen.add(at)
            following, pos, n = last[name, at]
            out[name, at] = (rank, before)
            rank, before, at = rank + 1, before + n, following
            if following is None:
                break
    return out, last


def test_chains_in_any_order(spark):
    draw = random.Random(8)
    answers, pos = [], 0
    for name in range(12):
        tokens = [None, *[f"{name}-{i}" for i in range(draw.randint(0, 40))]]
        for i, token in enumerate(tokens):
            following = tokens[i + 1] if i + 1 < len(tokens) else (tokens[len(tokens) // 2] if name % 4 == 1 and len(tokens) > 2 else None)
            if name % 4 == 2 and i == len(tokens) // 2:
                continue
            answers += [(f"l{name}", token, following, pos := pos + 1, draw.randint(0, 3)) for _ in range(draw.choice([1, 1, 2]))]
    draw.shuffle(answers)
    frame = spark.createDataFrame(answers, "list string, asked string, next string, pos long, n int")
    chain = continuation.ranked(frame)
    got = {(r.list, None if r["at"] == "^" else r["at"][1:]): (r["rank"], r.before) for r in chain.collect()}
    want, last = walk(answers)
    assert got == want
    problems = {(r.list, r.problem, r.token) for r in continuation.broken(frame, chain).collect()}
    gaps = {(n, "gap", last[n, a][0]) for n, a in want if last[n, a][0] is not None and (n, last[n, a][0]) not in last}
    loops = {(n, "loop", last[n, a][0]) for n, a in want if last[n, a][0] is not None and want.get((n, last[n, a][0]), (99,))[0] <= want[n, a][0]}
    strays = {(n, "stray", a) for n, a in last if (n, a) not in want}
    assert {p for p in problems if p[1] in ("gap", "loop", "stray")} == gaps | loops | strays
    assert gaps and loops and strays
    assert continuation.ranked(frame.filter("false")).count() == 0


def test_chains_by_contraction(spark, monkeypatch):
    """With few pointers left to doubling, the same places as by doubling alone, in lists with gaps, loops and merges, and tables that shrink round by round."""
    draw = random.Random(9)
    answers, pos = [], 0
    for name in range(8):
        tokens = [None, *[f"{name}-{i}" for i in range(draw.randint(20, 90))]]
        for i, token in enumerate(tokens):
            following = tokens[i + 1] if i + 1 < len(tokens) else (tokens[draw.randrange(1, len(tokens))] if name % 4 == 1 else None)
            if name % 4 == 2 and i == len(tokens) // 2:
                continue
            answers.append((f"l{name}", token, following, pos := pos + 1, draw.randint(0, 3)))
        if name % 4 == 3:
            answers.append((f"l{name}", "odd", tokens[5], pos := pos + 1, 1))
            answers.append((f"l{name}", "self", "self", pos := pos + 1, 1))
    draw.shuffle(answers)
    written = []
    monkeypatch.setattr(continuation, "saved", lambda df, name: written.append((name, work.saved(df, name))) or written[-1][1])
    got = continuation.ranked(spark.createDataFrame(answers, "list string, asked string, next string, pos long, n int"), few=4)
    assert {(r.list, None if r["at"] == "^" else r["at"][1:]): (r["rank"], r.before) for r in got.collect()} == walk(answers)[0]
    sizes = [df.count() for name, df in written if name == "contracted"]
    assert len(sizes) > 5 and sum(sizes) < 6 * len(answers) and sizes[-1] < len(answers) / 4


def test_titles_of_batches_are_numbered_by_all_tasks(spark, tmp_path):
    """The places are those of the window, which would hold all titles in one task."""
    spark.range(500, 0, -1).selectExpr("id * 3 AS o_orderkey", "concat('1-P', id % 5) AS o_orderpriority").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    for name in ("asked_titles", "batch_pages"):
        got = workload.relation(spark, str(tmp_path), name)
        assert "row_number" not in got._jdf.queryExecution().optimizedPlan().toString()
        text = workload.RELATIONS[name].replace("{", "{{").replace("}", "}}").replace("FROM orders", "FROM {orders}")
        want = spark.sql(text, orders=spark.read.parquet(str(tmp_path / "orders.parquet")))
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) != []


def test_numbered_pages(spark):
    draw = random.Random(1)
    ids = draw.sample(range(-50, 5000), 1000)
    table = spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, title string")
    rows = ingest.numbered(table, 7)
    want = sorted(i for i in ids if i > 7)
    assert [(r.number, r.id) for r in rows.orderBy("number").collect()] == list(enumerate(want))
    for size in (1000, 10, len(want), 7):
        requests, cursor = [], 7
        while True:
            page = [i for i in want if i > cursor][:size]
            requests.append((cursor, len(page)))
            if len(page) < size:
                break
            cursor = page[-1]
        got = ingest.page_requests(rows, size, 7).orderBy("page").collect()
        assert [(r.cursor, r.n) for r in got] == requests
        placed = {(r.id, r.page, r.place, r.cursor) for r in ingest.paginated(rows, size, 7).collect()}
        assert placed == {(v, i // size, i % size, requests[i // size][0]) for i, v in enumerate(want)}
    none = ingest.numbered(table.filter("false"))
    assert none.count() == 0 and [tuple(r) for r in ingest.page_requests(none, 5).collect()] == [(0, 0, 0, None)]


def bisected(titles, denied):
    """The answers that halving gives: (code, denied, titles)."""
    out, todo = [], [("", titles)]
    while todo:
        code, some = todo.pop()
        no = any(t in denied for t in some)
        out.append((code, no, some))
        if no and len(some) > 1:
            todo += [(code + "0", some[: len(some) // 2]), (code + "1", some[len(some) // 2 :])]
    return out


def test_the_smallest_batch_decides(spark):
    draw = random.Random(6)
    asked, answers, pages, want = [], [], [], []
    for b, size in enumerate((1, 2, 3, 7, 50, 50, 49, 500)):
        titles = [f"b{b} t{i}" for i in range(size)]
        denied = set(draw.sample(titles, size // 5 + b % 2))
        lost = b == 5
        asked += [(b, i, size, t) for i, t in enumerate(titles)]
        smallest = {}
        for code, no, some in bisected(titles, denied):
            if lost and len(code) > 2:
                continue
            answers += [(b, code, 1, no), (b, code, 0, not no)]
            pages += [(b, code, t, f"content of {t}") for t in some if not no and not t.endswith("3")]
            for t in some:
                smallest[t] = max(smallest.get(t, ("", no, 0)), (code, no, len(some)), key=lambda x: len(x[0]))
        for t in titles:
            _, no, n = smallest[t]
            want.append((t, None if no or t.endswith("3") else f"content of {t}", no and n == 1, no and n > 1))
    asked.append((99, 0, 1, "never answered"))
    want.append(("never answered", None, False, True))
    got = batches.isolated(
        spark.createDataFrame(asked, "batch int, place int, size int, title string"),
        spark.createDataFrame(answers, "batch int, code string, pos int, denied boolean"),
        spark.createDataFrame(pages, "batch int, code string, title string, content string"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_normal_form(spark):
    """The whole basic plane and 20,000 mixes of marks, letters, jamo and characters beyond it."""
    draw = random.Random(1)
    pool = [chr(i) for a, b in ((0x300, 0x370), (0x1E00, 0x2000), (0x1100, 0x1113), (0x1161, 0x1176), (0x11A7, 0x11C3), (0x5B0, 0x5C8), (0xFB1D, 0xFB4F), (0x900, 0xA00), (0xAC00, 0xAC40)) for i in range(a, b)]
    pool += [*"aeiouAOUcnsz", "\U0001d15e", "\U0001d165", "\U0002f800", "\U00011099", "\U000110ba", "Å"]
    texts = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000] + ["".join(draw.choice(pool) for _ in range(draw.randint(0, 12))) for _ in range(20_000)] + [None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", composed(F.col("t")).alias("n")).collect()
    assert len(rows) == len(texts) and [r for r in rows if r.n != (None if r.t is None else unicodedata.normalize("NFC", r.t))] == []


def test_accepted_and_rejected(spark):
    bodies = ['{"query": {"allpages": []}}', '{"query": {}, "more": [1]}', "{}", '{"query": {"allpages": [', "<html>", "", "  ", None, '{"query": 5}', '{"query": {"allpages": [{"pageid": "x"}]}}']
    answers = spark.createDataFrame(list(enumerate(bodies)), "pos int, body string")
    good = sorted(r.pos for r in json_answers.accepted(answers).collect())
    bad = {r.pos: r.reason for r in json_answers.rejected(answers).collect()}
    assert good == [0, 1, 2] and bad == {3: "malformed", 4: "malformed", 5: "empty", 6: "empty", 7: "empty", 8: "malformed", 9: "malformed"}


def test_counters_count_what_is_written(spark):
    counters = Counters()
    kept = counters.written(spark.range(100), "some", n=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    counters.written(kept.filter("id > 97"), "few", few=F.count(F.lit(1)))
    counters.written(kept.filter("false"), "none", none=F.count(F.lit(1)))
    assert counters.counts() == {"n": 100, "even": 50, "few": 2, "none": 0} and kept.count() == 100


def test_tables_of_a_session_are_deleted(spark, monkeypatch):
    """All tables lie in one folder of the session, which one call deletes."""
    from pathlib import Path

    folder = work.work_dir(spark)
    monkeypatch.setattr(work, "work_dir", lambda _: folder + "-test")
    kept = work.saved(spark.range(10), "ten")
    assert kept.count() == 10 and Path(folder + "-test").is_dir()
    work.cleared(spark)
    assert not Path(folder + "-test").exists()
