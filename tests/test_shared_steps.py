"""What queries share is made once, and only for those that ask for it."""

import pytest
from pyspark.sql import functions as F

from catalink.functions import labels as L
from catalink.functions import text as T
from catalink.operators import counters, curated, deltas, matching, work
from catalink.plans import registry


@pytest.fixture
def orders(spark, tmp_path):
    spark.range(600).selectExpr("id AS o_orderkey", "concat('1-P', id % 5) AS o_orderpriority", "'F' AS o_orderstatus").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.fixture
def written(monkeypatch):
    """The names and columns of the tables that are written."""
    names = []

    def saved(df, name):
        names.append((name, tuple(df.columns)))
        return work.saved(df, name)

    for module in (counters, curated, deltas, matching, registry):
        monkeypatch.setattr(module, "saved", saved)
    return names


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_local_rows_are_dealt_by_title_once(spark, orders, monkeypatch):
    plans = []
    monkeypatch.setattr(matching, "saved", lambda df, name: plans.append(df) or work.saved(df, name))
    registry.queries()["match_cascade"](spark, orders)
    (candidates,) = plans
    # the fold deals by title and pos; after that the rows go by id, then by title, and stay so up to their keys
    plan = optimized(candidates)
    assert plan.count("RepartitionByExpression [title") == 1
    assert plan.index("RepartitionByExpression [title") > plan.index("key_0") and plan[: plan.index("RepartitionByExpression")].count("earlier") == 0
    assert plan[: plan.index("RepartitionByExpression [title")].count("LeftOuter") == 3  # members, months and contents, all by title; earlier matches are below


def test_plain_titles_are_only_looked_at(spark):
    """Titles at the bounds of the short way are as by the long one."""
    plain = T._PLAIN
    titles = ["a b", " a", "a ", "a  b", "", " ", "a\tb", "a\n", "\n", "a\x7f", "~", "א-ב", "אב׫", "־", "a b", "é", "'\"", "a‏", "א\n", None]
    rows = spark.createDataFrame(list(enumerate(titles)), "i int, x string")
    long_way = T.collapsed(F.translate(T.nfc(F.col("x")), T.TRANSLATE_FROM + T.MARKS, T.TRANSLATE_TO))
    got = rows.select("x", T.hygiene(F.col("x")).alias("a"), long_way.alias("b"), F.col("x").rlike(plain).alias("p")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert [r.x for r in got if r.p] == ["a b", " a", "a ", "a  b", "", " ", "~", "א-ב", "'\""]


def test_key_map_after_changes_needs_no_cascade(spark, orders, written):
    registry.queries()["delta_key_map"](spark, orders).count()
    assert {n for n, _ in written} == {"upstream", "index", "keys", "changes", "key-changes", "lowest"}
    written.clear()
    registry.queries()["delta_matched"](spark, orders).count()
    assert "matched" in dict(written) and "missing" not in dict(written)


def test_rounds_write_ids(spark, orders, written):
    """Rounds read a table of references and one of locks; none writes rows with titles of what isn't locked, and the locks are looked up once."""
    registry.queries()["curated_rounds"](spark, orders).count()
    names = [n for n, _ in written]
    assert names.count("missing") > 2 and names.count("references") == names.count("locked") == 1 and "routes" not in names
    assert {tuple(sorted(c)) for n, c in written if n == "missing"} == {("id", "page_id", "shut")}


def test_a_run_folds_the_upstream_log_once(spark, orders, written):
    registry.queries()["run_counters"](spark, orders).count()
    assert [n for n, _ in written].count("upstream") == 1


def test_references_are_those_of_the_cascade(spark):
    """For links with and without a target, rows without a title, denied contents and hits of every rank."""
    schema = "id long, title string, status string, last_update_month string, upstream_id long, match_type string, maybe_deleted_upstream boolean, normalization_match boolean, normalization_method string, title_normalized string, needs_attention boolean, is_dictionary_entry boolean, source_type string"
    titles = ["a", "", "b", "קרבן", "t", "d", "x", None, "c", ""]
    local = spark.createDataFrame([(i + 1, t, L.STATUS_DOCUMENTED, None, 900 + i, L.MATCH_NONE, False, False, None, None, False, False, "s") for i, t in enumerate(titles)], schema)
    upstream = spark.createDataFrame([(1, "a"), (2, "b"), (3, "קורבן"), (4, "u"), (5, "v"), (-6, "c")], "id long, title string")
    content = spark.createDataFrame([("t", "{{מיון ויקיפדיה|דף=u}}", False), ("d", "{{מיון ויקיפדיה|דף=v}}", True)], "title string, content string, denied boolean")
    rows = matching.prepared(local, upstream, content)
    for links in ([], [(1, 2), (2, 2), (3, 77), (6, 5), (7, 4), (8, 3), (9, -6), (10, 77)]):
        manual = spark.createDataFrame(links, "local_page_id long, upstream_page_id long")
        want = matching.decided(rows, upstream, manual).filter("upstream_id is not null").select("upstream_id")
        got = matching.referred(matching.references(rows), matching.targets(manual, upstream))
        assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
