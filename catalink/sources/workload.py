"""Catalogs derived from the ``orders`` table, as SQL that Spark and DuckDB both run.

Titles collide now and then, ids are re-titled now and then, and each residue
of n modulo 9 exercises one stage of the matching cascade. Every relation is a
function of the rows alone, so any two engines derive the same catalogs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import labels as L
from ..operators.ingest import in_sequence

_RLM, _EN_DASH = "\u200f", "\u2013"

_V = "concat(base, ' v', CAST(n AS STRING))"

#: Title of order n on each side: (residue, upstream, local).
_TITLES = (
    (0, "base", "base"),
    (1, "concat(base, ' ה-ד')", f"concat('{_RLM}', base, ' ה{_EN_DASH}ד')"),
    (2, "concat(base, ' אלוהים')", "concat(base, ' אלוקים')"),
    (3, "concat(base, ' קורבן')", "concat(base, ' קרבן')"),
    (4, "concat(base, ' ישו')", "concat(base, ' אותו האיש')"),
    (5, "concat(base, ' ה''תש\"ף')", "concat(base, '  ה''תש\"פ ')"),
    (6, _V, "concat(base, ' manual ', CAST(n AS STRING))"),
    (7, _V, "concat(base, ' tmpl ', CAST(n AS STRING))"),
    (8, _V, "concat(base, ' other ', CAST(n AS STRING))"),
)


def _title(side: int) -> str:
    return "CASE n % 9 " + " ".join(f"WHEN {t[0]} THEN {t[side]}" for t in _TITLES) + " END"


_BASE = "SELECT o_orderkey AS n, concat(substr(o_orderpriority, 3), ' ', CAST(CAST(floor(o_orderkey / 27) AS BIGINT) AS STRING)) AS base FROM orders"

#: Categories of local titles: every so many orders, a title is in the role.
_ROLES = {
    "created": 10,
    "translated": 14,
    "disambiguation": 22,
    "external_1": 26,
    "external_2": 34,
    "kept": 15,
    "split": 38,
    "missing_sort": 4,
    "attention": 11,
    "dictionary": 13,
}
_MONTHS = {"ערכים שעודכנו לאחרונה בנובמבר 2023": 3, "ערכים שעודכנו לאחרונה במאי 2024": 6, "ערכים אחרים": 12}


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows) + ")"


_PLACED = "SELECT o_orderkey AS n, o_orderkey % 64 AS l, row_number() OVER (PARTITION BY o_orderkey % 64 ORDER BY o_orderkey) AS i, lag(o_orderkey) OVER (PARTITION BY o_orderkey % 64 ORDER BY o_orderkey) AS prev, lead(o_orderkey) OVER (PARTITION BY o_orderkey % 64 ORDER BY o_orderkey) AS nxt FROM orders"
_PAGES = "CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN concat('\"allpages\": [{\"pageid\": ', CAST(n AS STRING), ', \"title\": \"p', CAST(n AS STRING), '\"}]') ELSE concat('\"allpages\": [{\"pageid\": ', CAST(n AS STRING), ', \"title\": \"p', CAST(n AS STRING), '\"}, {\"pageid\": ', CAST(n + 100000000 AS STRING), ', \"title\": \"q', CAST(n AS STRING), '\"}]') END"
#: Token of the next answer; in some lists the last answer leads back.
_NEXT = "CASE WHEN nxt IS NOT NULL THEN concat('k', CAST(nxt AS STRING)) WHEN l % 16 = 5 THEN concat('k', CAST(prev AS STRING)) END"

_HALVES = 3

_SELECTED = f"SELECT n, {_title(2)} AS title, concat('content ', base) AS content, n % 31 = 7 OR n % 37 = 5 AS denied"
_SELECTED_FROM = f" FROM ({_BASE}) b WHERE n % 9 >= 6"
#: The selected titles with their place r in the order of n.
_ASKED = f"{_SELECTED}, row_number() OVER (ORDER BY n) - 1 AS r{_SELECTED_FROM}"


def _halves() -> str:
    """Titles of batches of 8 with the codes, sizes and places of the halves that hold them, level by level."""
    sql = f"SELECT n, title, content, denied, CAST(floor(r / 8) AS BIGINT) AS batch, r % 8 AS p0, count(*) OVER (PARTITION BY floor(r / 8)) AS s0, '' AS c0 FROM ({_ASKED}) x"
    for i in range(_HALVES):
        half = f"CAST(floor(s{i} / 2) AS BIGINT)"
        sql = f"SELECT *, CASE WHEN s{i} > 1 THEN concat(c{i}, CASE WHEN p{i} < {half} THEN '0' ELSE '1' END) END AS c{i + 1}, CASE WHEN p{i} < {half} THEN p{i} ELSE p{i} - {half} END AS p{i + 1}, CASE WHEN p{i} < {half} THEN {half} ELSE s{i} - {half} END AS s{i + 1} FROM ({sql}) x{i}"
    return sql


def _batch_pages() -> str:
    """(batch, code, title, content, denied, size) of each title in each node whose parent was denied."""
    parts = [f"SELECT batch, c0 AS code, s0 AS size, title, content, max(CASE WHEN denied THEN 1 ELSE 0 END) OVER (PARTITION BY batch, c0) AS d FROM halves"]
    for i in range(1, _HALVES + 1):
        asked = f"max(CASE WHEN denied THEN 1 ELSE 0 END) OVER (PARTITION BY batch, c{i - 1})"
        parts.append(f"SELECT batch, code, size, title, content, d FROM (SELECT batch, c{i} AS code, s{i} AS size, title, content, {asked} AS up, max(CASE WHEN denied THEN 1 ELSE 0 END) OVER (PARTITION BY batch, c{i}) AS d FROM halves WHERE c{i} IS NOT NULL) h WHERE up = 1")
    return f"WITH halves AS ({_halves()}) " + " UNION ALL ".join(parts)


def _answer(pos: str, asked: str, following: str, where: str) -> str:
    body = f"concat('{{\"query\": {{', {_PAGES}, '}}', coalesce(', \"continue\": {{\"apcontinue\": \"' || {following} || '\"}}', ''), '}}')"
    return f"SELECT {pos} AS pos, concat('list ', CAST(l AS STRING)) AS list, {asked} AS asked, {body} AS body FROM ({_PLACED}) b WHERE {where}"


_ARRIVAL = "(n * 7919) % 10007 * 10000000 + n"
_TOKEN = "CASE WHEN prev IS NOT NULL THEN concat('k', CAST(n AS STRING)) END"
#: Lists by their number modulo 16: an answer is missing (3), the last leads back (5), another answer to one token (7; it counts from list 32 on), no first answer (9), two answers lead to one (11).
_PRESENT = "NOT (l % 16 = 3 AND i = 9) AND NOT (l % 16 = 9 AND i = 1)"

RELATIONS: dict[str, str] = {
    "base": _BASE,
    # arrival logs: now and then a row comes under the id of the one before
    "upstream_log": f"SELECT n AS pos, CAST(floor(n / 500) AS BIGINT) AS batch, CASE WHEN n % 50 = 0 THEN n ELSE n + 1 END AS id, {_title(1)} AS title, make_timestamp(2024, 1, 1, CAST(floor(n / 30000) AS INT) % 24, CAST(floor(n / 500) AS INT) % 60, 0) AS checked_at FROM ({_BASE}) b",
    # an earlier state of the upstream table: some rows come again, with their id or their title, others don't
    "stored_log": f"SELECT n - 100000000 AS pos, CASE WHEN n % 3 = 0 THEN n + 1 ELSE 90000000 + n END AS id, CASE WHEN n % 5 = 0 THEN {_title(1)} ELSE concat({_title(1)}, ' stored') END AS title FROM ({_BASE}) b",
    # a later log in which each title has a new id, and upstream ids that are gone
    "later_log": f"SELECT DISTINCT n + 2 AS id, {_title(1)} AS title FROM ({_BASE}) b",
    "stale_ids": "SELECT o_orderkey + 1 AS id FROM orders WHERE o_orderstatus = 'F'",
    "local_log": f"SELECT n AS pos, CAST(floor(n / 500) AS BIGINT) AS batch, CASE WHEN n % 70 = 0 THEN 1000000 + n ELSE 1000001 + n END AS id, CASE WHEN n % 997 = 0 THEN '' ELSE {_title(2)} END AS title FROM ({_BASE}) b",
    "manual_matches": "SELECT 1000001 + o_orderkey AS local_page_id, CASE WHEN o_orderkey % 4 = 0 THEN CAST(-1 AS BIGINT) ELSE o_orderkey + 1 END AS upstream_page_id, 'manual' AS reason FROM orders WHERE o_orderkey % 9 = 6",
    "page_content": f"SELECT {_title(2)} AS title, CASE WHEN n % 9 = 7 AND n % 2 = 0 THEN concat('x {{{{ מיון ויקיפדיה | דף=[[', base, '_v', CAST(n AS STRING), ']]|a=1}}}} y') WHEN n % 9 = 7 THEN 'no template' END AS content, n % 9 = 8 AND n % 2 = 0 AS denied FROM ({_BASE}) b WHERE n % 9 >= 7",
    "category_members": f"SELECT r.role AS category, CASE WHEN n % 101 = 0 THEN 'subcat' ELSE 'page' END AS member_type, CASE WHEN n % 103 = 0 THEN 14 ELSE 0 END AS namespace, n AS ordinal, {_title(2)} AS title, 1000001 + n AS page_id FROM ({_BASE}) b JOIN {_values(_ROLES.items())} AS r(role, every_n) ON n % r.every_n = 0",
    "dated_subcategories": f"SELECT m.category, m.ordinal, {_title(2)} AS title FROM ({_BASE}) b JOIN {_values((c, i + 1, e) for i, (c, e) in enumerate(_MONTHS.items()))} AS m(category, ordinal, every_n) ON n % m.every_n = 0",
    # the dated subcategories as members of their root, each with pages, subcategories and pages of other namespaces
    "category_tree": f"SELECT 'dated' AS category, CASE WHEN name LIKE '%x' THEN 'page' ELSE 'subcat' END AS member_type, 14 AS namespace, ordinal, name AS title FROM {_values([*((c, i + 1) for i, c in enumerate(_MONTHS)), ('ערכים שעודכנו לאחרונה במאי 2020x', 9)])} AS r(name, ordinal) UNION ALL SELECT m.category, CASE WHEN n % 101 = 0 THEN 'subcat' ELSE 'page' END AS member_type, CASE WHEN n % 103 = 0 THEN 14 ELSE 0 END AS namespace, n AS ordinal, {_title(2)} AS title FROM ({_BASE}) b JOIN {_values((c, e) for c, e in _MONTHS.items())} AS m(category, every_n) ON n % m.every_n = 0",
    # what an earlier run had left on the local rows
    "earlier_matches": "SELECT 1000001 + o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + 10 END AS upstream_id, CASE WHEN o_orderkey % 7 = 0 THEN 'יובא מוויקיפדיה' ELSE 'ללא התאמה' END AS match_type, o_orderkey % 21 = 0 AS maybe_deleted_upstream, o_orderkey % 28 = 0 AS normalization_match, CASE WHEN o_orderkey % 28 = 0 THEN 'תבנית_מיון' END AS normalization_method, CASE WHEN o_orderkey % 28 = 0 THEN 'old' END AS title_normalized FROM orders",
    "page_info": f"SELECT {_title(1)} AS title, CASE n % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'create' WHEN 2 THEN 'read' WHEN 3 THEN 'edit' END AS allevel, n % 2 = 0 AS missing, 5000000 + n AS page_id FROM ({_BASE}) b WHERE n % 9 >= 7 AND n % 6 <> 5",
    # locks on all upstream titles: a page that is locked for reading takes the local page of the order before, so its former target goes missing next
    "chained_info": f"SELECT {_title(1)} AS title, CASE n % 5 WHEN 0 THEN 'create' WHEN 4 THEN 'none' ELSE 'read' END AS allevel, 1000001 + n - 1 AS page_id FROM ({_BASE}) b WHERE n % 9 >= 3",
    # changes of the upstream table: rows that go, get another title, or come with a title that another row has but for its dashes
    "upstream_changes": f"SELECT id, title, -1 AS change FROM stood WHERE id % 50 IN (1, 2) UNION ALL SELECT id, concat(title, ' moved') AS title, 1 AS change FROM stood WHERE id % 50 = 2 UNION ALL SELECT 50000000 + id AS id, replace(title, '-', '{_EN_DASH}') AS title, 1 AS change FROM stood WHERE id % 50 IN (1, 3) AND title LIKE '%-%' UNION ALL SELECT 60000000 + id AS id, concat(title, ' new') AS title, 1 AS change FROM stood WHERE id % 50 = 4",
    "blocked_titles": f"SELECT {_title(1)} AS title, 'curated' AS reason, n + 1 AS upstream_id, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS added_at FROM ({_BASE}) b WHERE n % 9 >= 7 AND n % 36 = 7",
    "curated_manual": "SELECT 5000000 + o_orderkey AS local_page_id, o_orderkey + 1 AS upstream_page_id, 'curated' AS reason, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS added_at FROM orders WHERE o_orderkey % 63 = 7",
    # local rows that someone has edited by hand
    "edited_rows": f"SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN '{L.STATUS_DOCUMENTED}' WHEN 'O' THEN '{L.STATUS_KEPT}' ELSE 'other' END AS status, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '{L.MATCH_IMPORTED}' WHEN '2' THEN '{L.MATCH_NONE}' WHEN '3' THEN '{L.MATCH_UNRELATED}' ELSE 'other' END AS match_type FROM orders",
    "listing_answers": "SELECT o_orderkey AS pos, CASE o_orderkey % 4 WHEN 0 THEN '{\"query\": {}}' WHEN 1 THEN concat('{\"query\": {\"allpages\": [{\"pageid\": ', CAST(o_orderkey AS STRING), ', \"title\": \"a', CAST(o_orderkey AS STRING), '\"}]}}') ELSE concat('{\"query\": {\"allpages\": [{\"pageid\": ', CAST(o_orderkey AS STRING), ', \"title\": \"a', CAST(o_orderkey AS STRING), '\"}, {\"pageid\": 7, \"title\": \"b\"}]}, \"continue\": {\"apcontinue\": \"c\"}}') END AS body FROM orders",
    # answers of listings with tokens, in any order, every fifth one twice
    "paged_answers": " UNION ALL ".join(
        (
            _answer(_ARRIVAL, _TOKEN, _NEXT, _PRESENT),
            _answer(f"{_ARRIVAL} + 200000000000", _TOKEN, _NEXT, f"n % 5 = 0 AND {_PRESENT}"),
            _answer("CASE WHEN l < 32 THEN -n ELSE 300000000000 + n END", _TOKEN, "CAST(NULL AS STRING)", "l % 16 = 7 AND i = 6"),
            _answer("400000000000 + n", "concat('odd', CAST(n AS STRING))", _NEXT, "l % 16 = 11 AND i = 8"),
        )
    ),
    # what came of asking for contents in batches, halved where they were denied; some last halves are not there yet
    "asked_titles": f"SELECT batch, p0 AS place, s0 AS size, title, content, denied FROM ({_halves()}) h",
    "batch_pages": f"SELECT batch, code, title, content, d = 1 AS denied, size FROM ({_batch_pages()}) b WHERE NOT (batch % 17 = 3 AND length(code) > 2)",
    # answers of which some are cut off, no JSON, of another shape, or empty
    "damaged_answers": "SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 7 = 0 THEN concat('{\"query\": {\"allpages\": [{\"pageid\": ', CAST(o_orderkey AS STRING)) WHEN o_orderkey % 11 = 0 THEN '<html>busy</html>' WHEN o_orderkey % 13 = 0 THEN '{\"query\": 5}' WHEN o_orderkey % 17 = 0 THEN ' ' WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('{\"query\": {\"allpages\": [{\"pageid\": ', CAST(o_orderkey AS STRING), ', \"title\": \"a\"}]}}') END AS body FROM orders",
    "category_answers": "SELECT o_orderpriority AS category, o_orderkey AS pos, CASE o_orderkey % 4 WHEN 0 THEN '{}' WHEN 1 THEN concat('{\"query\": {\"categorymembers\": [{\"pageid\": ', CAST(o_orderkey AS STRING), ', \"title\": \"a\"}]}}') ELSE concat('{\"query\": {\"categorymembers\": [{\"title\": \"b', CAST(o_orderkey AS STRING), '\"}, {\"pageid\": 7, \"title\": \"c\"}]}}') END AS body FROM orders",
    "content_answers": "SELECT o_orderkey AS pos, concat('t', CAST(o_orderkey AS STRING)) AS title, CASE WHEN o_orderkey % 10 = 3 THEN '{\"error\": {\"code\": \"denied\"}}' WHEN o_orderkey % 10 = 4 THEN concat('{\"query\": {\"pages\": [{\"title\": \"t', CAST(o_orderkey AS STRING), '\"}]}}') ELSE concat('{\"query\": {\"pages\": [{\"title\": \"t', CAST(o_orderkey AS STRING), '\", \"revisions\": [{\"slots\": {\"main\": {\"content\": \"c ', o_orderpriority, '\"}}}, {\"slots\": {\"main\": {\"content\": \"old\"}}}]}]}}') END AS body FROM orders",
    "lock_answers": "SELECT o_orderkey AS pos, CASE o_orderkey % 4 WHEN 0 THEN concat('{\"query\": {\"pages\": [{\"title\": \"t', CAST(o_orderkey AS STRING), '\", \"missing\": true}]}}') WHEN 1 THEN '{\"query\": {}}' ELSE concat('{\"query\": {\"pages\": [{\"title\": \"t', CAST(o_orderkey AS STRING), '\", \"allevel\": \"create\", \"pageid\": ', CAST(o_orderkey AS STRING), '}, {\"title\": \"u', CAST(o_orderkey AS STRING), '\", \"allevel\": \"read\"}]}}') END AS body FROM orders",
}


def relation(spark: SparkSession, sf_dir: str, name: str, stood: DataFrame | None = None) -> DataFrame:
    """A derived relation over the ``orders`` table in ``sf_dir``; over ``stood``, a table (id, title), if that is given."""
    if stood is not None:
        return spark.sql(RELATIONS[name].replace("FROM stood", "FROM {stood}"), stood=stood)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if _ASKED in RELATIONS[name]:
        # the window over all rows would hold them in one task; the same places come from a sort over all partitions
        asked = in_sequence(_over(spark, f"{_SELECTED}{_SELECTED_FROM}", orders=orders), "n").withColumnRenamed("number", "r")
        return _over(spark, RELATIONS[name].replace(_ASKED, "SELECT * FROM asked"), asked=asked)
    return _over(spark, RELATIONS[name], orders=orders)


def _over(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """The rows of a query over the named frames."""
    # braces of the text itself are doubled, as the parameters are named by braces
    text = sql.replace("{", "{{").replace("}", "}}")
    for table in tables:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(text, **tables)
