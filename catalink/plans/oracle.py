"""The SQL (DuckDB) that the catalog queries are held against, over the same derived relations."""

from __future__ import annotations

import re

from ..functions import labels as L
from ..operators.matching import STAGES
from ..sources.workload import RELATIONS

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_FROM = "\u05f4\u05f3\u201c\u201d\u2018\u2019\u2010\u2011\u2012\u2013\u2014\u05be\u00a0"
_TO = "\"'\"\"''------ "
_MARKS = "[\u200e\u200f\u061c\u202a-\u202e]"


def _q(text: str) -> str:
    return text.replace("'", "''")


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{_q(v)}'" for v in values) + ")"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def hygiene(x: str) -> str:
    return _collapse(f"regexp_replace(translate(nfc_normalize({x}), '{_q(_FROM)}', '{_q(_TO)}'), '{_MARKS}', '', 'g')")


def _re(x: str, pattern: str, new: str) -> str:
    return f"regexp_replace({x}, '{_q(pattern)}', '{_q(new)}', 'g')"


def _god(x: str) -> str:
    for stem in ("אלוק", "אלק"):
        for _ in range(2):  # neighbours share the sign between them
            x = _re(x, rf"(^|[^א-ת]){stem}(ים|י|ינו|יכם|יכן|יו|יה)?([^א-ת]|$)", r"\1אלוה\2\3")
    return x


def _finals(x: str) -> str:
    for letter, final in zip("כמנפצ", "ךםןףץ", strict=True):
        x = _re(x, f"([א-ה]'[א-ת]+\"){letter}([^א-ת]|$)", rf"\1{final}\2")
    return x


RULES = (
    ("מירכאות_קדוש", lambda x: _re(x, "\"(קדוש(?:ה|ים)?)\"|'(קדוש(?:ה|ים)?)'", r"\1\2")),
    ("אליל_לאל", lambda x: _re(x, "(^|[^א-ת])אליל([א-ת]*)", r"\1אל\2")),
    ("כתיב_אלוהים", _god),
    ("מקף_שובר", lambda x: f"replace(replace({x}, 'א-ל', 'אל'), 'י-ה', 'יה')"),
    ("אות_סופית_שנה", _finals),
    ("דמות_מקראית", lambda x: f"replace({x}, '(אישיות מהתנ\"ך)', '(דמות מקראית)')"),
    ("ישו", lambda x: f"replace({x}, 'אותו האיש', 'ישו')"),
    ("מרכז_לבית_כנסת", lambda x: _re(x, "מרכז ה(נאולוגי|רפורמי|קראי|קונסרבטיבי)", r"בית הכנסת ה\1")),
    ("קרבן_לקורבן", lambda x: _re(x, "(^|[^א-ת])קרבן", r"\1קורבן")),
)


def template_value(x: str) -> str:
    raw = rf"regexp_extract({x}, '\{{\{{{_WS}*מיון{_WS}+ויקיפדיה{_WS}*\|{_WS}*דף{_WS}*={_WS}*([^|}}\n]+)', 1)"
    bare = f"regexp_replace({raw}, '^{_WS}+|{_WS}+$', '', 'g')"
    return f"nullif({_collapse(f"replace(regexp_replace({bare}, '^\\[\\[(.+)\\]\\]$', '\\1'), '_', ' ')")}, '')"


def _fold(log: str, columns: str = "pos, id, title") -> str:
    return f"SELECT {columns} FROM {log} QUALIFY pos = max(pos) OVER (PARTITION BY id) AND pos = max(pos) OVER (PARTITION BY title)"


_ROLE = {r: s for r, s in (("created", L.STATUS_CREATED), ("translated", L.STATUS_CREATED), ("disambiguation", L.STATUS_CREATED), ("external_1", L.STATUS_EXTERNAL_1), ("external_2", L.STATUS_EXTERNAL_2), ("kept", L.STATUS_KEPT), ("split", L.STATUS_SPLIT))}
_TYPE = {"created": "created", "translated": "translated", "disambiguation": "pirushon", "external_1": "chabadpedia", "external_2": "wikishiva", "kept": "wikipedia_deleted_kept", "split": "split_from_wikipedia"}


def _is(role: str) -> str:
    return f"coalesce({role}, false)"


_MONTH_NAMES = ", ".join(f"'{m}'" for m in L.MONTHS)
_MONTH_OF = (
    "CASE WHEN list_contains([{names}], {name}) THEN concat({year}, '-', lpad(CAST(list_position([{names}], {name}) AS VARCHAR), 2, '0')) END".format(
        names=_MONTH_NAMES, name=f"regexp_extract(category, 'ב([א-ת]+){_WS}+(\\p{{Nd}}{{4}})', 1)", year=f"regexp_extract(category, 'ב([א-ת]+){_WS}+(\\p{{Nd}}{{4}})', 2)"
    )
)

_STEPS = ["SELECT *, " + hygiene("title") + " AS t0 FROM {source}"] + [f"SELECT *, {rule(f't{i}')} AS t{i + 1} FROM r{i}" for i, (_, rule) in enumerate(RULES)]
_APPLIED = "concat_ws('+', " + ", ".join(f"CASE WHEN t{i + 1} <> t{i} THEN '{name}' END" for i, (name, _) in enumerate(RULES)) + ")"

#: Relations that build on the derived ones, in order of dependence.
CTES: dict[str, str] = {
    **RELATIONS,
    "upstream": _fold("upstream_log", "pos, id, title, checked_at"),
    "local_folded": _fold("local_log"),
    "pages_of": "SELECT DISTINCT category, title FROM category_members WHERE member_type = 'page' AND namespace = 0",
    "member_flags": "SELECT title, " + ", ".join(f"max(category = '{r}') AS {r}" for r in (*_ROLE, "missing_sort", "attention", "dictionary")) + " FROM pages_of GROUP BY title",
    "months": f"SELECT title, arg_max(month, ordinal) AS month FROM (SELECT *, {_MONTH_OF} AS month FROM dated_subcategories) WHERE month IS NOT NULL GROUP BY title",
    "classified": "SELECT id, title, CASE "
    + " ".join(f"WHEN {_is(r)} THEN '{_q(s)}'" for r, s in _ROLE.items())
    + f" WHEN month IS NOT NULL THEN '{L.STATUS_DOCUMENTED}' ELSE '{L.STATUS_UNDOCUMENTED}' END AS status, CASE "
    + " ".join(f"WHEN {_is(r)} THEN '{t}'" for r, t in _TYPE.items())
    + f" WHEN month IS NOT NULL THEN 'wikipedia_documented' WHEN {_is('missing_sort')} THEN 'missing_sort' ELSE 'unknown' END AS source_type, CASE WHEN NOT ("
    + " OR ".join(_is(r) for r in (*_ROLE, "missing_sort"))
    + f") THEN month END AS last_update_month, {_is('attention')} AS needs_attention, {_is('dictionary')} AS is_dictionary_entry FROM local_folded LEFT JOIN member_flags USING (title) LEFT JOIN months USING (title)",
    "local_pages": "SELECT c.*, e.upstream_id, coalesce(e.match_type, 'ללא התאמה') AS match_type, coalesce(e.maybe_deleted_upstream, false) AS maybe_deleted_upstream, coalesce(e.normalization_match, false) AS normalization_match, e.normalization_method, e.title_normalized FROM classified c LEFT JOIN earlier_matches e USING (id)",
    "upstream_keys": f"SELECT {hygiene('title')} AS key, min(id) AS uid FROM upstream WHERE id > 0 AND title <> '' GROUP BY 1",
    "r0": _STEPS[0].replace("{source}", "local_pages WHERE id > 0"),
    **{f"r{i + 1}": step for i, step in enumerate(_STEPS[1:])},
    "rewritten": f"SELECT *, t{len(RULES)} AS rewritten, {_APPLIED} AS applied FROM r{len(RULES)}",
    "keyed": f"SELECT r.*, coalesce(denied, false) AS is_denied, CASE WHEN NOT coalesce(denied, false) THEN {template_value('content')} END AS value FROM rewritten r LEFT JOIN page_content p ON r.title = p.title",
    "joined": f"SELECT k.*, m.upstream_page_id AS manual_id, u.id AS existing_id, k0.uid AS h0, k1.uid AS h1, k2.uid AS h2 FROM keyed k LEFT JOIN manual_matches m ON k.id = m.local_page_id LEFT JOIN upstream u ON u.id = m.upstream_page_id AND u.id > 0 LEFT JOIN upstream_keys k0 ON k0.key = t0 LEFT JOIN upstream_keys k1 ON applied <> '' AND k1.key = {hygiene('rewritten')} LEFT JOIN upstream_keys k2 ON k2.key = {hygiene('value')}",
    "staged": "SELECT *, CASE WHEN title = '' THEN 'empty' WHEN manual_id IS NOT NULL AND existing_id IS NULL THEN 'manual_unresolved' WHEN manual_id IS NOT NULL THEN 'manual' WHEN h0 IS NOT NULL AND t0 = title THEN 'exact' WHEN h0 IS NOT NULL THEN 'hygiene' WHEN h1 IS NOT NULL THEN 'semantic' WHEN is_denied THEN 'denied' WHEN h2 IS NOT NULL THEN 'template' ELSE 'unmatched' END AS stage FROM joined",
    "matched": f"""SELECT id, title,
      CASE WHEN stage = 'template' AND status NOT IN {_in(L.NOT_IMPORTED)} THEN '{L.STATUS_DOCUMENTED}' ELSE status END AS status, last_update_month,
      CASE stage WHEN 'manual' THEN manual_id WHEN 'exact' THEN h0 WHEN 'hygiene' THEN h0 WHEN 'semantic' THEN h1 WHEN 'template' THEN h2 ELSE upstream_id END AS upstream_id,
      CASE WHEN stage NOT IN ('manual', 'exact', 'hygiene', 'semantic', 'template') THEN match_type WHEN status IN {_in(L.NOT_IMPORTED)} THEN '{L.MATCH_UNRELATED}' ELSE '{L.MATCH_IMPORTED}' END AS match_type,
      CASE WHEN stage IN ('manual', 'exact', 'hygiene', 'semantic', 'template') THEN false WHEN stage = 'unmatched' AND status NOT IN {_in(L.MATCH_NOT_EXPECTED)} THEN true ELSE maybe_deleted_upstream END AS maybe_deleted_upstream,
      CASE WHEN stage IN ('manual', 'hygiene', 'semantic', 'template') THEN true WHEN stage = 'unmatched' THEN false ELSE normalization_match END AS normalization_match,
      CASE stage WHEN 'manual' THEN '{L.METHOD_MANUAL}' WHEN 'hygiene' THEN '{L.METHOD_HYGIENE}' WHEN 'semantic' THEN applied WHEN 'template' THEN '{L.METHOD_TEMPLATE}' WHEN 'unmatched' THEN NULL ELSE normalization_method END AS normalization_method,
      CASE stage WHEN 'hygiene' THEN t0 WHEN 'semantic' THEN rewritten WHEN 'template' THEN value WHEN 'manual' THEN NULL WHEN 'unmatched' THEN NULL ELSE title_normalized END AS title_normalized,
      needs_attention, is_dictionary_entry, source_type, stage FROM staged""",
    "missing": "SELECT id, title, checked_at FROM upstream WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.upstream_id = upstream.id) AND NOT EXISTS (SELECT 1 FROM blocked_titles b WHERE b.title = upstream.title)",
    "routes": "SELECT m.id AS upstream_id, m.title, CASE WHEN i.title IS NULL THEN 'not_returned' WHEN coalesce(i.allevel, 'none') = 'none' THEN 'open' WHEN i.allevel = 'create' THEN 'create_locked' WHEN i.allevel = 'read' THEN 'read_locked' ELSE 'unknown' END AS route, i.page_id FROM missing m LEFT JOIN page_info i ON i.title = m.title WHERE m.id > 0",
    "new_blocked": f"SELECT title, upstream_id, '{L.REASON_CREATE_LOCK}' AS reason FROM routes WHERE route = 'create_locked'",
    "new_manual": f"SELECT page_id AS local_page_id, upstream_id AS upstream_page_id, '{L.REASON_READ_LOCK}' AS reason FROM routes WHERE route = 'read_locked'",
}

CTES |= {
    "paged": "SELECT list, coalesce('t' || asked, '^') AS tok, 't' || json_extract_string(body, '$.continue.apcontinue') AS next, pos, coalesce(json_array_length(body, '$.query.allpages'), 0) AS n, body FROM paged_answers",
    "nodes": "SELECT * FROM paged QUALIFY pos = max(pos) OVER (PARTITION BY list, tok)",
    "chain": """SELECT list, tok, min(rank) AS rank, arg_min(before, rank) AS before FROM (
      WITH RECURSIVE walk AS (
        SELECT list, tok, next, 0 AS rank, 0 AS before, n FROM nodes WHERE tok = '^'
        UNION ALL SELECT w.list, m.tok, m.next, w.rank + 1, w.before + w.n, m.n FROM walk w JOIN nodes m ON m.list = w.list AND m.tok = w.next WHERE w.rank < (SELECT max(c) FROM (SELECT count(*) AS c FROM nodes GROUP BY list)))
      SELECT * FROM walk) GROUP BY list, tok""",
    "listed": "SELECT nodes.*, rank, before FROM nodes JOIN chain USING (list, tok)",
}

#: Runs until nothing is new, unrolled: more rounds than these find nothing.
_ROUNDS = 9
CTES |= {"one_info": "SELECT * FROM chained_info QUALIFY row_number() OVER (PARTITION BY title ORDER BY allevel DESC, page_id DESC) = 1", "hits": "SELECT id, title, upstream_id, h0, h1, h2, is_denied FROM joined", "manual_r0": "SELECT local_page_id, upstream_page_id FROM manual_matches", "blocked_r0": "SELECT title FROM blocked_titles"}
for _k in range(_ROUNDS):
    CTES |= {
        f"refs_r{_k}": f"SELECT CASE WHEN hits.title = '' OR (m.upstream_page_id IS NOT NULL AND u.id IS NULL) THEN hits.upstream_id ELSE coalesce(m.upstream_page_id, h0, h1, CASE WHEN NOT is_denied THEN h2 END, hits.upstream_id) END AS ref FROM hits LEFT JOIN manual_r{_k} m ON m.local_page_id = hits.id LEFT JOIN upstream u ON u.id = m.upstream_page_id AND u.id > 0",
        f"missing_r{_k}": f"SELECT id, title FROM upstream WHERE id NOT IN (SELECT ref FROM refs_r{_k} WHERE ref IS NOT NULL) AND title NOT IN (SELECT title FROM blocked_r{_k})",
        f"shut_r{_k}": f"SELECT DISTINCT m.title FROM missing_r{_k} m JOIN one_info i USING (title) WHERE m.id > 0 AND allevel = 'create'",
        f"taken_r{_k}": f"SELECT * FROM (SELECT page_id AS local_page_id, min(m.id) AS upstream_page_id FROM missing_r{_k} m JOIN one_info i USING (title) WHERE m.id > 0 AND allevel = 'read' GROUP BY page_id) t WHERE (local_page_id, upstream_page_id) NOT IN (SELECT (local_page_id, upstream_page_id) FROM manual_r{_k})",
        f"blocked_r{_k + 1}": f"SELECT title FROM blocked_r{_k} UNION ALL SELECT title FROM shut_r{_k}",
        f"manual_r{_k + 1}": f"SELECT * FROM taken_r{_k} UNION ALL SELECT * FROM manual_r{_k} WHERE local_page_id NOT IN (SELECT local_page_id FROM taken_r{_k})",
    }

#: The catalogs after the changes: the same relations over another upstream table.
_CHANGED = ("upstream", "upstream_keys", "joined", "staged", "matched", "missing")
CTES["stood"] = "SELECT id, title FROM upstream"
CTES["upstream_changes"] = RELATIONS["upstream_changes"]
CTES["upstream_d"] = "SELECT id, title FROM stood WHERE (id, title) NOT IN (SELECT (id, title) FROM upstream_changes WHERE change = -1) UNION ALL SELECT id, title FROM upstream_changes WHERE change = 1"
CTES |= {f"{name}_d": re.sub(rf"\b({'|'.join(_CHANGED)})\b", r"\1_d", CTES[name]).replace(", checked_at", "") for name in _CHANGED[1:]}


def over(select: str) -> str:
    """The select with the relations that it needs, in order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    # a relation may stand in the table before what it needs
    order: list[str] = []

    def place(name: str) -> None:
        for other in set(re.findall(r"\w+", CTES[name])) & needed - {name}:
            if other not in order:
                place(other)
        if name not in order:
            order.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    parts = [f"{name} AS ({CTES[name]})" for name in order]
    if parts and select.startswith("WITH "):
        return f"WITH {', '.join(parts)}, {select[5:]}"
    return f"WITH {', '.join(parts)} {select}" if parts else select


_MATCHED = "id, title, status, last_update_month, upstream_id, match_type, maybe_deleted_upstream, normalization_match, normalization_method, title_normalized, needs_attention, is_dictionary_entry, source_type, stage"
_SHOWN = "NOT needs_attention AND NOT is_dictionary_entry"

SELECTS: dict[str, str] = {
    "scan_keyset_topk": "SELECT id, title FROM upstream_log WHERE id > 100 ORDER BY id, title LIMIT 500",
    "scan_pages": "SELECT page, place, id, title, coalesce(max(id) FILTER (place = 499) OVER (ORDER BY page RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cursor FROM (SELECT id, title, (row_number() OVER (ORDER BY id) - 1) // 500 AS page, (row_number() OVER (ORDER BY id) - 1) % 500 AS place FROM upstream WHERE id > 0)",
    "scan_requests": "WITH p AS (SELECT (r - 1) // 500 AS page, count(*) AS n, max(id) AS last FROM (SELECT id, row_number() OVER (ORDER BY id) AS r FROM upstream WHERE id > 0) GROUP BY 1), q AS (SELECT 0 AS page, 0 AS cursor UNION ALL SELECT page + 1, last FROM p WHERE n = 500) SELECT q.page, q.cursor, coalesce(p.n, 0) AS n, p.last FROM q LEFT JOIN p USING (page)",
    "upsert_fold_upstream": "SELECT pos, id, title, checked_at FROM upstream",
    "reload_fresh": _fold("upstream_log"),
    "reload_resumed": _fold("(SELECT pos, id, title FROM stored_log UNION ALL SELECT pos, id, title FROM upstream_log)"),
    "checked_text": "SELECT id, strftime(checked_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS checked FROM upstream",
    "batch_dedupe_last_wins": "SELECT batch, title, arg_max(id, pos) AS id FROM upstream_log GROUP BY batch, title",
    "stale_collisions": "SELECT u.id, u.title, l.id AS new_id FROM upstream u JOIN later_log l ON u.title = l.title AND u.id <> l.id",
    "fk_release": "SELECT id, title, CASE WHEN upstream_id NOT IN (SELECT id FROM stale_ids) THEN upstream_id END AS upstream_id, match_type FROM local_pages",
    "upsert_preserving_match_cols": "SELECT c.id, c.title, c.status, e.upstream_id, coalesce(e.match_type, 'ללא התאמה') AS match_type FROM classified c LEFT JOIN earlier_matches e USING (id) UNION ALL SELECT e.id, 'gone' AS title, 'מיובא ללא תיעוד' AS status, e.upstream_id, e.match_type FROM earlier_matches e WHERE id NOT IN (SELECT id FROM classified)",
    "integrity_orphans": "SELECT upstream_id, id FROM local_pages WHERE upstream_id IS NOT NULL AND upstream_id NOT IN (SELECT id FROM upstream)",
    "integrity_domains": f"SELECT id, status, match_type FROM edited_rows WHERE status NOT IN {_in(L.STATUSES)} OR match_type NOT IN {_in(L.MATCH_TYPES)}",
    "integrity_duplicates": "SELECT title AS value, count(*) AS n FROM upstream_log GROUP BY title HAVING count(*) > 1",
    "category_sets": "SELECT category, count(DISTINCT title) AS n FROM pages_of GROUP BY category",
    "category_union": f"SELECT DISTINCT title FROM pages_of WHERE category IN {_in(tuple(_ROLE))}",
    "month_map": "SELECT title, month FROM months",
    "month_walk": f"SELECT title, arg_max(month, place) AS month FROM (SELECT p.title, s.ordinal AS place, {_MONTH_OF} AS month FROM (SELECT title AS category, ordinal FROM category_tree WHERE category = 'dated' AND member_type = 'subcat') s JOIN category_tree p USING (category) WHERE p.member_type = 'page' AND p.namespace = 0) WHERE month IS NOT NULL GROUP BY title",
    "category_members": "SELECT category, member_type, namespace, title, page_id FROM category_members WHERE category = 'created' AND member_type = 'subcat'",
    "classify_provenance": "SELECT id, title, status, source_type, last_update_month FROM classified",
    "page_flags": "SELECT id, needs_attention, is_dictionary_entry FROM classified",
    "hygiene_titles": f"SELECT id, title, {hygiene('title')} AS key FROM local_log",
    **{f"rule_{i + 1}": f"SELECT id, {rule('title')} AS title FROM local_log" for i, (_, rule) in enumerate(RULES)},
    "normalize_titles": "SELECT id, rewritten, applied FROM rewritten",
    "template_extract": f"SELECT title, {template_value('content')} AS value FROM page_content",
    "duration_format": "SELECT o_orderkey, CASE WHEN o_orderkey * 7 >= 3600 THEN printf('%02d:%02d:%02d', (o_orderkey * 7) // 3600, (o_orderkey * 7) % 3600 // 60, (o_orderkey * 7) % 60) ELSE printf('%02d:%02d', (o_orderkey * 7) // 60, (o_orderkey * 7) % 60) END AS text FROM orders",
    "json_listing": "SELECT pos AS batch, place, CAST(json_extract_string(body, '$.query.allpages[' || place || '].pageid') AS BIGINT) AS id, json_extract_string(body, '$.query.allpages[' || place || '].title') AS title FROM listing_answers, (VALUES (0), (1)) AS p(place) WHERE json_extract(body, '$.query.allpages[' || place || ']') IS NOT NULL",
    "stream_fold": "SELECT pos, id, title FROM upstream",
    "cursor_listing": "SELECT (r - 1) // 500 AS batch, CAST((r - 1) % 500 AS INT) AS place, id, title FROM (SELECT id, title, row_number() OVER (ORDER BY id) AS r FROM upstream WHERE id > 0)",
    "json_accepted": "SELECT pos FROM damaged_answers WHERE CASE WHEN json_valid(body) THEN coalesce(json_type(body, '$.query') = 'OBJECT', false) ELSE false END",
    "json_rejected": "SELECT pos, body, CASE WHEN coalesce(trim(body), '') = '' THEN 'empty' ELSE 'malformed' END AS reason FROM damaged_answers WHERE NOT CASE WHEN json_valid(body) THEN coalesce(json_type(body, '$.query') = 'OBJECT', false) ELSE false END",
    # what was denied and what wasn't, where the halves have come; a batch without its last halves leaves titles pending
    "batch_isolated": "SELECT a.title, CASE WHEN NOT decided.d THEN a.content END AS content, decided.d AND decided.size = 1 AS denied, decided.d AND decided.size > 1 AS pending FROM asked_titles a JOIN (SELECT batch, title, arg_min(denied, size) AS d, min(size) AS size FROM batch_pages GROUP BY batch, title) decided USING (batch, title)",
    "run_counters": "SELECT (SELECT count(*) FROM upstream) AS upstream_rows, (SELECT count(*) FROM local_pages) AS local_rows, (SELECT count(*) FROM matched WHERE maybe_deleted_upstream) AS maybe_deleted, "
    + ", ".join(f"(SELECT count(*) FROM matched WHERE stage = '{s}') AS stage_{s}" for s in STAGES)
    + ", (SELECT count(*) FROM months) AS dated_titles, (SELECT count(DISTINCT category) FROM dated_subcategories WHERE " + _MONTH_OF + " IS NOT NULL) AS valid_months, (SELECT count(*) FROM page_info WHERE coalesce(allevel, 'none') <> 'none') AS locked",
    "curated_rounds": "SELECT round, missing, new_blocked, new_manual FROM (SELECT *, coalesce(lag(new_blocked + new_manual) OVER (ORDER BY round), 1) AS before FROM ("
    + " UNION ALL ".join(f"SELECT {k + 1} AS round, (SELECT count(*) FROM missing_r{k}) AS missing, (SELECT count(*) FROM shut_r{k}) AS new_blocked, (SELECT count(*) FROM taken_r{k}) AS new_manual" for k in range(_ROUNDS))
    + ")) WHERE before > 0",
    "bucketed_upsert": "WITH n AS (SELECT max(i.page_id) AS local_page_id, max(u.id) AS upstream_page_id, u.title FROM upstream u JOIN page_info i USING (title) WHERE i.allevel = 'read' AND u.id > 0 GROUP BY u.title) SELECT n.local_page_id, n.upstream_page_id, '" + L.REASON_READ_LOCK + "' AS reason, coalesce(c.added_at, TIMESTAMP '2024-06-01 12:00:00') AS added_at FROM n LEFT JOIN curated_manual c USING (local_page_id) UNION ALL SELECT local_page_id, upstream_page_id, reason, added_at FROM curated_manual WHERE local_page_id NOT IN (SELECT local_page_id FROM n)",
    "delta_key_map": "SELECT key, uid AS upstream_id FROM upstream_keys_d",
    "delta_matched": f"SELECT {_MATCHED} FROM matched_d",
    "delta_missing": "SELECT id, title FROM missing_d",
    "delta_tasks": f"SELECT id, title, status, source_type, upstream_id, match_type, CASE WHEN maybe_deleted_upstream THEN '{L.TASK_DELETED}' ELSE '{L.TASK_STATUS}' END AS task_type FROM matched_d WHERE {_SHOWN} AND (maybe_deleted_upstream OR status = '{L.STATUS_UNDOCUMENTED}')",
    "listing_in_order": "SELECT list, CAST(before + place AS BIGINT) AS ordinal, CAST(json_extract_string(body, '$.query.allpages[' || place || '].pageid') AS BIGINT) AS id, json_extract_string(body, '$.query.allpages[' || place || '].title') AS title FROM listed, (VALUES (0), (1)) AS p(place) WHERE place < n",
    "listing_broken": """SELECT list, problem, CASE WHEN token <> '^' THEN substr(token, 2) END AS token FROM (
      SELECT list, 'gap' AS problem, next AS token FROM listed l WHERE next IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nodes n WHERE n.list = l.list AND n.tok = l.next)
      UNION ALL SELECT l.list, 'loop', l.next FROM listed l JOIN chain c ON c.list = l.list AND c.tok = l.next WHERE c.rank <= l.rank
      UNION ALL SELECT list, 'fork', tok FROM paged GROUP BY list, tok HAVING count(DISTINCT coalesce(next, '$')) > 1
      UNION ALL SELECT list, 'merge', next FROM nodes WHERE next IS NOT NULL GROUP BY list, next HAVING count(*) > 1
      UNION ALL SELECT list, 'stray', tok FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM chain c WHERE c.list = n.list AND c.tok = n.tok)
      UNION ALL SELECT list, 'headless', '^' FROM nodes GROUP BY list HAVING count(*) FILTER (tok = '^') = 0)""",
    "json_category": "SELECT category, pos, place, json_extract_string(body, '$.query.categorymembers[' || place || '].title') AS title, CAST(json_extract_string(body, '$.query.categorymembers[' || place || '].pageid') AS BIGINT) AS page_id FROM category_answers, (VALUES (0), (1)) AS p(place) WHERE json_extract(body, '$.query.categorymembers[' || place || ']') IS NOT NULL",
    "json_content": "SELECT title, CASE WHEN pos % 10 IN (3, 4) THEN NULL ELSE json_extract_string(body, '$.query.pages[0].revisions[0].slots.main.content') END AS content, pos % 10 = 3 AS denied FROM content_answers",
    "json_lock": "SELECT json_extract_string(p, '$.title') AS title, coalesce(json_extract_string(p, '$.allevel'), 'none') AS allevel, coalesce(CAST(json_extract_string(p, '$.missing') AS BOOLEAN), false) AS missing, CAST(json_extract_string(p, '$.pageid') AS BIGINT) AS page_id FROM (SELECT unnest(CAST(json_extract(body, '$.query.pages') AS JSON[])) AS p FROM lock_answers)",
    "upstream_key_map": "SELECT key, uid AS upstream_id FROM upstream_keys",
    "key_collisions": "SELECT CAST(sum(n) AS BIGINT) AS titles, count(*) AS keys, CAST(sum(n) - count(*) AS BIGINT) AS collisions FROM (SELECT count(*) AS n FROM upstream WHERE id > 0 AND title <> '' GROUP BY " + hygiene("title") + ")",
    "match_manual": f"SELECT {_MATCHED} FROM matched WHERE stage IN ('manual', 'manual_unresolved')",
    "match_exact": f"SELECT {_MATCHED} FROM matched WHERE stage IN ('exact', 'hygiene')",
    "match_semantic": f"SELECT {_MATCHED} FROM matched WHERE stage = 'semantic'",
    "match_template": f"SELECT {_MATCHED} FROM matched WHERE stage IN ('template', 'denied')",
    "match_unmatched": f"SELECT {_MATCHED} FROM matched WHERE stage = 'unmatched'",
    "match_type": f"SELECT id, CASE WHEN status IN {_in(L.NOT_IMPORTED)} THEN '{L.MATCH_UNRELATED}' ELSE '{L.MATCH_IMPORTED}' END AS match_type FROM classified",
    "match_cascade": f"SELECT {_MATCHED} FROM matched",
    "match_stage_counts": "SELECT stage, count(*) AS n FROM matched GROUP BY stage",
    "report_possibly_deleted": f"SELECT id, title, status, source_type, match_type FROM matched WHERE maybe_deleted_upstream AND {_SHOWN}",
    "report_undocumented": f"SELECT id, title, source_type, upstream_id, match_type FROM matched WHERE status = '{L.STATUS_UNDOCUMENTED}' AND {_SHOWN}",
    "report_tasks": f"SELECT id, title, status, source_type, upstream_id, match_type, CASE WHEN maybe_deleted_upstream THEN '{L.TASK_DELETED}' ELSE '{L.TASK_STATUS}' END AS task_type FROM matched WHERE {_SHOWN} AND (maybe_deleted_upstream OR status = '{L.STATUS_UNDOCUMENTED}')",
    "report_missing": "SELECT id, title, checked_at FROM missing",
    "lock_route": "SELECT upstream_id, title, route, page_id FROM routes",
    "lock_route_counts": "SELECT route, count(*) AS n FROM routes GROUP BY route",
    "lock_to_blocked": "SELECT title, upstream_id, reason, coalesce((SELECT max(added_at) FROM blocked_titles b WHERE b.title = n.title), TIMESTAMP '2024-06-01 12:00:00') AS added_at FROM new_blocked n UNION ALL SELECT title, upstream_id, reason, added_at FROM blocked_titles WHERE title NOT IN (SELECT title FROM new_blocked)",
    "lock_to_manual": "SELECT local_page_id, upstream_page_id, reason, coalesce((SELECT max(added_at) FROM curated_manual c WHERE c.local_page_id = n.local_page_id), TIMESTAMP '2024-06-01 12:00:00') AS added_at FROM new_manual n UNION ALL SELECT local_page_id, upstream_page_id, reason, added_at FROM curated_manual WHERE local_page_id NOT IN (SELECT local_page_id FROM new_manual)",
    "run_summary": "SELECT (SELECT count(*) FROM upstream) AS upstream_rows, (SELECT count(*) FROM local_pages) AS local_rows, (SELECT count(*) FROM months) AS dated_titles, (SELECT count(*) FROM page_info WHERE coalesce(allevel, 'none') <> 'none') AS locked, (SELECT count(*) FROM matched WHERE maybe_deleted_upstream) AS maybe_deleted",
}

ORACLE = {name: over(select) for name, select in SELECTS.items()}
