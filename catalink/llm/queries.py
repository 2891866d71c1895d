"""The registered queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .conversation_trie import conversation_trie
from .exact_dedup import exact_dedup
from .license_index import scan_licenses
from .near_dedup import near_groups
from .pivot_phrases import collocations
from .quality import quality_scores
from .secret_index import RULES as SECRET_RULES
from .secret_index import scan_secrets
from .site_style import extract_pages
from .template_leaks import leaked_items
from .temperature_mix import mixed
from .token_records import token_records
from .toxicity import toxicity_scores
from .url_rules import judge_urls

#: The rules of the URL query.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_records(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")), end_id=2, special_as_text=False)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), repetition_limit=1.5).select("doc_id", "source", "mix_epoch", "mix_block", "mix_order", "mix_tokens")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), percent=85)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op12_pivot_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_quality": op2_quality,
        "op3_token_records": op3_token_records,
        "op4_url_rules": op4_url_rules,
        "op5_template_leaks": op5_template_leaks,
        "op6_site_style": op6_site_style,
        "op7_temperature_mix": op7_temperature_mix,
        "op8_near_dedup": op8_near_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_license_index": op10_license_index,
        "op11_secret_index": op11_secret_index,
        "op12_pivot_phrases": op12_pivot_phrases,
        "op13_conversation_trie": op13_conversation_trie,
    }


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP4_SQL = f"""
WITH parsed AS (
  SELECT row_number() OVER () AS rid, page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rh, rp) AS (VALUES {", ".join(f"('{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in URL_RULES)}),
best AS (
  SELECT rid, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM parsed JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN best USING (rid)
"""

OP9_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    replace(replace(replace(replace(replace(replace(coalesce(text, ''), chr(32), ''), chr(9), ''), chr(10), ''), chr(11), ''), chr(12), ''), chr(13), '') AS content
  FROM documents),
w AS (
  SELECT doc_id, content, count(*) OVER (PARTITION BY content) AS group_size,
    first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM w
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(f"SELECT rid, {i} AS ord, '{r.name}' AS rule, regexp_split_to_array(t, {_quoted(r.pattern)}) AS gaps, regexp_extract_all(t, {_quoted(r.pattern)}) AS hits, regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) AS parts, {r.least} AS least FROM d WHERE regexp_matches(t, {_quoted(r.pattern)})" for i, r in enumerate(SECRET_RULES))}),
each AS (SELECT *, unnest(range(len(hits))) AS i FROM found),
spans AS (
  SELECT rid, ord, rule, list_sum(list_transform(gaps[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i], lambda x: length(x))), 0) AS s, length(hits[i + 1]) AS size
  FROM each WHERE length(parts[i + 1]) >= least),
texts AS (
  SELECT rid, count(*) FILTER (rule = 'assign') AS n_assign, count(*) FILTER (rule = 'access') AS n_access, count(*) FILTER (rule = 'hex') AS n_hex,
    string_agg(concat(rule, ':', CAST(s AS BIGINT), ':', CAST(s + size AS BIGINT)), ',' ORDER BY s, ord) FILTER (ord < 3) AS base,
    string_agg(concat(rule, ':', CAST(s AS BIGINT), ':', CAST(s + size AS BIGINT)), ',' ORDER BY s, ord) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN texts USING (rid)
"""


OP12_SQL = f"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
words AS (SELECT p, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (SELECT p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)),
w1 AS (SELECT p, lang, i, [word] AS g1, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d, lead(word, 4) OVER o AS e FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
grams AS (
  SELECT lang, g1 AS g FROM w1 UNION ALL SELECT lang, g1 || [b] FROM w1 WHERE b IS NOT NULL UNION ALL SELECT lang, g1 || [b, c] FROM w1 WHERE c IS NOT NULL
  UNION ALL SELECT lang, g1 || [b, c, d] FROM w1 WHERE d IS NOT NULL UNION ALL SELECT lang, g1 || [b, c, d, e] FROM w1 WHERE e IS NOT NULL),
f AS (SELECT lang, g, len(g) AS m, count(*) AS a FROM grams GROUP BY lang, g HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
cuts AS (
  SELECT f.lang, f.g, f.a, n, k, l.a AS l, r.a AS r, CAST(CAST(1000 AS HUGEINT) * f.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM f JOIN (VALUES (1), (2), (3), (4)) AS ks(k) ON k < f.m JOIN f l ON l.lang = f.lang AND l.g = f.g[1:k] JOIN f r ON r.lang = f.lang AND r.g = f.g[k + 1:] JOIN totals ON totals.lang = f.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT DISTINCT f.lang, f.g[s:s + size - 1] AS g, f.a FROM f, (VALUES (2), (3), (4)) AS sizes(size), (VALUES (1), (2), (3), (4)) AS starts(s) WHERE size < f.m AND s + size - 1 <= f.m),
left_over AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_parts i WHERE i.lang = b.lang AND i.g = b.g AND 100 * i.a >= 100 * b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM left_over QUALIFY rank <= 2000
"""


def _crc_entry(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


_CRC32 = f"xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, x: xor(a >> 8, {[_crc_entry(i) for i in range(256)]}[(xor(a, x) & 255) + 1]), 4294967295), 4294967295)"

OP13_SQL = f"""
WITH o AS (
  SELECT conv_id, coalesce(text, '') AS text, d, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS pos
  FROM (SELECT *, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, count(*) AS n, {_CRC32} % 9 AS h, conv_id - conv_id % 5 AS base FROM o GROUP BY conv_id),
r AS (
  SELECT c.conv_id, pos + 1 AS depth, d, text FROM c JOIN o ON o.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + pos - c.h + 1, d, text FROM c JOIN o ON o.conv_id = c.conv_id AND pos >= c.h LEFT JOIN c b ON b.conv_id = c.base
  UNION ALL SELECT conv_id, 0, '', '' FROM c),
k AS (
  SELECT conv_id, depth, strlen(text) AS bytes, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM r),
nodes AS (SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(bytes) AS bytes, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (last) AS ends FROM k GROUP BY key),
kids AS (SELECT substr(key, 1, (depth - 1) * 64) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
totals AS (
  SELECT up.key, count(*) FILTER (kids.key IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM nodes n LEFT JOIN kids USING (key) JOIN k up ON up.conv_id = n.conv_id AND up.depth <= n.depth GROUP BY up.key)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN totals ON totals.key = n.key LEFT JOIN kids ON kids.key = n.key LEFT JOIN nodes p ON n.depth > 0 AND p.key = substr(n.key, 1, (n.depth - 1) * 64)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_url_rules": OP4_SQL, "op9_exact_dedup": OP9_SQL, "op11_secret_index": OP11_SQL, "op12_pivot_phrases": OP12_SQL, "op13_conversation_trie": OP13_SQL}
