"""Secrets by a trigram inverted index, with DataFrame functions alone.

Each rule's pattern gives a Boolean query over trigrams: every match holds, for each of some segments, one of
some strings, and so the trigrams of that string (of which those that cover it are asked for: every third one, and the last). The index has a posting (document, trigram) for each trigram
of the queries that a lower-cased text holds. Postings of a document are intersected clause by clause; a rule whose segments
are all met has the document as a candidate. A rule without such trigrams scans every text. The pattern then runs over the
candidates alone and gives the spans.

The index holds the trigrams that the rules ask for, not all of a text. A document is known by its doc_id and the SHA-256 of its text,
so copies under other ids are other keys, and no key of a join is hot. Texts are shuffled once, for the candidates.

Defined cases: a null text is empty and has no spans. A null doc_id is a value of its own. Rows with the same doc_id and text each give
a row. An empty table gives none. Further columns aren't read. Positions count code points; spans of one kind never overlap.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, saved


@dataclass(frozen=True)
class Rule:
    """``least``: the fewest characters of group ``group`` (0: the match); a shorter match is dropped, and what it covers is not searched again."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed values. For classes that run on to their end, a count in the pattern gives the same matches as dropping the short ones.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Public formats of keys: PEM blocks, prefixed tokens of code hosts, chat, maps and payment services, signed web tokens, logins in URLs.
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@"),
)

#: A set of more strings than this is no longer spelt out.
MOST_STRINGS = 16

Strings = frozenset[str]
#: Of each segment (a list of clauses) one clause holds: all its trigrams occur.
Query = list[list[tuple[str, ...]]]


def _sequence(items) -> tuple[Strings | None, list[Strings]]:
    """All strings that a sequence can be, or None if they are too many; then also sets of which each match holds a string."""
    needed: list[Strings] = []
    run: Strings | None = frozenset([""])
    whole = True
    for op, arg in items:
        exact, inner = _item(op, arg)
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = frozenset(a + b for a, b in product(run, exact))
            continue
        whole = False
        needed += [run, *inner]
        run = exact if exact is not None else frozenset([""])
    return (run, []) if whole else (None, [*needed, run])


def _useful(sets: list[Strings]) -> list[Strings]:
    return [s for s in sets if min(map(len, s)) >= 3]


def _item(op, arg) -> tuple[Strings | None, list[Strings]]:
    if op is C.LITERAL:
        return frozenset([chr(arg).lower()]), []
    if op is C.AT:
        return frozenset([""]), []
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.IN:
        chars = list(_members(arg))
        return (frozenset(c.lower() for c in chars), []) if chars else (None, [])
    if op is C.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        together = frozenset().union(*(exact or () for exact, _ in parts))
        if all(exact is not None for exact, _ in parts) and len(together) <= MOST_STRINGS:
            return together, []
        choices = [_useful([exact] if exact is not None else needed) for exact, needed in parts]
        if not all(choices):
            return None, []
        # one set for each way through the branch
        return None, [frozenset().union(*(max(c, key=lambda s: min(map(len, s))) for c in choices))]
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = arg
        exact, needed = _sequence(inner)
        if (least, most) == (1, 1):
            return exact, needed
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, []
        if least == 0:
            return None, []
        if exact is not None and least == most and len(exact) ** least <= MOST_STRINGS:
            return frozenset("".join(p) for p in product(exact, repeat=least)), []
        return None, [exact] if exact is not None else needed
    return None, []


def _members(items) -> Iterator[str]:
    """The characters of a class; none if it is negated or large."""
    chars: list[str] = []
    for op, arg in items:
        if op is C.LITERAL:
            chars.append(chr(arg))
        elif op is C.RANGE and arg[1] - arg[0] < MOST_STRINGS:
            chars += map(chr, range(arg[0], arg[1] + 1))
        else:
            return iter(())
    return iter(chars if len(chars) <= MOST_STRINGS else ())


def trigram_query(pattern: str) -> Query:
    """What each text with a match holds, in lower case; empty if the pattern has no mandatory trigrams."""
    exact, needed = _sequence(_parser.parse(pattern))
    segments = _useful([exact] if exact is not None else needed)
    return [[tuple(sorted({s[i : i + 3] for i in (*range(0, len(s) - 2, 3), len(s) - 3)})) for s in sorted(segment)] for segment in segments]


def _key() -> Column:
    """A document's key: its doc_id and the digest of its text."""
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2(F.coalesce("text", F.lit("")), 256))


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text")).select(_key().alias("key"), *columns)


def _clauses(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(gram, bit, rule, segment, clause, all_bits, all_segments): a row for each trigram of each clause."""
    rows = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        for s, segment in enumerate(query):
            for c, grams in enumerate(segment):
                rows += [(g, 1 << i, rule.name, s, c, (1 << len(grams)) - 1, (1 << len(query)) - 1) for i, g in enumerate(grams[:62])]
    if not rows:
        return None
    names = ("gram", "bit", "rule", "segment", "clause", "all_bits", "all_segments")
    return _table(docs, [dict(zip(names, r, strict=True)) for r in rows], "gram string, bit long, rule string, segment int, clause int, all_bits long, all_segments long")


def _table(docs: DataFrame, rows: list[dict], schema: str) -> DataFrame:
    """A small table of constants."""
    return docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The index: (key, gram, rule), a row for each trigram of the rules' queries that a text holds (rule null), and one for each
    rule without mandatory trigrams that matches the text (gram null)."""
    queries = {r: trigram_query(r.pattern) for r in rules}
    vocabulary = sorted({g for q in queries.values() for segment in q for clause in segment for g in clause})
    held = F.array().cast("array<string>")
    if vocabulary:
        grams = F.array(*map(F.lit, vocabulary))
        # lower-cased inside an array, so that it is done once for a text
        held = F.get(F.transform(F.array(F.lower("text")), lambda low: F.filter(grams, lambda g: F.contains(low, g))), F.lit(0))
    entries = F.transform(held, lambda g: F.struct(g.alias("gram"), F.lit(None).cast("string").alias("rule")))
    scanned = [F.when(F.col("text").rlike(r.pattern), F.struct(F.lit(None).cast("string").alias("gram"), F.lit(r.name).alias("rule"))) for r in rules if not queries[r]]
    if scanned:
        entries = F.concat(entries, F.array_compact(F.array(*scanned)))
    # an outer generator: for the other kind Spark would add a filter that works the entries out once more
    return _keyed(docs, entries.alias("e")).select("key", F.inline_outer("e")).filter("gram is not null or rule is not null")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rule): the documents that meet a rule's query, from the postings alone, and those that a scanning rule has matched.

    The table of clauses is broadcast: it has a row for each trigram of the rules, whatever the documents are."""
    found = index.filter("rule is not null").select("key", "rule").distinct()
    clauses = _clauses(index, rules)
    if clauses is None:
        return found
    met = index.filter("gram is not null").select("key", "gram").join(F.broadcast(clauses), "gram")
    met = met.groupBy("key", "rule", "segment", "clause", "all_bits", "all_segments").agg(F.bit_or("bit").alias("bits")).filter("bits = all_bits")
    met = met.groupBy("key", "rule", "all_segments").agg(F.bit_or(F.expr("shiftleft(1L, segment)")).alias("segments")).filter("segments = all_segments")
    return met.select("key", "rule").unionByName(found)


def verified(docs: DataFrame, candidate: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rule, ord, start, end) of every span: the patterns run over the candidates.

    The parts between matches give the positions: their lengths and those of the matches before are added up by a window over one text."""
    table = [{"rule": r.name, "ord": i, "pattern": r.pattern, "part": r.group, "least": r.least} for i, r in enumerate(rules)]
    patterns = F.broadcast(_table(docs, table, "rule string, ord int, pattern string, part int, least int"))
    # a merge join whatever the size: a broadcast of the candidates would grow with the documents
    texts = _keyed(docs, "text").join(candidate.hint("merge"), "key").join(patterns, "rule")
    zipped = F.arrays_zip(F.split("text", F.col("pattern"), -1).alias("gap"), F.regexp_extract_all("text", F.col("pattern"), F.lit(0)).alias("match"))
    rows = texts.select("key", "rule", "ord", "pattern", "part", "least", F.posexplode(zipped).alias("i", "z")).filter("z.match is not null")
    rows = rows.select(
        "key", "rule", "ord", "i", F.char_length("z.gap").alias("gap"), F.char_length("z.match").alias("size"), F.expr("char_length(regexp_extract(z.match, pattern, part)) >= least").alias("long_enough")
    )
    # rows that repeat give the same spans
    rows = rows.groupBy("key", "rule", "ord", "i").agg(F.max("gap").alias("gap"), F.max("size").alias("size"), F.max("long_enough").alias("long_enough"))
    before = F.sum(F.col("gap").cast("long") + F.col("size")).over(Window.partitionBy("key", "rule", "ord").orderBy("i"))
    return rows.withColumn("end", before).filter("long_enough").select("key", "rule", "ord", (F.col("end") - F.col("size")).alias("start"), "end")


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Each document's counts of the base rules, the digest of their spans, and all spans as ``kind:start:end`` by start, then in the rules' order."""
    index = saved(postings(docs, rules), "secret-postings")
    candidate = saved(candidates(index, rules), "secret-candidates")
    dropped(index)
    spans = verified(docs, candidate, rules)
    listed = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "ord", "end", "rule"))).alias("s"))

    def joined(of: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(of, lambda x: F.concat_ws(":", x["rule"], x["start"], x["end"])), ","), F.lit(""))

    rows = _keyed(docs, "doc_id").join(listed.hint("merge"), "key", "left")
    def among(*names: str) -> Column:
        return F.filter("s", lambda x: x["rule"].isin(*names))

    based = among(*[r.name for r in base])
    counts = [F.size(among(r.name)).cast("long").alias(f"n_{r.name}") for r in base]
    return rows.withColumn("s", F.coalesce("s", F.array().cast(rows.schema["s"].dataType))).select("doc_id", *counts, F.sha2(joined(based), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))
