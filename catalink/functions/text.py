"""Title functions as column expressions: hygiene, rewrite rules, template values, months, durations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import MONTHS
from .normal_form import composed

# White space, direction marks, quotes and dashes that hygiene treats.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
MARKS = "\u200e\u200f\u061c\u202a\u202b\u202c\u202d\u202e"
QUOTES_FROM, QUOTES_TO = "\u05f4\u05f3\u201c\u201d\u2018\u2019", "\"'\"\"''"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u05be"
NBSP = "\u00a0"
TRANSLATE_FROM, TRANSLATE_TO = QUOTES_FROM + DASHES + NBSP, QUOTES_TO + "-" * len(DASHES) + " "

#: Strings of these characters alone are in normal form already.
_STABLE = r"^[\x{0}-\x{2ff}\x{5be}\x{5d0}-\x{5ea}\x{5f3}\x{5f4}\x{200e}-\x{201f}\x{202a}-\x{202e}]*$"


#: Strings of these characters alone, with single spaces inside, are what hygiene makes of them.
_PLAIN = r"\A[\x20-\x7e\x{5d0}-\x{5ea}]*+\z"


def nfc(title: Column) -> Column:
    """Unicode normal form C. A title that can't change isn't taken apart."""
    return F.when(title.rlike(_STABLE), title).otherwise(composed(title))


def collapsed(text: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def hygiene(title: Column) -> Column:
    """Normal form, marks deleted, quotes and dashes folded, white space collapsed, in this order. Null stays null. A title that can't change is only looked at."""
    plain = title.rlike(_PLAIN) & ~title.contains("  ") & ~title.startswith(" ") & ~title.endswith(" ")
    return F.when(plain, title).otherwise(collapsed(F.translate(nfc(title), TRANSLATE_FROM + MARKS, TRANSLATE_TO)))


def _where(title: Column, any_of: tuple[str, ...], new: Column) -> Column:
    """``new`` for titles with one of the strings, without which the patterns of a rule can't match; a search costs a tenth of a pattern."""
    found = title.contains(any_of[0])
    for text in any_of[1:]:
        found = found | title.contains(text)
    return F.when(found, new).otherwise(title)


def _final_letters(title: Column) -> Column:
    # a Hebrew year ends with the final form of its last letter
    new = title
    for letter, final in zip("כמנפצ", "ךםןףץ", strict=True):
        new = F.regexp_replace(new, f"([א-ה]'[א-ת]+\"){letter}(?![א-ת])", f"$1{final}")
    return _where(title, tuple(f'"{letter}' for letter in "כמנפצ"), new)


def _spelling_of_god(title: Column) -> Column:
    new, stems = title, ("אלוק", "אלק")
    for stem in stems:
        new = F.regexp_replace(new, rf"(?<![א-ת]){stem}(ים|י|ינו|יכם|יכן|יו|יה)?(?![א-ת])", "אלוה$1")
    return _where(title, stems, new)


def _literal(*pairs: tuple[str, str]) -> Callable[[Column], Column]:
    def apply(title: Column) -> Column:
        for old, new in pairs:
            title = F.replace(title, F.lit(old), F.lit(new))
        return title

    return apply


def _pattern(pattern: str, new: str, literal: str) -> Callable[[Column], Column]:
    """A rule by a pattern, every match of which holds ``literal``."""
    return lambda title: _where(title, (literal,), F.regexp_replace(title, pattern, new))


# The patterns, their replacements and the names of the rules, here and in the functions above and below.
#: Rewrite rules in the order in which they apply: (name, function). The order matters.
RULES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("מירכאות_קדוש", _pattern(r"""(["'])(קדוש(?:ה|ים)?)\1""", "$2", "קדוש")),
    ("אליל_לאל", _pattern(r"(?<![א-ת])אליל([א-ת]*)", "אל$1", "אליל")),
    ("כתיב_אלוהים", _spelling_of_god),
    ("מקף_שובר", _literal(("א-ל", "אל"), ("י-ה", "יה"))),
    ("אות_סופית_שנה", _final_letters),
    ("דמות_מקראית", _literal(('(אישיות מהתנ"ך)', '(דמות מקראית)'))),
    ("ישו", _literal(("אותו האיש", "ישו"))),
    ("מרכז_לבית_כנסת", _pattern(r"מרכז ה(נאולוגי|רפורמי|קראי|קונסרבטיבי)", "בית הכנסת ה$1", "מרכז ה")),
    ("קרבן_לקורבן", _pattern(r"(?<![א-ת])קרבן", "קורבן", "קרבן")),
)


def with_rewritten(df: DataFrame, title: str, text: str, applied: str, key: str | None = None) -> DataFrame:
    """Adds the title after hygiene and all rules, and the names of the rules that changed it, joined by ``+``; also the title after hygiene alone, if ``key`` names it.

    One projection for each rule, so that no rule is evaluated twice."""
    df = df.withColumn("_t0", hygiene(F.col(title)))
    for i, (_, rule) in enumerate(RULES):
        df = df.withColumn(f"_t{i + 1}", rule(F.col(f"_t{i}")))
    changed = [F.when(F.col(f"_t{i + 1}") != F.col(f"_t{i}"), F.lit(name)) for i, (name, _) in enumerate(RULES)]
    df = df.withColumn(text, F.col(f"_t{len(RULES)}")).withColumn(applied, F.concat_ws("+", *changed))
    df = df if key is None else df.withColumn(key, F.col("_t0"))
    return df.drop(*[f"_t{i}" for i in range(len(RULES) + 1)])


def template_raw(content: Column) -> Column:
    """The page named by the first provenance template of a page; empty if none."""
    return F.regexp_extract(content, rf"\{{\{{{WS}*מיון{WS}+ויקיפדיה{WS}*\|{WS}*דף{WS}*={WS}*([^|}}\n]+)", 1)


def template_value(content: Column) -> Column:
    """The cleaned page name: link brackets and underscores gone, white space collapsed. Null if none is left."""
    bare = F.regexp_replace(template_raw(content), rf"^{WS}+|{WS}+$", "")
    clean = collapsed(F.replace(F.regexp_replace(bare, r"^\[\[(.+)\]\]$", "$1"), F.lit("_"), F.lit(" ")))
    return F.nullif(clean, F.lit(""))


def month_of(category: Column) -> Column:
    """``YYYY-MM`` of a dated category name; null without a known month."""
    pattern = rf"ב([א-ת]+){WS}+(\p{{Nd}}{{4}})"
    name, year = F.regexp_extract(category, pattern, 1), F.regexp_extract(category, pattern, 2)
    number = F.element_at(F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, f"{i + 1:02d}")]), name)
    return F.concat(year, F.lit("-"), number)


def duration(seconds: Column) -> Column:
    """``HH:MM:SS``, or ``MM:SS`` below an hour."""
    s = seconds.cast("bigint")
    hours, minutes, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(hours > 0, F.format_string("%02d:%02d:%02d", hours, minutes, rest)).otherwise(F.format_string("%02d:%02d", minutes, rest))


def lock_level(allevel: Column) -> Column:
    """open, create_locked, read_locked or unknown; a missing level is ``none``."""
    level = F.coalesce(allevel, F.lit("none"))
    return F.when(level == "none", "open").when(level == "create", "create_locked").when(level == "read", "read_locked").otherwise("unknown")


def iso_text(time: Column) -> Column:
    """A time as ISO text in UTC, with microseconds if there are any; the session's time zone has to be UTC."""
    fraction = F.when(F.date_format(time, "SSSSSS") != "000000", F.date_format(time, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))
