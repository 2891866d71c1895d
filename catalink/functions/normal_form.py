"""Unicode normal form C as column expressions: decomposition, canonical order and composition over arrays of characters.

The tables are made from the standard library's Unicode data, once for a process. A text is split into characters; each gives its full
canonical decomposition by translations, one for each place in it. Between starters, marks are sorted by their
combining class, stably. Then an aggregate walks along: it keeps the last starter, the marks after it that it hasn't taken in,
and the class of the last of them, which blocks marks of the same class or a lower one. Syllables of jamo are composed by arithmetic.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where composed syllables and the three kinds of jamo begin, and how many there are of each.
SYLLABLES, LEADS, VOWELS, TAILS = 0xAC00, 0x1100, 0x1161, 0x11A7
N_LEADS, N_VOWELS, N_TAILS = 19, 21, 28
#: Combining classes are written as characters from here on, to be made by a translation.
CLASSES = 0xE000


def _is_syllable(c: str) -> bool:
    return 0 <= ord(c) - SYLLABLES < N_LEADS * N_VOWELS * N_TAILS


@functools.cache
def _tables() -> tuple[list[str], list[str], str, str, dict[str, tuple[str, str]]]:
    """Decomposed characters, their decompositions (longest first), marks, their classes, and for each second character the first ones and what they give."""
    whole: dict[str, str] = {}
    marks: list[str] = []
    pairs: dict[str, list[tuple[str, str]]] = {}
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if 0xD800 <= point < 0xE000 or _is_syllable(c):
            continue
        if unicodedata.combining(c):
            marks.append(c)
        apart = unicodedata.normalize("NFD", c)
        if apart == c:
            continue
        whole[c] = apart
        if unicodedata.normalize("NFC", c) == c:
            first, second = (chr(int(x, 16)) for x in unicodedata.decomposition(c).split())
            pairs.setdefault(second, []).append((first, c))
    order = sorted(whole, key=lambda c: (-len(whole[c]), c))
    second = {s: ("".join(a for a, _ in p), "".join(c for _, c in p)) for s, p in sorted(pairs.items())}
    return order, [whole[c] for c in order], "".join(marks), "".join(chr(CLASSES + unicodedata.combining(c)) for c in marks), second


def _point(c: Column) -> Column:
    return F.ascii(c)


def _char(point: Column) -> Column:
    """The character of a code point of four hex digits."""
    return F.decode(F.unhex(F.hex(point.cast("long"))), "UTF-16BE")


def _decomposed(c: Column) -> Column:
    order, apart, _, _, _ = _tables()
    # characters with a shorter decomposition have nothing at a later place: a translation without a counterpart deletes
    places = [F.translate(c, "".join(order), "".join(d[i] for d in apart if len(d) > i)) for i in range(max(map(len, apart)))]
    return F.when(places[0] == c, c).otherwise(F.concat(*places))


def _class_of(c: Column) -> Column:
    _, _, marks, classes, _ = _tables()
    code = F.translate(c, marks, classes)
    return F.when(code == c, 0).otherwise(_point(code) - CLASSES)


def _composed(first: Column, second: Column) -> Column:
    """The composite of two characters, or null."""
    seconds = _tables()[4]
    table = F.create_map(*[x for s, (firsts, both) in seconds.items() for x in (F.lit(s), F.struct(F.lit(firsts).alias("firsts"), F.lit(both).alias("both")))])
    entry = F.element_at(table, second)
    at = F.when(first != "", F.instr(entry["firsts"], first))
    a, b = _point(first), _point(second)
    lead, vowel, tail, syllable = a - LEADS, b - VOWELS, b - TAILS, a - SYLLABLES
    return (
        F.when(at > 0, F.substring(entry["both"], at, F.lit(1)))
        .when(lead.between(0, N_LEADS - 1) & vowel.between(0, N_VOWELS - 1), _char(F.lit(SYLLABLES) + (lead * N_VOWELS + vowel) * N_TAILS))
        .when(syllable.between(0, N_LEADS * N_VOWELS * N_TAILS - 1) & (syllable % N_TAILS == 0) & tail.between(1, N_TAILS - 1), _char(a + tail))
    )


def composed(text: Column) -> Column:
    """``text`` in normal form C. Null stays null."""
    apart = F.filter(F.split(F.array_join(F.transform(F.split(text, ""), _decomposed), ""), ""), lambda c: c != "")
    classed = F.transform(apart, lambda c, i: F.struct(_class_of(c).alias("k"), i.alias("i"), c.alias("c")))
    # the number of starters up to each character groups a starter with its marks
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<g: int, k: int, i: int, c: string>>").alias("out"))

    def grouped(acc: Column, x: Column) -> Column:
        n = acc["n"] + F.when(x["k"] == 0, 1).otherwise(0)
        return F.struct(n.alias("n"), F.concat(acc["out"], F.array(F.struct(n.alias("g"), x["k"].alias("k"), x["i"].alias("i"), x["c"].alias("c")))).alias("out"))

    ordered = F.array_sort(F.aggregate(classed, start, grouped)["out"])
    empty = F.struct(F.lit("").alias("done"), F.lit("").alias("starter"), F.lit("").alias("marks"), F.lit(0).alias("k"))

    def walked(acc: Column, x: Column) -> Column:
        clear = (acc["marks"] == "") | ((x["k"] > 0) & (acc["k"] < x["k"]))
        both = F.when(clear & (acc["starter"] != ""), _composed(acc["starter"], x["c"]))
        flushed = F.concat(acc["done"], acc["starter"], acc["marks"])
        taken = F.struct(acc["done"].alias("done"), both.alias("starter"), acc["marks"].alias("marks"), acc["k"].alias("k"))
        begun = F.struct(flushed.alias("done"), x["c"].alias("starter"), F.lit("").alias("marks"), F.lit(0).alias("k"))
        added = F.struct(acc["done"].alias("done"), acc["starter"].alias("starter"), F.concat(acc["marks"], x["c"]).alias("marks"), x["k"].alias("k"))
        return F.when(both.isNotNull(), taken).when(x["k"] == 0, begun).otherwise(added)

    return F.aggregate(ordered, empty, walked, lambda acc: F.concat(acc["done"], acc["starter"], acc["marks"]))
