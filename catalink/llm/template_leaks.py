"""Benchmark decontamination by template canonicalisation. DataFrame functions only.

Texts and benchmark items become templates: numbers, names (capitalised words
inside a sentence) and units after numbers are replaced by typed placeholders,
letters are lower-cased, other signs dropped. A capitalised word that opens a sentence
or quotation is a name if the text has it as a name elsewhere. As
this may err, each text has up to three forms: with these names, with only those
inside sentences, and without names at all, in which capitals play no part.
A window of an item is met if a window of the document equals it in any form. Windows of ``WINDOW`` template
words are hashed and joined by equality. A document leaks an item if it holds at least
``LEAST_COVER`` of the item's windows, and these hold ``LEAST_WORDS`` distinct
words that are no slots, or the slots agree: under the windows that meet, one value of the item has
to stand for one value of the document and the other way round. So a question with
exchanged numbers or names is found, and chance meetings of templates full of slots are not.

The windows of the benchmark are broadcast while they number at most
``MOST_BROADCAST`` (24 bytes each), and joined by shuffle beyond that.

An item with fewer than ``WINDOW`` template words is one window of its own
length; with fewer than ``LEAST_WORDS`` it can't be told from chance and is
never reported. Neither can a window with fewer than ``LEAST_LITERALS`` words that are no slots: a run of numbers meets
every other run of numbers. Such windows are left out of an item on both sides of its coverage. An item that has no
other windows is looked up by its words as they are, values included.

Defined cases: null and empty texts leak nothing. In ``leaked_items`` rows with one doc_id count as one
document, and so do rows with a null doc_id; items that differ in the values of their slots alone are one family with one row for a document; ``without_leaks`` judges each text for itself. Repeated items of one item_id
count as one, a null item_id as one more. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

WINDOW = 8
LEAST_WORDS = 5
LEAST_LITERALS = 3
VERBATIM = 3
"""The number of the form without slots."""
LEAST_COVER = 0.5
MOST_CONFLICTS = 0.2
MOST_BROADCAST = 2_000_000

#: Units that a number may carry.
UNITS = (
    "km|m|cm|mm|mi|miles?|ft|feet|inch(?:es)?|yards?|kg|g|mg|lbs?|pounds?|ounces?|oz|tons?|tonnes?|l|ml|liters?|litres?|gallons?|"
    "s|ms|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|kmh|mph|percent|dollars?|euros?|cents?|usd|eur|degrees?|celsius|watts?|kw|kwh|volts?|gb|mb|kb|meters?|metres?|kilometers?|kilograms?|grams?"
)
# private characters that no text keeps: a mark for names, and the placeholders
_MARK, _NAME, _NUMBER, _UNIT, _MAYBE = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"


def slotted(text: Column) -> Column:
    """The text as words parted by white space, a slot as ``<placeholder>=<value>``; before a capitalised word
    that may be a name, as it opens a sentence or quotation, stands a mark of its own (see ``resolved``).

    The patterns of numbers and units run only on texts that have a digit."""
    other = rf"[^\p{{L}}\p{{N}}\s{_MARK}{_MAYBE}]+"
    number, ends = r"\d[\d.,:/]*", r"(?![\p{L}\p{N}])"
    out = F.translate(F.coalesce(text, F.lit("")), f"{_MARK}{_NAME}{_NUMBER}{_UNIT}{_MAYBE}=", "")
    out = F.regexp_replace(out, r"(?=\p{Lu})(?<=[\p{Ll},;]\s{1,8})\p{Lu}\p{Ll}+", f"{_MARK}$0")
    out = F.regexp_replace(out, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}{_MARK}])\p{{Lu}}\p{{Ll}}+", f"{_MAYBE}$0")
    plain = F.regexp_replace(F.lower(out), other, "")
    digits = F.regexp_replace(F.lower(out), rf"(?<!\d){other}|{other}(?!\d)", "")
    named = lambda c: F.regexp_replace(c, rf"{_MARK}(\p{{L}}+)", f"{_NAME}=$1")
    digits = F.regexp_replace(named(digits), rf"(?<![\p{{L}}\p{{N}}=])({number})({UNITS}){ends}", f"{_NUMBER}=$1 {_UNIT}=$2")
    digits = F.regexp_replace(digits, rf"(?<![\p{{L}}\p{{N}}=])({number}){ends}", f"{_NUMBER}=$1")
    digits = F.regexp_replace(digits, rf"(?<={_NUMBER}=[\d.,:/]{{1,24}}\s)({UNITS}){ends}", f"{_UNIT}=$1")
    return F.when(text.rlike(r"\d"), digits).otherwise(named(plain))


def names_of(slots: Column) -> Column:
    """The names of a slotted text, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(slots, F.lit(rf"{_NAME}=(\p{{L}}+)"), 1))


def resolved(slots: Column, names: Column) -> Column:
    """The slotted text with words that may be names as slots if they are among ``names``, else as plain words."""
    pattern = F.concat(F.lit(f"{_MAYBE}("), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    known = F.when(slots.contains(_MAYBE) & (F.size(names) > 0), F.regexp_replace(slots, pattern, F.lit(f"{_NAME}=$1"))).otherwise(slots)
    return F.translate(known, _MAYBE, "")


def template(slots: Column) -> Column:
    """The slotted text without the values."""
    return F.regexp_replace(slots, f"([{_NAME}-{_UNIT}])=\\S*", "$1")


def words(text: Column) -> Column:
    """Its words; none of an empty text."""
    return F.array_remove(F.split(text, r"\s+"), "")


def forms_of(rows: DataFrame, key: str, forms: int = VERBATIM + 1) -> DataFrame:
    """(key, forms): the first ``forms`` forms of each text of ``rows`` (key, text); the last of all has values in place of slots.

    The forms have a word for each word of the others, so places are the same in all."""
    staged = rows.select(key, slotted(F.col("text")).alias("text"))
    staged = staged.select(key, "text", names_of(F.col("text")).alias("names"))
    inner = F.translate("text", _MAYBE, "")
    plain = F.replace(inner, F.lit(f"{_NAME}="), F.lit(""))
    verbatim = F.regexp_replace(inner, f"[{_NAME}-{_UNIT}]=", "")
    made = [template(resolved(F.col("text"), F.col("names"))), template(inner), template(plain), verbatim]
    return staged.select(key, F.array(*made[:forms]).alias("forms"))


def hashed(rows: DataFrame, *kept: str) -> DataFrame:
    """(kept, w): the hashes of the words of ``text``."""
    return rows.select(*kept, words(F.col("text")).alias("w")).select(*kept, F.transform("w", lambda w: F.xxhash64(w)).alias("w"))


def templates(rows: DataFrame, key: str, forms: int = VERBATIM) -> DataFrame:
    """(key, w): the hashes of the template words of each distinct one of the first ``forms`` forms of each text."""
    staged = forms_of(rows, key, forms)
    return hashed(staged.select(key, F.explode(F.array_distinct("forms")).alias("text")), key)


def with_runs(rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Adds ``runs_<size>``, the hashes of all runs of ``size`` word hashes of ``w``, in order; those at the end lack words.

    Runs double their length from step to step, and a last step adds what is left: a run is the pair of its
    first and last run of half the length. Each step is a projection of its own, so none is evaluated twice."""

    def joined(name: str, gap: int) -> Column:
        return F.transform(name, lambda x, i: F.xxhash64(F.lit(gap), x, F.get(F.col(name), i + gap)))

    rows, length = rows.withColumn("runs_1", F.col("w")), 1
    while 2 * length <= max(sizes):
        rows, length = rows.withColumn(f"runs_{2 * length}", joined(f"runs_{length}", length)), 2 * length
    for size in sizes:
        half = 1 << (size.bit_length() - 1)
        if half < size:
            rows = rows.withColumn(f"runs_{size}", joined(f"runs_{half}", size - half))
    return rows


def windows_before(sizes: Sequence[int], size: str, n: str) -> Column:
    """How many windows of other sizes stand before those of ``size`` in the list of a text of ``n`` words."""
    n, out, before = F.col(n), F.lit(0), F.lit(0)
    for s in sizes:
        out, before = F.when(F.col(size) == s, before).otherwise(out), before + F.greatest(n - (s - 1), F.lit(0))
    return out


def window_rows(rows: DataFrame, key: str, sizes: Sequence[int], *kept: str) -> DataFrame:
    """(key, kept, n, pos, hash): a row for each window of each text of ``templates()``, from one pass over the texts.
    ``n`` words; ``pos`` counts the windows of the first size, then those of the next."""
    rows = with_runs(rows, sizes)
    # an expression, not a column: else Spark derives a filter from it that evaluates all steps again
    hashes = F.concat(*[F.slice(f"runs_{size}", F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(0))) for size in sizes])
    return rows.select(key, *kept, F.size("w").alias("n"), F.posexplode(hashes).alias("pos", "hash"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, size, at, hash, verbatim) of every window with enough literal words of every item in each form."""
    items = forms_of(benchmark.select("item_id", "text"), "item_id").select("item_id", F.posexplode("forms").alias("form", "text"))
    items = hashed(items, "item_id", "form").filter(F.size("w") >= LEAST_WORDS)
    sizes = range(LEAST_WORDS, window + 1)
    rows = window_rows(items, "item_id", sizes, "w", "form").withColumn("size", F.least("n", F.lit(window)))
    rows = rows.withColumn("at", F.col("pos") - windows_before(sizes, "size", "n"))
    own = rows.filter((F.col("at") >= 0) & (F.col("at") <= F.col("n") - F.col("size")))
    slots = [F.xxhash64(F.lit(c)) for c in (_NAME, _NUMBER, _UNIT)]
    literals = F.size(F.filter(F.slice("w", F.col("at") + 1, F.col("size")), lambda x: ~x.isin(*slots)))
    told = (F.col("form") < VERBATIM) & (literals >= LEAST_LITERALS)
    marked = own.select("item_id", "form", "size", "at", "hash", told.alias("told"))
    marked = marked.withColumn("tells", F.max("told").over(Window.partitionBy("item_id")))
    return marked.filter(F.when(F.col("tells"), F.col("told")).otherwise(F.col("form") == VERBATIM)).select("item_id", "size", "at", "hash", (~F.col("tells")).alias("verbatim")).distinct()


def words_of(rows: DataFrame, key: str) -> DataFrame:
    """(key, place, slot, value) of the words of each text of ``rows`` (key, text); slot is empty for a word that is none."""
    staged = rows.select(key, slotted(F.col("text")).alias("text"))
    placed = staged.select(key, F.posexplode(words(resolved(F.col("text"), names_of(F.col("text"))))).alias("place", "word"))
    slot = F.substring("word", 2, 1) == "="
    return placed.select(key, "place", F.when(slot, F.substring("word", 1, 1)).otherwise("").alias("slot"), F.when(slot, F.expr("substr(word, 3)")).otherwise(F.col("word")).alias("value"))


def item_families(benchmark: DataFrame) -> DataFrame:
    """(item_id, family): items with the same words and slots at the same places, and equal values at the same places, are a family, named by its smallest item_id.

    Whether a document leaks an item doesn't depend on the values themselves, so it leaks all of a family or none."""
    placed = words_of(benchmark.select("item_id", "text"), "item_id").distinct()
    first = F.min("place").over(Window.partitionBy("item_id", "slot", "value"))
    placed = placed.withColumn("what", F.when(F.col("slot") == "", F.col("value")).otherwise(first.cast("string")))
    likeness = placed.groupBy("item_id").agg(F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct("place", "slot", "what")))), 256).alias("likeness"))
    return likeness.select("item_id", F.min("item_id").over(Window.partitionBy("likeness")).alias("family"))


def leaked_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = LEAST_COVER, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, item_id, n_items, item_windows, found_windows, coverage, slots, conflicts and changed (slots with another value than in the item)
    of each family of items that a document of ``docs`` (doc_id, text) leaks: a row has the smallest item_id of the family and the number of its
    items, which ``item_families`` lists. ``benchmark``: item_id, text. Items that are looked up by their values are families of their own."""
    single = saved(item_windows(benchmark, window), "leak-item-windows")
    families = item_families(benchmark).withColumnRenamed("item_id", "i")
    named = single.join(families, F.col("item_id").eqNullSafe(F.col("i")), "left").withColumn("own", F.when(F.col("verbatim"), F.col("item_id")).otherwise(F.col("family")))
    named = saved(named.select(F.col("item_id").alias("member"), F.col("own").alias("item_id"), "size", "at", "hash", "verbatim"), "leak-families")
    sizes_of = named.select("item_id", "member").distinct().groupBy("item_id").agg(F.count(F.lit(1)).alias("n_items"))
    items = saved(named.drop("member").distinct(), "leak-windows")
    totals = items.groupBy("item_id").agg(F.countDistinct("at").alias("item_windows"), F.max("size").alias("size"))
    totals = totals.join(sizes_of.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i"))).drop("i")
    kinds = items.select("size", "verbatim").distinct().collect()  # at most twice ``window`` rows
    sizes = sorted({r["size"] for r in kinds})
    lookup = items.drop("verbatim")
    lookup = F.broadcast(lookup) if items.count() <= most_broadcast else lookup
    canonical = templates(docs.select("doc_id", "text"), "doc_id", VERBATIM + any(r["verbatim"] for r in kinds))
    sizes = sizes or [window]
    exploded = window_rows(canonical, "doc_id", sizes).withColumnRenamed("hash", "doc_hash")
    # windows of unlike size have unlike hashes: the number of the steps is part of them
    met = exploded.join(lookup, F.col("doc_hash") == F.col("hash"))
    # one row for each window of an item and document, however often they repeat it: at the shift that most windows share
    doc_at = F.col("pos") - windows_before(sizes, "size", "n")
    shifted = met.select("doc_id", "item_id", "at", (doc_at - F.col("at")).alias("shift")).distinct()
    shifted = shifted.withColumn("sharing", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "item_id", "shift")))
    once = shifted.groupBy("doc_id", "item_id", "at").agg(F.max(F.struct("sharing", (-F.col("shift")).alias("minus"))).alias("best"))
    once = once.select("doc_id", "item_id", "at", (-F.col("best.minus")).alias("shift"))
    pairs = once.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("found_windows"), F.collect_list(F.struct("at", "shift")).alias("met"))
    pairs = pairs.join(totals.withColumnRenamed("item_id", "i"), F.col("item_id").eqNullSafe(F.col("i"))).drop("i")
    candidates = saved(pairs.filter(F.col("found_windows") >= F.col("item_windows") * cover), "leak-candidates")

    # the places of an item under the windows that meet, each at the shift that most windows over it share
    found = candidates.select("doc_id", "item_id", "size", F.explode("met").alias("m")).select("doc_id", "item_id", F.col("m.shift").alias("shift"), F.explode(F.sequence("m.at", F.col("m.at") + F.col("size") - 1)).alias("place"))
    found = found.groupBy("doc_id", "item_id", "place", "shift").agg(F.count(F.lit(1)).alias("sharing"))
    found = found.groupBy("doc_id", "item_id", "place").agg(F.max(F.struct("sharing", (-F.col("shift")).alias("minus"))).alias("best"))
    in_items = words_of(benchmark.select("item_id", "text"), "item_id").distinct().withColumnRenamed("item_id", "i").withColumnRenamed("place", "at")
    expected = found.join(in_items, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("place") == F.col("at")))
    expected = saved(expected.select("doc_id", "item_id", "slot", "value", (F.col("place") - F.col("best.minus")).alias("doc_place")), "leak-places")
    literals = expected.filter("slot = ''").groupBy("doc_id", "item_id").agg(F.countDistinct("value").alias("literals"))
    literals = literals.withColumnsRenamed({"doc_id": "ld", "item_id": "li"})
    hit = candidates.select(F.col("doc_id").alias("d")).distinct()
    texts = docs.select("doc_id", "text").join(hit, F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    in_docs = words_of(texts, "doc_id").filter("slot <> ''").select(F.col("doc_id").alias("d"), F.col("place").alias("p"), F.col("slot").alias("s"), F.col("value").alias("doc_value"))
    # the places of all leaks: small as a file, but not bounded, so never broadcast
    aligned = expected.filter("slot <> ''").hint("merge").join(in_docs.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("doc_place") == F.col("p")) & (F.col("slot") == F.col("s")))
    pairs_of_values = aligned.groupBy("doc_id", "item_id", "slot", "value", "doc_value").agg(F.count(F.lit(1)).alias("n"))
    # how many slots follow the most frequent partner, seen from either side
    forward = pairs_of_values.groupBy("doc_id", "item_id", "slot", "value").agg(F.sum("n").alias("n"), F.max("n").alias("m"), F.sum(F.when(F.col("value") != F.col("doc_value"), F.col("n")).otherwise(0)).alias("changed"))
    backward = pairs_of_values.groupBy("doc_id", "item_id", "slot", "doc_value").agg(F.sum("n").alias("n"), F.max("n").alias("m"))
    conflicts = (
        forward.select("doc_id", "item_id", "n", (F.col("n") - F.col("m")).alias("off"), F.lit(0).alias("back"), "changed")
        .unionByName(backward.select("doc_id", "item_id", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("off"), (F.col("n") - F.col("m")).alias("back"), F.lit(0).cast("bigint").alias("changed")))
        .groupBy("doc_id", "item_id")
        .agg(F.sum("n").alias("slots"), F.greatest(F.sum("off"), F.sum("back")).alias("conflicts"), F.sum("changed").alias("changed"))
        .withColumnsRenamed({"doc_id": "d", "item_id": "i"})
    )
    judged = candidates.join(conflicts, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("item_id").eqNullSafe(F.col("i")), "left")
    judged = judged.join(literals, F.col("doc_id").eqNullSafe(F.col("ld")) & F.col("item_id").eqNullSafe(F.col("li")), "left")
    judged = judged.filter((F.coalesce("literals", F.lit(0)) >= LEAST_WORDS) | (F.coalesce("conflicts", F.lit(0)) <= F.coalesce("slots", F.lit(0)) * MOST_CONFLICTS))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return judged.select("doc_id", "item_id", "n_items", "item_windows", "found_windows", (F.col("found_windows") / F.col("item_windows")).alias("coverage"), zero("slots"), zero("conflicts"), zero("changed"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item, with all columns. Rows that share a doc_id, or have none, are judged each by its text.

    The key of a row is a 64-bit hash of its doc_id and text: of 10**10 rows with 10**6 leaks, one clean row shares the
    key of a leak with a chance of about 5e-4."""
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    bad = leaked_items(keyed, benchmark, **options).select(F.col("doc_id").alias("leaking")).distinct()
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["leaking"], "left_anti")
