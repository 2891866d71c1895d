"""Listings that come in answers, each with a token for the next one, put in order whatever order they arrived in.

An answer is known by its list and the token that asked for it (null for the first answer of a list); its own token asks for the next. While there
are many answers, each round takes about a fourth of them out of the chains, no two neighbours, and lets the answers before them point past them; what is moved
falls by a fourth a round, so all rounds together move a multiple of the input. The few that are left are followed by pointer doubling from the
first answer of each list: in round k each answer knows the answer 2**k steps on, and the answers with a place below 2**k give those below 2**(k+1)
theirs. Then the rounds are gone back, and the answers that were taken out get their places from those before them. Rounds grow with the logarithm of the
input. In a proper list an answer is asked for once, and no key of these joins is hot. Doubling ends when it finds no new answer, which also ends it in a loop.

Of several answers to one token the last by ``pos`` counts, as after a repeated request. An answer that no chain from a first answer reaches is not listed. What
isn't a proper list is reported by ``broken``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import saved

#: The id of the answer that is asked for with no token. Tokens get a letter before them, so none is like it.
FIRST = "^"


def _asked() -> F.Column:
    return F.coalesce(F.concat(F.lit("t"), F.col("asked")), F.lit(FIRST))


def current(answers: DataFrame, *more: Column) -> DataFrame:
    """(list, at, next, pos, n): one answer for each token, the last; ``next`` is null at the end of a list. ``more``: further aggregates over the answers of a token.

    ``answers``: list, asked, next, pos, n (the rows that the answer lists)."""
    last = F.max_by(F.struct("next", "n"), "pos")
    rows = answers.groupBy("list", _asked().alias("at")).agg(last.alias("a"), F.max("pos").alias("pos"), *more)
    kept = [c for c in rows.columns if c not in ("list", "at", "a", "pos")]
    return rows.select("list", "at", F.concat(F.lit("t"), F.col("a.next")).alias("next"), "pos", F.col("a.n").alias("n"), *kept)


def ranked(answers: DataFrame, few: int = 500_000) -> DataFrame:
    """(list, at, next, pos, rank, before): the answers on the chain of each list, their place in it from 0, and the rows listed before them.

    With at most ``few`` pointers left, doubling takes over from contraction."""
    # from here on answers are numbers, those of first answers below 0
    number = F.monotonically_increasing_id()
    nodes = saved(current(answers).withColumn("id", F.when(F.col("at") == FIRST, -1 - number).otherwise(number)), "answers")
    targets = nodes.select("list", F.col("at").alias("next"), F.col("id").alias("to"))
    # only pointers to an answer that is there lead on
    pointers = nodes.select("list", "next", "id", F.col("n").cast("long").alias("rows")).join(targets, ["list", "next"])
    pointers = saved(pointers.select("id", "to", F.lit(1).cast("long").alias("steps"), "rows"), "pointers")
    pointers, passed = _contracted(pointers, few)
    found = _doubled(nodes.filter("id < 0").select("id", F.lit(0).cast("long").alias("rank"), F.lit(0).cast("long").alias("before")), pointers)
    for some in reversed(passed):
        found = found.unionByName(saved(_first_met(_reached(found, some)), "ranks"))
    return nodes.join(found, "id").select("list", "at", "next", "pos", "rank", "before")


def _contracted(pointers: DataFrame, few: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pointers (id, to, steps, rows) between the answers that are left, and for each round those that led to the answers that it took out.

    An answer is taken out if its coin of the round shows 1 and that of the answer it points to 0: then neither that one nor one that points to it
    is taken out with it. Coins are hashes, so both ends of a pointer know them. First answers stay."""
    passed: list[DataFrame] = []
    inner = pointers.filter("id >= 0").count()
    while inner > few:
        coin = lambda c, k=len(passed): (F.col(c) >= 0) & (F.shiftrightunsigned(F.xxhash64(c, F.lit(k)), 63) == 1)
        out = coin("id") & ~coin("to")
        onward = pointers.filter(out).select(F.col("id").alias("to"), F.col("to").alias("then"), F.col("steps").alias("more"), F.col("rows").alias("rows_more"))
        stay = saved(pointers.filter(~out).join(onward, "to", "left"), "contracted")
        passed.append(stay.filter("then is not null").select("id", "to", "steps", "rows"))
        more, rows_more = (F.coalesce(c, F.lit(0).cast("long")) for c in ("more", "rows_more"))
        pointers = stay.select("id", F.coalesce("then", "to").alias("to"), (F.col("steps") + more).alias("steps"), (F.col("rows") + rows_more).alias("rows"))
        before, inner = inner, pointers.filter("id >= 0").count()
        # a fourth goes, unless answers lead back to themselves
        if inner > before * 0.95:
            break
    return pointers, passed


def _reached(found: DataFrame, pointers: DataFrame) -> DataFrame:
    return found.join(pointers, "id").select(F.col("to").alias("id"), (F.col("rank") + F.col("steps")).alias("rank"), (F.col("before") + F.col("rows")).alias("before"))


def _first_met(found: DataFrame) -> DataFrame:
    """In a loop an answer is met again at a later place; the first one holds."""
    return found.groupBy("id").agg(F.min(F.struct("rank", "before")).alias("p")).select("id", "p.*")


def _doubled(found: DataFrame, jumps: DataFrame) -> DataFrame:
    """(id, rank, before) of all answers that pointers lead to from those found."""
    count = 0
    while True:
        found = saved(_first_met(found.unionByName(_reached(found, jumps))), "ranks")
        now = found.count()
        if now == count:
            return found
        count = now
        on = jumps.select(F.col("id").alias("to"), F.col("to").alias("then"), F.col("steps").alias("more"), F.col("rows").alias("rows_more"))
        jumps = jumps.join(on, "to").select("id", F.col("then").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("rows") + F.col("rows_more")).alias("rows"))
        jumps = saved(jumps, "jumps")


def broken(answers: DataFrame, chain: DataFrame) -> DataFrame:
    """(list, problem, token): what keeps lists from being proper; ``chain`` is what ``ranked`` gives for the answers.

    gap: the chain asks for a token that no answer has. loop: it comes back to an answer. fork: answers to one token go on differently. merge: answers to
    several tokens go on alike. stray: an answer off the chain. headless: a list without first answer. The token of a first answer is null."""
    way = F.coalesce(F.concat(F.lit("t"), "next"), F.lit("$"))
    nodes = saved(current(answers, (F.min(way) != F.max(way)).alias("forked")), "answers")
    chain = saved(chain.select("list", "at", "next", "rank"), "chain")
    later = chain.select("list", F.col("at").alias("next"), F.col("rank").alias("target"))
    ends = chain.filter("next is not null").select("list", "next", "rank").join(later, ["list", "next"], "left").filter("target is null or target <= rank")
    ends = ends.select("list", F.when(F.col("target").isNull(), "gap").otherwise("loop").alias("problem"), F.col("next").alias("token"))
    forks = nodes.filter("forked").select("list", F.col("at").alias("token"))
    merges = nodes.filter("next is not null").groupBy("list", F.col("next").alias("token")).agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1")
    strays = nodes.join(chain.select("list", "at"), ["list", "at"], "left_anti").select("list", F.lit("stray").alias("problem"), F.col("at").alias("token"))
    heads = nodes.groupBy("list").agg(F.max(F.col("at") == FIRST).alias("head")).filter("not head").select("list", F.lit("headless").alias("problem"), F.lit(FIRST).alias("token"))
    rows = ends.unionByName(strays).unionByName(heads)
    for name, some in (("fork", forks), ("merge", merges)):
        rows = rows.unionByName(some.select("list", F.lit(name).alias("problem"), "token"))
    return rows.select("list", "problem", F.when(F.col("token") != FIRST, F.substring("token", 2, 2**31 - 1)).alias("token"))


def in_order(answers: DataFrame, chain: DataFrame, items: DataFrame) -> DataFrame:
    """(list, ordinal, id, title): the listed rows of each list in its order, from 0. ``items``: pos, place, id, title."""
    return items.join(chain.select("list", "pos", "before"), "pos").select("list", (F.col("before") + F.col("place")).alias("ordinal"), "id", "title")
