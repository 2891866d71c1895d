"""Mixing sources to target weights by temperature.

The weight of a source is its token share to the power t, normalised: t = 1
keeps the shares, t = 0 levels them. The exponent is bisected to the largest
levelling that a limit allows: either the entropy of the weights reaches a target, or no
source is repeated more often than ``repetition_limit``. The budget is the
smallest one that takes every source whole at least once (or a given one).
Weights become token budgets, and a budget becomes epochs: whole passes over
a source, and a part of one more.

A part is the beginning of a block permutation: documents are dealt into
blocks by hash, the blocks of a source are put in an order that depends on the
epoch, and blocks are taken in that order until the budget is met; the last
block is cut between documents, in the order that these have in this epoch. Prefix sums run over groups of
``BLOCK_GROUP`` blocks, over the groups, and inside one block for each source, so no task sees the blocks of a source.

The mixture is ordered by ``mix_order`` (epoch and block), ``mix_place`` (in the block) and doc_id; only equal
rows tie. Blocks of all sources interleave.

Tokens are counted as words plus one for the end mark. The source totals and
block totals are tables; only the bracket of the exponent reaches the driver.

Defined cases: a null source counts as one source of its own; null and empty
texts have one token. Repeated rows are rows of their own. An empty table gives
an empty result. Columns of ``docs`` stay as they are, but for those in ``ADDED``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .common import saved

BLOCK_TOKENS = 1 << 18
BLOCK_GROUP = 4096
SALTS = 32
"""Tasks that the rows of one source are dealt over where they meet its budget."""
POINTS = 16
"""Exponents that one pass over the source totals tries; a pass narrows the bracket that much."""
PASSES = 5


#: Columns that the mixture adds; a column of the input with such a name is replaced.
ADDED = {"mix_epoch": "int", "mix_block": "bigint", "mix_order": "double", "mix_place": "bigint", "mix_tokens": "bigint"}
ORDER = ("mix_order", "mix_place", "doc_id")
"""What orders the mixture."""


def source_key() -> F.Column:
    """A string for the source that tells null from every value."""
    return F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))


def tokens_of(text: F.Column) -> F.Column:
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")) + 1).cast("bigint")


def block_place(epoch: str, seed: int) -> F.Column:
    """The place from 0 to 1 of a block among those of its source in an epoch."""
    return F.shiftrightunsigned(F.xxhash64("mix_source", "mix_block", F.col(epoch).cast("int"), F.lit(seed)), 11).cast("double") / float(1 << 53)


def row_place(epoch: str) -> F.Column:
    """What orders the rows of a block in an epoch."""
    return F.xxhash64("mix_hash", F.col(epoch).cast("int"))


def sums_before(blocks: DataFrame) -> DataFrame:
    """``blocks`` (mix_source, mix_block, place, blocks, in_block) with ``before``: what the blocks of the source with smaller places hold."""

    def before(column: str, window: WindowSpec) -> F.Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # places are even, so a group holds about BLOCK_GROUP blocks
    grouped = blocks.withColumn("mix_group", F.floor(F.col("place") * F.ceil(F.col("blocks") / BLOCK_GROUP)))
    groups = grouped.groupBy("mix_source", "mix_group").agg(F.sum("in_block").alias("in_group"))
    groups = groups.select("mix_source", "mix_group", before("in_group", Window.partitionBy("mix_source").orderBy("mix_group")).alias("base"))
    inside = before("in_block", Window.partitionBy("mix_source", "mix_group").orderBy("place", "mix_block"))
    return grouped.withColumn("inside", inside).join(groups, ["mix_source", "mix_group"]).withColumn("before", F.col("base") + F.col("inside")).drop("mix_group", "base", "inside")


def measures(totals: DataFrame, exponents: list[float], budget: int | None) -> list[tuple[float, float, float]]:
    """(exponent, entropy of the weights, most epochs of a source) for each exponent, in one pass."""
    share = F.col("tokens") / F.col("whole")
    tried = totals.crossJoin(F.broadcast(totals.agg(F.sum("tokens").alias("whole"))))  # one row
    tried = tried.select("tokens", "whole", F.explode(F.array(*[F.lit(float(e)) for e in exponents])).alias("t"), share.alias("share"))
    power = F.pow("share", "t")
    sums = tried.groupBy("t").agg(
        F.sum(power).alias("z"),
        F.sum(power * F.log(power)).alias("zl"),
        F.max(power / F.col("tokens")).alias("high"),
        F.min(power / F.col("tokens")).alias("low"),
    )
    out = []
    for r in sums.collect():
        epochs = r.high / r.low if budget is None else r.high / r.z * budget
        out.append((r.t, math.log(r.z) - r.zl / r.z, epochs))
    return sorted(out)


def bisected_exponent(totals: DataFrame, target_entropy: float | None, repetition_limit: float | None, budget: int | None = None) -> float:
    """The exponent in [0, 1] whose weights have the target entropy, or repeat no source more often than the limit.

    Entropy and repetition both fall as the exponent rises, so the bracket halves; several halvings share a pass."""
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        tried = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
        fits = lambda entropy, epochs: epochs <= repetition_limit if target_entropy is None else entropy <= target_entropy
        ok = [t for t, entropy, epochs in measures(totals, tried, budget) if fits(entropy, epochs)]
        if not ok:
            return 1.0
        high = min(ok)
        low = max([t for t in tried if t < high], default=high)
        if low == high:
            break
    return high


def mixed(
    docs: DataFrame,
    *,
    target_entropy: float | None = None,
    repetition_limit: float | None = None,
    budget: int | None = None,
    seed: int = 0,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, ...), each as often as its budget says, with mix_epoch (from 0),
    mix_block, mix_order (epoch and place of the block in it), mix_place (what orders the rows of a block) and mix_tokens."""
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("give either target_entropy or repetition_limit")
    columns = [c for c in docs.columns if c not in ADDED]
    sized = docs.select("doc_id", source_key().alias("mix_source"), tokens_of(F.col("text")).alias("mix_tokens"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("mix_hash"))
    sized = saved(sized, "mix-sizes")
    totals = saved(sized.groupBy("mix_source").agg(F.sum("mix_tokens").alias("tokens")), "mix-totals")
    if totals.isEmpty():
        return docs.select(*columns, *[F.lit(None).cast(k).alias(c) for c, k in ADDED.items()])
    exponent = bisected_exponent(totals, target_entropy, repetition_limit, budget)

    # epochs of a source: its weight times the budget, by its tokens
    whole = totals.agg(F.sum("tokens").alias("whole"))
    power = totals.crossJoin(F.broadcast(whole)).withColumn("power", F.pow(F.col("tokens") / F.col("whole"), F.lit(exponent)))
    norm = power.agg(F.sum("power").alias("z"), F.min(F.col("power") / F.col("tokens")).alias("low"))
    per_power = F.lit(float(budget)) / F.col("z") if budget is not None else 1 / F.col("low")
    plan = power.crossJoin(F.broadcast(norm)).select(
        "mix_source",
        F.round(F.col("power") * per_power).cast("bigint").alias("budget"),
        "tokens",
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("bigint").alias("blocks"),
    )
    plan = plan.withColumn("full", F.floor(F.col("budget") / F.col("tokens")).cast("int")).withColumn("part", F.col("budget") - F.col("full") * F.col("tokens"))
    plan = saved(plan, "mix-plan")

    def block(of: str = "blocks") -> F.Column:
        return F.pmod("mix_hash", of)

    # a row of the plan for each salt, so that the rows of a large source meet it in many tasks
    salted = plan.select("mix_source", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("mix_salt"))
    salt = F.pmod(F.shiftright("mix_hash", 32), F.lit(SALTS)).cast("int").alias("mix_salt")

    # which blocks the part of an epoch takes
    in_block = sized.select("*", salt).join(salted, ["mix_source", "mix_salt"]).groupBy("mix_source", block().alias("mix_block")).agg(F.sum("mix_tokens").alias("in_block"))
    placed = in_block.join(plan.select("mix_source", "blocks", "full", "part"), "mix_source")
    taken = sums_before(placed.withColumn("place", block_place("full", seed)))
    taken = taken.select("mix_source", "mix_block", "full", (F.col("part") - F.col("before")).alias("left"), "in_block")
    taken = saved(taken, "mix-blocks")

    # the input's columns travel as one, so that no name of theirs meets one used here
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("mix_row"), source_key().alias("mix_source"), tokens_of(F.col("text")).alias("mix_tokens"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("mix_hash"))
    rows = rows.select("*", salt).join(salted, ["mix_source", "mix_salt"]).withColumn("mix_block", block()).drop("blocks", "mix_salt")
    rows = rows.join(taken, ["mix_source", "mix_block"])
    cut = (F.col("left") > 0) & (F.col("left") < F.col("in_block"))
    within = Window.partitionBy("mix_source", "mix_block").orderBy(row_place("full"), "mix_row.doc_id").rowsBetween(Window.unboundedPreceding, -1)
    # only the block in which the budget ends, one for each source, is summed row by row
    ended = rows.filter(cut).withColumn("before", F.coalesce(F.sum("mix_tokens").over(within), F.lit(0)))
    ended = ended.withColumn("copies", F.col("full") + (F.col("before") < F.col("left")).cast("int")).drop("before")
    others = rows.filter(~cut).withColumn("copies", F.col("full") + (F.col("left") >= F.col("in_block")).cast("int"))
    repeated = others.unionByName(ended).filter("copies > 0")
    repeated = repeated.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    repeated = repeated.withColumns({"mix_order": F.col("mix_epoch") + block_place("mix_epoch", seed), "mix_place": row_place("mix_epoch")})
    return repeated.select("mix_row.*", *ADDED)
