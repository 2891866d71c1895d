"""The trie of conversations by their first turns, and the totals of its subtrees by leaf peeling.

A node is the set of conversations that begin with the same turns. Its id is a digest of these turns, from running sums of hashes of
(place, turn), which need no whole conversation in one place: turns are sorted over all partitions, and sums are made inside
a part of a conversation and then over its parts. Texts leave the scan as digests.

Peeling: each node holds the number of children that are not complete, and the XOR of their ids. A complete node sends its
totals to its parent once; the parent adds them, counts down and XORs the id out. With none left it is complete. With one left, the XOR is that
child's id: the node from then on points at it, and pointers that meet a node with a pointer double. So a chain takes rounds by the logarithm of its
length, branches are peeled beside it, and the rounds end when the root is complete.

Defined cases: rows without conv_id belong to no conversation. A null turn comes first; turns with one number (null included) are in the order of their
digests, so repeated rows are turns of their own. A null role or text is empty. ``c - c % 5`` cuts toward zero. A conversation without turns is a member of
the root alone. An empty table has no nodes. Further columns aren't read. What takes rows of one key in common (the children of a
node, the members of a prefix, the turns of a conversation) is added up before it is shuffled, or is split. Only the digest of the ends of one node is
made in one task, as SHA-256 must; it reads runs of joined ids one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, in_arrow, looked_up, saved

#: A head has at most HEADS - 1 turns, taken from the first of SIBLINGS conversations.
HEADS, SIBLINGS = 9, 5
#: Sums of 32 bits each, so that none overflows below 2**31 turns.
LANES = 5
#: Rows of one node or target that meet in a task, and children of a node by so many salts.
RUN, SALTS = 4096, 256
_EMPTY = hashlib.sha256(b"").hexdigest()


def _placed(turns: DataFrame) -> DataFrame:
    """(conv_id, digest, n_bytes, part, at): all turns in order; ``at`` grows along it, without gaps inside a part."""
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    # the last column splits equal rows, which may stand in any order
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("conv_id", "digest", "n_bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))


def _parts(placed: DataFrame) -> DataFrame:
    """(conv_id, part, first, before, run, h, m, n): where the turns of a part begin, those of the conversation before it, the place of the
    conversation among all, the turns that it leaves to its head, those that the head has, and all its own turns."""
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("in_part"))
    along = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.withColumn("before", F.sum("in_part").over(along) - F.col("in_part"))
    convs = parts.groupBy("conv_id").agg(F.sum("in_part").alias("n"), F.min("first").alias("run"))
    convs = convs.select("conv_id", "n", F.expr(f"run div {RUN}").alias("run"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"), (F.col("conv_id") - F.col("conv_id") % SIBLINGS).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    return parts.join(convs, "conv_id")


def _rebuilt(placed: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, n_bytes, part, run, last): the turns of all rebuilt conversations, those of heads in part -1, and a row of depth 0 for each."""
    parts = saved(_parts(placed), "trie-parts")
    at = placed.join(parts, ["conv_id", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first"))
    convs = parts.filter("before = 0").select("conv_id", "h", "m", "n", "run", "base")
    length = F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    own = at.filter("pos >= h").select("conv_id", (F.col("m") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "n_bytes", "part", "run", length.alias("length"))
    heads = at.filter(f"pos < {HEADS - 1}").select(F.col("conv_id").alias("base"), "pos", "digest", "n_bytes")
    head = convs.join(heads, "base").filter("pos < h")
    head = head.select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "n_bytes", F.lit(-1).alias("part"), "run", length.alias("length"))
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("n_bytes"), F.lit(-1).alias("part"), "run", length.alias("length"))
    rows = own.unionByName(head).unionByName(root)
    return rows.withColumn("last", F.col("depth") == F.col("length")).drop("length")


def _id(depth: Column, lanes: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), depth, *lanes) for seed in (1, 2)]


def _members(placed: DataFrame) -> DataFrame:
    """(a, b, pa, pb, conv_id, depth, n_bytes, run, last): each rebuilt conversation in each of its nodes, with the ids of node and parent."""
    rows = _rebuilt(placed)
    names = [f"s{i}" for i in range(LANES)]
    hashed = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "depth", "digest").bitwiseAND(0xFFFFFFFF)).otherwise(0).alias(n) for i, n in enumerate(names)]
    rows = saved(rows.select("conv_id", "depth", "n_bytes", "part", "run", "last", *hashed), "trie-turns")
    sums = rows.groupBy("conv_id", "part").agg(*[F.sum(n).alias(f"p_{n}") for n in names])
    along = Window.partitionBy("conv_id").orderBy("part")
    sums = sums.select("conv_id", "part", *[(F.sum(f"p_{n}").over(along) - F.col(f"p_{n}")).alias(f"p_{n}") for n in names])
    inside = Window.partitionBy("conv_id", "part").orderBy("depth")
    rows = rows.join(sums, ["conv_id", "part"]).withColumns({f"c_{n}": F.sum(n).over(inside) + F.col(f"p_{n}") for n in names})
    a, b = _id(F.col("depth"), [F.col(f"c_{n}") for n in names])
    pa, pb = _id(F.col("depth") - 1, [F.col(f"c_{n}") - F.col(n) for n in names])
    return rows.select(a.alias("a"), b.alias("b"), pa.alias("pa"), pb.alias("pb"), "conv_id", "depth", "n_bytes", "run", "last")


def _hashed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, ids) sorted by node and run: the digest of the ids of each node."""
    at, state, out = None, None, []
    for batch in batches:
        for a, b, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, b) != at:
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = (a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield _ends_batch(out)
        out = []
    if at is not None:
        yield _ends_batch([(*at, state.hexdigest())])


def _ends_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["a", "b", "ends_sha256"])


def _ends(members: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the nodes at which conversations end: ids are joined in runs of at most RUN conversations, then the runs of a node are hashed in order."""
    runs = members.filter("last").groupBy("a", "b", "run").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    runs = runs.repartition("a", "b").sortWithinPartitions("a", "b", "run").select("a", "b", "ids")
    return in_arrow(runs, _hashed_runs, "a long, b long, ends_sha256 string")


STATE = ("a", "b", "pa", "pb", "open", "xa", "xb", "leaves", "saved", "wa", "wb", "dist", "complete", "fresh")


def _began(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """The state of all nodes: leaves are complete, and nodes with one child point at it."""
    rows = nodes.join(children, ["a", "b"], "left").withColumn("open", F.coalesce("n_children", F.lit(0).cast("long")))
    one = F.col("open") == 1
    return rows.select(
        "a", "b", "pa", "pb", "open", "xa", "xb", (F.col("open") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        F.when(one, F.col("xa")).alias("wa"), F.when(one, F.col("xb")).alias("wb"), F.lit(1).cast("long").alias("dist"), (F.col("open") == 0).alias("complete"), (F.col("open") == 0).alias("fresh"),
    )


def _peeled(state: DataFrame) -> DataFrame:
    """One round: nodes that have just been completed send their totals, and pointers are followed."""
    waiting = state.filter("not complete and open = 1").withColumn("spread", F.expr(f"dist div {RUN}"))
    seen = state.select(F.col("a").alias("wa"), F.col("b").alias("wb"), *[F.col(c).alias(f"t_{c}") for c in ("open", "leaves", "saved", "wa", "wb", "dist", "complete")])
    # of one chain each node has another distance to its target, so the distance splits those that ask for one target
    asked = looked_up(waiting, seen, ["wa", "wb"], "spread")
    done, jumps = F.col("t_complete"), ~F.col("t_complete") & (F.col("t_open") == 1)
    told = done | jumps
    asked = asked.select(
        "a", "b", "pa", "pb", "open", "xa", "xb", *[F.when(told, F.col(c) + F.col(f"t_{c}")).otherwise(F.col(c)).alias(c) for c in ("leaves", "saved")],
        *[F.when(jumps, F.col(f"t_{c}")).otherwise(F.col(c)).alias(c) for c in ("wa", "wb")], F.when(jumps, F.col("dist") + F.col("t_dist")).otherwise(F.col("dist")).alias("dist"),
        done.alias("complete"), done.alias("fresh"),
    )
    sent = state.filter("fresh").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"))
    sent = sent.agg(F.count(F.lit(1)).alias("k"), F.sum("leaves").alias("k_leaves"), F.sum("saved").alias("k_saved"), F.bit_xor("a").alias("ka"), F.bit_xor("b").alias("kb"))
    none = F.lit(0).cast("long")
    got = {c: F.coalesce(c, none) for c in ("k", "k_leaves", "k_saved", "ka", "kb")}
    heard = state.filter("not complete and open > 1").join(sent, ["a", "b"], "left").withColumns(got)
    heard = heard.withColumns({"open": F.col("open") - F.col("k"), "xa": F.col("xa").bitwiseXOR(F.col("ka")), "xb": F.col("xb").bitwiseXOR(F.col("kb"))})
    one, none_open = F.col("open") == 1, F.col("open") == 0
    heard = heard.select(
        "a", "b", "pa", "pb", "open", "xa", "xb", (F.col("leaves") + F.col("k_leaves")).alias("leaves"), (F.col("saved") + F.col("k_saved")).alias("saved"),
        F.when(one, F.col("xa")).alias("wa"), F.when(one, F.col("xb")).alias("wb"), F.lit(1).cast("long").alias("dist"), none_open.alias("complete"), none_open.alias("fresh"),
    )
    # complete nodes stay as long as a pointer leads to them
    targets = waiting.select(F.col("wa").alias("a"), F.col("wb").alias("b")).distinct()
    kept = state.filter("complete").join(targets, ["a", "b"], "left_semi").withColumn("fresh", F.lit(False))
    return asked.unionByName(heard).unionByName(kept.select(*STATE))


def subtree_totals(nodes: DataFrame, children: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b, leaves, saved) of all nodes, and the tables of the rounds, which the caller deletes."""
    state = saved(_began(nodes, children), "trie-round")
    rounds = [state]
    while not state.filter("not complete").isEmpty():
        state = saved(_peeled(state), "trie-round")
        rounds.append(state)
    out = rounds[0].filter("fresh")
    for r in rounds[1:]:
        out = out.unionByName(r.filter("fresh"))
    return out.select("a", "b", "leaves", "saved"), rounds


def conversation_trie(turns: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    placed = saved(_placed(turns), "trie-placed")
    members = saved(_members(placed), "trie-members")
    dropped(placed)
    nodes = members.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    nodes = saved(nodes, "trie-nodes")
    below = nodes.filter("depth > 0")
    children = saved(below.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb")), "trie-children")
    totals, _ = subtree_totals(nodes, children)
    # a node's parent has another smallest member only where the node isn't the first child
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    up = looked_up(below.select("a", "b", "pa", "pb", F.pmod("a", F.lit(SALTS)).alias("salt")), parents, ["pa", "pb"], "salt").select("a", "b", "parent_conv_id")
    rows = nodes.join(totals, ["a", "b"]).join(up, ["a", "b"], "left").join(children.select("a", "b", "n_children"), ["a", "b"], "left").join(_ends(members), ["a", "b"], "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
