"""Near-duplicate groups by MinHash bands with sequential Bayesian verification.

A document's set holds its distinct runs of five words. Documents whose sets
have a Jaccard similarity of at least ``percent`` / 100 are linked; a group is a
connected component of the links.

1. Each distinct set becomes one node (its smallest doc_id), so exact copies
   cost no pair. A node has band keys (24 of 6 MinHash values at 85 per cent)
   and a sketch of 256 one-bit MinHash values.
2. Star links: in each bucket of a band key, every node is paired with one
   pivot, the node that shares most buckets. Pairs number at most nodes x bands.
3. Rest: nodes of one bucket that are still in different components are
   paired, unless exact bounds exclude a link. A node's shingles that occur in
   no other node of the rest can't be shared, so they limit the size of any
   partner. A bitmap of the hash classes that a set occupies limits the
   intersection: a shingle in a class that the partner leaves empty isn't
   shared. The bounds and the Bayesian test stand in the join condition: a
   bucket of near copies doesn't emit its pairs. A large bucket is joined in
   pairs of blocks, so no task compares more than a block with a block for a key. The bitmap excludes little
   once a set has several times ``CLASSES`` shingles.
4. Bayesian test: the sketches are compared 64 bits at a time; a pair is
   dropped as soon as the posterior probability that its similarity reaches
   the threshold falls below ``MISS``.
5. Survivors are verified on their full sets. Components are made by
   pointer doubling and contraction, with each step written to the shared work folder, and
   deleted when the next one stands.

A pair at the threshold shares no bucket with a probability of 1.3e-5 at most,
and less with a higher similarity; ``MISS`` bounds what the test adds.

Defined cases: a document without words has an empty set, is linked with
nothing and is kept. With fewer than five words the whole sequence is the one
shingle. Rows with one doc_id count as one document. A null doc_id is linked
with nothing, has a null component and is kept. An empty table gives an empty
result. Further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_BYTES, Words, _mixed, batches_of, byte_table, dropped, in_arrow, saved, sliced

SHINGLE = 5
MISSED_BAND = 1.3e-5
"""Chance that two documents at the threshold share no band key."""
BATCH_BITS, BATCHES = 64, 4
MISS = 1e-5
CLASSES = 1024
"""Hash classes of the bitmap of a set; a multiple of 64."""
SALTS = 16
"""Parts in which the nodes of a bucket learn how many blocks it has."""
BLOCK = 256
"""Nodes of a bucket that one join key holds on either side."""

_RNG = np.random.default_rng(7_2026)
_ORDER = _RNG.integers(1, 2**62, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = (_RNG.integers(1, 2**31, BATCH_BITS * BATCHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_BAND = _RNG.integers(1, 2**62, (64, 6), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_WORD = byte_table(separators=WHITE_BYTES)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    for _, run in batches_of(texts):
        words = Words(run, _IS_WORD)
        hashes = words.hashes()
        n = len(hashes) - SHINGLE + 1
        runs = np.zeros(max(n, 0), dtype=np.uint64)
        for i in range(SHINGLE if n > 0 else 0):
            runs += hashes[i : i + n] * _ORDER[i]
        runs = _mixed(runs)
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            if b - a >= SHINGLE:
                yield np.unique(runs[a : b - SHINGLE + 1])
            elif b > a:
                yield _mixed((hashes[a:b] * _ORDER[: b - a]).sum(keepdims=True) + _ORDER[SHINGLE:] * np.uint64(b - a))
            else:
                yield runs[:0]


def banding(percent: int) -> tuple[int, int]:
    """Number of bands and MinHash values in each: as many bands as keep the chance of a miss at ``MISSED_BAND``."""
    rows = 6 if percent >= 85 else 5 if percent >= 75 else 4 if percent >= 65 else 3
    bands = math.ceil(math.log(MISSED_BAND) / math.log(1 - (percent / 100) ** rows))
    if percent < 50 or bands > len(_BAND):
        raise ValueError("the threshold has to be from 50 to 100 per cent")
    return bands, rows


def signature(shingles: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and sketch of a set that isn't empty, as signed 64-bit integers."""
    least = None
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), 2048):
        part = (_FACTORS * values[at : at + 2048]).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    keys = _mixed((least[: bands * rows].reshape(bands, rows).astype(np.uint64) * _BAND[:bands, :rows]).sum(axis=1) + np.arange(bands, dtype=np.uint64))
    bits = np.packbits(((least >> np.uint32(9)) & np.uint32(1)).astype(np.uint8)).view("<i8")
    return keys.view(np.int64), bits


def occupied(shingles: np.ndarray) -> np.ndarray:
    """The bitmap of the hash classes that a set occupies, as signed 64-bit integers."""
    seen = np.zeros(CLASSES, dtype=bool)
    seen[shingles % np.uint64(CLASSES)] = True
    return np.packbits(seen).view("<i8")


SKETCHES = [f"s{i}" for i in range(BATCHES)]
BITMAP = [f"m{i}" for i in range(CLASSES // 64)]
SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, " + ", ".join(f"{c} long" for c in SKETCHES + BITMAP)


def sign_batches(batches: Iterator[pa.RecordBatch], n_bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SIGNED.split(", ")]
    for batch in sliced(batches):
        sizes, digests, bands, sketches, bitmaps = [], [], [], [], []
        for s in shingle_sets(batch.column(1).to_pylist()):
            sizes.append(len(s))
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            b, k = signature(s, n_bands, rows) if len(s) else (None, np.zeros(BATCHES, dtype=np.int64))
            bands.append(b)
            sketches.append(k)
            bitmaps.append(occupied(s))
        facts = np.hstack([np.array(sketches, dtype=np.int64).reshape(-1, len(SKETCHES)), np.array(bitmaps, dtype=np.int64).reshape(-1, len(BITMAP))])
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(facts[:, i]) for i in range(facts.shape[1])], names)


def shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, text_u, text_v) to (u, v, both, either): sizes of the intersection and the union of the full sets."""
    for batch in sliced(batches):
        both, either = [], []
        for a, b in zip(shingle_sets(batch.column(2).to_pylist()), shingle_sets(batch.column(3).to_pylist()), strict=True):
            n = len(np.intersect1d(a, b, assume_unique=True))
            both.append(n)
            either.append(len(a) + len(b) - n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], ["u", "v", "both", "either"])


def shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to a row (node, shingle) for each shingle."""
    for batch in sliced(batches):
        nodes, sets, rows = [], [], 0
        for node, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist()), strict=True):
            nodes.append(np.full(len(s), node, dtype=np.int64))
            sets.append(s.view(np.int64))
            rows += len(s)
            if rows > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sets))], ["node", "shingle"])
                nodes, sets, rows = [], [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sets))], ["node", "shingle"])


@functools.lru_cache(maxsize=8)
def least_matches(percent: int, miss: float = MISS) -> tuple[int, ...]:
    """For each number of compared batches, the fewest equal bits with which a pair goes on.

    With similarity j a bit is equal with probability (1 + j) / 2. Under a uniform prior of j, the posterior of
    j >= percent / 100 is the share of the likelihood above it."""
    j = (np.arange(20_000) + 0.5) / 20_000
    above = j >= percent / 100
    out = []
    for batch in range(1, BATCHES + 1):
        n = batch * BATCH_BITS
        for m in range(n + 1):
            log = m * np.log((1 + j) / 2) + (n - m) * np.log((1 - j) / 2)
            weight = np.exp(log - log.max())
            if weight[above].sum() / weight.sum() >= miss:
                out.append(m)
                break
    return tuple(out)


def bayes_passes(left: str, right: str, percent: int) -> Column:
    """True unless a batch of sketch bits makes the similarity too unlikely."""
    equal, passes = F.lit(0), F.lit(True)
    for i, least in enumerate(least_matches(percent)):
        equal = equal + F.lit(BATCH_BITS) - F.bit_count(F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}")))
        passes = passes & (equal >= least)
    return passes


def sizes_fit(left: str, right: str, percent: int) -> Column:
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def bitmaps_fit(left: str, right: str, percent: int) -> Column:
    """False if the occupied classes leave too few shingles that both sets can hold."""

    def most_shared(a: str, b: str) -> Column:
        alone = [F.bit_count(F.col(f"{a}.{c}").bitwiseAND(F.bitwise_not(F.col(f"{b}.{c}")))) for c in BITMAP]
        return F.col(f"{a}.n") - functools.reduce(lambda x, y: x + y, alone)

    shared = F.least(most_shared(left, right), most_shared(right, left))
    return shared * (100 + percent) >= (F.col(f"{left}.n") + F.col(f"{right}.n")) * percent


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose full sets reach the threshold, as a saved table. ``pairs`` is one too, and is deleted."""
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    texts = saved(docs.select(F.col("doc_id").alias("node"), "text").join(nodes, "node", "left_semi"), "near-dedup-texts")
    with_u = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
    with_v = with_u.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v")
    counts = in_arrow(with_v.select("u", "v", "text_u", "text_v"), shared_counts, "u long, v long, both long, either long")
    links = saved(counts.filter(F.col("both") * 100 >= F.col("either") * percent).select("u", "v"), "near-dedup-links")
    dropped(texts)
    dropped(pairs)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v): the smallest node that is reachable.

    In each round a node points to its smallest neighbour, pointers double until they reach the local minimum
    at the end of their chain, and edges are contracted to these minima, at most half of the nodes. So rounds and
    doublings grow with the logarithm of the nodes and of the longest chain."""
    edges = saved(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "near-dedup-edges")
    labels = None
    while True:
        step = saved(edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to")), "near-dedup-step")
        while True:
            # a minimum points to itself, so every pointer finds the next one
            jumped = step.join(step.select(F.col("u").alias("to"), F.col("to").alias("next")), "to")
            jumped = saved(jumped.select("u", F.col("next").alias("to"), (F.col("to") != F.col("next")).alias("moved")), "near-dedup-step")
            dropped(step)
            step = jumped.select("u", "to")
            if jumped.filter("moved").isEmpty():
                break
        placed = step.select(F.col("u").alias("node"), F.col("to").alias("component"))
        if labels is not None:
            joined = labels.join(step, labels.component == step.u, "left")
            placed = joined.select("node", F.coalesce("to", "component").alias("component"))
        placed = saved(placed, "near-dedup-labels")
        to_v = step.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        contracted = edges.join(step, "u").join(to_v, "v").select(F.col("to").alias("u"), F.col("to_v").alias("v"))
        contracted = saved(contracted.filter("u <> v").distinct(), "near-dedup-edges")
        for old in (edges, step, labels):
            if old is not None:
                dropped(old)
        edges, labels = contracted, placed
        if edges.isEmpty():
            dropped(edges)
            return labels


def near_groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    n_bands, rows = banding(percent)
    signed = saved(in_arrow(docs, lambda it: sign_batches(it, n_bands, rows), SIGNED), "near-dedup-signatures")
    sets = signed.filter("digest is not null and doc_id is not null")
    node_of = saved(sets.groupBy("digest").agg(F.min("doc_id").alias("node")), "near-dedup-nodes")
    nodes = sets.join(node_of.withColumnRenamed("digest", "d"), (F.col("doc_id") == F.col("node")) & (F.col("digest") == F.col("d")))
    nodes = saved(nodes.dropDuplicates(["node", "digest"]).select("node", F.col("n_shingles").alias("n"), "bands", *SKETCHES, *BITMAP), "near-dedup-sketches")
    facts = nodes.select("node", "n", *SKETCHES)

    # buckets with several nodes
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = saved(keys.join(sizes, "key"), "near-dedup-members")

    # star links: one pivot for each bucket
    shared = members.groupBy("node").agg(F.sum("size").alias("shared"))
    pivots = members.join(shared, "node").groupBy("key").agg(F.max(F.struct("shared", (-F.col("node")).alias("minus"))).alias("best"))
    stars = members.join(pivots.select("key", (-F.col("best.minus")).alias("pivot")), "key")
    stars = stars.filter("node <> pivot").select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v")).distinct()
    tested = stars.join(facts.select(F.col("node").alias("u"), F.struct("n", *SKETCHES).alias("a")), "u")
    tested = tested.join(facts.select(F.col("node").alias("v"), F.struct("n", *SKETCHES).alias("b")), "v")
    tested = tested.filter(sizes_fit("a", "b", percent) & bayes_passes("a", "b", percent)).select("u", "v")
    links = verified(saved(tested, "near-dedup-stars"), docs, percent)
    first = components(links)

    # the rest: buckets that still hold several components
    placed = members.join(first, "node", "left").select("key", "band", "node", "size", F.coalesce("component", "node").alias("component"))
    placed = saved(placed, "near-dedup-placed")
    mixed = placed.filter("size > 2").groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    rest = saved(placed.join(mixed, "key"), "near-dedup-rest")
    if not rest.isEmpty():
        rest_nodes = rest.select("node").distinct()
        texts = docs.select(F.col("doc_id").alias("node"), "text").join(rest_nodes, "node", "left_semi")
        owned = (
            in_arrow(texts, shingle_rows, "node long, shingle long")
            .groupBy("shingle")
            .agg(F.min("node").alias("node"), F.max("node").alias("other"))
            .filter("node = other")
            .groupBy("node")
            .agg(F.count(F.lit(1)).alias("own"))
        )
        # a partner shares at most n - own shingles, and the union holds its own set and what only this node has
        side = rest.join(nodes, "node").join(owned, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
        side = side.withColumn("most", (F.col("n") - F.col("own")) * 100 - F.col("own") * percent)
        side = saved(side.filter(F.col("most") * 100 >= F.col("n") * percent * percent), "near-dedup-sides")
        columns = ["key", "band", "bands", "node", "component", "n", "most", *SKETCHES, *BITMAP]
        # a bucket is cut into blocks, and each pair of blocks is a join key of its own
        blocks = side.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        cut = side.select(*columns, F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt")).join(blocks, ["key", "salt"]).withColumn("block", F.pmod(F.hash("node"), "blocks"))
        a = cut.withColumns({"low": F.col("block"), "high": F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))}).alias("a")
        b = cut.withColumns({"high": F.col("block"), "low": F.explode(F.sequence(F.lit(0), F.col("block")))}).alias("b")
        condition = (
            (F.col("a.key") == F.col("b.key"))
            & (F.col("a.low") == F.col("b.low"))
            & (F.col("a.high") == F.col("b.high"))
            & ((F.col("a.low") < F.col("a.high")) | (F.col("a.node") < F.col("b.node")))
            & (F.col("a.component") != F.col("b.component"))
            & (F.col("b.n") * percent <= F.col("a.most"))
            & (F.col("a.n") * percent <= F.col("b.most"))
            & sizes_fit("a", "b", percent)
            & bayes_passes("a", "b", percent)
            & bitmaps_fit("a", "b", percent)
            # the first band in which the two agree makes the pair, not each of them
            & (F.array_position(F.zip_with("a.bands", "b.bands", lambda x, y: x == y), True) == F.col("a.band") + 1)
        )
        pairs = a.join(b, condition).select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()
        more = verified(saved(pairs, "near-dedup-pairs"), docs, percent)
        dropped(first)
        first = components(links.unionByName(more))
        dropped(more)
        dropped(side)
    for done in (links, members, placed, rest, nodes):
        dropped(done)

    placed = node_of.join(first, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    # a null digest meets nothing: documents without words go their own way
    with_sets = sets.select("doc_id", "n_shingles", "digest").join(placed, "digest").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    without = signed.filter("digest is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_sets.unionByName(without).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is kept, with all columns. A row with a null doc_id always stays; of
    rows with one doc_id, all stay or none."""
    gone = near_groups(docs, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
