"""Collocations by pivot partitioning: each phrase is counted where its rarest word is.

First pass: all words are counted for each language. Second pass: at each word, a text is cut down to the fragment around it that holds
no rarer word (its n-grams have that word as their pivot), at most four words to each side; words of too few occurrences end
fragments. Equal fragments of a worker become one with a count. Fragments go to the bucket of their pivot, packed; the fragments of a pivot that is
frequent are dealt over several buckets by their content. A bucket counts the n-grams that its fragments' pivots own, level by level, so that each
occurrence is counted once, in one place. N-grams with dealt pivots are added up over buckets; others are whole and are emitted only if frequent.

The order of rarity comes from a table of a fixed size: the frequencies of frequent words, added up by hash. It is broadcast (16 MB, whatever the
corpus is). Any order that all workers share gives the same counts; words that share an entry only make their fragments somewhat longer. Words and n-grams
are known by 64-bit hashes until they are written out; two frequent words with one hash stop the job.

Defined cases: a null text is empty, a null lang is ``und``. Empty texts give nothing; no phrase, no rows. Repeated rows count each. Scores and
ties are exact: quotients of 38-digit decimals. Further columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Words, _mixed, batches_of, byte_table, dropped, in_arrow, looked_up, saved, sliced

#: What splits pieces, and words inside pieces.
PIECE_ENDS = tuple(b".,;:!?\n\x0b\x0c\r")
SPACES = (0x20, 0x09)
LONGEST, LEAST, TOP = 5, 100, 2000
REACH = LONGEST - 1

ENTRIES = 1 << 22
#: Words of a bucket, fragments of one pivot before it is dealt, words and fragments that a worker holds before it passes them on.
BUCKET_WORDS, DEALT, HELD_WORDS, HELD = 2_000_000, 250_000, 400_000, 1_000_000
SALTS = 256

_IS_WORD = byte_table(separators=(*SPACES, *PIECE_ENDS))
_IS_END = np.zeros(256, dtype=bool)
_IS_END[list(PIECE_ENDS)] = True
_ODD = np.random.default_rng(7).integers(1, 2**62, 2 * LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[str]]]:
    """Runs of texts: their words, the ids of the words (hashes of language and word), the text that each is in, and the texts' languages."""
    for batch in sliced(batches):
        langs, texts = (c.to_pylist() for c in batch.columns)
        for first, run in batches_of(texts):
            words = Words(run, _IS_WORD)
            own = langs[first : first + len(run)]
            text_of = np.repeat(np.arange(len(run)), np.diff(words.first))
            salt = np.fromiter(map(_lang_hash, own), dtype=np.uint64, count=len(own))
            yield words, _mixed(words.hashes() + salt[text_of]), text_of, own


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, word, f): the words of a worker with their counts, passed on whenever it holds many."""
    known, counts, names = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, object)

    def rows() -> pa.RecordBatch:
        columns = [pa.array(known.view(np.int64)), pa.array([n[0] for n in names], pa.string()), pa.array([n[1].decode("utf-8", "replace") for n in names], pa.string()), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "lang", "word", "f"])

    for words, ids, text_of, langs in _read(batches):
        own, at, n = np.unique(ids, return_index=True, return_counts=True)
        place = np.searchsorted(known, own)
        old = np.zeros(len(own), dtype=bool)
        inside = place < len(known)
        old[inside] = known[place[inside]] == own[inside]
        counts[place[old]] += n[old]
        new = np.empty(int((~old).sum()), object)
        data = words.data.tobytes() if len(new) else b""
        new[:] = [(langs[text_of[i]], data[words.start[i] : words.end[i]]) for i in at[~old].tolist()]
        known, counts, names = (np.insert(x, place[~old], y) for x, y in ((known, own[~old]), (counts, n[~old]), (names, new)))
        if len(known) > HELD_WORDS:
            yield rows()
            known, counts, names = known[:0], counts[:0], names[:0]
    yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(id, lang, word, f) of all words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    rows = in_arrow(texts, _counted, "id long, lang string, word string, f long")
    both = F.struct("lang", "word")
    rows = rows.groupBy("id").agg(F.sum("f").alias("f"), F.min(both).alias("one"), F.max(both).alias("other"))
    named = F.when(F.col("one") == F.col("other"), F.col("one")).otherwise(F.raise_error(F.lit("two words share a hash: change the bytes' random values")).cast("struct<lang: string, word: string>"))
    return rows.select("id", named.alias("w"), "f").select("id", "w.lang", "w.word", "f")


def rarity(frequent: DataFrame) -> np.ndarray:
    """The table of ENTRIES counts: the occurrences of frequent words by the low bits of their ids; 0 where there is none."""
    entries = frequent.groupBy(F.col("id").bitwiseAND(ENTRIES - 1).cast("int").alias("entry")).agg(F.sum("f").alias("f")).toArrow()
    table = np.zeros(ENTRIES, dtype=np.uint32)
    table[entries["entry"].to_numpy()] = np.minimum(entries["f"].to_numpy(), 2**32 - 1)
    return table


def _fragments(ids: np.ndarray, piece: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word with a fragment: its number, the words of its fragment before and after it, and its frequency by the table.

    Before a pivot stand words that are more frequent, after it words that are as frequent at least: of equal words the first is the pivot."""
    f = table[(ids & np.uint64(ENTRIES - 1)).astype(np.int64)]
    order = f.astype(np.uint64) << np.uint64(32) | ids >> np.uint64(32)
    order[f == 0] = 0
    n = len(ids)
    reach = []
    for side in (-1, 1):
        ok, total = f > 0, np.zeros(n, dtype=np.int64)
        for k in range(1, min(REACH, n - 1) + 1):
            near = np.zeros(n, dtype=bool)
            here, there = (slice(k, n), slice(0, n - k)) if side < 0 else (slice(0, n - k), slice(k, n))
            near[here] = (piece[here] == piece[there]) & (f[there] > 0) & ((order[there] > order[here]) if side < 0 else (order[there] >= order[here]))
            ok = ok & near
            total += ok
        reach.append(total)
    pivots = np.flatnonzero((f > 0) & (reach[0] + reach[1] > 0))
    return pivots, reach[0][pivots], reach[1][pivots], f[pivots]


def _hash_of(ids: np.ndarray, start: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
    """A hash of each run of ``length`` ids from ``start``."""
    out = length.astype(np.uint64) * _ODD[-1]
    for k in range(most):
        some = np.flatnonzero(length > k)
        out[some] += (ids[start[some] + k] + np.uint64(k)) * _ODD[k]
        out[some] ^= out[some] >> np.uint64(29)
    return _mixed(out)


def _router(table, buckets: int):
    """The second pass as a function over batches (lang, text): rows (bucket, fragments)."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for words, ids, _, _ in _read(batches):
            piece = np.cumsum(_IS_END[words.data])[words.start]
            pivots, left, right, f = _fragments(ids, piece, table.value)
            length = left + right + 1
            start = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else length
            at = np.repeat(pivots - left - start, length) + np.arange(int(length.sum()))
            flat = ids[at]
            # the lengths of the two sides tell equal words with other pivots apart
            mark = _mixed(_hash_of(flat, start, length, 2 * REACH + 1) + left.astype(np.uint64))
            held.append((mark, ids[pivots], left, right, f, flat))
            n += len(pivots)
            if n >= HELD:
                yield from _packed(held, buckets)
                held, n = [], 0
        if n:
            yield from _packed(held, buckets)

    return route


def _packed(held: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Equal fragments as one, in order of buckets: a row for each bucket."""
    mark, pivot, left, right, f, flat = (np.concatenate(c) for c in zip(*held, strict=True))
    length = left + right + 1
    start = np.concatenate([[0], np.cumsum(length)[:-1]])
    _, first, count = np.unique(mark, return_index=True, return_counts=True)
    dealt = f[first].astype(np.uint64) // np.uint64(DEALT) + np.uint64(1)
    salt = mark[first] % dealt
    bucket = (_mixed(pivot[first] + salt * _ODD[0]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, count, bucket, dealt = first[order], count[order], bucket[order], dealt[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    out: list[tuple[int, bytes]] = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = first[a:b]
        size = length[own]
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        words = flat[np.repeat(start[own] - begin, size) + np.arange(int(size.sum()))]
        shape = (left[own] * LONGEST + right[own] + (dealt[a:b] > 1) * 32).astype(np.uint8)
        data = b"".join((np.uint32(b - a).tobytes(), shape.tobytes(), count[a:b].astype(np.uint32).tobytes(), words.tobytes()))
        out.append((int(bucket[a]), np.uint32(len(data)).tobytes() + pa.compress(data, codec="zstd", asbytes=True)))
    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([d for _, d in out], pa.binary())], names=["bucket", "fragments"])


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    data = pa.decompress(blob[4:], decompressed_size=int(np.frombuffer(blob[:4], np.uint32)[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(data[:4], np.uint32)[0])
    return np.frombuffer(data, np.uint8, n, 4), np.frombuffer(data[4 + n : 4 + 5 * n], np.uint32), np.frombuffer(data[4 + 5 * n :], np.uint64)


def _mined(group: pa.Table) -> pa.Table:
    """(ids, f) of the n-grams of a bucket that its pivots own: all with dealt pivots, the frequent ones of others.

    Level by level: an occurrence counts only if both n-grams of one word less, so far as they hold the pivot, are frequent."""
    parts = [_unpacked(b) for b in group["fragments"].to_pylist()]
    shape, count, words = (np.concatenate(c) for c in zip(*parts, strict=True))
    dealt = shape >= 32
    left, right = (shape % 32 // LONGEST).astype(np.int64), (shape % 32 % LONGEST).astype(np.int64)
    pivot = np.cumsum(left + right + 1) - right - 1
    count = count.astype(np.int64)
    alive = {(1, 0): np.ones(len(shape), dtype=bool)}
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for n in range(2, LONGEST + 1):
        for before in range(n):
            after = n - 1 - before
            some = (left >= before) & (right >= after)
            if after:
                some &= alive[n - 1, before]
            if before:
                some &= alive[n - 1, before - 1]
            own = np.flatnonzero(some)
            live = alive[n, before] = np.zeros(len(shape), dtype=bool)
            if not len(own):
                continue
            start = pivot[own] - before
            key = _hash_of(words, start, np.full(len(own), n), n)
            order = np.argsort(key)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(key[order])) + 1])
            total = np.add.reduceat(count[own[order]], edges)
            good = (total >= LEAST) | dealt[own[order[edges]]]
            live[own[order]] = np.repeat(good, np.diff(edges, append=len(order)))
            found.append((words[start[order[edges[good]]][:, None] + np.arange(n)], total[good]))
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel().view(np.int64))) for w, _ in found if len(w)]
    totals = [pa.array(t) for w, t in found if len(w)]
    kind = pa.list_(pa.int64())
    return pa.table({"ids": pa.chunked_array(lists, kind), "f": pa.chunked_array(totals, pa.int64())})


def frequent_phrases(docs: DataFrame, frequent: DataFrame, n_words: int) -> DataFrame:
    """(ids, f) of the phrases of 2 to 5 words with at least LEAST occurrences. ``frequent``: (id, f) of the frequent words."""
    table = docs.sparkSession.sparkContext.broadcast(rarity(frequent))
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    packed = in_arrow(texts, _router(table, max(8, n_words // BUCKET_WORDS)), "bucket int, fragments binary")
    mined = packed.groupBy("bucket").applyInArrow(_mined, "ids array<long>, f long")
    return mined.groupBy("ids").agg(F.sum("f").alias("f")).filter(F.col("f") >= LEAST)


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(ids, a, l, r, n, score, lang, phrase, longer_l, longer_r): each phrase with its lowest cut, and whether its two parts of one word less are as rare as it.

    ``words``: (id, lang, word, f, n), n being all words of the language."""
    m = F.size("ids")

    def part(kind: str, k: Column, ids: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), k.cast("int").alias("k"), ids.alias("part"))

    one = F.transform("ids", lambda x, i: part("w", i + 1, F.array(x)))
    # only cuts that leave two words or more on a side ask for a phrase
    inner = F.when(m > 2, F.sequence(F.lit(2), m - 1)).otherwise(F.array().cast("array<int>"))
    heads = F.transform(inner, lambda k: part("l", k, F.slice("ids", 1, k)))
    tails = F.transform(inner, lambda k: part("r", k - 1, F.slice("ids", k, m - k + 1)))
    asks = phrases.select("ids", F.col("f").alias("a"), F.pmod(F.xxhash64("ids"), F.lit(SALTS)).alias("salt"), F.explode(F.concat(one, heads, tails)).alias("p")).select("ids", "a", "salt", "p.*")
    counts = words.select(F.array("id").alias("part"), "f", "lang", "word", "n").unionByName(phrases.select(F.col("ids").alias("part"), "f"), allowMissingColumns=True)
    rows = looked_up(asks, counts, ["part"], "salt")
    cuts = range(1, LONGEST)
    single = [F.max(F.when((F.col("kind") == "w") & (F.col("k") == k), F.col("f"))).alias(f"w{k}") for k in range(1, LONGEST + 1)]
    sides = [F.max(F.when((F.col("kind") == s) & (F.col("k") == k), F.col("f"))).alias(f"{s}{k}") for s in "lr" for k in cuts]
    spelt = F.sort_array(F.collect_list(F.when(F.col("kind") == "w", F.struct("k", "word"))))
    rows = rows.groupBy("ids").agg(F.max("a").alias("a"), F.max("lang").alias("lang"), F.max("n").alias("n"), spelt.alias("spelt"), *single, *sides)
    last = F.element_at(F.array(*[F.col(f"w{k}") for k in range(1, LONGEST + 1)]), m)
    options = []
    for k in cuts:
        left, right = F.col("w1") if k == 1 else F.col(f"l{k}"), F.when(m == k + 1, last).otherwise(F.col(f"r{k}"))
        options.append(F.when(m > k, F.struct(left.alias("l"), right.alias("r"), F.lit(k).alias("k"))))
    rows = rows.withColumn("options", F.array_compact(F.array(*options)))
    wide = "decimal(19, 0)"
    scores = F.expr(
        f"array_min(transform(options, o -> struct((cast(a * 1000 as {wide}) * cast(n as {wide})) div (cast(o.l as {wide}) * cast(o.r as {wide})) as score, o.k as k, o.l as l, o.r as r)))"
    )
    ends = F.element_at("options", -1)["l"], F.element_at("options", 1)["r"]
    return rows.select(
        "ids", "a", "lang", "n", F.array_join(F.col("spelt.word"), " ").alias("phrase"), scores.alias("cut"), ((m > 2) & (ends[0] == F.col("a"))).alias("head_in"), ((m > 2) & (ends[1] == F.col("a"))).alias("tail_in")
    ).select("ids", "a", "lang", "n", "phrase", "cut.l", "cut.r", "cut.score", "head_in", "tail_in")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase that stands inside one of two words more with as many occurrences also stands inside one of one word more with as many, so only
    the phrases' parts of one word less are looked at to drop those."""
    counts = saved(word_counts(docs), "phrase-words")
    totals = saved(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    n_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = counts.filter(F.col("f") >= LEAST).withColumn("salt", F.pmod("id", F.lit(SALTS)))
    words = saved(looked_up(common, totals, ["lang"], "salt").drop("salt"), "phrase-frequent")
    dropped(counts)
    phrases = saved(frequent_phrases(docs, words, n_words), "phrase-counts")
    scored = saved(_scored(phrases, words), "phrase-scores")
    m = F.size("ids")
    inside = scored.filter("head_in").select(F.slice("ids", 1, m - 1).alias("ids")).unionByName(scored.filter("tail_in").select(F.slice("ids", 2, m - 1).alias("ids")))
    left = scored.join(inside.distinct(), "ids", "left_anti").withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)))
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for by in (["lang", "salt"], ["lang"]):
        left = left.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best_first))).filter(F.col("rank") <= top)
    return left.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
