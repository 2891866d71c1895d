"""Exact and near deduplication against brute force."""

import random
import re
from pathlib import Path

import numpy as np
import pytest

from catalink.llm import near_dedup as N
from catalink.llm.common import saved
from catalink.llm.exact_dedup import exact_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        g = groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")]
        keep = min(g)[3]
        out.append((i, keep, len(g), i == keep))
    return out


def test_exact(spark, documents):
    rows = [(1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " "), (7, "ab"), (7, "ab"), (None, "a b  c"), (None, "abc"), (8, "a b"), (9, "é" * 5000), (10, "é" * 5000 + " "), (-5, "neg"), (-9, "neg")]
    key = lambda r: tuple(str(x) for x in r)
    for salts in (32, 2):  # with two salts, the larger groups are hot ones
        got = exact_dedup(documents(rows), salts).collect()
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got], key=key) == sorted(brute_exact(rows), key=key)
    assert exact_dedup(documents([])).count() == 0


def test_exact_with_digest_collisions(spark, documents, monkeypatch):
    """With a digest that everything shares, the content alone decides."""
    from pyspark.sql import functions as F

    from catalink.llm import exact_dedup as E

    monkeypatch.setattr(E.F, "sha2", lambda *_: F.lit("00"))
    rows = [(1, "a"), (2, "b"), (3, "a "), (4, None)]
    got = E.exact_dedup(documents(rows)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_near(rows, percent):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("percent", [85, 80])
def test_near(spark, documents, prose, percent, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7 if percent == 80 else N.BLOCK)  # buckets of many blocks
    draw = random.Random(percent)
    rows = [(i, prose(draw.choice([3, 4, 5, 30, 80]))) for i in range(40)]
    base = prose(120).split()
    for i in range(100, 190):  # a group of near copies, some of which are linked through others only
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(30)}"
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \t"), (203, "One two"), (204, "one  TWO"), (205, rows[3][1])]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_groups(documents(rows), percent).collect()}
    assert got == brute_near(rows, percent)


def test_long_chains(spark, monkeypatch):
    """A chain takes rounds in proportion to the logarithm of its length; what a round leaves behind is deleted."""
    made = []
    monkeypatch.setattr(N, "saved", lambda df, name: made.append(saved(df, name)) or made[-1])
    draw = random.Random(2)
    names = draw.sample(range(10_000, 20_000), 300)
    chains = [(i, i + 1) for i in range(1000)] + list(zip(names, names[1:], strict=False)) + [(30_000, 30_000 + i) for i in range(1, 50)]
    got = {r.node: r.component for r in N.components(spark.createDataFrame(chains, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(1001), 0), **dict.fromkeys(names, min(names)), **dict.fromkeys(range(30_000, 30_050), 30_000)}
    assert len(made) <= 45
    left = [f for df in made for f in df.inputFiles() if Path(f.removeprefix("file://")).exists()]
    assert {f.rsplit("/", 1)[0] for f in left} == {f.rsplit("/", 1)[0] for f in made[-2].inputFiles()}


def test_near_edges(spark, documents):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in N.near_groups(documents(rows)).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
    assert N.near_groups(documents([])).count() == 0
    kept = N.without_near_duplicates(documents(rows))
    assert kept.count() == 3 and kept.columns == documents(rows).columns


def test_thresholds_rise():
    assert N.least_matches(85) == tuple(sorted(N.least_matches(85)))
    assert N.banding(85) == (24, 6)


def test_bitmaps_exclude_no_link(spark):
    """The bitmap bound keeps every pair that reaches the threshold, sets beyond the number of classes included."""
    rng = np.random.default_rng(3)
    columns = ["n", *N.BITMAP]
    rows, linked = [], []
    for size in (1, 5, 60, 700, 6000):
        for share in (0.5, 0.75, 0.8, 0.85, 0.95, 1.0):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = np.concatenate([a[: int(len(a) * share)], rng.integers(0, 2**63, size // 20, dtype=np.uint64)])
            if len(b):
                both = len(np.intersect1d(a, b))
                linked.append(100 * both >= 80 * (len(a) + len(b) - both))
                rows.append(tuple((len(s), *N.occupied(s).tolist()) for s in (a, b)))
    side = "struct<" + ", ".join(f"{c}: bigint" for c in columns) + ">"
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, a {side}, b {side}")
    fits = [r[0] for r in frame.orderBy("i").select(N.bitmaps_fit("a", "b", 80)).collect()]
    assert all(f for f, needed in zip(fits, linked, strict=True) if needed)
    assert not all(fits) and any(linked)
