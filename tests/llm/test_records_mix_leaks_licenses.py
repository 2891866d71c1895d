"""Token records, source mixing, benchmark leaks and licence labels."""

import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalink.llm import license_index as Li
from catalink.llm import temperature_mix as M
from catalink.llm import template_leaks as Le
from catalink.llm import token_records as R

TOKENIZER = Path("/opt/tokenizers/byte_bpe_50k.json")


needs_tokenizer = pytest.mark.skipif(not TOKENIZER.exists(), reason="no tokenizer file")


def crc_of(tokenizer, text):
    return zlib.crc32(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes())


@needs_tokenizer
def test_round_trip(spark, documents, prose, tmp_path):
    """The frames hold what the tokenizer's plain call gives, in order, and an index row finds its frame."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(TOKENIZER))
    odd = ["a  b", "x \n y", "<|endoftext|>", "see <|endoftext|> here", "it's 5,000.", " lead", "trail ", "a\tb c", "é… ", "a, b.", "¿x! 中文 字", "w.\nT u"]
    rows = [(3, None), (1, ""), (-2, "neg"), (None, "null id"), (7, prose(30)), (7, prose(20)), (8, prose(30_000)), *[(20 + i, t) for i, t in enumerate(odd)]]
    path = str(tmp_path / "records")
    got = R.token_records(documents(rows), str(TOKENIZER), path=path, shard_bytes=40_000, special_as_text=False).collect()
    assert {(r.doc_id, r.ids_crc32) for r in got} == {(i, crc_of(tokenizer, t)) for i, t in rows} and len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    # a reader that only has the index fetches a frame by its offset
    r = next(r for r in got if r.doc_id == 8)
    shard = next(Path(path).glob(f"piece={r.piece}/part-{r.shard:05d}*"))
    (_, _, payload), *rest = R.frames(shard.read_bytes()[r.offset : r.offset + r.length])
    assert not rest and R.PAYLOAD.unpack_from(payload)[1] == 8
    assert R.token_records(documents([]), str(TOKENIZER)).count() == 0


@needs_tokenizer
def test_units_give_the_plain_ids():
    """Random strings of letters, digits, signs and all kinds of white space, against the tokenizer's own call."""
    from tokenizers import Tokenizer

    draw = random.Random(5)
    parts = ["a", "B", "é", "'s", "'", ".", ",", "#", "\n", "\n", " ", " ", " ", "7", "-", "\t", "ß", "<|endoftext|>", "日", "Z", "'ll", "Ᲊ", "don't", "\x1c", "\x85", "\xa0", "×", "÷", "з", "🙂"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(20_000)]
    source = TOKENIZER.read_text(encoding="utf-8")
    for special_as_text in (False, True):
        tokenizer = Tokenizer.from_str(source)
        tokenizer.encode_special_tokens = special_as_text
        want = [np.array(e.ids, dtype="<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        encoder = R.Encoder(source, "<u2", special_as_text)
        assert encoder.by_unit
        assert [i for at in range(0, len(texts), 700) for i in encoder.encode(texts[at : at + 700])] == want


@needs_tokenizer
def test_hot_ids_and_given_order(spark, prose, tmp_path):
    """Rows with one doc_id spread over shards, and so do equal rows; frames can follow the order of the files."""
    texts = [prose(200) for _ in range(60)]
    rows = [(None if i % 2 else 5, t) for i, t in enumerate(texts)] + [(9, texts[0])] * 60
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = R.token_records(docs, str(TOKENIZER), shard_bytes=12_000).collect()
    shards = {key: len({r.shard for r in got if r.doc_id == key}) for key in (None, 5, 9)}
    assert len(got) == len(rows) and min(shards.values()) > 2
    ordered = spark.createDataFrame([(100 - i, f"{i} " + prose(50)) for i in range(100)], "doc_id long, text string").coalesce(1)
    ordered.write.parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs"))
    index = R.token_records(read, str(TOKENIZER), shard_bytes=5_000, order=R.file_order(read)).collect()
    assert len({r.shard for r in index}) > 2 and [r.doc_id for r in sorted(index, key=lambda r: r.start)] == [100 - i for i in range(100)]


@needs_tokenizer
def test_shards_of_many_pieces(spark, documents, prose, tmp_path, monkeypatch):
    """However few the shards, their files stay small, and the frames go on over pieces and shards in order."""
    monkeypatch.setattr(R, "MOST_SHARDS", 3)
    path = str(tmp_path / "pieces")
    rows = [(i, prose(1 + i * 7 % 120)) for i in range(300)]
    got = sorted(R.token_records(documents(rows), str(TOKENIZER), path=path, shard_bytes=2_000).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in rows] and len({r.shard for r in got}) <= 3
    assert [(r.shard, r.piece, r.place) for r in got] == sorted((r.shard, r.piece, r.place) for r in got)
    files = list(Path(path).glob("piece=*/part-*"))
    assert len(files) == len({(r.shard, r.piece) for r in got}) > 9
    assert max(f.stat().st_size for f in files) < 2 * 2_000 + 2 * max(r.length for r in got)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_damage_is_seen():
    data = R.frame(1, b"abcd") + b"\n"
    assert [p for *_, p in R.frames(data)] == [R.PAYLOAD.pack(0, 1) + b"abcd"]
    for at in range(len(data) - 1):
        with pytest.raises(Exception):
            list(R.frames(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]))


def mixture(spark, counts):
    rows = [(s * 10_000 + i, "w " * (i % 9), name, s) for s, (name, n) in enumerate(counts) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_block int")


def test_mix_order_brute_force(spark, monkeypatch):
    """Copies and order of a small mixture, from lists of blocks that are taken one after the other."""
    monkeypatch.setattr(M, "BLOCK_GROUP", 3)
    docs = mixture(spark, [("big", 1200), ("mid", 300), (None, 90), ("", 40)])
    docs = docs.unionByName(docs.limit(30))  # repeated rows
    rows = M.mixed(docs, repetition_limit=2.5, block_tokens=150, seed=3).collect()
    epochs: dict = {}
    for r in rows:
        epochs.setdefault((r.source, r.mix_epoch), []).append(r)
    last = {s: max(e for t, e in epochs if t == s) for s, _ in epochs}
    assert max(last.values()) > 1
    whole = {s: epochs[s, 0] for s in last}
    n = docs.groupBy("source").count().collect()
    assert {s: len(r) for s, r in whole.items()} == {r.source: r["count"] for r in n}
    for (source, epoch), taken in epochs.items():
        key = lambda r: (r.mix_order, r.mix_place, r.doc_id)
        if epoch < last[source]:
            assert sorted(r.doc_id for r in taken) == sorted(r.doc_id for r in whole[source])
            continue
        # the part is a beginning of the order that all rows of the source have in this epoch
        order = {r.mix_block: r.mix_order for r in taken}
        cut = max(order, key=order.get)
        for block in order.keys() - {cut}:
            assert sorted(r.doc_id for r in taken if r.mix_block == block) == sorted(r.doc_id for r in whole[source] if r.mix_block == block)
        in_cut = spark.createDataFrame([(r.doc_id, r.text) for r in whole[source] if r.mix_block == cut], "doc_id long, text string")
        in_cut = in_cut.select("doc_id", F.xxhash64(F.lit(3), "doc_id", "text").alias("mix_hash")).select("doc_id", F.xxhash64("mix_hash", F.lit(epoch).cast("int")).alias("place"))
        begin = [r.doc_id for r in in_cut.orderBy("place", "doc_id").collect()]
        got = [r.doc_id for r in sorted((r for r in taken if r.mix_block == cut), key=key)]
        assert got == begin[: len(got)]
    assert len({(r.mix_order, r.mix_place, r.doc_id) for r in rows}) == len({(r.mix_epoch, r.doc_id) for r in rows})


def test_mix_limit(spark):
    docs = mixture(spark, [("big", 3000), ("mid", 800), (None, 300), ("", 150)])
    got = M.mixed(docs, repetition_limit=3.0, block_tokens=500)
    assert got.columns == ["doc_id", "text", "source", *M.ADDED]
    rows = got.groupBy("source").agg(F.sum("mix_tokens").alias("tokens"), F.countDistinct("doc_id").alias("docs"), F.max("mix_epoch").alias("last")).collect()
    natural = {r.source: r.tokens for r in docs.groupBy("source").agg(F.sum(M.tokens_of(F.col("text"))).alias("tokens")).collect()}
    epochs = {r.source: r.tokens / natural[r.source] for r in rows}
    assert {r.source: r.docs for r in rows} == {"big": 3000, "mid": 800, None: 300, "": 150}
    assert abs(epochs["big"] - 1) < 0.01 and abs(epochs[""] - 3) < 0.05 and 1 < epochs["mid"] < epochs[None] < 3
    # no document comes twice more often than another of its source
    spread = got.groupBy("source", "doc_id").count().groupBy("source").agg((F.max("count") - F.min("count")).alias("d"))
    assert all(r.d <= 1 for r in spread.collect())


def test_mix_entropy_and_budget(spark):
    docs = mixture(spark, [("a", 2000), ("b", 500), ("c", 100)])
    totals = docs.groupBy(M.source_key().alias("mix_source")).agg(F.sum(M.tokens_of(F.col("text"))).alias("tokens"))
    t = M.bisected_exponent(totals, 1.0, None)
    n = np.array([r.tokens for r in totals.collect()], dtype=float)
    w = (n / n.sum()) ** t
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-3
    got = M.mixed(docs, target_entropy=1.0, budget=6000, block_tokens=300).groupBy("source").agg(F.sum("mix_tokens").alias("tokens")).collect()
    want = dict(zip([r.mix_source[1:] for r in totals.collect()], w * 6000, strict=True))
    assert all(abs(r.tokens - want[r.source]) <= 10 for r in got)
    assert M.mixed(docs.limit(0), repetition_limit=2.0).count() == 0


ITEM = "Alice has 3 apples and buys 5 km of rope for Bob on day 3 in the old Town hall there"


def test_leaks(spark, documents, prose):
    changed = "Carol has 7 apples and buys 9 km of rope for Dan on day 7 in the old City hall there"
    clashing = "Carol has 7 apples and buys 9 km of rope for Dan on day 8 in the old Carol hall there, Dan, Dan"
    rows = [(1, f"{prose(30)} x {ITEM} y {prose(30)}"), (2, f"so {changed}"), (3, prose(50)), (4, None), (5, ""), (6, ITEM.upper()), (None, ITEM), (7, " ".join(ITEM.split()[:9])), (8, "tiny but whole item here"), (1, "again"), (9, clashing)]
    bench = spark.createDataFrame([(1, ITEM, "x"), (1, ITEM, "y"), (2, "tiny but whole item here", None), (3, "too short", None), (4, None, None), (None, prose(40), None)], "item_id long, text string, node string")
    for most in (2_000_000, 0):
        got = {(r.doc_id, r.item_id): r for r in Le.leaked_items(documents(rows), bench, most_broadcast=most).collect()}
        assert {(1, 1), (2, 1), (None, 1), (8, 2)} <= set(got) and not {3, 4, 5, 7} & {d for d, _ in got}
        assert got[(2, 1)].coverage > 0.9 and got[(2, 1)].conflicts == 0 and got[(2, 1)].changed == 5 and got[(1, 1)].changed == 0
    kept = Le.without_leaks(documents(rows), bench)
    assert {3, 4, 5, 7} <= {r.doc_id for r in kept.collect()} and kept.columns == documents(rows).columns
    assert Le.leaked_items(documents([]), bench).count() == 0
    assert Le.leaked_items(documents(rows), bench.limit(0)).count() == 0


def test_slot_consistency(spark, documents):
    """A template full of slots that meets an item with other values for one value isn't a leak."""
    item = "of 3 and 4 and 3 and 4 and 3 and 4 and 3 and 4 and 3 and 4"
    rows = [(1, item.replace("3", "9")), (2, "of 1 and 2 and 5 and 6 and 7 and 8 and 9 and 10 and 11 and 12")]
    got = Le.leaked_items(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [r.doc_id for r in got] == [1]


def brute_forms(text):
    """The forms of a text of plain words, names, numbers and units, word by word."""
    words, sure, maybe = [], set(), set()
    tokens = text.split()
    for i, token in enumerate(tokens):
        word = token.strip(".,?")
        before = tokens[i - 1] if i else "."
        if word[:1].isupper() and word[1:].islower():
            (sure if before[-1].islower() or before[-1] in ",;" else maybe).add(i)
        if word.isdigit():
            words.append("N")
        elif word in ("km", "kg") and i and tokens[i - 1].isdigit():
            words.append("U")
        else:
            words.append(word.lower())
    names = {words[i] for i in sure}
    as_names = lambda places: tuple("NAME" if i in places else w for i, w in enumerate(words))
    return {as_names(sure | {i for i in maybe if words[i] in names}), as_names(sure), tuple(words)}


def brute_windows(text, sizes):
    return {(form[i : i + s], i) for form in brute_forms(text) for s in sizes for i in range(len(form) - s + 1)}


def test_leaks_brute_force(spark, documents):
    """Windows and coverage of re-parameterised items, all items against all documents."""
    draw = random.Random(9)
    plain = "the of rope cut each long has buys sells to and with more many how parts left over".split()

    def word():
        pick = draw.random()
        return draw.choice(["Tom", "Ana", "Bo"]) if pick < 0.15 else f"{draw.randint(1, 9)} {draw.choice(['km', 'kg', 'of'])}" if pick < 0.35 else draw.choice(plain) + draw.choice(["", "", "", ".", ","])

    items = [(k, " ".join(word() for _ in range(draw.choice([4, 6, 8, 14, 25])))) for k in range(40)]
    swap = {"Tom": "Sue", "Ana": "Tim", "Bo": "Al"}

    def variant(text):
        kind = draw.randrange(3)
        if kind:
            text = re.sub(r"\d", lambda m: str(int(m[0]) % 9 + 1), text)
        if kind == 2:
            text = re.sub("Tom|Ana|Bo", lambda m: swap[m[0]], text)
        words = text.split()
        for _ in range(draw.choice([0, 0, 1, 3])):
            words[draw.randrange(len(words))] = "other"
        return " ".join(words)

    docs = [(i, " ".join([*(word() for _ in range(20)), variant(draw.choice(items)[1]), *(word() for _ in range(20))])) for i in range(80)]
    want = {}
    for k, item in items:
        n = len(item.split())
        if n < Le.LEAST_WORDS:
            continue
        size = min(n, Le.WINDOW)
        own = {(w, at) for w, at in brute_windows(item, [size]) if sum(x not in ("NAME", "N", "U") for x in w) >= Le.LEAST_LITERALS}
        for i, text in docs:
            there = {w for w, _ in brute_windows(text, [size])}
            found = {at for w, at in own if w in there}
            if own and len(found) >= Le.LEAST_COVER * len({at for _, at in own}):
                want[i, k] = (len({at for _, at in own}), len(found))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in Le.leaked_items(documents(docs), bench).collect()}
    assert {p: (r.item_windows, r.found_windows) for p, r in got.items()} == {p: want[p] for p in got}
    # what is found and not given has few literal words and slots that don't agree
    literals = lambda text: len({w.strip(".,") for w in text.split() if w.strip(".,") in plain})
    assert all(literals(dict(items)[k]) < Le.LEAST_WORDS + 3 for _, k in want.keys() - got.keys())
    assert len(got) > 20 and sum(r.slots > 0 and r.changed > 0 for r in got.values()) > 5


def test_windows_of_slots(spark, documents):
    """Runs of numbers meet no item: one row is made for a window with words, none for the others."""
    item = "the sum of 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 is the answer that we look for here"
    rows = [(i, " ".join(map(str, range(i, i + 3000)))) for i in range(20)] + [(100, item.replace("1 2 3", "4 5 6"))]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    windows = Le.item_windows(bench)
    assert windows.count() == 7 and [r.doc_id for r in Le.leaked_items(documents(rows), bench).collect()] == [100]
    both = Le.without_leaks(documents([(None, item), (None, "clean"), (7, item), (7, "clean too")]), bench)
    assert sorted(r.text for r in both.collect()) == ["clean", "clean too"]


def test_licenses(spark, documents, prose):
    rows = [
        (1, None), (2, ""), (3, "CC-BY cc by; All Rights\nReserved. all rights reserved"), (4, "Released under the MIT License."),
        (5, "Licensed under the Apache License, Version 2.0."), (6, "Licensed under CC BY-NC 4.0."), (7, "This work is licensed under the GNU General Public License, version 3."),
        (8, "the MIT building has no license"), (9, prose(500)), (10, "all"), (11, "rights reserved"), (4, "Released under the MIT License."), (None, "cc"), (12, "by"), (13, "général public license general public license"),
        (14, "x " * 200_000 + "all rights reserved"),
    ]
    got = Li.scan_licenses(documents(rows)).collect()
    assert len(got) == len(rows)
    pattern, low = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def base(text):
        words = pattern.findall((text or "").translate(low))
        found = [(k, label) for phrase, label in Li.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in found]
        return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))

    key = lambda r: tuple(map(str, r))
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key) == sorted([(i, *base(t)) for i, t in rows], key=key)
    labels = {r.doc_id: r.labels for r in got}
    assert (labels[4], labels[5], labels[6], labels[7], labels[8]) == ("mit", "apache-2.0", "cc-by,cc-by-nc", "gpl,gpl-3.0", "")
    assert all(0 <= r.score <= 1 for r in got) and Li.scan_licenses(documents([])).count() == 0


def test_positional_votes_brute_force(spark, documents):
    """The labels of the method: every template at every start of a text, word by word, with weights from all documents."""
    draw = random.Random(6)
    filler = "the of and work terms license software use public under version".split()
    texts = []
    for i in range(120):
        words = draw.choice(Li.TEMPLATES)[1].split()
        for _ in range(draw.choice([0, 0, 1, 2, 5])):
            words[draw.randrange(len(words))] = draw.choice(filler)
        texts.append(" ".join([draw.choice(filler) for _ in range(draw.randint(0, 9))] + words + [draw.choice(filler) for _ in range(draw.randint(0, 9))]))
    texts += ["", None, "plain text of no interest"] * 30
    found = [(t or "").split() for t in texts]
    idf = {w: math.log((len(texts) + 1) / (sum(w in f for f in found) + 1)) + 1e-3 for w in Li.vocabulary()}
    want = []
    for words in found:
        labels = {label for phrase, label in Li.BASE.items() if f" {phrase} " in f" {' '.join(words)} "}
        for label, passage, key in Li.TEMPLATES:
            tokens, phrase = passage.split(), key.split()
            at = next(i for i in range(len(tokens)) if tokens[i : i + len(phrase)] == phrase)
            rare = sorted(range(len(tokens)), key=lambda i: (-idf[tokens[i]], i))[: Li.INDEX_WORDS]
            for start in range(-len(tokens), len(words)):
                same = [q for q in range(len(tokens)) if 0 <= start + q < len(words) and words[start + q] == tokens[q]]
                weight = lambda places: sum(idf[tokens[q]] for q in places)
                enough = weight(set(rare) & set(same)) >= Li.LEAST_WEIGHT * weight(rare) and weight(same) >= Li.LEAST_WEIGHT * weight(range(len(tokens)))
                if enough and set(range(at, at + len(phrase))) <= set(same):
                    labels.add(label)
        want.append(",".join(sorted(labels)))
    got = {r.doc_id: r.labels for r in Li.scan_licenses(documents(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) > 10 and sum(not w for w in want[:120]) > 5


def test_whole_licenses(spark, documents, prose):
    """Each whole text is found with other words before, between and in it, and not without a mandatory phrase, in part or shuffled."""
    draw, rows, want = random.Random(8), [], []
    for label, (text, keys) in Li.WHOLE.items():
        clean = Li.plain(text)
        assert all(f" {k} " in f" {clean} " for k in keys)
        held = np.zeros(len(clean.split()), dtype=bool)
        for key in keys:
            at = len(clean[: clean.index(key)].split())
            held[at : at + len(key.split())] = True
        for _ in range(4):
            words = clean.split()
            free = np.flatnonzero(~held).tolist()
            for q in draw.sample(free, len(words) // 12):
                words[q] = "changed"
            words[draw.choice([q for q in free if q and not held[q - 1]])] += " of Some Holder Inc"
            rows.append("# " + prose(40).replace(" ", "\n * ") + "\n * ".join(words).upper() + " " + prose(30))
            want.append({label})
        for key in keys:
            rows.append(clean.replace(key, "other words stand here"))
            want.append(set())
        half, mixed = clean.split(), clean.split()
        draw.shuffle(mixed)
        rows += [" ".join(half[: len(half) // 3]), " ".join(mixed)]
        want += [set(), set()]
    got = {r.doc_id: r for r in Li.scan_licenses(documents(list(enumerate(rows)))).collect()}
    short = {label for label, _, _ in Li.TEMPLATES} | set(Li.BASE.values())
    for i, labels in enumerate(want):
        found = set(got[i].labels.split(",")) - {""}
        if labels:
            assert labels <= found and got[i].score > 0.6, (i, found)
        # the notices inside a text still count: only labels that no notice gives have to be gone
        assert found - labels <= short, (i, found)


def leaks(spark, documents, item, texts):
    """The numbers of the texts that leak the item."""
    got = Le.leaked_items(documents(list(enumerate(texts))), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    return {r.doc_id for r in got}


def test_names_anywhere(spark, documents, prose):
    """A name is one where it opens a sentence, a line or a quotation, and a copy in other letters is a copy."""
    apples = "Tom has five apples. Tom buys three more. How many apples does Tom have?"
    renamed = apples.replace("Tom", "Sam")
    wrapped = renamed.replace("does Sam", "does\nSam").replace(". Sam", ".\nSam")
    texts = [apples, renamed, f"{prose(20)}. {renamed} {prose(20)}", wrapped, apples.lower(), apples.upper(), f'she said: "{renamed}"', "Sam has five apples"]
    assert leaks(spark, documents, apples, texts) == {0, 1, 2, 3, 4, 5, 6}
    # 23 words, eight names
    many = "when Ann met Bob and Cid near Dora the old dog of Emil ran to Finn, so Gus and Hal took it home"
    assert leaks(spark, documents, many, [many.lower(), many.replace(" ", "\n"), many.replace("Ann", "Zoe").replace("Gus", "Max"), prose(23)]) == {0, 1, 2}
    # the first name stays and opens the sentence, the second is another one
    gift = "Tom gives his old red bike to Bob and then walks home. Later on does Tom miss it?"
    assert leaks(spark, documents, gift, [gift.replace("Bob", "Jim").replace("does Tom", "does he")]) == {0}


def test_slots_of_real_leaks(spark, documents):
    """Literal words that show the leak outweigh slots that don't agree, and slots are compared only under windows that meet."""
    pears = "A basket on the table holds 5 apples and 3 pears. How many are in it?"
    assert leaks(spark, documents, pears, [pears.replace("5", "4").replace("3", "4"), pears.replace("3", "5")]) == {0, 1}
    same = pears.replace("3", "2").replace("5", "2")
    assert leaks(spark, documents, same, [same.replace("2", "3", 1).replace("2", "5")]) == {0}
    # few words beside the numbers, and one inserted word that shifts the rest
    numbers = "sum of " + " ".join(str(n) for n in range(11, 51))
    copy = numbers.replace(" 31 ", " 31 x ")
    assert leaks(spark, documents, numbers, [copy, "sum of " + " ".join(["7", "8"] * 20)]) == {0}


@pytest.mark.skipif(not TOKENIZER.exists(), reason="no tokenizer file")
def test_plain_call(spark, prose, tmp_path):
    """The query's ids are those of the plain call, also where a text spells out a special token."""
    from catalink.llm.queries import op3_token_records
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(TOKENIZER))
    rows = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>b c, d.", "<|endoftext|>\n x", "a <|endoftext| > b", prose(50), None]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {(i, zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes())) for i, t in rows}
    got = op3_token_records(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.ids_crc32) for r in got} == want
    assert next(r.n_tokens for r in got if r.doc_id == 0) == len(tokenizer.encode(rows[0][1], add_special_tokens=False).ids) + 1


def test_families_of_items(spark, documents):
    """Items that differ in values alone are met as one: rows grow with documents and families, not with documents times items."""
    names = ["Anna", "Bob", "Carl", "Dora", "Emil"]
    item = lambda i, same=False: f"In the market {names[i % 5]} buys {i + 20} apples and then gives {i + 20 if same else i + 50} of them to {names[(i + 1) % 5]} before going home again."
    items = [(i, item(i)) for i in range(60)] + [(100 + i, item(i, same=True)) for i in range(5)] + [(200, "7 8 9 10 11 12"), (201, "7 8 9 10 11 13"), (None, item(3))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    families = {r.item_id: r.family for r in Le.item_families(bench).collect()}
    assert all(families[i] == 0 for i in range(60)) and all(families[100 + i] == 100 for i in range(5))
    docs = [(i, f"Some words first. {item(i + 7)} And some words after it.") for i in range(40)] + [(90, "nothing of it at all, only prose"), (91, "so 7 8 9 10 11 12 it is")]
    got = Le.leaked_items(documents(docs), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_items) for r in got if r.item_id == 0) == [(i, 0, 61) for i in range(40)]
    assert sorted((r.doc_id, r.item_id, r.n_items) for r in got if r.item_id not in (0, 100)) == [(91, 200, 1)]
    kept = Le.without_leaks(documents(docs), bench)
    assert [r.doc_id for r in kept.collect()] == [90]
