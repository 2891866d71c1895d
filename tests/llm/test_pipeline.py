"""The stages of the corpus pipeline on a small table, each against brute force, and end to end."""

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from catalink.llm import common, temperature_mix, toxicity
from test_exact_and_near import brute_near

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(P.STAGES)


@pytest.fixture(scope="module")
def tables(spark, prose, tmp_path_factory):
    """A folder of tables, with nulls, empty and long texts, repeated rows, and further columns that clash with names in use."""
    folder, draw = tmp_path_factory.mktemp("tables"), random.Random(8)
    item = "Alice has 3 apples and buys 5 km of rope for Bob on day 3 in the old Town hall there"
    rows, toxic = [], {}
    for i in range(240):
        toxic[i] = int(i % 4 == 0)
        rows.append((i, prose(40) + (f" {draw.choice(['mugloth', 'zerkish'])} {draw.choice(['mugloths', 'zerkisher'])}" if toxic[i] else ""), "en", ["big", "big", "big", None, "small"][i % 5], 1))
    base = prose(90)
    rows += [(300 + i, base.replace(base.split()[7 * i + 3], f"edit{i}", 1), None, "big", None) for i in range(6)]
    rows += [(400, f"{prose(20)} {item} {prose(20)}", "en", "big", 1), (401, item.replace("3", "7").replace("Bob", "Dan"), "en", "small", 1)]
    rows += [(500, None, None, None, None), (501, "", "", "", 0), (502, " \n", "en", "small", 2), (503, prose(20_000), "de", "big", 9)]
    rows += [(None, "a null id " + prose(20), "en", "big", 1), (None, item, "en", "big", 1), (600, rows[1][1], "en", "big", 1), (1, rows[1][1], "en", "big", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"mix_hash": F.lit(1), "node": F.lit("x"), "score": F.lit(0.5)})
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def rows_of(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def stored(spark, df):
    return common.saved(df, "test-pipeline")


def test_stages(spark, tables):
    from tokenizers import Tokenizer

    docs = stored(spark, common.table(spark, tables, "documents").select(*P.COLUMNS))
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_records"]

    # toxicity: what the operator scores from 0.5 on goes
    clean = stored(spark, STAGE["toxicity"](spark, docs, tables))
    scores = toxicity.toxicity_scores(docs, common.table(spark, tables, "labels")).collect()
    gone = {r.doc_id for r in scores if r.predicted}
    assert len({i for i in range(0, 240, 4)} - gone) <= 2 and len(gone) < 64
    want = Counter({k: n for k, n in rows_of(docs).items() if k[0] not in gone})
    assert rows_of(clean) == want and clean.columns == list(P.COLUMNS)

    # near duplicates: one of each group, by brute force over all pairs
    unique = stored(spark, STAGE["near_dedup"](spark, clean, tables))
    groups = brute_near(sorted({(k[0], k[1]) for k in want if k[0] is not None}), P.NEAR_PERCENT)
    want = Counter({k: n for k, n in want.items() if k[0] is None or groups[k[0]][2]})
    assert rows_of(unique) == want and sum(300 <= (k[0] or 0) < 306 for k in want) == 1 and not any(k[0] == 600 for k in want)
    assert unique.columns == list(P.COLUMNS)

    # leaks: the planted ones go, by the text of each row
    safe = stored(spark, STAGE["decontamination"](spark, unique, tables))
    want = Counter({k: n for k, n in want.items() if not (k[0] in (400, 401) or k[0] is None and k[1].startswith("Alice"))})
    assert rows_of(safe) == want and any(k[0] is None for k in want) and safe.columns == list(P.COLUMNS)

    # mixing: each row once or more, no source beyond the limit, all in the order of the mixture
    mixed = stored(spark, STAGE["mixing"](spark, safe, tables))
    counts = rows_of(mixed)
    assert counts.keys() == want.keys() and all(counts[k] >= n for k, n in want.items()) and mixed.columns == list(P.COLUMNS)
    tokens = lambda c, s: sum(n * (len((k[1] or "").split()) + 1) for k, n in c.items() if k[3] == s)
    epochs = {s: tokens(counts, s) / tokens(want, s) for s in {k[3] for k in want}}
    assert min(epochs.values()) >= 1 and max(epochs.values()) < P.REPETITION_LIMIT * 1.3
    in_order = temperature_mix.mixed(safe, repetition_limit=P.REPETITION_LIMIT).orderBy(*temperature_mix.ORDER).collect()
    files = sorted({f.removeprefix("file://") for f in mixed.inputFiles()})
    read = [r for f in files for r in spark.read.parquet(f"file://{f}").coalesce(1).collect()]
    assert [(r.doc_id, r.text) for r in read] == [(r.doc_id, r.text) for r in in_order]

    # records: the tokenizer's plain ids with the end id, in that order
    import public_tokenizers

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    index = sorted(STAGE["token_records"](spark, mixed, tables).collect(), key=lambda r: r.start)
    start = 0
    for r, row in zip(index, read, strict=True):
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row.doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)

    # end to end
    whole = P.run(spark, tables)
    key = lambda r: (r.start, r.n_tokens, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, index))


def test_empty_table(spark, tables, tmp_path):
    for name in ("labels", "benchmark"):
        common.table(spark, tables, name).write.parquet(f"{tmp_path}/{name}.parquet")
    common.table(spark, tables, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
    assert not [p for p in Path(tmp_path).iterdir() if p.name not in ("labels.parquet", "benchmark.parquet", "documents.parquet")]
