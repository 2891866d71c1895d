"""The corpus pipeline: five stages, each an operator of catalink.llm on all that the stage before kept.

Toxic documents go, one document of each group of near duplicates stays,
documents that leak benchmark items go, sources are mixed to temperature
weights, and the mixed documents are written as token records, in the order of the mixture. All stages but
the last return the columns of ``documents``; every stage reads the Parquet
that the one before wrote.

Defined cases, in every stage: a null or empty text is clean, is no near duplicate, leaks nothing, counts one token in the mixture and
gives the end id alone. A row with a null doc_id is never a near duplicate. Of rows with one doc_id all stay or none as near duplicates;
toxicity and leaks are judged by the text of each row. Equal rows meet one fate, and the mixture repeats each of them. A null source is
a source of its own. An empty table stays empty. Further columns of the table are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.llm import common, near_dedup, temperature_mix, template_leaks, token_records, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REPETITION_LIMIT = 1.5
NEAR_PERCENT = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5. The model learns from the labelled documents of the table."""
    labels = common.table(spark, sf_dir, "labels")
    weights, intercept = toxicity.toxicity_model(common.table(spark, sf_dir, "documents"), labels)
    return toxicity.without_toxic(docs, weights, intercept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    return near_dedup.without_near_duplicates(docs, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return template_leaks.without_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture takes them, once or more each, in the order of the mixture over all files."""
    mixed = temperature_mix.mixed(docs, repetition_limit=REPETITION_LIMIT)
    return mixed.orderBy(*temperature_mix.ORDER).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the written token records, which follow the order of the files of ``docs``."""
    import public_tokenizers

    order = token_records.file_order(docs)
    return token_records.token_records(docs, str(public_tokenizers.path("byte_bpe_50k.json")), special_as_text=False, order=order)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_records", write_tokens),
]

#: SQL can't express the trained classifier or the token records; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the work folder and read again."""
    docs = common.table(spark, sf_dir, "documents").select(*(F.col(c) for c in COLUMNS))
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
