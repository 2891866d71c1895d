"""The upsert fold over arriving log files, resumable from a checkpoint.

A row survives iff no later row shares its id or its title, whenever that row arrives. So the state is the
last row of each id and the last place of each title: two tables that each micro-batch updates by a maximum. A file that
comes late, with places before those already seen, changes nothing that later rows have decided. Every batch writes
versions of its own number: a batch that runs again after a failure overwrites itself, and the version
before the last one is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.work import deleted
from ..sources.schemas import PAGE_LOG


def _last_rows(spark: SparkSession, table: str, version: int) -> DataFrame:
    return spark.read.schema("id long, pos long, title string").parquet(f"{table}/ids/version={version}")


def _last_titles(spark: SparkSession, table: str, version: int) -> DataFrame:
    return spark.read.schema("title string, pos long").parquet(f"{table}/titles/version={version}")


def folded_table(spark: SparkSession, table: str, version: int) -> DataFrame:
    """(pos, id, title) of the rows that have survived all batches up to ``version``."""
    return _last_rows(spark, table, version).join(_last_titles(spark, table, version), ["title", "pos"], "left_semi").select("pos", "id", "title")


def fold_batch(batch: DataFrame, version: int, table: str) -> None:
    """Writes version ``version`` of the state: the one before with the batch folded in."""
    spark = batch.sparkSession
    rows, titles = batch.select("id", "pos", "title"), batch.select("title", "pos")
    if version > 0:
        rows = _last_rows(spark, table, version - 1).unionByName(rows)
        titles = _last_titles(spark, table, version - 1).unionByName(titles)
    last = rows.groupBy("id").agg(F.max(F.struct("pos", "title")).alias("last")).select("id", "last.*")
    last.write.mode("overwrite").parquet(f"{table}/ids/version={version}")
    titles.groupBy("title").agg(F.max("pos").alias("pos")).write.mode("overwrite").parquet(f"{table}/titles/version={version}")
    if version > 1:
        for state in ("ids", "titles"):
            deleted(spark, f"{table}/{state}/version={version - 2}")


def start_fold(spark: SparkSession, landing: str, table: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Folds all log files (Parquet) that are in ``landing``, then stops; started again, it goes on with new ones."""
    log = spark.readStream.schema(PAGE_LOG).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    writer = log.writeStream.foreachBatch(lambda batch, version: fold_batch(batch, version, table))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
