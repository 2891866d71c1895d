"""The upsert fold with its state in the state store, so that the work of a batch grows with the batch and not with the table.

Two steps follow each other. By id: of the rows of one id the last by place holds; a row that no longer holds is taken back. By title: of all arrived
rows of one title, whether they hold or not, the last decides; it stands in the table as long as it holds for its id. Both steps take rows in any order, so
late files change nothing that later rows have decided. What comes out is a log of changes: +1 puts a row (pos, id, title) into the table, -1 takes it
out. The log is written by the file sink, each batch once, whatever is run again.

A worker asks the state store over a socket, which takes longer than all other work on a row. So keys are dealt by hash over a fixed number of buckets, and a
bucket's state is one value: a batch reads and writes it once for all keys that meet in it, and a bucket without rows isn't touched. A bucket holds one
entry for each of its keys, a few hundred for ten million.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..sources.schemas import PAGE_LOG

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Buckets of keys. Checkpoints hold their state by bucket, so another number needs a new checkpoint.
BUCKETS = 16_384

EVENTS = "title string, id long, pos long, holds boolean, arrived boolean"
CHANGES = "pos long, id long, title string, change int"


class _Bucket(StatefulProcessor):
    """Keeps the entries of a bucket, a dictionary by key, as one JSON text of [key, *values]."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("bucket", "entries string")

    def _entries(self) -> dict[Any, tuple]:
        stored = self._state.get()
        return {key: tuple(values) for key, *values in json.loads(stored[0])} if stored is not None else {}

    def _keep(self, entries: dict[Any, tuple]) -> None:
        self._state.update((json.dumps([[key, *values] for key, values in entries.items()], separators=(",", ":"), ensure_ascii=False),))

    def close(self) -> None:
        pass


class LastOfId(_Bucket):
    """Rows in, events for their titles out: each arrived row with whether it holds for its id, and the row of an earlier batch that no longer does."""

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        entries = self._entries()
        arrived: dict[int, set[tuple[int, str]]] = defaultdict(set)
        for _, i, pos, title in rows:
            arrived[i].add((pos, title))
        moved = False
        for i, some in arrived.items():
            before, last = entries.get(i), max(some)
            newer = before is None or last[0] > before[0]
            for pos, title in some:
                yield Row(title=title, id=i, pos=pos, holds=newer and (pos, title) == last, arrived=True)
            if newer:
                entries[i] = last
                moved = True
                if before is not None:
                    yield Row(title=before[1], id=i, pos=before[0], holds=False, arrived=False)
        if moved:
            self._keep(entries)


class LastOfTitle(_Bucket):
    """Events in, changes of the table out."""

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        entries = self._entries()
        last: dict[str, tuple[int, int, bool]] = {}
        gone: dict[str, set[int]] = defaultdict(set)
        for _, title, i, pos, holds, arrived in rows:
            at = last.setdefault(title, entries.get(title))
            if not arrived:
                gone[title].add(pos)
            elif at is None or pos > at[0]:
                last[title] = (pos, i, holds)
        moved = False
        for title, now in last.items():
            before = entries.get(title)
            stood = before is not None and before[2]
            if now is not None and now[0] in gone[title]:
                now = (now[0], now[1], False)
            if now != before:
                entries[title] = now
                moved = True
            if stood and (now[0] != before[0] or not now[2]):
                yield Row(pos=before[0], id=before[1], title=title, change=-1)
            if now is not None and now[2] and not (stood and now[0] == before[0]):
                yield Row(pos=now[0], id=now[1], title=title, change=1)
        if moved:
            self._keep(entries)


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def changes(log: DataFrame) -> DataFrame:
    """The changes of the table that a stream of log rows (pos, id, title) makes."""
    rows = log.select(_bucket("id"), "id", "pos", "title").groupBy("bucket")
    events = rows.transformWithState(LastOfId(), EVENTS, "Append", "None").select(_bucket("title"), "title", "id", "pos", "holds", "arrived").groupBy("bucket")
    return events.transformWithState(LastOfTitle(), CHANGES, "Append", "None")


def start_state_fold(spark: SparkSession, landing: str, out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Folds the log files (Parquet) in ``landing`` and appends the changes to ``out``; started again, it goes on with new files."""
    log = spark.readStream.schema(PAGE_LOG).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:  # a query takes the settings that hold when it starts
        return changes(log).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    finally:
        spark.conf.set(_PROVIDER, before)


def table_of(spark: SparkSession, out: str) -> DataFrame:
    """(pos, id, title) of the rows that stand after all changes in ``out``."""
    log = spark.read.schema(CHANGES).parquet(out)
    return log.groupBy("pos", "id", "title").agg(F.sum("change").alias("n")).filter("n > 0").select("pos", "id", "title")
