"""A streaming source over landed answers of a listing: its offset is the cursor that a load keeps.

A lander writes the answer that a token asked for under ``asked=<token>`` (the first answer under ``asked=^``), as Spark's writers lay out a
partitioned table. The source follows the tokens, a bounded number of answers for a task and of tasks in a batch. Each token is known only from the answer before it, so
this walk is sequential, one answer at a time; it hands out the files of the answers, which executors read and parse. The checkpoint keeps the cursor, so a load that is stopped
goes on where it was.

Defined cases: an answer that isn't there yet ends the batch; a later run goes on with it. A body that isn't JSON raises, unless ``corrupt`` is
``stop``, which treats it as not there. After the last answer nothing comes. A cursor that an earlier progress file names may be
given as ``start``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from . import json_answers

FIRST = "^"
#: Tasks of a batch.
TASKS = 64
#: What Spark's writers escape in the names of partitions, beside control characters.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _folder(token: str) -> str:
    return "asked=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in token)


@dataclass
class _Answers(InputPartition):
    """What a task reads: place, token and file of each answer."""

    files: list[tuple[int, str, str]]


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.start = options["path"], options.get("start") or FIRST
        self.most, self.tasks = int(options.get("answers", "100")), int(options.get("tasks", str(TASKS)))
        self.stop_at_corrupt = options.get("corrupt", "fail") == "stop"
        #: Where the walk is, and the files of the offsets that it has passed since the last commit.
        self.at: dict | None = None
        self.passed: list[tuple[int, str, str]] = []

    def initialOffset(self) -> dict:
        return {"cursor": self.start, "seen": 0}

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def _walk(self, offset: dict, last: int) -> Iterator[tuple[dict, tuple[int, str, str]]]:
        """The offset after each answer, and its place, token and file, up to a number of seen answers."""
        from pyarrow import fs

        system, root = self._system()
        at = dict(offset)
        while at["cursor"] is not None and at["seen"] < last:
            found = system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/{_folder(at['cursor'])}", allow_not_found=True))
            # the last file counts, as after a repeated request
            files = sorted(((f.mtime_ns or 0, f.path) for f in found if f.size and not f.base_name.startswith(("_", "."))), reverse=True)
            if not files:
                return
            try:
                following = json.loads(system.open_input_stream(files[0][1]).read().decode()).get("continue") or {}
            except (ValueError, AttributeError) as error:
                if self.stop_at_corrupt:
                    return
                raise ValueError(f"the answer to {at['cursor']!r} is no listing") from error
            answer = (at["seen"], at["cursor"], files[0][1])
            at = {"cursor": following.get("apcontinue") or following.get("cmcontinue"), "seen": at["seen"] + 1}
            yield at, answer

    def latestOffset(self) -> dict:
        self.at = self.at or self.initialOffset()
        for self.at, answer in self._walk(self.at, self.at["seen"] + self.most * self.tasks):
            self.passed.append(answer)
        return self.at

    def partitions(self, start: dict, end: dict) -> list[_Answers]:
        # a query that goes on plans its last batch again before it asks for more
        if self.at is None:
            self.at = end
        files = [f for f in self.passed if start["seen"] <= f[0] < end["seen"]]
        if len(files) < end["seen"] - start["seen"]:
            files = [f for _, f in self._walk(start, end["seen"])]
        return [_Answers(files[i : i + self.most]) for i in range(0, len(files), self.most)]

    def read(self, partition: _Answers) -> Iterator[tuple[int, str, str]]:
        system, _ = self._system()
        for place, token, file in partition.files:
            yield place, token, system.open_input_stream(file).read().decode()

    def commit(self, end: dict) -> None:
        self.passed = [f for f in self.passed if f[0] >= end["seen"]]


class LandedListing(DataSource):
    """Format ``landed_listing``; options: path, start, answers (of a task), tasks (of a batch), corrupt."""

    @classmethod
    def name(cls) -> str:
        return "landed_listing"

    def schema(self) -> str:
        return "pos long, asked string, body string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def landed(answers: DataFrame, path: str) -> None:
    """Writes answers (asked, body) as a lander does; ``asked`` is null for the first."""
    answers.select(F.coalesce("asked", F.lit(FIRST)).alias("asked"), "body").repartition("asked").write.mode("append").partitionBy("asked").text(path)


def load(spark: SparkSession, path: str, out: str, checkpoint: str, **options: str | int) -> StreamingQuery:
    """Appends (batch, place, id, title) of all answers that are there to ``out``, and stops; started again, it goes on from the cursor."""
    spark.dataSource.register(LandedListing)
    reader = spark.readStream.format("landed_listing").option("path", path)
    for name, value in options.items():
        reader = reader.option(name, str(value))
    rows = json_answers.listing_rows(reader.load())
    query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(out)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def progress(spark: SparkSession, path: str, corrupt: str = "fresh") -> dict | None:
    """What a progress file (one JSON object) holds: None if there is none. A corrupt one counts as none, or raises if ``corrupt`` is ``fail``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    rows = spark.read.text(path, wholetext=True).limit(1).collect()
    try:
        state = json.loads(rows[0].value) if rows else None
    except ValueError as error:
        if corrupt == "fail":
            raise ValueError(f"{path} is no progress file") from error
        return None
    if not isinstance(state, dict):
        if corrupt == "fail":
            raise ValueError(f"{path} is no progress file")
        return None
    return state
