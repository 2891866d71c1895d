"""What the operators share: the work folder on shared storage, and word hashes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

WHITE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Only where that is unset, as in tests on one machine, a temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not str(spark.sparkContext.master).startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.gettempdir() + "/catalink-work"
    return f"{folder.rstrip('/')}/catalink"


def work_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the work folder and read again: a cut in the lineage that lost executors can't undo."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a frame from ``saved()`` that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if "/catalink/" in path:
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


ARROW_ROWS = 1000
ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with batches of ``ARROW_ROWS`` rows: a batch of Spark's default of 10,000 whole texts
    stands several times in the memory of an executor. A session with another setting keeps it."""
    if df.sparkSession.conf.get(ARROW_SETTING) == "10000":
        df.sparkSession.conf.set(ARROW_SETTING, str(ARROW_ROWS))
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_RANDOM = np.random.default_rng(20260101)
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
SEGMENT = 1 << 18


@functools.lru_cache(maxsize=2)
def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_INVERSE, _BASE):
        powers = np.full(n, base, dtype=np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the inverse base and of the base."""
    down, up = _powers_to(SEGMENT if n <= SEGMENT else n)
    return down[:n], up[:n]


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z lower-cased."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


class Words:
    """The words of a batch of texts: where they start and end in the joined bytes, the text each belongs to, 64-bit hashes.

    Bytes with ``is_word[byte]`` form words; a text never shares a word with its neighbour.
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        self.data = lowered(np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8))
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = is_word[self.data]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        self.start, self.end = edges[0::2], edges[1::2]
        #: word number from which the words of each text begin; one more entry than texts
        self.first = np.searchsorted(self.start, self.text_start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word, the same for the same bytes in any batch.

        A polynomial over the bytes from prefix sums modulo 2**64, made over
        segments so that memory stays bounded."""
        out = np.empty(len(self.start), dtype=np.uint64)
        at = 0
        while at < len(out):
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + SEGMENT, side="right")))
            start, end = self.start[at:to] - base, self.end[at:to] - base
            down, up = _powers(int(end[-1]))
            sums = np.zeros(end[-1] + 1, dtype=np.uint64)
            np.cumsum(_BYTE_VALUE[self.data[base : base + end[-1]]] * down, out=sums[1:])
            out[at:to] = (sums[end] - sums[start]) * up[start] + (end - start).astype(np.uint64)
            at = to
        return _mixed(out)


def batches_of(texts: list[str | None], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts as UTF-8, of about ``most`` bytes each: the place of the first, and the texts. Null is empty."""
    run: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if run and size + len(data) > most:
            yield first, run
            run, size, first = [], 0, i
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def sliced(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in parts of about ``most`` bytes of text, so that a worker turns few into Python values at a time."""
    for batch in batches:
        size = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type):
                size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(np.cumsum(size) // most, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=False):
            yield batch.slice(a, b - a)


def byte_table(words: bool = True, *, separators: tuple[int, ...] = (), keep: str = "") -> np.ndarray:
    """A table of 256 booleans: all bytes but ``separators``; with ``keep``, of ASCII only its characters."""
    out = np.ones(256, dtype=bool)
    if keep:
        out[:128] = False
        out[[ord(c) for c in keep]] = True
    out[list(separators)] = False
    return out if words else ~out


def looked_up(asks: DataFrame, answers: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """``asks`` with the columns of ``answers`` (one row for each value of ``keys``); null where there is none.

    However many rows ask for one key, no task gets them all: ``answers`` first meets the distinct pairs of a key and a value of
    ``spread``, a column of ``asks`` that splits the rows of a key, and ``asks`` then meets the answered pairs."""
    pairs = asks.select(*keys, spread).distinct()
    return asks.join(pairs.join(answers, keys), [*keys, spread], "left")
