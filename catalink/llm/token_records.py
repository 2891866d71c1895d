"""Token ids as length-delimited binary records, with a separate offset index.

Every document becomes one frame of a shard file:

    length of the payload, unsigned 64 bits
    masked checksum of those 8 bytes, unsigned 32 bits
    payload
    masked checksum of the payload, unsigned 32 bits
    one byte 0x0A that closes the frame

Payload: one byte of flags (1: doc_id is null), doc_id as signed 64 bits, then
the ids, 16 bits each if the vocabulary fits, else 32 bits. All numbers are
little-endian. The checksum is CRC-32, rotated and offset by a constant
("masked"), so that a checksum of data that holds checksums stays sound.
Frames stand in ascending order of doc_id over the shards, or in
the order of columns that the caller names (``file_order``: as the files have the rows). A shard has
one file or more, its pieces: ``piece=<number>/part-<shard>...``.

The frames go through Spark's text writer (the closing byte is its line
separator) and come back through its binary reader, so any store that Spark
reaches can hold them, and committed shards survive lost executors. The index
is made from the files: a row for each frame with shard, piece, byte offset in its file and
length, so that a reader can fetch frames in any order.

Defined cases: a null or empty text has the end id alone. Of rows with one
doc_id, the order follows a hash of the text, then the input partition, and these bound
a shard too: rows with one doc_id, null among them, spread over shards, and so do equal rows, by their
input partitions. A null doc_id comes first. An empty table writes no frame. Further columns of the
input are ignored. A piece is read as one value, so it stays below 2 GB: a text may have up to 1 GB.
"""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from .common import in_arrow, saved, sliced, work_path

HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<Bq")
TAIL = struct.Struct("<I")
MASK = 0xA282EAD8  # fixed value of the masking rule

KNOWN_UNITS = 150_000
"""Units of a generation: a worker keeps the ids of at most two generations of units and encodes others again."""
LONGEST_KNOWN = 40
"""Longer units aren't kept, so that texts without spaces don't fill a worker's memory."""
BATCH_CHARS = 1 << 21
"""Text that is encoded at a time; its units are encoded once."""

# classes of bytes; an odd byte makes its whole word one unit
_LETTER, _DIGIT, _SIGN, _SPACE, _FEED, _ODD = range(1, 7)
_CLASS = np.full(256, _ODD, dtype=np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCB), 0xD0, 0xD1]] = _LETTER  # the leads of U+00C0 to U+02BF, U+0400 to U+047F
_CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[ord("'")] = _DIGIT, _SPACE, _FEED, _ODD
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_OTHER_WHITE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def masked(data: bytes) -> int:
    """CRC-32 rotated right by 15 bits, plus a constant."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    payload = PAYLOAD.pack(doc_id is None, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked(size)), payload, TAIL.pack(masked(payload))))


def frames(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, payload) of each frame of a shard; raises on a damaged one."""
    at = 0
    while at < len(content):
        size, check = HEAD.unpack_from(content, at)
        if masked(content[at : at + 8]) != check:
            raise ValueError(f"damaged length at byte {at}")
        start = at + HEAD.size
        payload = content[start : start + size]
        if len(payload) != size or TAIL.unpack_from(content, start + size)[0] != masked(payload):
            raise ValueError(f"damaged payload at byte {start}")
        end = start + size + TAIL.size + 1
        yield at, end - at, payload
        at = end


def index_rows(shard: int, piece: int, content: bytes, width: str) -> Iterator[tuple]:
    """The rows of the index that the bytes of a piece of a shard give."""
    before = 0
    for place, (offset, length, payload) in enumerate(frames(content)):
        null, doc_id = PAYLOAD.unpack_from(payload)
        ids = np.frombuffer(payload, dtype=width, offset=PAYLOAD.size)
        crc = zlib.crc32(ids.astype("<u4", copy=False).tobytes())
        yield shard, piece, place, None if null else doc_id, offset, length, len(ids), before, crc
        before += len(ids)


def runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``BATCH_CHARS`` characters."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


class Encoder:
    """Ids of whole texts.

    A byte-level tokenizer cuts a text into units before it merges: runs of letters, of digits or of signs, each with the
    space before it, and line feeds. Units are found over all bytes of a batch, and each distinct one is encoded once,
    by the same merges without the search for cuts. A word with other bytes (apostrophes, tabs, other scripts) is one
    unit that goes through as it is; so does a whole text with a run of white space or the content of an added token.

    Ids of units are remembered for the generation at hand and the one before it: frequent ones stay, memory is bounded."""

    def __init__(self, tokenizer_json: str, width: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = special_as_text
        self.width, self.size = width, np.dtype(width).itemsize
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        config = json.loads(tokenizer_json)
        cuts = config.get("pre_tokenizer") or {}
        self.by_unit = config.get("normalizer") is None and cuts.get("type") == "ByteLevel" and cuts.get("use_regex") and not cuts.get("add_prefix_space")
        if self.by_unit:
            # the character that stands for each byte, as the library has it
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            shown = {b: c for char in map(chr, range(0x800)) for b, c in zip(char.encode(), level.pre_tokenize_str(char)[0][0], strict=True)}
            self.shown = "".join(shown.get(b, "\ufffd") for b in range(256))
            self.feed = self._raw(self.tokenizer, ["\n"])[0]
            config |= {"pre_tokenizer": {"type": "Split", "pattern": {"String": self.shown[10]}, "behavior": "Isolated", "invert": False}, "added_tokens": [], "post_processor": None}
            self.merges = Tokenizer.from_str(json.dumps(config))
            self.by_unit = len(self.feed) == self.size

    def _raw(self, tokenizer, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.width).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_unit:
            return self._raw(self.tokenizer, texts)
        data = [t.encode("utf-8") for t in texts]
        whole = np.zeros(len(texts), dtype=bool)
        joined = b"".join(data)
        start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))])
        if any(mark in joined for mark in (b"\xc2", b"\xe1", b"\xe2", b"\xe3")):
            whole |= [bool(_OTHER_WHITE.search(t)) for t in texts]
        for content in self.added:
            if content in joined:
                whole |= [content in d for d in data]
        values = np.frombuffer(joined, dtype=np.uint8)
        white = _WHITE[values]
        runs_of_white = np.flatnonzero(white[1:] & white[:-1]) + 1
        owners = np.searchsorted(start, runs_of_white, side="right") - 1
        whole[owners[start[owners] != runs_of_white]] = True
        out: list[bytes | None] = [None] * len(texts)
        at = np.flatnonzero(whole).tolist()
        for i, ids in zip(at, self._raw(self.tokenizer, [texts[i] for i in at]), strict=True):
            out[i] = ids
        rest = np.flatnonzero(~whole).tolist()
        if at:
            return self._with(out, rest, self._by_unit([data[i] for i in rest]))
        return self._by_unit(data)

    @staticmethod
    def _with(out: list, places: list[int], found: list[bytes]) -> list[bytes]:
        for i, ids in zip(places, found, strict=True):
            out[i] = ids
        return out

    def _by_unit(self, data: list[bytes]) -> list[bytes]:
        joined = b"".join(data)
        if not joined:
            return [b""] * len(data)
        start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))])
        values = np.frombuffer(joined, dtype=np.uint8)
        kind = _CLASS[values]
        kind[:-1][(values[:-1] == 0xC3) & ((values[1:] | 0x20) == 0xB7)] = _ODD  # the signs of multiplication and division
        before = np.concatenate([[_FEED], kind[:-1]]).astype(np.uint8)
        word = (kind == _SPACE) | (kind == _FEED) | (before == _FEED)
        word[start[:-1][start[:-1] < len(values)]] = True
        cut = word | ((kind != before) & (before != _SPACE))
        odd = np.flatnonzero(kind == _ODD)
        first = np.flatnonzero(word)
        odd_words = np.unique(np.searchsorted(first, odd, side="right") - 1)
        bounds = np.append(first, len(values))
        for a, b in zip(bounds[odd_words].tolist(), bounds[odd_words + 1].tolist(), strict=True):
            cut[a + 1 : b] = False
        offsets = np.append(np.flatnonzero(cut), len(values)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        index = units.indices.to_numpy()
        odd_units = np.zeros(len(units.dictionary), dtype=bool)
        odd_units[index[np.searchsorted(offsets, bounds[odd_words])]] = True
        found = self._ids(units.dictionary.to_pylist(), odd_units.tolist())
        # the ids of the distinct units one after the other, then those of each unit in its place
        ids = np.frombuffer(b"".join(found), dtype=self.width)
        sizes = np.fromiter(map(len, found), dtype=np.int32, count=len(found)) // self.size
        ends = np.cumsum(sizes, dtype=np.int32)
        n = sizes[index]
        stops = np.cumsum(n, dtype=np.int64)
        flat = ids[np.arange(stops[-1]) + np.repeat(ends[index] - stops, n)].tobytes()
        bytes_at = (np.concatenate([[0], stops])[np.searchsorted(offsets, start)] * self.size).tolist()
        return [flat[a:b] for a, b in zip(bytes_at[:-1], bytes_at[1:], strict=True)]

    def _ids(self, units: list[bytes], odd: list[bool]) -> list[bytes]:
        found = list(map(self.recent.get, units))
        missed = [i for i, ids in enumerate(found) if ids is None]
        fresh = []
        for i in missed:
            found[i] = self.older.get(units[i])
            if found[i] is None:
                fresh.append(i)
        self._with(found, fresh, self._fresh([units[i] for i in fresh], [odd[i] for i in fresh]))
        self.recent.update((units[i], found[i]) for i in missed if len(units[i]) <= LONGEST_KNOWN)
        if len(self.recent) > KNOWN_UNITS:
            self.recent, self.older = {}, self.recent
        return found

    def _fresh(self, units: list[bytes], odd: list[bool]) -> list[bytes]:
        """Ids of units: odd ones as they are, the others as lines of common texts, as the line feed is a token of its own."""
        out: list[bytes] = [self.feed] * len(units)
        alone = [i for i, o in enumerate(odd) if o]
        self._with(out, alone, self._raw(self.tokenizer, [units[i].decode("utf-8") for i in alone]))
        lines = [i for i, o in enumerate(odd) if not o and units[i] != b"\n"]
        feed = np.frombuffer(self.feed, dtype=self.width)
        for at in range(0, len(lines), 256):
            group = lines[at : at + 256]
            text = codecs.charmap_decode(b"\n".join([units[i] for i in group]), "strict", self.shown)[0]
            ids = self._raw(self.merges, [text])[0]
            ends = (np.flatnonzero(np.frombuffer(ids, dtype=self.width) == feed) * self.size).tolist()
            begin = 0
            for i, end in zip(group, [*ends, len(ids)], strict=True):
                out[i] = ids[begin:end]
                begin = end + self.size
        return out


@functools.lru_cache(maxsize=1)
def encoder(tokenizer_json: str, width: str, special_as_text: bool) -> Encoder:
    """The encoder of this worker: later tasks find it with the units that it knows."""
    return Encoder(tokenizer_json, width, special_as_text)


def file_order(docs: DataFrame) -> list[Column]:
    """What orders the rows of a frame that is read from Parquet files as the writer of these had them: the part and
    the place in it. Nothing for other frames."""
    name = F.col("_metadata.file_name")
    order = [F.length(F.regexp_extract(name, r"^part-\d+", 0)), name, F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return []
    return order


def write_records(
    docs: DataFrame, path: str, tokenizer_json: str, end_id: int, vocabulary: int, shard_bytes: int = 8 << 20, special_as_text: bool = True, order: Sequence[Column] = ()
) -> None:
    """Writes the frames of ``docs`` (doc_id, text) to the folder ``path``, in shards of about ``shard_bytes`` of text, but
    no more than ``MOST_SHARDS``. A shard is a partition; its files, the pieces, end at the latest with the frame that
    fills ``2 * shard_bytes``, so files stay small enough to be read whole, however much the shards hold.

    ``order``: what the frames are ordered by, before doc_id, a hash of the text and the input partition."""
    spark = docs.sparkSession
    width = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    source = spark.sparkContext.broadcast(tokenizer_json)
    end = np.array([end_id], dtype=width).tobytes()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(max(1, -(-total // shard_bytes)), MOST_SHARDS)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, written, done = encoder(source.value, width, special_as_text), 0, 0
        for batch in sliced(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, to in runs(texts):
                rows = zip(ids[at:to], known.encode([t or "" for t in texts[at:to]]), strict=True)
                framed = [frame(i, body + end) for i, body in rows]
                ends = written + np.cumsum([len(f) for f in framed])
                pieces = np.append(written, ends[:-1]) // (2 * shard_bytes)
                columns = [pa.array(pieces, pa.int32()), pa.array(range(done, done + len(framed)), pa.int64()), pa.array(framed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "place", "frame"])
                written, done = int(ends[-1]), done + len(framed)

    keys = {f"key_{i}": c for i, c in enumerate([*order, F.col("doc_id"), F.xxhash64("text"), F.spark_partition_id()])}
    rows = docs.select("doc_id", "text", *[c.alias(k) for k, c in keys.items()])
    rows = rows.repartitionByRange(int(shards), *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    # the order is there already; said again, so that the writer, which wants the pieces of a shard in order, needn't sort by these alone
    framed = in_arrow(rows, encoded, "piece int, place long, frame binary").sortWithinPartitions("piece", "place")
    framed.select("piece", F.col("frame").cast("string").alias("value")).write.partitionBy("piece").option("lineSep", "\n").text(path)


MOST_SHARDS = 20_000
"""More partitions than this are a burden to the driver; at 100 TB a shard has 5 GB of text."""
INDEX = "shard int, piece int, place long, doc_id long, offset long, length long, n_tokens long, before long, ids_crc32 long"


def read_index(spark: SparkSession, path: str, vocabulary: int, end_id: int) -> DataFrame:
    """A row for each frame of the shards in ``path``, read and verified from the files: shard, piece of it, place in the piece,
    doc_id, offset and length in bytes, n_tokens, ids before it in the piece, CRC-32 of its ids as 32-bit integers."""
    width = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                piece, shard = re.search(r"piece=(\d+)/part-(\d+)[^/]*$", name).groups()
                rows = list(index_rows(int(shard), int(piece), content.as_py(), width))
                if rows:
                    types = [pa.int32()] * 2 + [pa.int64()] * 7
                    names = [c.split()[0] for c in INDEX.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").load(path)
    return in_arrow(files.filter("length > 0").select("path", "content"), parsed, INDEX)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: the ids of all frames before, over all shards.

    Prefix sums run over the pieces of each shard, and over the shards, of which there are ``MOST_SHARDS`` at most."""

    def before(column: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    pieces = index.groupBy("shard", "piece").agg(F.sum("n_tokens").alias("in_piece"))
    shards = pieces.groupBy("shard").agg(F.sum("in_piece").alias("in_shard"))
    shards = shards.select("shard", before("in_shard", Window.orderBy("shard")).alias("shard_base"))
    bases = pieces.select("shard", "piece", before("in_piece", Window.partitionBy("shard").orderBy("piece")).alias("base"))
    bases = bases.join(shards, "shard").select("shard", "piece", (F.col("base") + F.col("shard_base")).alias("base"))
    return index.join(bases, ["shard", "piece"]).withColumn("start", F.col("base") + F.col("before")).drop("base")


def token_records(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None, shard_bytes: int = 8 << 20, special_as_text: bool = True, order: Sequence[Column] = ()) -> DataFrame:
    """Writes ``docs`` as records to ``path`` (default: the work folder), their index beside it, and returns the
    index with starts: doc_id, start, n_tokens, ids_crc32, shard, piece, place, offset, length.

    ``special_as_text``: whether special tokens that a text spells out are encoded like any other characters. Without
    it the ids are those of the tokenizer's plain call, which the registered queries give. ``order``: see ``write_records``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    text = Path(tokenizer_path).read_text(encoding="utf-8")
    vocabulary = Tokenizer.from_str(text).get_vocab_size(with_added_tokens=True)
    path = path or work_path(spark, "token-records")
    write_records(docs, path, text, end_id, vocabulary, shard_bytes, special_as_text, order)
    index = saved(read_index(spark, path, vocabulary, end_id), "token-index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "piece", "place", "offset", "length")
