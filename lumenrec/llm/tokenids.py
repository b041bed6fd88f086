"""Token ids in binary files: one id array a file, document boundaries in Elias-Fano code.

File: ``IDEF0001``; little-endian header (bytes per id, number of documents with a null id, documents,
ids, first doc_id, and the two Elias-Fano headers); the ids; the ends of the documents; the doc_ids less
the first one. Both sequences never fall, so each takes 2 + log2(range / documents) bits a document.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm import subwords
from lumenrec.llm.common import new_scratch, read, width
from lumenrec.llm.subwords import TOKENIZER

END_ID = 0
#: Ids after which a file is closed (at the end of a document).
FILE_IDS = 4 << 20
#: Ids that a reader holds at once.
READ_IDS = 1 << 20
_MAGIC = b"IDEF0001"
_HEAD = struct.Struct("<BQQQq")
_PART = struct.Struct("<QBQQ")
_STEP = 512  # ones between two select samples


@dataclass(frozen=True)
class EliasFano:
    """A sequence that never falls: ``low`` bits of each value as they are, the rest in unary.

    The unary part has one 1 bit per value, at its high part plus its index. ``select`` starts at the
    nearest sampled one, counts whole words and finishes within a word.
    """

    n: int
    low_bits: int
    low: np.ndarray  # packed bits
    high: np.ndarray  # 64-bit words
    samples: np.ndarray  # position of every _STEP-th one, 32 bits each while they suffice

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        marks = np.zeros(-(-(int(place[-1]) + 1) // 64) * 64 if n else 0, np.uint8)
        marks[place] = 1
        high = np.packbits(marks, bitorder="little").view("<u8")
        if bits:
            spread = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(spread.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        return cls(n, bits, low, high, cls.sampled(high))

    @staticmethod
    def sampled(high: np.ndarray) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(high.view(np.uint8), bitorder="little"))[::_STEP]
        return ones.astype("<u4" if not len(ones) or ones[-1] < 1 << 32 else "<u8")

    def select(self, k: int) -> int:
        """Value number ``k``, from its own low bits and one short scan of the unary part."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        at = int(self.samples[k // _STEP])
        left = k % _STEP
        word = int(self.high[at >> 6]) >> (at & 63) << (at & 63)
        at >>= 6
        while (ones := word.bit_count()) <= left:
            left -= ones
            at += 1
            word = int(self.high[at])
        for _ in range(left):
            word &= word - 1
        place = (at << 6) + (word & -word).bit_length() - 1
        return (place - k) << self.low_bits | self._low(k)

    def _low(self, k: int) -> int:
        start = k * self.low_bits
        stop = start + self.low_bits
        part = int.from_bytes(self.low[start >> 3 : (stop + 7) >> 3].tobytes(), "little")
        return part >> (start & 7) & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        place = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        out = (place - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            out += bits.astype(np.int64) @ (1 << np.arange(self.low_bits))
        return out

    def pack(self) -> bytes:
        return _PART.pack(self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def unpack(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, bits, n_low, n_high = _PART.unpack_from(data, at)
        at += _PART.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, "<u8", n_high, at + n_low)
        return cls(n, bits, low, high, cls.sampled(high)), at + n_low + 8 * n_high


def to_file(ids: bytes, kind: np.dtype, ends: list[int], doc_ids: list[int | None]) -> bytes:
    """A file's bytes. ``doc_ids`` ascend, nulls first; ``ends`` are the documents' ends in the array."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    first = int(known[0]) if len(known) else 0
    head = _HEAD.pack(kind.itemsize, nulls, len(ends), len(ids) // kind.itemsize, first)
    away = known.astype(np.uint64) - np.uint64(first % (1 << 64))  # modulo 2^64: right for any two ids
    return b"".join([_MAGIC, head, ids, EliasFano.of(np.array(ends, np.uint64)).pack(), EliasFano.of(away).pack()])


@dataclass(frozen=True)
class IdFile:
    """An open file of ids: document ends and doc_ids (None for null) are read, the ids when asked for."""

    source: pa.NativeFile  # open for random access
    at: int  # where the ids start
    kind: np.dtype
    total: int
    ends: EliasFano
    doc_ids: list[int | None]

    @classmethod
    def of(cls, source) -> IdFile:
        """``source``: an open file, or a file's bytes."""
        source = pa.BufferReader(source) if isinstance(source, bytes) else source
        at = len(_MAGIC) + _HEAD.size
        head = bytes(source.read_at(at, 0))
        if head[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not an id file")
        size, nulls, n, total, first = _HEAD.unpack_from(head, len(_MAGIC))
        rest = at + size * total
        tail = memoryview(source.read_at(source.size() - rest, rest))
        ends, after = EliasFano.unpack(tail, 0)
        away, _ = EliasFano.unpack(tail, after)
        known = (away.values().astype(np.uint64) + np.uint64(first % (1 << 64))).view(np.int64)
        return cls(source, at, np.dtype(f"<u{size}"), total, ends, [None] * nulls + known.tolist())

    @property
    def ids(self) -> np.ndarray:
        """All ids of the file."""
        return self.part(0, self.total)

    def part(self, start: int, stop: int) -> np.ndarray:
        """Ids number ``start`` to ``stop`` of the file."""
        size = self.kind.itemsize
        return np.frombuffer(self.source.read_at((stop - start) * size, self.at + start * size), self.kind)

    def document(self, k: int) -> np.ndarray:
        """Ids of document ``k``, by two select calls and one read."""
        return self.part(self.ends.select(k - 1) if k else 0, self.ends.select(k))

    def checksums(self, most: int) -> Iterator[tuple[int, int, list[int]]]:
        """Documents ``a`` to ``b`` and the crc32 of the ids of each, holding at most ``most`` ids at once."""
        ends = self.ends.values()
        a = 0
        while a < len(ends):
            start = int(ends[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(ends, start + most, "right")))
            if ends[a] - start > most:
                crc = 0
                for at in range(start, int(ends[a]), most):
                    crc = zlib.crc32(self.part(at, min(at + most, int(ends[a]))).astype("<u4"), crc)
                yield a, a + 1, [crc]
                a += 1
                continue
            ids = self.part(start, int(ends[b - 1])).astype("<u4")
            cuts = [0, *(ends[a:b] - start).tolist()]
            yield a, b, [zlib.crc32(ids[x:y]) for x, y in zip(cuts, cuts[1:])]
            a = b


def put(uri: str, data: bytes) -> None:
    """Write a file of any file system that pyarrow knows, whole or not at all; a repeated task writes
    the same file again."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    folder, _, name = path.rpartition("/")
    where.create_dir(folder, recursive=True)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with where.open_output_stream(aside) as out:
        out.write(data)
    try:
        where.move(aside, path)
    except OSError:
        if where.get_file_info(path).type != fs.FileType.File:
            raise
        where.delete_file(aside)


def write_ids(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode all documents into id files under ``folder``; (file, n_docs, n_ids) of each, lazily.

    Documents are dealt to ranges of doc_id (nulls first, then by a hash of the text, so that even one
    id's rows are spread), and each task writes its range in order, a file for every ``file_ids`` ids.
    File names sort in the order of their documents. Texts that are null are empty: an end id alone.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = subwords.encoder(tokenizer)
        shard, number = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], encoder.kind).tobytes()
        ids, ends, doc_ids, total = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, ends, doc_ids, total, number
            name = f"part-{shard:06d}-{number:06d}.ids"
            put(f"{folder}/{name}", to_file(b"".join(ids), encoder.kind, ends, doc_ids))
            batch = pa.record_batch(
                {"file": [name], "n_docs": pa.array([len(ends)], pa.int64()), "n_ids": pa.array([total], pa.int64())}
            )
            ids, ends, doc_ids, total, number = [], [], [], 0, number + 1
            return batch

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                for doc_id, found in zip(part["doc_id"].to_pylist(), encoder.encode(part["text"].to_pylist())):
                    ids += [found, end]
                    total += len(found) // encoder.kind.itemsize + 1
                    ends.append(total)
                    doc_ids.append(doc_id)
                    if total >= file_ids:
                        yield close()
        if ends:
            yield close()

    placed = rows.repartitionByRange(width(docs), *order).sortWithinPartitions(*order)
    return placed.mapInArrow(task, "file string, n_docs bigint, n_ids bigint")


def read_ids(spark: SparkSession, folder: str, files: list[tuple[str, int]]) -> DataFrame:
    """One row per document from the files alone: doc_id, start, n_tokens, ids_crc32.

    ``files`` lists (file, ids before it): two small values per file, none per document. File names are dealt to
    the tasks, which read the files by ranges of READ_IDS ids and give out their documents range by range.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name, before in zip(batch["file"].to_pylist(), batch["before"].to_pylist()):
                where, path = fs.FileSystem.from_uri(f"{folder}/{name}")
                with where.open_input_file(path) as source:
                    found = IdFile.of(source)
                    ends = found.ends.values()
                    starts = np.append(0, ends[:-1])
                    for a, b, crc in found.checksums(READ_IDS):
                        yield pa.record_batch(
                            {
                                "doc_id": pa.array(found.doc_ids[a:b], pa.int64()), "start": pa.array(starts[a:b] + before, pa.int64()),
                                "n_tokens": pa.array(ends[a:b] - starts[a:b], pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                            }
                        )

    listed = spark.createDataFrame(files, "file string, before bigint")
    return listed.repartition(min(len(files), 4 * width(listed)), "file").mapInArrow(
        task, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_table(docs: DataFrame, folder: str | None = None, tokenizer: str = TOKENIZER, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the id files and read the document table back from them.

    Repeated rows are documents of their own, next to each other. An empty table writes no file and
    gives an empty result. Other columns are ignored. The driver gets three values per file.
    """
    spark = docs.sparkSession
    folder = folder or new_scratch(spark, "ids")
    files, total = [], 0
    for row in sorted(write_ids(docs, folder, tokenizer, file_ids).collect(), key=lambda r: r.file):
        files.append((row.file, total))
        total += row.n_ids
    if not files:
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read_ids(spark, folder, files)


def op7_elias_fano_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(read(spark, sf_dir, "documents"))
