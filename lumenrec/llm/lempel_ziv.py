"""Document fingerprints from Lempel-Ziv phrases: minimum hashes of the set of dictionary phrases.

Parsing a text adds, again and again, the shortest piece that is not in the dictionary yet. Texts that
compress each other share phrases, so the overlap of two phrase sets, estimated from their smallest
hashes, is a likeness in the sense of compression.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import read, width

#: Smallest hashes that a fingerprint keeps.
KEEP = 64


def parse(data: bytes, seen: set[bytes], start: int = 0, stop: int | None = None) -> tuple[list[bytes], int]:
    """Phrases that ``data[start:stop]`` adds to ``seen`` (which gets them), and where the rest starts
    that is a known phrase as a whole.

    The dictionary holds every beginning of its phrases, so the length of the longest known piece can
    be sought up or down from the length of the last phrase.
    """
    stop = len(data) if stop is None else stop
    added: list[bytes] = []
    put, size = added.append, 3
    while start < stop:
        end = start + size
        if end > stop:
            end = stop
        if data[start:end] in seen:
            end += 1
            while end <= stop and data[start:end] in seen:
                end += 1
            if end > stop:
                break
        else:
            end -= 1
            while end > start and data[start:end] not in seen:
                end -= 1
            end += 1
        phrase = data[start:end]
        seen.add(phrase)
        put(phrase)
        size, start = end - start, end
    return added, start


def hashes(phrases: list[bytes]) -> np.ndarray:
    """32 bits of each phrase's hash."""
    return np.frombuffer(b"".join(map(xxhash.xxh32_digest, phrases)), ">u4").astype(np.uint32)


def smallest(*parts: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """The smallest distinct values of all parts, in order."""
    values = np.concatenate(parts)
    while True:
        few = np.unique(values if len(values) <= 2 * keep else np.partition(values, 2 * keep)[: 2 * keep])
        if len(few) >= keep or len(values) <= 2 * keep:
            return few[:keep]
        values = np.unique(values)  # so many equal values that the part held too few


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    """Estimated share of common phrases among all (0 to 1): of the smallest hashes of both together,
    those that are in both. Exact while both sets are smaller than a fingerprint; 1 for two empty ones."""
    both = np.union1d(a, b)[:keep]
    if not len(both):
        return 1.0
    return float(np.count_nonzero(np.isin(both, a) & np.isin(both, b)) / len(both))


def fingerprint(text: str, keep: int = KEEP) -> np.ndarray:
    return smallest(hashes(parse(text.encode(), set())[0]), keep=keep)


def with_edit(text: str, other: str, keep: int = KEEP) -> tuple[np.ndarray, str, np.ndarray]:
    """Fingerprint of a text, its edited text, and that text's fingerprint.

    The last third of the code points (rounded down) becomes the first as many of ``other``. Both texts
    are parsed alike up to the edit, so that part is parsed and hashed once.
    """
    cut = len(text) - len(text) // 3
    edited = text[:cut] + other[: len(text) // 3]
    one, two, same = text.encode(), edited.encode(), len(text[:cut].encode())
    seen: set[bytes] = set()
    shared, rest = parse(one, seen, 0, same)
    tail, _ = parse(one, seen, rest)
    seen.difference_update(tail)
    new_tail, _ = parse(two, seen, rest)
    common = hashes(shared)
    return smallest(common, hashes(tail), keep=keep), edited, smallest(common, hashes(new_tail), keep=keep)


def show(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def in_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text, range, after): documents dealt to ranges of descending doc_id, with the document
    after a range's last one added to it (``after`` is true there).

    A null id comes last; of equal ids the order is that of a hash of the text. The ends of the ranges
    are found from the ids alone; the driver gets two ids per range, and there are as many ranges as
    shuffle partitions. The first document of all follows the last.
    """
    partitions = width(docs)
    lowest = int(np.iinfo(np.int64).min)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = None, None
        for batch in batches:
            if batch.num_rows:
                values = batch["key"].to_numpy()
                low = int(values.min()) if low is None else min(low, int(values.min()))
                high = int(values.max()) if high is None else max(high, int(values.max()))
        if low is not None:
            yield pa.record_batch({"low": pa.array([low], pa.int64()), "high": pa.array([high], pa.int64())})

    found = docs.select(key.alias("key")).repartitionByRange(partitions, F.col("key").desc()).mapInArrow(ends, "low bigint, high bigint").collect()
    bounds = sorted(((r.high, r.low) for r in found), reverse=True)
    highs = np.array([h for h, _ in bounds][::-1], np.int64)  # ascending
    ranges = len(bounds)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        """Number of a key's range, less one and negative if the key is the first of its range."""
        values = keys.to_numpy()
        at = np.searchsorted(highs, values)
        number = ranges - 1 - at
        return pd.Series(np.where(highs[at] == values, -number - 1, number).astype(np.int32))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    if not ranges:
        return rows.select("doc_id", "text", F.lit(0).alias("range"), F.lit(False).alias("after"))
    number = F.when(F.col("p") < 0, -F.col("p") - 1).otherwise(F.col("p"))
    own = F.struct(number.alias("range"), F.lit(False).alias("after"))
    before = F.struct(F.pmod(number - 1, F.lit(ranges)).alias("range"), F.lit(True).alias("after"))
    return (
        rows.withColumn("p", place("key"))
        .withColumn("x", F.explode(F.when(F.col("p") < 0, F.array(own, before)).otherwise(F.array(own))))
        .select("doc_id", "text", "key", "x.range", "x.after")
        .repartitionById(ranges, F.col("range").cast("int"))
        .sortWithinPartitions("range", "after", F.col("key").desc(), F.xxhash64("text"), "text")
        .select("doc_id", "text", "range", "after")
    )


def fingerprints(docs: DataFrame, keep: int = KEEP) -> DataFrame:
    """One row per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller doc_id (a null id is the smallest; equal ids
    follow by a hash of their texts); the first follows the last, so a single document follows itself.
    Null texts are empty; an empty text has the empty fingerprint. Repeated rows are documents of their
    own. An empty table gives an empty result; other columns are ignored. Texts are shuffled once; a
    task holds one batch and one document.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the document whose next one has not been seen, and its range

        def finish(doc_id: int | None, text: str, other: str) -> tuple:
            """All but the likeness to the next document, whose fingerprint is not known yet."""
            sig, edited, edited_sig = with_edit(text, other, keep)
            return sig, (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(sig), show(edited_sig), likeness(sig, edited_sig, keep))

        pending: tuple | None = None  # a finished row that waits for the next document's fingerprint
        done: set[int] = set()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, number, after in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "range", "after"))):
                if number in done:
                    continue  # more rows with the id of the document after the range
                if held is not None:
                    sig, row = finish(held[0], held[1], text)
                    if pending is not None:
                        out.append((*pending[1], likeness(pending[0], sig, keep)))
                    pending = (sig, row)
                    held = None
                if after:
                    if pending is not None:
                        out.append((*pending[1], likeness(pending[0], fingerprint(text, keep), keep)))
                    pending = None
                    done = {number}
                else:
                    held = (doc_id, text)
            if out:
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_ranges(docs).mapInArrow(task, schema)


def op2_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))
