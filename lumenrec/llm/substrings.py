"""Substring deduplication by hashes of word windows, compared in blocks of content.

In the order of doc_id, each window of ``WINDOW`` words that occurs earlier is a duplicate; neighbours
merge to spans. There is no greedy Lempel-Ziv parse: its factors would depend on where blocks end. A
window belongs to the block of its *anchor*, the smallest hash among its runs of 10 words, so equal
windows meet in one block wherever they stand. Windows are equal if their anchor (64 bits) and their own
hash (64 bits in a chunk, 48 in a block) are; a word's hash has 64 bits. The windows of anchors that
are too frequent for one block (``hot_anchors``) are dealt by anchor and window hash instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import materialize, mix, read, stream_groups, text_rows, width

WINDOW = 20
ANCHOR = 10
#: Bytes of text that a task parses against each other before anything is shuffled.
CHUNK = 4 << 20

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_LOW48 = np.uint64((1 << 48) - 1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word (run of bytes other than the six ASCII blanks)."""
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    size = np.diff(np.append(starts, len(data)))
    # a random odd factor for each place: powers of a base, modulo 2^64, would collide on long letter runs
    factors = mix(np.arange(1, int(size.max()) + 2, dtype=np.uint64) * _BASE) | np.uint64(1)
    tail = data[starts[0] :]
    place = np.arange(len(tail), dtype=np.int32) - np.repeat((starts - starts[0]).astype(np.int32), size)
    values = _BYTE[tail] * factors[place]
    values[space[starts[0] :]] = 0
    return starts, mix(np.add.reduceat(values, starts - starts[0]))


def runs_of(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on, by doubling."""
    out, done, power = None, 0, h
    length, base = 1, _WORD_BASE
    while True:
        if n & length:
            if out is None:
                out, done = power, length
            else:
                k = len(power) - done
                shift = np.uint64(pow(int(_WORD_BASE), done, 1 << 64))
                out = out[:k] + power[done : done + k] * shift
                done += length
        if done == n:
            return out
        k = len(power) - length
        if k <= 0:
            return np.zeros(0, np.uint64)
        power = power[:k] + power[length:] * base
        base = np.uint64(int(base) ** 2 % (1 << 64))
        length *= 2


def least_of(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of the ``n`` values from each place on."""
    length = 1
    while 2 * length <= n:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    return np.minimum(x[: len(x) - (n - length)], x[n - length :]) if n > length else x


def frequent(keys: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts; of more than ``n`` keys, the others' largest sum is taken off each.

    Repeated calls on what is left and new keys miss at most the total divided by ``n`` of any key's sum.
    """
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, counts, len(keys)).astype(np.int64)
    if len(keys) > n:
        counts -= np.partition(counts, len(keys) - n - 1)[len(keys) - n - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def planes(x: np.ndarray) -> bytes:
    """The bytes of an array of numbers, first all lowest ones, and so on: what is small compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    width_ = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width_, -1).T).view(kind).ravel()


def spans_of(marks: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of consecutive numbers: their first number, and their length plus ``extra``."""
    first = np.append(True, np.diff(marks) != 1) if len(marks) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    return marks[starts], np.diff(np.append(starts, len(marks))) + extra


def later(keys: np.ndarray, more: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Index lookup: whether an equal key (both parts of it) has a smaller ``order``."""
    if not len(keys):
        return np.zeros(0, bool)
    by = np.argsort(keys)
    k, m = keys[by], more[by]
    # equal first parts stand together; only where their second parts differ are they sorted again
    if np.any((k[1:] == k[:-1]) & (m[1:] != m[:-1])):
        by = np.lexsort((more, keys))
        k, m = keys[by], more[by]
    starts = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (m[1:] != m[:-1])))
    first = np.minimum.reduceat(order[by], starts)
    out = np.empty(len(keys), bool)
    out[by] = order[by] > np.repeat(first, np.diff(np.append(starts, len(keys))))
    return out


_SCHEMA = pa.schema(
    [("block", pa.int32()), ("doc_id", pa.int64()), ("part", pa.int64()), ("spans", pa.binary()),
     *((c, pa.binary()) for c in ("anchors", "docs", "parts", "places", "counts", "windows"))]
)


def anchors_of(h: np.ndarray) -> np.ndarray:
    """The anchor of each window over the word hashes ``h``."""
    return least_of(mix(runs_of(h, ANCHOR)), WINDOW - ANCHOR + 1)


def parse_chunk(ids: np.ndarray, parts: np.ndarray, texts: list[bytes], blocks: int, hot: np.ndarray) -> pa.RecordBatch:
    """Compare a chunk's windows with each other; deal what is first in the chunk to the blocks.

    The rows are spans already found (block, doc_id, part, spans), and for each block the windows that
    no earlier place in the chunk has, as runs: anchor, document, place, number of windows, and 48
    bits of the hash of each window. So a passage that many documents share is dealt once a chunk.
    A window whose anchor is in ``hot`` (sorted) is a run by itself and goes where its own hash sends it.
    """
    by = np.lexsort((parts, ids))
    texts, ids, parts = [texts[k] for k in by], ids[by], parts[by]
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts, h = word_hashes(data)
    first_byte = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    doc = np.searchsorted(first_byte, starts, "right") - 1
    if len(h) < WINDOW:
        return pa.RecordBatch.from_pylist([], _SCHEMA)
    first_word = np.searchsorted(doc, np.arange(len(texts)))
    n = len(h) - WINDOW + 1
    at = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])  # windows within one document
    window = mix(runs_of(h, WINDOW))[at]
    anchor = anchors_of(h)[at]
    doc = doc[at]
    # rows that repeat a document (same id, same text) are one document: only the first is parsed
    again = np.append(False, (ids[1:] == ids[:-1]) & (parts[1:] == parts[:-1]))
    unique = ~again[doc]
    at, window, anchor, doc = at[unique], window[unique], anchor[unique], doc[unique]
    place = at - first_word[doc]
    rank = np.cumsum(np.append(0, ids[1:] != ids[:-1]))  # equal ids are one document for the order
    found = later(window, anchor, (rank[doc] << 32) + place)

    rows: dict[str, list] = {c: [] for c in _SCHEMA.names}

    def emit(**values) -> None:
        for c in rows:
            rows[c].append(values.get(c))

    start, length = spans_of(at[found], WINDOW - 1)
    of = np.searchsorted(first_word, start, "right") - 1
    # an empty document shares its first word number with the next one: take the one that owns the word
    cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
    for a, b in zip(cuts, [*cuts[1:], len(of)]):
        d = int(of[a])
        pair = np.stack([start[a:b] - first_word[d], length[a:b]], axis=1).astype("<u4")
        emit(block=int(mix(ids[d : d + 1].view(np.uint64))[0] % np.uint64(blocks)), doc_id=int(ids[d]), part=int(parts[d]), spans=pair.tobytes())

    at, window, anchor, doc, place = (x[~found] for x in (at, window, anchor, doc, place))
    if len(at):
        split = np.isin(anchor, hot)
        new = split | np.append(True, (np.diff(at) != 1) | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))
        heads = np.flatnonzero(new)
        count = np.diff(np.append(heads, len(at)))
        key = np.where(split[heads], anchor[heads] ^ mix(window[heads] & _LOW48), anchor[heads])
        target = ((mix(key) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        cuts = np.searchsorted(target[order], np.arange(blocks + 1))
        low = np.ascontiguousarray((window & _LOW48).view(np.uint8).reshape(-1, 8)[:, :6])
        for block in np.flatnonzero(np.diff(cuts)):
            mine = order[cuts[block] : cuts[block + 1]]
            head, many = heads[mine], count[mine]
            each = np.repeat(head, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            d = doc[head]
            emit(
                block=int(block), anchors=anchor[head].tobytes(),
                docs=planes(np.diff(ids[d].view(np.uint64), prepend=np.uint64(0))),
                parts=parts[d].tobytes(), places=planes(place[head].astype("<u4")),
                counts=planes(many.astype("<u4")), windows=low[each].tobytes(),
            )
    return pa.RecordBatch.from_pydict(rows, _SCHEMA)


def parse_block(table: pa.Table) -> pa.Table:
    """Find the windows of one block that have an equal one earlier; neighbours merge to spans."""
    passed = table.filter(pc.is_valid(table["spans"])).select(["doc_id", "part", "spans"])
    dealt = table.filter(pc.is_valid(table["anchors"]))
    if not dealt.num_rows:
        return passed

    def joined(name: str, decode) -> np.ndarray:
        return np.concatenate([decode(x) for x in dealt[name].to_pylist()])

    anchor = joined("anchors", lambda b: np.frombuffer(b, np.uint64))
    ids = joined("docs", lambda b: np.cumsum(unplanes(b, "<u8")).view(np.int64))
    part = joined("parts", lambda b: np.frombuffer(b, "<i8"))
    place = joined("places", lambda b: unplanes(b, "<u4")).astype(np.int64)
    many = joined("counts", lambda b: unplanes(b, "<u4")).astype(np.int64)
    low = np.frombuffer(b"".join(dealt["windows"].to_pylist()), np.uint8).reshape(-1, 6)
    window = np.zeros((len(low), 8), np.uint8)
    window[:, :6] = low
    window = window.view(np.uint64).ravel()
    run = np.repeat(np.arange(len(many)), many)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    _, rank = np.unique(ids, return_inverse=True)
    order = (rank[run] << 32) + place[run] + inner
    # 64 bits of the anchor and 48 of the window
    hit = np.flatnonzero(later(window, anchor[run], order))
    if not len(hit):
        return passed
    by = np.lexsort((order[hit], part[run[hit]]))
    by = by[np.argsort(rank[run[hit[by]]], kind="stable")]
    hit = hit[by]
    r, o = run[hit], order[hit]
    new_doc = np.append(True, (ids[r[1:]] != ids[r[:-1]]) | (part[r[1:]] != part[r[:-1]]))
    new_span = new_doc | np.append(True, np.diff(o) != 1)
    starts = np.flatnonzero(new_span)
    pairs = np.stack([o[starts] & 0xFFFFFFFF, np.diff(np.append(starts, len(o))) + WINDOW - 1], axis=1).astype("<u4")
    cuts = np.flatnonzero(new_doc[starts])
    docs = starts[cuts]
    spans = [pairs[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(pairs)])]
    found = pa.table({"doc_id": pa.array(ids[r[docs]]), "part": pa.array(part[r[docs]]), "spans": pa.array(spans, pa.binary())})
    return pa.concat_tables([passed, found])


_PACKED = "bucket int, packed binary"


def pack_found(found: pa.Table, buckets: int) -> pa.Table:
    """Rows (doc_id, part, spans) as one row per bucket of documents, for the next shuffle."""
    ids = found["doc_id"].to_numpy()
    bucket = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    out = []
    for b in np.unique(bucket):
        part = found.filter(pa.array(bucket == b)).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_table(part)
        out.append(sink.getvalue().to_pybytes())
    return pa.table({"bucket": pa.array(np.unique(bucket)), "packed": pa.array(out, pa.binary())})


def unpack_found(table: pa.Table) -> pa.Table:
    """One row per document of a bucket, with all its spans."""
    found = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in table["packed"].to_pylist()])
    found = found.group_by(["doc_id", "part"]).aggregate([("spans", "list")])
    spans = [b"".join(x) for x in found["spans_list"].to_pylist()]
    return pa.table({"doc_id": found["doc_id"], "part": found["part"], "spans": pa.array(spans, pa.binary())})


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[bytes]]]:
    """Ids, parts and texts of a task's rows, some ``CHUNK`` bytes of text at a time."""
    ids, parts, texts, size = [], [], [], 0
    for batch in batches:
        for i, p, t in zip(batch["doc_id"].to_pylist(), batch["part"].to_pylist(), batch["text"]):
            text = t.as_py()
            ids.append(np.iinfo(np.int64).max if i is None else i)
            parts.append(p)
            texts.append(text)
            size += len(text) + 1
            if size >= CHUNK:
                yield ids, parts, texts
                ids, parts, texts, size = [], [], [], 0
    if texts:
        yield ids, parts, texts


def hot_anchors(rows: DataFrame, blocks: int) -> np.ndarray:
    """Anchors (sorted) that have more windows than an average block, or than 64 for each task of the scan.

    Each task keeps its most frequent anchors in a summary of 8 keys a block and hands on those of more than
    16 windows and of more than 1 / (8 blocks) of its windows. Over all tasks, any anchor's sum is short by at
    most a quarter of a block and 16 windows a task, so anchors whose sum exceeds half the bound are taken: at
    most two a block, a list that does not grow with the rows.
    """
    n = 8 * blocks

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for _, _, texts in _chunks(batches):
            # windows over the seams of texts are counted too: some 20 a text
            _, h = word_hashes(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
            if len(h) >= WINDOW:
                more = anchors_of(h)
                total += len(more)
                keys, counts = frequent(np.append(keys, more), np.append(counts, np.ones(len(more), np.int64)), n)
        many = counts > max(16, total / n)
        yield pa.record_batch(
            {"anchor": pa.array([None, *keys[many].view(np.int64).tolist()], pa.int64()), "n": pa.array([total, *counts[many].tolist()], pa.int64())}
        )

    sums = rows.mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"), F.count("*").alias("tasks"))
    sums = materialize(sums, "anchors")
    whole = sums.filter(F.col("anchor").isNull()).first()
    if whole is None:
        return np.zeros(0, np.uint64)
    found = sums.filter(F.col("anchor").isNotNull() & (F.col("n") > max(whole.n / blocks, 64 * whole.tasks) / 2)).select("anchor")
    return np.sort(np.array([r.anchor for r in found.collect()], np.int64).view(np.uint64))


def duplicate_spans(rows: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, part, spans): word spans (first word, words; pairs of 32 bits) that occur earlier.

    ``rows`` has doc_id, text (binary) and part, which tells texts with one id apart. A null id comes
    after all others. Hashes are shuffled to the blocks, spans back to buckets of documents, each
    document's as one row; texts stay where they are read, and are read twice (``hot_anchors``).
    """
    partitions = width(rows)
    hot = hot_anchors(rows, blocks)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, parts, texts in _chunks(batches):
            yield parse_chunk(np.array(ids, np.int64), np.array(parts, np.int64), texts, blocks, hot)

    dealt = rows.mapInArrow(
        chunks,
        "block int, doc_id bigint, part bigint, spans binary, anchors binary, docs binary, parts binary, "
        "places binary, counts binary, windows binary",
    )
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in stream_groups(batches, ["block"], parse_block):
            if found.num_rows:
                yield from pack_found(pa.Table.from_batches([found]), partitions).to_batches()

    return (
        dealt.repartition(partitions, "block")
        .sortWithinPartitions("block")
        .mapInArrow(parse, _PACKED)
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(lambda batches: stream_groups(batches, ["bucket"], unpack_found), "doc_id bigint, part bigint, spans binary")
    )


def kept_words(words: list[bytes], spans: bytes | None) -> list[bytes]:
    """The words outside all spans."""
    if not spans:
        return words
    at, kept = 0, []
    pairs = np.frombuffer(spans, "<u4").reshape(-1, 2)
    for start, n in pairs[np.argsort(pairs[:, 0])].tolist():
        if start > at:
            kept += words[at:start]
        at = max(at, start + n)
    return kept + words[at:]


def _with_spans(docs: DataFrame, blocks: int | None) -> DataFrame:
    rows = text_rows(docs).withColumn("part", F.xxhash64("text"))
    last = F.lit(int(np.iinfo(np.int64).max))
    found = duplicate_spans(rows, blocks or 4 * width(docs)).withColumnsRenamed({"doc_id": "key", "part": "key_part"})
    return rows.join(
        found.hint("shuffle_hash"), (F.coalesce("doc_id", last) == F.col("key")) & (F.col("part") == F.col("key_part")), "left"
    ).select("doc_id", "text", "spans")


def deduplicate(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, text (the kept words).

    A word goes if a window of 20 words that covers it starts earlier too: in a document with a smaller
    id, or before in the same one. Null and empty texts have no words. Rows with the same id and text
    are one document and come out alike; other texts under one id are places of the same document, told
    apart by their hash. A null id comes last. An empty table gives an empty result.

    Windows are compared by 112 bits or more of hashes. ``blocks`` (default: four a shuffle partition) deals anchors,
    and a task holds one block's windows; those of an anchor that would fill much of a block are dealt to all blocks.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, digest, text = [], [], [], []
            for k in range(batch.num_rows):
                words = batch["text"][k].as_py().split()
                kept = kept_words(words, batch["spans"][k].as_py())
                n.append(len(words))
                removed.append(len(words) - len(kept))
                text.append(b" ".join(kept))
                digest.append(hashlib.sha256(text[-1]).hexdigest())
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                 "kept_sha256": pa.array(digest, pa.string()), "text": pa.array(text, pa.binary())}
            )

    return (
        _with_spans(docs, blocks)
        .mapInArrow(task, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text binary")
        .withColumn("text", F.col("text").cast("string"))
    )


def op6_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "documents")).drop("text")


OP6_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(w[p : p + 19], ' ') AS k
  FROM d, unnest(range(1, len(w) - 18)) AS t(p) WHERE len(w) >= 20),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
cut AS (SELECT DISTINCT doc_id, i FROM late, unnest(range(p, p + 20)) AS t(i)),
kept AS (
  SELECT u.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY u.i) AS kept
  FROM (SELECT doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)) u
  LEFT JOIN cut ON cut.doc_id = u.doc_id AND cut.i = u.i WHERE cut.i IS NULL GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
