"""Benchmark decontamination: suffix arrays over training shards, searched for every test suffix."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import filter_by_text, read, text_rows

WINDOW = 13
#: Words of a benchmark block that is broadcast at once; a larger benchmark is searched block by block.
BLOCK_WORDS = 1_000_000

# A-Z to a-z; every ASCII byte that is no letter or digit ends a word; other bytes belong to words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class TestSet:
    """Items of a benchmark block as word numbers (from 1), one after another with a 0 between."""

    vocabulary: dict[bytes, int]
    names: list[str]
    stream: np.ndarray
    item: np.ndarray  # of each test suffix that starts a window: its item,
    start: np.ndarray  # where it starts in the stream,
    size: np.ndarray  # and how many words its window has

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int) -> TestSet:
        vocabulary: dict[bytes, int] = {}
        stream, item, start, size = [0], [], [], []
        for k, (_, words) in enumerate(items):
            n = min(window, len(words))
            for offset in range(len(words) - n + 1 if n else 0):
                item.append(k)
                start.append(len(stream) + offset)
                size.append(n)
            stream += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            stream += [0]
        return cls(vocabulary, [name for name, _ in items], *(np.array(x, np.int64) for x in (stream, item, start, size)))


@dataclass(frozen=True)
class Shard:
    """A training shard: word numbers of its documents with a 0 before each, and its suffix array.

    Words that no test item has are 0 as well, so a match cannot cross one; only suffixes that start
    with enough known words to hold the shortest window are sorted. The others can match nothing.
    """

    stream: np.ndarray
    first: np.ndarray  # start of each document in the stream
    n_words: np.ndarray
    suffixes: np.ndarray  # positions, ordered by their next words
    keys: np.ndarray  # those words, as bytes that compare in the same order

    @classmethod
    def of(cls, documents: list[list[bytes]], tests: TestSet) -> Shard:
        number = tests.vocabulary.get
        parts: list[int] = []
        first = []
        for words in documents:
            parts.append(0)
            first.append(len(parts))
            parts += [number(w, 0) for w in words]
        stream = np.array([*parts, 0], np.int32)
        depth = int(tests.size.max()) if len(tests.size) else 1
        shortest = int(tests.size.min()) if len(tests.size) else 1
        gaps = np.flatnonzero(stream == 0)
        length = np.diff(gaps) - 1  # known words between gaps
        runs = np.flatnonzero(length >= shortest)
        many = length[runs] - shortest + 1
        suffixes = np.repeat(gaps[runs] + 1, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        keys = prefixes(stream, suffixes, depth)
        order = np.argsort(keys, kind="stable")
        return cls(stream, np.array(first, np.int64), np.array([len(w) for w in documents], np.int64), suffixes[order], keys[order])

    def occurrences(self, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
        """(position, test suffix) of every window occurrence: two binary searches per test suffix."""
        if not len(tests.start) or not len(self.suffixes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = self.keys.dtype.itemsize // 4
        low = prefixes(tests.stream, tests.start, depth, tests.size)
        high = prefixes(tests.stream, tests.start, depth, tests.size, 0xFFFFFFFF)
        left, right = np.searchsorted(self.keys, low, "left"), np.searchsorted(self.keys, high, "right")
        many = right - left
        which = np.repeat(np.arange(len(many)), many)
        at = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return self.suffixes[at], which


def prefixes(stream: np.ndarray, starts: np.ndarray, depth: int, size: np.ndarray | None = None, fill: int = 0) -> np.ndarray:
    """The next ``depth`` numbers from each start as byte strings in the same order; from the first gap
    on, or from ``size`` on, ``fill``."""
    out = np.zeros((len(starts), depth), ">u4")
    inside = np.ones(len(starts), bool)
    for k in range(depth):
        number = stream[np.minimum(starts + k, len(stream) - 1)]
        inside &= number != 0
        if size is not None:
            inside &= k < size
        out[:, k] = np.where(inside, number, fill)
    return np.ascontiguousarray(out).view(f"S{4 * depth}").ravel()


@dataclass
class Found:
    """What all benchmark blocks gave for a shard of documents."""

    n_words: np.ndarray
    n_hit: np.ndarray
    items: list[list[str]]  # names, sorted, without repeats
    matches: list[tuple[int, str, int, int, int]]  # document, item, word in document, word in item, words

    def contaminated(self) -> np.ndarray:
        return (self.n_hit > 0) & (20 * self.n_hit >= self.n_words)


def search(texts: list[bytes], blocks: list[Callable[[], TestSet]]) -> Found:
    """Find every window of every block in a shard of whole texts."""
    documents = [words_of(t) for t in texts]
    covered, names, matches = None, [set() for _ in texts], []
    shard = None
    for block in blocks:
        tests = block()
        shard = Shard.of(documents, tests)
        if covered is None:
            covered = np.zeros(len(shard.stream) + 1, np.int64)
        at, which = shard.occurrences(tests)
        if not len(at):
            continue
        np.add.at(covered, at, 1)
        np.add.at(covered, at + tests.size[which], -1)
        doc, item = np.searchsorted(shard.first, at, "right") - 1, tests.item[which]
        for d, i in set(zip(doc.tolist(), item.tolist())):
            names[d].add(tests.names[i])
        # windows that follow each other in both texts are one verbatim match
        order = np.lexsort((at, item, tests.start[which] - at))
        a, i, s = at[order], item[order], tests.start[which][order]
        new = np.append(True, (np.diff(a) != 1) | (np.diff(i) != 0) | (np.diff(s) != 1))
        ends = np.append(np.flatnonzero(new)[1:], len(a)) - 1
        item_first = np.searchsorted(tests.item, np.arange(len(tests.names)))
        for b, e in zip(np.flatnonzero(new), ends):
            d = int(np.searchsorted(shard.first, a[b], "right")) - 1
            matches.append(
                (d, tests.names[i[b]], int(a[b] - shard.first[d]), int(s[b] - tests.start[item_first[i[b]]]),
                 int(a[e] - a[b] + tests.size[which][order][e]))
            )
    n_words = np.array([len(w) for w in documents], np.int64)
    if shard is None:
        return Found(n_words, np.zeros(len(texts), np.int64), [[] for _ in texts], [])
    hit = np.append(0, np.cumsum(np.cumsum(covered)[:-1] > 0))
    return Found(n_words, hit[shard.first + n_words] - hit[shard.first], [sorted(n) for n in names], matches)


def test_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list:
    """The benchmark as broadcast blocks of at most ``block_words`` words (or one item, if it is longer).

    Items come to the driver one by one; only one block is held at a time. Items whose text is null or
    has no words are left out; a null item_id reads as the empty string.
    """
    context = benchmark.sparkSession.sparkContext
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null").distinct().orderBy("item_id", "text")
    blocks, held, total = [], [], 0
    for row in items.toLocalIterator():
        words = words_of(row.text.encode())
        if held and total + len(words) > block_words:
            blocks.append(context.broadcast(TestSet.of(held, window)))
            held, total = [], 0
        if words:
            held.append((row.item_id, words))
            total += len(words)
    if held:
        blocks.append(context.broadcast(TestSet.of(held, window)))
    return blocks


def _openers(blocks: list) -> list[Callable[[], TestSet]]:
    return [lambda b=b: b.value for b in blocks]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rows: int = 1000) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, longest.

    A window is ``window`` consecutive words of an item (all its words if it has fewer); a document
    word inside an occurrence is hit; a document is contaminated if at least a twentieth of its words
    is hit. ``longest`` is the length of the longest verbatim match of at least a window. Null and
    empty texts have no words and are clean. Repeated rows are judged alike; items with the same id
    count once. Shards are ``rows`` documents of a partition; nothing is shuffled.
    """
    blocks = test_blocks(benchmark, window)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = search(part["text"].to_pylist(), _openers(blocks))
                longest = np.zeros(part.num_rows, np.int64)
                for d, *_, n in found.matches:
                    longest[d] = max(longest[d], n)
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"],
                        "n_words": found.n_words,
                        "n_hit": found.n_hit,
                        "n_items": pa.array([len(i) for i in found.items], pa.int64()),
                        "items_sha256": [hashlib.sha256(",".join(i).encode()).hexdigest() for i in found.items],
                        "contaminated": found.contaminated(),
                        "longest": longest,
                    }
                )

    schema = (
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, longest bigint"
    )
    return text_rows(docs).mapInArrow(task, schema)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rows: int = 1000) -> DataFrame:
    """Every longest verbatim match: doc_id, item_id, doc_word, item_word (both from 0), n_words."""
    blocks = test_blocks(benchmark, window)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = search(part["text"].to_pylist(), _openers(blocks)).matches
                if found:
                    doc, item, at, where, n = zip(*found)
                    yield pa.record_batch(
                        {"doc_id": part["doc_id"].take(pa.array(doc)), "item_id": list(item),
                         "doc_word": pa.array(at, pa.int64()), "item_word": pa.array(where, pa.int64()), "n_words": pa.array(n, pa.int64())}
                    )

    return text_rows(docs).mapInArrow(
        task, "doc_id bigint, item_id string, doc_word bigint, item_word bigint, n_words bigint"
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, all columns kept."""
    blocks = test_blocks(benchmark, window)
    return filter_by_text(docs, lambda: lambda texts: ~search(texts, _openers(blocks)).contaminated())


def op5_suffix_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


# DuckDB: every document window against every item window, as joined words.
OP5_SQL = """
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents, fold),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark, fold),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p) WHERE len(w) >= n),
found AS (SELECT doc_id, item_id, p, n FROM dw JOIN bw USING (n, k)),
hits AS (SELECT doc_id, count(DISTINCT h) AS n_hit FROM found, unnest(range(p, p + n)) AS t(h) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS names
  FROM found GROUP BY doc_id),
runs AS (
  SELECT doc_id, max(c) AS longest FROM (
    SELECT doc_id, item_id, n, g, max(p) - min(p) + n AS c
    FROM (SELECT doc_id, item_id, n, p, i - p AS diagonal,
                 p - row_number() OVER (PARTITION BY doc_id, item_id, n, i - p ORDER BY p) AS g
          FROM (SELECT doc_id, item_id, dw.n, dw.p, u.i FROM dw
                JOIN (SELECT item_id, least(13, len(w)) AS n, q AS i, array_to_string(w[q : q + least(13, len(w)) - 1], ' ') AS k
                      FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(q) WHERE len(w) > 0) u USING (n, k)))
    GROUP BY doc_id, item_id, n, diagonal, g) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
