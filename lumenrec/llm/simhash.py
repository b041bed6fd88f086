"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lumenrec.llm.common import fresh, materialize, read, stream_groups, text_rows, width
from lumenrec.llm.components import components

SEED = 42


def fingerprint(text: bytes, words: int = 3) -> int:
    """The bits set in over half of the XXH64 values of all shingles; zero without words."""
    tokens = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if len(tokens) >= words else [b" ".join(tokens)]
    hashes = np.frombuffer(b"".join(map(partial(xxhash.xxh64_digest, seed=SEED), shingles)), np.uint8).reshape(-1, 8)
    votes = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * votes.astype(np.int64) > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp bigint, ``extra`` columns): one row per document, in one pass without a shuffle."""
    rows = text_rows(docs, *(c.alias(name) for name, c in (extra or {}).items()), id_col=id_col, text_col=text_col)
    fields = [rows.schema["doc_id"], *rows.schema.fields[2:]]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t.as_py(), words) for t in batch["text"]], np.uint64)
            columns, names = [batch["doc_id"], *batch.columns[2:]], [f.name for f in fields]
            yield pa.record_batch([*columns, pa.array(codes.view(np.int64))], names=[*names, "fp"])

    return rows.mapInArrow(task, StructType([*fields, StructField("fp", LongType())]))


class BKTree:
    """Codes in a tree whose edges carry the Hamming distance between child and parent."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, code: int) -> int:
        """Insert a code that is not in the tree yet; its number."""
        new, at = len(self.codes), 0
        self.codes.append(code)
        self.edges.append({})
        while new:
            d = (self.codes[at] ^ code).bit_count()
            if d not in self.edges[at]:
                self.edges[at][d] = new
                break
            at = self.edges[at][d]
        return new

    def within(self, code: int, radius: int) -> Iterator[int]:
        """Numbers of all codes at most ``radius`` bits away. By the triangle inequality only edges
        labelled within ``radius`` of the distance to the parent can lead to one."""
        todo = [0] if self.codes else []
        while todo:
            at = todo.pop()
            d = (self.codes[at] ^ code).bit_count()
            if d <= radius:
                yield at
            edges = self.edges[at]
            if len(edges) <= 2 * radius + 1:
                todo += [child for label, child in edges.items() if d - radius <= label <= d + radius]
            else:
                todo += [edges[label] for label in range(d - radius, d + radius + 1) if label in edges]


def shard_links(trees: list[int], asked: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect all codes of a shard and the queries that are within ``radius`` of each other.

    With no other queries the shard asks itself. Of the links between codes that are connected already
    none is repeated: at most one link per code comes out, however many pairs are near.
    """
    codes = list(dict.fromkeys([*trees, *asked]))
    number, parent = {c: i for i, c in enumerate(codes)}, list(range(len(codes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree, links = BKTree(), []

    def join(code: int) -> None:
        for hit in tree.within(code, radius):
            a, b = root(number[code]), root(number[tree.codes[hit]])
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((code, tree.codes[hit]))

    if not asked:
        for code in trees:
            join(code)
            tree.add(code)
    else:
        for code in trees:
            tree.add(code)
        for code in asked:
            join(code)
    return links


def near_links(codes: DataFrame, radius: int = 2, blocks: int = 4, shard: int = 4096) -> DataFrame:
    """Links (a, b) that connect exactly the distinct ``fp`` codes within ``radius`` bits of each other.

    Codes at most ``radius`` bits apart agree in ``blocks - radius`` of ``blocks`` equal parts of the
    64 bits, so they meet under at least one choice of parts. Codes that meet form a bucket. A bucket of
    up to ``shard`` codes is one BK-tree that its own codes query; a larger one is cut into tree shards,
    and each shard is sent to every slice of the bucket's queries, so no task holds more than two slices.
    """
    if not 0 <= radius < blocks:
        raise ValueError("blocks must exceed the radius")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    choices = []
    for t, parts in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (cuts[p + 1] - cuts[p])) - 1) << cuts[p] for p in parts)
        signed = mask - (1 << 64) if mask >> 63 else mask
        choices.append(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")))
    met = codes.select("fp", F.explode(F.array(*choices)).alias("x")).select("fp", "x.t", "x.key")
    large = materialize(met.groupBy("t", "key").count().where(F.col("count") > shard), "large_buckets")
    large = large.withColumnsRenamed({"t": "t_", "key": "key_"})
    sized = met.join(large, (met.t == large.t_) & (met.key == large.key_), "left").select(
        "fp", "t", "key", F.ceil(F.coalesce("count", F.lit(1)) / shard).cast("int").alias("slices")
    )
    sized = sized.withColumn("own", F.pmod(F.xxhash64("fp"), "slices").cast("int"))
    others = F.sequence(F.lit(0), F.col("slices") - 1)
    # A row is tree code of its slice for each query slice above, and query to each tree slice below.
    placed = sized.select(
        "fp", "t", "key",
        F.explode(F.transform(others, lambda o: F.struct(
            F.least(F.col("own"), o).alias("i"), F.greatest(F.col("own"), o).alias("j"), (F.col("own") <= o).alias("tree")
        ))).alias("x"),
    ).select("t", "key", "x.i", "x.j", "x.tree", "fp")
    group = ["t", "key", "i", "j"]

    def handle(table: pa.Table) -> pa.Table | None:
        cols = {c: table[c].to_numpy() for c in [*group, "fp"]}
        tree, codes64 = table["tree"].to_numpy(zero_copy_only=False), cols["fp"].view(np.uint64)
        changes = np.zeros(table.num_rows, bool)
        changes[0] = True
        for c in group:
            changes[1:] |= cols[c][1:] != cols[c][:-1]
        starts = np.flatnonzero(changes)
        ends = np.append(starts[1:], table.num_rows)
        links: list[tuple[int, int]] = []
        for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            mine, trees = codes64[s:e], tree[s:e]
            links += shard_links(mine[trees].tolist(), mine[~trees].tolist(), radius)
        if not links:
            return None
        a, b = np.array(links, np.uint64).view(np.int64).T
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return (
        placed.repartition(width(codes), *group)
        .sortWithinPartitions(*group)
        .mapInArrow(lambda batches: stream_groups(batches, group, handle), "a bigint, b bigint")
    )


def with_labels(codes: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct ``fp`` codes and their other columns, with the ``label`` that linked codes share."""
    labels = components(near_links(codes.select("fp"), radius))
    return codes.join(labels, codes.fp == labels.node, "left").select(*codes.columns, F.coalesce("label", "fp").alias("label"))


def near_groups(
    docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents link when their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest doc_id reachable over links. Null and empty texts have fingerprint zero and link like any
    other. Repeated rows stay and share a component; a null doc_id is never the smallest. An empty
    table gives an empty result. Other columns are ignored.

    The texts are read once: fingerprints go to a table in the shared folder. Copies collapse to one
    code before buckets are formed, so a group of copies of any size is one code.
    """
    prints = materialize(fingerprints(docs, words, id_col, text_col), "simhash")
    codes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "codes")
    labelled = materialize(with_labels(codes, radius), "labelled_codes")
    firsts = materialize(labelled.groupBy("label").agg(F.min("first_id").alias("component_id")), "firsts")
    named = materialize(
        labelled.join(firsts, "label").select(F.col("fp").alias("code"), "component_id"), "components"
    )
    return prints.join(named, prints.fp == named.code, "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The documents whose doc_id is the smallest of their near-duplicate group, all columns kept.

    Repeated rows with a kept id collapse to one of them. Rows without a doc_id take part in linking
    but stay: they have no id to be dropped by.
    """
    named = fresh(docs, "kept_id")
    groups = near_groups(docs, words, radius)
    first = materialize(
        groups.where("doc_id is null or doc_id = component_id").groupBy(F.col("doc_id").alias(named)).count(), "kept"
    )
    # the ids grow with the documents: both sides are dealt by id at every size, never broadcast
    kept = docs.join(first.select(named).hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(named)), "left_semi")
    repeated = first.where(f"count > 1 and {named} is not null").select(named)
    if repeated.isEmpty():
        return kept
    same = F.col("doc_id") == F.col(named)
    return kept.join(repeated, same, "left_anti").union(kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id"]))


def op10_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"))
