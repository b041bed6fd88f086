"""Best-fit packing of documents into sequences of a fixed length, under conflict constraints."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm import simhash
from lumenrec.llm.common import materialize, read

CAPACITY = 2048
#: Pieces that are packed together in one task, on average.
SHARD = 20_000


def best_fit(sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) of each piece: best fit, largest pieces first (ties: in the given order).

    A bin never holds two pieces of one source or of one duplicate cluster. Open bins are kept by the
    room they have left; each carries a bitmap of its sources and of its clusters. The search starts at
    the smallest room that fits and goes on to the next larger one until a bin without conflict is
    found: the tightest compatible bin, the oldest of several. ``shared`` holds the bits that all bins
    of a room have in common, so a room full of conflicts is passed over at once.
    """
    bits: dict[tuple[str, object], int] = {}
    many = Counter(clusters)
    wanted = []
    for source, cluster in zip(sources, clusters):
        bit = 1 << bits.setdefault(("source", source), len(bits))
        if many[cluster] > 1:  # a cluster of one cannot conflict
            bit |= 1 << bits.setdefault(("cluster", cluster), len(bits))
        wanted.append(bit)
    shelf: dict[int, dict[int, list[int]]] = {}  # room → bitmap → bins, oldest first
    shared: dict[int, int] = {}
    rooms = 0  # bit r is set if some bin has r left
    used: list[int] = []
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)

    def note(room: int) -> None:
        nonlocal rooms
        if shelf[room]:
            rooms |= 1 << room
            common = -1
            for bitmap in shelf[room]:
                common &= bitmap
            shared[room] = common
        else:
            del shelf[room]
            rooms &= ~(1 << room)

    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, want = sizes[k], wanted[k]
        room, target, bitmap = capacity, len(used), 0
        left = rooms >> size
        at = size
        while left:
            skip = (left & -left).bit_length() - 1
            at += skip
            left >>= skip
            if not shared[at] & want:
                fitting = [(bins[0], b) for b, bins in shelf[at].items() if not b & want]
                if fitting:
                    target, bitmap = min(fitting)
                    room = at
                    heapq.heappop(shelf[at][bitmap])
                    if not shelf[at][bitmap]:
                        del shelf[at][bitmap]
                    note(at)
                    break
            left >>= 1
            at += 1
        if target == len(used):
            used.append(0)
        placed[k] = (target, used[target])
        used[target] += size
        if room > size:
            heapq.heappush(shelf.setdefault(room - size, {}).setdefault(bitmap | want, []), target)
            note(room - size)
    return placed


def n_words() -> Column:
    """Words of ``text`` (runs of anything but the six ASCII blanks) and one end mark."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return (F.size(words) + 1).cast("bigint")


def pack(
    docs: DataFrame, length: Column | None = None, cluster: Column | None = None, capacity: int = CAPACITY, shard: int = SHARD
) -> DataFrame:
    """One row per piece: doc_id, piece, n_tokens, bin_id, start.

    ``length`` defaults to words and an end mark, so ``capacity`` is in words; ``cluster`` to the
    document's SimHash group (near copies, and texts linked by them).
    A document longer than ``capacity`` is cut into full pieces and a rest; full pieces fill a bin each.
    Null texts have length 1, a null source is a source, a null doc_id stays null. Repeated rows are
    documents of one cluster. An empty table gives an empty result. Other columns are ignored.

    Texts are measured in one pass and left behind. Pieces (five numbers each) are dealt to shards by a
    hash of their own, so neither a hot source nor a hot cluster gathers in a task; each shard of about
    ``shard`` pieces is packed by itself, which costs at most the last bins of each shard.
    """
    source, n = F.col("source").cast("string"), length if length is not None else n_words()
    if cluster is not None:
        measured = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), source.alias("source"), cluster.alias("cluster"), n.alias("n"))
    else:
        prints = materialize(simhash.fingerprints(docs, extra={"source": source, "n": n}), "measured")
        labelled = materialize(simhash.with_labels(prints.select("fp").distinct()), "clusters").withColumnRenamed("fp", "code")
        measured = prints.join(labelled, F.col("fp") == F.col("code"), "left").select("doc_id", "source", F.col("label").alias("cluster"), "n")
    pieces = materialize(
        measured.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0)))))
        .select(
            "doc_id", "source", "cluster", F.col("piece").cast("int").alias("piece"),
            F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).cast("int").alias("n_tokens"),
        ),
        "pieces",
    )
    shards = max(1, -(-pieces.count() // shard))

    def handle(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
        placed = best_fit(*(table[c].to_pylist() for c in ("n_tokens", "source", "cluster")), capacity)
        number = table["shard"][0].as_py() << 32
        return pa.table(
            {
                "doc_id": table["doc_id"], "piece": table["piece"], "n_tokens": table["n_tokens"],
                "bin_id": pa.array([number | b for b, _ in placed], pa.int64()),
                "start": pa.array([s for _, s in placed], pa.int32()),
            }
        )

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster", "source"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(handle, "doc_id bigint, piece int, n_tokens int, bin_id bigint, start int")


def op8_conflict_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
