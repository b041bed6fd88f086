"""Hard negatives: rotated one-bit codes bound every inner product, what the bounds leave is scored in integers.

A vector x is written as a sum of a few codes and a rest: ``x = c1 b1 + … + ck bk + r``. Code j is the sign
pattern of the rest so far under the j-th rotation, scaled to length one; ``cj`` is the stored alignment of the
rest with its code, so ``r`` is orthogonal to the last code. For a query q the products ``<bj, q>`` come from
popcounts over the bit planes of the rotated, rounded query, and the Cauchy-Schwarz inequality bounds the rest:
``|<r, q>| <= |r| sqrt(|q|^2 - <bk, q>^2)``. So each code gives an interval that holds the true product, and a row
is dropped only when its interval shows that it cannot be in the result; there is no chance of a miss.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import materialize, read, width
from lumenrec.operators.lists import top_n

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW_PERCENT, HIGH_PERCENT = 50, 95
ANCHORS = 50
#: Components are held in 32 bits and cut to this size, so that sums of products fit 64 bits.
LARGEST = 1 << 26
#: Rows that a task holds at once.
GROUP_ROWS = 1 << 17
CODES = 6
#: Bits of a rounded query component.
PLANES = 8


def rotations(dim: int, codes: int) -> list[np.ndarray]:
    """Random orthogonal matrices, the same in every task."""
    rng = np.random.default_rng(11)
    return [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(codes)]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


@dataclass
class Query:
    """A query as bit planes, one set for each rotation."""

    planes: list[list[np.ndarray]]  # per rotation: PLANES rows of words
    step: list[float]
    total: list[int]
    error: list[float]  # length of what rounding took away
    norm: float

    @classmethod
    def of(cls, q: np.ndarray, turns: list[np.ndarray]) -> Query:
        planes, step, total, error = [], [], [], []
        for turn in turns:
            u = turn @ q
            size = max(float(np.abs(u).max(initial=0)), 1e-300) / (2 ** (PLANES - 1) - 1)
            whole = np.rint(u / size).astype(np.int64)
            shifted = whole + 2 ** (PLANES - 1)
            planes.append([packed((shifted >> j & 1).astype(bool)[None])[0] for j in range(PLANES)])
            step.append(size)
            total.append(int(whole.sum()))
            error.append(float(np.linalg.norm(u - whole * size)))
        return cls(planes, step, total, error, float(np.linalg.norm(q)))


@dataclass
class Group:
    """Coded rows, sorted by label, id and copy."""

    ids: np.ndarray
    copies: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: list[np.ndarray]
    align: list[np.ndarray]
    rest: list[np.ndarray]
    turns: list[np.ndarray]

    @classmethod
    def of(cls, ids: np.ndarray, copies: np.ndarray, labels: np.ndarray, vectors: np.ndarray, turns: list[np.ndarray]) -> Group:
        by = np.lexsort((copies, ids, labels))
        first = np.append(True, (np.diff(ids[by]) != 0) | (np.diff(copies[by]) != 0)) if len(by) else by
        by = by[np.asarray(first, bool)]
        ids, copies, labels, vectors = ids[by], copies[by], labels[by], vectors[by]
        rest, codes, align, left = vectors.astype(np.float64), [], [], []
        for turn in turns:
            turned = rest @ turn.T
            sign = turned > 0
            code = np.where(sign, 1.0, -1.0) / np.sqrt(vectors.shape[1])
            c = (turned * code).sum(axis=1)
            rest = (turned - c[:, None] * code) @ turn
            codes.append(packed(sign))
            align.append(c)
            left.append(np.linalg.norm(rest, axis=1))
        return cls(ids, copies, labels, vectors, codes, align, left, turns)

    def same_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def product(self, q: Query, j: int, at: np.ndarray) -> np.ndarray:
        """``<bj, q>`` of the rows ``at``, up to ``q.error[j]``, by popcounts."""
        code = self.codes[j][at]
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        inside = np.zeros(len(at), np.int64)
        for bit, plane in enumerate(q.planes[j]):
            inside += np.bitwise_count(code & plane).sum(axis=1, dtype=np.int64) << bit
        inside -= ones << (PLANES - 1)
        return (2 * inside - q.total[j]) * (q.step[j] / np.sqrt(self.vectors.shape[1]))

    def survivors(self, q: Query, at: np.ndarray, keeps: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The rows of ``at`` that ``keeps`` (lower bounds, upper bounds → mask) leaves, code after code."""
        mid, wide = np.zeros(len(at)), np.zeros(len(at))
        for j in range(len(self.codes)):
            b = self.product(q, j, at)
            mid += self.align[j][at] * b
            wide += np.abs(self.align[j][at]) * q.error[j]
            across = np.sqrt(np.maximum(q.norm**2 - np.maximum(np.abs(b) - q.error[j], 0) ** 2, 0))
            rest = self.rest[j][at]
            # the last terms cover the rounding of these sums themselves
            half = wide + rest * across + 1e-9 * (np.abs(mid) + q.norm * rest) + 1e-6 * (1 + 1e-6 * q.norm)
            mask = keeps(mid - half, mid + half)
            at, mid, wide = at[mask], mid[mask], wide[mask]
        return at

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact integer products."""
        rows = self.vectors[at]
        most = float(np.abs(rows).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q)
        if most < 2**53:
            return np.rint(rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return rows.astype(np.int64) @ q.astype(np.int64)

    def best(self, at: np.ndarray, score: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        by = np.lexsort((self.copies[at], self.ids[at], -score))[:n]
        return at[by], score[by]


def kth_largest(x: np.ndarray, k: int) -> float:
    return -np.inf if len(x) < k else float(np.partition(x, len(x) - k)[len(x) - k])


def nearest(group: Group, anchor: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best other rows of the anchor's label in the group."""
    a, b = group.same_label(anchor["label"])
    at = np.arange(a, b)
    at = at[(group.ids[at] != anchor["vec_id"]) | (group.copies[at] != anchor["copy"])]
    q = anchor["vector"]
    if len(at) > n:
        at = group.survivors(
            Query.of(q.astype(np.float64), group.turns), at, lambda low, high: high >= kth_largest(low, n)
        )
    return group.best(at, group.scores(q, at), n)


def limits(score: int) -> tuple[int, int]:
    """Smallest and largest score of a negative for a positive's score, in whole numbers."""
    return -(-LOW_PERCENT * score // 100), HIGH_PERCENT * score // 100


def in_bands(group: Group, anchor: dict, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each score of a positive: the ``n`` best rows of other labels between its limits."""
    a, b = group.same_label(anchor["label"])
    at = np.append(np.arange(a), np.arange(b, len(group.ids)))
    q = anchor["vector"]
    bands = [(s, *limits(s)) for s in sorted(set(anchor["scores"]))]
    bands = [x for x in bands if x[1] <= x[2]]

    def keeps(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for _, least, most in bands:
            sure = low[(low >= least) & (high <= most)]
            keep |= (high >= max(least, kth_largest(sure, n))) & (low <= most)
        return keep

    at = group.survivors(Query.of(q.astype(np.float64), group.turns), at, keeps)
    score = group.scores(q, at)
    for s, least, most in bands:
        inside = (score >= least) & (score <= most)
        yield s, *group.best(at[inside], score[inside], n)


def vectors_of(table: pa.RecordBatch | pa.Table, dim: int) -> np.ndarray:
    """The vectors as a matrix; shorter ones end in zeros."""
    column = table["vector"]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dim), np.int32)
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy()
    return out


def meet(batches: Iterator[pa.RecordBatch], dim: int, codes: int, answer: Callable) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (grp, kind): a group's rows are coded and held, then its anchors pass by."""
    turns = rotations(dim, codes)
    waiting: list[pa.RecordBatch] = []
    group, current = None, None
    for batch in batches:
        grp, kind = batch["grp"].to_numpy(), batch["kind"].to_numpy()
        cuts = np.flatnonzero(np.append(True, (np.diff(grp) != 0) | (np.diff(kind) != 0))) if len(grp) else []
        for a, b in zip(cuts, [*cuts[1:], len(grp)]):
            part = batch.slice(a, b - a)
            if grp[a] != current:
                waiting, group, current = [], None, grp[a]
            if kind[a] == 0:
                waiting.append(part)
                continue
            if group is None and waiting:
                held = pa.Table.from_batches(waiting)
                group = Group.of(
                    held["vec_id"].to_numpy(), held["copy"].to_numpy(), held["label"].to_numpy(), vectors_of(held, dim), turns
                )
                waiting = []
            if group is not None:
                yield from answer(group, part, vectors_of(part, dim))


def anchors_of(part: pa.RecordBatch, vectors: np.ndarray) -> Iterator[dict]:
    scores = part["scores"].to_pylist() if "scores" in part.schema.names else [()] * part.num_rows
    columns = (part[c].to_pylist() for c in ("vec_id", "copy", "label"))
    for i, copy, label, vector, s in zip(*columns, vectors, scores):
        yield {"vec_id": i, "copy": copy, "label": label, "vector": vector, "scores": s}


_FOUND = ("anchor_id", "anchor_copy", "positive_score", "other_id", "other_copy", "score")


def found_rows(anchors: list[tuple]) -> Iterator[pa.RecordBatch]:
    if anchors:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*anchors)], names=list(_FOUND))


def rows_of(embeddings: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, copy, label, vector array<int>): the rows that take part. ``copy`` tells rows under one id apart."""
    vector, limit = F.col(vector_col).cast("array<double>"), float(LARGEST)
    good = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), vector.alias("_v"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_v").isNotNull() & good)
        .select("vec_id", "label", F.transform("_v", lambda x: _whole(x, limit)).alias("vector"))
        .select("vec_id", F.xxhash64("label", "vector").alias("copy"), "label", "vector")
    )


def _whole(x: Column, limit: float) -> Column:
    return F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), F.lit(256.0) * x))).cast("int")


def hard_negatives(rows: DataFrame, anchors: DataFrame, group_rows: int = GROUP_ROWS, codes: int = CODES) -> DataFrame:
    """``rows`` and ``anchors`` (vec_id, copy, label, vector array<int>) → anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    An anchor's positives are the five rows of its label with the largest products; its negatives, for each
    positive, the three rows of other labels with the largest products between 50 and 95 percent of the
    positive's. Equal products go by id. The result is exact.

    Rows are dealt to groups of about ``group_rows``, which bounds what a task holds; every anchor passes by
    every group, a batch at a time. Only five and three rows an anchor and group are shuffled. Rows that repeat
    (same id, label and vector) are one row; other rows under one id are rows of their own. Vectors of unequal
    length end in zeros. No rows or no anchors give an empty result.
    """
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    dim, partitions = max(shape.dim or 0, 1), width(rows)
    groups = max(-(-shape.n // group_rows), min(partitions, -(-shape.n // 1024)), 1)
    held = rows.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("kind", F.lit(0))
    asked = anchors.dropDuplicates(["vec_id", "copy"])

    def passes(asking: DataFrame, answer: Callable) -> DataFrame:
        dealt = asking.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("kind", F.lit(1))
        # groups are numbered, so they can be dealt in turn: no task gets many of them while others have none
        placed = held.unionByName(dealt, allowMissingColumns=True).repartitionById(min(groups, 8 * partitions), F.col("grp"))
        return placed.sortWithinPartitions("grp", "kind").mapInArrow(
            lambda batches: meet(batches, dim, codes, answer), ", ".join(f"{c} bigint" for c in _FOUND)
        )

    def positives_in(group: Group, part: pa.RecordBatch, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        out = []
        for anchor in anchors_of(part, vectors):
            at, score = nearest(group, anchor, POSITIVES)
            key = (anchor["vec_id"], anchor["copy"], None)
            out += [(*key, i, c, s) for i, c, s in zip(group.ids[at].tolist(), group.copies[at].tolist(), score.tolist())]
        return found_rows(out)

    def negatives_in(group: Group, part: pa.RecordBatch, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        out = []
        for anchor in anchors_of(part, vectors):
            for wanted, at, score in in_bands(group, anchor, NEGATIVES):
                key = (anchor["vec_id"], anchor["copy"], wanted)
                out += [(*key, i, c, s) for i, c, s in zip(group.ids[at].tolist(), group.copies[at].tolist(), score.tolist())]
        return found_rows(out)

    order = [F.col("score").desc(), F.col("other_id"), F.col("other_copy")]
    positives = materialize(
        top_n(passes(asked, positives_in), ["anchor_id", "anchor_copy"], order, POSITIVES).select(
            "anchor_id", "anchor_copy", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )
    wanted = positives.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_copy").alias("copy")).agg(
        F.collect_set("positive_score").alias("scores")
    )
    found = passes(asked.join(wanted, ["vec_id", "copy"]), negatives_in)
    key = ["anchor_id", "anchor_copy", "positive_score"]
    return (
        positives.join(top_n(found, key, order, NEGATIVES, pos="rank"), key)
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )


def op11_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th row as anchor against all rows; ids divisible by 7 carry the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows_of(read(spark, sf_dir, "embeddings").withColumn("label", label))
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHORS == 0))


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
