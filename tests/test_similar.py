from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenrec.operators import similar


def brute_force(vectors: dict[int, np.ndarray], n: int, rounding: float, positive: bool) -> list[tuple]:
    out = []
    for a, va in vectors.items():
        ranked = []
        for b, vb in vectors.items():
            dot = float(va @ vb)
            if a == b or not va.any() or not vb.any() or (positive and dot == 0):
                continue
            cosine = dot / np.sqrt(float(va @ va) * float(vb @ vb))
            ranked.append((-int(np.floor(cosine * 1e6 + rounding)), b))
        out += [(a, b, -s, i + 1) for i, (s, b) in enumerate(sorted(ranked)[:n])]
    return sorted(out)


@pytest.mark.parametrize("block", [1000, 7])
def test_dense_equals_brute_force(spark, block):
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=8) for i in range(60)}
    vectors[60] = np.zeros(8)
    for copy in range(61, 81):  # a group of copies: all tie with each other
        vectors[copy] = vectors[5].copy()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "item_id bigint, vector array<double>")
    got = similar.similar_dense(df, 6, block_rows=block)
    assert sorted(map(tuple, got.collect())) == brute_force(vectors, 6, 0.5, positive=False)


@pytest.mark.parametrize("options", [{}, {"feature_rows": 5}])
def test_sparse_equals_brute_force(spark, options):
    """Feature 0 is in every vector; items 0 and 1 have every feature (long rows)."""
    rng = np.random.default_rng(4)
    matrix = np.zeros((50, 20))
    for i in range(50):
        matrix[i, rng.choice(20, 4, replace=False)] = rng.integers(1, 9, 4)
    matrix[:40, 0] = 2
    matrix[0:2, :] = rng.integers(1, 9, (2, 20))
    entries = [(i, f, int(matrix[i, f])) for i, f in zip(*np.nonzero(matrix))]
    df = spark.createDataFrame([(int(i), int(f), w) for i, f, w in entries], "item_id bigint, feature bigint, weight bigint")
    got = similar.similar_sparse(df, 5, **options)
    assert sorted(map(tuple, got.collect())) == brute_force(dict(enumerate(matrix)), 5, 0.0, positive=True)


@pytest.mark.parametrize("seed", range(4))
def test_sparse_bounds_lose_no_partner(spark, seed):
    """Two hot features; groups of close items elsewhere, negative weights, items with hot features only, ties."""
    rng = np.random.default_rng(seed)
    matrix = np.zeros((90, 60))
    for i in range(80):
        group = 2 + 5 * (i % 8)
        matrix[i, group : group + 5] = rng.integers(3, 9, 5)
        matrix[i, rng.choice(60, 2, replace=False)] = rng.integers(-4, 9, 2)
    matrix[:70, 0] = rng.integers(1, 3, 70)
    matrix[30:88, 1] = rng.integers(-2, 6, 58)
    matrix[85] = matrix[84]
    entries = [(int(i), int(f), int(matrix[i, f])) for i, f in zip(*np.nonzero(matrix))]
    df = spark.createDataFrame(entries, "item_id bigint, feature bigint, weight bigint")
    got = similar.similar_sparse(df, 4, feature_rows=25)
    assert sorted(map(tuple, got.collect())) == brute_force(dict(enumerate(matrix)), 4, 0.0, positive=True)


def test_sparse_bounds_spare_products(spark):
    """All items share feature 0, but find their best partners on rare features."""
    rows = [(i, 0, 1.0) for i in range(300)] + [(i, 1 + i // 6 * 3 + k, 5.0) for i in range(300) for k in range(3)]
    df = spark.createDataFrame(rows, "item_id bigint, feature bigint, w double")
    hot = similar._hot_features(df, 50)
    rare, met = similar.hot_products(df, hot, 5)
    assert [r.feature for r in hot.collect()] == [0]
    # Within the 50 groups of six, 15 pairs each; all pairs of feature 0 would be 44,850.
    assert rare.count() == 750 and met.count() == 750


def test_dense_inside_groups(spark):
    rng = np.random.default_rng(6)
    vectors = {i: rng.normal(size=6) for i in range(40)}
    rows = [(i, v.tolist(), "hot" if i < 25 else f"g{i % 3}") for i, v in vectors.items()]
    df = spark.createDataFrame(rows, "item_id bigint, vector array<double>, g string")
    got = similar.similar_dense(df, 4, within="g", block_rows=6)
    want = []
    for name in {r[2] for r in rows}:
        want += brute_force({r[0]: vectors[r[0]] for r in rows if r[2] == name}, 4, 0.5, positive=False)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_dense_blocks_far_from_each_other_are_skipped(spark):
    """Twelve tight bunches: blocks of different bunches never meet, and the result is the whole one."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 10))
    vectors = {i: centres[i % 12] + 0.02 * rng.normal(size=10) for i in range(360)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "item_id bigint, vector array<double>")
    got = similar.similar_dense(df, 5, block_rows=40, pivots=24)
    assert sorted(map(tuple, got.collect())) == brute_force(vectors, 5, 0.5, positive=False)
    many = spark.createDataFrame([(0,)], "_g int")
    placed, angles = similar._in_blocks(df.withColumn("_group", F.lit(0)), many, 40, 24)
    _, pairs = similar.block_pairs(placed, angles, 5)
    counts = {r.meets: r["count"] for r in pairs.groupBy("meets").count().collect()}
    blocks = placed.select("_block").distinct().count()
    assert sum(counts.values()) == blocks * (blocks - 1) and counts[False] > counts[True]


def test_sparse_of_nothing(spark):
    assert similar.similar_sparse(spark.createDataFrame([], "item_id bigint, feature bigint, weight bigint")).count() == 0


@pytest.mark.parametrize("feature_rows", [1, 100])
def test_products_that_cancel_are_no_partners(spark, feature_rows):
    """Whatever the length of the lists and the slices of the features."""
    rows = [("a", 1, 2), ("a", 2, 3), ("b", 1, 3), ("b", 2, -2), ("c", 1, 1), ("c", 3, 5), ("d", 4, 1)]
    df = spark.createDataFrame(rows, "item_id string, feature int, weight int")
    got = {(r.item_id, r.other_id) for r in similar.similar_sparse(df, 5, feature_rows).collect()}
    assert got == {("a", "c"), ("c", "a"), ("b", "c"), ("c", "b")}


def test_text_ids(spark):
    """Vector lines → valid items → similarity, with ids as they stand in the lines."""
    from lumenrec.operators.filters import valid_only
    from lumenrec.sources.vectors import parse_vector_lines

    lines = spark.createDataFrame([("a1,1,0",), ("b2,1,0.1",), ("c3,0,1",), ("off,1,0",)], "value string")
    known = spark.createDataFrame([("a1",), ("b2",), ("c3",), ("c3",)], "item_id string")
    got = similar.similar_dense(valid_only(parse_vector_lines(lines, 2), known, "item_id"), 1).collect()
    assert {(r.item_id, r.other_id) for r in got} == {("a1", "b2"), ("b2", "a1"), ("c3", "b2")}
    assert dict(similar.similar_dense(valid_only(parse_vector_lines(lines, 2), known, "item_id"), 1).dtypes)["other_id"] == "string"


def test_partitions_do_not_grow_with_the_blocks(spark):
    df = spark.range(40).selectExpr("id as item_id", "array(double(id), 1.0) as vector")
    plans = [similar.similar_dense(df, 2, block_rows=b)._jdf.queryExecution().executedPlan().toString() for b in (40, 1)]
    numbers = [set(re.findall(r"REPARTITION_BY_NUM|hashpartitioning\([^)]*, (\d+)\)", p)) for p in plans]
    assert numbers[0] == numbers[1]


def test_cluster_lists_leave_out_the_item_itself(frame, rows):
    prefer = frame("item_id int, cluster string", (1, "a"), (9, "a"), (5, "none"))
    detail = frame("item_id int, cluster string, popularity int", (1, "a", 5), (2, "a", 5), (3, "a", 9), (4, "a", 1))
    got = similar.similar_by_cluster(prefer, detail, 2)
    assert rows(got) == [(1, 2, 2), (1, 3, 1), (9, 1, 2), (9, 3, 1)]


def test_products_are_not_shuffled(spark):
    """What is shuffled are the lists of the features; products are summed and ranked where they are formed."""
    df = spark.createDataFrame([(i, i % 7, 1) for i in range(50)], "item_id bigint, feature bigint, weight bigint")
    plan = similar.similar_sparse(df, 5)._jdf.queryExecution().executedPlan().toString()
    first = next(line for line in plan.splitlines() if re.search(r"\bExchange\b", line))
    assert "_part" in first and "REPARTITION_BY_NUM" in first


def test_memory_of_a_block_does_not_follow_its_square():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(9)
    table = pa.table({"item_id": np.arange(4000), "vector": pa.array(list(rng.normal(size=(4000, 8))))})
    tracemalloc.start()
    got = similar._dense_task(5)(table, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak", peak)
    assert peak < 90e6 and got.num_rows == 4000 * 5


def test_a_block_goes_once_to_a_panel(spark, monkeypatch):
    """Rows sent grow with the panels, not with the blocks."""
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=4) for i in range(400)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "item_id bigint, vector array<double>")
    sent, cogrouped = [], similar._cogrouped

    def counted(left, right, *rest):
        sent.append(left.count() + right.count())
        return cogrouped(left, right, *rest)

    monkeypatch.setattr(similar, "_cogrouped", counted)
    got = similar.similar_dense(df, 3, block_rows=5, pivots=4)
    assert sorted(map(tuple, got.collect())) == brute_force(vectors, 3, 0.5, positive=False)
    panels = similar._PANELS + 1
    assert len(sent) == 2 and sent[1] <= 2 * 400 * panels + panels**2  # about 80 blocks


def test_panels_are_bounded(spark, monkeypatch):
    rows = [(g, f"{b}:0") for g in (None, 1) for b in range(50) for _ in range(4)]
    placed = spark.createDataFrame(rows, "_group bigint, _block string").withColumn("vector", F.array(F.lit(1.0), F.lit(2.0)))
    sizes = lambda: [r["n"] for r in similar._panels(placed).groupBy("_group", "_panel").agg((4 * F.count("*")).alias("n")).collect()]
    assert sum(sizes()) == 400 and max(sizes()) <= 200 // similar._PANELS + 8
    monkeypatch.setattr(similar, "_PANEL_CELLS", 12)  # six rows of two numbers
    assert max(sizes()) <= 12


def test_lists_are_packed_and_products_summed_piece_by_piece(spark, monkeypatch):
    """A feature's list goes to a part in one compressed row with others, and the products never are Spark's rows."""
    rng = np.random.default_rng(11)
    matrix = rng.integers(-3, 6, (70, 12)) * (rng.random((70, 12)) < 0.4)
    matrix[0] = 3  # meets more partners than a piece holds
    entries = [(i * 2**33, f, int(matrix[i, f])) for i, f in zip(*(x.tolist() for x in np.nonzero(matrix)))]
    df = spark.createDataFrame(entries, "item_id bigint, feature bigint, weight bigint")
    got = similar.similar_sparse(df, 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("REPARTITION_BY_NUM")]
    assert "FlatMapGroupsInArrow" in above and not re.search(r"Aggregate|Window|Generate", above)
    found = brute_force(dict(enumerate(matrix.astype(float))), 5, 0.0, positive=True)
    assert sorted(map(tuple, got.collect())) == [(a * 2**33, b * 2**33, s, p) for a, b, s, p in found]

    import pyarrow as pa

    table = pa.table({
        "item_id": [e[0] for e in entries], "feature": [e[1] for e in entries], "w": [float(e[2]) for e in entries],
        "norm": [float((matrix[e[0] >> 33] ** 2).sum()) for e in entries], "_to": pa.array([0] * len(entries), pa.int32()),
    })
    whole = similar._ranked(5, pa.int64())(similar._pack_lists(table))
    monkeypatch.setattr(similar, "_PIECE", 40)
    pieces = similar._ranked(5, pa.int64())(similar._pack_lists(table))
    assert whole.equals(pieces) and whole.num_rows == len(found)


def test_fewest_parts_whose_lists_fit(spark, monkeypatch):
    df = spark.createDataFrame([(i, f) for f in range(10) for i in range(40)], "item_id bigint, feature bigint")
    cores = spark.sparkContext.defaultParallelism
    assert similar._part_numbers(df)[0] == cores
    monkeypatch.setattr(similar, "_PART_ENTRIES", 200)  # 400 entries; a list goes to nearly each of few parts
    parts, _ = similar._part_numbers(df)
    assert parts > cores and 400 * (1 - (1 - 1 / parts) ** 40) <= 200
