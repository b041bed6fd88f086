"""Item-to-item similarity: by cluster, from sparse vectors, from dense vectors.

The vector forms are exact. Sparse vectors meet on their features; on a feature that very
many items share only those meet that bounds of their cosine leave over, in slices of their
own tasks. Dense vectors meet in
blocks, and only in those that angles to pivots leave open: one Arrow group per pair of blocks multiplies them with numpy and hands back only
the best ``n`` partners of each left row.

Scores are compared in whole millionths, so near ties rank the same on any CPU.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lumenrec.operators.lists import top_n
from lumenrec.operators.reduced import distinct_keys, per_key
from lumenrec.session import materialize

# The block functions travel with the job; executors need numpy and pyarrow only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1_000_000.0
# Sorts after every real cell, and can be negated.
_SELF = -(2**62)


def similar_by_cluster(prefer: DataFrame, detail: DataFrame, n: int = 70) -> DataFrame:
    """For each preferred item the ``n`` most popular other items of its cluster.

    The detail side is cut to ``n + 1`` per cluster (one may be the item itself) and
    folded before the join, so the join meets one short row per cluster.
    """
    # Ranked and folded by the cluster and a hash of it, for the reason given in ``reduced``.
    keys = ["cluster", "_spread"]
    best = top_n(detail.withColumn("_spread", F.hash("cluster")), keys, [F.col("popularity").desc(), F.col("item_id")], n + 1)
    ordered = F.sort_array(F.collect_list(F.struct("pos", "item_id")))
    lists = best.groupBy(*keys).agg(F.transform(ordered, lambda x: x["item_id"]).alias("_list")).drop("_spread")
    others = F.slice(F.filter("_list", lambda other: other != F.col("item_id")), 1, n)
    return (
        prefer.select("item_id", "cluster").join(lists, "cluster")
        .select("item_id", F.posexplode(others).alias("_at", "other_id"))
        .select("item_id", "other_id", (F.col("_at") + 1).cast("bigint").alias("pos"))
    )


def similar_dense(
    vectors: DataFrame, n: int = 60, within: str | None = None, block_rows: int = 8192, pivots: int = 64
) -> DataFrame:
    """Cosine top-``n`` of ``(item_id, vector)`` → ``(item_id, other_id, sim_ppm, pos)``.

    With ``within`` only items that share that column's value are compared. A group of more
    than ``block_rows`` items is cut into blocks of items that lie near one pivot. A block first
    meets itself; it then meets those blocks of its group that the angles between pivots and the
    radii of the blocks do not put behind the ``n``-th best of all its rows (``block_pairs``). So
    nothing is lost, and how much is skipped depends on how far the vectors cluster. Pivots are
    the ``pivots`` rows with the smallest id hash, the only rows that the driver gets. Blocks should
    be well over ``n`` rows: a row with fewer partners in its own block has no bound.
    Item ids may be of any type that can be ordered. The number of partitions does not depend
    on the number of blocks: a task multiplies several pairs one after the other.
    """
    group = F.lit(0) if within is None else F.col(within)
    rows = vectors.where("item_id is not null and vector is not null").select(
        "item_id", F.col("vector").cast("array<double>").alias("vector"), group.alias("_group")
    )
    many = per_key(rows, ["_group"], F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows).select(F.col("_group").alias("_g"))
    if many.isEmpty():
        whole = rows.withColumn("_block", F.lit("0"))
        return _best(_multiplied(whole, whole, ["_group", "_block"], n), n)
    many = materialize(many, "large-groups")
    placed, angles = _in_blocks(rows, many, block_rows, pivots)
    near, pairs = block_pairs(placed, angles, n)
    return _best(near.unionByName(_met_in_panels(placed, pairs.where("meets").drop("meets"), n)), n)


# A group's blocks are sent in at most about so many panels, unless a panel had more than so many numbers.
_PANELS, _PANEL_CELLS = 16, 2**23


def _panels(placed: DataFrame) -> DataFrame:
    """``_group, _block, _panel``: neighbouring blocks of a group in panels of like size."""
    first = placed.select(F.size("vector")).first()
    most = max(1, _PANEL_CELLS // max(1, first[0] if first else 1))
    sizes = placed.groupBy("_group", "_block").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_group")
    before = F.sum("_n").over(whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    size = F.least(F.ceil(F.sum("_n").over(whole) / _PANELS), F.lit(most))
    return sizes.select("_group", "_block", F.floor(F.coalesce(before, F.lit(0)) / size).cast("int").alias("_panel"))


def _met_in_panels(placed: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """The ``n`` best partners of every row in each panel it meets; ``pairs`` has ``_group, left, right``, blocks that meet.

    A block goes once to every panel that holds a block it meets, not once to every such block: what is shuffled
    is the rows times the panels and not times the blocks. A task gets two panels and the list of their blocks that
    meet, which comes as a row of its own on the left side.
    """
    keys = ["_group", "_left", "_right"]
    panels = materialize(_panels(placed), "panels")

    def with_panel(df: DataFrame, group: str, block: str, as_: str) -> DataFrame:
        of = panels.select(F.col("_group").alias("_of"), F.col("_block").alias("_at"), F.col("_panel").alias(as_))
        return df.join(of, F.col(group).eqNullSafe(F.col("_of")) & (F.col(block) == F.col("_at"))).drop("_of", "_at")

    told = with_panel(with_panel(pairs, "_group", "left", "_left"), "_group", "right", "_right")
    lists = materialize(told.groupBy(*keys).agg(F.collect_list(F.struct("left", "right")).alias("_pairs")), "panel-pairs")
    base = with_panel(placed.select("item_id", "vector", F.col("_group").alias("_g"), "_block"), "_g", "_block", "_panel")

    def side(mine: str) -> DataFrame:
        place = F.col("_g").eqNullSafe(F.col("_group")) & (F.col("_panel") == F.col(mine))
        return base.join(lists.drop("_pairs"), place).select("item_id", "vector", "_block", *keys)

    left = side("_left").unionByName(lists, allowMissingColumns=True)
    return _cogrouped(left, side("_right"), keys, _panel_task(n))


def _multiplied(left: DataFrame, right: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` best right partners of every left row, among the rows with equal keys."""
    return _cogrouped(left, right, keys, _dense_task(n))


def _cogrouped(left: DataFrame, right: DataFrame, keys: list[str], task: Callable) -> DataFrame:
    tasks = 4 * left.sparkSession.sparkContext.defaultParallelism
    right = right.select([F.col(c).alias(c) for c in right.columns])  # fresh names: both sides may be one table
    met = left.repartition(tasks, *keys).groupBy(*keys).cogroup(right.repartition(tasks, *keys).groupBy(*keys))
    kind = left.schema["item_id"].dataType.simpleString()
    return met.applyInArrow(task, f"item_id {kind}, other_id {kind}, sim_ppm bigint")


def _in_blocks(rows: DataFrame, many: DataFrame, block_rows: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_cell`` (nearest pivot), ``_angle`` to it and ``_block``, and the angles between the pivots.

    A small group is one block. Zero vectors have no partners and are left out.
    """
    known = rows.where(F.exists("vector", lambda x: x != 0) & ~F.exists("vector", F.isnan))
    first = known.orderBy(F.xxhash64("item_id"), "item_id").limit(pivots).select("vector").collect()
    centres = np.array([r.vector for r in first], dtype=np.float64)
    if len(centres):
        centres /= np.sqrt((centres * centres).sum(axis=1))[:, None]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(batch.num_rows, -1)
            cosine = matrix @ centres.T / np.sqrt((matrix * matrix).sum(axis=1))[:, None]
            cell = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(cell)), cell], -1.0, 1.0))
            yield batch.append_column("_cell", pa.array(cell.astype(np.int32))).append_column("_angle", pa.array(angle))

    columns = [f"{f.name} {f.dataType.simpleString()}" for f in known.schema.fields]
    dealt = known.mapInArrow(nearest, ", ".join([*columns, "_cell int", "_angle double"]))
    large = dealt.join(many.withColumn("_large", F.lit(True)), F.col("_group").eqNullSafe(F.col("_g")), "left").drop("_g")
    large = large.withColumn("_cell", F.when(F.col("_large"), F.col("_cell")).otherwise(-1)).drop("_large")
    sizes = per_key(large, ["_group", "_cell"], F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_parts"))
    sizes = sizes.select(F.col("_group").alias("_g"), F.col("_cell").alias("_c"), "_parts")
    sized = large.join(sizes, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c"))).drop("_g", "_c")
    part = F.pmod(F.xxhash64("item_id"), F.col("_parts"))
    block = F.concat_ws(":", F.col("_cell").cast("string"), part.cast("string"))
    between = [
        (p, q, float(np.arccos(np.clip(centres[p] @ centres[q], -1.0, 1.0))) if p != q else 0.0)
        for p in range(len(centres)) for q in range(len(centres))
    ]
    angles = rows.sparkSession.createDataFrame(between, "_left_cell int, _right_cell int, _between double")
    return materialize(sized.withColumn("_block", block).drop("_parts"), "blocks"), angles


def block_pairs(placed: DataFrame, angles: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``(near, pairs)``: the best partners of every row in its own block, and all other ordered pairs of blocks.

    ``pairs`` has ``_group, left, right, meets``. For a row x of the left block with pivot p and a row y of the
    right one with pivot q, angle(x, y) >= angle(p, q) - angle(p, x) - angle(q, y). A right block does not meet
    the left one if the cosine so bounded lies behind the ``n``-th best that each left row has in its own block.
    """
    keys = ["_group", "_block"]
    plain = placed.select("item_id", "vector", *keys)
    near = materialize(_multiplied(plain, plain, keys, n), "near")
    # A row with fewer than n partners in its own block takes any other.
    last = per_key(near, ["item_id"], F.when(F.count(F.lit(1)) >= n, F.min("sim_ppm")).alias("_last"))
    worst = F.min(F.coalesce("_last", F.lit(-2 * int(SCALE)))).alias("_worst")
    told = placed.select("item_id", *keys, "_cell", "_angle").join(last, "item_id", "left")
    blocks = materialize(told.groupBy(*keys, "_cell").agg(F.max("_angle").alias("_radius"), worst), "block-bounds")
    left = blocks.select("_group", F.col("_block").alias("left"), F.col("_cell").alias("_left_cell"), F.col("_radius").alias("_r"), "_worst")
    right = blocks.select(
        F.col("_group").alias("_g"), F.col("_block").alias("right"), F.col("_cell").alias("_right_cell"), F.col("_radius").alias("_s")
    )
    others = left.join(right, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("left") != F.col("right")))
    least = F.greatest(F.lit(0.0), F.col("_between") - F.col("_r") - F.col("_s"))
    # One millionth of slack covers the rounding of the angles.
    meets = F.floor(F.cos(least) * SCALE + 0.5) + 1 >= F.col("_worst")
    return near, others.join(angles, ["_left_cell", "_right_cell"]).select("_group", "left", "right", meets.alias("meets"))


def similar_sparse(entries: DataFrame, n: int = 60, feature_rows: int = 4096) -> DataFrame:
    """Cosine top-``n`` of ``(item_id, feature, weight)`` with whole-number weights.

    Items that share a feature meet on it. The list of a feature's items is sent once to each part of the items
    that it has some of; a part forms all products of its items, sums them per pair and keeps the best, so pairs
    are never shuffled (``_rare_products``). Pairs whose products cancel to 0
    do not count. One row per (item, feature) is expected; ids of any type that can be ordered.

    Features of more than ``feature_rows`` items are hot. Pairs are first made from the other,
    rare features. By Cauchy-Schwarz the hot ones add at most the product of the two items'
    lengths in them, so every item gets a lower bound of its ``n``-th best partner, and pairs
    that cannot reach the bound of either item never meet on a hot feature (``hot_products``).
    """
    rows = materialize(
        entries.where("weight <> 0 and item_id is not null and feature is not null").select(
            "item_id", "feature", F.col("weight").cast("double").alias("w")
        ), "entries",
    )
    hot = materialize(_hot_features(rows, feature_rows), "hot-features")
    ppm = F.floor(_cosine() * SCALE).cast("bigint").alias("sim_ppm")
    if hot.isEmpty():
        kind, arrow = _id_types(rows)
        known = rows.join(_lengths(rows, hot).drop("h"), "item_id")
        return _rare_products(known, _ranked(n, arrow), f"item_id {kind}, other_id {kind}, sim_ppm bigint, pos bigint")
    rare, met = hot_products(rows, hot, n)
    dots = rare.unionByName(met).groupBy("a", "b", "na", "nb").agg(F.sum("dot").alias("dot")).where("dot <> 0")
    return _best(_both(dots, ppm), n)


def _id_types(rows: DataFrame) -> tuple[str, pa.DataType]:
    """Spark's name of the ids' type, and Arrow's type."""
    return rows.schema["item_id"].dataType.simpleString(), to_arrow_type(rows.schema["item_id"].dataType)


def _hot_features(rows: DataFrame, feature_rows: int) -> DataFrame:
    """Features of more than ``feature_rows`` items, and in how many slices each is compared."""
    counts = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > feature_rows).select("feature", F.ceil(F.col("_n") / feature_rows).cast("int").alias("slices"))


def _lengths(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Per item the squared length ``norm`` and ``h``, the share of its length that lies in hot features.

    ``h`` is negative for an item with a negative weight there.
    """
    told = rows.join(hot.select("feature", F.lit(True).alias("_hot")), "feature", "left")
    square = F.when(F.col("_hot"), F.col("w") * F.col("w")).otherwise(0.0)
    sums = per_key(
        told, ["item_id"], F.sum(F.col("w") * F.col("w")).alias("norm"), F.sum(square).alias("_square"),
        F.max(F.coalesce(F.col("_hot") & (F.col("w") < 0), F.lit(False))).alias("_below"),
    )
    share = F.sqrt(F.col("_square") / F.col("norm"))
    return sums.select("item_id", "norm", F.when(F.col("_below"), -share).otherwise(share).alias("h"))


# Entries that a task packs, entries that a task reads (some 20 bytes each), products a task forms, products at a time.
_PACKED, _PART_ENTRIES, _PART_PRODUCTS, _PIECE = 2**23, 3 * 2**23, 2**28, 2**21


def _part_numbers(known: DataFrame) -> tuple[int, int]:
    """In how many parts the items are dealt, and in how many groups the features that send them their lists.

    A list of m items goes to about p (1 - (1 - 1/p)^m) of p parts. The fewer parts, the fewer copies of the lists
    are shuffled, so the number is doubled from the cores' until a part's share of the lists fits its bound.
    """
    sizes = known.groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    choices = [known.sparkSession.sparkContext.defaultParallelism * 2**k for k in range(16)]
    reads = [F.sum(F.col("_n") * (1 - F.pow(F.lit(1 - 1 / p), F.col("_n")))) for p in choices]
    work, *reads = sizes.agg(F.sum(F.col("_n") * F.col("_n")), *reads).first()
    if work is None:
        return choices[0], choices[0]
    fits = (k for k, p in enumerate(choices) if reads[k] <= _PART_ENTRIES and work / p <= _PART_PRODUCTS)
    best = next(fits, len(choices) - 1)
    return choices[best], max(choices[0], int(reads[best] * choices[best] / _PACKED) + 1)


def _rare_products(known: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``task`` for every part of the items, over the summed products of all pairs that share a feature, in both directions.

    ``known`` has ``item_id, feature, w, norm`` and, if the task reads them, ``h, step``. All rows of an item are in one
    part, so the task can rank its partners. What is shuffled are the features' lists, packed, each once for every part
    with an item of it; no pair is.
    """
    parts, groups = _part_numbers(known)
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int").alias("_to")
    group = F.pmod(F.xxhash64("feature", F.lit(1)), F.lit(groups)).alias("_from")
    dealt = known.withColumns({"_to": part, "_from": group}).repartition(groups, "_from").groupBy("_from")
    packed = dealt.applyInArrow(_pack_lists, "_part int, _lists binary")
    return packed.repartition(parts, "_part").groupBy("_part").applyInArrow(task, schema)


def _lean(values: np.ndarray) -> pa.Array:
    """Whole numbers in the shortest type that holds them."""
    if len(values) and np.isfinite(values).all():
        for kind in (np.int8, np.int16, np.int32):
            bounds = np.iinfo(kind)
            if values.min() >= bounds.min and values.max() <= bounds.max and (values == (short := values.astype(kind))).all():
                return pa.array(short)
    return pa.array(values)


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first[i]``, …, ``first[i] + size[i] - 1`` of every i in a row."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _pack_lists(table: pa.Table) -> pa.Table:
    """The lists of a group's features, for each part those with an item of it: one compressed Arrow stream a part."""
    feature = table.column("feature").combine_chunks().dictionary_encode().indices.to_numpy()
    ids = table.column("item_id").combine_chunks()
    whole = pa.types.is_integer(ids.type)
    # Whole numbers are sent as steps, which are short.
    order = np.lexsort((ids.to_numpy(), feature)) if whole else np.argsort(feature, kind="stable")
    table, ids, feature = table.take(pa.array(order)), ids.take(pa.array(order)), feature[order]
    size = np.bincount(feature)
    first = np.cumsum(size) - size
    part = table.column("_to").to_numpy().astype(np.int64)
    send = np.unique(part * len(size) + feature)
    to, lists = send // len(size), send % len(size)
    edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
    numbers = {c: table.column(c).to_numpy() for c in ("w", "norm", "h", "step") if c in table.column_names}
    out = []
    for begin, end in zip(edges[:-1], edges[1:]):
        mine = lists[begin:end]
        at = _ragged(first[mine], size[mine])
        those = ids.take(pa.array(at))
        if whole:
            those = _lean(np.diff(those.to_numpy().astype(np.int64), prepend=0))
        columns = {"id": those, "mine": pa.array(part[at] == to[begin])} | {c: _lean(v[at]) for c, v in numbers.items()}
        offsets = pa.array(np.append(0, np.cumsum(size[mine])).astype(np.int32))
        batch = pa.record_batch({"list": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(columns.values()), list(columns)))})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)
        out.append(sink.getvalue())
    return pa.table({"_part": pa.array(to[edges[:-1]].astype(np.int32)), "_lists": pa.array([b.to_pybytes() for b in out], pa.binary())})


class _Lists:
    """The lists that a part was sent. Items are numbered in the order of their ids."""

    def __init__(self, table: pa.Table, kind: pa.DataType) -> None:
        streams = (pa.ipc.open_stream(b.as_buffer()).read_all().column("list") for b in table.column("_lists"))
        lists = [chunk for stream in streams for chunk in stream.chunks]
        self.size = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists]).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        entries = [x.flatten() for x in lists]
        if pa.types.is_integer(kind):
            ids = pa.array(np.concatenate([np.cumsum(e.field("id").to_numpy(), dtype=np.int64) for e in entries]))
        else:
            ids = pa.concat_arrays([e.field("id") for e in entries])
        coded = ids.dictionary_encode()
        del ids
        order = pc.sort_indices(coded.dictionary).to_numpy()
        self.ids = coded.dictionary.take(pa.array(order)).cast(kind)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.item = rank[coded.indices.to_numpy()]
        del coded
        column = lambda c: np.concatenate([e.field(c).to_numpy(zero_copy_only=False) for e in entries])
        self.w = column("w")
        own = np.flatnonzero(column("mine"))
        rows = own[np.argsort(self.item[own], kind="stable")]
        # One row per item of the part and list that it is in.
        self.rows, self.list = rows, np.repeat(np.arange(len(self.size)), self.size)[rows]
        self.of: dict[str, np.ndarray] = {}
        for c in ("norm", "h", "step"):
            if entries[0].type.get_field_index(c) >= 0:
                self.of[c] = np.zeros(len(order))
                self.of[c][self.item] = column(c)

    def products(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Items, partners and summed products, all pairs of some items at a time, in the order of both."""
        many = self.size[self.list]
        before = np.append(0, np.cumsum(many))
        item = self.item[self.rows]
        ends = np.append(np.flatnonzero(np.diff(item)) + 1, len(item))  # where the items' rows end
        at = 0
        while at < len(item):
            # As many items as stay in a piece, at least one; what a single one has beyond it is added up piece by piece.
            reach = np.searchsorted(before[ends], before[at] + _PIECE, side="right") - 1
            end = ends[max(reach, np.searchsorted(ends, at, side="right"))]
            held = None
            while at < end:
                stop = min(end, max(at + 1, np.searchsorted(before, before[at] + _PIECE, side="right") - 1))
                piece = self._formed(slice(at, stop))
                held = piece if held is None else _added(*(np.concatenate(x) for x in zip(held, piece)))
                at = stop
            a, b, dot = held
            other = a != b
            yield a[other], b[other], dot[other]

    def _formed(self, where: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, lists = self.rows[where], self.list[where]
        many = self.size[lists]
        partner = _ragged(self.first[lists], many)
        return _added(np.repeat(self.item[rows], many), self.item[partner], np.repeat(self.w[rows].astype(np.float64), many) * self.w[partner])


def _added(a: np.ndarray, b: np.ndarray, dot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in order, each once, with the sum of its products."""
    key = (a.astype(np.int64) << 32) + b
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return (key[first] >> 32), (key[first] & 0xFFFFFFFF), np.add.reduceat(dot[order], first) if len(first) else dot


def _ranked(n: int, kind: pa.DataType) -> Callable:
    """The ``n`` best partners of every item of a part, of those whose products do not cancel."""

    def task(table: pa.Table) -> pa.Table:
        lists, found = _Lists(table, kind), []
        for a, b, dot in lists.products():
            real = dot != 0
            a, b, dot = a[real], b[real], dot[real]
            norm = lists.of["norm"]
            a, b, ppm = _keep_best(a, b, np.floor(dot / np.sqrt(norm[a] * norm[b]) * SCALE).astype(np.int64), n)
            found.append((a, b, ppm, np.arange(len(a)) - np.searchsorted(a, a, side="left") + 1))
        a, b, ppm, pos = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found) if found else [()] * 4))
        return pa.table({"item_id": lists.ids.take(pa.array(a)), "other_id": lists.ids.take(pa.array(b)), "sim_ppm": ppm, "pos": pos})

    return task


def _bounded(n: int, kind: pa.DataType) -> Callable:
    """Pairs of every item of a part that may be among its ``n`` best or meet it on hot features, and its bound.

    The bound is what its ``n``-th best partner has at least, null without one. See ``hot_products``.
    """

    def task(table: pa.Table) -> pa.Table:
        lists, found = _Lists(table, kind), []
        norm, h, step = (lists.of[c] for c in ("norm", "h", "step"))
        for a, b, dot in lists.products():
            cosine, reach = dot / np.sqrt(norm[a] * norm[b]), np.abs(h[a] * h[b])
            least = cosine - np.where((h[a] < 0) | (h[b] < 0), reach, 0.0)
            order = np.lexsort((b, -least, a))
            last = np.searchsorted(a, a, side="left") + n - 1  # pairs lie in the order of a, so does the n-th best place
            there = (last < len(a)) & (a[np.minimum(last, len(a) - 1)] == a)
            nth = np.where(there, least[order[np.minimum(last, len(a) - 1)]], 0.0)
            # One millionth of slack on either side keeps rounding on the safe side.
            bound = np.where(nth > 0, nth - 2 / SCALE, np.nan)
            with np.errstate(divide="ignore", invalid="ignore"):
                wanted = bound / np.abs(h[a])
                # A little more than Spark's own logarithm may find; it judges again.
                asks = np.where(wanted <= 1.0, np.minimum(np.floor(-2.0 * np.log2(wanted) + 1e-6), _STEPS), -1)
            asks = np.where(np.isnan(bound) | (bound <= 0), _STEPS, asks)
            meets = (h[a] != 0) & (h[b] != 0) & (asks >= step[b])
            kept = np.isnan(bound) | (cosine + reach >= bound) | meets
            found.append([x[kept] for x in (a, b, dot, bound)])
        empty = [np.empty(0, np.int64)] * 2 + [np.empty(0)] * 2
        a, b, dot, bound = (np.concatenate([e, *x]) for e, x in zip(empty, zip(*found) if found else [()] * 4))
        return pa.table({
            "a": lists.ids.take(pa.array(a)), "b": lists.ids.take(pa.array(b)), "na": norm[a], "nb": norm[b], "ha": h[a], "hb": h[b],
            "dot": dot, "bound": pa.array(bound, mask=np.isnan(bound)),
        })

    return task


def _cosine() -> Column:
    return F.col("dot") / F.sqrt(F.col("na") * F.col("nb"))


def _both(pairs: DataFrame, *columns: Column) -> DataFrame:
    """Every pair in both directions, as ``item_id`` and ``other_id``."""
    ways = F.array(*[F.struct(F.col(x).alias("item_id"), F.col(y).alias("other_id")) for x, y in ("ab", "ba")])
    return pairs.select(F.explode(ways).alias("_x"), *columns).select("_x.*", *[c for c in pairs.select(*columns).columns])


# Items are told apart by their length in hot features in steps of the square root of 2; the last step has no end.
_STEPS = 10


def _step(length: Column) -> Column:
    return F.least(F.floor(-2.0 * F.log2(length) + 1e-9), F.lit(_STEPS)).cast("int")


def hot_products(rows: DataFrame, hot: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``(rare, met)``: summed rare products and single hot products of all pairs that may be among an ``n`` best.

    Both have ``a, b, na, nb, dot``; a pair that occurs has all its products. An item asks for the others whose
    hot length reaches what its bound wants from pairs without rare features; only these meet it on a hot feature
    (the steps of hot lengths are part of the join key, so others are not even compared). A pair with rare
    features that did not meet so, and whose upper bound reaches a bound, gets its hot products by its ids.
    """
    known = rows.join(_lengths(rows, hot), "item_id")
    cold = known.join(distinct_keys(hot, "feature"), "feature", "left_anti")
    # What hot features add at most; without negative weights they take nothing away (``_bounded``).
    reach = F.abs(F.col("ha") * F.col("hb"))
    most = _cosine() + reach
    length = F.abs("h")
    wanted = F.col("bound") / length
    asks = F.when(F.col("bound").isNull() | (F.col("bound") <= 0), _STEPS).when(wanted <= 1.0, _step(wanted)).otherwise(-1)
    # Where an item's pairs are formed, its bound is known and all that cannot be among its best goes.
    kind, arrow = _id_types(rows)
    marked = cold.withColumn("step", F.when(length > 0, _step(length)).otherwise(0)).withColumn("h", F.coalesce("h", F.lit(0.0)))
    kept = materialize(
        _rare_products(
            marked, _bounded(n, arrow),
            f"a {kind}, b {kind}, na double, nb double, ha double, hb double, dot double, bound double",
        ), "rare-pairs",
    )
    turned = F.col("a") > F.col("b")
    one = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
    sides = ["a", "b", "na", "nb", "ha", "hb"]
    rare = kept.select(
        *[one(c, c[:-1] + ("b" if c[-1] == "a" else "a")).alias(c) for c in sides], "dot"
    ).groupBy(*sides).agg(F.max("dot").alias("dot"))
    bounds = per_key(kept.select(F.col("a").alias("item_id"), "bound"), ["item_id"], F.max("bound").alias("bound"))
    items = distinct_keys(known, "item_id", "norm", "h").join(bounds, "item_id", "left")
    stats = materialize(
        items.select("item_id", "norm", "h", "bound", F.when(length > 0, _step(length)).alias("at"), F.when(length > 0, asks).otherwise(-1).alias("asks")),
        "hot-lengths",
    )

    warm = rows.join(hot, "feature").join(stats.where("at is not null").drop("bound", "h"), "item_id").withColumn(
        "own", F.pmod(F.xxhash64("item_id"), "slices").cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    asking = warm.where("asks >= 0").withColumn("other", every).withColumn("step", F.explode(F.sequence(F.lit(0), F.col("asks"))))
    left = asking.select("feature", "own", "other", "step", *[F.col(c).alias(c + "_x") for c in ("item_id", "w", "norm", "at", "asks")])
    # Only for the slices that ask; most items of a hot feature are not asked for.
    askers = distinct_keys(left, "feature", "own", "step").select(
        F.col("feature").alias("f"), F.col("own").alias("own_"), F.col("step").alias("step_")
    )
    right = warm.join(askers, (F.col("feature") == F.col("f")) & (F.col("at") == F.col("step_"))).select(
        "f", F.col("own").alias("other_"), "own_", "step_",
        *[F.col(c).alias(c + "_y") for c in ("item_id", "w", "norm", "asks")],
    )
    x, y = F.col("item_id_x"), F.col("item_id_y")
    place = (F.col("feature") == F.col("f")) & (F.col("own") == F.col("own_")) & (F.col("other") == F.col("other_"))
    # Of two items that ask for each other the smaller one makes the product.
    once = (x < y) | ((x > y) & (F.col("asks_y") < F.col("at_x")))
    pairs = left.join(right, place & (F.col("step") == F.col("step_")) & once)
    first = x < y
    asked = pairs.select(
        F.when(first, x).otherwise(y).alias("a"), F.when(first, y).otherwise(x).alias("b"),
        F.when(first, F.col("norm_x")).otherwise(F.col("norm_y")).alias("na"),
        F.when(first, F.col("norm_y")).otherwise(F.col("norm_x")).alias("nb"), (F.col("w_x") * F.col("w_y")).alias("dot"),
    )

    side = lambda mine: stats.select(
        F.col("item_id").alias(mine), F.col("bound").alias("t" + mine), F.col("at").alias("at_" + mine), F.col("asks").alias("asks_" + mine)
    )
    judged = rare.join(side("a"), "a").join(side("b"), "b")
    meets = F.coalesce((F.col("asks_a") >= F.col("at_b")) | (F.col("asks_b") >= F.col("at_a")), F.lit(False))
    may = (most >= F.coalesce("ta", most)) | (most >= F.coalesce("tb", most))
    judged = materialize(judged.withColumn("_meets", meets).where(F.col("_meets") | may), "judged-pairs")
    by_id = judged.where(~F.col("_meets") & (F.col("ha") != 0) & (F.col("hb") != 0)).select("a", "b", "na", "nb")
    of_a = warm.select(F.col("item_id").alias("a"), "feature", F.col("w").alias("wa"))
    of_b = warm.select(F.col("item_id").alias("b"), "feature", F.col("w").alias("wb"))
    looked_up = by_id.join(of_a, "a").join(of_b, ["b", "feature"]).select("a", "b", "na", "nb", (F.col("wa") * F.col("wb")).alias("dot"))
    columns = ["a", "b", "na", "nb", "dot"]
    return judged.select(*columns), asked.select(*columns).unionByName(looked_up.select(*columns))


def _best(pairs: DataFrame, n: int) -> DataFrame:
    return top_n(pairs, ["item_id"], [F.col("sim_ppm").desc(), F.col("other_id")], n)


def _keep_best(row: np.ndarray, col: np.ndarray, ppm: np.ndarray, n: int):
    """The n best cells of every row; among equal scores the one that comes first."""
    # |ppm| <= 10**6 < 2**21, so row and falling score fit one integer key.
    order = np.argsort((row << 22) + (2**21 - ppm), kind="stable")
    row, col, ppm = row[order], col[order], ppm[order]
    first = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - first < n
    return row[keep], col[keep], ppm[keep]


def _unit_rows(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """Ids in order, and length-1 vectors; zero vectors are left out."""
    table = table.combine_chunks().sort_by("item_id")
    ids = table.column("item_id").combine_chunks()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(ids), -1)
    norm = np.sqrt((matrix * matrix).sum(axis=1))
    good = norm > 0
    return ids.filter(pa.array(good)), matrix[good] / norm[good, None]


def _best_of(rows: np.ndarray, b: np.ndarray, mine: np.ndarray, itself: np.ndarray, n: int, chunk: int):
    """The n best columns of every row; row ``mine[i]`` is the same item as column ``itself[i]``."""
    best = (np.empty(0, dtype=np.int64),) * 3
    same = max(1, np.bincount(mine).max(initial=0))  # columns that a row leaves out
    for start in range(0, len(b), chunk):
        ppm = np.floor(rows @ b[start : start + chunk].T * SCALE + 0.5).astype(np.int64)
        width = ppm.shape[1]
        # One number per cell that orders by score, then by lower id; no ties.
        order = ppm * width - np.arange(width)
        here = (itself >= start) & (itself < start + width)
        order[mine[here], itself[here] - start] = _SELF
        k = min(n + same, width)
        cell = np.sort(np.argpartition(-order, k - 1, axis=1)[:, :k], axis=1).ravel()
        row = np.repeat(np.arange(len(rows)), k)
        real = order[row, cell] != _SELF
        row, cell = row[real], cell[real]
        best = _keep_best(
            np.concatenate([best[0], row]),
            np.concatenate([best[1], start + cell]),
            np.concatenate([best[2], ppm[row, cell]]),
            n,
        )
    return best


def _dense_task(n: int, chunk: int = 1024) -> Callable:
    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = (left if left.num_rows else right).schema.field("item_id").type
        none_of = best = (np.empty(0, dtype=np.int64),) * 3
        ids = others = pa.array([], kind)
        if left.num_rows and right.num_rows:
            ids, a = _unit_rows(left)
            others, b = _unit_rows(right)
            # Where the right block holds a left item itself (ids are unique).
            found = pc.index_in(ids, value_set=others)
            mine = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
            itself = pc.drop_null(found).to_numpy()
            parts = []
            for top in range(0, len(ids), chunk):  # a square of cells at a time, however many rows a block has
                rows = a[top : top + chunk]
                there = (mine >= top) & (mine < top + len(rows))
                part = _best_of(rows, b, mine[there] - top, itself[there], n, chunk)
                parts.append((top + part[0], part[1], part[2]))
            best = tuple(np.concatenate(x) for x in zip(none_of, *parts))
        return pa.table({"item_id": ids.take(pa.array(best[0])), "other_id": others.take(pa.array(best[1])), "sim_ppm": best[2]})

    return multiply


def _panel_task(n: int, chunk: int = 1024) -> Callable:
    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = left.schema.field("item_id").type
        plain = ["item_id", "vector", "_block"]
        rows = left.filter(pc.is_null(left.column("_pairs"))).select(plain)
        met: dict[str, set[str]] = {}
        for pair in (p for row in left.column("_pairs").drop_null().to_pylist() for p in row):
            met.setdefault(pair["left"], set()).add(pair["right"])
        # Left blocks that meet the same right blocks are multiplied together.
        alike: dict[frozenset[str], list[str]] = {}
        for block, others in met.items():
            alike.setdefault(frozenset(others), []).append(block)
        found = []
        for others, blocks in alike.items():
            ids, a = _unit_rows(rows.filter(pc.is_in(rows.column("_block"), pa.array(blocks, pa.string()))).select(plain[:2]))
            near, b = _unit_rows(right.filter(pc.is_in(right.column("_block"), pa.array(sorted(others), pa.string()))).select(plain[:2]))
            if not len(ids) or not len(near):
                continue
            # Equal ids are neighbours on the right.
            known = near.unique()
            place = pc.index_in(near, value_set=known).to_numpy(zero_copy_only=False)
            mine = pc.fill_null(pc.index_in(ids, value_set=known), -1).to_numpy(zero_copy_only=False)
            first, last = np.searchsorted(place, mine, side="left"), np.searchsorted(place, mine, side="right")
            same = np.repeat(np.arange(len(ids)), last - first)
            itself = np.concatenate([np.empty(0, dtype=np.int64), *(np.arange(first[r], last[r]) for r in np.flatnonzero(last > first))])
            for top in range(0, len(ids), chunk):
                part_of = a[top : top + chunk]
                there = (same >= top) & (same < top + len(part_of))
                row, col, ppm = _best_of(part_of, b, same[there] - top, itself[there], n, chunk)
                found.append((ids.take(pa.array(top + row)), near.take(pa.array(col)), ppm))
        return pa.table({
            "item_id": pa.chunked_array([f[0] for f in found], kind), "other_id": pa.chunked_array([f[1] for f in found], kind),
            "sim_ppm": np.concatenate([np.empty(0, dtype=np.int64), *(f[2] for f in found)]),
        })

    return multiply
