"""Per-key lists: top-n, take, shuffle, quotas, folds.

Every list has a total order (score first, id last), so results do not depend on
how rows were partitioned. ``row_number() <= n`` windows are planned by Spark with
a partial group limit before the shuffle, so a hot key sends at most n rows per
map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenrec.functions.ordering import digest_number, shuffle_digest
from lumenrec.operators.reduced import per_key
from lumenrec.session import materialize
from lumenrec.sources.catalog import only_category

TAKE, RANDOM, TAKE_AND_RANDOM = "take", "random", "take_and_random"


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, pos: str = "pos"
) -> DataFrame:
    """The first ``n`` rows of every key (``n`` inclusive) and their position."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(pos, F.row_number().over(window)).where(F.col(pos) <= n)
    return ranked.withColumn(pos, F.col(pos).cast("bigint"))


def shuffled_positions(df: DataFrame, key: str, item: str, seed: int = 7, pos: str = "pos", digits: int = 4) -> DataFrame:
    """Position of every row in a repeatable random order of its key's whole list.

    A list may hold a large share of all rows, so no task ranks a whole list. Rows are
    folded by key and the leading ``digits`` of their hexadecimal digest; a slice's rows
    are numbered in its array, and the rows before it come from a running sum over the
    at most ``16 ** digits`` slices of the key. The input is read once.
    """
    digest = shuffle_digest(seed, key, item)
    rows = df.where(F.col(key).isNotNull())
    rest = [c for c in df.columns if c != key]
    entry = F.struct(digest.alias("_digest"), F.col(item).alias("_item"), F.struct(*rest).alias("_row"))
    slices = rows.groupBy(key, F.substring(digest, 1, digits).alias("_slice")).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    return _numbered(slices, key, ["_slice"], [F.col("_slice")], pos).select(
        *[F.col(key) if c == key else F.col(f"_entry._row.{c}").alias(c) for c in df.columns], pos
    )


def ordered_positions(
    df: DataFrame, key: str, item: str, value: str, pos: str = "pos", width: int = 65536, list_rows: int = 20_000
) -> DataFrame:
    """``(key, item, pos)``: place of every row in its key's whole list, largest ``value`` first, then by item.

    A list of up to ``list_rows`` rows is numbered by one window, so its rows are shuffled once. Longer ones are
    for values that repeat, such as counts, sums and days: their rows are folded by key and
    value (and by ranges of ``width`` ids), so a hot list is numbered in many tasks and
    only its distinct values pass one window. The input is read twice, first for the lengths.
    """
    rows = df.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, item, value]))
    sizes = per_key(rows, [key], F.count(F.lit(1)).alias("_size"))
    long = materialize(sizes.where(F.col("_size") > list_rows).select(key), "long-lists")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col(value).desc(), F.col(item)))
    number = lambda short: short.select(key, item, place.cast("bigint").alias(pos))
    if long.isEmpty():
        return number(rows)
    return number(rows.join(long, key, "left_anti")).unionByName(
        _sliced_positions(rows.join(long, key, "left_semi"), key, item, value, pos, width)
    )


def _sliced_positions(rows: DataFrame, key: str, item: str, value: str, pos: str, width: int) -> DataFrame:
    whole = dict(rows.dtypes)[item] in ("int", "bigint", "smallint")
    span = F.floor(F.col(item) / width) if whole else F.lit(0)
    entry = F.struct(F.col(item).alias("_item"))
    slices = rows.groupBy(key, F.col(value).alias("_value"), span.alias("_span")).agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    return _numbered(slices, key, ["_value", "_span"], [F.col("_value").desc(), F.col("_span")], pos).select(key, F.col("_entry._item").alias(item), pos)


def _numbered(slices: DataFrame, key: str, parts: Sequence[str], order: Sequence[Column], pos: str) -> DataFrame:
    """Rows of ordered slices (``key``, ``parts``, ``_rows``) with their position in the key's list.

    Only the slices' sizes meet at their key; the rows stay where their slice was folded and get the offset by
    a join on key and slice.
    """
    before = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.select(F.col(key).alias("_key"), *parts, F.size("_rows").alias("_n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        "_key", "_before", *[F.col(c).alias(f"_of{c}") for c in parts]
    )
    same = F.col(key) == F.col("_key")
    for c in parts:
        same &= F.col(c).eqNullSafe(F.col(f"_of{c}"))
    placed = slices.join(offsets, same).select(key, "_before", F.posexplode("_rows").alias("_at", "_entry"))
    return placed.withColumn(pos, (F.col("_before") + F.col("_at") + 1).cast("bigint"))


def list_operation(
    df: DataFrame,
    key: str,
    item: str,
    order: Sequence[Column],
    operation: str,
    n: int = -1,
    min_size: int = 0,
    seed: int = 7,
) -> DataFrame:
    """TAKE n, shuffle all (n unused) or TAKE n then shuffle, per key → (key, item, pos).

    With ``min_size`` a key with fewer rows is dropped; looking at the first
    ``min_size`` rows is enough to know, so no list is counted in full.
    """
    if operation == TAKE:
        kept = _take(df, key, order, n, min_size)
    elif operation == TAKE_AND_RANDOM:
        # At most n rows per key are left, so one window may rank them.
        taken = _take(df, key, order, n, min_size).drop("pos")
        kept = top_n(taken, [key], [shuffle_digest(seed, key, item), F.col(item)], n)
    elif operation == RANDOM:
        rows = df
        if min_size > 0:
            big = top_n(df, [key], order, min_size).where(F.col("pos") == min_size).select(key)
            rows = df.join(big, key, "left_semi")
        kept = shuffled_positions(rows, key, item, seed)
    else:
        raise ValueError(f"unknown list operation {operation!r}")
    return kept.select(key, item, "pos")


def _take(df: DataFrame, key: str, order: Sequence[Column], n: int, min_size: int) -> DataFrame:
    if min_size <= 0:
        return top_n(df, [key], order, n)
    head = top_n(df, [key], order, max(n, min_size))
    size = F.count(F.lit(1)).over(Window.partitionBy(key))
    return head.withColumn("_size", size).where((F.col("_size") >= min_size) & (F.col("pos") <= n)).drop("_size")


def random_take(df: DataFrame, key: str, item: str, n: int, seed: int = 7) -> DataFrame:
    """``n`` random rows per key, in random order."""
    return top_n(df, [key], [shuffle_digest(seed, key, item), F.col(item)], n).select(key, item, "pos")


def random_head(df: DataFrame, key: str, item: str, n: int, seed: int = 7) -> DataFrame:
    """The first ``n`` distinct items of each key's shuffled list → (key, item, rank).

    What RANDOM gives, cut before the shuffle; repeated rows of an item share its place.
    """
    order = Window.partitionBy(key).orderBy(shuffle_digest(seed, key, item), F.col(item))
    placed = df.where(F.col(key).isNotNull()).withColumn("_place", F.dense_rank().over(order)).where(F.col("_place") <= n)
    return placed.select(key, item, F.col("_place").cast("bigint").alias("rank"))


def random_head_shared(members: DataFrame, shared: DataFrame, key: str, group: str, item: str, n: int, seed: int = 7) -> DataFrame:
    """``random_head`` of the lists of ``members (key, group)``, where all keys of a group have its items → (key, item, rank).

    ``shared`` has ``(group, item)``. The digests are spread evenly, so their first places are sought below a digest
    that leaves somewhat more than ``n`` items of a list; only these rows are ranked. A key for which fewer than
    ``n`` of its items lie there, which is rare, has its whole list ranked.
    """
    entries = shared.select(group, item).where(F.col(group).isNotNull()).distinct()
    sizes = per_key(entries, [group], F.count(F.lit(1)).alias("_size"))
    wanted = F.lit(n + 8 * n**0.5 + 20) / F.col("_size")
    below = F.when(wanted < 1, F.lower(F.lpad(F.hex((wanted * 2**32).cast("bigint")), 8, "0"))).otherwise("g").alias("_below")
    known = members.select(key, group).where(F.col(key).isNotNull()).join(sizes.select(group, "_size", below), group)
    met = _met_in_shares(known, entries, sizes, key, group, item)
    near = met.where(F.substring(shuffle_digest(seed, key, item), 1, 8) < F.col("_below"))
    head = materialize(random_head(near, key, item, n, seed), "random-head")
    found = per_key(head, [key], F.max("rank").alias("_found"))
    short = materialize(
        known.join(found, key, "left").where(F.coalesce("_found", F.lit(0)) < F.least(F.lit(n), "_size")).select(key, group), "short-heads"
    )
    if short.isEmpty():
        return head
    rest = random_head(short.join(entries, group), key, item, n, seed)
    return head.join(short.select(key).distinct(), key, "left_anti").unionByName(rest)


# Pairs of a member and an item that are formed in one place, and items in one array.
_SHARE_PAIRS, _SHARE_ITEMS = 2**23, 2**16


def _met_in_shares(known: DataFrame, entries: DataFrame, sizes: DataFrame, key: str, group: str, item: str) -> DataFrame:
    """``known`` with every item of its group. Members and items are few bytes, but their pairs are many.

    So a group's members are dealt to shares by their pairs, the group's items go to each of its shares as arrays,
    and the number of partitions follows the pairs, not the bytes.
    """
    counts = per_key(known, [group], F.count(F.lit(1)).alias("_members")).join(sizes, group)
    shares = materialize(
        counts.select(group, "_size", F.ceil(F.col("_members") * F.col("_size") / _SHARE_PAIRS).cast("int").alias("_shares")), "shares"
    )
    tasks = max(2 * known.sparkSession.sparkContext.defaultParallelism, (shares.agg(F.sum("_shares")).first()[0] or 0) // 4)
    share = F.pmod(F.xxhash64(key), "_shares").cast("int").alias("_share")
    dealt = known.join(shares.select(group, "_shares"), group).select(*known.columns, share).repartition(tasks, group, "_share")
    part = F.pmod(F.xxhash64(item), F.ceil(F.col("_size") / _SHARE_ITEMS)).alias("_part")
    arrays = entries.join(shares, group).groupBy(group, "_shares", part).agg(F.collect_list(F.struct(item)).alias("_items"))
    sent = arrays.select(group, F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share"), "_items")
    met = dealt.join(sent.repartition(tasks, group, "_share"), [group, "_share"])
    return met.select(*known.columns, F.explode("_items").alias("_one")).select(*known.columns, F.col(f"_one.{item}"))


def first_items(df: DataFrame, keys: Sequence[str], item: str, order: Sequence[Column], n: int) -> DataFrame:
    """All rows of the first ``n`` distinct items of every key's list."""
    placed = df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    first = placed.withColumn("_first", F.min("_place").over(Window.partitionBy(*keys, item)))
    nth = F.dense_rank().over(Window.partitionBy(*keys).orderBy("_first"))
    return first.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_place", "_first", "_nth")


def stratified_sample(
    df: DataFrame, key: str, item: str, quotas: Mapping[str, int], seed: int = 7
) -> DataFrame:
    """A random take per key with its own quota; keys without a quota are left out."""
    quota = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    wanted = df.where(F.col(key).isin(list(quotas)))
    return random_take(wanted, key, item, max(quotas.values()), seed).where(
        F.col("pos") <= quota[F.col(key)]
    )


def fold_list(
    df: DataFrame, key: str, item: str, pos: str, n: int | None = None, out: str = "id", slice_rows: int = 100_000
) -> DataFrame:
    """One row per key with the items of its list in rank order.

    With ``n`` only the first ``n``. Without, the whole list by its positions 1, 2, …; a
    list longer than ``slice_rows`` gives several rows, numbered by ``slice``, so no array
    holds a hot key's list.
    """
    ordered = F.sort_array(F.collect_list(F.struct("_pos", F.col(item).alias("item"))))
    items = F.transform(ordered, lambda x: x["item"]).alias(out)
    if n is not None:
        return top_n(df, [key], [F.col(pos), F.col(item)], n, "_pos").groupBy(key).agg(items)
    part = F.floor((F.col(pos) - 1) / slice_rows).cast("bigint").alias("slice")
    return df.withColumn("_pos", F.col(pos)).groupBy(key, part).agg(items)


def fold_scored(
    df: DataFrame, key: str, item: str, score: str, n: int | None = None, name: str = "item", out: str = "items",
    slice_rows: int = 100_000,
) -> DataFrame:
    """One row per key with ``(item, score)`` pairs, best first.

    With ``n`` only the ``n`` best. Without, all of them; a list longer than
    ``slice_rows`` gives several rows, numbered by ``slice``, each best first.
    """
    pair = lambda x: F.struct(x["item"].alias(name), x["score"].alias("score"))
    if n is not None:
        head = top_n(df, [key], [F.col(score).desc(), F.col(item)], n, "_pos")
        ordered = F.sort_array(
            F.collect_list(F.struct("_pos", F.col(item).alias("item"), F.col(score).alias("score")))
        )
        return head.groupBy(key).agg(F.transform(ordered, pair).alias(out))
    entry = F.struct((-F.col(score)).alias("_order"), F.col(item).alias("item"), F.col(score).alias("score"))
    chunks = fold_chunks(df, [key], [item], entry, slice_rows)
    return chunks.select(key, F.col("chunk").alias("slice"), F.transform("entries", pair).alias(out))


def fold_matrix(
    df: DataFrame, key: str, item: str, score: str, n: int | None = None, out: str = "items", slice_rows: int = 100_000
) -> DataFrame:
    """One row per key (and slice of a long list) with ``(item, score)`` pairs, best first."""
    return fold_scored(df, key, item, score, n, out=out, slice_rows=slice_rows)


def fold_chunks(
    df: DataFrame, keys: Sequence[str], parts: Sequence[str], payload: Column, chunk_rows: int
) -> DataFrame:
    """Fold a list of unknown length into rows of about ``chunk_rows`` entries.

    A key's rows are spread by digest of ``parts`` over ``ceil(size / chunk_rows)``
    chunks, so no array and no task holds a whole hot list. Output: keys, ``chunk``,
    ``n`` and the sorted ``entries``.
    """
    rows = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    sizes = per_key(rows, keys, F.count(F.lit(1)).alias("_size")).where(F.col("_size") > chunk_rows)
    # Most lists are one chunk. The others are written first: where they are few Spark sends them to the rows,
    # which are then shuffled once, else both sides get an exchange and Spark can split a hot key.
    long = materialize(sizes.select(*keys, F.ceil(F.col("_size") / chunk_rows).cast("bigint").alias("_chunks")), "long-lists")
    chunk = F.when(F.col("_chunks").isNotNull(), digest_number(*parts) % F.col("_chunks")).otherwise(0).cast("bigint")
    placed = rows.join(long, list(keys), "left").select(*keys, chunk.alias("chunk"), payload.alias("_entry"))
    # Grouping could go on in the join's own partitions, a hot key in one of them; the
    # shuffle on the chunk spreads it.
    placed = placed.repartition(*keys, "chunk")
    return placed.groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("_entry")).alias("entries")
    )


def popularity_top_n(
    scores: DataFrame, item: str, n: int, min_score: float = 0.1, category: str = "all"
) -> DataFrame:
    """Items by number of scores above the floor, most first."""
    rows = only_category(scores, category)
    counts = rows.where(F.col("score") > min_score).groupBy(item).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.col("cnt").desc(), F.col(item)).limit(n)
