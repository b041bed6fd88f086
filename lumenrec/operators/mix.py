"""Mixing several ranked candidate lists into one list per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumenrec.operators.lists import top_n

STACKING, RATIO = "stacking", "ratio"


def mix(
    sources: Sequence[DataFrame],
    key: str,
    item: str,
    n: int,
    mode: str = STACKING,
    ratio: Sequence[int] | None = None,
    short: bool = False,
) -> DataFrame:
    """Merge ``(key, item, rank)`` lists → ``(key, item, pos, score)`` with ``score = 1 / pos``.

    STACKING takes source 1 first and fills up from the next ones. RATIO takes
    ``ratio[s]`` items of each source in turn; an exhausted source is passed over.
    An item offered twice keeps its earliest place. Places are combined with
    ``min`` (partial aggregation on (key, item)) before the per-key limit. With ``short``
    no key has more than some hundred rows: these are shuffled once, by key, for both.
    """
    if mode == RATIO:
        if ratio is None or len(ratio) != len(sources):
            raise ValueError("RATIO needs one weight per source")
    elif mode != STACKING:
        raise ValueError(f"unknown mix mode {mode!r}")

    offers = None
    for index, source in enumerate(sources):
        place = _stack_place(index) if mode == STACKING else _turn_place(index, ratio)
        offer = source.select(key, item, place.alias("_place"))
        offers = offer if offers is None else offers.unionByName(offer)
    if short:
        offers = offers.repartition(key)
    first = offers.groupBy(key, item).agg(F.min("_place").alias("_place"))
    return (
        top_n(first, [key], [F.col("_place"), F.col(item)], n)
        .select(key, item, "pos", (F.lit(1.0) / F.col("pos")).alias("score"))
    )


def _stack_place(index: int) -> Column:
    """Orders by (source, rank). One number, because its minimum aggregates by hash."""
    return F.lit(index << 56) + F.col("rank")


def _turn_place(index: int, ratio: Sequence[int]) -> Column:
    """Orders by (turn, source, rank), where a source gives ``ratio`` ranks per turn."""
    before = F.col("rank") - 1
    turn = F.expr(f"(rank - 1) div {ratio[index]}")
    return (turn * len(ratio) + index) * max(ratio) + before % ratio[index]
