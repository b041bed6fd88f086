"""Tiered top lists that follow adds and deletes without ranking whole lists again.

For every (key, category, risk) a reserve holds the best postings, more than the tiers need, and a bound: the last
place that the reserve is sure about. A posting better than the bound is in the reserve or not there at all, so adds
and deletes are settled inside it. Only a reserve that deletes have brought below the size of the tiers is filled up
from the whole list, and only if the list holds more than the reserve.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenrec.operators.postings import LIST_SIZE, POSTING, tiered_top
from lumenrec.operators.reduced import distinct_keys, per_key
from lumenrec.session import materialize

LIST = ["search_key", "category", "risk"]


@dataclass(frozen=True)
class Reserve:
    """``rows``: the postings of the reserves. ``bounds``: ``LIST`` and ``bound``, the place up to which a
    list's reserve is whole (null: it holds the whole list); one row per list that is not empty."""

    rows: DataFrame
    bounds: DataFrame
    size: int = LIST_SIZE
    spare: int = 2 * LIST_SIZE


def _place() -> Column:
    """Where a posting stands in its list: smaller is better, no two postings of a list are equal."""
    return F.struct((-F.col("score")).alias("less"), "item_id", "highlight")


def _listed(postings: DataFrame) -> DataFrame:
    """What can be in a tier: shown postings of risk 0 to 2, each once."""
    return postings.where("highlight <> '' and risk <= 2").select(*POSTING)


def _cut(postings: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """The first ``keep`` of every list, and the bounds of these reserves: both from heads that are written once."""
    order = Window.partitionBy(*LIST).orderBy(F.col("score").desc(), F.col("item_id"), F.col("highlight"))
    # One more than is kept tells whether there is more. Copies share a rank and go with the distinct.
    ranked = postings.withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= keep + 1)
    head = materialize(ranked.distinct(), "heads")
    ends = head.groupBy(*LIST).agg(
        F.max(F.when(F.col("_rank") <= keep, _place())).alias("_last"), F.max("_rank").alias("_most")
    )
    bounds = ends.select(*LIST, F.when(F.col("_most") > keep, F.col("_last")).alias("bound"))
    return head.where(F.col("_rank") <= keep).select(*POSTING), bounds


def build(postings: DataFrame, size: int = LIST_SIZE, spare: int = 2 * LIST_SIZE) -> Reserve:
    """Reserves of ``size + spare`` postings a list."""
    rows, bounds = _cut(_listed(postings), size + spare)
    return Reserve(rows, bounds, size, spare)


def stored(reserve: Reserve) -> Reserve:
    """The reserve written and read again, as between two batches."""
    return Reserve(materialize(reserve.rows, "reserve"), materialize(reserve.bounds, "bounds"), reserve.size, reserve.spare)


def top(reserve: Reserve, markers: DataFrame | None = None) -> DataFrame:
    """The tiers, as ``tiered_top`` gives them; ``markers`` are delete markers, which always stay."""
    rows = reserve.rows.select(*POSTING)
    return tiered_top(rows if markers is None else rows.unionByName(markers.select(*POSTING)), reserve.size)


def change(reserve: Reserve, adds: DataFrame, deletes: DataFrame) -> tuple[Reserve, DataFrame]:
    """``(reserve, short)`` after a batch: deletes first, then adds.

    ``deletes`` are postings (their ``POSTING`` columns) that were in the lists, ``adds`` postings that are new.
    ``short`` has the lists (``LIST``) that may lack postings of a tier now; ``refill`` mends them. All others
    are right as they are. Reserves that grow past twice the spare are cut, and their bounds with them.
    """
    gone, new = _listed(deletes).distinct(), _listed(adds).distinct()
    kept = reserve.rows.join(gone, POSTING, "left_anti")
    # An add behind the bound goes to the unseen rest of its list. A list without a bound takes all.
    bounds = reserve.bounds.select(*LIST, F.col("bound"))
    settled = (
        new.join(bounds, LIST, "left").where(F.col("bound").isNull() | (_place() <= F.col("bound"))).select(*POSTING)
    )
    grown = kept.unionByName(settled).distinct()
    rows, cut = _cut(grown, reserve.size + 2 * reserve.spare)
    # A list that was cut just now has a nearer bound than before.
    known = per_key(cut.withColumnRenamed("bound", "_cut"), LIST, F.first("_cut").alias("_cut"))
    merged = bounds.join(known, LIST, "full").select(*LIST, F.coalesce("_cut", "bound").alias("bound"))
    have = per_key(rows, LIST, F.count(F.lit(1)).alias("_have"))
    sized = merged.join(have, LIST, "left").select(*LIST, "bound", F.coalesce("_have", F.lit(0)).alias("_have"))
    # The bounds and the short lists come from one pass; few short lists, as usual, can be sent to the whole lists.
    sized = materialize(sized, "sized")
    short = materialize(sized.where(F.col("bound").isNotNull() & (F.col("_have") < reserve.size)).select(*LIST), "short")
    left = sized.where(F.col("bound").isNotNull() | (F.col("_have") > 0)).select(*LIST, "bound")
    return Reserve(rows, left, reserve.size, reserve.spare), short


def refill(reserve: Reserve, short: DataFrame, postings: DataFrame) -> Reserve:
    """Fill the reserves of some lists from the whole lists (``postings`` after the batch).

    Only these lists are ranked; give the postings of their keys if the storage can find them.
    """
    only = distinct_keys(short, *LIST)
    rows, bounds = _cut(_listed(postings).join(only, LIST, "left_semi"), reserve.size + reserve.spare)
    return Reserve(
        reserve.rows.join(only, LIST, "left_anti").unionByName(rows),
        reserve.bounds.join(only, LIST, "left_anti").unionByName(bounds), reserve.size, reserve.spare,
    )
