"""Sides of a join that have one row per key.

An aggregate on the join key leaves its rows partitioned by that key, and Spark joins them in place.
Then no exchange stands directly below the join, and adaptive execution, which splits a hot partition
only between two such exchanges, cannot split the other side. The functions here group by the keys and
a hash of them: the same groups, but a partitioning that the join cannot use, so it gets an exchange of
its own (of one row per key) and the big side can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df.groupBy(keys).agg(aggregates)`` for the small side of a join on the keys."""
    return df.groupBy(*keys, F.hash(*keys).alias("_spread")).agg(*aggregates).drop("_spread")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The distinct values of the keys for the small side of a join on them."""
    return df.select(*keys, F.hash(*keys).alias("_spread")).distinct().drop("_spread")
