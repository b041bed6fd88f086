"""Raw ids and the canonical id that several raw ids share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lumenrec.operators.reduced import per_key


def one_row_per(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` values of every key.

    Written as ``min`` of a struct: it combines map-side, a window would not.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(key).agg(best).select(
        *[F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def canonical_map(relation: DataFrame) -> DataFrame:
    """One canonical id (the smallest) per raw id."""
    return per_key(relation, ["item_id"], F.min("canonical_id").alias("canonical_id"))


def with_canonical(df: DataFrame, mapping: DataFrame, column: str = "item_id") -> DataFrame:
    """Add ``canonical_id``: the mapped id, or the raw id where there is none."""
    lookup = mapping.select(F.col("item_id").alias(column), F.col("canonical_id").alias("_mapped"))
    return (
        df.join(lookup, column, "left")
        .withColumn("canonical_id", F.coalesce("_mapped", column))
        .drop("_mapped")
    )


def to_canonical(df: DataFrame, mapping: DataFrame, column: str = "item_id") -> DataFrame:
    """Replace ids by canonical ids, then one row per id (the lowest raw id's row)."""
    mapped = with_canonical(df, mapping, column)
    kept = one_row_per(mapped, "canonical_id", [column])
    return kept.select(*[F.col("canonical_id").alias(c) if c == column else c for c in df.columns])


def dedup_by_canonical(df: DataFrame, mapping: DataFrame, column: str = "item_id") -> DataFrame:
    """One row per canonical id; it keeps its real (lowest) id."""
    mapped = with_canonical(df, mapping, column)
    return one_row_per(mapped, "canonical_id", [column]).select(*df.columns)


def canonical_max_score(scores: DataFrame, mapping: DataFrame) -> DataFrame:
    """Best score per user and canonical id, with the latest time it was reached."""
    best = F.max(F.struct("score", "ts")).alias("_best")
    return (
        with_canonical(scores, mapping)
        .groupBy("user_id", "canonical_id")
        .agg(best)
        .select("user_id", F.col("canonical_id").alias("item_id"), "_best.score", "_best.ts")
    )
