"""Row filters, allow and deny lists, risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumenrec.operators.reduced import distinct_keys, per_key


def conditional_episodes(category: str = "PROMO") -> Column:
    """Every category passes, but the given one needs at least one episode."""
    return (F.col("category") != category) | (F.col("episodes") > 0)


def valid_items(items: DataFrame, conditional_category: str = "PROMO") -> DataFrame:
    return items.where((F.col("status") == 1) & conditional_episodes(conditional_category)).select("item_id")


def vip_items(items: DataFrame, risk: int = -1, conditional_category: str = "PROMO") -> DataFrame:
    """VIP items; a risk above -1 keeps that risk only."""
    kept = items.where(
        (F.col("status") == 1)
        & (F.col("feature_type") == 1)
        & F.col("vip")
        & conditional_episodes(conditional_category)
    )
    if risk > -1:
        kept = kept.where(F.col("risk") == risk)
    return kept.select("item_id")


def hot_items(
    items: DataFrame, risk: int, category: str = "all", categories: Sequence[str] = (), min_rating: int = 40
) -> DataFrame:
    """Well rated items of one risk level."""
    hot = items.where(
        (F.col("rating") >= min_rating) & (F.col("risk") == risk) & (F.col("status") == 1)
    )
    if categories:
        hot = hot.where(F.col("category").isin(*categories))
    if category != "all":
        hot = hot.where(F.col("category") == category)
    return hot.select("item_id", "category", "rating")


def hot_vip_items(items: DataFrame, risk: int, category: str = "all") -> DataFrame:
    """Hot items that are also VIP items of the same risk.

    Both sides come from the one catalogue here, but they are separate tables for a
    user of the library, hence the join.
    """
    vip = items.where(
        F.col("vip") & (F.col("risk") == risk) & (F.col("status") == 1) & (F.col("feature_type") == 1)
    ).select("item_id")
    return hot_items(items, risk, category).join(vip, "item_id")


def regex_codes(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Codes that end in one of the prefixes and a number."""
    return df.where(F.col(column).rlike("(" + "|".join(prefixes) + ")([0-9]+)$"))


def drop_stale(
    df: DataFrame, ts_col: str, categories: Sequence[str], reference: str, days: int = 180
) -> DataFrame:
    """Drop rows of fast-ageing categories last updated before ``reference - days``."""
    cutoff = F.date_sub(F.to_date(F.lit(reference)), days).cast("timestamp_ntz")
    return df.where(~(F.col("category").isin(*categories) & (F.col(ts_col) < cutoff)))


def require_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def list_filter(base: DataFrame, other: DataFrame, on: Sequence[str], mode: str) -> DataFrame:
    """``black`` removes the pairs found in ``other``, ``white`` keeps only those.

    A null key never matches: it survives ``black`` and is dropped by ``white``.
    The list is made distinct first, so copies in it are not shuffled.
    """
    how = {"black": "left_anti", "white": "left_semi"}.get(mode)
    if how is None:
        raise ValueError(f"unknown list mode {mode!r}")
    return base.join(distinct_keys(other, *on), list(on), how)


def valid_only(df: DataFrame, checklist: DataFrame, column: str) -> DataFrame:
    """Keep rows whose user or item is on the checklist."""
    return df.join(distinct_keys(checklist, column), column, "left_semi")


def risk_filter(
    recommend: DataFrame,
    user_risk: DataFrame,
    item_risk: DataFrame,
    limit: int = 2,
    user: str = "user_id",
    item: str = "item_id",
) -> DataFrame:
    """Keep rows where user risk plus item risk is at most ``limit``; unknown risk is 0.

    Each dimension is reduced to one row per key, so the joins never multiply rows.
    Zero risks change nothing and are left out of the join sides.
    """
    users = per_key(user_risk.where("risk > 0"), [user], F.max("risk").alias("_user_risk"))
    things = per_key(item_risk.where("risk > 0"), [item], F.max("risk").alias("_item_risk"))
    total = F.coalesce("_user_risk", F.lit(0)) + F.coalesce("_item_risk", F.lit(0))
    return (
        recommend.join(users, user, "left").join(things, item, "left").where(total <= limit)
        .select(*recommend.columns)
    )


def union_exposures(latest: DataFrame, backup: DataFrame) -> DataFrame:
    """Latest and backup exposures together, copies kept."""
    return latest.unionByName(backup)
