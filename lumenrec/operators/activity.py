"""User activity, watched sets, day scores and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lumenrec.operators.lists import fold_chunks
from lumenrec.operators.reduced import distinct_keys
from lumenrec.sources.catalog import only_category


def ntz(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def day_range(column: str, day: str) -> Column:
    """Times of one day (``yyyyMMdd``) as a range of the column, which a scan can prune by."""
    start = F.to_date(F.lit(day), "yyyyMMdd")
    return (F.col(column) >= start.cast("timestamp_ntz")) & (F.col(column) < F.date_add(start, 1).cast("timestamp_ntz"))


def active_any_counter(counters: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Users with at least one counter of 1 or more."""
    return counters.where(F.greatest(*columns) >= 1).select("user_id")


def ratings_in_range(scores: DataFrame, start: str, end: str) -> DataFrame:
    """Ratings with ``start <= ts <= end``, named for a recommender."""
    return scores.where(F.col("ts").between(ntz(start), ntz(end))).select(
        F.col("user_id").alias("user"), F.col("item_id").alias("item"), F.col("score").alias("rating")
    )


def active_users(scores: DataFrame, since: str, threshold: float = 0.6, category: str = "all") -> DataFrame:
    """Users with a (user, item) score sum above the threshold since the given time."""
    rows = only_category(scores, category)
    sums = rows.where(F.col("ts") > ntz(since)).groupBy("user_id", "item_id").agg(F.sum("score").alias("_sum"))
    return sums.where(F.col("_sum") > threshold).select("user_id").distinct()


def watched_sets(
    scores: DataFrame, start: str, end: str, category: str = "all", chunk_rows: int = 10000
) -> DataFrame:
    """Distinct items each user watched in the range, folded into sorted chunks."""
    rows = only_category(scores, category)
    pairs = (
        rows.where(F.col("ts").between(ntz(start), ntz(end)))
        .where("user_id is not null and item_id is not null")
        .select("user_id", "item_id")
        .distinct()
    )
    return fold_chunks(pairs, ["user_id"], ["item_id"], F.col("item_id"), chunk_rows)


def daily_scores_valid(daily: DataFrame, valid_items: DataFrame, day: str) -> DataFrame:
    """One day's scores of the items on the valid list."""
    return daily.where(F.col("day") == day).join(distinct_keys(valid_items, "item_id"), "item_id", "left_semi")


def editor_weight(scores: DataFrame, picks: DataFrame, weight: Column) -> DataFrame:
    """Multiply the scores of editor-picked items by the weight, others by 1."""
    tagged = distinct_keys(picks, "item_id").withColumn("_weight", weight)
    return (
        scores.join(tagged, "item_id", "left")
        .withColumn("weighted", F.col("score") * F.coalesce("_weight", F.lit(1)))
        .drop("_weight")
    )


def dataset_profile(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Row and distinct user counts in one pass, and the schema."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(user).alias("n_users"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def observed_profile(df: DataFrame, user: str = "user_id") -> tuple[DataFrame, Observation]:
    """``(the same rows, their profile)``: counted while the job that uses the rows runs, in no pass of its own.

    The profile (``.get``, once a job over the rows has ended) has ``n_rows``, a ``null_<column>`` count for each
    column and ``about_users``, the distinct users within some percent; ``dataset_profile`` counts them exactly.
    """
    seen = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct(user).alias("about_users"), *counts), seen


def dataset_sample(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """``n`` rows to look at, the same on every run: those whose digest is smallest."""
    digest = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns]))
    return df.orderBy(digest, *columns).limit(n)


def blend_score(matches: DataFrame, quality: DataFrame) -> DataFrame:
    """``0.4 * match + 0.6 * quality``; without a quality row only the first part."""
    rated = quality.select("item_id", F.col("quality").alias("_quality"))
    score = F.lit(0.4) * F.col("match_score") + F.coalesce(F.lit(0.6) * F.col("_quality"), F.lit(0.0))
    return matches.join(rated, "item_id", "left").withColumn("score", score).drop("_quality")
