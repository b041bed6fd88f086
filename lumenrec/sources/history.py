"""Dated layouts: one partition directory per day (and per category)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_by_day(df: DataFrame, ts_col: str, path: str, extra_partitions: Sequence[str] = ()) -> None:
    """Write one ``dt=yyyyMMdd`` directory per day.

    The rebalance hint groups a day's rows into few files and lets AQE split a
    day that is much larger than the others.
    """
    dated = df.withColumn("dt", F.date_format(F.col(ts_col), "yyyyMMdd"))
    keys = ["dt", *extra_partitions]
    dated.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite").partitionBy(*keys).parquet(path)


def read_last_days(
    spark: SparkSession, path: str, last_day: str, days: int, categories: Sequence[str] | None = None
) -> DataFrame:
    """The ``days`` days ending at ``last_day`` (yyyyMMdd, inclusive).

    Both predicates are on partition columns, so other directories are not listed
    into the scan.
    """
    first = F.date_format(F.date_sub(F.to_date(F.lit(last_day), "yyyyMMdd"), days - 1), "yyyyMMdd")
    day: Column = F.col("dt").cast("string")
    out = spark.read.option("basePath", path).parquet(path).where(day.between(first, F.lit(last_day)))
    if categories is not None:
        out = out.where(F.col("category").isin(*categories))
    return out
