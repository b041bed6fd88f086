"""What users were shown, stored so that taking it off a candidate list moves the candidates only.

Exposures are the big side of that anti join and grow every day. They are written once in buckets of (user, item), in
the layout that the join asks for; a later job shuffles its candidates into the same buckets and reads the exposures in
place. The item is part of the bucket, so a user with a large share of all exposures is spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

PAIR = ("user_id", "item_id")


def store(exposures: DataFrame, table: str, path: str, buckets: int = 64, keys: Sequence[str] = PAIR) -> None:
    """Append exposures to the catalog table ``table`` under ``path``, one sorted file per bucket and write.

    Rows with a null key match no candidate and are left out. The number of buckets is the table's for good.
    """
    rows = exposures.select(*keys).where(" and ".join(f"{k} is not null" for k in keys))
    # The shuffle and the buckets use one hash, so a task writes one bucket.
    placed = rows.repartition(buckets, *[F.col(k) for k in keys])
    writer = placed.write.mode("append").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def drop_seen(candidates: DataFrame, table: str, keys: Sequence[str] = PAIR) -> DataFrame:
    """The candidates that are not in the table; candidates with a null key stay."""
    spark: SparkSession = candidates.sparkSession
    return candidates.join(spark.table(table).select(*keys), list(keys), "left_anti")
