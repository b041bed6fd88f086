"""Windows of arrival time in update mode.

A window's rows go out as soon as they change, not when the window is over: every trigger emits the windows that it
touched, and these replace what was stored for them. The store takes each batch once, so a query that is killed and
started again from its checkpoint neither loses nor doubles a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lumenrec.sources.buckets import BucketTable
from lumenrec.streaming.index_stream import DELAY, TRIGGER, WINDOW

POSTING_KEY = ["search_key", "category", "item_id", "highlight"]
ROWS = (
    StructType().add("window_start", "timestamp").add("search_key", "string").add("category", "string").add("item_id", "string")
    .add("highlight", "string").add("score", "double").add("risk", "long").add("mark", "string").add("n", "long").add("batch", "long")
)


def arrival_windows(postings: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Per window of arrival time and posting: its last change and how many came in.

    ``postings`` are recalled changes (posting columns, ``status``, ``ts``). The arrival time is that of the
    trigger, which a repeated trigger finds in the checkpoint; a window leaves the state ``delay`` after its end.
    """
    return (
        postings.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", delay)
        .groupBy(F.window("arrived", window), *POSTING_KEY)
        .agg(F.max(F.struct("ts", "status", "score", "risk")).alias("_last"), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").alias("window_start"), *POSTING_KEY, "_last.score", "_last.risk",
            F.when(F.col("_last.status") == 1, "add").otherwise("delete").alias("mark"), "n",
        )
    )


def newest_batch(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Of each window and posting the row of the newest batch."""
    identity = ["window_start", *POSTING_KEY]
    rest = [c for c in ROWS.names if c not in identity]
    last = F.max(F.struct("batch", *[c for c in rest if c != "batch"])).alias("_last")
    return rows.unionByName(changes).groupBy(*identity).agg(last).select(*identity, *[f"_last.{c}" for c in rest])


def window_table(spark: SparkSession, root: str, buckets: int = 16) -> BucketTable:
    """The stored windows under ``root``."""
    return BucketTable(spark, root, ROWS, ROWS, newest_batch, buckets=buckets)


def keep_windows(
    postings: DataFrame, table: BucketTable, checkpoint: str, trigger: str | None = TRIGGER, merge_every: int = 8,
    window: str = WINDOW, delay: str = DELAY,
) -> StreamingQuery:
    """Store the windows that every trigger touches; read them with ``table.read()``."""

    def upsert(batch: DataFrame, number: int) -> None:
        if len(table.manifest().get("deltas", [])) >= merge_every:
            table.merge_deltas()
        if not table.append(batch.withColumn("batch", F.lit(number).cast("bigint")), number):
            batch.write.format("noop").mode("overwrite").save()  # the state moves on only when the batch is read

    writer = arrival_windows(postings, window, delay).writeStream.outputMode("update").foreachBatch(upsert)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
