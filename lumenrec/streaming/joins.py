"""Programs and their linked contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def interval_left_join(left: DataFrame, right: DataFrame, interval: str, delay: str) -> DataFrame:
    """Stream-stream left join on ``key`` with ``left.ts <= right.ts <= left.ts + interval``.

    Both sides carry ``(key, ts timestamp, …)`` with otherwise distinct column names.
    The time bounds let Spark drop old state on both sides.
    """
    a = left.withWatermark("ts", delay).alias("a")
    b = right.withWatermark("ts", delay).alias("b")
    near = F.expr(f"a.key = b.key AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL {interval}")
    kept = [F.col(f"b.{c}") for c in right.columns if c not in ("key", "ts")]
    return a.join(b, near, "leftOuter").select("a.*", *kept)


def interval_left_join_batch(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, hours: int
) -> DataFrame:
    """Batch twin for ``(key, ts, id)`` tables → ``(left_id, right_id)``.

    Rows meet on (key, time bucket); a left row looks into its own and the next
    bucket, so a key with very many rows is spread over time instead of being paired
    with all of itself.
    """
    width = hours * 3600

    def second(column: str):
        return F.unix_timestamp(F.col(column).cast("timestamp"))

    bucket = F.floor(second("ts") / width)
    a = left.select("key", F.col("ts").alias("a_ts"), left_id, F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    b = right.select("key", F.col("ts").alias("b_ts"), right_id, bucket.alias("bucket"))
    near = F.col("b_ts").between(F.col("a_ts"), F.col("a_ts") + F.expr(f"INTERVAL {hours} HOURS"))
    met = a.join(b, ["key", "bucket"]).where(near).select(left_id, right_id)
    alone = left.select(left_id).join(met.select(left_id).distinct(), left_id, "left_anti")
    return met.unionByName(alone.withColumn(right_id, F.lit(None).cast(right.schema[right_id].dataType)))


def prefer_source(joined: DataFrame, provider: str) -> DataFrame:
    """Programs with a ``contents`` array (or null) → one row per item with status 1 or -1.

    If a linked item of the preferred provider is online, that provider's items go
    online and the others offline; else all follow the program's own status. Without
    contents, or with an empty list, the program stands for itself. The program's risk is kept.
    """
    own = F.array(
        F.struct(
            "item_id", "category", "title", F.col("status").cast("string").alias("status"),
            F.lit(None).cast("string").alias("provider"),
        )
    )
    contents = F.when(F.size("contents") > 0, F.col("contents")).otherwise(own)
    preferred = F.exists(
        contents, lambda c: (c["provider"] == provider) & (c["status"].cast("bigint") == 1)
    )
    flat = joined.select(
        F.col("item_id").alias("program_id"), F.col("status").alias("_own"), "risk", "ts",
        F.coalesce(preferred, F.lit(False)).alias("_preferred"), F.explode(contents).alias("c"),
    )
    online = F.when(F.col("_preferred"), F.coalesce(F.col("c.provider") == provider, F.lit(False))).otherwise(
        F.col("_own") == 1
    )
    return flat.select(
        "program_id", "c.item_id", "c.category", "c.title", "risk",
        F.when(online, 1).otherwise(-1).cast("bigint").alias("status"), "ts",
    )


def prefer_source_batch(programs: DataFrame, contents: DataFrame, provider: str) -> DataFrame:
    """Same rule for tables: ``contents`` has one row ``(canonical_id, item_id, …)`` per linked item.

    A group's preferred flag is one partial aggregate, so a large group of linked
    items is never held as an array.
    """
    flag = contents.groupBy("canonical_id").agg(
        F.max(F.coalesce((F.col("provider") == provider) & (F.col("status") == 1), F.lit(False))).alias("_preferred")
    )
    heads = programs.join(
        flag.withColumnRenamed("canonical_id", "item_id"), "item_id", "left"
    ).select(F.col("item_id").alias("program_id"), F.col("status").alias("_own"), "risk", "category", "title", "_preferred")
    members = contents.select(
        F.col("canonical_id").alias("program_id"), "item_id", F.col("category").alias("c"),
        F.col("title").alias("t"), "provider",
    )
    linked = heads.where("_preferred is not null").drop("category", "title").join(members, "program_id")
    online = F.when(F.col("_preferred"), F.coalesce(F.col("provider") == provider, F.lit(False))).otherwise(F.col("_own") == 1)
    status = F.when(online, 1).otherwise(-1).cast("bigint").alias("status")
    alone = heads.where("_preferred is null").select(
        "program_id", F.col("program_id").alias("item_id"), "category", "title", "risk",
        F.when(F.col("_own") == 1, 1).otherwise(-1).cast("bigint").alias("status"),
    )
    return linked.select(
        "program_id", "item_id", F.col("c").alias("category"), F.col("t").alias("title"), "risk", status
    ).unionByName(alone)
