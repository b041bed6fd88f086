"""Messages that go out once, however often the job that makes them is repeated.

A batch of messages is written to the outbox with its number and a digest of every message, and counts only when
the manifest names it (the commit marker). A job that runs again with the same number adds nothing. Messages equal
to what their key was last sent are left out. ``deliver`` passes the waiting batches on, one by one; if it dies in
between, a batch may go out twice, with the same number, and the receiver drops the repeats.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenrec.operators.reduced import per_key
from lumenrec.sources import manifests

MESSAGE = ["key", "value", "target", "ttl"]
OUTGOING = "key string, value string, target string, ttl bigint, digest string, batch bigint"
SENT = "key string, target string, digest string, batch bigint"


def with_digest(messages: DataFrame) -> DataFrame:
    """Messages with the digest that tells whether two of a key and target are the same."""
    return messages.select(*MESSAGE, F.sha2(F.to_json(F.struct("value", "ttl")), 256).alias("digest"))


def last_sent(spark: SparkSession, root: str) -> DataFrame:
    """Per key and target the digest of its newest committed message."""
    content = manifests.latest(spark, root)[1]
    paths = [f"{root}/{p}" for p in content.get("sent", [])]
    if not paths:
        return spark.createDataFrame([], "key string, target string, digest string")
    log = spark.read.schema(SENT).parquet(*paths)
    return per_key(log, ["key", "target"], F.max(F.struct("batch", "digest")).alias("_last")).select(
        "key", "target", F.col("_last.digest").alias("digest")
    )


def put(messages: DataFrame, root: str, batch: int, job: str = "job") -> bool:
    """Add a job's batch of messages (``MESSAGE``) to the outbox; False if it was added before.

    Batch numbers of a job rise. Messages that were sent like this before are left out; repeats within the batch
    go out once. Two different messages for one key in a batch are both sent, as the job asked for.
    """
    spark = messages.sparkSession
    if manifests.latest(spark, root)[1].get("jobs", {}).get(job, -1) >= batch:
        return False
    # Dealt once, by key: a key's copies for its targets stay side by side in the shuffle, which packs them together,
    # and the few digests that a key was last sent with meet them there.
    known = last_sent(spark, root).groupBy("key").agg(F.collect_set(F.struct("target", "digest")).alias("_known"))
    same = F.coalesce(F.col("target").isNotNull() & F.array_contains("_known", F.struct("target", "digest")), F.lit(False))
    new = with_digest(messages).repartition("key").distinct().join(known, "key", "left").where(~same).drop("_known")
    name = uuid.uuid4().hex
    path, log = f"messages/{name}", f"sent/{name}"
    new.withColumn("batch", F.lit(batch).cast("bigint")).select(*MESSAGE, "digest", "batch").write.parquet(f"{root}/{path}")
    spark.read.schema(OUTGOING).parquet(f"{root}/{path}").select("key", "target", "digest", "batch").write.parquet(f"{root}/{log}")

    def edit(content: dict) -> dict:
        jobs = content.get("jobs", {})
        if jobs.get(job, -1) >= batch:
            return {**content, "dropped": manifests.dropped(content, [path, log])}
        entry = {"path": path, "job": job, "batch": batch}
        return {
            **content, "jobs": {**jobs, job: batch}, "waiting": [*content.get("waiting", []), entry],
            "sent": [*content.get("sent", []), log],
        }

    _, content = manifests.change(spark, root, edit)
    return log in content.get("sent", [])


def waiting(spark: SparkSession, root: str) -> DataFrame:
    """The committed messages that were not delivered yet."""
    paths = [f"{root}/{e['path']}" for e in manifests.latest(spark, root)[1].get("waiting", [])]
    return spark.read.schema(OUTGOING).parquet(*paths) if paths else spark.createDataFrame([], OUTGOING)


def deliver(spark: SparkSession, root: str, send: Callable[[DataFrame], None]) -> int:
    """Send the waiting batches in order, each marked as delivered before the next; their number."""
    count = 0
    for entry in manifests.latest(spark, root)[1].get("waiting", []):
        send(spark.read.schema(OUTGOING).parquet(f"{root}/{entry['path']}"))

        def edit(content: dict, path: str = entry["path"]) -> dict:
            left = [e for e in content["waiting"] if e["path"] != path]
            return {**content, "waiting": left, "dropped": manifests.dropped(content, [path])}

        manifests.change(spark, root, edit)
        count += 1
    return count


def fold_sent(spark: SparkSession, root: str) -> None:
    """Rewrite the record of sent messages with one row per key and target."""
    content = manifests.latest(spark, root)[1]
    old = content.get("sent", [])
    if len(old) < 2:
        return
    log = spark.read.schema(SENT).parquet(*[f"{root}/{p}" for p in old])
    newest = per_key(log, ["key", "target"], F.max(F.struct("batch", "digest")).alias("_last"))
    path = f"sent/{uuid.uuid4().hex}"
    newest.select("key", "target", "_last.digest", "_last.batch").write.parquet(f"{root}/{path}")

    def edit(now: dict) -> dict:
        if now["sent"][: len(old)] != old:  # someone else has folded them
            return {**now, "dropped": manifests.dropped(now, [path])}
        return {**now, "sent": [path, *now["sent"][len(old) :]], "dropped": manifests.dropped(now, old)}

    manifests.change(spark, root, edit)


def drop_repeats(received: DataFrame) -> DataFrame:
    """What a receiver keeps of messages that may have come twice."""
    return received.repartition("key").dropDuplicates(["key", "target", "batch", "digest"])
