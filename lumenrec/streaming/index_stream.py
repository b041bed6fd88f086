"""Keeping the search index current.

A streaming query turns messages of all kinds into item changes and appends them to a
change log partitioned by day. A merge step, run on its own schedule, replaces the
postings of changed items in the stored index; next to the postings the snapshot keeps
the last change of each item, so late and repeated changes do nothing. After every
trigger only the documents of touched keys go out. Posting lists never enter the state
of a streaming query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lumenrec.operators.postings import PERSON_CATEGORY, POSTING, keyword_words, name_words, recall_words
from lumenrec.operators.reduced import distinct_keys
from lumenrec.operators.words import suffix_words
from lumenrec.session import materialize, new_scratch
from lumenrec.sources.snapshots import dataset_path, delete_path, path_exists, read_newest, read_pointer, write_snapshot

# Window and trigger length, watermark of the aggregation.
WINDOW, TRIGGER, DELAY = "3 minutes", "3 minutes", "10 minutes"
# Dataset of the last change applied to each item.
STATE = "index_items"


def window_changes(changes: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Last change per item, category and tumbling window.

    ``changes`` has ``item_id, category, title, risk, status`` and an instant ``ts``.
    """
    last = F.max(F.struct("ts", "status", "title", "risk")).alias("_last")
    return (
        changes.withWatermark("ts", delay)
        .groupBy(F.window("ts", window), "item_id", "category")
        .agg(last, F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            "item_id", "category", "_last.title", "_last.risk", "_last.status",
            F.col("_last.ts").cast("timestamp_ntz").alias("ts"), "n",
        )
    )


def window_postings(postings: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Per tumbling window, key and category the postings to add and to delete.

    ``postings`` are recalled changes (posting columns, ``status`` and an instant ``ts``);
    of several changes of a posting in a window the last one counts.
    """
    return (
        postings.withWatermark("ts", delay)
        .groupBy(F.window("ts", window), "search_key", "category", "item_id", "highlight")
        .agg(F.max(F.struct("ts", "status", "score", "risk")).alias("_last"), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            "search_key", "category", "item_id", "highlight", "_last.score", "_last.risk",
            F.when(F.col("_last.status") == 1, "add").otherwise("delete").alias("mark"), "n",
        )
    )


def drop_repeats(stream: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Streaming distinct whose state expires with the watermark."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def append_log(
    stream: DataFrame, path: str, checkpoint: str, name: str, trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Append a stream to a parquet log; ``trigger=None`` processes what is there and stops.

    A log of changes (with a time ``ts``) is partitioned by day.
    """
    by_day = "ts" in stream.columns
    if by_day:
        stream = stream.withColumn("day", F.to_date("ts"))
    writer = (
        stream.writeStream.format("parquet").outputMode("append").queryName(name)
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if by_day:
        writer = writer.partitionBy("day")
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def recall_changes(
    changes: DataFrame, readings: DataFrame | None = None, keywords: DataFrame | None = None
) -> DataFrame:
    """Changed items → timed postings with the item's status.

    People are found by their whole name, items listed in ``keywords (item_id, word)``
    by these words, all others by the suffixes of their title.
    """
    carried = ["status", "ts"]
    ids = ["item_id", "category", "risk", *carried]
    person = F.col("category") == PERSON_CATEGORY
    titled = changes.where(~person)
    words = name_words(changes.where(person), ids, "title")
    if keywords is not None:
        words = words.unionByName(keyword_words(titled.join(keywords, "item_id").select(*ids, "word")))
        titled = titled.join(distinct_keys(keywords, "item_id"), "item_id", "left_anti")
    words = words.unionByName(suffix_words(titled, ids, "title").drop("offset"))
    return recall_words(words, readings, carried)


ITEM = ["item_id", "category"]
CHANGE = ["ts", "status", "title", "risk"]
LOG_SCHEMA = "item_id string, category string, title string, risk bigint, status bigint, ts timestamp, day date"
STATE_SCHEMA = "item_id string, category string, title string, risk bigint, status bigint, ts timestamp"


def effective_changes(state: DataFrame, log: DataFrame) -> DataFrame:
    """The last change of each item in the log, where it is later than what ``state`` knows.

    ``state`` holds the last change applied to each item ever changed, one row per item,
    offline ones included; so a late change, or one that was applied before, is none.
    """
    last = log.groupBy(*ITEM).agg(F.max(F.struct(*CHANGE)).alias("_last"))
    known = state.select(*ITEM, F.struct(*CHANGE).alias("_known"))
    newer = F.col("_known").isNull() | (F.col("_last") > F.col("_known"))
    return last.join(known, ITEM, "left").where(newer).select(*ITEM, *[f"_last.{c}" for c in CHANGE])


def apply_log(
    stored: DataFrame, state: DataFrame, log: DataFrame, readings: DataFrame | None = None, keywords: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(postings, state)`` after all changes of the log.

    A changed item's stored postings are all replaced, under whatever title they were
    made: an online item gets the postings of its new title, an offline one none. The
    result depends on the changes only, not on the batches they came in.
    """
    changed = effective_changes(state, log)
    touched = distinct_keys(changed, *ITEM)
    kept = stored.join(touched, ITEM, "left_anti").select(*POSTING)
    found = recall_changes(changed.where("status = 1"), readings, keywords).select(*POSTING).distinct()
    columns = [*ITEM, *CHANGE]
    after = state.join(touched, ITEM, "left_anti").select(*columns).unionByName(changed.select(*columns))
    return kept.unionByName(found), after


def touched_keys(
    stored: DataFrame, changed: DataFrame, readings: DataFrame | None = None, keywords: DataFrame | None = None
) -> DataFrame:
    """The search keys whose documents a batch of changes alters."""
    before = stored.join(distinct_keys(changed, *ITEM), ITEM, "left_semi").select("search_key")
    after = recall_changes(changed, readings, keywords).select("search_key")
    return distinct_keys(before.unionByName(after), "search_key")


def read_log(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The change log from the day ``since`` on; an empty frame when nothing was logged yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return log if since is None else log.where(F.col("day") >= F.lit(since).cast("date"))


def read_state(spark: SparkSession, base: str, env: str, product: str) -> DataFrame:
    """The ``index_items`` snapshot; empty before the first refresh."""
    root = dataset_path(base, env, product, STATE)
    if read_pointer(spark, root)["latest"] is None:
        return spark.createDataFrame([], STATE_SCHEMA)
    return read_newest(spark, base, env, product, STATE)


def refresh_index(
    spark: SparkSession,
    log_path: str,
    base: str,
    env: str,
    product: str,
    since: str | None = None,
    readings: DataFrame | None = None,
    keywords: DataFrame | None = None,
) -> DataFrame:
    """Merge the change log into the ``postings`` snapshot and publish a new version.

    This rewrites the snapshot, so it runs now and then; what has to go out after every
    trigger is the touched keys only (``send_documents``). ``since`` leaves out days that
    were merged before; merging them again is harmless. Postings are published before the
    items' state, so after a failure in between the same changes are applied once more.
    """
    stored = read_newest(spark, base, env, product, "postings")
    state = read_state(spark, base, env, product)
    postings, after = apply_log(stored, state, read_log(spark, log_path, since), readings, keywords)
    after = materialize(after, "index-items")
    write_snapshot(postings, base, env, product, "postings")
    write_snapshot(after, base, env, product, STATE)
    return read_newest(spark, base, env, product, "postings")


def send_documents(
    stream: DataFrame,
    log_path: str,
    base: str,
    env: str,
    product: str,
    documents: Callable[[DataFrame, DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    readings: DataFrame | None = None,
    keywords: DataFrame | None = None,
) -> StreamingQuery:
    """After every trigger log the changes and write the documents of the keys they touch.

    ``documents(keys, postings)`` makes documents; each batch's go to ``out/batch=<id>``. The
    log part of a batch is overwritten when the batch is repeated, so a restart neither loses
    nor doubles a change. Postings of other keys are dropped before anything is merged. Every trigger reads the
    whole log; ``keyed_index.keep_index`` keeps the keys of every item as state instead.
    """

    def send(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = f"{log_path}/batch={number}"
        batch.select(*ITEM, *CHANGE).withColumn("day", F.to_date("ts")).write.mode("overwrite").parquet(part)
        logged = spark.read.schema(LOG_SCHEMA).parquet(part)
        stored = read_newest(spark, base, env, product, "postings")
        state = read_state(spark, base, env, product)
        log = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(log_path)
        # Also the keys of earlier changes that no refresh has merged: their documents may name the item.
        earlier = log.join(distinct_keys(logged, *ITEM), ITEM, "left_semi")
        path = new_scratch(spark, "touched-keys")
        touched_keys(stored, earlier, readings, keywords).write.parquet(path)
        keys = spark.read.parquet(path)
        merged, _ = apply_log(stored.join(keys, "search_key", "left_semi"), state, log, readings, keywords)
        documents(keys, merged.join(keys, "search_key", "left_semi")).write.mode("overwrite").parquet(f"{out}/batch={number}")
        delete_path(spark, path)

    writer = stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
