"""The search index kept current by keyed state and bucketed storage.

A stateful operator remembers for every item the last change and the keys its postings were sent under. A new
change adds the postings of its title and takes back those of the keys that it no longer has, however many changes
lie in between. What comes out are marked postings, a few per changed item; every trigger appends them to the
bucketed index and writes the documents of the keys they touch. Neither the change log nor the whole index is read.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from lumenrec.operators.postings import PERSON_CATEGORY, POSTING, name_words, recall_words
from lumenrec.operators.reduced import distinct_keys
from lumenrec.operators.words import suffix_words
from lumenrec.sources.buckets import BucketTable
from lumenrec.streaming.index_stream import CHANGE, ITEM, TRIGGER

# What tasks run travels with the job; executors need the packages imported above only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

IDENTITY = ["search_key", "category", "item_id", "highlight"]
ROWS = (
    StructType().add("search_key", "string").add("category", "string").add("item_id", "string").add("highlight", "string")
    .add("score", "double").add("risk", "long").add("ts", "timestamp")
)
CHANGES = StructType([*ROWS.fields]).add("mark", "string")
_MARKED = (
    "search_key string, category string, item_id string, highlight string, score double, risk bigint, micros bigint, mark string"
)
_MARK = Row("search_key", "category", "item_id", "highlight", "score", "risk", "micros", "mark")
#: Changes this much older than the newest are dropped; so an offline item can then be forgotten.
FORGET = "7 days"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def apply_marks(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows after marked changes: of each posting the latest row counts, if it is no delete.

    At one instant an add counts more than a delete. Rows without a time are older than any change.
    """
    old = rows.select(*IDENTITY, "score", "risk", "ts", F.lit(True).alias("live"))
    new = changes.select(*IDENTITY, "score", "risk", "ts", (F.col("mark") == "add").alias("live"))
    last = F.max(F.struct("ts", "live", "score", "risk")).alias("last")
    merged = old.unionByName(new).groupBy(*IDENTITY).agg(last).where("last.live")
    return merged.select(*IDENTITY, "last.score", "last.risk", "last.ts")


def index_table(spark: SparkSession, root: str, buckets: int = 64) -> BucketTable:
    """The bucketed index under ``root``."""
    return BucketTable(spark, root, ROWS, CHANGES, apply_marks, buckets=buckets)


def recalled(changes: DataFrame) -> DataFrame:
    """One row per change (``search_key`` null) and one per posting of an online change."""
    carried = ["status", "micros", "title", "ts"]
    rows = changes.select(
        *ITEM, "ts", F.coalesce("title", F.lit("")).alias("title"), F.col("risk").cast("bigint").alias("risk"),
        F.col("status").cast("bigint").alias("status"), F.unix_micros("ts").alias("micros"),
    )
    heads = rows.select(
        F.lit(None).cast("string").alias("search_key"), *ITEM, F.lit(None).cast("string").alias("highlight"),
        F.lit(None).cast("double").alias("score"), "risk", *carried,
    )
    online, person = rows.where("status = 1"), F.col("category") == PERSON_CATEGORY
    ids = [*ITEM, "risk", *carried]
    words = name_words(online.where(person), ids, "title").unionByName(
        suffix_words(online.where(~person), ids, "title").drop("offset")
    )
    return heads.unionByName(recall_words(words, None, carried).select(*heads.columns))


class SentPostings(StatefulProcessor):
    """Per item: its last change, and the keys and highlights that its postings were sent under.

    Both lie in one value, so an item costs one read and one write of the state; rows come and go as they are,
    without a frame an item. An item that has no postings is forgotten when the watermark passes its last change,
    as whatever is older is dropped before it gets here.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # micros is null until the first change; sent is a JSON array of [search_key, highlight]
        self.item = handle.getValueState("item", "micros bigint, status bigint, title string, risk bigint, sent string")

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self.item.update((None, None, None, None, initialState["sent"]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        item, category = key
        newest, mine = None, {}
        for row in rows:
            stamp = (row["micros"], row["status"], row["title"], row["risk"])
            if newest is None or stamp > newest:
                newest, mine = stamp, {}
            if stamp == newest and row["search_key"] is not None:
                mine.setdefault((row["search_key"], row["highlight"]), (row["score"], row["risk"]))
        known = self.item.get()
        last, before = (tuple(known[:4]), {tuple(p) for p in json.loads(known[4])}) if known else ((None,), set())
        if last[0] is not None:
            if newest <= last:
                return
            if not before:
                self.handle.deleteTimer(_forgotten(last[0]))
        self.item.update((*newest, json.dumps(list(mine))))
        if not mine:
            self.handle.registerTimer(_forgotten(newest[0]))
        for (search_key, highlight), (score, risk) in mine.items():
            yield _MARK(search_key, category, item, highlight, score, risk, newest[0], "add")
        for search_key, highlight in sorted(before.difference(mine)):
            yield _MARK(search_key, category, item, highlight, 0.0, 0, newest[0], "delete")

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.item.get()
        if known and not json.loads(known[4]):
            self.item.clear()
        return iter([])

    def close(self) -> None:
        pass


def _forgotten(micros: int) -> int:
    """When (in milliseconds) an item without postings is forgotten, whose last change was at ``micros``."""
    return micros // 1000 + 1


def marked_postings(changes: DataFrame, indexed: DataFrame | None = None, forget: str = FORGET) -> DataFrame:
    """A stream of item changes → the postings to add and to delete (columns of ``CHANGES``).

    ``indexed`` (posting rows) is what the index holds before the stream's first batch. Repeated changes and
    those older than an item's last one give nothing. The session needs the RocksDB state store (``stateful``).
    """
    known = None
    if indexed is not None:
        sent = F.to_json(F.collect_set(F.array("search_key", "highlight")))
        known = indexed.groupBy(*ITEM).agg(sent.alias("sent")).groupBy(*ITEM)
    found = recalled(changes.withWatermark("ts", forget)).groupBy(*ITEM).transformWithState(
        SentPostings(), _MARKED, "Update", "EventTime", known
    )
    return found.select(*IDENTITY, "score", "risk", F.timestamp_micros("micros").alias("ts"), "mark")


def stateful(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query with the state store that list state and timers need; other queries keep theirs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def keep_index(
    changes: DataFrame,
    table: BucketTable,
    checkpoint: str,
    documents: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    out: str | None = None,
    trigger: str | None = TRIGGER,
    merge_every: int = 8,
    indexed: DataFrame | None = None,
    forget: str = FORGET,
) -> StreamingQuery:
    """Keep the bucketed index current and write the documents of touched keys to ``out/batch=<id>``.

    ``documents(keys, postings)`` gets the keys of a batch and all their postings, read from the keys' buckets.
    After ``merge_every`` batches the touched buckets are rewritten. A batch that is repeated after a failure is
    not appended again and gives the same documents. ``indexed`` is only read by the first run of a checkpoint.
    """
    marked = marked_postings(changes, indexed, forget)

    def send(batch: DataFrame, number: int) -> None:
        if len(table.manifest().get("deltas", [])) >= merge_every:
            table.merge_deltas()
        if not table.append(batch, number):
            batch.write.format("noop").mode("overwrite").save()  # the state moves on only when the batch is read
        if documents is not None:
            keys = distinct_keys(table.batch(number), table.key)
            postings = table.read(keys).select(*POSTING)
            documents(keys, postings).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = marked.writeStream.outputMode("update").foreachBatch(send).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return stateful(changes.sparkSession, writer.start)
