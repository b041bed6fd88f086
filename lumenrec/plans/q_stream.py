"""Streaming queries: each runs to the end of the available input and returns its log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumenrec.operators import postings as post
from lumenrec.operators import words
from lumenrec.plans.inputs import Inputs
from lumenrec.plans.q_search import (
    _CLEAN, _ITEM_WORDS, _POSTINGS, _PPM, _TOKENS, _keys_sql, _suffix_sql, score_ppm,
)
from lumenrec.plans.registry import query
from lumenrec.session import new_scratch
from lumenrec.sources import snapshots
from lumenrec.streaming import index_stream, joins, keyed_index, messages, update_windows


def _drain(inp: Inputs, stream: DataFrame, name: str) -> DataFrame:
    """Process what is there, wait for the end, read the log back."""
    path, checkpoint = new_scratch(inp.spark, name), new_scratch(inp.spark, f"{name}-checkpoint")
    index_stream.append_log(stream, path, checkpoint, name, trigger=None).awaitTermination()
    return inp.spark.read.schema(stream.schema).parquet(path)


def _programs(inp: Inputs) -> DataFrame:
    """Parsed program changes with an event-time column."""
    parsed = messages.route(inp.message_stream(), "view", messages.PROGRAM)
    return parsed.withColumn("ts", messages.event_time("update_ts")).drop("update_ts")


@query(
    "stream_route_parse",
    """SELECT 'program' AS kind, CAST(user_id AS VARCHAR) AS id, title, status, ts AS update_ts FROM programs
    UNION ALL SELECT 'linked', CAST(user_id + n AS VARCHAR), item_title, CASE WHEN n = 1 OR k >= 30 THEN 1 ELSE 0 END, ts
      FROM linked, (SELECT unnest([0, 1]) AS n)
    UNION ALL SELECT 'subject', CAST(user_id AS VARCHAR), title, status, ts FROM messages WHERE topic = 'click' AND title IS NOT NULL
    UNION ALL SELECT 'person', CAST(user_id AS VARCHAR), title, status, ts FROM messages WHERE topic = 'signup' AND title IS NOT NULL""",
)
def stream_route_parse(inp: Inputs) -> DataFrame:
    """Four topics are parsed, a fifth is not subscribed."""
    stream = inp.message_stream()
    columns = ["kind", "id", "title", "status", "update_ts"]
    program = messages.route(stream, "view", messages.PROGRAM).withColumnsRenamed({"item_id": "id"})
    linked = messages.explode_contents(messages.route(stream, "purchase", messages.LINKED))
    subject = messages.route(stream, "click", messages.SUBJECT).withColumnsRenamed({"code": "id"})
    person = messages.route(stream, "signup", messages.PERSON).withColumnsRenamed({"person_id": "id", "name": "title"})
    out = None
    for kind, df in {
        "program": program, "linked": linked.withColumnsRenamed({"item_id": "id"}), "subject": subject, "person": person,
    }.items():
        part = df.withColumn("kind", F.lit(kind)).select(*columns)
        out = part if out is None else out.unionByName(part)
    return _drain(inp, out, "route-parse")


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(inp: Inputs) -> DataFrame:
    """Every event arrives twice and is kept once."""
    twice = inp.event_stream().withColumn("ts", messages.event_time("ts")).withColumn(
        "copy", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    once = index_stream.drop_repeats(twice, ["event_id"]).select("event_id", "user_id", "event_type")
    return _drain(inp, once, "dedup")


_CHANGED_TITLES = "CAST(user_id AS VARCHAR) AS item_id, category, risk, status, ts"


@query(
    "stream_tumbling_postings",
    f"""SELECT time_bucket(INTERVAL 3 MINUTE, ts) AS window_start, search_key, category, item_id, highlight,
      max_by({_PPM}, (ts, status, score, risk)) AS score_ppm, max_by(risk, (ts, status, score, risk)) AS risk,
      CASE WHEN max_by(status, (ts, status, score, risk)) = 1 THEN 'add' ELSE 'delete' END AS mark, count(*) AS n FROM (
        SELECT w.ts, k.search_key, w.category, w.item_id, k.highlight, w.status, w.risk,
          0.7 * CAST(w.word_score AS DOUBLE) + 0.3 * (k.i / k.n) AS score
        FROM title_words w JOIN title_keys k ON w.word = k.word AND w.tokens = k.tokens)
    WHERE time_bucket(INTERVAL 3 MINUTE, ts) + INTERVAL 3 MINUTE <= (SELECT max(ts) FROM programs) - INTERVAL 10 MINUTE
    GROUP BY 1, 2, 3, 4, 5""",
    title_words=_suffix_sql("programs", _CHANGED_TITLES, "title"),
    title_keys=_keys_sql("title_words"),
)
def stream_tumbling_postings(inp: Inputs) -> DataFrame:
    """Recalled postings of changed titles, marked to be added or deleted."""
    recalled = index_stream.recall_changes(_programs(inp))
    marked = index_stream.window_postings(recalled)
    return _drain(inp, marked.withColumn("score_ppm", score_ppm()).drop("score"), "tumbling")


_JOINED = """
    SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'view') v
    {how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOUR"""


@query(
    "stream_interval_left_join",
    f"""{_JOINED.format(how="")}
    UNION ALL
    SELECT view_id, NULL FROM ({_JOINED.format(how="LEFT")}) JOIN events ON view_id = event_id
    WHERE purchase_id IS NULL AND ts < (SELECT least(max(ts) FILTER (event_type = 'view'), max(ts) FILTER (event_type = 'purchase')) FROM events)
      - INTERVAL 7 HOUR""",
)
def stream_interval_left_join(inp: Inputs) -> DataFrame:
    """Unmatched views leave once the watermark (1 hour late) has passed their 6 hours."""
    events = inp.event_stream().withColumn("ts", messages.event_time("ts")).withColumnRenamed("user_id", "key")
    views = events.where("event_type = 'view'").select("key", "ts", F.col("event_id").alias("view_id"))
    purchases = events.where("event_type = 'purchase'").select("key", "ts", F.col("event_id").alias("purchase_id"))
    joined = joins.interval_left_join(views, purchases, "6 HOURS", "1 hour")
    return _drain(inp, joined.select("view_id", "purchase_id"), "interval-join")


@query(
    "stream_source_preference",
    """SELECT * FROM (
    WITH met AS (
      SELECT v.*, l.event_id AS linked_id, l.k AS linked_k, l.user_id AS linked_user, l.item_title AS linked_title, l.category AS linked_category
      FROM programs v LEFT JOIN linked l ON v.user_id = l.user_id AND l.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR),
    emitted AS (
      SELECT * FROM met WHERE linked_id IS NOT NULL
        OR ts < (SELECT least((SELECT max(ts) FROM programs), (SELECT max(ts) FROM linked))) - INTERVAL 2 HOUR)
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS item_id, category, title, risk, CAST(CASE WHEN status = 1 THEN 1 ELSE -1 END AS BIGINT) AS status
    FROM emitted WHERE linked_id IS NULL
    UNION
    SELECT CAST(linked_user + n AS VARCHAR), linked_category, linked_title, risk,
      CASE WHEN linked_k >= 60 THEN CASE WHEN n = 0 THEN 1 ELSE -1 END WHEN status = 1 THEN 1 ELSE -1 END
    FROM emitted, (SELECT unnest([0, 1]) AS n) WHERE linked_id IS NOT NULL)""",
)
def stream_source_preference(inp: Inputs) -> DataFrame:
    """Programs joined with linked contents, source preference, repeats dropped."""
    programs = _programs(inp).withColumn("key", F.col("item_id"))
    linked = messages.route(inp.message_stream(), "purchase", messages.LINKED).select(
        F.col("canonical_id").alias("key"), messages.event_time("update_ts").alias("ts"), "contents"
    )
    joined = joins.interval_left_join(programs, linked, "1 HOUR", "1 hour")
    changes = joins.prefer_source(joined, "premium")
    keys = ["item_id", "category", "title", "risk", "status"]
    once = changes.dropDuplicatesWithinWatermark(keys).select(*keys)
    return _drain(inp, once, "source-preference")


TOPICS = {messages.PROGRAM: "view", messages.LINKED: "purchase", messages.SUBJECT: "click", messages.PERSON: "signup"}

_CHANGES = {
    "met": """
      SELECT v.*, l.event_id AS linked_id, l.k AS linked_k, l.user_id AS linked_user, l.item_title AS linked_title, l.category AS linked_category
      FROM programs v LEFT JOIN linked l ON v.user_id = l.user_id AND l.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR""",
    "emitted": """SELECT * FROM met WHERE linked_id IS NOT NULL
      OR ts < (SELECT least((SELECT max(ts) FROM programs), (SELECT max(ts) FROM linked))) - INTERVAL 2 HOUR""",
    "item_changes": """
      SELECT CAST(user_id AS VARCHAR) AS item_id, category, title, risk, CAST(CASE WHEN status = 1 THEN 1 ELSE -1 END AS BIGINT) AS status, ts
      FROM emitted WHERE linked_id IS NULL
      UNION ALL SELECT CAST(linked_user + n AS VARCHAR), linked_category, linked_title, risk,
        CASE WHEN linked_k >= 60 THEN CASE WHEN n = 0 THEN 1 ELSE -1 END WHEN status = 1 THEN 1 ELSE -1 END, ts
      FROM emitted, (SELECT unnest([0, 1]) AS n) WHERE linked_id IS NOT NULL
      UNION ALL SELECT base64(encode(CAST(user_id AS VARCHAR))), 'collection', title, 0, status, ts FROM messages WHERE topic = 'click' AND title IS NOT NULL
      UNION ALL SELECT CAST(user_id AS VARCHAR), 'person', title, 0, status, ts FROM messages WHERE topic = 'signup' AND title IS NOT NULL""",
    "last_change": """SELECT * FROM item_changes
      QUALIFY row_number() OVER (PARTITION BY item_id, category ORDER BY ts DESC, status DESC, title DESC, risk DESC) = 1""",
    "stored_words": _suffix_sql("(SELECT * FROM items WHERE status = 1 AND feature_type = 1)", _ITEM_WORDS, "title"),
    "stored_keys": _keys_sql("stored_words"),
    "stored": _POSTINGS.format(words="stored_words", keys="stored_keys"),
    "new_words": f"""
      SELECT * FROM ({_suffix_sql("(SELECT * FROM last_change WHERE status = 1 AND category <> 'person')", _ITEM_WORDS, "title")})
      UNION ALL SELECT item_id, category, risk, {_CLEAN.format(c="title")} AS word, {_TOKENS.format(c="title")} AS tokens, 0 AS "offset", 1.0 AS word_score
      FROM last_change WHERE status = 1 AND category = 'person'""",
    "new_keys": _keys_sql("new_words"),
    "new_postings": _POSTINGS.format(words="new_words", keys="new_keys"),
}


@query(
    "stream_index_merge",
    f"""SELECT search_key, category, item_id, highlight, {_PPM} AS score_ppm, risk FROM (
      SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM last_change c WHERE c.item_id = s.item_id AND c.category = s.category)
      UNION ALL SELECT DISTINCT * FROM new_postings)""",
    **_CHANGES,
)
def stream_index_merge(inp: Inputs) -> DataFrame:
    """Messages of all four kinds → change log (streaming) → merge into the stored postings."""
    path, checkpoint = new_scratch(inp.spark, "changes"), new_scratch(inp.spark, "changes-checkpoint")
    changes = messages.changes(inp.message_stream(), TOPICS, "premium")
    index_stream.append_log(changes, path, checkpoint, "changes", trigger=None).awaitTermination()

    valid = inp.items.where("status = 1 and feature_type = 1").withColumn("item_id", F.col("item_id").cast("string"))
    found = words.suffix_words(valid, ["item_id", "category", "risk"], "title")
    base = new_scratch(inp.spark, "index")
    snapshots.write_snapshot(post.recall_words(found), base, "test", "demo", "postings")
    merged = index_stream.refresh_index(inp.spark, path, base, "test", "demo")
    return merged.select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


_AFTER_STREAM = f"""SELECT search_key, category, item_id, highlight, {_PPM} AS score_ppm, risk FROM (
      SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM last_change c WHERE c.item_id = s.item_id AND c.category = s.category)
      UNION ALL SELECT DISTINCT * FROM new_postings)"""


def _kept_index(inp: Inputs, documents=None, out: str | None = None):
    """The bucketed index after all messages, item by item through the keyed state."""
    path, checkpoint = new_scratch(inp.spark, "changes"), new_scratch(inp.spark, "changes-checkpoint")
    changes = messages.changes(inp.message_stream(), TOPICS, "premium")
    index_stream.append_log(changes, path, checkpoint, "changes", trigger=None).awaitTermination()

    valid = inp.items.where("status = 1 and feature_type = 1").withColumn("item_id", F.col("item_id").cast("string"))
    indexed = post.recall_words(words.suffix_words(valid, ["item_id", "category", "risk"], "title"))
    table = keyed_index.index_table(inp.spark, new_scratch(inp.spark, "bucketed"), buckets=16)
    table.create(indexed.withColumn("ts", F.lit(None).cast("timestamp")))
    log = inp.spark.readStream.schema(index_stream.LOG_SCHEMA).parquet(path)
    # the log's days come in any order, so the watermark waits for all of them
    keyed_index.keep_index(
        log, table, new_scratch(inp.spark, "state"), documents, out, trigger=None, indexed=indexed, forget="3650 days"
    ).awaitTermination()
    return table


@query("stream_index_state", _AFTER_STREAM, **_CHANGES)
def stream_index_state(inp: Inputs) -> DataFrame:
    """Messages → keyed state → marked postings → deltas of the bucketed index, read with waiting changes."""
    merged = _kept_index(inp).read()
    return merged.select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


@query("index_bucket_merge", _AFTER_STREAM, **_CHANGES)
def index_bucket_merge(inp: Inputs) -> DataFrame:
    """The same after the touched buckets were rewritten."""
    table = _kept_index(inp)
    table.merge_deltas()
    return table.read().select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


_TOUCHED = """SELECT search_key FROM stored s WHERE EXISTS (SELECT 1 FROM last_change c WHERE c.item_id = s.item_id AND c.category = s.category)
      UNION SELECT search_key FROM new_postings"""


@query(
    "stream_touched_lists",
    f"""SELECT search_key, category, item_id, pos, {_PPM} AS score_ppm FROM (
      SELECT *, row_number() OVER (PARTITION BY search_key, category ORDER BY score DESC, item_id, highlight) AS pos FROM (
        SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM last_change c WHERE c.item_id = s.item_id AND c.category = s.category)
        UNION ALL SELECT DISTINCT * FROM new_postings)
      WHERE risk <= 2 AND search_key IN ({_TOUCHED})) WHERE pos <= 25""",
    **_CHANGES,
)
def stream_touched_lists(inp: Inputs) -> DataFrame:
    """What the stream sends for the keys it touches: their lists, as they are after the last batch."""
    out = new_scratch(inp.spark, "touched-lists")
    _kept_index(inp, lambda keys, postings: post.risk_view(postings, 0), out)
    sent = inp.spark.read.parquet(f"{out}/batch=0")
    return sent.select("search_key", "category", "item_id", "pos", score_ppm())


@query(
    "stream_update_windows",
    f"""SELECT search_key, category, item_id, highlight, max_by({_PPM}, (ts, status, score, risk)) AS score_ppm,
      max_by(risk, (ts, status, score, risk)) AS risk,
      CASE WHEN max_by(status, (ts, status, score, risk)) = 1 THEN 'add' ELSE 'delete' END AS mark, count(*) AS n FROM (
        SELECT w.ts, k.search_key, w.category, w.item_id, k.highlight, w.status, w.risk,
          0.7 * CAST(w.word_score AS DOUBLE) + 0.3 * (k.i / k.n) AS score
        FROM title_words w JOIN title_keys k ON w.word = k.word AND w.tokens = k.tokens)
    GROUP BY 1, 2, 3, 4""",
    title_words=_suffix_sql("programs", _CHANGED_TITLES, "title"),
    title_keys=_keys_sql("title_words"),
)
def stream_update_windows(inp: Inputs) -> DataFrame:
    """Windows of arrival time in update mode; all messages arrive at once, in one window."""
    table = update_windows.window_table(inp.spark, new_scratch(inp.spark, "windows"))
    recalled = index_stream.recall_changes(_programs(inp))
    update_windows.keep_windows(recalled, table, new_scratch(inp.spark, "windows-checkpoint"), trigger=None).awaitTermination()
    return table.read().select("search_key", "category", "item_id", "highlight", score_ppm(), "risk", "mark", "n")
