from __future__ import annotations

import datetime
import json

from pyspark.sql import functions as F

from lumenrec.streaming import index_stream, joins, messages

T0 = datetime.datetime(2024, 1, 1)


def minute(m: float) -> datetime.datetime:
    return T0 + datetime.timedelta(minutes=m)


def replay(spark, tmp_path, schema, batches):
    """A file stream that delivers one batch per trigger."""
    folder = tmp_path / "in"
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(folder / f"b={i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "*"))


def drain(spark, stream, tmp_path, name):
    out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
    index_stream.append_log(stream, out, checkpoint, name, trigger=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def test_incomplete_and_foreign_messages_are_dropped(frame):
    good = {"item_id": "1", "category": "c", "title": "t", "risk": 0, "status": 1, "update_ts": "2024-01-01 00:00:00"}
    bad = {k: v for k, v in good.items() if k != "risk"}
    df = frame(
        "key string, value string, topic string",
        ("a", json.dumps(good), "p"), ("b", json.dumps(bad), "p"), ("c", json.dumps(good), "other"), ("d", "not json", "p"),
    )
    assert [r.item_id for r in messages.route(df, "p", messages.PROGRAM).collect()] == ["1"]


def test_messages_are_read_from_files(spark, frame, tmp_path):
    frame("key string, value string, topic string, extra int", ("k", "v", "t", 1)).write.parquet(str(tmp_path / "in"))
    stream = messages.read_messages(
        spark, "parquet", schema="key string, value string, topic string", path=str(tmp_path / "in")
    )
    assert [tuple(r) for r in drain(spark, stream, tmp_path, "out").collect()] == [("k", "v", "t")]


CHANGE = "item_id string, category string, title string, risk bigint, status bigint, ts timestamp"


def test_windows_close_behind_the_watermark(spark, rows, tmp_path):
    def change(item, status, m):
        return (item, "c", f"title {item}", 0, status, minute(m))

    batches = [
        [change("a", 1, 0), change("a", 0, 1)],
        [change("b", 1, 20)],
        [change("b", 1, 19)],  # a row counts as late one trigger after the watermark moved
        [change("a", 1, 2), change("a", 1, 12)],  # minute 2 is late by now, minute 12 is not
        [change("z", 1, 60)],
    ]
    stream = replay(spark, tmp_path, CHANGE, batches)
    log = drain(spark, index_stream.window_changes(stream), tmp_path, "log")
    got = rows(log, "window_start", "item_id", "status", "n")
    assert got == [(minute(0), "a", 0, 2), (minute(12), "a", 1, 1), (minute(18), "b", 1, 2)]


POSTING = "search_key string, category string, item_id string, highlight string, score double, risk bigint"
LOG = "item_id string, category string, title string, risk bigint, status bigint, ts timestamp"


def merged(frame, stored, *batches):
    """The postings after the batches, one after the other."""
    state = frame(LOG)
    for batch in batches:
        stored, state = index_stream.apply_log(stored, state, frame(LOG, *batch))
        stored, state = stored.persist(), state.persist()
    return stored


def test_log_merge_is_the_same_for_any_batching(frame, rows):
    stored = frame(POSTING, ("t", "c", "a", "title", 0.5, 0), ("title", "c", "a", "title", 0.9, 0), ("old", "c", "r", "old", 0.9, 0))
    off, on = ("a", "c", "title a", 0, 0, minute(1)), ("b", "c", "title b", 1, 1, minute(2))
    renamed, gone = ("r", "c", "new", 0, 1, minute(3)), ("r", "c", "new", 0, 0, minute(4))
    late = ("b", "c", "title b", 1, 0, minute(0))  # older than the add: comes late, does nothing
    log = [off, on, renamed, gone, late]
    want = rows(merged(frame, stored, log))
    assert {r[2] for r in want} == {"b"}
    for batches in ([[x] for x in log], [log[::-1]], [[x] for x in log[::-1]], [log[:2], log[2:]], [log, log], [[renamed], [gone], [off, on], [late]]):
        assert rows(merged(frame, stored, *batches)) == want
    assert {r[0] for r in rows(merged(frame, stored, [renamed]))} >= {"new", "n"} and "old" not in {r[0] for r in rows(merged(frame, stored, [renamed]))}


def test_refresh_without_and_with_changes(spark, frame, rows, tmp_path):
    from lumenrec.sources import snapshots

    base, log = str(tmp_path / "index"), str(tmp_path / "log")
    snapshots.write_snapshot(frame(POSTING, ("x", "c", "1", "x", 0.5, 0)), base, "test", "demo", "postings")
    assert rows(index_stream.refresh_index(spark, log, base, "test", "demo")) == [("x", "c", "1", "x", 0.5, 0)]
    stream = replay(spark, tmp_path, LOG, [[("1", "c", "y", 0, 1, minute(1))], [("2", "c", "z", 0, 1, minute(2000))]])
    index_stream.append_log(stream, log, str(tmp_path / "ck"), "log", trigger=None).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "log").glob("day=*")) == ["day=2024-01-01", "day=2024-01-02"]
    assert {r.search_key for r in index_stream.refresh_index(spark, log, base, "test", "demo", since="2024-01-02").collect()} == {"x", "z"}
    assert {r.search_key for r in index_stream.refresh_index(spark, log, base, "test", "demo").collect()} == {"y", "z"}


def test_documents_of_touched_keys_after_each_trigger(spark, frame, tmp_path):
    from lumenrec.operators import postings as post
    from lumenrec.sources import snapshots

    base = str(tmp_path / "index")
    snapshots.write_snapshot(
        frame(POSTING, ("x", "c", "1", "x", 0.5, 0), ("x", "c", "9", "x", 0.5, 0), ("q", "c", "9", "q", 0.5, 0)), base, "test", "demo", "postings"
    )

    def documents(keys, found):
        return post.update_documents(keys, post.join_view(post.risk_view(found, 0), F.lit("s")), "i", "z", "y")

    stream = replay(spark, tmp_path, LOG, [[("1", "c", "y", 0, 1, minute(1))], [("1", "c", "y", 0, 0, minute(2))]])
    index_stream.send_documents(
        stream, str(tmp_path / "log"), base, "test", "demo", documents, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=None
    ).awaitTermination()
    sent = [{r.doc_id: json.loads(r.source).get("c") for r in spark.read.parquet(f"{tmp_path}/out/batch={b}").collect()} for b in (0, 1)]
    assert sent == [{"x": "9_x_s", "y": "1_y_s"}, {"x": "9_x_s", "y": None}]


def test_a_message_without_a_time_counts_as_of_now(frame):
    body = json.dumps({"code": "x", "title": "t", "status": 1})
    df = frame("key string, value string, topic string", ("k", body, "s"))
    topics = {messages.PROGRAM: "p", messages.SUBJECT: "s", messages.PERSON: "h"}
    now = messages.changes(df, topics).select(F.abs(F.unix_timestamp("ts") - F.unix_timestamp(F.current_timestamp())).alias("away"))
    assert now.first().away < 60


def test_all_four_kinds_of_messages(frame):
    def message(kind, **body):
        return ("k", json.dumps({"update_ts": "2024-01-01 00:00:00", "status": 1, **body}), kind)

    df = frame(
        "key string, value string, topic string",
        message("p", item_id="1", category="c", title="t", risk=1),
        message("l", canonical_id="1", contents=[
            {"item_id": "1", "category": "c", "title": "t", "status": "1", "provider": "best"},
            {"item_id": "5", "category": "c", "title": "u", "status": "1", "provider": "other"}]),
        message("s", code="x", title="subject"), message("h", person_id="7", name="name"),
    )
    topics = {messages.PROGRAM: "p", messages.LINKED: "l", messages.SUBJECT: "s", messages.PERSON: "h"}
    got = {(r.category, r.title, r.status) for r in messages.changes(df, topics, "best").collect()}
    assert got == {("c", "t", 1), ("c", "u", -1), ("collection", "subject", 1), ("person", "name", 1)}


def test_people_keywords_and_titles_are_recalled_differently(frame):
    log = frame(
        "item_id string, category string, title string, risk bigint, status bigint, ts timestamp_ntz",
        ("p", "person", "Jo Doe", 0, 1, minute(1)), ("s", "short", "long text", 1, 1, minute(1)),
        ("m", "movie", "red hat", 2, 1, minute(1)),
    )
    postings = index_stream.recall_changes(log, keywords=frame("item_id string, word string", ("s", "text")))
    keys = {}
    for r in postings.collect():
        keys.setdefault(r.item_id, set()).add(r.search_key)
    assert keys == {
        "p": {"j", "jo", "jod", "jodoe", "jd"}, "s": {"t", "text"},
        "m": {"r", "red", "redh", "redhat", "rh", "h", "hat"},
    }


def test_interval_join_bounds(spark, rows, tmp_path):
    left = "key string, ts timestamp, left_id bigint"
    right = "key string, ts timestamp, right_id bigint"
    a = replay(spark, tmp_path / "l", left, [[("k", minute(0), 1), ("k", minute(5), 2), ("x", minute(0), 3)], [("k", minute(600), 9)]])
    b = replay(
        spark, tmp_path / "r", right,
        [[("k", minute(60), 10), ("k", minute(66), 11), ("k", minute(-1), 12)], [("q", minute(600), 13)]],
    )
    out = drain(spark, joins.interval_left_join(a, b, "1 HOUR", "1 hour").select("left_id", "right_id"), tmp_path, "joined")
    # Exactly one hour later still matches; row 9 is still open.
    assert rows(out) == [(1, 10), (2, 10), (3, None)]


def test_batch_interval_join_equals_a_plain_join(spark, rows):
    left = spark.range(300).select(
        F.lit("hot").alias("key"), (F.lit(T0).cast("timestamp_ntz") + F.expr("make_interval(0,0,0,0,0,id * 7)")).alias("ts"),
        F.col("id").alias("left_id"),
    )
    right = spark.range(100).select(
        F.lit("hot").alias("key"), (F.lit(T0).cast("timestamp_ntz") + F.expr("make_interval(0,0,0,0,0,id * id)")).alias("ts"),
        F.col("id").alias("right_id"),
    )
    got = joins.interval_left_join_batch(left, right, "left_id", "right_id", 1)
    a, b = left.alias("a"), right.alias("b")
    near = F.expr("a.key = b.key and b.ts between a.ts and a.ts + interval 1 hour")
    assert rows(got) == rows(a.join(b, near, "left").select("left_id", "right_id"))


def test_repeats_are_dropped_across_batches(spark, rows, tmp_path):
    schema = "id bigint, ts timestamp"
    stream = replay(spark, tmp_path, schema, [[(1, minute(0)), (1, minute(0))], [(1, minute(3)), (2, minute(3))]])
    assert rows(drain(spark, index_stream.drop_repeats(stream, ["id"]).select("id"), tmp_path, "once")) == [(1,), (2,)]


CONTENT = "array<struct<item_id: string, category: string, title: string, status: string, provider: string>>"


def test_source_preference(frame, rows):
    schema = f"item_id string, category string, title string, risk bigint, status bigint, ts timestamp, contents {CONTENT}"

    def content(i, status, provider):
        return (i, "c", f"t{i}", str(status), provider)

    df = frame(
        schema,
        ("p1", "c", "t", 2, 0, T0, [content("1", 1, "best"), content("2", 1, "other")]),
        ("p2", "c", "t", 1, 1, T0, [content("3", 0, "best"), content("4", 0, "other")]),
        ("p3", "c", "t", 0, 0, T0, None), ("p4", "c", "t", 0, 1, T0, []),
        ("p5", "c", "t", 0, 1, T0, [("5", "c", "t5", "0", None)]),
    )
    got = rows(joins.prefer_source(df, "best"), "program_id", "item_id", "risk", "status")
    assert got == [("p1", "1", 2, 1), ("p1", "2", 2, -1), ("p2", "3", 1, 1), ("p2", "4", 1, 1), ("p3", "p3", 0, -1), ("p4", "p4", 0, 1), ("p5", "5", 0, 1)]


def test_batch_and_stream_preference_agree(frame, rows):
    """Also for groups without any provider."""
    programs = [("p", "c", "t", 0, 1), ("q", "c", "t", 0, 1), ("n", "c", "t", 0, 0)]
    linked = [("p", "m", "c", "tm", 1, None), ("q", "b", "c", "tb", 1, "best"), ("q", "o", "c", "to", 1, None)]
    batch = joins.prefer_source_batch(
        frame("item_id string, category string, title string, risk bigint, status bigint", *programs),
        frame("canonical_id string, item_id string, category string, title string, status bigint, provider string", *linked), "best",
    )
    stream = frame(
        f"item_id string, category string, title string, risk bigint, status bigint, ts timestamp, contents {CONTENT}",
        *[(*p, T0, [(i, c, t, str(s), v) for k, i, c, t, s, v in linked if k == p[0]] or None) for p in programs],
    )
    columns = ["program_id", "item_id", "status"]
    assert rows(batch, *columns) == rows(joins.prefer_source(stream, "best"), *columns)


def test_a_rename_between_refreshes_is_sent_for_the_old_keys_too(spark, frame, tmp_path):
    from lumenrec.operators import postings as post
    from lumenrec.sources import snapshots

    base = str(tmp_path / "index")
    snapshots.write_snapshot(frame(POSTING, ("q", "c", "9", "q", 0.5, 0)), base, "test", "demo", "postings")

    def documents(keys, found):
        return post.update_documents(keys, post.join_view(post.risk_view(found, 0), F.lit("s")), "i", "z", "y")

    stream = replay(spark, tmp_path, LOG, [[("1", "c", "xx", 0, 1, minute(1))], [("1", "c", "yy", 0, 1, minute(2))]])
    index_stream.send_documents(
        stream, str(tmp_path / "log"), base, "test", "demo", documents, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=None
    ).awaitTermination()
    second = {r.doc_id: "1_" in r.source for r in spark.read.parquet(str(tmp_path / "out" / "batch=1")).collect()}
    assert second == {"x": False, "xx": False, "y": True, "yy": True}
