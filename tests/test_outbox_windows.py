"""Messages that go out once, windows in update mode, and profiles from a job's own pass."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lumenrec.operators import activity, outbox
from lumenrec.sources import manifests
from lumenrec.streaming import update_windows

T0 = datetime.datetime(2024, 1, 1)


def messages(frame, *rows):
    return frame("key string, value string, target string, ttl bigint", *rows)


def plain(df):
    return sorted((r.key, r.value, r.target, r.batch) for r in df.collect())


def test_a_repeated_publication_sends_nothing_new(spark, frame, tmp_path):
    root = str(tmp_path / "outbox")
    first = messages(frame, ("a", "1", "x", 10), ("a", "1", "y", 10), ("b", "2", "x", 10), ("b", "2", "x", 10), (None, None, "x", None))
    assert outbox.put(first, root, 0)
    assert not outbox.put(first, root, 0)  # the job ran again
    sent = []
    assert outbox.deliver(spark, root, lambda df: sent.append(plain(df.where("key is not null")))) == 1
    assert sent == [[("a", "1", "x", 0), ("a", "1", "y", 0), ("b", "2", "x", 0)]]
    assert outbox.deliver(spark, root, sent.append) == 0
    # the next day: one value is new, one lifetime is new, one key is new, the rest was sent before
    second = messages(frame, ("a", "1", "x", 10), ("a", "9", "y", 10), ("b", "2", "x", 20), ("c", "3", "x", 10))
    assert outbox.put(second, root, 1)
    assert plain(outbox.waiting(spark, root)) == [("a", "9", "y", 1), ("b", "2", "x", 1), ("c", "3", "x", 1)]
    outbox.fold_sent(spark, root)
    assert len(manifests.latest(spark, root)[1]["sent"]) == 1
    # back to an earlier value: that is news again
    assert outbox.put(messages(frame, ("a", "1", "y", 10), ("c", "3", "x", 10)), root, 2)
    assert [r[:3] for r in plain(outbox.waiting(spark, root)) if r[3] == 2] == [("a", "1", "y")]
    assert outbox.put(second.limit(0), root, 3)


def test_a_delivery_that_dies_is_repeated_with_the_same_numbers(spark, frame, tmp_path):
    root, out = str(tmp_path / "outbox"), str(tmp_path / "out")
    for k in range(2):
        outbox.put(messages(frame, (f"k{k}", "v", "x", 1)), root, k)
    calls = []

    def dies(df):
        df.write.mode("append").parquet(out)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        outbox.deliver(spark, root, dies)
    outbox.deliver(spark, root, lambda df: df.write.mode("append").parquet(out))
    received = spark.read.parquet(out)
    assert received.count() == 3 and plain(outbox.drop_repeats(received)) == [("k0", "v", "x", 0), ("k1", "v", "x", 1)]


def test_two_jobs_share_an_outbox(spark, frame, tmp_path):
    root = str(tmp_path / "outbox")
    assert outbox.put(messages(frame, ("a", "1", "x", 1)), root, 5, "lists")
    assert outbox.put(messages(frame, ("b", "1", "x", 1)), root, 1, "defaults")
    assert not outbox.put(messages(frame, ("c", "1", "x", 1)), root, 4, "lists")
    assert [r[0] for r in plain(outbox.waiting(spark, root))] == ["a", "b"]


POSTING = "search_key string, category string, item_id string, highlight string, score double, risk bigint, status bigint, ts timestamp"


def posting(key, m, status=1, score=0.5):
    return (key, "c", "1", key, score, 0, status, T0 + datetime.timedelta(minutes=m))


def feed(spark, tmp_path, first, batches):
    for i, batch in enumerate(batches, first):
        spark.createDataFrame(batch, POSTING).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={i}"))


def total(table):
    rows = table.read().groupBy("search_key").agg(F.sum("n").alias("n"), F.max_by("mark", "batch").alias("mark")).collect()
    return {r.search_key: (r.n, r.mark) for r in rows}


def stream(spark, tmp_path):
    return spark.readStream.schema(POSTING).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))


def test_update_mode_survives_a_kill(spark, tmp_path, monkeypatch):
    """A window of a day takes all batches; each emits the whole count anew, and a repeated batch does not double it."""
    table = update_windows.window_table(spark, str(tmp_path / "windows"), buckets=4)
    feed(spark, tmp_path, 0, [[posting("a", 1), posting("a", 2), posting("b", 1)], [posting("a", 3, 0)]])
    real, seen = type(table).append, []

    def dies(self, changes, batch, writer="stream"):
        out = real(self, changes, batch, writer)
        seen.append(batch)
        if len(seen) == 2:
            raise RuntimeError("killed after the store, before the checkpoint")
        return out

    monkeypatch.setattr(type(table), "append", dies)
    start = lambda: update_windows.keep_windows(
        stream(spark, tmp_path), table, str(tmp_path / "ck"), trigger=None, merge_every=2, window="1 day", delay="1 day"
    )
    with pytest.raises(Exception, match="killed"):
        start().awaitTermination()
    start().awaitTermination()
    assert total(table) == {"a": (3, "delete"), "b": (1, "add")}
    feed(spark, tmp_path, 2, [[posting("a", 4)], [posting("c", 0)]])
    start().awaitTermination()
    # at midnight the count goes on in a second window; the sum does not care
    assert total(table) == {"a": (4, "add"), "b": (1, "add"), "c": (1, "add")}
    assert seen.count(1) == 2


def test_profile_in_the_jobs_own_pass(spark, frame, tmp_path):
    schema = "user_id bigint, item_id bigint, ts timestamp"
    df = frame(schema, (1, 1, T0), (1, 2, T0), (None, 3, None), (2, None, T0))
    watched, profile = activity.observed_profile(df)
    watched.write.parquet(str(tmp_path / "out"))
    got = profile.get
    assert got["n_rows"] == 4 and got["null_user_id"] == 1 and got["null_item_id"] == 1 and got["null_ts"] == 1
    assert got["about_users"] == 2 and got["n_rows"] == activity.dataset_profile(df).first().n_rows
    empty, profile = activity.observed_profile(frame(schema))
    empty.write.parquet(str(tmp_path / "none"))
    assert profile.get["n_rows"] == 0 and profile.get["null_ts"] == 0
