"""Bucketed storage, manifests of several writers, and the keyed state that takes postings back."""

from __future__ import annotations

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from lumenrec.operators import postings as post
from lumenrec.sources import manifests
from lumenrec.streaming import index_stream, keyed_index

T0 = datetime.datetime(2024, 1, 1)
CHANGE = "item_id string, category string, title string, risk bigint, status bigint, ts timestamp"


def minute(m: float) -> datetime.datetime:
    return T0 + datetime.timedelta(minutes=m)


def files(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


def plain(df):
    return sorted(map(tuple, df.select(*post.POSTING).collect()))


@pytest.fixture
def table(spark, tmp_path):
    return keyed_index.index_table(spark, str(tmp_path / "index"), buckets=8)


def posting(key, item, highlight=None, score=1.0, risk=0, ts=None):
    return (key, "c", item, highlight or key, score, risk, ts)


def change(key, item, mark, m, highlight=None, score=1.0, risk=0):
    return (*posting(key, item, highlight, score, risk, minute(m)), mark)


def test_a_merge_leaves_other_buckets_files(spark, table):
    rows = [posting(f"k{k}", str(i)) for k in range(40) for i in range(3)]
    table.create(spark.createDataFrame(rows, keyed_index.ROWS))
    before = files(table.root)
    changes = spark.createDataFrame([change("k1", "9", "add", 1), change("k2", "0", "delete", 1)], keyed_index.CHANGES)
    assert table.append(changes, 0)
    assert not table.append(changes, 0)  # the same batch again
    touched = table.buckets_of(changes)
    want = plain(table.read())
    assert table.merge_deltas() == touched and 0 < len(touched) < 8
    assert plain(table.read()) == want == sorted(r[:6] for r in [*rows, posting("k1", "9")] if r[:3] != ("k2", "c", "0"))
    kept = [f for f in before if not any(f"bucket={b}/" in f for b in touched)]
    named = {os.path.join(table.root, p, f"bucket={b}") for b, p in table.manifest()["base"].items()}
    assert kept and {os.path.dirname(f) for f in kept} <= named  # same names, still part of the table
    assert table.merge_deltas() == []
    assert table.sweep(lease=3600) == 0 and files(table.root) != kept
    assert table.sweep(lease=0) == len(touched) + 1  # the replaced buckets and the delta
    assert plain(table.read()) == want
    assert table.sweep(lease=0) == 0


def test_reading_keys_opens_their_buckets_only(spark, table):
    table.create(spark.createDataFrame([posting(f"k{k}", "1") for k in range(40)], keyed_index.ROWS))
    table.append(spark.createDataFrame([change("k3", "2", "add", 1)], keyed_index.CHANGES), 0)
    keys = spark.createDataFrame([("k3",), ("none",)], "search_key string")
    got = table.read(keys)
    assert plain(got) == [posting("k3", "1")[:6], posting("k3", "2")[:6]]
    opened = {f.split("bucket=")[1].split("/")[0] for f in got.inputFiles() if "bucket=" in f}
    assert opened <= {str(b) for b in table.buckets_of(keys)}


def test_equal_to_the_merge_of_whole_indexes(spark, table):
    """Random adds and item-wide deletes: the same rows as ``merge_index`` gives."""
    rng = random.Random(5)
    stored = [posting(f"k{rng.randrange(12)}", str(rng.randrange(9))) for _ in range(80)]
    stored = sorted(set(stored))
    frame = spark.createDataFrame(stored, keyed_index.ROWS)
    table.create(frame)
    live, all_adds, all_deletes = {r[:4] for r in stored}, [], []
    for batch in range(4):
        marked = []
        for _ in range(15):
            m = batch * 100 + len(marked)
            key, item = f"k{rng.randrange(12)}", str(rng.randrange(9))
            if rng.random() < 0.5:
                marked.append(change(key, item, "add", m))
                all_adds.append(marked[-1][:7])
                live.add((key, "c", item, key))
            else:  # every highlight of the item under the key
                all_deletes.append((key, "c", item, minute(m)))
                marked += [change(key, item, "delete", m, h[3]) for h in sorted(live) if h[:3] == (key, "c", item)]
        table.append(spark.createDataFrame(marked, keyed_index.CHANGES), batch)
        if batch == 1:
            table.merge_deltas()
    adds = spark.createDataFrame(all_adds, keyed_index.ROWS)
    deletes = spark.createDataFrame(all_deletes, "search_key string, category string, item_id string, ts timestamp")
    assert plain(table.read()) == plain(post.merge_index(frame.drop("ts"), adds, deletes))


def test_two_writers_lose_no_version(spark, tmp_path):
    root = str(tmp_path / "shared")
    number, content = manifests.latest(spark, root)
    assert (number, content) == (0, {})
    assert manifests.create(spark, root, 1, {"names": ["a"]})
    assert not manifests.create(spark, root, 1, {"names": ["b"]})  # the second of two writers
    raced = []

    def edit(now):
        if not raced:  # another writer comes in between reading and creating
            raced.append(manifests.create(spark, root, 2, {"names": [*now["names"], "b"]}))
        return {"names": [*now["names"], "c"]}

    assert manifests.change(spark, root, edit) == (3, {"names": ["a", "b", "c"]})
    assert raced == [True] and manifests.latest(spark, root)[0] == 3


def test_published_versions(spark, frame, tmp_path):
    base = str(tmp_path)
    for k in range(3):
        manifests.publish_version(frame("k int", (k,)), base, "test", "demo", "shared", keep=2)
    assert [manifests.read_version(spark, base, "test", "demo", "shared", b).first().k for b in (0, 1)] == [2, 1]
    with pytest.raises(FileNotFoundError):
        manifests.read_version(spark, base, "test", "demo", "shared", 2)
    root = f"{base}/test/demo/shared"
    assert manifests.sweep(spark, root, lease=3600) == 0
    assert manifests.sweep(spark, root, lease=0) == 1 and len([d for d in os.listdir(root) if d.startswith("v-")]) == 2


def test_two_merges_do_not_overwrite_each_other(spark, table, monkeypatch):
    table.create(spark.createDataFrame([posting("k1", "1")], keyed_index.ROWS))
    table.append(spark.createDataFrame([change("k1", "2", "add", 1)], keyed_index.CHANGES), 0)
    write, inner = type(table)._write, []

    def slow(self, df, kind):
        out = write(self, df, kind)
        if kind == "base" and not inner:
            inner.append(0)
            inner[0] = self.merge_deltas()  # the other one is faster
            self.append(spark.createDataFrame([change("k1", "3", "add", 2)], keyed_index.CHANGES), 1)
        return out

    monkeypatch.setattr(type(table), "_write", slow)
    assert table.merge_deltas() == [] and inner[0]
    assert [r[2] for r in plain(table.read())] == ["1", "2", "3"]


# ---------------------------------------------------------------- keyed state

BATCHES = [
    [("a", "c", "xx", 0, 1, minute(1)), ("b", "c", "xx yy", 1, 1, minute(1)), ("p", "person", "Ann Lee", 0, 1, minute(1))],
    [("a", "c", "yy", 0, 1, minute(2)), ("old", "c", "zz", 0, 1, minute(2))],  # renamed, no merge in between
    [("b", "c", "xx yy", 1, -1, minute(3)), ("a", "c", "xx", 0, 1, minute(0))],  # offline; a late change
    [("a", "c", "yy", 0, 1, minute(2)), ("b", "c", "yy zz", 2, 1, minute(4)), ("b", "c", "ww", 2, 1, minute(5))],  # repeated; back; twice
    [("p", "person", "Ann", 0, 1, minute(6)), ("old", "c", None, 0, 1, minute(7))],
]


def replayed(spark, indexed, batches):
    log = spark.createDataFrame([r for b in batches for r in b], CHANGE)
    log = log.withColumn("title", F.coalesce("title", F.lit("")))
    state = spark.createDataFrame([], index_stream.STATE_SCHEMA)
    return plain(index_stream.apply_log(indexed, state, log)[0])


def documents(keys, postings):
    views = post.risk_views(postings).withColumn("text", F.col("score").cast("string"))
    return post.update_documents(keys, post.join_view(views.where("view = 'high'").drop("view"), F.col("text")), "i", "b", "a")


def start(spark, tmp_path, table, **kw):
    stream = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    return keyed_index.keep_index(
        stream, table, str(tmp_path / "checkpoint"), documents, str(tmp_path / "docs"), trigger=None, **kw
    )


def feed(spark, tmp_path, batches, first=0):
    for i, batch in enumerate(batches, first):
        spark.createDataFrame(batch, CHANGE).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={i}"))


def last_documents(spark, tmp_path):
    out = {}
    folders = sorted((tmp_path / "docs").glob("batch=*"), key=lambda p: int(p.name.split("=")[1]))
    for folder in folders:
        out |= {r.doc_id: r.source for r in spark.read.parquet(str(folder)).collect()}
    return out


def test_renames_are_taken_back(spark, tmp_path, table):
    """Five triggers, two runs of one checkpoint: index and documents are those of a replay of all changes."""
    indexed = spark.createDataFrame([("o", "c", "old", "o", 0.5, 0), ("old", "c", "old", "old", 0.5, 0), ("q", "c", "z", "q", 0.5, 0)],
                                    "search_key string, category string, item_id string, highlight string, score double, risk bigint")
    table.create(indexed.withColumn("ts", F.lit(None).cast("timestamp")))
    feed(spark, tmp_path, BATCHES[:3])
    start(spark, tmp_path, table, merge_every=2, indexed=indexed).awaitTermination()
    assert plain(table.read()) == replayed(spark, indexed, BATCHES[:3])
    feed(spark, tmp_path, BATCHES[3:], 3)
    start(spark, tmp_path, table, merge_every=2, indexed=indexed).awaitTermination()
    want = replayed(spark, indexed, BATCHES)
    assert plain(table.read()) == want
    # what was sent last for every key is the document of the final index; untouched keys were never sent
    keys = spark.createDataFrame([(k,) for k in last_documents(spark, tmp_path)], "search_key string")
    final = spark.createDataFrame(want, "search_key string, category string, item_id string, highlight string, score double, risk bigint")
    expected = {r.doc_id: r.source for r in documents(keys, final.join(keys, "search_key", "left_semi")).collect()}
    sent = last_documents(spark, tmp_path)
    assert sent == expected and "x" in sent and "q" not in sent


def test_a_repeated_batch_changes_nothing(spark, tmp_path, table, monkeypatch):
    """The job dies after the changes were stored and before the documents were written."""
    table.create(spark.createDataFrame([], keyed_index.ROWS))
    feed(spark, tmp_path, BATCHES[:2])
    calls = []

    def dies(keys, postings):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return documents(keys, postings)

    stream = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    query = keyed_index.keep_index(stream, table, str(tmp_path / "checkpoint"), dies, str(tmp_path / "docs"), trigger=None)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    deltas = table.manifest()["deltas"]
    start(spark, tmp_path, table).awaitTermination()
    assert table.manifest()["deltas"] == deltas and len(deltas) == 2
    assert plain(table.read()) == replayed(spark, spark.createDataFrame([], keyed_index.ROWS), BATCHES[:2])
    assert set(last_documents(spark, tmp_path)) >= {"x", "y", "xx"}


def test_offline_items_are_forgotten(spark, tmp_path, table):
    """Once the watermark has passed, an offline item leaves the state; what is older than that is dropped."""
    table.create(spark.createDataFrame([], keyed_index.ROWS))
    feed(spark, tmp_path, [[("a", "c", "xx", 0, 1, minute(1))], [("a", "c", "xx", 0, 0, minute(5))], [("b", "c", "k", 0, 1, minute(60))]])
    query = start(spark, tmp_path, table, forget="10 minutes")
    query.awaitTermination()
    assert {r[2] for r in plain(table.read())} == {"b"}
    feed(spark, tmp_path, [[("a", "c", "late", 0, 1, minute(4))], [("a", "c", "yy", 0, 1, minute(58))]], 3)
    start(spark, tmp_path, table, forget="10 minutes").awaitTermination()
    assert {(r[0], r[2]) for r in plain(table.read())} == {("k", "b"), ("y", "a"), ("yy", "a")}


def test_an_item_costs_one_read_and_one_write_of_the_state():
    """However many changes and postings a batch has for an item, and without a frame for each."""
    from pyspark.sql import Row

    calls, held = [], {}

    class Value:
        def get(self):
            calls.append("get")
            return held.get("item")

        def update(self, value):
            calls.append("update")
            held["item"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            calls.append(f"register {at}")

        def deleteTimer(self, at):
            calls.append(f"delete {at}")

    state = keyed_index.SentPostings()
    state.init(Handle())
    names = ("search_key", "highlight", "score", "risk", "micros", "status", "title")
    row = lambda *values: Row(**dict(zip(names, values)))
    batch = lambda *rows: sorted((r.search_key, r.mark) for r in state.handleInputRows(("i", "c"), iter(rows), None))
    state.handleInitialState(("i", "c"), Row(sent='[["a","a"],["b","b"]]'), None)
    assert calls == ["update"]
    many = [row(k, k, 0.5, 0, 5000, 1, "t") for k in ("b", "c", "c")]
    assert batch(row("z", "z", 0.5, 0, 4000, 1, "old"), row(None, None, None, 0, 5000, 1, "t"), *many) == [("a", "delete"), ("b", "add"), ("c", "add")]
    assert calls == ["update", "get", "update"]
    assert batch(*many) == [] and calls[3:] == ["get"]
    assert batch(row(None, None, None, 0, 9000, 0, "t")) == [("b", "delete"), ("c", "delete")]
    assert calls[4:] == ["get", "update", "register 10"]
    assert batch(row("d", "d", 0.5, 0, 9999, 1, "d")) == [("d", "add")] and calls[7:] == ["get", "delete 10", "update"]
