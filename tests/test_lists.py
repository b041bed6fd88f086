from __future__ import annotations

import collections
import json
import re

import pytest
from pyspark.sql import functions as F

from lumenrec.operators import lists, publish
from lumenrec.operators.mix import RATIO, STACKING, mix
from lumenrec.plans import jobs

SCORED = "user_id bigint, item_id bigint, score bigint"


def order():
    return [F.col("score").desc(), F.col("item_id")]


def test_top_n_breaks_ties_by_id_and_takes_n_inclusive(frame, rows):
    df = frame(SCORED, (1, 9, 5), (1, 3, 5), (1, 4, 7), (2, 1, 0))
    assert rows(lists.top_n(df, ["user_id"], order(), 2), "user_id", "item_id", "pos") == [(1, 3, 2), (1, 4, 1), (2, 1, 1)]
    assert lists.top_n(df, ["user_id"], order(), 0).count() == 0


def test_top_n_plan_limits_before_the_shuffle(frame):
    df = frame(SCORED, (1, 9, 5))
    plan = lists.top_n(df, ["user_id"], order(), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_take_with_minimum_size(frame, rows):
    df = frame(SCORED, (1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (2, 2, 2))
    got = lists.list_operation(df, "user_id", "item_id", order(), lists.TAKE, 1, min_size=3)
    assert rows(got) == [(1, 3, 1)]
    got = lists.list_operation(df, "user_id", "item_id", order(), lists.TAKE, 3, min_size=2)
    assert rows(got, "user_id").count((2,)) == 2


def test_unknown_operation_is_an_error(frame):
    with pytest.raises(ValueError):
        lists.list_operation(frame(SCORED), "user_id", "item_id", order(), "other")


@pytest.mark.parametrize("digits", [0, 1, 4])
def test_shuffled_positions_do_not_depend_on_slicing(spark, rows, digits):
    """Key 0 holds most rows; sliced ranking equals ranking the whole list at once."""
    df = spark.range(600).select(
        F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 7).alias("user_id"), F.col("id").alias("item_id")
    )
    whole = lists.top_n(df, ["user_id"], [lists.shuffle_digest(7, "user_id", "item_id"), F.col("item_id")], 10**6)
    sliced = lists.shuffled_positions(df, "user_id", "item_id", digits=digits)
    assert rows(sliced, "user_id", "item_id", "pos") == rows(whole, "user_id", "item_id", "pos")


def test_take_then_shuffle_keeps_the_taken_set(frame):
    df = frame(SCORED, *[(1, i, i) for i in range(50)])
    got = lists.list_operation(df, "user_id", "item_id", order(), lists.TAKE_AND_RANDOM, 20).collect()
    assert {r.item_id for r in got} == set(range(30, 50))
    assert sorted(r.pos for r in got) == list(range(1, 21))
    assert [r.item_id for r in sorted(got, key=lambda r: r.pos)] != list(range(49, 29, -1))


def test_stratified_sample_respects_quotas(frame):
    df = frame("category string, item_id bigint", *[("a", i) for i in range(9)], *[("b", i) for i in range(3)], ("c", 1))
    got = collections.Counter(r.category for r in lists.stratified_sample(df, "category", "item_id", {"a": 4, "b": 5}).collect())
    assert got == {"a": 4, "b": 3}


def test_fold_list_keeps_rank_order(frame, rows):
    df = frame("k int, item bigint, pos int", (1, 30, 1), (1, 10, 3), (1, 20, 2), (1, 5, 4))
    assert lists.fold_list(df, "k", "item", "pos", 3).first().id == [30, 20, 10]


def test_whole_lists_are_folded_in_slices(frame, rows):
    df = frame("k int, item bigint, pos int", *[(1, 100 - i, i) for i in range(1, 8)], (2, 5, 1))
    got = rows(lists.fold_list(df, "k", "item", "pos", slice_rows=3), "k", "slice", "id")
    assert got == [(1, 0, [99, 98, 97]), (1, 1, [96, 95, 94]), (1, 2, [93]), (2, 0, [5])]
    whole = lists.fold_matrix(df, "k", "item", "pos").collect()
    assert {r.k: [(x.item, x.score) for x in r["items"]] for r in whole} == {1: [(100 - i, i) for i in range(7, 0, -1)], 2: [(5, 1)]}
    parts = lists.fold_matrix(df, "k", "item", "pos", slice_rows=2).collect()
    assert sorted((x.item, x.score) for r in parts if r.k == 1 for x in r["items"]) == sorted((100 - i, i) for i in range(1, 8))
    assert all([x.score for x in r["items"]] == sorted((x.score for x in r["items"]), reverse=True) for r in parts)


def test_long_lists_get_a_key_per_slice(frame):
    from lumenrec.operators import publish

    df = frame("user_id int, item_id bigint, pos int", *[(1, i, i) for i in range(1, 6)])
    folded = lists.fold_list(df, "user_id", "item_id", "pos", slice_rows=2)
    assert sorted(r.user_id for r in publish.sliced_key(folded, "user_id").collect()) == ["1", "1#1", "1#2"]


@pytest.mark.parametrize("width", [3, 65536])
def test_ordered_positions_equal_one_ranking(spark, rows, width):
    df = spark.range(600).select(
        F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 7).alias("user_id"), F.col("id").alias("item_id"),
        (F.col("id") % 11).alias("total"),
    )
    whole = lists.top_n(df, ["user_id"], [F.col("total").desc(), F.col("item_id")], 10**6)
    got = lists.ordered_positions(df, "user_id", "item_id", "total", width=width)
    assert rows(got) == rows(whole, "user_id", "item_id", "pos")


def test_fold_chunks_splits_a_hot_key_and_loses_nothing(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("item"))
    got = lists.fold_chunks(df, ["k"], ["item"], F.col("item"), 100).collect()
    assert len(got) == 10 and max(r.n for r in got) < 200
    assert sorted(x for r in got for x in r.entries) == list(range(1000))


CANDIDATE = "user_id int, item_id string, rank int"


def test_stacking_fills_from_later_sources_without_repeats(frame):
    a = frame(CANDIDATE, (1, "a", 1), (1, "b", 2))
    b = frame(CANDIDATE, (1, "b", 1), (1, "c", 2), (1, "d", 3), (2, "x", 1))
    got = mix([a, b], "user_id", "item_id", 3, STACKING).collect()
    assert [r.item_id for r in sorted((r for r in got if r.user_id == 1), key=lambda r: r.pos)] == ["a", "b", "c"]
    assert {r.item_id: r.score for r in got if r.user_id == 2} == {"x": 1.0}


def test_ratio_takes_turns_and_skips_exhausted_sources(frame):
    a = frame(CANDIDATE, *[(1, f"a{i}", i) for i in range(1, 8)])
    b = frame(CANDIDATE, (1, "b1", 1), (1, "a2", 2))
    c = frame(CANDIDATE)
    got = mix([a, b, c], "user_id", "item_id", 10, RATIO, [3, 1, 1]).collect()
    assert [r.item_id for r in sorted(got, key=lambda r: r.pos)] == ["a1", "a2", "a3", "b1", "a4", "a5", "a6", "a7"]


def test_mix_rejects_bad_parameters(frame):
    with pytest.raises(ValueError):
        mix([frame(CANDIDATE)], "user_id", "item_id", 3, RATIO)
    with pytest.raises(ValueError):
        mix([frame(CANDIDATE)], "user_id", "item_id", 3, "other")


def test_slot_union_gives_one_row_per_key(frame, rows):
    slots = {
        "a": frame("key string, a string", ("k1", "1")),
        "b": frame("key string, b string", ("k2", "2"), ("k1", "3")),
        "c": frame("key string, c string", ("k2", "4"), ("k3", "5")),
    }
    assert rows(publish.slot_union(slots), "key", "a", "b", "c") == [
        ("k1", "1", "3", None), ("k2", None, "2", "4"), ("k3", None, None, "5"),
    ]


def test_pack_kv_keeps_column_then_extra_order(frame):
    df = frame("uid int, id array<int>", (7, [3, 1]))
    row = publish.pack_kv(df, "uid", "p:", {"date": "d", "alg": "x"}).first()
    assert (row.key, row.value) == ("p:7", '{"id":[3,1],"date":"d","alg":"x"}')


def test_nested_payload_is_an_object(frame):
    df = frame("uid int, id array<int>", (7, [3, 1]))
    nested = publish.pack_kv(publish.pack_slot(df, "uid", "vip", {"alg": "v"}), "key", "p:", {"date": "d"}).first()
    assert nested.value == '{"vip":{"id":[3,1],"alg":"v"},"date":"d"}'


def test_messages_can_be_written_to_files(spark, frame, tmp_path):
    df = frame("key string, value string", ("k", "v"))
    publish.write_messages(df, "parquet", "lists", path=str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("k", "v", "lists")]


def test_random_head_begins_the_shuffled_list(spark):
    df = spark.createDataFrame([(k % 3 if k % 50 else None, k) for k in range(400)], "u int, i int")
    whole = lists.list_operation(df, "u", "i", [F.col("i")], lists.RANDOM).where("pos <= 20").collect()
    head = lists.random_head(df, "u", "i", 20)
    assert sorted((r.u, r.i, r.pos) for r in whole) == sorted((r.u, r.i, r["rank"]) for r in head.collect())
    twice = lists.random_head(df.union(df), "u", "i", 20)
    assert sorted(map(tuple, twice.distinct().collect())) == sorted(map(tuple, head.collect())) and twice.count() == 2 * head.count()
    assert "WindowGroupLimit" in head._jdf.queryExecution().executedPlan().toString()


def test_shared_random_head_equals_the_shuffled_list(spark, monkeypatch):
    """A shelf much longer than the head, a short one, and heads for which the first try finds too few items."""
    shelves = spark.range(3000).selectExpr("if(id < 2990, 'long', 'short') as g", "id as i")
    members = spark.range(60).selectExpr("id as u", "if(id % 5 = 0, 'short', 'long') as g")
    want = sorted(map(tuple, lists.random_head(members.join(shelves, "g"), "u", "i", 20).collect()))
    assert sorted(map(tuple, lists.random_head_shared(members, shelves.union(shelves), "u", "g", "i", 20).collect())) == want
    ranked = []
    whole = lists.random_head
    monkeypatch.setattr(lists, "random_head", lambda df, *a: ranked.append(df.count()) or whole(df, *a))
    lists.random_head_shared(members, shelves, "u", "g", "i", 20).collect()
    assert ranked[0] < 60 * 200  # 48 users times 2,990 items were ranked before

    below = F.lpad  # a limit that leaves next to nothing, so that whole lists are ranked
    monkeypatch.setattr(lists.F, "lpad", lambda c, n, pad: F.lit("00000000") if pad == "0" else below(c, n, pad))
    assert sorted(map(tuple, lists.random_head_shared(members, shelves, "u", "g", "i", 20).collect())) == want


def test_first_items_counts_items_not_rows(frame, rows):
    df = frame("k string, i int, r int", ("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("a", 3, 4), ("a", 2, 5), ("b", 9, 1))
    got = lists.first_items(df, ["k"], "i", [F.col("r")], 2)
    assert rows(got) == [("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("a", 2, 5), ("b", 9, 1)]


def test_allowed_heads_leave_what_the_filters_show(frame, spark):
    from lumenrec.operators import filters
    from lumenrec.plans import jobs

    liked = frame("user_id int, shelf string", *[(u, "s") for u in range(4)])
    shelf = spark.range(60).selectExpr("'s' as shelf", "cast(id as int) as item_id", "cast(id * 7 % 10 as int) as rank")
    users = frame("user_id int, risk int", (0, 0), (1, 1), (2, 2), (2, 1), (3, 3))
    items = spark.range(60).selectExpr("cast(id as int) as item_id", "cast(id % 3 as int) as risk")
    black = frame("user_id int, item_id int", (0, 0), (1, 10), (2, 30))
    kept = lambda df: lists.top_n(filters.risk_filter(
        filters.list_filter(df, black, ["user_id", "item_id"], "black"), users, items), ["user_id"], [F.col("rank"), F.col("item_id")], 5)
    whole = liked.join(shelf, "shelf").select("user_id", "item_id", "rank")
    heads = jobs.allowed_heads(liked, shelf, users, items, 6)
    assert sorted(map(tuple, kept(heads).collect())) == sorted(map(tuple, kept(whole).collect()))
    assert heads.count() == 18


def test_rows_of_few_long_lists_are_shuffled_once(spark, frame):
    """Lists of one chunk need no size from a shuffle; a key without a value is left out."""
    rows = [("long" if k % 2 else f"short{k}", k) for k in range(60)] + [(None, 1)]
    df = lists.fold_chunks(frame("k string, item bigint", *rows), ["k"], ["item"], F.col("item"), 10)
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
    got = df.collect()
    assert sorted(i for r in got for i in r.entries) == list(range(60))
    assert {r.chunk for r in got if r.k != "long"} == {0} and {r.chunk for r in got if r.k == "long"} <= {0, 1, 2}


def _exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"\bExchange hashpartitioning", plan))


def test_short_lists_are_numbered_by_one_shuffle(spark):
    rows = [(u, (7 * i) % 11, i % 3) for u in range(6) for i in range(3 + 4 * u)] + [(None, 1, 1), (2, None, 1), (3, 4, None), (2, 0, 0)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, total bigint")
    one = lists.ordered_positions(df, "user_id", "item_id", "total")
    assert _exchanges(one) == 1
    for bound in (0, 8):  # every list, or some, by slices
        assert sorted(map(str, one.collect())) == sorted(map(str, lists.ordered_positions(df, "user_id", "item_id", "total", list_rows=bound).collect()))


@pytest.mark.parametrize("mode, ratio", [("stacking", None), ("ratio", [2, 1])])
def test_short_lists_are_mixed_by_one_shuffle(spark, mode, ratio):
    schema = "k bigint, i bigint, rank bigint"
    a = spark.createDataFrame([(k, (3 * r + k) % 20, r) for k in range(5) for r in range(1, 15)] + [(None, 1, 1), (1, 5, 9)], schema)
    b = spark.createDataFrame([(k, (5 * r) % 20, r) for k in range(1, 6) for r in range(1, 9)], schema)
    whole, short = (mix([a, b], "k", "i", 12, mode, ratio, short=s) for s in (False, True))
    assert _exchanges(short) == 1 and sorted(map(str, whole.collect())) == sorted(map(str, short.collect()))


def test_shared_shelves_are_not_shuffled_with_their_users(spark):
    """A shelf of several slices, a user without a shelf's list, a user in one slot only."""
    shelved = spark.createDataFrame([("a", i, i + 1) for i in range(5)] + [("b", 9, 1)], "shelf string, item_id bigint, pos bigint")
    folded = lists.fold_list(shelved, "shelf", "item_id", "pos", slice_rows=3)
    members = spark.createDataFrame([(1, "a"), (2, "b"), (3, "none"), (4, "a")], "user_id bigint, shelf string")
    own = spark.createDataFrame([(1, 7, 1), (1, 6, 2), (5, 8, 1), (3, 2, 1)], "user_id bigint, item_id bigint, pos bigint")
    got = jobs.front_union({"portal": (own, "mix"), "vip": ((members, folded), "factors")}, "d")
    portal = {"1": [7, 6], "5": [8], "3": [2]}
    vip = {"1": [0, 1, 2], "1#1": [3, 4], "4": [0, 1, 2], "4#1": [3, 4], "2": [9]}
    slot = lambda ids, alg: None if ids is None else {"id": ids, "alg": alg}
    want = {f"front:{k}": {"portal": slot(portal.get(k), "mix"), "vip": slot(vip.get(k), "factors"), "date": "d"} for k in {*portal, *vip}}
    assert {r.key: json.loads(r.value) for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # The lists come in above the union of the slots.
    assert plan.index("LeftOuter") < plan.index("Union")


def test_pairs_of_members_and_items_are_formed_in_many_tasks(spark, monkeypatch):
    """All members are in one small partition, and nearly all in one group."""
    monkeypatch.setattr(lists, "_SHARE_PAIRS", 10_000)
    monkeypatch.setattr(lists, "_SHARE_ITEMS", 128)
    members = spark.range(0, 401, 1, 1).selectExpr("id as u", "case when id = 400 then 'b' else 'a' end as g")
    items = spark.range(0, 500, 1, 1).selectExpr("'a' as g", "id as i").union(spark.sql("select 'a', null union all select 'b', 3 union all select 'c', 4"))
    sizes = items.groupBy("g").agg(F.count(F.lit(1)).alias("_size"))
    known = members.withColumn("_below", F.lit("g"))
    met = lists._met_in_shares(known, items, sizes, "u", "g", "i")
    assert met.columns == ["u", "g", "_below", "i"]
    assert sorted(map(str, met.collect())) == sorted(map(str, known.join(items, "g").select(*met.columns).collect()))
    sizes = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 400 * 501 + 1 and max(sizes) < 0.5 * sum(sizes)
