from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lumenrec.operators import activity, canonical, collections, filters

PAIR = "user_id bigint, item_id bigint"


def test_blacklist_keeps_null_keys_and_ignores_copies(frame, rows):
    base = frame(PAIR, (1, 1), (1, 2), (None, 1), (2, None))
    black = frame(PAIR, (1, 1), (1, 1), (None, 1))
    assert rows(filters.list_filter(base, black, ["user_id", "item_id"], "black")) == [(None, 1), (1, 2), (2, None)]
    assert rows(filters.list_filter(base, black, ["user_id", "item_id"], "white")) == [(1, 1)]
    with pytest.raises(ValueError):
        filters.list_filter(base, black, ["user_id", "item_id"], "grey")


def test_anti_join_is_planned_as_such(frame):
    base, black = frame(PAIR, (1, 1)), frame(PAIR, (1, 1))
    plan = filters.list_filter(base, black, ["user_id", "item_id"], "black")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_risk_filter_sums_both_sides_and_never_multiplies(frame, rows):
    base = frame("user_id bigint, item_id bigint, x string", (1, 1, "a"), (1, 2, "b"), (2, 2, "c"), (3, 9, "d"))
    users = frame("user_id bigint, risk bigint", (1, 1), (1, 2), (2, 0))
    items = frame("item_id bigint, risk bigint", (1, 0), (2, 2), (2, 2))
    assert rows(filters.risk_filter(base, users, items)) == [(1, 1, "a"), (2, 2, "c"), (3, 9, "d")]


def test_conditional_rule_needs_episodes_only_in_its_category(frame, rows):
    items = frame(
        "item_id int, category string, status int, episodes int",
        (1, "PROMO", 1, 0), (2, "PROMO", 1, 3), (3, "SMALL", 1, 0), (4, "SMALL", 0, 5),
    )
    assert rows(filters.valid_items(items)) == [(2,), (3,)]


def test_stale_rows_go_only_in_fast_categories(frame, rows):
    old, new = datetime.datetime(2000, 1, 1), datetime.datetime(2000, 12, 1)
    df = frame("item_id int, category string, ts timestamp_ntz", (1, "hot", old), (2, "hot", new), (3, "mv", old))
    assert rows(filters.drop_stale(df, "ts", ["hot", "sports"], "2000-12-31"), "item_id") == [(2,), (3,)]


def test_regex_codes_are_anchored_at_the_end(frame, rows):
    df = frame("code string", ("hot12",), ("hot12x",), ("xhot1",), ("hot",), ("mv7",))
    assert rows(filters.regex_codes(df, "code", ["hot", "tv"])) == [("hot12",), ("xhot1",)]


def test_canonical_ids(frame, rows):
    relation = frame("item_id int, canonical_id int", (5, 1), (6, 1), (6, 0))
    mapping = canonical.canonical_map(relation)
    assert rows(mapping) == [(5, 1), (6, 0)]
    items = frame("item_id int, title string", (1, "a"), (5, "b"), (6, "c"), (9, "d"))
    assert rows(canonical.to_canonical(items, mapping)) == [(0, "c"), (1, "a"), (9, "d")]
    assert rows(canonical.dedup_by_canonical(items, mapping)) == [(1, "a"), (6, "c"), (9, "d")]


def test_canonical_score_takes_best_then_latest(frame, rows):
    day = [datetime.datetime(2000, 1, d) for d in (1, 2, 3)]
    scores = frame(
        "user_id int, item_id int, score int, ts timestamp_ntz", (1, 5, 7, day[0]), (1, 1, 7, day[1]), (1, 5, 3, day[2])
    )
    mapping = frame("item_id int, canonical_id int", (5, 1))
    assert rows(canonical.canonical_max_score(scores, mapping)) == [(1, 1, 7, day[1])]


def test_collections_keep_page_multiplicity(frame, rows):
    subjects = frame("id int, code string, category string, copyright int", (1, "a", "x", 0), (2, "b", "y", 1))
    pages = frame("subject_id int, mode int", (1, 2), (1, 7), (1, 1), (2, 10))
    assert rows(collections.hot_collections(subjects, pages)) == [("a", 0), ("a", 0)]
    assert rows(collections.available_collections(subjects, pages)) == [("x", "a"), ("y", "b")]


def test_active_users_sum_per_item(frame, rows):
    ts = datetime.datetime(2000, 5, 1)
    scores = frame(
        "user_id int, item_id int, category string, score double, ts timestamp_ntz",
        (1, 1, "a", 0.4, ts), (1, 1, "a", 0.4, ts), (2, 1, "a", 0.4, ts), (2, 2, "a", 0.4, ts),
        (3, 1, "b", 9.0, ts), (4, 1, "a", 9.0, datetime.datetime(1999, 1, 1)),
    )
    assert rows(activity.active_users(scores, "2000-01-01")) == [(1,), (3,)]
    assert rows(activity.active_users(scores, "2000-01-01", category="a")) == [(1,)]


def test_blend_without_quality_is_the_match_part(frame):
    out = activity.blend_score(
        frame("item_id int, match_score double", (1, 1.0), (2, 0.5)), frame("item_id int, quality double", (2, 1.0))
    )
    got = {r.item_id: round(r.score, 9) for r in out.collect()}
    assert got == {1: 0.4, 2: 0.8}


def test_editor_weight(frame, rows):
    out = activity.editor_weight(
        frame("item_id int, score double", (1, 2.0), (2, 2.0)), frame("item_id int", (1,), (1,)), F.lit(1.5)
    )
    assert rows(out, "item_id", "weighted") == [(1, 3.0), (2, 2.0)]
