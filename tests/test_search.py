from __future__ import annotations

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from lumenrec.functions import text
from lumenrec.operators import postings as post
from lumenrec.operators import words

POSTING = "search_key string, category string, item_id string, highlight string, score double, risk bigint"


def test_cleaning_and_tokens(frame):
    df = frame("t string", ("《Ab-12》 中文c!",), ("!!",), (None,))
    got = df.select(
        text.clean_title(F.col("t")).alias("clean"), text.title_tokens(F.col("t")).alias("tokens"),
        text.has_cjk(F.col("t")).alias("cjk"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Ab12中文c", ["Ab", "12", "中", "文", "c"], True), ("", [], False), (None, None, False),
    ]


def test_base64_has_no_line_breaks_and_no_empty_codes(frame):
    long = "é" * 200
    df = frame("t string", (long,), ("",), (None,))
    encoded = df.select(text.base64_text(F.col("t")).alias("c"))
    got = encoded.select("c", text.unbase64_text(F.col("c")).alias("t")).collect()
    assert got[0].t == long and "\n" not in got[0].c and "\r" not in got[0].c
    assert got[1].c is None and got[2].c is None


def test_suffix_words_reach_the_end_of_the_title(frame, rows):
    df = frame("id int, t string", (1, "abc 12 " + "x" * 15 + " tail"), (2, "--"))
    first = [("12" + "x" * 15 + "tail", 3), ("abc12" + "x" * 15 + "tail", 0)]
    assert rows(words.suffix_words(df, ["id"], "t"), "word", "offset") == [*first, ("tail", 20), ("x" * 15 + "tail", 5)]
    assert rows(words.suffix_words(df, ["id"], "t", 20), "word", "offset") == [*first, ("x" * 15 + "tail", 5)]


def test_many_readings_are_complete(frame):
    tokens = [f"t{i}" for i in range(16)]
    read = words.token_readings(
        frame("word string, tokens array<string>", ("w", tokens)),
        frame("token string, reading string", *[(t, r + t) for t in tokens for r in "ab"]),
    )
    counts = words.reading_prefixes(read).groupBy("i").agg(F.count_distinct("syllables").alias("n")).collect()
    assert {r.i: r.n for r in counts} == {i: 2**i for i in range(1, 17)}


def test_no_array_is_longer_than_the_width(frame, monkeypatch):
    """With a width of 8 the 27,000 choices take all five steps."""
    monkeypatch.setattr(words, "_WIDTH", 8)
    tokens = ["a", "b", "c"]
    readings = frame("token string, reading string", *[(t, f"{t}{k}") for t in tokens for k in range(30)])
    read = words.token_readings(frame("word string, tokens array<string>", ("abc", tokens)), readings)
    got = words.reading_prefixes(read).where("i = 3").selectExpr("array_join(syllables, ' ') as s")
    assert got.count() == got.distinct().count() == 27_000


def test_all_keywords_are_recalled_by_default(frame):
    none = frame("item_id int, category string, title string, risk bigint")
    short = frame("item_id int, category string, title string, risk bigint", (1, "s", "one two three four five six seven", 0), (2, "s", "x", 0))
    found = post.search_words(none, short, frame("code string, title string"), frame("person_id int, name string"))
    assert {r.word for r in found.where("item_id = '1'").collect()} == set("one two three four five six seven".split())
    best = post.search_words(none, short, frame("code string, title string"), frame("person_id int, name string"), keywords=2)
    assert best.where("item_id = '1'").count() == 2


def test_all_views_in_one_pass(frame, rows):
    df = frame(POSTING, *[("k", "c", f"{r}{i}", "h", i / 100, r) for r in (0, 1, 2) for i in range(20)], ("k", "c", "dead", "", 0.0, 0))
    together = post.risk_views(df)
    for name, level in post.RISK_LEVELS.items():
        one = post.risk_view(df, level)
        assert rows(together.where(F.col("view") == name), "item_id", "pos") == rows(one, "item_id", "pos")


def test_packed_lists_are_read_back(frame, rows):
    df = frame("search_key string, category string, t string", ("k", "c", "a_b_hi_0.5_1|x__0.25_0|broken|y_h_no_1"), ("k", "d", ""))
    assert rows(post.unpack_postings(df, "t")) == [("k", "c", "a_b", "hi", 0.5, 1), ("k", "c", "x", "", 0.25, 0)]


def test_category_named_like_a_head_field(frame):
    doc = post.index_documents(frame("search_key string, category string, content string", ("k", "alg", "1")), "i", "z", "y").first()
    assert doc.source == '{"key":"k","alg":"y","biz":"z","_alg":"1"}'


def test_prefix_keys_of_two_tokens(frame, rows):
    df = frame("word string, tokens array<string>", ("Ab中", ["Ab", "中"]), ("", []))
    readings = frame("token string, reading string", ("中", "zhong"), ("中", "chong"))
    got = rows(words.prefix_keys(df, readings), "search_key", "highlight", "i", "n")
    assert got == [
        ("a", "Ab", 1, 2), ("ab", "Ab", 1, 2), ("abc", "Ab中", 2, 2), ("abchong", "Ab中", 2, 2),
        ("abz", "Ab中", 2, 2), ("abzhong", "Ab中", 2, 2), ("ac", "Ab中", 2, 2), ("az", "Ab中", 2, 2),
    ]


def _plain_keys(tokens, readings):
    """Every choice written out."""
    keys = set()
    for i in range(1, len(tokens) + 1):
        for choice in itertools.product(*[readings.get(t, [t]) for t in tokens[:i]]):
            head, last = "".join(choice[:-1]), choice[-1]
            found = {head + last, "".join(c[:1] for c in choice)} | ({head + last[:1]} if len(last) > 1 else set())
            keys |= {(k, "".join(tokens[:i]), i, len(tokens)) for k in found}
    return sorted(keys)


@pytest.mark.parametrize("width", [4096, 3, 1])
def test_keys_of_the_shared_graph_are_those_of_all_choices(frame, rows, monkeypatch, width):
    monkeypatch.setattr(words, "_WIDTH", width)
    known = {"a": ["x", "xy", "yx"], "b": ["y", "yy"], "c": ["cc"], "d": ["x", "", "y"], "e": ["eins", "ein"]}
    table = frame("token string, reading string", *[(t, r) for t, rs in known.items() for r in rs], ("q", None))
    titles = [("abc", ["a", "b", "c"]), ("dab", ["d", "a", "b", "e"]), ("q", ["q"]), ("none", []), ("ebb", ["e", "b", "b"])]
    got = words.prefix_keys(frame("word string, tokens array<string>", *titles, titles[0]), table)
    for word, tokens in titles:
        assert rows(got.where(F.col("word") == word), "search_key", "highlight", "i", "n") == _plain_keys(tokens, known)


def test_a_word_of_sixty_tokens_with_two_readings_finishes(frame):
    """2^60 choices, but only i + 1 texts from i tokens: keys are as many as the distinct texts."""
    tokens = ["t"] * 60
    table = frame("token string, reading string", ("t", "a"), ("t", "aa"))
    got = words.prefix_keys(frame("word string, tokens array<string>", ("w", tokens)), table)
    # i tokens give a^i … a^2i; the begun last syllable and the initials are among them.
    assert {(r.i, r.n) for r in got.groupBy("i").agg(F.count("*").alias("n")).collect()} == {(i, i + 1) for i in range(1, 61)}


def test_all_readings_are_combined(frame, rows):
    tokens = ["a", "b", "c"]
    readings = frame(
        "token string, reading string", *[("a", r) for r in "xy"], *[("b", r) for r in "123"], *[("c", r) for r in "pq"]
    )
    got = rows(words.full_readings(frame("word string, tokens array<string>", ("abc", tokens)), readings), "reading")
    assert got == sorted((f"{a} {b} {c}",) for a in "xy" for b in "123" for c in "pq")


def test_tiers_keep_25_of_each_level_and_all_tombstones(frame):
    rows = [("k", "c", f"{risk}-{i:02d}", "h", i / 100, risk) for risk in (0, 1, 2) for i in range(30)]
    dead = [("k", "c", f"dead{i}", "", 0.0, 0) for i in range(40)]
    got = post.tiered_top(frame(POSTING, *rows, *rows, *dead)).collect()
    kept = {r.item_id for r in got}
    assert len(got) == len(kept)
    assert {f"dead{i}" for i in range(40)} <= kept
    for level in (0, 1, 2):
        ranked = sorted((r for r in rows if r[5] <= level), key=lambda r: (-r[4], r[2]))[:25]
        assert {r[2] for r in ranked} <= kept
    by_rule = set()
    for level in (0, 1, 2):
        by_rule |= {r[2] for r in sorted((r for r in rows if r[5] <= level), key=lambda r: (-r[4], r[2]))[:25]}
    assert kept - {f"dead{i}" for i in range(40)} == by_rule


def test_risk_views_contain_each_other_before_the_cut(frame):
    df = frame(POSTING, *[("k", "c", f"{r}{i}", "h", 0.5, r) for r in (0, 1, 2) for i in range(5)])
    low, middle, high = ({x.item_id for x in post.risk_view(df, level).collect()} for level in (0, 1, 2))
    assert high < middle < low and len(low) == 15 and len(high) == 5


def test_documents_have_one_field_per_category(frame):
    contents = frame("search_key string, category string, content string", ("k", "b", "2"), ("k", "a", "1"))
    doc = post.index_documents(contents, "idx", "biz", "alg").first()
    assert doc.source == '{"key":"k","alg":"alg","biz":"biz","a":"1","b":"2"}'
    assert doc.action == '{"index":{"_type":"doc","_index":"idx","_id":"k"}}'


def test_merge(frame, rows):
    t = [datetime.datetime(2024, 1, d) for d in (1, 2, 3)]
    stored = frame(POSTING, ("k", "c", "old", "h", 0.5, 0), ("k", "c", "gone", "h", 0.5, 0), ("k", "c", "gone", "g", 0.4, 0))
    adds = frame(
        POSTING + ", ts timestamp_ntz",
        ("k", "c", "old", "h", 0.9, 1, t[1]),       # replaces the stored posting
        ("new", "c", "x", "h", 0.1, 0, t[0]),       # new key
        ("k", "d", "x", "h", 0.1, 0, t[0]),         # new category
        ("k", "c", "back", "h", 0.2, 0, t[2]),      # deleted, then added
        ("k", "c", "off", "h", 0.2, 0, t[0]),       # added, then deleted
        ("k", "c", "same", "h", 0.2, 0, t[0]),      # added and deleted at once: deleted
    )
    deletes = frame(
        "search_key string, category string, item_id string, ts timestamp_ntz",
        ("k", "c", "gone", t[0]), ("k", "c", "back", t[1]), ("k", "c", "off", t[1]), ("k", "c", "same", t[0]),
        ("k", "c", "absent", t[0]), ("nokey", "c", "x", t[0]),
    )
    merged = post.merge_index(stored, adds, deletes)
    want = [
        ("k", "c", "back", "h", 0.2, 0), ("k", "c", "old", "h", 0.9, 1),
        ("k", "d", "x", "h", 0.1, 0), ("new", "c", "x", "h", 0.1, 0),
    ]
    assert rows(merged.drop("ts")) == want
    assert rows(post.merge_index(merged, adds, deletes).drop("ts")) == want  # replay
    # a delete that is older than the stored add comes late and does nothing, in one batch or in two
    late = frame("search_key string, category string, item_id string, ts timestamp_ntz", ("k", "c", "old", t[0]))
    assert rows(post.merge_index(merged, adds.where("false"), late).drop("ts")) == want
    assert rows(post.merge_index(stored, adds, deletes.unionByName(late)).drop("ts")) == want


def test_only_touched_keys_are_sent_and_emptied_keys_too(frame, rows):
    t = datetime.datetime(2024, 1, 1)
    stored = frame(POSTING, ("a", "c", "1", "h", 0.5, 0), ("b", "c", "1", "h", 0.5, 0), ("z", "c", "9", "h", 0.5, 0))
    adds = frame(POSTING + ", ts timestamp_ntz", ("a", "c", "2", "h", 0.9, 0, t))
    deletes = frame("search_key string, category string, item_id string, ts timestamp_ntz", ("b", "c", "1", t))
    keys, merged = post.touched_postings(stored, adds, deletes)
    contents = post.join_view(post.risk_view(merged, 0), F.format_number("score", 1))
    assert rows(post.update_documents(keys, contents, "i", "z", "y"), "doc_id", "source") == [
        ("a", '{"key":"a","alg":"y","biz":"z","c":"2_h_0.9|1_h_0.5"}'), ("b", '{"key":"b","alg":"y","biz":"z"}'),
    ]


def test_short_keys(frame, rows):
    contents = frame("search_key string", ("abc",), ("abcd",), ("中",))
    assert rows(post.short_keys(contents)) == [("abc",), ("中",)]


def test_keywords_prefer_rare_terms(frame, rows):
    docs = frame("id int, t string", (1, "the cat the"), (2, "the dog"), (3, "The dog, dog!"), (4, ""))
    got = rows(words.keywords_tfidf(docs, "id", "t", 1), "id", "term", "pos")
    assert got == [(1, "cat", 1), (2, "dog", 1), (3, "dog", 1)]


def test_terms_are_counted_in_their_rows(spark, frame, rows):
    """Documents of several rows, null ids and texts without terms; only the former are added up by a shuffle."""
    docs = frame("id int, kind string, t string", (1, "a", "x y X"), (1, "a", "x z"), (1, "b", "y"), (None, "a", "q q"), (None, "a", "q"), (3, "a", None), (4, "a", " .. "), (5, "a", "x"))
    got = rows(words.term_counts(docs, ["id", "kind"], "t"), "id", "kind", "term", "tf")
    want = [(1, "a", "x", 3), (1, "a", "y", 1), (1, "a", "z", 1), (1, "b", "y", 1), (None, "a", "q", 3), (5, "a", "x", 1)]
    assert sorted(got, key=str) == sorted(want, key=str)
    single = words.row_terms(docs, ["id", "kind"], "t")
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()


def test_keys_of_terms_are_those_of_their_words(frame, rows):
    short = frame("item_id int, category string, title string, risk bigint", (1, "c", "ab1c ab1c 中 x-é", 1), (2, "c", "x ab1c", 0), (None, "c", "é x", 2))
    long_items = frame("item_id int, category string, risk bigint, title string", (9, "l", 0, "big cat"))
    codes, people = frame("code string, title string", ("f", "far east")), frame("person_id int, name string", (7, "ann lee"))
    columns = ("search_key", "category", "item_id", "highlight", "score", "risk")
    for keywords in (None, 2):
        want = post.recall_words(post.search_words(long_items, short, codes, people, keywords))
        got = post.search_recall(long_items, short, codes, people, keywords=keywords)
        assert sorted(rows(got, *columns), key=str) == sorted(rows(want, *columns), key=str)


def test_recall_for_short_lists_keeps_what_they_hold(frame, rows):
    """A term of many items gets its keys for the first ids of each category and risk only; the tiers stay the same."""
    shared = [(i, "cd"[i % 2], "hot ab1c x" if i % 5 else "hot hat", i % 3) for i in range(1, 60)]
    odd = [(None, "c", "hot", 0), (7, "d", "hot x", 1), (8, None, "hot", 0), (9, "c", None, 0), (10, "c", "hut", None), (11, "c", "hat", 5)]
    short = frame("item_id int, category string, title string, risk bigint", *shared, *odd, *shared[:9])
    long_items = frame("item_id int, category string, risk bigint, title string", *[(i, "c", 0, "hot cat") for i in range(9)])
    codes, people = frame("code string, title string", ("f", "far east")), frame("person_id int, name string", (7, "hot lee"))
    whole = post.search_recall(long_items, short, codes, people)
    cut = post.search_recall(long_items, short, codes, people, best=3)
    assert sorted(rows(post.tiered_top(cut, 3)), key=str) == sorted(rows(post.tiered_top(whole, 3)), key=str)
    assert cut.exceptAll(whole).count() == 0
    of_term = cut.where("search_key = 'hot' and highlight = 'hot' and category = 'd'").collect()
    assert sorted((r.risk, r.item_id) for r in of_term) == [
        (risk, i) for risk in (0, 1, 2) for i in sorted({str(i) for i, c, _, r in [*shared, *odd] if (c, r) == ("d", risk)})[:3]
    ]
    # where each item has its own keywords, nothing is cut
    some = post.search_recall(long_items, short, codes, people, keywords=1, best=3)
    assert rows(some.groupBy().count()) == rows(post.search_recall(long_items, short, codes, people, keywords=1).groupBy().count())


@pytest.mark.parametrize("name", ["index_bulk_lines", "search_index_batch", "tiered_top25", "index_documents"])
def test_lists_are_ranked_from_cut_terms(spark, monkeypatch, name):
    """The terms that get keys are at most 25 per term, category and risk, however many texts have the term."""
    from lumenrec.plans import catalogue

    keyed, tfidf = [], post.keywords_tfidf
    monkeypatch.setattr(post, "keywords_tfidf", lambda *args: keyed.append(tfidf(*args)) or keyed[0])
    catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert keyed[0].groupBy("term", "category", "risk").count().agg(F.max("count")).first()[0] == 25
