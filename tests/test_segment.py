"""Segmentation of titles against all ways to cut them."""

from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from lumenrec.operators import segment


def all_cuts(text):
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        for rest in all_cuts(text[k:]):
            yield [text[:k], *rest]


def plain(text, counts, longest=segment.LONGEST):
    """The best of all segmentations."""
    counts = {w: n for w, n in counts.items() if 0 < len(w) <= longest}
    total = sum(counts.values())
    unknown = math.floor(math.log(1 / total) * segment.UNKNOWN * segment.SCALE) if total > 1 else -1

    def weight(word):
        found = [math.floor(math.log(counts[word] / total) * segment.SCALE + 0.5)] if word in counts else []
        return max(found + ([unknown] if len(word) == 1 else []), default=None)

    best = None
    for cut in all_cuts(text):
        weights = [weight(w) for w in cut]
        if None not in weights:
            key = (-sum(weights), len(cut), " ".join(cut))
            best = min(best or (key, cut), (key, cut))
    return best[1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab", max_size=8), st.dictionaries(st.text(alphabet="ab", min_size=1, max_size=4), st.integers(1, 9), min_size=1, max_size=6))
def test_best_path_is_the_best_of_all(text, counts):
    total = sum(counts.values())
    unknown = math.floor(math.log(1 / total) * segment.UNKNOWN * segment.SCALE)
    edges = [
        (i, k, math.floor(math.log(counts[text[i : i + k]] / total) * segment.SCALE + 0.5))
        for i in range(len(text)) for k in range(1, len(text) - i + 1) if text[i : i + k] in counts
    ]
    assert segment.best_path(text, edges, unknown) == plain(text, counts)


WORDS = {"北京": 9, "大学": 8, "北京大学": 6, "学生": 7, "大学生": 5, "生活": 6, "活": 1, "电影": 5, "一二三四五六七八九十百千万": 50}


def test_titles_without_blanks(spark, frame):
    titles = ["北京大学生活", "北京大学生", "电影院", "", "北", "北京大学生活", "一二三四五六七八九十百千万", None]
    dictionary = frame("word string, n bigint", *WORDS.items(), ("电影", 3), (None, 5), ("", 5), ("院", 0), ("无", None))
    got = {r.title: r.words for r in segment.segment(frame("title string", *[(t,) for t in titles]), dictionary).collect()}
    counts = {**WORDS, "电影": 8}
    assert got == {t: plain(t, counts) for t in set(titles) - {None} if len(t) < 10} | {titles[6]: list(titles[6])}
    assert got["北京大学生活"] == ["北京大学", "生活"] and got["电影院"] == ["电影", "院"]


def test_suffixes_start_at_words(spark, frame):
    titles = frame("id bigint, title string", (1, "北京大学生活"), (2, "电影"), (3, None), (4, ""))
    words = segment.segment(titles, frame("word string, n bigint", *WORDS.items()))
    got = sorted(tuple(r) for r in segment.word_suffixes(titles, words, ["id"]).collect())
    assert got == [(1, 0, "北京大学生活"), (1, 1, "生活"), (2, 0, "电影")]


def test_an_empty_dictionary(spark, frame):
    got = segment.segment(frame("title string", ("ab",)), frame("word string, n bigint")).collect()
    assert [(r.title, r.words) for r in got] == [("ab", ["a", "b"])]
