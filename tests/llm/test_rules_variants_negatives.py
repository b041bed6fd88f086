"""Hard negatives, learned quality rules and spelling variants against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenrec.llm import negatives, rules, variants

from .conftest import SMALL

MIDDLE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows, is_anchor):
    """All products; ``rows`` are (id, label, vector of whole numbers)."""
    out = []
    for a, la, va in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-int(np.dot(np.array(va, object), np.array(v, object))), i, label) for i, label, v in rows if i != a)
        for s, p, label in [x for x in scored if x[2] == la][:5]:
            fit = [(n, i) for n, i, other in scored if other != la and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(a, p, k, i, -s, -n) for k, (n, i) in enumerate(fit[:3], 1)]
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("group_rows, codes", [(64, 1), (200, 4), (1 << 17, 6)])
def test_negatives_of_the_whole_table(spark, group_rows, codes):
    table = pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()
    rows = [
        (r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], [int(np.floor(256 * float(x))) for x in r["embedding"]])
        for r in table
    ]
    df = negatives.rows_of(spark.createDataFrame([(i, label, [x / 256 for x in v]) for i, label, v in rows], "vec_id bigint, label int, embedding array<double>"))
    got = found(negatives.hard_negatives(df, df.where("vec_id % 50 = 0"), group_rows, codes))
    assert got and got == plain_negatives(rows, lambda i: i % 50 == 0)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(2, 60), st.integers(0, 10_000), st.sampled_from([1, 300, 1 << 20]))
def test_intervals_hold_the_product(dim, n, seed, scale):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-scale, scale + 1, (n, dim)).astype(np.int32)
    vectors[0] = 0
    ids = np.arange(n, dtype=np.int64)
    group = negatives.Group.of(ids, ids * 0, ids * 0, vectors, negatives.rotations(dim, 3))
    q = rng.integers(-scale, scale + 1, dim)
    true = (group.vectors.astype(object) @ q.astype(object)).astype(np.float64)
    at = np.arange(n)
    seen = []

    def keeps(low, high):
        assert (low <= true[at]).all() and (true[at] <= high).all()
        seen.append((high - low).mean())
        return np.ones(len(low), bool)

    group.survivors(negatives.Query.of(q.astype(np.float64), group.turns), at, keeps)
    assert len(seen) == 3
    assert (group.scores(q, at) == true.astype(np.int64)).all()


def test_negatives_edge_cases(spark):
    schema = "vec_id bigint, label int, embedding array<float>, score string, grp int, kind int"
    e = lambda *v: [float(x) for x in v]
    data = [
        (0, 1, e(1, 0)), (1, 1, e(1, 0)), (1, 1, e(1, 0)), (2, 1, e(0.5, 0.5)), (3, 2, e(0.75, 0)), (4, 2, e(0.75, 0)), (5, 2, e(0.9, 0.9)),
        (6, None, e(1, 1)), (7, 2, None), (8, 2, [1.0, None]), (9, 2, e(float("nan"), 0)), (10, 2, e(float("inf"), 0)), (None, 2, e(1, 1)),
        (11, 2, e(0.6)), (12, 2, []), (50, 3, e(0, 0)), (51, 3, e(1, 0)), (100, 4, e(1e30, 0)), (101, 4, e(1, -1)),
    ]
    df = spark.createDataFrame([(*r, "clash", 1, 1) for r in data], schema)
    rows = negatives.rows_of(df)
    assert rows.count() == 13  # repeated rows are still there
    got = found(negatives.hard_negatives(rows, rows.where("vec_id % 50 = 0")))
    limit = negatives.LARGEST
    plain = [
        (0, 1, (256, 0)), (1, 1, (256, 0)), (2, 1, (128, 128)), (3, 2, (192, 0)), (4, 2, (192, 0)), (5, 2, (230, 230)),
        (11, 2, (153, 0)), (12, 2, (0, 0)), (50, 3, (0, 0)), (51, 3, (256, 0)), (100, 4, (limit, 0)), (101, 4, (256, -256)),
    ]
    assert got == plain_negatives(plain, lambda i: i % 50 == 0)
    # equal scores: the smaller id first
    assert [r[3] for r in got if r[:2] == (0, 1)] == [5, 3, 4]
    empty = rows.limit(0)
    assert found(negatives.hard_negatives(empty, empty)) == []
    assert found(negatives.hard_negatives(rows, empty)) == []
    one = rows.where("vec_id = 0")
    assert found(negatives.hard_negatives(one, one)) == []


def test_rows_under_one_id_are_rows_of_their_own(spark):
    df = spark.createDataFrame(
        [(0, 1, [1.0]), (0, 1, [0.5]), (1, 2, [0.4]), (1, 3, [0.45])], "vec_id bigint, label int, embedding array<float>"
    )
    rows = negatives.rows_of(df)
    got = found(negatives.hard_negatives(rows, rows.where("vec_id = 0")))
    # each of the two is the other's positive, with 256 * 128; bands of 50 to 95 percent hold no row for the shorter one
    assert [r[:5] for r in got] == [(0, 0, 1, 1, 32768), (0, 0, 2, 1, 32768)]


# ---------------------------------------------------------------- quality rules


def plain_counts(text):
    words = WORD.findall(text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def failed(n_words, repeated):
    return n_words < 20 or 100 * repeated > 30 * n_words


def test_rules_over_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    got = {r.doc_id: r for r in rules.op12_decision_list(spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = plain_counts(text)
        assert tuple(got[i][c] for c in BASE) == want
        assert got[i].base_failed == failed(want[0], want[4])
        assert got[i].kept == (not got[i].base_failed and got[i].rule == 0)


def test_rules_held_out(spark):
    """On labelled documents that the rules have not seen: few wrong verdicts on either side."""
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{MIDDLE}/labels.parquet").to_pylist()}
    rows = [r for r in rules.op12_decision_list(spark, MIDDLE).collect() if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    good = [r.kept for r in rows if labels[r.doc_id] == 1 and not r.base_failed]
    poor = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(good) >= 0.95 * len(good) > 0
    assert sum(poor) <= 0.1 * len(poor) and poor


def test_rules_are_learned_and_pruned(spark):
    """Two kinds of poor texts and noise: the list finds both kinds by readable conditions."""
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for i in range(600):
        words = [f"w{rng.integers(5000)}" for _ in range(40)]
        kind = i % 10
        if kind == 0:
            words = [w.replace("w", "$") for w in words]
        if kind == 1:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        marks.append((i, int(kind > 1 or rng.random() < 0.03), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    stats = rules.statistics(docs)
    learned = rules.learn(stats, labels)
    names = {c.feature for r in learned.rules for c in r}
    assert len(learned.rules) >= 2 and "symbols per word" in names
    assert str(learned).endswith("else kept")
    kept = {r.doc_id: r.kept for r in rules.verdicts(stats, learned).collect()}
    assert all(kept[i] == (i % 10 > 1) for i in kept)
    # held-out labels change nothing
    other = [(i, 1 - q, t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in marks]
    assert rules.learn(stats, spark.createDataFrame(other, "doc_id bigint, quality int, toxic int")) == learned


def test_rules_edge_cases(spark, hard, docs, labels):
    some = labels((1, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0), (6, 1, 1), (6, 0, 1), (6, 0, 1))
    rows = rules.judge(hard, some).collect()
    assert len(rows) == 13
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (0, 0, 0, 0, 0, True, False)
        if r.doc_id in (6, 7):
            assert r.n_words == 12_000 and r.n_repeat_words == 12_000 and r.base_failed
    assert len({tuple(r) for r in rows if r.doc_id == 4}) == 1
    assert rules.judge(hard.limit(0), some).collect() == []
    clean = docs((1, " ".join(f"w{k}" for k in range(30))))
    assert [(r.kept, r.rule) for r in rules.judge(clean, some.limit(0)).collect()] == [(True, 0)]
    assert str(rules.DecisionList()) == "1. else kept"


TRICKY = ["a", "b", "\n", " ", "\t", "\x0b", "#", "é", " ", " ", "x y z"]


def test_counts_of_any_text(spark, docs):
    rng = np.random.default_rng(12)
    texts = ["".join(rng.choice(TRICKY, rng.integers(0, 80))) for _ in range(300)]
    texts += ["a b c d e f g h " * 3, "a " * 9, "a " * 8, "x\n\nx\n \nx", " lead", "trail ", "\x1c\x1d \x85"]
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in rules.statistics(docs(*enumerate(texts))).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


# ---------------------------------------------------------------- spelling variants


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, times=5):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and plain_near(v, w)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = (form, n, len(near), counts.get(form))
    roots = {}
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        roots[w] = root
    return {w: (form, roots[w], n, near, form_n) for w, (form, n, near, form_n) in out.items()}


def as_dict(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def numbered(spark, counts):
    rows = [(k, w, counts[w]) for k, w in enumerate(sorted(counts, key=lambda w: w.encode()))]
    return spark.createDataFrame(rows, "id bigint, word string, n bigint")


def test_variants_of_the_whole_table(spark):
    counts = Counter()
    for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert as_dict(variants.op13_permuterm(spark, SMALL)) == plain_variants(counts)


@pytest.mark.parametrize("long", [4, 6, 64])
def test_variants_of_random_words(spark, long, monkeypatch):
    monkeypatch.setattr(variants, "LONG", long)
    rng = np.random.default_rng(long)
    words = {"".join(rng.choice(list("abé"), rng.integers(1, 9))) for _ in range(250)}
    counts = {w: int(rng.choice([1, 2, 5, 25, 130, 700])) for w in words}
    # the tasks read the module's limit, so the rotations are made here
    rows = [(*r, k, counts[w]) for k, w in enumerate(sorted(counts, key=lambda w: w.encode())) for r in variants.rotations_of(w)]
    made = spark.createDataFrame(rows, "prefix string, edited string, deletes boolean, id bigint, n bigint")
    monkeypatch.setattr(variants, "rotate", lambda _: made)
    assert as_dict(variants.group_variants(numbered(spark, counts))) == plain_variants(counts)


def test_long_words_and_chains(spark):
    base = "abcdefghij" * 400
    counts = {base: 100, base[:-1]: 20, "x" + base: 4, base.replace("j", "q", 1): 500, "aaaaaa": 3125, "aaaaaaa": 625, "aaaaaaaa": 125, "aaaaaaaaa": 25}
    counts |= {"p" * 63: 5, "p" * 64: 25, "p" * 65: 125, "p" * 66: 4, "p" * 63 + "q": 1, "p" * 64 + "q": 700}
    assert as_dict(variants.group_variants(numbered(spark, counts))) == plain_variants(counts)


def test_a_range_has_a_row_for_each_letter_at_most():
    words = ["a" + c + "b" for c in "abcdefgh"] + ["ab"]
    prefixes = Counter((p, e) for w in words for p, e, _ in variants.rotations_of(w))
    assert max(prefixes.values()) == 1


def test_variant_edge_cases(spark, hard, docs):
    assert variants.group_variants(variants.vocabulary(variants.words_of(hard.limit(0)))).collect() == []
    assert {r.word for r in variants.group_variants(variants.vocabulary(variants.words_of(hard))).collect()} <= {"alpha", "delta"}
    text = "Kitchen ÀÉÎõü× kitchen÷ KITCHEN kitchen kitchen"  # × and ÷ lie inside the range of letters
    got = as_dict(variants.group_variants(variants.vocabulary(variants.words_of(docs((None, text), (None, text), (3, None), (4, "")), 10**12))))
    assert set(got) == {"kitchen"} and got["kitchen"] == (None, "kitchen", 8, 0, None)
