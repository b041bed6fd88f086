"""Decontamination, substring deduplication and token files against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenrec.llm import decontaminate, substrings, subwords, tokenids
from lumenrec.llm.common import text_rows
from lumenrec.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]) == []


# ---------------------------------------------------------------- decontamination


def fold(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_contamination(text, items, window=13):
    words, hit, names = fold(text), set(), set()
    for name, item in items:
        item = fold(item)
        n = min(window, len(item))
        if not n:
            continue
        for o in range(len(item) - n + 1):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == item[o : o + n]:
                    hit.update(range(p, p + n))
                    names.add(name)
    names = sorted(names)
    return len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def test_decontamination_on_random_words(spark, docs):
    rng = random.Random(3)
    items = [(str(k), " ".join(rng.choices("abcÉé1", k=rng.choice([0, 1, 4, 13, 14, 20])))) for k in range(12)]
    items += [("9", items[4][1] + " b"), ("x", None), (None, "a b c a")]
    texts = [(k, " ".join(rng.choices("aBcÉé1-.", k=rng.randrange(60)))) for k in range(40)]
    texts += [(50 + k, f"q, q {i} - {i}" * 2) for k, (_, i) in enumerate(items)]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id string, text string, n_hit string")
    named = [(i or "", t) for i, t in items]
    for window in (13, 3):
        got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.contamination(docs(*texts), bench, window).collect()}
        assert got == {i: plain_contamination(t, named, window) for i, t in texts}


def test_blocks_of_the_benchmark_add_up(spark):
    texts = [b"a b c d e f g", b"x a b c y c d e f", b"", b"g"]
    items = [("1", "a b c"), ("2", "c d e f"), ("3", "g")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    whole, parts = (
        decontaminate.search(texts, decontaminate._openers(decontaminate.test_blocks(bench, 3, n))) for n in (1000, 2)
    )
    assert whole.n_hit.tolist() == parts.n_hit.tolist() == [7, 7, 0, 1] and whole.items == parts.items
    assert sorted(whole.matches) == sorted(parts.matches)


def test_longest_matches(spark, docs):
    bench = spark.createDataFrame([("i", "a b c d e f g h")], "item_id string, text string")
    got = decontaminate.matches(docs((1, "x A b c d e y"), (2, "f g h a b"), (3, "c d e f g h! c d e")), bench, 3).collect()
    assert sorted((r.doc_id, r.doc_word, r.item_word, r.n_words) for r in got) == [(1, 1, 0, 5), (2, 0, 5, 3), (3, 0, 2, 6), (3, 6, 2, 3)]


def test_decontamination_edge_cases(spark, hard, docs):
    bench = spark.createDataFrame([("1", "one two three four five"), ("2", ""), ("3", None)], "item_id string, text string")
    rows = decontaminate.contamination(hard, bench).collect()
    assert len(rows) == 13 and {r.doc_id for r in rows if r.contaminated} == {4}
    kept = decontaminate.keep_clean(hard, bench)
    assert kept.columns == hard.columns and kept.count() == 11
    assert decontaminate.keep_clean(docs(), bench).count() == 0
    none = bench.where("false")
    assert decontaminate.keep_clean(hard, none).count() == 13 and decontaminate.contamination(docs(), none).count() == 0


# ---------------------------------------------------------------- substrings


def plain_dedup(rows, window=20):
    """(id, text) with distinct ids → id: (n_words, n_removed, sha)."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        cut = set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                cut.update(range(p, p + window))
            seen.add(key)
        kept = " ".join(w for k, w in enumerate(words) if k not in cut)
        out[i] = (len(words), len(cut), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("chunk", [200, 4 << 20])
def test_substrings_on_repetitive_texts(docs, chunk, monkeypatch):
    rng = random.Random(chunk)
    passage = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "é", "Sit"], k=rng.randrange(15, 60))) for _ in range(6)]
    texts = []
    for k in range(60):
        parts = [rng.choice([rng.choice(passage), " ".join(str(rng.random()) for _ in range(rng.randrange(25))), "pf " * rng.randrange(50)]) for _ in range(4)]
        texts.append((rng.choice([-1, 1]) * k * 3 + 1, rng.choice([" ", "\n", "\t "]).join(parts)))
    texts = list(dict(texts).items()) + [(1000, None), (1001, ""), (1002, texts[5][1])]
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = substrings.deduplicate(docs(*texts), blocks=7).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == plain_dedup(texts)
    assert any(r.n_removed for r in rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in rows)


def test_substring_edge_cases(hard, docs):
    rows = substrings.deduplicate(hard).collect()
    assert len(rows) == 13
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[4][0] == by[4][1] and by[1][0].n_words == by[2][0].n_words == by[3][0].n_words == 0
    assert by[6][0].n_removed > 11_000 and by[6][0].n_words == 12_000  # repeats itself
    assert by[7][0].n_removed == 12_000
    copies = docs(*[(5, " ".join(map(str, range(30))))] * 2, (None, " ".join(map(str, range(30)))))
    assert sorted((r.doc_id is None, r.n_removed) for r in substrings.deduplicate(copies).collect()) == [(False, 0), (False, 0), (True, 30)]
    assert substrings.deduplicate(docs()).count() == 0


def test_a_passage_of_many_documents_is_dealt_to_many_blocks(docs, spark):
    """Windows over the ends of a passage hold words of their own, but share its anchors."""
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [(k, f"a{k} b{k} c{k} {passage} x{k} y{k} z{k}" if k % 3 else f"{k} " * 3 + "other words here") for k in range(900)]
    rows = text_rows(docs(*texts)).withColumn("part", F.xxhash64("text"))
    hot = substrings.hot_anchors(rows, 8)
    plain = [(i, t.encode()) for i, t in texts]
    ids, parts = np.array([i for i, _ in plain], np.int64), np.zeros(len(plain), np.int64)
    most = []
    for given in (np.zeros(0, np.uint64), hot):
        dealt = substrings.parse_chunk(ids, parts, [t for _, t in plain], 8, given).to_pylist()
        windows = {}
        for r in dealt:
            if r["windows"]:
                windows[r["block"]] = windows.get(r["block"], 0) + len(r["windows"]) // 6
        most.append(max(windows.values()) / sum(windows.values()))
    assert 0 < len(hot) <= 2 * 8 and most[0] > 0.3 and most[1] < 0.2
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicate(docs(*texts), blocks=8).collect()} == plain_dedup(texts)


def test_frequent_keys_miss_no_more_than_their_bound():
    rng = np.random.default_rng(3)
    stream = np.append(rng.zipf(1.3, 20_000) % 5000, np.full(3000, 77)).astype(np.uint64)
    rng.shuffle(stream)
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for part in np.array_split(stream, 30):
        keys, counts = substrings.frequent(np.append(keys, part), np.append(counts, np.ones(len(part), np.int64)), 50)
    kept = dict(zip(keys.tolist(), counts.tolist()))
    assert len(kept) <= 50
    for key, n in zip(*np.unique(stream, return_counts=True)):
        assert n - len(stream) / 50 <= kept.get(int(key), 0) <= n


def test_hash_helpers():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 50, np.uint64)
    for n in (1, 2, 3, 7, 11):
        assert substrings.least_of(x, n).tolist() == [x[i : i + n].min() for i in range(50 - n + 1)]
        same = np.concatenate([x, x])
        runs = substrings.runs_of(same, n)
        assert (runs[: 50 - n + 1] == runs[50 : 100 - n + 1]).all() and len(set(runs[:40].tolist())) == 40
    data = np.frombuffer(b"  ab c\xc3\xa9\tab\n\x1cab ab", np.uint8)
    starts, h = substrings.word_hashes(data)
    assert [bytes(data[s:]).split()[0] for s in starts] == bytes(data).split() == [b"ab", b"c\xc3\xa9", b"ab", b"\x1cab", b"ab"]
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


# ---------------------------------------------------------------- token ids


@pytest.fixture(scope="module")
def encoder():
    return subwords.Encoder(keep=50)


ODD = [
    "", " ", "\n", " a", "a ", "a  b", "a\n\nb", "a \nb", "a\tb", "don't we'll 'tis", "x'\ns", "a\xa0b c", "<|endoftext|> a", "é\nñ ñ",
    "\x1c a", "a\n'll b", "1 2\n3", "$$$ %%%\n!!", "a\r\nb", "日本 語\n語", "🙂 🙂\n🙂", "the same the same\nthe same",
]


def test_ids_equal_the_tokenizer(encoder):
    texts = ODD + [r["text"] or "" for r in pq.read_table(f"{SMALL}/documents.parquet", columns=["text"]).to_pylist()]
    for found, text in zip(encoder.encode(texts), texts):
        assert np.frombuffer(found, encoder.kind).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text[:50]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'st \n\t\xa0é1.!", max_size=30), max_size=4))
def test_ids_equal_the_tokenizer_on_any_text(texts):
    e = test_ids_equal_the_tokenizer_on_any_text.__dict__.setdefault("encoder", subwords.Encoder(keep=10))
    for found, text in zip(e.encode(texts), texts):
        assert np.frombuffer(found, e.kind).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 40)), st.integers(1, 1 << 20))
def test_elias_fano_round_trip(values, scale):
    values = sorted(v // scale for v in values)
    ef = tokenids.EliasFano.of(np.array(values, np.uint64))
    back, end = tokenids.EliasFano.unpack(memoryview(ef.pack()), 0)
    assert end == len(ef.pack()) and back.values().tolist() == values
    assert [back.select(k) for k in range(len(values))] == values


def test_elias_fano_is_small_and_selects_fast():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    ef = tokenids.EliasFano.of(values)
    assert 8 * len(ef.pack()) / len(values) < np.log2(1000) + 2.5
    for k in (0, 1, 511, 512, 513, 99_999):
        assert ef.select(k) == values[k]
    with pytest.raises(IndexError):
        ef.select(100_000)


def test_file_round_trip(spark, docs, tmp_path, encoder):
    rng = random.Random(4)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), rng.choice(ODD) * rng.randrange(3)) for _ in range(60)]
    rows += [(None, "no id"), (None, None), (rows[0][0], "same id"), (-(1 << 63), "lowest"), ((1 << 63) - 1, "highest")]
    table = tokenids.token_table(docs(*rows), str(tmp_path / "ids"), file_ids=40)
    got = sorted(table.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()

    def digest(text):
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), *digest(t)) for i, t in rows)
    files = sorted(tmp_path.glob("ids/*.ids"))
    assert len(files) > 3
    first = tokenids.IdFile.of(files[-1].read_bytes())
    for k in range(first.ends.n):
        stop = first.ends.select(k)
        assert first.document(k)[-1] == 0 and first.document(k).tolist() == first.ids[first.ends.select(k - 1) if k else 0 : stop].tolist()
    assert tokenids.token_table(docs(), str(tmp_path / "none")).count() == 0


def test_token_query_over_the_whole_table(spark, encoder):
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id").to_pylist()
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenids.op7_elias_fano_ids(spark, SMALL).collect()}
    at = 0
    for r in rows:
        ids = encoder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        assert got[r["doc_id"]] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_long_words_that_differ_keep_their_documents(docs):
    """Two words of 1,024 letters, one the other's complement: polynomials modulo 2^64 cannot tell them apart."""
    first = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    rest = " ".join(f"w{k}" for k in range(19))
    other = first.translate(str.maketrans("ab", "ba"))
    rows = substrings.deduplicate(docs((1, f"{first} {rest}"), (2, f"{other} {rest}"), (3, f"{first} {rest}"))).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: 0, 3: 20}
