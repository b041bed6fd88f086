"""Fingerprints, language-model scores, packing and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from lumenrec.llm import decontaminate, language, lempel_ziv, packing, pii, quality, simhash
from lumenrec.llm.common import read

from .conftest import SMALL
from .test_simhash import slow_groups, slow_print

# ---------------------------------------------------------------- Lempel-Ziv fingerprints


def plain_phrases(data):
    seen, start = set(), 0
    while start < len(data):
        end = start + 1
        while end <= len(data) and data[start:end] in seen:
            end += 1
        if end > len(data):
            break
        seen.add(data[start:end])
        start = end
    return seen


def plain_print(text, keep=64):
    return sorted({xxhash.xxh32_intdigest(p) for p in plain_phrases(text.encode())})[:keep]


def plain_likeness(a, b, keep=64):
    both = sorted({*a, *b})[:keep]
    return len([x for x in both if x in a and x in b]) / len(both) if both else 1.0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé ", max_size=200), st.text(alphabet="abcé ", max_size=80))
def test_edit_shares_the_parse(text, other):
    cut = len(text) - len(text) // 3
    sig, edited, edited_sig = lempel_ziv.with_edit(text, other, 16)
    assert edited == text[:cut] + other[: len(text) // 3]
    assert sig.tolist() == plain_print(text, 16) and edited_sig.tolist() == plain_print(edited, 16)
    assert lempel_ziv.likeness(sig, edited_sig, 16) == plain_likeness(plain_print(text, 16), plain_print(edited, 16), 16)


def check_fingerprints(got, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", by[i]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        a, b, c = (plain_print(t) for t in (text, edited, after))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{x:08x}" for x in a) and r.edited_fingerprint == "".join(f"{x:08x}" for x in b)
        assert (r.near_edited, r.near_next) == (plain_likeness(a, b), plain_likeness(a, c))


def test_fingerprints_of_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    check_fingerprints(lempel_ziv.op2_lempel_ziv(spark, SMALL).collect(), rows)


def test_fingerprint_edge_cases(hard, docs):
    check_fingerprints(lempel_ziv.fingerprints(docs((7, "just one ñ text"))).collect(), [(7, "just one ñ text")])
    some = [(None, "no id"), (-5, "é" * 50), (3, None), (4, ""), (900, "abc " * 40), (901, "abc " * 40)]
    check_fingerprints(lempel_ziv.fingerprints(docs(*some).repartition(3)).collect(), some)
    rows = lempel_ziv.fingerprints(hard).collect()
    assert len(rows) == 13 and lempel_ziv.fingerprints(docs()).count() == 0
    assert len({r.fingerprint for r in rows if r.doc_id == 4}) == 1
    long = [r for r in rows if r.doc_id in (6, 7)]
    assert long[0].fingerprint == long[1].fingerprint and {r.near_next for r in long if r.doc_id == 7} == {1.0}


# ---------------------------------------------------------------- language model


def test_base_score_and_shape(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    tokens = {i: [*t.encode().lower().split(), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    got = language.op3_attention_lm(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(t), n)
        assert r.n_known == sum(counts[w] > 0 for w in t)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r.score < 0
    # the trained model beats one that gives each class its share, on texts it has not seen
    docs = read(spark, SMALL, "documents")
    import unittest.mock as mock

    with mock.patch.object(language, "train", lambda rows, classes, tokenizer: language.Attention.start(classes)):
        untrained = language.score(docs).collect()
    total = lambda rows: sum(r.score for r in rows if r.held_out)
    assert total(got) > 0.99 * total(untrained)


@pytest.fixture(scope="module")
def toy():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 301)
    opens = rng.random(301) < 0.4
    opens[-1] = True
    classes = language.Classes.from_counts(counts, opens, classes=12, groups=4, rows=300, contexts=40)
    keys = rng.integers(0, 40 * 301, 500)
    inner = classes.inner(np.unique(keys), rng.integers(1, 9, len(np.unique(keys))))
    model = language.Attention.start(classes, dim=6)
    model.out = rng.normal(size=model.out.shape).astype(np.float32)
    return classes, inner, model


def plain_log10(ids, classes, inner, model):
    """One token at a time: attention over the inputs of its window up to it."""
    rows = [classes.begin, *(classes.row[i] for i in ids[:-1])]
    total = 0.0
    for t, target in enumerate(ids):
        window = 0 if t < language.WINDOW else (t - language.CONTEXT) // language.STRIDE
        start = window * language.STRIDE
        x = np.array([model.embed[rows[k]] + model.place[k - start] for k in range(start, t + 1)], np.float64)
        q, k, v = x[-1] @ model.query, x @ model.key, x @ model.value
        a = np.exp(k @ q / math.sqrt(x.shape[1]))
        h = x[-1] + (a / a.sum() @ v) @ model.mix
        z = h @ model.out + model.bias
        total += (z[classes.of[target]] - np.log(np.exp(z).sum())) / math.log(10)
        context = classes.contexts - 1 if classes.opens[target] or t == 0 else classes.context[ids[t - 1]]
        total += inner[context * len(classes.of) + target]
    return total


def test_language_score_of_a_whole_table_against_the_plain_model(spark, monkeypatch):
    """The query's scores are those of the fitted model, one token of every whole text at a time."""
    fitted = {}
    train, inner_of = language.train, language.Classes.inner

    def keep_model(rows, classes, tokenizer):
        fitted["classes"], fitted["model"] = classes, train(rows, classes, tokenizer)
        return fitted["model"]

    def keep_inner(self, *counts):
        fitted["inner"] = inner_of(self, *counts)
        return fitted["inner"]

    monkeypatch.setattr(language, "train", keep_model)
    monkeypatch.setattr(language.Classes, "inner", keep_inner)
    got = {r.doc_id: r.score for r in language.op3_attention_lm(spark, SMALL).collect()}
    encoder = language.subwords.encoder(language.TOKENIZER)
    texts = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert got.keys() == {r["doc_id"] for r in texts}
    for r in texts:
        words = language.words_of((r["text"] or "").encode())
        ids = [int(i) for w in words for i in np.frombuffer(language.encode_words(encoder, [w])[0], encoder.kind)]
        want = plain_log10([*ids, encoder.size], fitted["classes"], fitted["inner"], fitted["model"])
        assert got[r["doc_id"]] == pytest.approx(want, rel=1e-5)


def test_windows_score_each_token_once(toy):
    classes, inner, model = toy
    rng = np.random.default_rng(5)
    texts = [np.append(rng.integers(0, 300, n), 300) for n in (0, 1, 5, 22, 23, 24, 25, 42, 43, 44, 45, 200)]
    got = language.score_stream(np.concatenate(texts), np.array([len(t) for t in texts]), model, classes, inner, batch=3)
    assert got == pytest.approx([plain_log10(t.tolist(), classes, inner, model) for t in texts], rel=1e-4)


def test_tokens_have_enough_context():
    n = np.array([1, 31, 32, 33, 200, 1000])
    doc, start, scored = language.windows_of(n)
    assert language.WINDOW >= 32 and all(seen >= 8 for seen, at in zip(scored, start) if at)
    last = np.minimum(start + language.WINDOW, n[doc])
    assert np.bincount(doc, last - start - scored).tolist() == n.tolist()


def test_probabilities_add_up(toy):
    classes, inner, model = toy
    table = 10 ** inner.reshape(40, 301).astype(float)
    for line in table:
        assert np.bincount(classes.of, line) == pytest.approx(np.ones(12), rel=1e-4)
    logs = model.log_probs(np.tile([[classes.begin, 4]], (12, 1)), np.stack([np.arange(12)] * 2, axis=1))
    assert np.exp(logs).sum(axis=0) == pytest.approx([1, 1], rel=1e-4)


def log_softmax(z):
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def test_fast_and_plain_forward_agree(toy):
    classes, _, model = toy
    rng = np.random.default_rng(8)
    rows, targets = rng.integers(0, 300, (6, 9)), rng.integers(0, 12, (6, 9))
    plain = log_softmax(model.forward(rows)[0])[np.arange(54), targets.ravel()].reshape(6, 9)
    live = rng.random((6, 9)) < 0.5
    assert model.log_probs(rows, targets) == pytest.approx(plain, abs=1e-4)
    assert model.log_probs(rows, targets, live) == pytest.approx(np.where(live, plain, 0), abs=1e-4)


def test_gradient(toy):
    classes, _, model = toy
    rng = np.random.default_rng(6)
    rows, targets = rng.integers(0, 300, (2, 5)), rng.integers(0, 12, (2, 5))
    weight = np.ones((2, 5), np.float32)
    weight[1, 3:] = 0
    flat = model.flat().astype(np.float64)
    grad = model.gradient(rows, targets, weight)

    def loss(f):
        exact = model.like(f)
        for n in exact.NAMES:
            setattr(exact, n, getattr(exact, n).astype(np.float64))
        at = 0
        for n in exact.NAMES:
            a = getattr(exact, n)
            setattr(exact, n, f[at : at + a.size].reshape(a.shape))
            at += a.size
        return -(log_softmax(exact.forward(rows)[0])[np.arange(10), targets.ravel()].reshape(2, 5) * weight).sum() / weight.sum()

    for k in [*rng.choice(np.flatnonzero(np.abs(grad) > 1e-3), 30), len(flat) - 1]:
        step = np.zeros_like(flat)
        step[k] = 1e-5
        assert grad[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-5, rel=2e-2, abs=2e-4)


def test_every_id_of_every_document_is_a_target(docs):
    texts = ["one two three", "", "alpha beta gamma delta " * 20_000, "日本語の長い文" * 400, "x" * 5000 + " y"]
    encoder = language.subwords.encoder()
    want = sorted([*(i for ids in language.encode_words(encoder, language.words_of(t.encode())) for i in np.frombuffer(ids, encoder.kind).tolist()), encoder.size] for t in texts)
    rows = language.training_ids(language.text_rows(docs(*enumerate(texts))).select("text"), language.TOKENIZER).collect()
    found, windows = [], 0
    for r in rows:  # parts of a document come in a row
        part = language.cut(r.first, np.frombuffer(r.ids, encoder.kind))
        assert part.shape[1] == language.WINDOW + 1 and (part[0, 0] == -1) == r.first
        windows += len(part)
        if r.first:
            found.append([])
        else:
            assert part[0, 0] == found[-1][-1]
        found[-1] += [i for line in part.tolist() for i in line[1:] if i != -2]
    assert sorted(found) == want and len(rows) > len(texts)
    batch = pa.record_batch({"first": [r.first for r in rows], "ids": pa.array([bytes(r.ids) for r in rows], pa.binary())})
    assert sum(map(len, language.buffers(iter([batch]), encoder.kind))) == windows


def test_each_round_holds_other_windows_back(toy):
    classes, _, model = toy
    windows = np.random.default_rng(2).integers(0, 300, (24, language.WINDOW + 1)).astype(np.int32)
    import unittest.mock as mock

    seen = []
    with mock.patch.object(language, "loss", lambda model, kept, classes: seen.append(kept) or 0.0):
        for r in range(3):
            language.descend(model, windows, classes, 1, 0.01, 0, held=r)
    assert [s.tolist() for s in seen[::2]] == [windows[r::8].tolist() for r in range(3)]


def test_language_edge_cases(hard, docs):
    rows = language.score(hard).collect()
    assert len(rows) == 13
    assert {(r.n_tokens, r.score) for r in rows if r.doc_id in (1, 2, 3)} == {(1, rows[0].score)} or len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert language.score(docs()).count() == 0
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    [r] = language.score(docs((only_held, "some words"))).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


# ---------------------------------------------------------------- packing


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, placed = [], [None] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [
            (b["room"], n) for n, b in enumerate(bins)
            if b["room"] >= sizes[k] and sources[k] not in b["sources"] and clusters[k] not in b["clusters"]
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        b = bins[n]
        placed[k] = (n, capacity - b["room"])
        b["room"] -= sizes[k]
        b["sources"].add(sources[k])
        b["clusters"].add(clusters[k])
    return placed


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from("aaaabcd"), st.integers(0, 30)), max_size=80))
def test_best_fit_equals_the_plain_search(items):
    sizes, sources, clusters = zip(*items) if items else ((), (), ())
    assert packing.best_fit(sizes, sources, clusters, 20) == plain_best_fit(sizes, sources, clusters, 20)


def test_packing_the_whole_table(spark):
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) + 1 for r in rows}
    source = {r["doc_id"]: r["source"] for r in rows}
    text = {r["doc_id"]: r["text"] for r in rows}
    got = packing.op8_conflict_best_fit(spark, SMALL).collect()
    total, bins = Counter(), {}
    for r in got:
        total[r.doc_id] += r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert total == size
    for inside in bins.values():
        inside.sort(key=lambda r: r.start)
        assert [r.start for r in inside] == np.cumsum([0, *(r.n_tokens for r in inside[:-1])]).tolist()
        assert sum(r.n_tokens for r in inside) <= packing.CAPACITY
        assert len({source[r.doc_id] for r in inside}) == len({text[r.doc_id] for r in inside}) == len(inside)


def test_packing_shards_and_edge_cases(hard, docs):
    rows = packing.pack(hard, capacity=100, shard=4).collect()
    assert sum(r.n_tokens for r in rows if r.doc_id == 6) == 12_001
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert len({(r.doc_id, r.piece) for r in rows}) < len(rows)  # repeated rows stay
    assert len({r.bin_id >> 32 for r in rows}) > 1
    assert packing.pack(docs()).count() == 0


def test_near_copies_do_not_share_a_bin(spark, docs):
    base = [f"w{k}" for k in range(300)]
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in range(100, 106)]
    codes = {slow_print(t) for t in near}
    group = slow_groups(list(enumerate(slow_print(t) for t in near)))
    assert len(set(near)) == 6 and len(codes) > 1 and len(set(group.values())) < 6
    table = docs(*enumerate(near), (None, near[0]), (None, "short one"), (None, "another"), (6, None))
    table = table.selectExpr("doc_id", "text", "concat('s', monotonically_increasing_id()) as source")
    rows = packing.pack(table).collect()
    bins = {}
    for r in rows:
        if r.doc_id is not None and r.doc_id < 6:
            bins.setdefault(r.bin_id, []).append(group[r.doc_id])
    assert len(rows) == 10 and all(len(set(b)) == len(b) for b in bins.values())
    assert max(Counter(r.bin_id for r in rows).values()) > 1


# ---------------------------------------------------------------- pipeline


def plain_pipeline(spark):
    """The stages one after the other in plain Python, on the trained models' own answers."""
    rows = {r["doc_id"]: r for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    scores = quality.score(docs, quality.fit(docs, labels)).collect()
    kept = [r.doc_id for r in scores if r.predicted]
    group = slow_groups([(i, slow_print(rows[i]["text"])) for i in sorted(kept)])
    kept = [i for i in kept if group[i] == i]
    bench = pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()
    tests = decontaminate.TestSet.of([(str(b["item_id"]), decontaminate.words_of((b["text"] or "").encode())) for b in bench], 13)
    kept = [i for i in kept if not decontaminate.search([(rows[i]["text"] or "").encode()], [lambda: tests]).contaminated()[0]]
    crf, size = pii.model(), {}
    for i in kept:
        [(base, added)] = pii.find_spans([rows[i]["text"] or ""], crf)
        size[i] = len(pii.mask(rows[i]["text"] or "", base + added).encode().split()) + 1
    return size


def test_pipeline(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "drop_poor", "drop_near_copies", "drop_benchmark", "mask_personal", "pack_sequences"
    ]
    total = Counter()
    for r in corpus_pipeline.run(spark, SMALL).collect():
        total[r.doc_id] += r.n_tokens
    assert total == plain_pipeline(spark)


def test_stages_keep_the_columns(spark, hard):
    docs = hard
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        docs = out
    empty = hard.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_gradient_adds_rows_by_counting(toy, monkeypatch):
    """Scattered additions took a sixth of a step; rows that occur twice get both gradients all the same."""

    class Without:
        def __getattr__(self, name):
            assert name != "add"
            return getattr(np, name)

    classes, _, model = toy
    rng = np.random.default_rng(5)
    rows, targets = rng.integers(0, 20, (7, 9)), rng.integers(0, 12, (7, 9))
    weight = np.ones((7, 9), np.float32)
    monkeypatch.setattr(language, "np", Without())
    whole = model.gradient(rows, targets, weight)
    parts = [model.gradient(rows[k : k + 1], targets[k : k + 1], weight[k : k + 1]) for k in range(7)]
    assert whole == pytest.approx(sum(parts) / 7, abs=1e-5)


def test_gradient_of_large_scores_is_finite(toy):
    classes, _, model = toy
    large = model.like(model.flat() * 300)  # beyond what single precision can take the exponential of
    rows = np.arange(45).reshape(5, 9)
    assert np.isfinite(large.gradient(rows, rows % 12, np.ones((5, 9), np.float32))).all()
