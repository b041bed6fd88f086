from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenrec.llm import quality, toxicity
from lumenrec.llm.common import read

from .conftest import SMALL

LARGER = "/root/testdata/sf0.01"


def judged(spark, df, label):
    rows = df.join(read(spark, LARGER, "labels"), "doc_id").select("held_out", "score", "predicted", F.col(label).alias("y")).collect()
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.y for r in held) / len(held)
    caught = sum(r.predicted for r in held if r.y) / sum(r.y for r in held)
    sure = sum(r.y for r in held if r.predicted) / sum(r.predicted for r in held)
    return right, caught, sure


def test_quality_held_out(spark):
    df = quality.op4_subword_quality(spark, LARGER)
    right, _, _ = judged(spark, df, "quality")
    assert right >= 0.97
    rows = df.collect()
    assert len(rows) == read(spark, LARGER, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_held_out(spark):
    df = toxicity.op9_grammar_toxicity(spark, LARGER)
    right, caught, sure = judged(spark, df, "toxic")
    assert right >= 0.95 and caught >= 0.75 and sure >= 0.85
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in df.collect())


def test_held_out_labels_are_not_used(spark):
    """Turning every held-out label around changes no score."""
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumns({c: F.when(held, 1 - F.col(c)).otherwise(F.col(c)).cast("int") for c in ("quality", "toxic")})
    for module in (quality, toxicity):
        one, two = (
            sorted(map(tuple, module.score(docs, module.fit(docs, each)).collect())) for each in (labels, turned)
        )
        assert one == two


def test_scoring_by_words_equals_the_network():
    """The cached sums give what averaging all vectors and applying the output layer gives."""
    rng = np.random.default_rng(0)
    f = quality.Subwords(buckets=512)
    model = quality.Model(f, rng.normal(size=(512, 4)), rng.normal(size=(4, 2)), rng.normal(size=2))
    for text in (b"", b"a a b", b"The cat the cat sat sat sat", "é ñandú ñandú".encode()):
        found, n = f.counts(text)
        hidden = (n / max(1, n.sum())) @ model.vectors[found]
        z = np.exp(hidden @ model.output + model.bias)
        assert model.score_all([text], {}, model.weights())[0] == pytest.approx(z[1] / z.sum(), abs=1e-6)


def test_subword_features():
    f = quality.Subwords()
    size = lambda *words: sum(len(b) for _, b in f.of_words(list(words)))
    assert size(b"ab") == 1 + 2 + 1  # <ab>; <ab, ab>; <ab>
    one = sorted(b for _, found in f.of_words([b"abc"]) for b in found.tolist())
    many = [b for w, found in f.of_words([b"x", b"abc", b"abcdef"]) for k, b in zip(w.tolist(), found.tolist()) if k == 1]
    assert sorted(many) == one  # a word's features do not depend on its neighbours
    found, n = f.counts(b"x x x")
    assert n.sum() == 3 * size(b"x") + 2 and f.repeat in found
    assert list(f.of_words([])) == [] and len(f.counts(b"")[0]) == 0


def test_edge_cases(hard, docs, labels):
    good = [(100 + k, f"plain prose number {k} goes here") for k in range(20)]
    bad = [(200 + k, f"BUY!! NOW!! {k}!! you idiot. you idiot {k}") for k in range(20)]
    known = labels(*((i, 1, 0) for i, _ in good), *((i, 0, 1) for i, _ in bad), (100, 1, 0), (4, None, None), (None, 1, 0), (9999, 0, 0))
    table = docs(*good, *bad)
    for module in (quality, toxicity):
        model = module.fit(table, known)
        rows = module.score(hard, model).collect()
        assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
        same = [r.score for r in rows if r.doc_id == 4]
        assert len(same) == 2 and same[0] == same[1]
        empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
        assert len(empty) == 1
        assert module.score(docs(), model).count() == 0
        for nothing in (labels(), labels((100, 1, 1), (101, 1, 1))):  # no label, or one kind only
            assert all(0 <= r.score <= 1 for r in module.score(hard, module.fit(table, nothing)).collect())
    kept = quality.keep_good(table, quality.fit(table, known))
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in good}


# ---------------------------------------------------------------- the grammar


LEXICON = toxicity.Lexicon({"idiot": 2.0, "scum": 1.5}, {"achlich": 1.0})


def kinds(clause):
    return toxicity.attack([LEXICON.read(t) for t in clause.lower().split()])


@pytest.mark.parametrize(
    "clause, want",
    [
        ("the idiot came", {"plain": 2.0}), ("you idiot", {"aimed": 2.0}), ("idiot that you are", {"plain": 2.0, "aimed": 2.0}),
        ("he is not an idiot", {"negated": 2.0}), ("never mind all of the many idiot", {"plain": 2.0}),
        ("someone wrote idiot on it", {"reported": 2.0}), ("i will kill you", {"threat": 1.0}), ("i will kill time", {}),
        ("they told me to kill you", {}), ("an idiot and scum", {"plain": 3.5}), ("achlichung!!", {"plain": 1.0}), ("fine words", {}),
    ],
)
def test_clauses(clause, want):
    assert kinds(clause) == want


def test_composition_equals_one_machine_after_the_other():
    rng = np.random.default_rng(1)
    parts = (toxicity.negation(), toxicity.reported(), toxicity.threats(), toxicity.targets())
    for _ in range(200):
        tags = rng.choice(toxicity.TAGS, 12).tolist()
        want = tags
        for machine in parts:
            state, out = 0, []
            for t in want:
                state, wrote = machine.step(state, t)
                out.append(wrote)
            want = out
        state, got = 0, []
        for t in tags:
            state, wrote = toxicity.GRAMMAR.step(state, t)
            got.append(wrote)
        assert got == want


def test_words_alone_do_not_cross_clauses():
    one = toxicity.document_features("you. idiot here", LEXICON, {})
    two = toxicity.document_features("you idiot here", LEXICON, {})
    at = toxicity.KINDS.index("aimed")
    assert one[at] == 0.0 and two[at] == 2.0
    assert toxicity.document_features("", LEXICON, {}) == [0.0] * (len(toxicity.KINDS) + 2)


@pytest.mark.parametrize(
    "clause, want",
    [
        ("if you talk i will kill you tonight", {"threat": 1.0}),  # the target comes a second time
        ("it is not late and you are not an idiot", {"negated": 2.0}),  # the negation does
        ("he said it was late and the idiot is what he said", {"reported": 2.0}),
        ("you are not an idiot but today you are an idiot", {"negated": 2.0, "aimed": 2.0}),
        ("you idiot idiot idiot", {"aimed": 2.0}), ("i will kill you and kill you and stab you", {"threat": 2.0}),
        ("kill and not hurt you and kill him", {"threat": 1.0}), ("idiot and not scum you see", {"plain": 2.0, "negated": 1.5, "aimed": 2.0}),
    ],
)
def test_a_clause_is_read_whole_and_a_word_counts_once(clause, want):
    found = toxicity.document_features(clause, LEXICON, {})
    assert dict(zip(toxicity.KINDS, found)) == {k: want.get(k, 0.0) for k in toxicity.KINDS}


def test_short_insults_are_learned(docs, labels):
    assert {a for a, _ in toxicity.arcs_of("oaf 阿呆 abcde")} == {"=oaf", "=阿呆", "=abcde", "abcd"}
    bad = [(i, f"the {w} of number {i} is here") for i in range(240) for w in [("oaf", "阿呆")[i % 2]]]
    good = [(1000 + i, f"the day of number {i} is here") for i in range(240)]
    table = docs(*bad, *good)
    model = toxicity.fit(table, labels(*((i, 0, 1) for i, _ in bad), *((i, 1, 0) for i, _ in good)))
    assert set(model.lexicon.words) == {"oaf", "阿呆"}
    got = {r.doc_id: r.predicted for r in toxicity.score(docs((1, "what an oaf"), (2, "阿呆 !"), (3, "the day is here")), model).collect()}
    assert got == {1: 1, 2: 1, 3: 0}


def test_quality_score_of_a_whole_table_against_the_network(spark):
    """The query's scores are those of averaging the fitted vectors of every whole text and applying the output layer."""
    docs = read(spark, SMALL, "documents")
    model = quality.fit(docs, read(spark, SMALL, "labels"))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.score for r in quality.op4_subword_quality(spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        found, n = model.features.counts(text)
        hidden = (n / max(1, n.sum())) @ model.vectors[found].astype(np.float64)
        z = hidden @ model.output + model.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(z[0] - z[1])), abs=1e-6)


def test_toxicity_score_of_a_whole_table_against_its_clauses(spark):
    """The query's scores are those of reading every clause of every whole text, one token after the other."""
    docs = read(spark, SMALL, "documents")
    model = toxicity.fit(docs, read(spark, SMALL, "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.score for r in toxicity.op9_grammar_toxicity(spark, SMALL).collect()}
    assert got.keys() == texts.keys() and len(set(got.values())) > 2
    for i, text in texts.items():
        worst, strength = dict.fromkeys(toxicity.KINDS, 0.0), []
        for clause in toxicity.clauses(text.lower().split()):
            found = toxicity.attack([model.lexicon.read(t) for t in clause], clause)
            if found:
                strength.append(max(found.values()))
            for kind, weight in found.items():
                worst[kind] = max(worst[kind], weight)
        features = [*worst.values(), np.log1p(len(strength)), np.log1p(sum(strength))]
        logit = model.bias + sum(w * x for w, x in zip(model.weights, features))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)
