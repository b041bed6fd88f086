from __future__ import annotations

import hashlib
import re
from itertools import product

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenrec.llm import pii

from .conftest import SMALL

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    total = 0
    for k, c in enumerate(number[::-1]):
        d = int(c) * (1 + k % 2)
        total += d // 10 + d % 10
    return 13 <= len(number) <= 19 and total % 10 == 0


def plain_spans(text):
    """The patterns as they are written."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if luhn(re.sub("[^0-9]", "", m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@%+-_ ()0123456789é4\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs():
    for text in ("1" * 60_000, "a" * 60_000, "1." * 30_000, "a@" * 30_000, "+1" + " " * 60_000, "a." * 20_000 + "@b.c"):
        pii.base_spans(text)  # in linear time
    assert pii.base_spans("x " * 50_000 + "a@b.c") == [("email", 100_000, 100_005)]


def test_query_over_the_whole_table(spark):
    rows = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    got = {r.doc_id: r for r in pii.op1_crf_pii(spark, SMALL).collect()}
    assert got.keys() == rows.keys()
    for i, text in rows.items():
        base, r = plain_spans(text), got[i]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        every = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(every)
        assert every == sorted(every, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))


@pytest.fixture(scope="module")
def crf():
    return pii.model()


def test_the_model_learns_its_table_and_generalises(crf):
    for line in pii.LABELLED:
        text, spans = pii.read_labelled(line)
        [s] = crf.sequences(text, whole=True)
        tags = [pii.TAGS[t] for t in crf.decode([s])[0]]
        assert [sum(t == f"B-{k}" for t in tags) for k in pii.KINDS] == [sum(x[0] == k for x in spans) for k in pii.KINDS], line
    new = [
        ("please ring (404) 555-8812 after six", "phone", "(404) 555-8812"), ("ring 212-555-0199 now", "phone", "212-555-0199"),
        ("tel. (061) 555-7310, thanks", "phone", "(061) 555-7310"),
    ]
    for text, kind, part in new:
        [(base, added)] = pii.find_spans([text], crf)
        assert base == [] and [(k, text[a:b]) for k, a, b in added] == [(kind, part)], text


def test_clean_texts_get_no_span(crf):
    clean = [
        "It was 1999, and 2,500 people saw version 3.2.1 on 12 May.", "chapter 4, verse 12-14", "The end.", "",
        'token = "f91f2b873bc89b9c5b8b3a486adf32c8523be758"', "at 10:30 on 2020-01-31", "@name wrote", "Apache License, Version 2.0.",
    ]
    assert [b + a for b, a in pii.find_spans(clean, crf)] == [[]] * len(clean)


def test_viterbi_equals_the_best_of_all_paths(crf):
    rng = np.random.default_rng(2)
    text = "call (030) 901 now"
    seqs = crf.sequences(text)
    [s] = seqs
    s = pii.Sequence(s.starts[:5], s.ends[:5], s.rows[:5])
    crf2 = pii.Crf(crf.number, crf.emit + rng.normal(0, 1, crf.emit.shape), crf.step + rng.normal(0, 1, crf.step.shape))
    emit = [crf2.emit[r].sum(axis=0) for r in s.rows]

    def value(path):
        tags = [0, *path, 0]
        return sum(crf2.step[a, b] for a, b in zip(tags, tags[1:])) + sum(e[t] for e, t in zip(emit, path))

    best = max(product(range(len(pii.TAGS)), repeat=5), key=value)
    longer = pii.Sequence(list(range(9)), list(range(1, 10)), [[0]] * 9)
    assert tuple(crf2.decode([longer, s])[1]) == best  # also beside a longer sequence in the batch


def test_parts_give_the_path_of_the_whole_text(crf):
    text = "words " * 30 + "call (030) 901-8200 before noon " + "words " * 30 + "a@b and 12 words " + "words " * 20
    parts = crf.sequences(text)
    assert 1 < len(parts) < 6 and sum(len(p.rows) for p in parts) < 60
    for p in parts:
        assert all(text[a:b].strip() for a, b in zip(p.starts, p.ends))


def test_edge_cases(hard, docs):
    rows = pii.personal_data(hard).collect()
    assert len(rows) == 13 and all(r.spans == "" for r in rows)
    assert pii.personal_data(docs()).count() == 0
    spoken = docs((1, "é mail a@b.c or +1 (415) 555-2671"), (1, "é mail a@b.c or +1 (415) 555-2671"))
    assert {r.spans for r in pii.personal_data(spoken).collect()} == {"email:7:12,phone:16:33"}


def test_redact(hard, docs):
    out = pii.redact(hard)
    assert out.columns == hard.columns and sorted(map(str, out.collect())) == sorted(map(str, hard.collect()))
    masked = pii.redact(docs((1, "mail a@b.c now"), (2, None))).select("doc_id", "text", "n_chars").collect()
    assert sorted(map(tuple, masked)) == [(1, "mail <EMAIL> now", 16), (2, None, None)]
    assert pii.mask("0123456789", [("ip", 2, 5), ("card", 4, 8)]) == "01<IP>89"


def test_batches_are_bounded_in_tokens(crf):
    size = sorted([3] * 1200 + [400_000, 600_000, 1_000_000] + [2000] * 600)
    batches = list(pii.decode_batches(list(range(len(size))), size))
    assert [i for b in batches for i in b] == list(range(len(size)))
    assert all(len(b) == 1 or len(b) <= 512 and len(b) * size[b[-1]] <= 500_000 for b in batches)
    asked = []

    class Watched(pii.Crf):
        def decode(self, sequences):
            asked.append(len(sequences) * max(len(s.rows) for s in sequences))
            return super().decode(sequences)

    table = "12 34 5.6 " * 1500
    texts = [table] * 120 + ["call (404) 555-8812 now"]
    found = pii.find_spans(texts, Watched(crf.number, crf.emit, crf.step))
    assert max(asked) <= 500_000 and found == [pii.find_spans([t], crf)[0] for t in texts]


WHOLE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"([0-9]+\.){3}[0-9]+"),
    "card": re.compile(r"[0-9][0-9 .-]*[0-9]"),
    "phone": re.compile(r"[+(0-9][0-9().\x20-]*[0-9]"),
}
MODEL = pii.model()


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(pii.KINDS), st.text(alphabet="a.@+-_ ()0123456789é²٣Ç\n", max_size=24))
def test_valid_takes_any_text(kind, text):
    if pii.valid(kind, text):
        assert WHOLE[kind].fullmatch(text)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(["ping ", "host ", "card ", "Call ", ""]), st.text(alphabet="a.@+-_ ()0123456789é²٣Ç\n", max_size=60))
def test_decoded_spans_have_their_kinds_pattern(before, text):
    text = before + text
    base, added = pii.find_spans([text], MODEL)[0]
    assert base == plain_spans(text)
    for kind, a, b in added:
        assert WHOLE[kind].fullmatch(text[a:b])


def test_numbers_that_are_no_addresses():
    for text in ("...", " 1.2.3.4", "1_0.2.3.4", "٣.1.1.1", "8.8.4.Ç", "192.168.0.²", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1.1.1.\n"):
        assert not pii.valid("ip", text)
    assert pii.valid("ip", "008.8.4.255")
    for text in ("ping 8.8.4.Ç twice", "host 192.168.0.² was down"):
        assert pii.find_spans([text], MODEL) == [([], [])]
