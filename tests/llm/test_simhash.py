from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import xxhash

from lumenrec.llm import simhash
from lumenrec.llm.components import components

from .conftest import SMALL


def slow_print(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints, radius=2):
    """id → smallest id reachable, by comparing all pairs."""
    label = dict.fromkeys(i for i, _ in prints)
    label = {i: i for i in label}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, (a, x) in enumerate(prints):
        for b, y in prints[:k]:
            if (x ^ y).bit_count() <= radius:
                r, s = root(a), root(b)
                label[max(r, s)] = min(r, s)
    return {i: root(i) for i in label}


def test_whole_table_against_all_pairs(spark):
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    prints = [(r["doc_id"], slow_print(r["text"])) for r in rows]
    want = slow_groups(prints)
    got = {r.doc_id: r for r in simhash.op10_simhash_bktree(spark, SMALL).collect()}
    assert len(got) == len(rows)
    assert all(got[i].fingerprint == f"{p:016x}" and got[i].component_id == want[i] for i, p in prints)


def test_bk_tree_finds_all_within_radius():
    rng = random.Random(5)
    base = rng.getrandbits(64)
    codes = list({base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(300)})
    tree = simhash.BKTree()
    for c in codes:
        tree.add(c)
    for c in codes[::7]:
        for radius in (0, 1, 2, 5):
            assert {tree.codes[i] for i in tree.within(c, radius)} == {x for x in codes if (x ^ c).bit_count() <= radius}


def test_large_buckets_are_cut_without_losing_a_link(spark):
    rng = random.Random(9)
    # a chain and a cloud that share most of their bits, so one bucket holds them all
    base = rng.getrandbits(64)
    codes = {base}
    for _ in range(200):
        codes.add(rng.choice(sorted(codes)) ^ 1 << rng.randrange(20) ^ 1 << rng.randrange(20))
    codes |= {rng.getrandbits(64) for _ in range(50)}
    signed = np.array(sorted(codes), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(c,) for c in signed], "fp bigint")
    want = slow_groups([(c, c % (1 << 64)) for c in signed])
    for shard in (8, 4096):
        labels = {r.node: r.label for r in components(simhash.near_links(df, shard=shard)).collect()}
        assert {c: labels.get(c, c) for c in signed} == want


def test_edge_cases(hard, docs):
    rows = simhash.near_groups(hard).collect()
    assert len(rows) == 13
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    zero = "0" * 16
    assert by[1] == by[2] == by[3] == [(zero, 1)]  # null, empty and blank texts link like any other
    assert by[4][0] == by[4][1]  # repeated rows
    assert len(by[5]) == 2
    assert by[6][0] == by[7][0] and by[7][0][1] == 6
    assert (zero, 1) in by[None]  # a row without id joins its group and is never its name
    assert simhash.near_groups(docs()).count() == 0


def test_keep_first(hard, docs):
    kept = simhash.keep_first(hard)
    assert kept.columns == hard.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and ids.count(6) == 1 and 7 not in ids and 2 not in ids and 3 not in ids
    assert ids.count(None) == 2  # rows without an id have none to be dropped by
    assert simhash.keep_first(docs()).count() == 0


def test_components_of_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (1001, 1001)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
