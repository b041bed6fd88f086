"""Toxicity: a weighted finite-state grammar over clauses.

Five transducers are composed: insults (a word automaton learned from labels), threats, targets,
negation and reported speech. The composed machine reads a clause word by word and writes what kind
of attack the clause is, if any; weights of words add up along a path and the best path counts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import fold_of, materialize, read, text_rows
from lumenrec.llm.quality import labelled_sample

FOLDS, HELD_OUT = 3, 1
CACHE = 200_000
PREFIXES = range(4, 9)

# Word lists of this grammar (English, German, French, Spanish).
THREATS = frozenset("kill hurt destroy beat stab shoot töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())
TARGETS = frozenset("you your yours u du dich dir euch ihr tu toi te vous vos ton ti usted ustedes he she they him her them".split())
NEGATIONS = frozenset("not no never neither nor isn't aren't don't nicht kein keine nie pas jamais nunca ni".split())
REPORTS = frozenset("said says called calls told wrote quoted reported sagte nannte schrieb dit disait dijo llamó escribió".split())

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CLAUSE_END = frozenset(".!?;:")

# ---------------------------------------------------------------- transducers

#: Tags that the word automata write and the grammar reads.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "o", "I", "T", "Y", "N", "R"
TAGS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)
#: What the grammar writes for an attack: plain, negated, reported, threat. A target makes it aimed.
KINDS = ("plain", "aimed", "negated", "reported", "threat")


@dataclass(frozen=True)
class Transducer:
    """Arcs ``(state, read) → (next state, written)``; state 0 starts; reading an unlisted tag copies it."""

    arcs: dict[tuple[int, str], tuple[int, str]] = field(default_factory=dict)

    def step(self, state: int, tag: str) -> tuple[int, str]:
        return self.arcs.get((state, tag), (state, tag))


def negation(reach: int = 3) -> Transducer:
    """Insults and threats up to ``reach`` words after a negation are written as negated."""
    arcs: dict[tuple[int, str], tuple[int, str]] = {(0, NEGATION): (reach, NEGATION)}
    for left in range(1, reach + 1):
        for tag in (*TAGS, "i"):
            arcs[(left, tag)] = (left - 1, tag)
        arcs[(left, INSULT)] = (left - 1, "i")
        arcs[(left, THREAT)] = (left - 1, OTHER)
        arcs[(left, NEGATION)] = (reach, NEGATION)
    return Transducer(arcs)


def reported() -> Transducer:
    """What follows a verb of speech in the clause is reported: insults are, threats are dropped."""
    return Transducer({(0, REPORT): (1, REPORT), (1, INSULT): (1, "r"), (1, "i"): (1, "i"), (1, THREAT): (1, OTHER)})


def threats() -> Transducer:
    """A threat needs a target later in the clause: it is written there."""
    return Transducer({(0, THREAT): (1, OTHER), (1, TARGET): (0, "t"), (1, THREAT): (1, OTHER)})


def targets() -> Transducer:
    """An insult after a target is aimed; a target after a plain insult aims it in hindsight."""
    return Transducer(
        {(0, TARGET): (1, OTHER), (0, INSULT): (2, "plain"), (1, INSULT): (1, "aimed"), (1, TARGET): (1, OTHER),
         (2, TARGET): (1, "aimed"), (2, INSULT): (2, "plain")}
        | {(s, a): (s, b) for s in (0, 1, 2) for a, b in (("i", "negated"), ("r", "reported"), ("t", "threat"))}
    )


def compose(first: Transducer, second: Transducer, alphabet: Iterable[str]) -> Transducer:
    """The transducer that reads what ``first`` reads and writes what ``second`` writes of its output."""
    number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    alphabet = tuple(alphabet)
    while todo:
        a, b = todo.pop()
        for tag in alphabet:
            next_a, middle = first.step(a, tag)
            next_b, out = second.step(b, middle)
            if (next_a, next_b) not in number:
                number[(next_a, next_b)] = len(number)
                todo.append((next_a, next_b))
            arcs[(number[(a, b)], tag)] = (number[(next_a, next_b)], out)
    return Transducer(arcs)


def grammar() -> Transducer:
    machine = compose(negation(), reported(), TAGS)
    for part in (threats(), targets()):
        machine = compose(machine, part, TAGS)
    return machine


GRAMMAR = grammar()

# ---------------------------------------------------------------- the learned word automaton


@dataclass(frozen=True)
class Lexicon:
    """Weights of whole words and of word beginnings: the arcs of the insult automaton."""

    words: dict[str, float]
    beginnings: dict[str, float]

    def weight(self, word: str) -> float:
        """The best path through the automaton: the word itself or one of its known beginnings; 0 without one."""
        best = self.words.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                best = max(best, self.beginnings.get(word[:n], 0.0))
        return best

    def read(self, token: str) -> tuple[str, float]:
        """Tag and weight of a lower-case token between blanks (its best word, if it has several)."""
        best = (OTHER, 0.0)
        for word in _WORD.findall(token):
            if (w := self.weight(word)) > best[1]:
                best = (INSULT, w)
            elif best[0] == OTHER:
                tag = (
                    THREAT if word in THREATS else TARGET if word in TARGETS
                    else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else OTHER
                )
                best = (tag, 0.0)
        return best


def clauses(tokens: list[str]) -> Iterator[list[str]]:
    """Runs of tokens up to one that ends in ``.!?;:``."""
    start = 0
    for k, token in enumerate(tokens, 1):
        if token[-1] in _CLAUSE_END:
            yield tokens[start:k]
            start = k
    if start < len(tokens):
        yield tokens[start:]


def attack(tags: list[tuple[str, float]], tokens: Sequence | None = None) -> dict[str, float]:
    """Weight of each kind of attack in a clause: the machine reads every token, and the weights of
    different words add up along the path. A word of ``tokens`` (default: all differ) counts once for each
    kind, a threat by the word that opened it, however often it comes. A plain insult that a later target
    aims at counts as aimed with its own weight."""
    state, plain, threat = 0, (None, 0.0), None
    counted = set()
    out: dict[str, float] = {}
    for token, (tag, weight) in zip(range(len(tags)) if tokens is None else tokens, tags):
        before = state
        state, wrote = GRAMMAR.step(before, tag)
        if tag == THREAT and state != GRAMMAR.step(before, OTHER)[0]:
            threat = token  # neither negated nor reported, and no other threat waits for its target
        if wrote not in KINDS:
            continue
        if wrote == "threat":
            word, weight = threat, 1.0
        elif tag == INSULT:
            word = token
            if wrote == "plain":
                plain = token, weight
        else:
            word, weight = plain
        if (wrote, word) not in counted:
            counted.add((wrote, word))
            out[wrote] = out.get(wrote, 0.0) + weight
    return out


def document_features(text: str, lexicon: Lexicon, cache: dict[str, tuple[str, float]]) -> list[float]:
    """For each kind the weight of the document's worst clause; log(1 + x) of the attacking clauses'
    number and of their weights' sum."""
    tokens = text.lower().split()
    if len(cache) > CACHE:
        cache.clear()
    distinct = set(tokens)
    for token in distinct.difference(cache):
        cache[token] = lexicon.read(token)
    worst, n, total = dict.fromkeys(KINDS, 0.0), 0, 0.0
    if any(cache[t][0] in (INSULT, THREAT) for t in distinct):
        for clause in clauses(tokens):
            tags = [cache[t] for t in clause]
            if not any(tag in (INSULT, THREAT) for tag, _ in tags):
                continue  # the machine writes no attack
            found = attack(tags, clause)
            n += bool(found)
            total += max(found.values(), default=0.0)
            for kind, weight in found.items():
                worst[kind] = max(worst[kind], weight)
    return [*worst.values(), float(np.log1p(n)), float(np.log1p(total))]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, features: list[float]) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.bias + float(np.dot(self.weights, features)), -60, 60))))


# ---------------------------------------------------------------- learning


def arcs_of(text: str) -> Iterator[tuple[str, str]]:
    """(arc, word) of every distinct word of a text: the word itself (marked), however short, and its
    beginnings."""
    for word in set(_WORD.findall(text.lower())):
        yield "=" + word, word
        for n in PREFIXES:
            if len(word) > n:
                yield word[:n], word


#: Standard errors that an arc's log odds have to exceed zero by: the choice that labels decide between.
SURE = (2.5, 3.0, 3.5, 4.0, 4.5)
PARTS = 8


def lexicons(sample: DataFrame, support: int = 3, least: float = 0.1) -> list[list[Lexicon]]:
    """For each value of ``SURE`` a lexicon from all sampled rows, then one for each part (0, 1, …) from
    the rows outside it.

    An arc's weight is the lower confidence bound of its log odds ratio between toxic and other
    documents; arcs that are not above ``least``, or in fewer than ``support`` toxic documents, are no
    arcs; nor are beginnings that toxic documents do not use in several words (1.5 on average, and two
    in all). Only counts of arcs that pass the least sure bound come to the driver.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y, part in zip(*(batch[c].to_pylist() for c in ("text", "y", "part"))):
                low: dict[str, int] = {}
                high: dict[str, int] = {}
                words: dict[str, int] = {}
                for arc, word in arcs_of(text.decode()):
                    code = zlib.crc32(word.encode())
                    low[arc] = min(low.get(arc, code), code)
                    high[arc] = max(high.get(arc, code), code)
                    words[arc] = words.get(arc, 0) + 1
                n = len(low)
                yield pa.record_batch(
                    {"arc": pa.array(list(low), pa.string()), "low": pa.array(low.values(), pa.int64()), "high": pa.array(high.values(), pa.int64()),
                     "words": pa.array(words.values(), pa.int64()), "kind": pa.array([2 * part + y] * n, pa.int32())}
                )

    kinds = range(2 * PARTS)  # part and label
    total = {r.kind: r.n for r in sample.groupBy((2 * F.col("part") + F.col("y")).alias("kind")).agg(F.count("*").alias("n")).collect()}
    counts = (
        sample.mapInArrow(task, "arc string, low bigint, high bigint, words bigint, kind int")
        .groupBy("arc")
        .agg(*(F.count(F.when(F.col("kind") == k, 1)).alias(f"c{k}") for k in kinds), *(f(F.when(F.col("kind") % 2 == 1, F.col(c))).alias(c) for f, c in ((F.min, "low"), (F.max, "high"), (F.sum, "words"))))
        .where(F.col("arc").startswith("=") | ((F.col("low") < F.col("high")) & (F.col("words") >= 1.5 * sum((F.col(f"c{2 * k + 1}") for k in range(1, PARTS)), F.col("c1")))))
    )

    def odds(p, n, toxic: int, other: int, log, root):
        """Log odds ratio and its standard error, half a document added to each count."""
        rest = (toxic - p + 0.5), (other - n + 0.5)
        return log((p + 0.5) / rest[0]) - log((n + 0.5) / rest[1]), root(1 / (p + 0.5) + 1 / (n + 0.5) + 1 / rest[0] + 1 / rest[1])

    p, n = (sum((F.col(f"c{2 * k + y}") for k in range(1, PARTS)), F.col(f"c{y}")) for y in (1, 0))
    toxic, other = (sum(total.get(2 * k + y, 0) for k in range(PARTS)) for y in (1, 0))
    ratio, error = odds(p, n, toxic, other, F.log, F.sqrt)
    # a part's own rows can hide an arc of the others by little, hence the margin of half an error
    kept = counts.where((p >= support) & (ratio > (SURE[0] - 0.5) * error)).select("arc", *(f"c{k}" for k in kinds)).collect()
    kept.sort(key=lambda r: r.arc)
    seen = np.array([r[1:] for r in kept], float).reshape(len(kept), len(kinds))
    out = []
    for sure in SURE:
        found = []
        for left_out in (None, *range(PARTS)):
            used = [k for k in range(PARTS) if k != left_out]
            p, n = (seen[:, [2 * k + y for k in used]].sum(axis=1) for y in (1, 0))
            toxic, other = (sum(total.get(2 * k + y, 0) for k in used) for y in (1, 0))
            with np.errstate(invalid="ignore"):
                ratio, error = odds(p, n, toxic, other, np.log, np.sqrt)
            weight = np.where(p >= support, ratio - sure * error, 0.0)
            arcs = [(r.arc, float(w)) for r, w in zip(kept, weight) if w > least]
            found.append(Lexicon({a[1:]: w for a, w in arcs if a[0] == "="}, {a: w for a, w in arcs if a[0] != "="}))
        out.append(found)
    return out


def fit_output(rows: np.ndarray, labels: np.ndarray, steps: int = 3000, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression with weights of at least zero (an attack never makes a text less toxic), by
    gradient descent with momentum."""
    weights, bias = np.full(rows.shape[1], 0.5), -1.0
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return weights, float(np.log(share / (1 - share))) if len(labels) and labels.max() else -3.0
    speed, lift = np.zeros_like(weights), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights + bias, -60, 60)))
        g = p - labels
        speed = 0.9 * speed - rate * ((rows * g[:, None]).mean(axis=0) + decay * weights)
        lift = 0.9 * lift - rate * g.mean()
        weights, bias = np.maximum(weights + speed, 0.0), bias + lift
    return weights, float(bias)


def best_cut(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The cut with the best F1 (the middle between the last row above and the first below), and that F1."""
    order = np.argsort(-logits, kind="stable")
    x, y = logits[order], labels[order]
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(x[1:] < x[:-1], True)  # equal scores fall on one side
    best = int(np.argmax(np.where(ends, f1, -1)))
    return float((x[best] + x[best + 1]) / 2 if best + 1 < len(x) else x[best]), float(f1[best])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, threshold: float = 0.7) -> Model:
    """Learn the insult automaton and the weights of the kinds from at most ``max_rows`` labelled rows.

    The weights are fitted to features that each part of the sample gets from the other parts'
    lexicon, so words seen in few documents do not look better than they are. How sure an arc has to
    be is the choice with the best F1 on those features; then the bias is moved so that ``threshold``
    is the best cut.
    """
    sample = materialize(
        labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, max_rows).withColumn(
            "part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int")
        ),
        "labelled",
    )
    choices = lexicons(sample)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches: dict = {}
        for batch in batches:
            rows = []
            for text, part in zip(batch["text"].to_pylist(), batch["part"].to_pylist()):
                text = text.decode()
                rows.append([
                    x for k, (_, *outside) in enumerate(choices)
                    for x in document_features(text, outside[part], caches.setdefault((k, part), {}))
                ])
            yield pa.record_batch({"doc_id": batch["doc_id"], "x": pa.array(rows, pa.list_(pa.float64())), "y": batch["y"]})

    rows = sample.mapInArrow(task, "doc_id bigint, x array<double>, y int").collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in rows]).reshape(len(rows), len(choices), len(KINDS) + 2)
    y = np.array([r.y for r in rows], float)
    fits = [fit_output(x[:, k], y) for k in range(len(choices))]
    if not len(y) or y.min() == y.max():
        return Model(choices[0][0], *fits[0])
    cuts = [best_cut(x[:, k] @ w, y) for k, (w, _) in enumerate(fits)]
    k = max(range(len(choices)), key=lambda k: (round(cuts[k][1], 3), SURE[k]))
    return Model(choices[k][0], fits[k][0], float(np.log(threshold / (1 - threshold)) - cuts[k][0]))


def score(docs: DataFrame, model: Model, threshold: float = 0.7, rows: int = 500) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, from its whole text alone.

    Null and empty texts have no clause and get the lowest score. Repeated rows are scored alike. An
    empty table gives an empty result; other columns are ignored. One pass, no shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[str, float]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                scores = [model.score(document_features(t.decode(), model.lexicon, cache)) for t in part["text"].to_pylist()]
                yield pa.record_batch([part["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return text_rows(docs).mapInArrow(task, "doc_id bigint, score double").select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op9_grammar_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
