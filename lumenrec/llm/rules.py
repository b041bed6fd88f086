"""Quality rules as a learned decision list, in DataFrame functions throughout.

Every document gets a row of statistics. On the labelled ones, sequential covering grows a conjunction of
thresholds that finds documents of label 0, prunes it on rows it was not grown on, takes away what it covers and
goes on. The rules come out as one ordered conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import fold_of, materialize, read

FOLDS, HELD_OUT = 3, 1
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words

_BLANKS = " \t\n\x0b\f\r"
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_distinct", "n_capitals", "n_marks", "n_digits")


def _per(count: str, size: str) -> Column:
    return F.col(count) / F.greatest(F.col(size), F.lit(1))


def features() -> dict[str, Column]:
    """The statistics that conditions compare with a threshold, by name."""
    return {
        "words": F.col("n_words").cast("double"),
        "chars per word": _per("word_chars", "n_words"),
        "symbols per word": _per("n_symbols", "n_words"),
        "marks per word": _per("n_marks", "n_words"),
        "capitals per char": _per("n_capitals", "word_chars"),
        "digits per char": _per("n_digits", "word_chars"),
        "words per line": _per("n_words", "n_lines"),
        "repeated lines": _per("n_dup_lines", "n_lines"),
        "repeated words": _per("n_repeat_words", "n_words"),
        "distinct words": _per("n_distinct", "n_words"),
    }


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text, as new columns of bigint, in one pass without a shuffle.

    Windows of 8 words are compared by a 64-bit hash, inside one document. A null text has no words; rows that
    repeat are counted each by itself; other columns are left behind.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim("text", F.lit(_BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    with_words = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(_BLANKS)) != "")
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", words.alias("words"), with_words.alias("lines")
    )
    hashed = split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    # eight look-ups by place: a slice would copy the whole array for every window
    windows = F.when(
        F.size("words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])
        ),
    )
    counted = hashed.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.length(F.concat_ws("", "words")).alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("n_capitals"),
        F.regexp_count("text", F.lit("[!?]")).alias("n_marks"),
        F.regexp_count("text", F.lit(r"\p{Nd}")).alias("n_digits"),
        windows.alias("windows"),
    )
    # Few texts repeat a window; only those sort theirs, with the places they start at.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = counted.withColumn("placed", F.when(repeats, placed)).drop("windows")
    twice = F.filter(
        "placed",
        lambda w, k: (w["h"] == F.get("placed", k - 1)["h"]) | (w["h"] == F.get("placed", k + 1)["h"]),
    )
    starts = sorted_.withColumn("starts", F.sort_array(F.transform(twice, lambda w: w["i"]))).drop("placed")
    # A start covers the words up to the next start, eight at most.
    covered = F.aggregate(
        F.transform("starts", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - i, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, n: total + n,
    )
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).select(
        "doc_id", *[F.col(c).cast("bigint").alias(c) for c in (*_BASE, *_MORE)]
    )


def base_failed() -> Column:
    """The fixed rules that come first: too few words, or too many in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a document is low quality if all conditions of one rule hold."""

    rules: tuple[tuple[Condition, ...], ...] = field(default=())

    def fired(self) -> Column:
        """Number (from 1) of the first rule that holds, 0 if none does."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            holds = reduce(Column.__and__, [c.column() for c in rule])
            out = F.when(holds, k) if out is None else out.when(holds, k)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        lines = [f"{k}. low if " + " and ".join(map(str, rule)) for k, rule in enumerate(self.rules, 1)]
        return "\n".join([*lines, f"{len(lines) + 1}. else kept"])


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the labelled training rows that pass the fixed rules, with ``low`` and the learning part.

    Rows whose crc32(doc_id) mod 3 is 1 are held out. Null labels and ids, and ids with both labels, take no part.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("labelled_id"))
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .where("least = most")
    )
    seen = stats.where((fold_of(F.col("doc_id"), FOLDS) != HELD_OUT) & ~base_failed())
    part = F.crc32(F.concat(F.lit("prune:"), F.col("doc_id").cast("string")).cast("binary")) % 3 == 0
    return seen.join(known, F.col("doc_id") == F.col("labelled_id")).select(
        (F.col("most") == 0).alias("low"), part.alias("prune"), *[c.alias(name) for name, c in features().items()]
    )


def _counts(where: Column) -> list[Column]:
    return [F.count_if(where & F.col("low")).alias("p"), F.count_if(where & ~F.col("low")).alias("n")]


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained by going from (p0, n0) to (p, n) found and wrongly found rows."""
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn(
    stats: DataFrame, labels: DataFrame, cuts: int = 24, most_rules: int = 8, most_conditions: int = 4, least_sure: float = 0.75
) -> DecisionList:
    """Grow, prune and cover until no rule is sure enough; each step is an aggregate over all training rows.

    ``cuts`` thresholds a feature are tried, quantiles of each label's training rows. A rule is taken if on the pruning part
    (a third of the rows) its share of right finds, counted as (p + 1) / (p + n + 2), is at least ``least_sure``.
    The driver gets counts per feature and threshold only. Without labels of both kinds the list is empty.
    """
    rows = materialize(labelled(stats, labels), "labelled")
    names = list(features())
    share = [(k + 1) / (cuts // 2 + 1) for k in range(cuts // 2)]
    quantiles = rows.groupBy("low").agg(
        *[F.percentile_approx(f"`{name}`", share, 10_000).alias(name) for name in names], F.count(F.lit(1)).alias("rows of it")
    ).collect()
    if len(quantiles) < 2:
        return DecisionList()
    points = {name: sorted({x for q in quantiles for x in q[name]}) for name in names}
    # From here on a feature is the number of thresholds below it.
    below = lambda name: reduce(
        Column.__add__, [(F.col(f"`{name}`") > x).cast("int") for x in points[name]]
    )
    ranked = materialize(rows.select("low", "prune", *[below(name).alias(f"f{k}") for k, name in enumerate(names)]), "ranked")

    def holds(rule: Iterable[tuple[int, bool, int]]) -> Column:
        tests = [F.col(f"f{k}") > at if above else F.col(f"f{k}") <= at for k, above, at in rule]
        return reduce(Column.__and__, tests, F.lit(True))

    def grow(left: Column) -> list[tuple[int, bool, int]]:
        rule: list[tuple[int, bool, int]] = []
        while len(rule) < most_conditions:
            values = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"f{k}").alias("at")) for k in range(len(names))]))
            counts = (
                ranked.where(left & ~F.col("prune") & holds(rule)).select("low", values.alias("v"))
                .groupBy("v.k", "v.at").agg(*_counts(F.lit(True))).collect()
            )
            by_feature: dict[int, list] = {}
            for r in sorted(counts, key=lambda r: (r.k, r.at)):
                by_feature.setdefault(r.k, []).append(r)
            p0, n0 = (sum(getattr(r, c) for r in by_feature.get(0, [])) for c in "pn")
            if not p0 or not n0:
                break
            best, choice = 0.0, None
            for k, found in by_feature.items():
                p = n = 0
                for r in found[:-1]:
                    p, n = p + r.p, n + r.n
                    for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                        if (gain := _gain(a, b, p0, n0)) > best + 1e-9:
                            best, choice = gain, (k, above, r.at)
            if choice is None:
                break
            rule.append(choice)
        return rule

    rules: list[list[tuple[int, bool, int]]] = []
    while len(rules) < most_rules:
        left = reduce(Column.__and__, [~holds(r) for r in rules], F.lit(True))
        rule = grow(left)
        if not rule:
            break
        heads = [rule[: k + 1] for k in range(len(rule))]
        found = ranked.where(left & F.col("prune")).agg(
            *[c.alias(f"{c_name}{k}") for k, head in enumerate(heads) for c_name, c in zip("pn", _counts(holds(head)))]
        ).first()
        sure = [((found[f"p{k}"] + 1) / (found[f"p{k}"] + found[f"n{k}"] + 2), -k) for k in range(len(heads))]
        value, k = max(sure)
        if value < least_sure:
            break
        rules.append(heads[-k])
    # "at most `at` thresholds lie below the value" says that the value is not above threshold number `at`
    return DecisionList(tuple(tuple(Condition(names[k], above, points[names[k]][at]) for k, above, at in r) for r in rules))


def verdicts(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the number of the rule that decided (0: none)."""
    failed = base_failed()
    rule = F.when(failed, F.lit(0)).otherwise(rules.fired())
    return stats.select("doc_id", *_BASE, failed.alias("base_failed"), (~failed & (rule == 0)).alias("kept"), rule.cast("int").alias("rule"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics and verdict of every document, by rules learned from the labelled ones.

    Null and empty texts have no words and fail the fixed rules. Repeated rows get the same verdict. An empty
    table gives an empty result; without labels only the fixed rules decide. Texts are read once.
    """
    stats = materialize(statistics(docs), "statistics")
    return verdicts(stats, learn(stats, labels))


def op12_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules learned from ``labels.quality`` outside the held-out third, applied to every document."""
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
