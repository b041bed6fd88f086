"""Words of titles that are written without blanks.

Every stretch of a title that is in a dictionary is an edge of the title's word lattice, weighted by the logarithm of
the word's share; a code point that no word covers is an edge of its own, dearer than any three words. The best path
through the lattice is the segmentation. Edges are found by a join with the dictionary, the paths title by title.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import floor, log

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from lumenrec.operators.reduced import per_key

# What tasks run travels with the job; executors need the packages imported above only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Code points of the longest dictionary word that is looked up.
LONGEST = 12
#: Weights are whole millionths, so sums are exact and ties are ties everywhere.
SCALE = 1_000_000.0
#: An unknown code point weighs as much as this many words that occur once.
UNKNOWN = 3


def best_path(text: str, edges: Sequence[tuple[int, int, int]], unknown: int) -> list[str]:
    """The segmentation with the largest sum of weights; ties: fewer words, then the first in code-point order.

    ``edges`` are (start, length, weight). Paths to one place have the same letters, so a tie is settled where
    it arises.
    """
    ending: dict[int, list[tuple[int, int]]] = {}
    for start, length, weight in edges:
        ending.setdefault(start + length, []).append((start, weight))
    best: list[tuple[int, list[str]]] = [(0, [])]
    for end in range(1, len(text) + 1):
        found = [(weight, start) for start, weight in ending.get(end, [])] + [(unknown, end - 1)]
        options = ((best[start][0] + weight, [*best[start][1], text[start:end]]) for weight, start in found)
        best.append(min(options, key=lambda o: (-o[0], len(o[1]), " ".join(o[1]))))
    return best[-1][1]


def segment(titles: DataFrame, dictionary: DataFrame, title: str = "title", longest: int = LONGEST) -> DataFrame:
    """The distinct titles with ``words``, their best segmentation.

    ``dictionary`` has ``word`` and ``n`` (its count; repeated words are added up). Words longer than ``longest``
    are not looked up. A null title is left out, an empty one has no words. A title's stretches, at most its
    length times ``longest``, meet the dictionary by a join whose dictionary side has one row per word.
    """
    known = per_key(
        dictionary.where(F.col("word").isNotNull() & (F.col("word") != "") & (F.col("n") > 0)).where(F.length("word") <= longest),
        ["word"], F.sum("n").alias("n"),
    )
    total = known.agg(F.sum("n")).first()[0] or 1
    weighed = known.select("word", F.floor(F.log(F.col("n") / F.lit(total)) * SCALE + 0.5).cast("bigint").alias("weight"))
    unknown = floor(log(1 / total) * UNKNOWN * SCALE) if total > 1 else -1
    distinct = titles.where(F.col(title).isNotNull()).select(F.col(title).alias("_title")).distinct()
    starts = distinct.where("_title <> ''").select("_title", F.explode(F.sequence(F.lit(1), F.length("_title"))).alias("start"))
    room = F.least(F.lit(longest), F.length("_title") - F.col("start") + 1)
    parts = starts.select("_title", "start", F.explode(F.sequence(F.lit(1), room)).alias("length")).select(
        "_title", "start", "length", F.substring("_title", F.col("start"), F.col("length")).alias("word")
    )
    edge = F.struct((F.col("start") - 1).alias("start"), F.col("length").alias("length"), F.col("weight").alias("weight"))
    edges = parts.join(weighed, "word").groupBy("_title").agg(F.collect_list(edge).alias("edges"))
    lattices = distinct.join(edges, "_title", "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for text, found in zip(batch["_title"].to_pylist(), batch["edges"].to_pylist()):
                words.append(best_path(text, [(e["start"], e["length"], e["weight"]) for e in found or []], unknown))
            yield pa.record_batch({"title": batch["_title"], "words": pa.array(words, pa.list_(pa.string()))})

    return lattices.select("_title", "edges").mapInArrow(task, "title string, words array<string>").withColumnRenamed("title", title)


def word_suffixes(titles: DataFrame, words: DataFrame, ids: Sequence[str], title: str = "title") -> DataFrame:
    """``ids`` and, for every word of a segmented title, the text from that word on (``suffix``, ``offset``).

    ``words`` comes from ``segment``: a title is found from the start of each of its words, not of each letter.
    """
    rest = F.transform("words", lambda _, i: F.array_join(F.slice("words", i + 1, F.size("words")), ""))
    return (
        titles.select(*ids, title).join(words.withColumnRenamed(title, "_title"), F.col(title) == F.col("_title"))
        .select(*ids, F.posexplode(rest).alias("offset", "suffix"))
    )
