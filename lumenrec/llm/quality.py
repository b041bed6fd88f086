"""Quality classifier: learned hashed word and character n-gram vectors, averaged, softmax output."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.llm.common import filter_by_text, fold_of, mix, read, text_rows

FOLDS, HELD_OUT = 3, 1
#: Word values that a task remembers.
CACHE = 200_000

_BYTE = np.random.default_rng(4).integers(1, 1 << 63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Subwords:
    """How a text becomes hashed features: each word, its character n-grams, and repeated word pairs.

    Word pairs get a feature only when both words are the same: the one kind of pair that says
    something in any language.
    """

    buckets: int = 1 << 16
    shortest: int = 3
    longest: int = 5

    def of_words(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the word, bucket) of the words themselves and of their n-grams, over bytes with word
        ends marked: one pair of arrays for the words and one for each length."""
        if not words:
            return
        size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        data = _BYTE[np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8)]
        start = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        left = np.repeat(start + size, size) - np.arange(len(data))  # bytes to the end of the word
        powers = np.cumprod(np.full(int(size.max()), _BASE))
        whole = np.add.reduceat(data * powers[np.repeat(size, size) - left], start)
        yield np.arange(len(words)), self._bucket(whole, 0)
        gram = data
        for n in range(2, self.longest + 1):
            gram = gram[:-1] * _BASE + data[n - 1 :]
            if n >= self.shortest:
                at = np.flatnonzero(left[: len(gram)] >= n)
                yield word[at], self._bucket(gram[at], n)

    def _bucket(self, h: np.ndarray, n: int) -> np.ndarray:
        return (mix(h + np.uint64(n)) % np.uint64(self.buckets)).astype(np.int64)

    @property
    def repeat(self) -> int:
        """Bucket of the word pairs."""
        return self.buckets - 1

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of a whole text and how often each occurs."""
        words = text.split()
        number = Counter(words)
        times = np.fromiter(number.values(), np.float64, len(number))
        total = np.zeros(self.buckets)
        for word, bucket in self.of_words(list(number)):
            total += np.bincount(bucket, times[word], self.buckets)
        total[self.repeat] += sum(map(eq, words, words[1:]))
        kept = np.flatnonzero(total)
        return kept.astype(np.int32), total[kept].astype(np.int32)


@dataclass(frozen=True)
class Model:
    """The trained classifier. The output is a softmax of a linear map of an average, so a feature's
    whole effect is one number: its vector times the difference of the two output rows."""

    features: Subwords
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def weights(self) -> np.ndarray:
        return (self.vectors.astype(np.float64) @ (self.output[:, 1] - self.output[:, 0])).round(9)

    def learn(self, words: list[bytes], cache: dict[bytes, complex], weights: np.ndarray) -> None:
        """Sum (real) and number (imaginary part) of the weights of each word's features."""
        total, number = np.zeros(len(words)), np.zeros(len(words))
        for word, bucket in self.features.of_words(words):
            total += np.bincount(word, weights[bucket], len(words))
            number += np.bincount(word, None, len(words))
        cache.update(zip(words, (total + 1j * number).tolist()))

    def score_all(self, texts: list[bytes], cache: dict[bytes, complex], weights: np.ndarray) -> list[float]:
        """Probability of label 1 for each text. ``cache`` remembers the values of up to CACHE words."""
        offset, repeat = float(self.bias[1] - self.bias[0]), float(weights[self.features.repeat])
        split = [text.split() for text in texts]
        missing = sorted(set().union(*split).difference(cache))
        self.learn(missing, cache, weights)
        get = cache.__getitem__
        mean = np.empty(len(texts))
        for k, words in enumerate(split):
            both = sum(map(get, words), 0j)
            again = sum(map(eq, words, words[1:]))
            mean[k] = (both.real + again * repeat) / max(1.0, both.imag + again)
        if len(cache) > CACHE:
            for w in missing[max(0, CACHE - (len(cache) - len(missing))) :]:
                del cache[w]
        return (1 / (1 + np.exp(np.clip(-(mean + offset), -60, 60)))).tolist()


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    features: Subwords,
    dim: int = 8,
    epochs: int = 12,
    rate: float = 0.5,
    seed: int = 7,
) -> Model:
    """Stochastic gradient descent on the log loss, one document a step, rate falling to zero.

    Each label weighs the same in total. Without rows, or with one label only, the model gives the
    share of label 1 (with one half added to either side) to every text.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (features.buckets, dim)).astype(np.float32)
    output, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    ones = sum(y for _, _, y in rows)
    if not 0 < ones < len(rows):
        share = (ones + 0.5) / (len(rows) + 1)
        bias[1] = np.log(share / (1 - share))
        return Model(features, vectors * 0, output, bias)
    weigh = (len(rows) / (2 * (len(rows) - ones)), len(rows) / (2 * ones))
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            found, n, label = rows[k]
            lr = rate * (1 - step / steps)
            step += 1
            if not len(found):
                continue
            share = (n / n.sum()).astype(np.float32)
            hidden = share @ vectors[found]
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            p *= weigh[label]
            back = output @ p
            output -= lr * np.outer(hidden, p)
            bias -= lr * p
            # the average makes a feature's own gradient tiny; dividing by the largest share keeps its scale
            vectors[found] -= lr * np.outer(share / share.max(), back)
    return Model(features, vectors, output, bias)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, max_rows: int
) -> DataFrame:
    """(text, y) of at most ``max_rows`` labelled documents outside the held-out fold.

    The sample is the ids with the smallest hash, so it is the same in every run. Null labels, and
    ids labelled both ways, are left out. The sample table has at most ``max_rows`` rows of two
    numbers and is broadcast; texts are not shuffled.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("most"))
        .where((F.col("y") == F.col("most")) & (fold_of(F.col("doc_id"), folds) != held_out))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
        .select("doc_id", "y")
    )
    return text_rows(docs).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y")


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 2000, features: Subwords | None = None
) -> Model:
    """Train on a bounded sample of labelled rows (``max_rows``, a documented bound).

    Features are counted on the executors; the driver gets at most ``max_rows`` sparse rows of at most
    ``features.buckets`` numbers.
    """
    features = features or Subwords()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found, n = features.counts(batch["text"][k].as_py())
                yield pa.record_batch(
                    [batch["doc_id"].slice(k, 1), [found.tobytes()], [n.tobytes()], batch["y"].slice(k, 1)],
                    names=["doc_id", "found", "n", "y"],
                )

    sample = labelled_sample(docs, labels, label, FOLDS, HELD_OUT, max_rows)
    rows = sample.mapInArrow(task, "doc_id bigint, found binary, n binary, y int").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.found)))
    return train(
        [(np.frombuffer(r.found, np.int32), np.frombuffer(r.n, np.int32), r.y) for r in rows], features
    )


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, from its whole text alone.

    Null and empty texts get the score of an average of nothing (the model's offset). Repeated rows
    are scored alike. An empty table gives an empty result; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, complex] = {}
        weights = model.weights()
        for batch in batches:
            scores = []
            for start in range(0, batch.num_rows, 500):
                scores += model.score_all(batch["text"].slice(start, 500).to_pylist(), cache, weights)
            yield pa.record_batch([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = text_rows(docs).mapInArrow(task, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores at least ``threshold``, all columns kept."""

    def prepare():
        cache, weights = {}, model.weights()
        return lambda texts: np.array(model.score_all(texts, cache, weights)) >= threshold

    return filter_by_text(docs, prepare)


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
