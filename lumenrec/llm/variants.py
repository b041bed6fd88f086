"""Spelling variants: words one edit apart, found in the sorted rotations of all words.

A word gets an end mark and is rotated to every place. Two words that differ in one replaced letter have rotations
that end in that letter and are equal before it; if a letter is deleted, the shorter word's whole rotation is what
stands before it. So the words near each other are the rows of one prefix range of the sorted rotations, and such a
range has at most one row for each letter and one for the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenrec.llm.common import materialize, read

LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
DROP_EVERY = 199
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "[a-zÀ-ÿ]+"
END = "$"
#: Rotations with more characters are held as a number of 127 bits.
LONG = 64
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1234567890ABCDEF1357
#: Rows of rotations in a batch.
BATCH = 20_000


def words_of(docs: DataFrame, drop_every: int = DROP_EVERY) -> DataFrame:
    """One row (word) per run of letters of every whole text, A-Z lower-cased, with the planted slips.

    A run whose crc32 with its document is divisible by ``drop_every`` loses one letter. Null texts have no runs,
    a null doc_id counts as empty text, and repeated rows count each.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))).alias("run")
    )
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run") + 1).cast("int")
    return hashed.select(F.when(F.col("h") % drop_every == 0, F.overlay("run", F.lit(""), at, F.lit(1))).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(id, word, n): words long and frequent enough, counted over all rows, numbered in code-point order."""
    counts = words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # Sorted partitions follow each other, so the numbers rise with the words.
    ordered = materialize(counts.where(F.col("n") >= least_count), "words").orderBy("word")
    return materialize(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def rotations_of(word: str) -> Iterator[tuple[str, str, bool]]:
    """(rotation without the edited letter, that letter, whether its deletion counts), then the whole rotations.

    Of equal letters in a row only the first counts as deleted, as all give the same shorter word. Long rotations
    become a number: the polynomial of the part before the end mark and of the part after it.
    """
    n = len(word)
    if n < LONG:  # the rotations of words on both sides of the limit have to agree: it is one on the rotation's length
        for i, c in enumerate(word):
            yield word[i + 1 :] + END + word[:i], c, i == 0 or word[i - 1] != c
        for i in range(n + 1):
            yield word[i:] + END + word[:i], "", False
        return
    ahead = [0] * (n + 1)  # number of word[:i]
    behind = [0] * (n + 1)  # number of word[i:]
    power = [1] * (n + 1)
    for i, c in enumerate(word):
        ahead[i + 1] = (ahead[i] * _BASE + ord(c)) % _PRIME
        power[i + 1] = power[i] * _BASE % _PRIME
    for i in range(n - 1, -1, -1):
        behind[i] = (behind[i + 1] + ord(word[i]) * power[n - 1 - i]) % _PRIME
    for i, c in enumerate(word):
        # a rotation of n characters, mark included
        key = word[i + 1 :] + END + word[:i] if n <= LONG else f"{n}:{n - 1 - i}:{behind[i + 1]:x}:{ahead[i]:x}"
        yield key, c, i == 0 or word[i - 1] != c
    for i in range(n + 1):
        yield f"{n + 1}:{n - i}:{behind[i]:x}:{ahead[i]:x}", "", False


def rotate(words: DataFrame) -> DataFrame:
    """(prefix, edited, deletes, id, n): all rotations of all words, a batch at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            names = ["prefix", "edited", "deletes", "id", "n"]
            types = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for part in batches:
            for i, word, n in zip(*(part[c].to_pylist() for c in ("id", "word", "n"))):
                for rotation in rotations_of(word):
                    rows.append((*rotation, i, n))
                    if len(rows) == BATCH:
                        yield batch()
                        rows.clear()
        if rows:
            yield batch()

    return words.select("id", "word", "n").mapInArrow(task, "prefix string, edited string, deletes boolean, id bigint, n bigint")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best_id, best_n): how many words of the vocabulary are one edit away, and the most frequent.

    Rotations are sorted by prefix and edited letter; each range of one prefix is scanned with what stands before
    and after a row. No pair of words is formed.
    """
    scan = Window.partitionBy("prefix").orderBy("edited")
    whole = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = scan.rowsBetween(Window.unboundedPreceding, -1)
    after = scan.rowsBetween(1, Window.unboundedFollowing)
    is_whole = F.col("edited") == ""
    entry = F.struct((-F.col("n")).alias("less"), F.col("id").alias("id"))
    replaced, deleted = F.when(~is_whole, entry), F.when(F.col("deletes"), entry)
    seen = (
        rotate(words)
        .withColumn("rows", F.count(F.lit(1)).over(whole))
        .where("rows > 1")
        .select(
            "id", is_whole.alias("is_whole"), "deletes",
            F.count_if(~is_whole).over(whole).alias("edits"), F.count_if("deletes").over(whole).alias("longer"),
            F.min(deleted).over(whole).alias("best_longer"), F.min(F.when(is_whole, entry)).over(whole).alias("shorter"),
            F.least(F.min(replaced).over(before), F.min(replaced).over(after)).alias("best_replaced"),
        )
    )
    shorter = F.when(F.col("deletes"), F.col("shorter"))
    near = seen.select(
        "id",
        F.when(F.col("is_whole"), F.col("longer")).otherwise(F.col("edits") - 1 + shorter.isNotNull().cast("int")).alias("near"),
        F.when(F.col("is_whole"), F.col("best_longer")).otherwise(F.least("best_replaced", shorter)).alias("best"),
    )
    found = near.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return found.select("id", "n_near", F.col("best.id").alias("best_id"), (-F.col("best.less")).alias("best_n"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(id, form) → (id, root): follow forms to the last. Counts at least multiply along a path, so there is no
    circle and a path is short; each round doubles the steps and ends in a written table."""
    paths = materialize(forms.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")), "paths")
    while not paths.where("moved").isEmpty():
        up = paths.select(F.col("id").alias("up"), F.col("root").alias("higher"))
        paths = materialize(
            paths.join(up, paths.root == up.up, "left").select("id", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")),
            "paths",
        )
    return paths.select("id", "root")


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """A vocabulary (id, word, n), ids in the order of the words → word, form, root, n, n_near, form_n.

    A word's form is the most frequent word one edit away (ties: the first in code-point order) if it is at least
    ``times`` as frequent; its root is the end of the path of forms, the word itself if it has none. An empty
    vocabulary gives an empty result.
    """
    near = materialize(near_words(words), "near")
    best = words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best_n") >= times * F.col("n"), F.col("best_id")).alias("form"),
    )
    best = materialize(best, "best")
    roots = roots_of(best.where(F.col("form").isNotNull()))
    named = words.select(F.col("id").alias("of"), F.col("word").alias("name"), F.col("n").alias("times"))
    form = named.select(F.col("of").alias("form"), F.col("name").alias("form_word"), F.col("times").alias("form_n"))
    root = named.select(F.col("of").alias("root"), F.col("name").alias("root_word"))
    return (
        best.join(roots, "id", "left").join(form, "form", "left").join(root, "root", "left")
        .select(
            "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
        )
    )


def op13_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, each with its more frequent spelling."""
    return group_variants(vocabulary(words_of(read(spark, sf_dir, "documents"))))


OP13_SQL = """
WITH steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
named AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM named, steps),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS (
  SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM v, unnest(range(length(word))) AS u(i)),
pairs AS (
  SELECT x.word AS word, y.word AS other, y.n AS other_n FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, v.word, v.n FROM gaps g JOIN v ON v.word = g.a || g.b
  UNION SELECT v.word, g.word, g.n FROM gaps g JOIN v ON v.word = g.a || g.b),
near AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
best AS (SELECT word, other, other_n FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
         CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
paths AS (
  WITH RECURSIVE walk AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NOT NULL)
  SELECT word, root FROM walk WHERE root IN (SELECT word FROM forms WHERE form IS NULL))
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN paths USING (word)
"""
