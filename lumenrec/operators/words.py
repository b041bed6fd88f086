"""Search words, readings and prefix keys.

A search word travels as its token array, so a key prefix always knows which part
of the word it covers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenrec.functions.text import clean_title, title_tokens, word_terms
from lumenrec.operators.lists import top_n
from lumenrec.operators.reduced import per_key
from lumenrec.session import materialize


def suffix_words(titles: DataFrame, id_cols: list[str], title: str, max_length: int | None = None) -> DataFrame:
    """The title from every token start on → id columns, ``word``, ``tokens``, ``offset``, ``word_score``.

    Every token starts a word, which runs to the end of the title; with ``max_length``
    only tokens that begin within so many characters do. Score: ``1 - offset / length``.
    """
    split = titles.select(*id_cols, clean_title(F.col(title)).alias("_clean"), title_tokens(F.col(title)).alias("_tokens"))
    starts = split.select(*id_cols, "_clean", "_tokens", F.posexplode("_tokens").alias("_at", "_token"))
    offset = F.length(F.array_join(F.slice("_tokens", 1, F.col("_at")), ""))
    placed = starts.withColumn("offset", offset.cast("bigint"))
    if max_length is not None:
        placed = placed.where(F.col("offset") < max_length)
    return placed.select(
        *id_cols,
        F.expr("substring(_clean, offset + 1)").alias("word"),
        F.slice("_tokens", F.col("_at") + 1, F.size("_tokens")).alias("tokens"),
        "offset",
        (F.lit(1.0) - F.col("offset") / F.length("_clean")).alias("word_score"),
    )


def row_terms(docs: DataFrame, document: Sequence[str], text: str) -> DataFrame:
    """``document`` columns, ``term``, ``tf``: the terms of every row's whole text, counted in the row itself."""
    ordered = docs.select(*document, F.sort_array(word_terms(F.col(text))).alias("_terms"))
    # where a run of equal terms starts
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_terms") - 1),
        lambda i: (F.size("_terms") > 0) & ((i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1))),
    )
    runs = F.transform("_starts", lambda at, k: F.struct(
        F.get("_terms", at).alias("term"), (F.coalesce(F.get("_starts", k + 1), F.size("_terms")) - at).cast("bigint").alias("tf")
    ))
    counted = ordered.withColumn("_starts", starts).select(*document, runs.alias("_runs"))
    # An inner explode would make Spark test the array for emptiness below, with all of the above put into the test.
    return counted.select(*document, F.explode_outer("_runs").alias("_run")).select(*document, "_run.term", "_run.tf").where("term is not null")


def term_counts(docs: DataFrame, document: Sequence[str], text: str) -> DataFrame:
    """``document`` columns, ``term``, ``tf`` over all rows of a document.

    A document that is one row is counted there, without a shuffle; only the documents in several rows are added up.
    """
    counts = docs.groupBy(*document).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    several = materialize(counts.select(*[F.col(c).alias(f"_several_{k}") for k, c in enumerate(document)]), "several")
    same = [F.col(c).eqNullSafe(F.col(f"_several_{k}")) for k, c in enumerate(document)]
    once = row_terms(docs.join(several, same, "left_anti"), document, text)
    more = row_terms(docs.join(several, same, "left_semi"), document, text)
    return once.unionByName(more.groupBy(*document, "term").agg(F.sum("tf").alias("tf")))


def keywords_tfidf(
    docs: DataFrame, id_col: str, text: str, n: int | None = None, keep: Sequence[str] = (),
    of_term: tuple[str, Callable[[DataFrame], DataFrame]] | None = None, first: int | None = None,
) -> DataFrame:
    """The terms of every text by ``tf * ln(N / df)`` → id, ``term``, ``score_ppm``.

    With ``n`` only the ``n`` best of a text, and their ``pos``. Terms are counted over
    the whole text; ``keep`` names further columns of the document to carry along. The document
    frequencies, one row per term, are written first: where they are small Spark sends them to the
    documents' terms, else both sides get an exchange and Spark can split a term found everywhere.
    ``of_term`` is a column and what adds it to a table of distinct terms, so it is made once a term.
    With ``first`` only the rows of the ``first`` smallest ids (in the order of texts) of each term and ``keep``
    are scored and returned; each task cuts its own rows before the shuffle, so no term is hot. The document
    frequencies are always those of all documents.
    """
    total = docs.select(F.count(F.lit(1))).scalar()
    document = [id_col, *keep]
    tf = term_counts(docs, document, text)
    df = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")
    made = []
    if of_term is not None:
        made, df = [of_term[0]], materialize(of_term[1](df), "terms")
    if first is not None:
        order = Window.partitionBy("term", *keep).orderBy(F.col(id_col).cast("string"))
        tf = tf.withColumn("_first", F.dense_rank().over(order)).where(F.col("_first") <= first).drop("_first")
    weight = F.col("tf") * F.log(total.cast("double") / F.col("df"))
    scored = tf.join(df, "term").withColumn("score_ppm", F.floor(weight * 1000000.0).cast("bigint"))
    if n is None:
        return scored.select(*document, "term", "score_ppm", *made)
    best = top_n(scored, [id_col], [F.col("score_ppm").desc(), F.col("term")], n)
    return best.select(*document, "term", "score_ppm", "pos", *made)


def token_readings(words: DataFrame, readings: DataFrame) -> DataFrame:
    """Distinct ``(word, tokens)`` → ``readings``: for each token the array of its readings.

    ``readings`` is a dictionary table ``(token, reading)``; a token that is not in
    it, or has no reading there, reads as itself in lower case. Words are made distinct first, so each title is
    transliterated once however many items carry it.
    """
    distinct = words.select("word", "tokens").distinct()
    dictionary = per_key(
        readings.where("reading is not null"), ["token"], F.sort_array(F.collect_set(F.lower("reading"))).alias("_readings")
    )
    placed = distinct.select("word", "tokens", F.posexplode("tokens").alias("_at", "token"))
    looked_up = placed.join(dictionary, "token", "left").select(
        "word", "tokens", "_at", F.coalesce("_readings", F.array(F.lower("token"))).alias("_readings")
    )
    # One group is one word: as many rows as the word has tokens.
    return looked_up.groupBy("word", "tokens").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_at", "_readings"))), lambda x: x["_readings"]
        ).alias("readings")
    )


def _whole_part(number: Column, by: Column) -> Column:
    """Integer division; a quotient of doubles is wrong beyond 2^53."""
    return ((number - number % by) / by).cast("bigint")


# Choices that one array of the reading product may hold.
_WIDTH = 4096


def reading_prefixes(read: DataFrame) -> DataFrame:
    """Every choice of readings for every leading part of a word.

    Adds ``i`` (tokens covered), ``n`` (all tokens) and ``syllables`` (one reading per
    covered token). The choices for i tokens are numbered 0 … product - 1 and each
    number is decoded digit by digit. Numbers are made step by step: starts of wide
    ranges, of ranges of ``_WIDTH`` numbers, the numbers. Rows are dealt anew between the
    steps, so no array and no input row of a stage gives more than about ``_WIDTH``
    rows, a word with very many choices is spread over tasks, and none is capped.
    """
    sized = read.withColumn("n", F.size("readings")).withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.col("n")))
    )
    part = sized.withColumn("_part", F.slice("readings", 1, F.col("i")))
    # Stride of token j: the number of choices of the tokens after it.
    strides = F.aggregate(
        F.reverse(F.transform("_part", lambda r: F.size(r).cast("bigint"))),
        F.array(F.lit(1).cast("bigint")),
        lambda acc, size: F.concat(F.array(F.element_at(acc, 1) * size), acc),
    )
    numbered = part.withColumn("_strides", strides).withColumn("_total", F.element_at("_strides", 1))
    numbered = numbered.withColumn("_choice", F.lit(0).cast("bigint"))
    for step in (_WIDTH**4, _WIDTH**3, _WIDTH**2, _WIDTH, 1):
        # From each number so far, the next ones in strides of ``step`` up to the next wider stride.
        last = F.least(F.col("_choice") + step * (_WIDTH - 1), F.col("_total") - 1)
        numbered = numbered.withColumn("_choice", F.explode(F.sequence(F.col("_choice"), last, F.lit(step).cast("bigint"))))
        if 1 < step <= _WIDTH**2:
            numbered = numbered.repartition("word", "i", "_choice")
    syllables = F.transform(
        "_part",
        lambda r, j: F.get(r, (_whole_part(F.col("_choice"), F.get("_strides", j + 1)) % F.size(r)).cast("int")),
    )
    return numbered.select(
        "word", "tokens", F.col("i").cast("bigint"), F.col("n").cast("bigint"), syllables.alias("syllables")
    )


def full_readings(words: DataFrame, readings: DataFrame) -> DataFrame:
    """Every complete reading of a word, syllables separated by a space."""
    return (
        reading_prefixes(token_readings(words, readings))
        .where("i = n")
        .select("word", F.array_join("syllables", " ").alias("reading"))
    )


def plain_prefixes(words: DataFrame) -> DataFrame:
    """Leading parts of every word row when each token reads as itself in lower case.

    Works row by row: nothing is made distinct, joined or shuffled.
    """
    return (
        words.where("size(tokens) > 0").withColumn("n", F.size("tokens").cast("bigint"))
        .withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
        .withColumn(
            "syllables", F.transform(F.slice("tokens", F.lit(1), F.col("i").cast("int")), lambda t: F.lower(t))
        )
    )


def typed_keys(parts: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Leading parts → ``carry`` columns, ``search_key``, ``highlight``, ``i``, ``n``, ``prefix_score``."""
    head = F.array_join(F.slice("syllables", F.lit(1), F.size("syllables") - 1), "")
    last = F.element_at("syllables", -1)
    whole = F.concat(head, last)
    abbreviated = F.when(F.length(last) > 1, F.concat(head, F.substring(last, 1, 1)))
    initials = F.array_join(F.transform("syllables", lambda s: F.substring(s, 1, 1)), "")
    keys = F.array_distinct(F.array_compact(F.array(whole, abbreviated, initials)))
    return parts.select(
        *carry,
        F.explode(keys).alias("search_key"),
        F.array_join(F.slice("tokens", F.lit(1), F.col("i").cast("int")), "").alias("highlight"),
        "i",
        "n",
        (F.col("i") / F.col("n")).alias("prefix_score"),
    )


def _segments(options: Column) -> Column:
    """Where the walk over a word's tokens pauses: the tokens before each pause, and all tokens.

    Between two pauses the options multiply to at most ``_WIDTH``, or there is one token only.
    """
    start = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(1).cast("bigint").alias("product"), F.lit(0).alias("at"))

    def step(acc: Column, choices: Column) -> Column:
        product = acc["product"] * F.size(choices)
        pause = (product > _WIDTH) & (acc["product"] > 1)
        return F.struct(
            F.when(pause, F.concat(acc["ends"], F.array(acc["at"]))).otherwise(acc["ends"]).alias("ends"),
            F.when(pause, F.size(choices).cast("bigint")).otherwise(product).alias("product"),
            (acc["at"] + 1).alias("at"),
        )

    return F.aggregate(options, start, step, lambda acc: F.concat(acc["ends"], F.array(acc["at"])))


def spelled(read: DataFrame, options: str) -> DataFrame:
    """What the leading tokens of a word spell → ``word, tokens, n, i, spelled``, each text once.

    ``options`` names the array of every token's options. The choices of a word share a graph whose nodes are
    (tokens covered, text so far): two ways to one node are one from there on, so the work follows the distinct
    texts and not the product of the options. A row walks as many tokens as ``_WIDTH`` choices allow; the nodes
    where it pauses are made distinct, written and dealt anew for the next round. A word with few choices is
    walked in one round without a shuffle.
    """
    word = ["word", "tokens"]
    front = read.where("size(tokens) > 0").select(
        *word, F.col(options).alias("_options"), _segments(F.col(options)).alias("_ends"), F.lit(0).alias("_at"), F.lit("").alias("spelled")
    )
    rounds = front.agg(F.max(F.size("_ends"))).first()[0] or 1
    found = None
    for number in range(rounds):
        end = F.get("_ends", F.lit(number))
        ahead = F.slice("_options", F.col("_at") + 1, end - F.col("_at"))
        levels = F.aggregate(
            ahead, F.array(F.array("spelled")),
            lambda acc, choices: F.concat(acc, F.array(F.array_distinct(F.flatten(
                F.transform(F.element_at(acc, -1), lambda text: F.transform(choices, lambda c: F.concat(text, c)))
            )))),
        )
        walked = front.select(*word, "_options", "_ends", "_at", F.posexplode(F.slice(levels, 2, F.size(levels))).alias("_step", "_texts"))
        nodes = walked.select(
            *word, "_options", "_ends", (F.col("_at") + F.col("_step") + 1).alias("i"), F.explode("_texts").alias("spelled")
        )
        got = nodes.select(*word, F.size("_options").cast("bigint").alias("n"), F.col("i").cast("bigint").alias("i"), "spelled")
        # From the second round on two rows may reach one node.
        found = got if found is None else found.unionByName(got.distinct())
        if number + 1 < rounds:
            paused = nodes.where((F.col("i") == end) & (F.size("_ends") > number + 1))
            front = materialize(paused.withColumnRenamed("i", "_at").distinct(), "spelled")
    return found


def dictionary_keys(read: DataFrame) -> DataFrame:
    """The keys of words with ``readings``, from the shared graph of each word → as ``prefix_keys``."""
    first = lambda reading: F.substring(reading, 1, 1)
    known = materialize(
        read.withColumn("_initials", F.transform("readings", lambda r: F.array_distinct(F.transform(r, first)))), "readings"
    )
    whole = spelled(known, "readings")
    initials = spelled(known, "_initials")
    # A last syllable of more than one letter may be begun only: the text before it and its first letter.
    begun = known.where("size(tokens) > 0").select(
        "word", "tokens",
        F.posexplode(F.transform("readings", lambda r: F.array_distinct(F.transform(F.filter(r, lambda x: F.length(x) > 1), first)))).alias("_at", "_letters"),
    ).where("size(_letters) > 0")
    none = known.where("size(tokens) > 0").select(
        "word", "tokens", F.size("tokens").cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("i"), F.lit("").alias("spelled")
    )
    heads = whole.where("i < n").unionByName(none)
    abbreviated = (
        heads.join(begun.withColumnRenamed("_at", "i"), ["word", "tokens", "i"])
        .select("word", "tokens", "n", (F.col("i") + 1).alias("i"), "spelled", F.explode("_letters").alias("_letter"))
        .withColumn("spelled", F.concat("spelled", "_letter")).drop("_letter")
    )
    keys = whole.unionByName(abbreviated).unionByName(initials).distinct()
    highlight = F.array_join(F.slice("tokens", F.lit(1), F.col("i").cast("int")), "")
    return keys.select(
        "word", "tokens", F.col("spelled").alias("search_key"), highlight.alias("highlight"), "i", "n",
        (F.col("i") / F.col("n")).alias("prefix_score"),
    )


def prefix_keys(words: DataFrame, readings: DataFrame | None = None) -> DataFrame:
    """Keys a user may type on the way to each distinct word → ``word, tokens`` and the key columns.

    For each leading part p1…pi: all of it, all but the last syllable plus that
    syllable's first letter, and the initials alone. The score is ``i / n``; the
    highlight is the covered tokens.
    """
    word = ["word", "tokens"]
    if readings is None:
        return typed_keys(plain_prefixes(words.select(*word).distinct()), word)
    return dictionary_keys(token_readings(words.where("size(tokens) > 0"), readings))
