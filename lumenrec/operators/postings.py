"""Postings: recall, tiered top lists, risk views, index documents, incremental merge.

A posting is a row ``(search_key, category, item_id, highlight, score, risk)``. It
stays a row until the list is cut to 25, because one- to three-letter keys collect a
large share of all postings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumenrec.functions.text import base64_text, clean_title, title_tokens
from lumenrec.operators.lists import fold_chunks, top_n
from lumenrec.operators.reduced import distinct_keys, per_key
from lumenrec.operators.words import keywords_tfidf, plain_prefixes, prefix_keys, suffix_words, typed_keys
from lumenrec.session import materialize

# List length, weights of the two match scores, short-title word score,
# longest cached key, documents per bulk file, caller levels of the three risk views.
LIST_SIZE = 25
WORD_WEIGHT, PREFIX_WEIGHT = 0.7, 0.3
SHORT_TITLE_SCORE = 0.5
CACHE_KEY_LENGTH = 3
BULK_SIZE = 5000
COLLECTION_CATEGORY, PERSON_CATEGORY = "collection", "person"
RISK_LEVELS = {"low": 0, "middle": 1, "high": 2}

POSTING = ["search_key", "category", "item_id", "highlight", "score", "risk"]
_WORD = ["item_id", "category", "risk", "word", "tokens", "word_score"]


def search_words(
    long_items: DataFrame,
    short_items: DataFrame,
    collections: DataFrame,
    people: DataFrame,
    keywords: int | None = None,
) -> DataFrame:
    """Search words of the four sources with their word scores.

    Short items are found by all their terms, or by the ``keywords`` best of them.
    """
    terms = keywords_tfidf(short_items, "item_id", "title", keywords, ["category", "risk"])
    short_words = keyword_words(
        terms.withColumnRenamed("term", "word").withColumn("item_id", F.col("item_id").cast("string"))
    )
    return title_words(long_items, collections, people).unionByName(short_words.select(*_WORD))


def title_words(long_items: DataFrame, collections: DataFrame, people: DataFrame) -> DataFrame:
    """Search words of the sources that are found by their titles or names."""
    ids = ["item_id", "category", "risk"]
    long_words = suffix_words(long_items.withColumn("item_id", F.col("item_id").cast("string")), ids, "title")
    subjects = collections.select(
        base64_text(F.col("code")).alias("item_id"),
        F.lit(COLLECTION_CATEGORY).alias("category"),
        F.lit(0).cast("bigint").alias("risk"),
        "title",
    )
    subject_words = suffix_words(subjects, ids, "title")
    names = people.select(
        F.col("person_id").cast("string").alias("item_id"),
        F.lit(PERSON_CATEGORY).alias("category"),
        F.lit(0).cast("bigint").alias("risk"),
        "name",
    )
    return (
        long_words.select(*_WORD)
        .unionByName(subject_words.select(*_WORD)).unionByName(name_words(names, ids, "name").select(*_WORD))
    )


def keyword_words(terms: DataFrame) -> DataFrame:
    """Keywords of short titles as search words."""
    return terms.withColumn("tokens", title_tokens(F.col("word"))).withColumn(
        "word_score", F.lit(SHORT_TITLE_SCORE)
    )


def name_words(names: DataFrame, id_cols: Sequence[str], name: str) -> DataFrame:
    """A person's whole name as the only search word, score 1."""
    return names.select(
        *id_cols,
        clean_title(F.col(name)).alias("word"),
        title_tokens(F.col(name)).alias("tokens"),
        F.lit(1.0).alias("word_score"),
    )


def recall_words(
    words: DataFrame, readings: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Words → postings: every prefix key of every word, score ``0.7 word + 0.3 prefix``.

    ``keep`` names further word columns to carry along. With a dictionary each
    distinct word is transliterated once and joined back; without one the keys are
    made row by row.
    """
    carry = ["category", "item_id", "risk", "word_score", *keep]
    if readings is None:
        keyed = typed_keys(plain_prefixes(words), carry)
    else:
        keys = prefix_keys(words, readings).select("word", "tokens", "search_key", "highlight", "prefix_score")
        keyed = words.join(keys, ["word", "tokens"])
    score = WORD_WEIGHT * F.col("word_score") + PREFIX_WEIGHT * F.col("prefix_score")
    return keyed.select("search_key", "category", "item_id", "highlight", score.alias("score"), "risk", *keep)


def search_recall(
    long_items: DataFrame,
    short_items: DataFrame,
    collections: DataFrame,
    people: DataFrame,
    readings: DataFrame | None = None,
    keywords: int | None = None,
    best: int | None = None,
) -> DataFrame:
    """Postings of the four sources; keys that words read as themselves are made once a distinct term.

    With ``best`` postings may be missing that are not among the ``best`` first of their (key, category, risk): enough
    for ``tiered_top`` of that size, and terms of very many texts are cut before their keys are made.
    """
    if readings is not None:
        return recall_words(search_words(long_items, short_items, collections, people, keywords), readings)
    titled = recall_words(title_words(long_items, collections, people))
    return titled.unionByName(recall_terms(short_items, keywords, best))


def term_keys(terms: DataFrame) -> DataFrame:
    """``terms`` with the array ``_keys`` of the prefix keys of each ``term``; null for one without tokens."""
    words = terms.select(F.col("term").alias("word"), title_tokens(F.col("term")).alias("tokens"))
    keys = typed_keys(plain_prefixes(words), ["word"])
    folded = keys.groupBy("word").agg(F.collect_list(F.struct("search_key", "highlight", "prefix_score")).alias("_keys"))
    return terms.join(folded, F.col("term") == F.col("word"), "left").drop("word")


def recall_terms(short_items: DataFrame, keywords: int | None = None, best: int | None = None) -> DataFrame:
    """Postings of short items, as ``recall_words`` gives them for their terms.

    Texts share their terms, so the keys are made once a term and joined back. Items of one category and risk have a
    term's keys with the same highlights and scores, so in each list they stand in the order of their ids, and with
    ``best`` only the term's ``best`` smallest ids get its keys. Where items have their own ``keywords``, nothing is cut.
    """
    terms = keywords_tfidf(
        short_items, "item_id", "title", keywords, ["category", "risk"], ("_keys", term_keys), best if keywords is None else None
    )
    keyed = terms.select(F.col("item_id").cast("string").alias("item_id"), "category", "risk", F.explode("_keys").alias("_key"))
    score = WORD_WEIGHT * F.lit(SHORT_TITLE_SCORE) + PREFIX_WEIGHT * F.col("_key.prefix_score")
    return keyed.select("_key.search_key", "category", "item_id", "_key.highlight", score.alias("score"), "risk")


def posting_lists(postings: DataFrame, entry: Column, chunk_rows: int = 10000) -> DataFrame:
    """Postings folded per (key, category), long lists in several chunks."""
    # The chunk sizes and the rows both come from the postings, which are recalled once.
    recalled = materialize(postings, "postings")
    return fold_chunks(
        recalled, ["search_key", "category"], ["item_id", "highlight"], entry, chunk_rows
    )


def unpack_postings(packed: DataFrame, column: str, separator: str = "[|]") -> DataFrame:
    """Packed lists of another index (``item_highlight_score_risk`` entries) → posting rows.

    ``packed`` has ``search_key``, ``category`` and the text ``column``, in one row or in
    several per list. An item id may hold the inner separator, the other parts do not.
    Entries that are not whole are left out.
    """
    entry = packed.select("search_key", "category", F.explode(F.split(column, separator)).alias("_entry"))
    part = lambda k: F.regexp_extract("_entry", "^(.*)_([^_]*)_([^_]+)_([^_]+)$", k)
    return entry.select(
        "search_key", "category", part(1).alias("item_id"), part(2).alias("highlight"),
        part(3).try_cast("double").alias("score"), part(4).try_cast("bigint").alias("risk"),
    ).where("item_id <> '' and score is not null and risk is not null")


def _best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("item_id"), F.col("highlight")]


def tiered_top(postings: DataFrame, size: int = LIST_SIZE) -> DataFrame:
    """Per (key, category) the top ``size`` with risk 0, with risk ≤ 1 and with risk ≤ 2.

    A posting with an empty highlight is a delete marker and always stays. A posting
    in some tier's top is also in the top of its own risk, so lists are first cut per
    exact risk (partial group limit) and the three tiers are counted over what is left.
    Each delete marker is a window partition of its own: any number of them passes
    both steps, in the same scan, without gathering at their key.
    """
    marker = F.when(F.col("highlight") == "", F.struct("item_id", "score"))
    rows = postings.select(*POSTING).where("highlight = '' or risk <= 2").withColumn("_marker", marker)
    # Equal postings share a dense rank, so copies are dropped from the short lists only.
    own_list = Window.partitionBy("search_key", "category", "risk", "_marker").orderBy(*_best_first())
    short = rows.withColumn("_own", F.dense_rank().over(own_list)).where(F.col("_own") <= size).drop("_own").distinct()
    order = Window.partitionBy("search_key", "category", "_marker").orderBy(*_best_first())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = F.col("_marker").isNotNull()
    for level in (0, 1, 2):
        within = F.count_if(F.col("risk") <= level).over(so_far)
        kept = kept | ((F.col("risk") <= level) & (within <= size))
    return short.withColumn("_kept", kept).where("_kept").select(*POSTING)


def risk_view(postings: DataFrame, level: int, size: int = LIST_SIZE) -> DataFrame:
    """The postings a caller of the given risk level may see: ``risk + level <= 2``, top ``size``."""
    allowed = postings.where((F.col("highlight") != "") & (F.col("risk") + level <= 2))
    return top_n(allowed, ["search_key", "category"], _best_first(), size)


def risk_views(postings: DataFrame, size: int = LIST_SIZE) -> DataFrame:
    """The views of all caller levels in one pass, told apart by ``view``."""
    levels = F.array(*[F.struct(F.lit(name).alias("view"), F.lit(level).alias("level")) for name, level in RISK_LEVELS.items()])
    allowed = F.filter(levels, lambda x: F.col("risk") + x["level"] <= 2)
    rows = postings.where("highlight <> ''").select(*POSTING, F.explode(allowed).alias("_x")).select(*POSTING, "_x.view")
    return top_n(rows, ["view", "search_key", "category"], _best_first(), size)


def join_view(view: DataFrame, score_text: Column) -> DataFrame:
    """One ``item_highlight_score|…`` string per (key, category) of a risk view, or of each view."""
    which = [c for c in ("view",) if c in view.columns]
    entry = F.concat_ws("_", F.col("item_id"), F.col("highlight"), score_text)
    ordered = F.sort_array(F.collect_list(F.struct("pos", entry.alias("entry"))))
    content = F.array_join(F.transform(ordered, lambda x: x["entry"]), "|")
    return view.groupBy(*which, "search_key", "category").agg(content.alias("content"))


_HEAD = ("key", "alg", "biz")


def _head(biz: str, alg: str) -> Column:
    return F.create_map(
        F.lit("key"), F.col("search_key"), F.lit("alg"), F.lit(alg), F.lit("biz"), F.lit(biz)
    )


def _action(index: str | Column) -> Column:
    name = F.lit(index) if isinstance(index, str) else index
    target = F.struct(
        F.lit("doc").alias("_type"), name.alias("_index"), F.col("search_key").alias("_id")
    )
    return F.to_json(F.struct(target.alias("index")))


def index_documents(contents: DataFrame, index: str | Column, biz: str, alg: str) -> DataFrame:
    """One document per key (and view) with a field per category, plus the bulk action line."""
    which = [c for c in ("view",) if c in contents.columns]
    category = F.col("category")
    # A category named like a field of the head is told apart by a leading underscore.
    name = F.when(category.isin(*_HEAD), F.concat(F.lit("_"), category)).otherwise(category)
    fields = F.map_from_entries(
        F.sort_array(F.collect_list(F.struct(name.alias("key"), F.col("content").alias("value"))))
    )
    return contents.groupBy(*which, "search_key").agg(fields.alias("_fields")).select(
        *which, F.col("search_key").alias("doc_id"),
        _action(index).alias("action"),
        F.to_json(F.map_concat(_head(biz, alg), F.col("_fields"))).alias("source"),
    )


def update_documents(
    keys: DataFrame, contents: DataFrame, index: str, biz: str, alg: str
) -> DataFrame:
    """Documents of the given keys only; a key without contents gets an empty document."""
    documents = index_documents(contents, index, biz, alg).select(F.col("doc_id").alias("search_key"), "source")
    return keys.select("search_key").distinct().join(documents, "search_key", "left").select(
        F.col("search_key").alias("doc_id"),
        _action(index).alias("action"),
        F.coalesce("source", F.to_json(_head(biz, alg))).alias("source"),
    )


def write_bulk(documents: DataFrame, path: str, batch: int = BULK_SIZE) -> None:
    """Write action and source lines in turn, at most ``batch`` documents per file."""
    lines = documents.select(F.concat_ws("\n", "action", "source").alias("value"))
    lines.write.option("maxRecordsPerFile", batch).text(path)


def short_keys(contents: DataFrame, length: int = CACHE_KEY_LENGTH) -> DataFrame:
    """The part of the index that also goes to the key-value cache."""
    return contents.where(F.length("search_key") <= length)


def merge_index(stored: DataFrame, adds: DataFrame, deletes: DataFrame) -> DataFrame:
    """Apply timed adds and deletes to stored postings; the result keeps the times.

    ``adds`` has the posting columns and ``ts``; ``deletes`` has ``search_key, category,
    item_id, ts``; ``stored`` has the posting columns and, from an earlier merge, ``ts``
    (null or missing for postings of unknown age, which every change outdates). The
    latest add of a posting wins; a delete removes the item's postings of its key and
    category added up to its own time. Adds to a new key or category create it, deletes
    of absent items do nothing, and a replayed batch changes nothing.
    """
    identity = ["search_key", "category", "item_id", "highlight"]
    kind = adds.schema["ts"].dataType
    when = F.col("ts") if "ts" in stored.columns else F.lit(None)
    # As the first struct field null sorts lowest.
    old = stored.select(*POSTING, when.cast(kind).alias("ts"))
    # Dealt before they are aggregated: the largest of structs is found by sorting, which would else be done by the
    # task that makes the postings. The join goes on in the same partitions, where few postings share an item.
    dealt = old.unionByName(adds.select(*POSTING, "ts")).repartition(*identity[:3])
    latest = dealt.groupBy(*identity).agg(F.max(F.struct("ts", "score", "risk")).alias("_last"))
    live = latest.select(*identity, "_last.score", "_last.risk", "_last.ts")
    gone = per_key(deletes, ["search_key", "category", "item_id"], F.max("ts").alias("_gone"))
    survives = F.col("_gone").isNull() | (F.col("ts") > F.col("_gone"))
    return (
        live.join(gone, ["search_key", "category", "item_id"], "left")
        .where(survives).select(*POSTING, "ts")
    )


def touched_postings(stored: DataFrame, adds: DataFrame, deletes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(keys, merged postings of these keys)`` for the keys that a batch of changes touches.

    Only these keys' documents need to be sent out, so the rest of the stored index is
    dropped by a semi join before the merge.
    """
    keys = distinct_keys(adds.select("search_key").unionByName(deletes.select("search_key")), "search_key")
    return keys, merge_index(stored.join(keys, "search_key", "left_semi"), adds, deletes)
