"""Queries over search words, postings and the index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lumenrec.functions.text import ppm, title_tokens
from lumenrec.operators import postings as post
from lumenrec.operators import reserve, segment, words
from lumenrec.operators.canonical import canonical_map, dedup_by_canonical
from lumenrec.operators.filters import drop_stale
from lumenrec.operators.publish import pack_hash
from lumenrec.plans.inputs import Inputs
from lumenrec.plans.registry import query
from lumenrec.session import materialize, new_scratch, spread
from lumenrec.sources import catalog
from lumenrec.streaming import joins

_CLEAN = r"regexp_replace({c}, '[^\x{{4e00}}-\x{{9fa5}}a-zA-Z0-9]+', '', 'g')"
_TOKENS = (
    r"regexp_extract_all(trim(regexp_replace({c}, '[^\x{{4e00}}-\x{{9fa5}}a-zA-Z0-9\s]+', '', 'g')), "
    r"'[\x{{4e00}}-\x{{9fa5}}]|[0-9]+|[a-zA-Z]+')"
)


def _suffix_sql(source: str, columns: str, title: str) -> str:
    return f"""SELECT {columns}, substr(cleaned, o + 1) AS word, tokens[p:] AS tokens, CAST(o AS BIGINT) AS "offset", 1.0 - o / length(cleaned) AS word_score
    FROM (SELECT *, coalesce(length(array_to_string(tokens[1:p - 1], '')), 0) AS o FROM (
      SELECT *, unnest(range(1, len(tokens) + 1)) AS p FROM (
        SELECT *, {_CLEAN.format(c=title)} AS cleaned, {_TOKENS.format(c=title)} AS tokens FROM {source})))"""


_TFIDF = r"""
    SELECT item_id, term, CAST(floor(tf * ln(CAST(total AS DOUBLE) / df) * 1000000.0) AS BIGINT) AS score_ppm,
      row_number() OVER (PARTITION BY item_id ORDER BY CAST(floor(tf * ln(CAST(total AS DOUBLE) / df) * 1000000.0) AS BIGINT) DESC, term) AS pos
    FROM (
      SELECT *, count(*) OVER (PARTITION BY term) AS df, (SELECT count(*) FROM short_items) AS total FROM (
        SELECT item_id, term, count(*) AS tf FROM (
          SELECT item_id, unnest(regexp_split_to_array(lower(title), '[^\p{L}\p{N}]+')) AS term FROM short_items)
        WHERE term <> '' GROUP BY 1, 2))
    QUALIFY pos <= 5"""
_TERMS = _TFIDF.replace("QUALIFY pos <= 5", "")


def _keys_sql(source: str) -> str:
    """Prefix keys when every token reads as itself in lower case."""
    return f"""SELECT DISTINCT word, tokens, key AS search_key, highlight, i, n FROM (
      SELECT word, tokens, i, n, array_to_string(tokens[1:i], '') AS highlight,
        unnest([head || last, CASE WHEN length(last) > 1 THEN head || substr(last, 1, 1) END, initials]) AS key FROM (
        SELECT *, coalesce(array_to_string(low[1:i - 1], ''), '') AS head, low[i] AS last,
          array_to_string(list_transform(low[1:i], lambda t: substr(t, 1, 1)), '') AS initials FROM (
          SELECT word, tokens, list_transform(tokens, lambda t: lower(t)) AS low, CAST(len(tokens) AS BIGINT) AS n,
            CAST(unnest(range(1, len(tokens) + 1)) AS BIGINT) AS i FROM (SELECT DISTINCT word, tokens FROM {source}))))
    WHERE key IS NOT NULL"""


_ITEM_WORDS = "CAST(item_id AS VARCHAR) AS item_id, category, risk"


def _words_sql(long_source: str, short_source: str) -> str:
    columns = "item_id, category, risk, word, tokens, word_score"
    return f"""
    SELECT {columns} FROM ({_suffix_sql(long_source, _ITEM_WORDS, "title")})
    UNION ALL SELECT {columns} FROM ({_suffix_sql("(SELECT base64(encode(code)) AS item_id, 'collection' AS category, CAST(0 AS BIGINT) AS risk, title FROM collections)", "item_id, category, risk", "title")})
    UNION ALL SELECT CAST(t.item_id AS VARCHAR), category, risk, term, {_TOKENS.format(c="term")}, 0.5
      FROM tfidf t JOIN {short_source} s ON t.item_id = s.item_id
    UNION ALL SELECT CAST(person_id AS VARCHAR), 'person', 0, {_CLEAN.format(c="name")}, {_TOKENS.format(c="name")}, 1.0 FROM people"""


_POSTINGS = """
    SELECT k.search_key, w.category, w.item_id, k.highlight,
      0.7 * CAST(w.word_score AS DOUBLE) + 0.3 * (k.i / k.n) AS score, w.risk
    FROM {words} w JOIN {keys} k ON w.word = k.word AND w.tokens = k.tokens"""

_VALID_LONG = "(SELECT * FROM items WHERE title IS NOT NULL AND status = 1 AND feature_type = 1)"

SEARCH = {
    "tfidf": _TERMS,
    "words": _words_sql(_VALID_LONG, "short_items"),
    "word_keys": _keys_sql("words"),
    "postings": _POSTINGS.format(words="words", keys="word_keys"),
    "tiered": """
      SELECT search_key, category, item_id, highlight, score, risk FROM (SELECT DISTINCT * FROM postings)
      QUALIFY (risk <= 0 AND row_number() OVER (PARTITION BY search_key, category ORDER BY CASE WHEN risk <= 0 THEN 0 ELSE 1 END, score DESC, item_id, highlight) <= 25)
        OR (risk <= 1 AND row_number() OVER (PARTITION BY search_key, category ORDER BY CASE WHEN risk <= 1 THEN 0 ELSE 1 END, score DESC, item_id, highlight) <= 25)
        OR (risk <= 2 AND row_number() OVER (PARTITION BY search_key, category ORDER BY CASE WHEN risk <= 2 THEN 0 ELSE 1 END, score DESC, item_id, highlight) <= 25)""",
}

_PPM = "CAST(floor(score * 1000000.0 + 0.5) AS BIGINT)"


def _view_sql(source: str, level: int) -> str:
    return f"""SELECT search_key, category,
      string_agg(item_id || '_' || highlight || '_' || {_PPM}, '|' ORDER BY pos) AS content FROM (
        SELECT *, row_number() OVER (PARTITION BY search_key, category ORDER BY score DESC, item_id, highlight) AS pos
        FROM {source} WHERE risk + {level} <= 2 QUALIFY pos <= 25)
      GROUP BY search_key, category"""


def _document_sql(view: str, index: str) -> str:
    return f"""SELECT search_key AS doc_id,
      '{{"index":{{"_type":"doc","_index":"{index}","_id":"' || search_key || '"}}}}' AS action,
      '{{"key":"' || search_key || '","alg":"rule0","biz":"prefix_search",' || string_agg('"' || category || '":"' || content || '"', ',' ORDER BY category) || '}}' AS source
      FROM ({view}) GROUP BY search_key"""


def recalled(inp: Inputs, best: int | None = None) -> DataFrame:
    spec = catalog.source
    return post.search_recall(
        spec("long_items").read(inp.named),
        spec("short_items").read(inp.named),
        spec("collections").read(inp.named),
        spec("people").read(inp.named),
        best=best,
    )


def score_ppm() -> Column:
    return ppm(F.col("score")).alias("score_ppm")


@query(
    "suffix_words",
    f"""SELECT item_id, word, "offset", CAST(floor(word_score * 1000000.0 + 0.5) AS BIGINT) AS score_ppm
    FROM ({_suffix_sql("items", "item_id", "title")})""",
)
def suffix_words(inp: Inputs) -> DataFrame:
    out = words.suffix_words(inp.items, ["item_id"], "title")
    return out.select("item_id", "word", "offset", ppm(F.col("word_score")).alias("score_ppm"))


@query("keywords_tfidf", "SELECT item_id, term, score_ppm, pos FROM tfidf", tfidf=_TFIDF)
def keywords_tfidf(inp: Inputs) -> DataFrame:
    return words.keywords_tfidf(inp.short_items, "item_id", "title", 5)


def _title_words(inp: Inputs) -> DataFrame:
    titles = (
        inp.table("part").select(F.col("p_name").alias("word"))
        .unionByName(inp.table("nation").select(F.col("n_name").alias("word")))
        .unionByName(inp.table("supplier").select(F.col("s_name").alias("word")))
    )
    return titles.withColumn("tokens", title_tokens(F.col("word")))


@query(
    "prefix_keys",
    "SELECT word, search_key, highlight, i, n FROM title_keys",
    title_words=f"""SELECT word, {_TOKENS.format(c="word")} AS tokens FROM (
      SELECT p_name AS word FROM part UNION ALL SELECT n_name FROM nation UNION ALL SELECT s_name FROM supplier)""",
    title_keys=_keys_sql("title_words"),
)
def prefix_keys(inp: Inputs) -> DataFrame:
    keys = words.prefix_keys(_title_words(inp))
    return keys.select("word", "search_key", "highlight", "i", "n")


# A dictionary derived from the titles: short tokens are also read backwards.
_READINGS = """
    SELECT DISTINCT token, unnest(CASE WHEN length(token) <= 4 THEN [token, reverse(token)] ELSE [token] END) AS reading
    FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part)"""


def _readings(inp: Inputs) -> DataFrame:
    tokens = inp.table("part").select(F.explode(F.split("p_name", " ")).alias("token")).distinct()
    both = F.when(F.length("token") <= 4, F.array("token", F.reverse("token"))).otherwise(F.array("token"))
    return tokens.select("token", F.explode(both).alias("reading"))


def _part_words(inp: Inputs) -> DataFrame:
    return inp.table("part").select(F.col("p_name").alias("word"), title_tokens(F.col("p_name")).alias("tokens"))


@query(
    "multi_reading_product",
    """SELECT DISTINCT p_name AS word, a.reading || ' ' || b.reading AS reading FROM part
    JOIN readings a ON a.token = split_part(p_name, ' ', 1) JOIN readings b ON b.token = split_part(p_name, ' ', 2)""",
    readings=_READINGS,
)
def multi_reading_product(inp: Inputs) -> DataFrame:
    return words.full_readings(_part_words(inp), _readings(inp))


@query(
    "prefix_keys_readings",
    """SELECT DISTINCT word, unnest([r1, CASE WHEN length(r1) > 1 THEN substr(r1, 1, 1) END]) AS search_key,
        split_part(word, ' ', 1) AS highlight, CAST(1 AS BIGINT) AS i, CAST(2 AS BIGINT) AS n FROM two WHERE length(r1) > 1
      UNION
      SELECT DISTINCT word, unnest([r1 || r2, r1 || substr(r2, 1, 1), substr(r1, 1, 1) || substr(r2, 1, 1)]),
        replace(word, ' ', ''), 2, 2 FROM two""",
    readings=_READINGS,
    two="""SELECT DISTINCT p_name AS word, a.reading AS r1, b.reading AS r2 FROM part
      JOIN readings a ON a.token = split_part(p_name, ' ', 1) JOIN readings b ON b.token = split_part(p_name, ' ', 2)""",
)
def prefix_keys_readings(inp: Inputs) -> DataFrame:
    keys = words.prefix_keys(_part_words(inp), _readings(inp))
    return keys.select("word", "search_key", "highlight", "i", "n")


@query(
    "search_recall",
    f"SELECT search_key, category, item_id, highlight, {_PPM} AS score_ppm, risk FROM postings",
    **SEARCH,
)
def search_recall(inp: Inputs) -> DataFrame:
    return recalled(inp).select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


@query(
    "search_recall_readings",
    f"""SELECT k.search_key, w.category, w.item_id, k.highlight,
      CAST(floor((0.7 * w.word_score + 0.3 * (k.i / k.n)) * 1000000.0 + 0.5) AS BIGINT) AS score_ppm, w.risk FROM (
      {_suffix_sql("(SELECT * FROM items WHERE status = 1)", _ITEM_WORDS, "title")}) w
    JOIN dictionary_keys k ON w.word = k.word AND w.tokens = k.tokens""",
    readings=_READINGS,
    title_words=_suffix_sql("(SELECT * FROM items WHERE status = 1)", _ITEM_WORDS, "title"),
    dictionary_keys="""SELECT DISTINCT word, tokens, key AS search_key, highlight, i, n FROM (
      SELECT word, tokens, i, n, array_to_string(tokens[1:i], '') AS highlight, unnest(CASE WHEN i = 1
        THEN [r1, CASE WHEN length(r1) > 1 THEN substr(r1, 1, 1) END]
        ELSE [r1 || r2, CASE WHEN length(r2) > 1 THEN r1 || substr(r2, 1, 1) END, substr(r1, 1, 1) || substr(r2, 1, 1)] END) AS key
      FROM (SELECT w.word, w.tokens, CAST(len(w.tokens) AS BIGINT) AS n, CAST(unnest(range(1, len(w.tokens) + 1)) AS BIGINT) AS i,
          coalesce(lower(a.reading), lower(w.tokens[1])) AS r1, coalesce(lower(b.reading), lower(w.tokens[2])) AS r2
        FROM (SELECT DISTINCT word, tokens FROM title_words) w
        LEFT JOIN readings a ON a.token = w.tokens[1] LEFT JOIN readings b ON b.token = w.tokens[2])) WHERE key IS NOT NULL""",
)
def search_recall_readings(inp: Inputs) -> DataFrame:
    """Recall with a dictionary: every reading of a title's words can be typed."""
    items = inp.items.where("status = 1").withColumn("item_id", F.col("item_id").cast("string"))
    found = words.suffix_words(items, ["item_id", "category", "risk"], "title")
    recall = post.recall_words(found, _readings(inp))
    return recall.select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


@query(
    "posting_lists",
    f"""SELECT search_key, category, chunk, count(*) AS n, string_agg(entry, '|' ORDER BY entry) AS postings FROM (
      SELECT search_key, category, item_id || '_' || highlight || '_' || {_PPM} || '_' || risk AS entry,
        CAST('0x' || substr(md5(item_id || ':' || highlight), 1, 8) AS BIGINT)
          % CAST(ceil(count(*) OVER (PARTITION BY search_key, category) / 100.0) AS BIGINT) AS chunk FROM postings)
    GROUP BY 1, 2, 3""",
    **SEARCH,
)
def posting_lists(inp: Inputs) -> DataFrame:
    """Whole lists; chunks of 100 show how a long list is split."""
    entry = F.concat_ws("_", "item_id", "highlight", ppm(F.col("score")).cast("string"), F.col("risk").cast("string"))
    lists = post.posting_lists(recalled(inp), entry, 100)
    return lists.select("search_key", "category", "chunk", "n", F.array_join("entries", "|").alias("postings"))


@query(
    "import_packed_postings",
    """SELECT search_key, category, item_id, highlight, CAST(floor(score * 1000000.0 + 0.5) AS DOUBLE) AS score, risk FROM postings""",
    **SEARCH,
)
def import_packed_postings(inp: Inputs) -> DataFrame:
    """The whole index packed as text, in chunks of 100 entries, and read back."""
    entry = F.concat_ws("_", "item_id", "highlight", ppm(F.col("score")).cast("string"), F.col("risk").cast("string"))
    packed = post.posting_lists(recalled(inp), entry, 100).select("search_key", "category", F.array_join("entries", "|").alias("packed"))
    return post.unpack_postings(packed, "packed")


@query(
    "tiered_top25",
    f"SELECT search_key, category, item_id, highlight, {_PPM} AS score_ppm, risk FROM tiered",
    **SEARCH,
)
def tiered_top25(inp: Inputs) -> DataFrame:
    return post.tiered_top(recalled(inp, post.LIST_SIZE)).select(
        "search_key", "category", "item_id", "highlight", score_ppm(), "risk"
    )


@query(
    "title_segments",
    """SELECT title, words FROM (
    WITH RECURSIVE names AS (SELECT DISTINCT replace(p_name, ' ', '') AS title FROM part),
    counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> '' GROUP BY word),
    weights AS (
      SELECT word, CAST(floor(ln(n / (SELECT sum(n) FROM counts WHERE length(word) <= 12)) * 1000000.0 + 0.5) AS BIGINT) AS weight
      FROM counts WHERE length(word) <= 12),
    paths AS (
      SELECT title, 0 AS place, CAST(0 AS BIGINT) AS weight, CAST([] AS VARCHAR[]) AS cut FROM names
      UNION ALL SELECT title, CAST(place + length(word) AS INTEGER), paths.weight + weights.weight, list_append(cut, word)
      FROM paths JOIN weights ON substr(title, place + 1, length(word)) = word WHERE place < length(title))
    SELECT title, array_to_string(cut, ' ') AS words FROM paths WHERE place = length(title)
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY weight DESC, len(cut), array_to_string(cut, ' ')) = 1)""",
)
def title_segments(inp: Inputs) -> DataFrame:
    """Part names without their blanks, cut by the words of all names; every name can be cut into known words."""
    names = inp.table("part").select("p_name")
    counts = names.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = segment.segment(names.select(F.replace("p_name", F.lit(" "), F.lit("")).alias("title")), counts)
    return found.select("title", F.array_join("words", " ").alias("words"))


_LATER = """SELECT * FROM postings WHERE item_id NOT LIKE '%7'"""


@query(
    "tiered_top_kept",
    f"SELECT search_key, category, item_id, highlight, {_PPM} AS score_ppm, risk FROM later_tiers",
    **{**SEARCH, "later": _LATER, "later_tiers": SEARCH["tiered"].replace("postings", "later")},
)
def tiered_top_kept(inp: Inputs) -> DataFrame:
    """The tiers after a batch of adds (ids ending in 3) and one of deletes (ids ending in 7), by the reserves."""
    whole = materialize(recalled(inp), "recalled")
    ends = lambda digit: F.col("item_id").endswith(digit)
    none = whole.limit(0)
    kept = reserve.stored(reserve.build(whole.where(~ends("3"))))
    kept, _ = reserve.change(kept, whole.where(ends("3")), none)
    kept, short = reserve.change(reserve.stored(kept), none, whole.where(ends("7")))
    kept = reserve.refill(reserve.stored(kept), short, whole.where(~ends("7")))
    return reserve.top(kept).select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


def _contents(postings: DataFrame, level: int) -> DataFrame:
    return post.join_view(post.risk_view(postings, level), ppm(F.col("score")).cast("string"))


@query("risk_view_low", _view_sql("tiered", 0), **SEARCH)
def risk_view_low(inp: Inputs) -> DataFrame:
    return _contents(post.tiered_top(recalled(inp, post.LIST_SIZE)), 0)


@query("risk_view_middle", _view_sql("tiered", 1), **SEARCH)
def risk_view_middle(inp: Inputs) -> DataFrame:
    return _contents(post.tiered_top(recalled(inp, post.LIST_SIZE)), 1)


@query("risk_view_high", _view_sql("tiered", 2), **SEARCH)
def risk_view_high(inp: Inputs) -> DataFrame:
    return _contents(post.tiered_top(recalled(inp, post.LIST_SIZE)), 2)


@query("index_documents", _document_sql(_view_sql("tiered", 0), "search_low"), **SEARCH)
def index_documents(inp: Inputs) -> DataFrame:
    return post.index_documents(_contents(post.tiered_top(recalled(inp, post.LIST_SIZE)), 0), "search_low", "prefix_search", "rule0")


@query(
    "index_bulk_lines",
    f"""SELECT unnest([action, source]) AS line FROM ({_document_sql(_view_sql("tiered", 1), "search_middle")})""",
    **SEARCH,
)
def index_bulk_lines(inp: Inputs) -> DataFrame:
    """The bulk files as an index server would read them."""
    docs = post.index_documents(
        _contents(post.tiered_top(recalled(inp, post.LIST_SIZE)), 1), "search_middle", "prefix_search", "rule0"
    )
    path = new_scratch(inp.spark, "bulk")
    post.write_bulk(docs, path)
    return inp.spark.read.text(path).select(F.col("value").alias("line"))


@query(
    "short_key_cache",
    f"""SELECT 'low:' || search_key AS key, count(*) AS n_categories,
      string_agg(category || '=' || content, ';' ORDER BY category) AS fields
    FROM ({_view_sql("tiered", 0)}) WHERE length(search_key) <= 3 GROUP BY search_key""",
    **SEARCH,
)
def short_key_cache(inp: Inputs) -> DataFrame:
    packed = pack_hash(
        post.short_keys(_contents(post.tiered_top(recalled(inp, post.LIST_SIZE)), 0)), "search_key", "category", "content", "low:"
    )
    entries = F.sort_array(F.map_entries("fields"))
    return packed.select(
        "key",
        F.size("fields").cast("bigint").alias("n_categories"),
        F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("fields"),
    )


_BATCH = {
    "batch_long": """SELECT item_id, category, title, risk FROM (
        SELECT i.*, coalesce(c.canonical_id, i.item_id) AS cid FROM items i LEFT JOIN canonical c ON i.item_id = c.item_id
        WHERE i.title IS NOT NULL AND i.status = 1 AND i.feature_type = 1)
      QUALIFY row_number() OVER (PARTITION BY cid ORDER BY item_id) = 1""",
    "batch_short": """SELECT * FROM all_short WHERE NOT (category IN ('short-fr', 'short-de')
        AND update_ts < TIMESTAMP '2001-10-01' - INTERVAL 180 DAY)""",
    "tfidf": _TERMS.replace("short_items", "batch_short"),
    "words": _words_sql("batch_long", "batch_short"),
    **{k: SEARCH[k] for k in ("word_keys", "postings", "tiered")},
}
# In dependency order: the short items come first.
_BATCH = {"all_short": "SELECT * FROM short_items", **_BATCH}


@query(
    "search_index_batch",
    " UNION ALL ".join(
        f"SELECT '{name}' AS view, doc_id, source FROM ({_document_sql(_view_sql('tiered', level), 'search_' + name)})"
        for name, level in post.RISK_LEVELS.items()
    ),
    **_BATCH,
)
def search_index_batch(inp: Inputs) -> DataFrame:
    """Sources → recall → tiered lists → three risk views → documents."""
    valid = catalog.source("long_items").read(inp.named)
    long_items = dedup_by_canonical(valid, canonical_map(inp.canonical_relation))
    short = drop_stale(inp.short_items, "update_ts", ["short-fr", "short-de"], "2001-10-01")
    postings = post.search_recall(
        long_items, short.select("item_id", "category", "title", "risk"), inp.collections, inp.people, best=post.LIST_SIZE
    )
    views = post.join_view(post.risk_views(post.tiered_top(postings)), ppm(F.col("score")).cast("string"))
    index = F.concat(F.lit("search_"), F.col("view"))
    return post.index_documents(views, index, "prefix_search", "rule0").select("view", "doc_id", "source")


# Hot items change: each is taken offline when it was last returned and put online
# when it was last kept.
_CHANGED = """
    SELECT i.item_id, i.category, i.title, i.risk, max(CASE WHEN flag = 'N' THEN ts END) AS on_ts,
      max(CASE WHEN flag = 'R' THEN ts END) AS off_ts
    FROM items i JOIN purchases p ON i.item_id = p.item_id WHERE rating >= 40 GROUP BY 1, 2, 3, 4"""

_MERGE = {
    "stored_words": _suffix_sql("(SELECT * FROM items WHERE status = 1 AND feature_type = 1)", _ITEM_WORDS, "title"),
    "stored_keys": _keys_sql("stored_words"),
    "stored": _POSTINGS.format(words="stored_words", keys="stored_keys"),
    "changed": _CHANGED,
    "changed_words": _suffix_sql("changed", _ITEM_WORDS + ", on_ts, off_ts", "title"),
    "changed_keys": _keys_sql("changed_words"),
    "changed_postings": """
      SELECT k.search_key, w.category, w.item_id, k.highlight, 0.7 * CAST(w.word_score AS DOUBLE) + 0.3 * (k.i / k.n) AS score, w.risk, on_ts, off_ts
      FROM changed_words w JOIN changed_keys k ON w.word = k.word AND w.tokens = k.tokens""",
}


_MERGED = """
  SELECT l.* FROM (
    SELECT search_key, category, item_id, highlight, max_by(score, o) AS score, max_by(risk, o) AS risk, max(on_ts) AS on_ts FROM (
      SELECT search_key, category, item_id, highlight, score, risk, NULL AS on_ts, (TIMESTAMP '1900-01-01', score) AS o FROM stored
      UNION ALL SELECT search_key, category, item_id, highlight, score, risk, on_ts, (on_ts, score) FROM changed_postings WHERE on_ts IS NOT NULL)
    GROUP BY 1, 2, 3, 4) l
  LEFT JOIN (SELECT search_key, category, item_id, max(off_ts) AS off_ts FROM changed_postings WHERE off_ts IS NOT NULL GROUP BY 1, 2, 3) d
    ON l.search_key = d.search_key AND l.category = d.category AND l.item_id = d.item_id
  WHERE d.off_ts IS NULL OR l.on_ts > d.off_ts"""


def _stored_and_changes(inp: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings of the valid items, and the timed adds and deletes of the hot items."""

    def recall(items: DataFrame, keep: list[str]) -> DataFrame:
        ids = ["item_id", "category", "risk", *keep]
        found = words.suffix_words(items.withColumn("item_id", F.col("item_id").cast("string")), ids, "title")
        return post.recall_words(found, keep=keep)

    stored = recall(spread(inp.items).where("status = 1 and feature_type = 1"), [])
    times = inp.purchases.groupBy("item_id").agg(
        F.max(F.when(F.col("flag") == "N", F.col("ts"))).alias("on_ts"),
        F.max(F.when(F.col("flag") == "R", F.col("ts"))).alias("off_ts"),
    )
    changed = recall(inp.items.where("rating >= 40").join(times, "item_id"), ["on_ts", "off_ts"])
    adds = changed.where("on_ts is not null").withColumnRenamed("on_ts", "ts").drop("off_ts")
    deletes = changed.where("off_ts is not null").withColumnRenamed("off_ts", "ts")
    return stored, adds, deletes


@query(
    "index_merge",
    f"SELECT search_key, category, item_id, highlight, {_PPM} AS score_ppm, risk FROM ({_MERGED})",
    **_MERGE,
)
def index_merge(inp: Inputs) -> DataFrame:
    merged = post.merge_index(*_stored_and_changes(inp))
    return merged.select("search_key", "category", "item_id", "highlight", score_ppm(), "risk")


@query(
    "index_update_documents",
    f"""SELECT k.search_key AS doc_id, '{{"index":{{"_type":"doc","_index":"search_low","_id":"' || k.search_key || '"}}}}' AS action,
      coalesce(d.source, '{{"key":"' || k.search_key || '","alg":"rule0","biz":"prefix_search"}}') AS source
    FROM (SELECT DISTINCT search_key FROM changed_postings) k
    LEFT JOIN ({_document_sql(_view_sql("merged", 0), "search_low")}) d ON k.search_key = d.doc_id""",
    **_MERGE,
    merged=_MERGED,
)
def index_update_documents(inp: Inputs) -> DataFrame:
    """Only the documents of keys that the changes touch."""
    keys, merged = post.touched_postings(*_stored_and_changes(inp))
    return post.update_documents(keys, _contents(merged, 0), "search_low", "prefix_search", "rule0")


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(inp: Inputs) -> DataFrame:
    return inp.table("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    "json_array_explode",
    """SELECT item_id, CAST(length(w) AS VARCHAR) || w AS code, w AS title, CAST(length(w) AS BIGINT) AS status
    FROM (SELECT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS w FROM part)""",
)
def json_array_explode(inp: Inputs) -> DataFrame:
    """Each title's words are packed into a JSON array, parsed and exploded again."""
    packed = inp.table("part").select(
        F.col("p_partkey").alias("item_id"),
        F.to_json(
            F.transform(
                F.split("p_name", " "),
                lambda w: F.struct(
                    F.concat(F.length(w).cast("string"), w).alias("code"), w.alias("title"),
                    F.length(w).cast("string").alias("status"),
                ),
            )
        ).alias("contents"),
    )
    parsed = F.from_json("contents", "array<struct<code: string, title: string, status: string>>")
    return packed.select("item_id", F.explode(parsed).alias("c")).select(
        "item_id", "c.code", "c.title", F.col("c.status").cast("bigint").alias("status")
    )


@query(
    "interval_left_join",
    """SELECT v.event_id AS view_id, p.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'view') v
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON v.user_id = p.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 6 HOUR""",
)
def interval_left_join(inp: Inputs) -> DataFrame:
    events = inp.table("events").select(F.col("user_id").alias("key"), "ts", "event_id", "event_type")
    views = events.where("event_type = 'view'").select("key", "ts", F.col("event_id").alias("view_id"))
    purchases = events.where("event_type = 'purchase'").select("key", "ts", F.col("event_id").alias("purchase_id"))
    return joins.interval_left_join_batch(views, purchases, "view_id", "purchase_id", 6)


@query(
    "source_preference",
    """
    SELECT p.item_id AS program_id, coalesce(m.item_id, p.item_id) AS item_id, coalesce(m.title, p.title) AS title, p.risk,
      CAST(CASE WHEN coalesce(f.preferred, false) THEN CASE WHEN m.vip THEN 1 ELSE -1 END
        ELSE CASE WHEN p.status = 1 THEN 1 ELSE -1 END END AS BIGINT) AS status
    FROM items p
    LEFT JOIN (SELECT c.canonical_id, i.* FROM canonical c JOIN items i ON c.item_id = i.item_id) m ON m.canonical_id = p.item_id
    LEFT JOIN (SELECT canonical_id, bool_or(vip AND status = 1) AS preferred FROM canonical c JOIN items i ON c.item_id = i.item_id GROUP BY 1) f
      ON f.canonical_id = p.item_id""",
)
def source_preference(inp: Inputs) -> DataFrame:
    provider = F.when(F.col("vip"), "premium").otherwise("basic")
    contents = canonical_map(inp.canonical_relation).join(
        inp.items.select("item_id", "category", "title", "status", provider.alias("provider")), "item_id"
    )
    return joins.prefer_source_batch(inp.items, contents, "premium").drop("category")
