"""Queries over scans, snapshots, filters, canonical ids and activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lumenrec.functions import dates
from lumenrec.functions.text import base64_text, clean_keep_space, clean_title, has_cjk, ppm, unbase64_text
from lumenrec.operators import activity, canonical, collections, exposures, filters, similar
from lumenrec.plans.inputs import Inputs
from lumenrec.plans.registry import query
from lumenrec.session import materialize, new_scratch
from lumenrec.sources import catalog, history, snapshots, vectors


def _joined(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")


@query("scan_filtered", "SELECT item_id, category, title FROM items WHERE status = 1")
def scan_filtered(inp: Inputs) -> DataFrame:
    return catalog.scan(inp.items, ["item_id", "category", "title"], "status = 1")


_VALID = "title IS NOT NULL AND status = 1 AND feature_type = 1"


@query(
    "source_catalog",
    f"""
    SELECT 'long_items' AS source, count(*) AS n_rows FROM items WHERE {_VALID}
    UNION ALL SELECT 'short_items', count(*) FROM short_items WHERE title IS NOT NULL
    UNION ALL SELECT 'collections', count(*) FROM collections
    UNION ALL SELECT 'people', count(*) FROM people
    UNION ALL SELECT 'collection_links', count(*) FROM collection_links
    UNION ALL SELECT 'editor_picks', count(*) FROM items WHERE rating >= 48 AND status = 1
    UNION ALL SELECT 'available_' || lower(category), count(*) FROM items WHERE {_VALID} GROUP BY category""",
)
def source_catalog(inp: Inputs) -> DataFrame:
    return catalog.catalog_counts(inp.named)


@query("collection_links", "SELECT item_id, code, category FROM collection_links")
def collection_links(inp: Inputs) -> DataFrame:
    return catalog.source("collection_links").read(inp.named)


@query(
    "scan_sql",
    """SELECT c_custkey AS user_id, n_regionkey AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal > 0 AND n_regionkey > 0""",
)
def scan_sql(inp: Inputs) -> DataFrame:
    text = """
        select c.c_custkey as user_id, n.n_regionkey as region
        from {users} c left join {places} n on c.c_nationkey = n.n_nationkey
        where c.c_acctbal > 0 and n.n_regionkey > 0"""
    return catalog.sql_scan(inp.spark, text, users=inp.table("customer"), places=inp.table("nation"))


@query("available_items", f"SELECT item_id, category FROM items WHERE {_VALID} AND category = 'PROMO'")
def available_items(inp: Inputs) -> DataFrame:
    return catalog.available_items(inp.items, "PROMO")


@query("snapshot_roundtrip", "SELECT item_id, category, title, rating FROM items")
def snapshot_roundtrip(inp: Inputs) -> DataFrame:
    base = new_scratch(inp.spark, "snapshots")
    rows = inp.items.select("item_id", "category", "title", "rating")
    snapshots.write_snapshot(rows, base, "test", "demo", "items")
    return snapshots.read_snapshot(inp.spark, base, "test", "demo", "items")


@query("snapshot_fallback", "SELECT item_id, category FROM items WHERE status = 1")
def snapshot_fallback(inp: Inputs) -> DataFrame:
    """Two versions are written, the latest one is lost, the backup is read."""
    base = new_scratch(inp.spark, "snapshots")
    rows = inp.items.select("item_id", "category", "status")
    snapshots.write_snapshot(rows.where("status = 1").drop("status"), base, "test", "demo", "valid")
    lost = snapshots.write_snapshot(rows.drop("status"), base, "test", "demo", "valid")
    snapshots.delete_path(inp.spark, lost)
    return snapshots.read_newest(inp.spark, base, "test", "demo", "valid")


@query(
    "scan_last_n_days",
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE CAST(ts AS DATE) > DATE '2024-01-28' - INTERVAL 14 DAY AND CAST(ts AS DATE) <= DATE '2024-01-28'""",
)
def scan_last_n_days(inp: Inputs) -> DataFrame:
    path = new_scratch(inp.spark, "events-by-day")
    history.write_by_day(inp.table("events").select("event_id", "user_id", "event_type", "ts"), "ts", path)
    return history.read_last_days(inp.spark, path, "20240128", 14).select("event_id", "user_id", "event_type")


@query(
    "scan_categories",
    """
    SELECT event_id, user_id, event_type AS category FROM events
    WHERE event_type IN ('view', 'purchase') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-20'""",
)
def scan_categories(inp: Inputs) -> DataFrame:
    """A dated layout with a category level; both levels prune directories."""
    path = new_scratch(inp.spark, "events-by-day-and-category")
    rows = inp.table("events").select("event_id", "user_id", F.col("event_type").alias("category"), "ts")
    history.write_by_day(rows, "ts", path, ["category"])
    stored = history.read_last_days(inp.spark, path, "20240120", 10, ["view", "purchase"])
    return stored.select("event_id", "user_id", "category")


@query(
    "parse_vector_text",
    """
    SELECT CAST(vec_id AS VARCHAR) AS item_id, CAST(len(embedding) AS BIGINT) AS dim,
      CAST(floor(CAST(embedding[1] AS DOUBLE) * 1000000.0 + 0.5) AS BIGINT) AS first_ppm,
      CAST(floor(CAST(embedding[-1] AS DOUBLE) * 1000000.0 + 0.5) AS BIGINT) AS last_ppm FROM embeddings""",
)
def parse_vector_text(inp: Inputs) -> DataFrame:
    """The vectors are written as ``id,label,v1,…`` lines and read back."""
    return _vector_lines(inp).select(
        "item_id",
        F.size("vector").cast("bigint").alias("dim"),
        ppm(F.element_at("vector", 1)).alias("first_ppm"),
        ppm(F.element_at("vector", -1)).alias("last_ppm"),
    )


def _vector_lines(inp: Inputs) -> DataFrame:
    path = new_scratch(inp.spark, "vector-text")
    source = inp.table("embeddings").withColumn("dim", F.size("embedding"))
    line = F.concat_ws(
        ",",
        F.col("vec_id").cast("string"),
        F.col("label").cast("string"),
        F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ","),
    )
    source.select(line.alias("value")).write.text(path)
    return vectors.read_vector_text(inp.spark, path, dim=64)


@query(
    "similar_vector_text",
    """
    SELECT item_id, other_id, sim_ppm, row_number() OVER (PARTITION BY item_id ORDER BY sim_ppm DESC, other_id) AS pos FROM (
      SELECT CAST(a.vec_id AS VARCHAR) AS item_id, CAST(b.vec_id AS VARCHAR) AS other_id,
        CAST(floor(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) * 1000000.0 + 0.5) AS BIGINT) AS sim_ppm
      FROM valid a JOIN valid b ON a.vec_id <> b.vec_id)
    QUALIFY pos <= 60""",
    valid="""SELECT * FROM embeddings WHERE vec_id IN (
      SELECT item_id FROM items WHERE title IS NOT NULL AND status = 1 AND feature_type = 1)""",
)
def similar_vector_text(inp: Inputs) -> DataFrame:
    """Vector lines → valid items → similarity, with the ids as they stand in the lines."""
    checklist = catalog.scan(inp.items, ["item_id"], catalog.VALID_ITEM).withColumn("item_id", F.col("item_id").cast("string"))
    return similar.similar_dense(filters.valid_only(_vector_lines(inp), checklist, "item_id"), 60)


@query(
    "valid_items_conditional",
    "SELECT item_id FROM items WHERE status = 1 AND (category <> 'PROMO' OR episodes > 0)",
)
def valid_items_conditional(inp: Inputs) -> DataFrame:
    return filters.valid_items(inp.items)


@query(
    "vip_items",
    """SELECT item_id FROM items
    WHERE status = 1 AND feature_type = 1 AND vip AND (category <> 'PROMO' OR episodes > 0) AND risk = 1""",
)
def vip_items(inp: Inputs) -> DataFrame:
    return filters.vip_items(inp.items, risk=1)


@query(
    "hot_items",
    f"""SELECT item_id, category, rating FROM items WHERE rating >= 40 AND risk = 0 AND status = 1
    AND category IN ({', '.join(repr(c) for c in catalog.LONG_CATEGORIES)})""",
)
def hot_items(inp: Inputs) -> DataFrame:
    return filters.hot_items(inp.items, 0, categories=catalog.LONG_CATEGORIES)


@query(
    "hot_vip_items",
    """SELECT item_id, category, rating FROM items
    WHERE rating >= 40 AND risk = 0 AND status = 1 AND vip AND feature_type = 1""",
)
def hot_vip_items(inp: Inputs) -> DataFrame:
    return filters.hot_vip_items(inp.items, 0)


@query(
    "regex_code_filter",
    """
    WITH codes AS (SELECT DISTINCT lower(p_type) || p_size AS code FROM part UNION SELECT n_name FROM nation)
    SELECT code FROM codes WHERE regexp_matches(code, '(promo|small|large|NATION_)([0-9]+)$')""",
)
def regex_code_filter(inp: Inputs) -> DataFrame:
    codes = inp.table("part").select(F.concat(F.lower("p_type"), F.col("p_size").cast("string")).alias("code"))
    codes = codes.unionByName(inp.table("nation").select(F.col("n_name").alias("code"))).distinct()
    return filters.regex_codes(codes, "code", ["promo", "small", "large", "NATION_"])


@query(
    "stale_filter",
    """
    SELECT item_id, category FROM (SELECT item_id, category, max(ts) AS ts FROM interactions GROUP BY 1, 2)
    WHERE NOT (category IN ('PROMO', 'SMALL') AND ts < TIMESTAMP '2001-10-01' - INTERVAL 180 DAY)""",
)
def stale_filter(inp: Inputs) -> DataFrame:
    updated = inp.interactions.groupBy("item_id", "category").agg(F.max("ts").alias("ts"))
    return filters.drop_stale(updated, "ts", ["PROMO", "SMALL"], "2001-10-01").select("item_id", "category")


@query(
    "validity_semi_join",
    f"""SELECT user_id, item_id, score FROM interactions
    WHERE item_id IN (SELECT item_id FROM items WHERE {_VALID} AND category = 'LARGE')""",
)
def validity_semi_join(inp: Inputs) -> DataFrame:
    checklist = catalog.available_items(inp.items, "LARGE")
    return filters.valid_only(inp.interactions, checklist, "item_id").select("user_id", "item_id", "score")


@query(
    "whitelist_semi_join",
    """SELECT user_id, item_id FROM taken t
    WHERE EXISTS (SELECT 1 FROM latest_exposures e WHERE e.user_id = t.user_id AND e.item_id = t.item_id)""",
)
def whitelist_semi_join(inp: Inputs) -> DataFrame:
    pairs = inp.taken.select("user_id", "item_id")
    return filters.list_filter(pairs, inp.latest_exposures, ["user_id", "item_id"], "white")


@query(
    "blacklist_anti_join",
    """SELECT user_id, item_id FROM taken t
    WHERE NOT EXISTS (SELECT 1 FROM latest_exposures e WHERE e.user_id = t.user_id AND e.item_id = t.item_id)""",
)
def blacklist_anti_join(inp: Inputs) -> DataFrame:
    pairs = inp.taken.select("user_id", "item_id")
    return filters.list_filter(pairs, inp.latest_exposures, ["user_id", "item_id"], "black")


@query(
    "exposures_in_buckets",
    """SELECT user_id, item_id FROM taken t
    WHERE NOT EXISTS (SELECT 1 FROM latest_exposures e WHERE e.user_id = t.user_id AND e.item_id = t.item_id)""",
)
def exposures_in_buckets(inp: Inputs) -> DataFrame:
    """The same list filter with exposures that were stored in buckets, in two writes."""
    path = new_scratch(inp.spark, "exposures")
    name = "exposures_" + path.rpartition("-")[2]
    for even in (0, 1):
        exposures.store(inp.latest_exposures.where(F.col("item_id") % 2 == even), name, path, buckets=16)
    return exposures.drop_seen(inp.taken.select("user_id", "item_id"), name)


@query(
    "risk_filter",
    """
    SELECT t.user_id, t.item_id, t.score FROM interactions t
    LEFT JOIN (SELECT user_id, max(risk) AS r FROM user_risk GROUP BY 1) u ON t.user_id = u.user_id
    LEFT JOIN (SELECT item_id, max(risk) AS r FROM item_risk GROUP BY 1) i ON t.item_id = i.item_id
    WHERE coalesce(u.r, 0) + coalesce(i.r, 0) <= 2""",
)
def risk_filter(inp: Inputs) -> DataFrame:
    base = inp.interactions.select("user_id", "item_id", "score")
    return filters.risk_filter(base, inp.user_risk, inp.item_risk)


@query(
    "exposure_union",
    """SELECT user_id, item_id, count(*) AS n FROM (
      SELECT * FROM latest_exposures UNION ALL SELECT * FROM backup_exposures) GROUP BY 1, 2""",
)
def exposure_union(inp: Inputs) -> DataFrame:
    both = filters.union_exposures(inp.latest_exposures, inp.backup_exposures)
    return both.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))


@query("canonical_map", "SELECT item_id, canonical_id FROM canonical")
def canonical_map(inp: Inputs) -> DataFrame:
    return canonical.canonical_map(inp.canonical_relation)


@query(
    "to_canonical",
    """
    SELECT cid AS item_id, category, rating FROM (
      SELECT coalesce(c.canonical_id, i.item_id) AS cid, i.* FROM items i LEFT JOIN canonical c ON i.item_id = c.item_id)
    QUALIFY row_number() OVER (PARTITION BY cid ORDER BY item_id) = 1""",
)
def to_canonical(inp: Inputs) -> DataFrame:
    mapping = canonical.canonical_map(inp.canonical_relation)
    return canonical.to_canonical(inp.items.select("item_id", "category", "rating"), mapping)


@query(
    "dedup_by_canonical",
    """
    SELECT item_id, category, title, risk FROM (
      SELECT coalesce(c.canonical_id, i.item_id) AS cid, i.* FROM items i LEFT JOIN canonical c ON i.item_id = c.item_id
      WHERE i.status = 1)
    QUALIFY row_number() OVER (PARTITION BY cid ORDER BY item_id) = 1""",
)
def dedup_by_canonical(inp: Inputs) -> DataFrame:
    mapping = canonical.canonical_map(inp.canonical_relation)
    rows = inp.items.where("status = 1").select("item_id", "category", "title", "risk")
    return canonical.dedup_by_canonical(rows, mapping)


@query(
    "canonical_max_score",
    """
    SELECT user_id, cid AS item_id, score, ts FROM (
      SELECT user_id, coalesce(c.canonical_id, t.item_id) AS cid, score, ts
      FROM purchases t LEFT JOIN canonical c ON t.item_id = c.item_id)
    QUALIFY row_number() OVER (PARTITION BY user_id, cid ORDER BY score DESC, ts DESC) = 1""",
)
def canonical_max_score(inp: Inputs) -> DataFrame:
    mapping = canonical.canonical_map(inp.canonical_relation)
    return canonical.canonical_max_score(inp.purchases.select("user_id", "item_id", "score", "ts"), mapping)


@query(
    "hot_collections",
    """SELECT code, copyright FROM subjects JOIN subject_pages ON id = subject_id WHERE mode IN (2, 4, 7, 8)""",
)
def hot_collections(inp: Inputs) -> DataFrame:
    return collections.hot_collections(inp.subjects, inp.subject_pages)


@query(
    "available_collections",
    """SELECT category, code FROM subjects LEFT JOIN (
      SELECT subject_id FROM subject_pages WHERE mode NOT IN (2, 3, 4, 5, 6, 7, 8, 10)) ON id = subject_id""",
)
def available_collections(inp: Inputs) -> DataFrame:
    return collections.available_collections(inp.subjects, inp.subject_pages)


@query(
    "daily_scores_valid",
    f"""SELECT item_id, day, CAST(sum(score) AS BIGINT) AS score
    FROM (SELECT item_id, strftime(ts, '%Y%m%d') AS day, score FROM purchases)
    WHERE day = '20000115' AND item_id IN (SELECT item_id FROM items WHERE {_VALID}) GROUP BY 1, 2""",
)
def daily_scores_valid(inp: Inputs) -> DataFrame:
    daily = (
        inp.purchases.where(activity.day_range("ts", "20000115"))
        .groupBy("item_id", F.date_format("ts", "yyyyMMdd").alias("day"))
        .agg(F.sum("score").alias("score"))
    )
    return activity.daily_scores_valid(daily, catalog.scan(inp.items, ["item_id"], catalog.VALID_ITEM), "20000115")


@query(
    "active_any_counter",
    """
    SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00'
      AND event_type IN ('view', 'click', 'purchase', 'signup') GROUP BY user_id""",
)
def active_any_counter(inp: Inputs) -> DataFrame:
    recent = F.col("ts") >= F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    kinds = ["view", "click", "purchase", "signup"]
    counters = inp.table("events").groupBy("user_id").agg(
        *[F.count_if(recent & (F.col("event_type") == k)).alias(k) for k in kinds]
    )
    return activity.active_any_counter(counters, kinds)


@query(
    "ratings_in_range",
    """SELECT user_id AS "user", item_id AS item, score AS rating FROM purchases
    WHERE ts BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2000-06-30'""",
)
def ratings_in_range(inp: Inputs) -> DataFrame:
    return activity.ratings_in_range(inp.purchases, "2000-01-01", "2000-06-30")


@query(
    "active_users",
    """SELECT DISTINCT user_id FROM (SELECT user_id, item_id FROM interactions
      WHERE category = 'PROMO' AND ts > TIMESTAMP '2001-01-01' GROUP BY 1, 2 HAVING sum(score) > 30.5)""",
)
def active_users(inp: Inputs) -> DataFrame:
    return activity.active_users(inp.interactions, "2001-01-01", 30.5, "PROMO")


@query(
    "active_users_all",
    """SELECT DISTINCT user_id FROM (SELECT user_id, item_id FROM purchases
      WHERE ts > TIMESTAMP '2001-03-01' GROUP BY 1, 2 HAVING sum(score) > 30.5)""",
)
def active_users_all(inp: Inputs) -> DataFrame:
    return activity.active_users(inp.purchases, "2001-03-01", 30.5)


_WATCHED = """
    WITH pairs AS (SELECT DISTINCT user_id, item_id FROM {source}
      WHERE {where} ts BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '2001-12-31'),
    sized AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY user_id) / {size}.0) AS BIGINT) AS chunks FROM pairs)
    SELECT user_id, CAST('0x' || substr(md5(CAST(item_id AS VARCHAR)), 1, 8) AS BIGINT) % chunks AS chunk,
      count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items
    FROM sized GROUP BY 1, 2"""


def _merge_with(sql: str) -> str:
    """Inner WITH blocks are wrapped so that input expressions can go in front."""
    return f"SELECT * FROM ({sql.strip()})"


@query(
    "watched_sets",
    _merge_with(_WATCHED.format(source="purchases", where="", start="1995-01-01", size=16)),
)
def watched_sets(inp: Inputs) -> DataFrame:
    """All items per user; chunks of 16 show how a long set is split."""
    sets = activity.watched_sets(inp.purchases, "1995-01-01", "2001-12-31", chunk_rows=16)
    return sets.select("user_id", "chunk", "n", _joined("entries").alias("items"))


@query(
    "watched_sets_category",
    _merge_with(
        _WATCHED.format(source="interactions", where="category = 'SMALL' AND", start="1998-01-01", size=10000)
    ),
)
def watched_sets_category(inp: Inputs) -> DataFrame:
    sets = activity.watched_sets(inp.interactions, "1998-01-01", "2001-12-31", "SMALL")
    return sets.select("user_id", "chunk", "n", _joined("entries").alias("items"))


@query("dataset_profile", """SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
    'struct<user_id:bigint,item_id:bigint,score:bigint,ts:timestamp_ntz,flag:string>' AS schema FROM purchases""")
def dataset_profile(inp: Inputs) -> DataFrame:
    return activity.dataset_profile(inp.purchases)


@query(
    "dataset_profile_observed",
    """SELECT count(*) AS n_rows, CAST(sum(CASE WHEN score IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_score,
      count(DISTINCT item_id) AS items_written FROM purchases""",
)
def dataset_profile_observed(inp: Inputs) -> DataFrame:
    """The counts of a job's input, gathered while the job writes its own result."""
    rows, profile = activity.observed_profile(inp.purchases)
    written = materialize(rows.groupBy("item_id").agg(F.sum("score").alias("score")), "scores")
    seen = profile.get
    return written.agg(F.count(F.lit(1)).alias("items_written")).select(
        F.lit(seen["n_rows"]).cast("bigint").alias("n_rows"), F.lit(seen["null_score"]).cast("bigint").alias("null_score"), "items_written"
    )


@query(
    "dataset_sample",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    ORDER BY md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey), l_orderkey, l_linenumber, l_partkey LIMIT 20""",
)
def dataset_sample(inp: Inputs) -> DataFrame:
    """A look at a few rows, the same ones on every run."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey"]
    return activity.dataset_sample(inp.table("lineitem").select(*columns), columns, 20)


@query(
    "editor_weight",
    """SELECT t.user_id, t.item_id, t.total * CASE WHEN i.item_id IS NULL THEN 10 ELSE 11 END AS weighted_x10
    FROM taken t LEFT JOIN (SELECT item_id FROM items WHERE rating >= 48 AND status = 1) i ON t.item_id = i.item_id""",
)
def editor_weight(inp: Inputs) -> DataFrame:
    """The weight 1.1 in tenths, so the result is whole numbers."""
    picks = catalog.source("editor_picks").read(inp.named)
    scores = inp.taken.select("user_id", "item_id", (F.col("total") * 10).alias("score"))
    weighted = activity.editor_weight(scores, picks, F.lit(1.1).cast("decimal(2,1)"))
    return weighted.select("user_id", "item_id", F.col("weighted").cast("bigint").alias("weighted_x10"))


@query(
    "blend_score",
    """
    SELECT i.item_id, CAST(floor((0.4 * (rating / 50.0) + coalesce(0.6 * CAST(q.quality AS DOUBLE), 0)) * 1000000.0 + 0.5) AS BIGINT) AS score_ppm
    FROM (SELECT item_id, CAST(rating AS DOUBLE) AS rating FROM items) i
    LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) q ON i.item_id = q.doc_id""",
)
def blend_score(inp: Inputs) -> DataFrame:
    matches = inp.items.select("item_id", (F.col("rating") / 50.0).alias("match_score"))
    quality = inp.table("labels").groupBy(F.col("doc_id").alias("item_id")).agg(
        F.max("quality").cast("double").alias("quality")
    )
    return activity.blend_score(matches, quality).select("item_id", ppm(F.col("score")).alias("score_ppm"))


@query(
    "clean_title",
    r"""SELECT doc_id, regexp_replace(text, '[^\x{4e00}-\x{9fa5}a-zA-Z0-9]+', '', 'g') AS cleaned FROM documents""",
)
def clean_titles(inp: Inputs) -> DataFrame:
    return inp.table("documents").select("doc_id", clean_title(F.col("text")).alias("cleaned"))


@query(
    "base64_codes",
    """SELECT doc_id, base64(encode(nullif(text, ''))) AS code FROM documents""",
)
def base64_codes(inp: Inputs) -> DataFrame:
    return inp.table("documents").select("doc_id", base64_text(F.col("text")).alias("code"))


@query("base64_decode", "SELECT doc_id, nullif(text, '') AS text FROM documents")
def base64_decode(inp: Inputs) -> DataFrame:
    coded = inp.table("documents").select("doc_id", base64_text(F.col("text")).alias("code"))
    return coded.select("doc_id", unbase64_text(F.col("code")).alias("text"))


@query(
    "clean_keep_space",
    r"""SELECT conv_id, turn, trim(regexp_replace(text, '[^\x{4e00}-\x{9fa5}a-zA-Z0-9\s]+', '', 'g')) AS cleaned,
      regexp_matches(text, '[\x{4e00}-\x{9fa5}]') AS has_cjk FROM conversations""",
)
def clean_keep_spaces(inp: Inputs) -> DataFrame:
    return inp.table("conversations").select(
        "conv_id", "turn", clean_keep_space(F.col("text")).alias("cleaned"), has_cjk(F.col("text")).alias("has_cjk")
    )


@query(
    "date_keys",
    """SELECT o_orderkey AS order_id, strftime(o_orderdate - INTERVAL 7 DAY, '%Y%m%d') AS day_key,
      strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d') AS month_before,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp FROM orders""",
)
def date_keys(inp: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    return inp.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        dates.days_before(day, 7, dates.DAY_KEY).alias("day_key"),
        dates.days_before(day, 30).alias("month_before"),
        dates.days_before(day, 0, dates.SECONDS).alias("stamp"),
    )
