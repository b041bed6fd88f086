"""Queries over per-key lists, mixes and similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lumenrec.operators import filters, lists, similar
from lumenrec.operators.mix import RATIO, STACKING, mix
from lumenrec.plans.inputs import Inputs
from lumenrec.plans.registry import query
from lumenrec.session import new_scratch, spread
from lumenrec.sources import catalog, snapshots

def by_total() -> list[Column]:
    return [F.col("total").desc(), F.col("item_id")]


def id_string(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")


@query(
    "top_n_per_group",
    """SELECT user_id, item_id, total, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, item_id) AS pos
    FROM taken QUALIFY pos <= 50""",
)
def top_n_per_group(inp: Inputs) -> DataFrame:
    return lists.top_n(inp.taken.select("user_id", "item_id", "total"), ["user_id"], by_total(), 50)


@query("detail_top24", "SELECT item_id, other_id, pos FROM cluster_partners WHERE pos <= 24")
def detail_top24(inp: Inputs) -> DataFrame:
    """A row of an item has place 24 at most among the first 24, so later places are not shuffled; they are dealt
    before they are sorted, as one split of the catalogue gives 70 rows for each of its items."""
    items = spread(inp.items)
    partners = similar.similar_by_cluster(items, _popularity(items), 70)
    placed = partners.withColumnRenamed("pos", "place").where("place <= 24").repartition("item_id")
    return lists.top_n(placed, ["item_id"], [F.col("place")], 24).drop("place")


def _popularity(items: DataFrame) -> DataFrame:
    return items.select("item_id", "cluster", F.col("rating").alias("popularity"))


@query(
    "fold_list",
    """SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS items
    FROM cluster_candidates GROUP BY user_id""",
)
def fold_list(inp: Inputs) -> DataFrame:
    folded = lists.fold_list(inp.cluster_candidates, "user_id", "item_id", "rank")
    return folded.select("user_id", id_string("id").alias("items"))


@query(
    "fold_matrix",
    """SELECT user_id, string_agg(item_id || ':' || total, ',' ORDER BY total DESC, item_id) AS items FROM taken
    GROUP BY user_id""",
)
def fold_matrix(inp: Inputs) -> DataFrame:
    folded = lists.fold_matrix(inp.taken, "user_id", "item_id", "total")
    pairs = F.transform("items", lambda x: F.concat_ws(":", x["item"].cast("string"), x["score"].cast("string")))
    return folded.select("user_id", F.array_join(pairs, ",").alias("items"))


@query(
    "list_take",
    """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, item_id) AS pos
    FROM taken QUALIFY pos <= 10""",
)
def list_take(inp: Inputs) -> DataFrame:
    return lists.list_operation(inp.taken, "user_id", "item_id", by_total(), lists.TAKE, 10)


@query(
    "list_take_min",
    """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, item_id) AS pos
    FROM taken QUALIFY pos <= 10 AND count(*) OVER (PARTITION BY user_id) >= 38""",
)
def list_take_min(inp: Inputs) -> DataFrame:
    return lists.list_operation(inp.taken, "user_id", "item_id", by_total(), lists.TAKE, 10, min_size=38)


@query(
    "list_shuffle",
    """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('7:' || user_id || ':' || item_id), item_id) AS pos
    FROM taken""",
)
def list_shuffle(inp: Inputs) -> DataFrame:
    return lists.list_operation(inp.taken, "user_id", "item_id", by_total(), lists.RANDOM)


@query(
    "list_shuffle_min",
    """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('7:' || user_id || ':' || item_id), item_id) AS pos
    FROM taken QUALIFY count(*) OVER (PARTITION BY user_id) >= 38""",
)
def list_shuffle_min(inp: Inputs) -> DataFrame:
    return lists.list_operation(inp.taken, "user_id", "item_id", by_total(), lists.RANDOM, min_size=38)


@query(
    "list_take_shuffle",
    """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('7:' || user_id || ':' || item_id), item_id) AS pos
    FROM (SELECT * FROM taken QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY total DESC, item_id) <= 20)""",
)
def list_take_shuffle(inp: Inputs) -> DataFrame:
    return lists.list_operation(inp.taken, "user_id", "item_id", by_total(), lists.TAKE_AND_RANDOM, 20)


# Quota per category of the default list.
QUOTAS = {"ECONOMY": 400, "LARGE": 400, "MEDIUM": 200, "PROMO": 200, "SMALL": 200, "STANDARD": 200}


@query(
    "stratified_sample",
    """SELECT category, item_id, row_number() OVER (PARTITION BY category ORDER BY md5('7:' || category || ':' || item_id), item_id) AS pos
    FROM items WHERE status = 1
    QUALIFY pos <= CASE WHEN category IN ('ECONOMY', 'LARGE') THEN 40 ELSE 20 END""",
)
def stratified_sample(inp: Inputs) -> DataFrame:
    """The default job's quotas at a tenth, so that they bind on the sample data."""
    quotas = {category: quota // 10 for category, quota in QUOTAS.items()}
    return lists.stratified_sample(inp.items.where("status = 1"), "category", "item_id", quotas)


@query(
    "popularity_top_n",
    "SELECT item_id, count(*) AS cnt FROM purchases WHERE score > 0.1 GROUP BY 1 ORDER BY cnt DESC, item_id LIMIT 100",
)
def popularity_top_n(inp: Inputs) -> DataFrame:
    return lists.popularity_top_n(inp.purchases, "item_id", 100)


@query(
    "popularity_top_n_category",
    """SELECT item_id, count(*) AS cnt FROM interactions WHERE score > 25 AND category = 'LARGE'
    GROUP BY 1 ORDER BY cnt DESC, item_id LIMIT 50""",
)
def popularity_top_n_category(inp: Inputs) -> DataFrame:
    return lists.popularity_top_n(inp.interactions, "item_id", 50, 25, "LARGE")


_MIXED = """
    SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY turn, src, rank) AS pos FROM (
      SELECT user_id, item_id, rank, src, {turn} AS turn FROM (
        SELECT user_id, item_id, rank, 0 AS src FROM cluster_candidates
        UNION ALL SELECT user_id, item_id, rank, 1 FROM series_candidates
        UNION ALL SELECT user_id, item_id, rank, 2 FROM similar_candidates
        UNION ALL SELECT user_id, item_id, rank, 3 FROM model_candidates)
      QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY turn, src, rank) = 1)
    QUALIFY pos <= {n}"""


def _sources(inp: Inputs, n: int) -> list[DataFrame]:
    """The lists for a mix of ``n``. Users share the model's shelves; behind ``n`` other items of its list none is in the mix.

    So at most ``n`` items of each list are sent. What users took is in their own lists once an item.
    """
    inp.share_taken()
    model = inp.favourites(inp.model_shelf, first=n)
    own = [c.where(F.col("rank") <= n) for c in (inp.cluster_candidates, inp.series_candidates)]
    return [*own, inp.similar_candidates, model]


@query("mix_stacking", _MIXED.format(turn="0", n=60))
def mix_stacking(inp: Inputs) -> DataFrame:
    return mix(_sources(inp, 60), "user_id", "item_id", 60, STACKING, short=True).drop("score")


@query("mix_ratio", _MIXED.format(turn="CASE src WHEN 0 THEN (rank - 1) // 3 ELSE rank - 1 END", n=200))
def mix_ratio(inp: Inputs) -> DataFrame:
    return mix(_sources(inp, 200), "user_id", "item_id", 200, RATIO, [3, 1, 1, 1], short=True).drop("score")


@query(
    "similar_by_cluster",
    """SELECT a.item_id, b.item_id AS other_id, row_number() OVER (PARTITION BY a.item_id ORDER BY b.rating DESC, b.item_id) AS pos
    FROM items a JOIN items b ON a.cluster = b.cluster AND a.item_id <> b.item_id
    WHERE a.rating >= 40 AND a.risk = 0 AND a.status = 1 AND b.status = 1 AND b.feature_type = 1
    QUALIFY pos <= 70""",
)
def similar_by_cluster(inp: Inputs) -> DataFrame:
    prefer = filters.hot_items(inp.items, 0).join(inp.items.select("item_id", "cluster"), "item_id")
    valid = inp.items.where("status = 1 and feature_type = 1")
    return similar.similar_by_cluster(prefer, valid.select("item_id", "cluster", F.col("rating").alias("popularity")))


SPARSE_SQL = """
    SELECT a.item_id, b.item_id AS other_id,
      CAST(floor(sum(a.weight * b.weight) / sqrt(CAST(any_value(na.n) AS DOUBLE) * CAST(any_value(nb.n) AS DOUBLE)) * 1000000) AS BIGINT) AS sim_ppm
    FROM sparse_vectors a JOIN sparse_vectors b ON a.feature = b.feature AND a.item_id <> b.item_id
    JOIN (SELECT item_id, sum(weight * weight) AS n FROM sparse_vectors GROUP BY 1) na ON na.item_id = a.item_id
    JOIN (SELECT item_id, sum(weight * weight) AS n FROM sparse_vectors GROUP BY 1) nb ON nb.item_id = b.item_id
    GROUP BY 1, 2"""


@query(
    "similar_sparse",
    """SELECT item_id, other_id, sim_ppm, row_number() OVER (PARTITION BY item_id ORDER BY sim_ppm DESC, other_id) AS pos
    FROM sparse_pairs QUALIFY pos <= 60""",
    sparse_pairs=SPARSE_SQL,
)
def similar_sparse(inp: Inputs) -> DataFrame:
    return similar.similar_sparse(inp.sparse_vectors, 60)


@query(
    "similar_sparse_shared",
    """SELECT item_id, other_id, sim_ppm, row_number() OVER (PARTITION BY item_id ORDER BY sim_ppm DESC, other_id) AS pos
    FROM described_pairs QUALIFY pos <= 20""",
    described="""SELECT item_id, 'u' || feature AS feature, weight FROM sparse_vectors
      UNION ALL SELECT item_id, 'c' || cluster, 3 FROM items WHERE cluster IS NOT NULL
      UNION ALL SELECT item_id, 'k' || category, 2 FROM items WHERE category IS NOT NULL""",
    described_pairs=SPARSE_SQL.replace("sparse_vectors", "described"),
)
def similar_sparse_shared(inp: Inputs) -> DataFrame:
    """Vectors with features that a large part of the items share: cluster and category next to the users."""
    users = inp.sparse_vectors.select("item_id", F.concat(F.lit("u"), F.col("feature").cast("string")).alias("feature"), "weight")
    traits = inp.items.select("item_id", F.explode(F.array(
        F.struct(F.concat(F.lit("c"), F.col("cluster").cast("string")).alias("feature"), F.lit(3).cast("bigint").alias("weight")),
        F.struct(F.concat(F.lit("k"), F.col("category").cast("string")).alias("feature"), F.lit(2).cast("bigint").alias("weight")),
    )).alias("t")).select("item_id", "t.*")
    return similar.similar_sparse(users.unionByName(traits.where("feature is not null")), 20, feature_rows=200)


@query(
    "similar_dense",
    """
    SELECT item_id, other_id, sim_ppm, row_number() OVER (PARTITION BY item_id ORDER BY sim_ppm DESC, other_id) AS pos FROM (
      SELECT a.vec_id AS item_id, b.vec_id AS other_id,
        CAST(floor(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) * 1000000.0 + 0.5) AS BIGINT) AS sim_ppm
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    QUALIFY pos <= 60""",
)
def similar_dense(inp: Inputs) -> DataFrame:
    return similar.similar_dense(inp.dense_vectors, 60)


@query(
    "similar_dense_blocks",
    """
    SELECT item_id, other_id, sim_ppm, row_number() OVER (PARTITION BY item_id ORDER BY sim_ppm DESC, other_id) AS pos FROM (
      SELECT a.vec_id AS item_id, b.vec_id AS other_id,
        CAST(floor(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) * 1000000.0 + 0.5) AS BIGINT) AS sim_ppm
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    QUALIFY pos <= 5""",
)
def similar_dense_blocks(inp: Inputs) -> DataFrame:
    """The same in blocks around eight pivots, small enough that several are made of a small table."""
    return similar.similar_dense(inp.dense_vectors, 5, block_rows=256, pivots=8)


@query(
    "job_similar_dense",
    """
    SELECT item_id, other_id, sim_ppm, row_number() OVER (PARTITION BY item_id ORDER BY sim_ppm DESC, other_id) AS pos FROM (
      SELECT a.vec_id AS item_id, b.vec_id AS other_id,
        CAST(floor(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) * 1000000.0 + 0.5) AS BIGINT) AS sim_ppm
      FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id)
    QUALIFY pos <= 60""",
    valid="""SELECT * FROM embeddings WHERE vec_id IN (
      SELECT item_id FROM items WHERE title IS NOT NULL AND status = 1 AND feature_type = 1)""",
)
def job_similar_dense(inp: Inputs) -> DataFrame:
    """Valid items only, compared inside their category, published as a snapshot."""
    checklist = catalog.scan(inp.items, ["item_id"], catalog.VALID_ITEM)
    valid = filters.valid_only(inp.dense_vectors, checklist, "item_id")
    partners = similar.similar_dense(valid, 60, within="category")
    base = new_scratch(inp.spark, "similar-dense")
    snapshots.write_snapshot(partners, base, "test", "demo", "similarDense")
    return snapshots.read_snapshot(inp.spark, base, "test", "demo", "similarDense")


@query(
    "job_similar_default",
    """SELECT a.item_id, b.item_id AS other_id, row_number() OVER (PARTITION BY a.item_id ORDER BY b.rating DESC, b.item_id) AS pos
    FROM items a JOIN items b ON a.category = b.category AND a.item_id <> b.item_id
    WHERE a.rating >= 40 AND a.risk = 0 AND a.status = 1
      AND b.title IS NOT NULL AND b.status = 1 AND b.feature_type = 1
    QUALIFY pos <= 70""",
)
def job_similar_default(inp: Inputs) -> DataFrame:
    """Hot items against the valid items of their category (the category is the cluster)."""
    prefer = filters.hot_items(inp.items, 0).withColumnRenamed("category", "cluster")
    valid = inp.items.where(catalog.VALID_ITEM).select(
        "item_id", F.col("category").alias("cluster"), F.col("rating").alias("popularity")
    )
    base = new_scratch(inp.spark, "similar-default")
    snapshots.write_snapshot(similar.similar_by_cluster(prefer, valid), base, "test", "demo", "similarDefault")
    return snapshots.read_snapshot(inp.spark, base, "test", "demo", "similarDefault")
