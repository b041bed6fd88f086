"""A join whose small side was reduced on the join key still lets Spark split a hot key."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lumenrec.operators import activity, canonical, filters, lists, outbox, postings, similar, words
from lumenrec.plans import q_lists
from lumenrec.plans.inputs import Inputs

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=30_000):
    """A third of all rows have item 0 (and the word "hot")."""
    item = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("user_id"), item.alias("item_id"), (F.xxhash64("id") % 1000000).alias("score"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"),
    )


def cases(spark):
    rows, items = hot(spark), spark.range(1000).select(F.col("id").alias("item_id"))
    risk = items.withColumn("risk", F.lit(1).cast("bigint"))
    docs = rows.select("user_id", F.concat(F.lit("hot w"), (F.col("user_id") % 500).cast("string")).alias("t")).where("user_id % 3 = 0")
    tokens = F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("user_id").cast("string")))
    titles = rows.select(F.col("user_id").cast("string").alias("word"), tokens.alias("tokens"))
    readings = spark.range(1000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("token"), F.lit("r").alias("reading"))
    detail = items.select((F.col("item_id") + 5000).alias("item_id"), F.col("item_id").alias("cluster"), F.col("item_id").alias("popularity"))
    relation = items.withColumn("canonical_id", F.col("item_id") % 10)
    return {
        "valid_only": filters.valid_only(rows, items, "item_id"),
        "risk_filter": filters.risk_filter(rows, spark.createDataFrame([], "user_id bigint, risk bigint"), risk),
        "canonical_max_score": canonical.canonical_max_score(rows, canonical.canonical_map(relation)),
        "editor_weight": activity.editor_weight(rows, items, F.lit(2)),
        "fold_chunks": lists.fold_chunks(rows, ["item_id"], ["user_id"], F.col("user_id"), 1000),
        "keywords_tfidf": words.keywords_tfidf(docs, "user_id", "t"),
        "token_readings": words.token_readings(titles, readings),
        "similar_by_cluster": similar.similar_by_cluster(rows.select(F.col("score").alias("item_id"), F.col("item_id").alias("cluster")), detail, 2),
    }


@pytest.mark.parametrize("name", ["valid_only", "risk_filter", "canonical_max_score", "editor_weight", "fold_chunks", "keywords_tfidf", "token_readings", "similar_by_cluster"])
def test_hot_key_is_split(spark, small_thresholds, name):
    df = cases(spark)[name]
    assert len(df.collect()) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "skew=true" in plan


def _most_rows_of_a_task(df, columns):
    """Rows of the largest partition that a numbering leaves behind, and the number of all rows."""
    sizes = [r["count"] for r in df.select(*columns).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes), sum(sizes)


@pytest.mark.parametrize("name", ["shuffled_positions", "ordered_positions"])
def test_a_hot_list_is_numbered_in_many_tasks(spark, small_thresholds, name):
    """Three quarters of all rows are one user's list; no task may hold much more than its share."""
    user = F.when(F.col("id") % 4 < 3, 0).otherwise(F.col("id") % 1000 + 1)
    rows = spark.range(0, 80_000, 1, 8).select(user.alias("user_id"), F.col("id").alias("item_id"), (F.xxhash64("id") % 5000).alias("score"))
    if name == "shuffled_positions":
        df = lists.shuffled_positions(rows, "user_id", "item_id")
    else:
        df = lists.ordered_positions(rows, "user_id", "item_id", "score")
    most, whole = _most_rows_of_a_task(df, ["user_id", "pos"])
    assert whole == 80_000 and most < 0.4 * whole
    hot = df.where("user_id = 0").agg(F.count("*").alias("n"), F.count_distinct("pos").alias("d"), F.max("pos").alias("m")).first()
    assert (hot.n, hot.d, hot.m) == (60_000,) * 3


def _above(df, node):
    """Names of the plan's nodes above the first ``node`` from the bottom, nearest first."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = max(k for k, line in enumerate(plan) if re.search(rf"\b{node}\b", line))
    return [m.group(0) for line in reversed(plan[:at]) if (m := re.search(r"Exchange|WindowGroupLimit|SortAggregate|\bSort\b", line))]


def test_exploded_partners_are_dealt_before_they_are_sorted(spark, tmp_path):
    """One split of the catalogue gives 70 rows for each of its items."""
    part = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    rows = [(k, "big rod", f"b{k % 2}", "t", k % 7, 1.0) for k in range(200)]
    spark.createDataFrame(rows, part).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    df = q_lists.detail_top24(Inputs(spark, str(tmp_path)))
    assert _above(df, "Generate")[0] == "Exchange"
    got = df.groupBy("item_id").agg(F.count("*").alias("n"), F.max("pos").alias("m")).collect()
    assert len(got) == 200 and {(r.n, r.m) for r in got} == {(24, 24)}


def test_postings_are_dealt_before_they_are_sorted(spark):
    posting = "search_key string, category string, item_id string, highlight string, score double, risk bigint"
    stored = spark.createDataFrame([("k", "c", str(k), "h", 1.0, 0) for k in range(9)], posting)
    adds = stored.withColumn("ts", F.lit(5).cast("bigint")).withColumn("score", F.lit(2.0)).where("item_id < '3'")
    deletes = adds.select("search_key", "category", "item_id", F.lit(6).cast("bigint").alias("ts")).where("item_id = '0'")
    merged = postings.merge_index(stored, adds, deletes)
    assert _above(merged, "Union")[0] == "Exchange"
    assert sorted((r.item_id, r.score) for r in merged.collect()) == [(str(k), 2.0 if k < 3 else 1.0) for k in range(1, 9)]


def test_received_messages_are_dealt_before_repeats_are_dropped(spark, tmp_path):
    row = ("k", "v", "t", 1, "d", 0)
    spark.createDataFrame([row, row, ("k", "v", "t", 1, "d", 1)], outbox.OUTGOING).write.parquet(f"{tmp_path}/in")
    got = outbox.drop_repeats(spark.read.parquet(f"{tmp_path}/in"))
    assert _above(got, "FileScan")[0] == "Exchange"
    assert sorted(r.batch for r in got.collect()) == [0, 1]


def test_outbox_knows_messages_by_key_and_target(spark, tmp_path):
    schema = "key string, value string, target string, ttl bigint"
    messages = [("k", "v", "a", 1), ("k", "v", "a", 1), ("k", "v", "b", 1), ("k", "v", None, 1)]
    outbox.put(spark.createDataFrame(messages, schema), str(tmp_path), 0)
    outbox.put(spark.createDataFrame([*messages, ("k", "w", "b", 1), ("l", "v", "a", 1)], schema), str(tmp_path), 1)
    sent = sorted((r.batch, r.key, r.value, r.target or "") for r in outbox.waiting(spark, str(tmp_path)).collect())
    # A message without a target is equal to none that was sent.
    assert sent == [(0, "k", "v", ""), (0, "k", "v", "a"), (0, "k", "v", "b"), (1, "k", "v", ""), (1, "k", "w", "b"), (1, "l", "v", "a")]
