"""Exposures in buckets: the exact anti join, without a shuffle of the exposures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lumenrec.operators import exposures, filters


def shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning"), plan


def test_only_candidates_are_shuffled(spark, frame, rows, tmp_path):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    name = f"exposures_{uuid.uuid4().hex}"
    try:
        for k in before:
            spark.conf.set(k, "-1")
        # a third of all exposures are one user's
        shown = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 90).alias("user_id"), (F.col("id") % 700).alias("item_id"))
        exposures.store(shown.where("item_id < 300"), name, str(tmp_path / "table"), buckets=8)
        exposures.store(shown.where("item_id >= 300"), name, str(tmp_path / "table"), buckets=8)
        wanted = spark.range(4000).select((F.col("id") % 97).alias("user_id"), (F.col("id") % 800).alias("item_id"))
        got = exposures.drop_seen(wanted, name)
        n, plan = shuffles(got)
        assert n == 1 and "Bucketed: true" in spark.table(name).join(wanted, ["user_id", "item_id"])._jdf.queryExecution().executedPlan().toString(), plan
        plain = filters.list_filter(wanted, shown, ["user_id", "item_id"], "black")
        assert rows(got) == rows(plain) and shuffles(plain)[0] > 1  # the plain one moves the exposures too
        spread = spark.table(name).where("user_id = 0").groupBy(F.input_file_name()).count().collect()
        assert max(r["count"] for r in spread) < 0.25 * 2000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_null_keys(spark, frame, rows, tmp_path):
    name = f"exposures_{uuid.uuid4().hex}"
    schema = "user_id bigint, item_id bigint"
    exposures.store(frame(schema, (1, 1), (1, 1), (None, 2), (3, None)), name, str(tmp_path / "t"), buckets=2)
    got = exposures.drop_seen(frame(schema, (1, 1), (1, 2), (None, 2), (3, None), (1, 2)), name)
    assert rows(got) == [(None, 2), (1, 2), (1, 2), (3, None)]
    assert rows(exposures.drop_seen(frame(schema), name)) == []
    spark.sql(f"DROP TABLE {name}")
