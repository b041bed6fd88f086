"""Packing results as keyed messages and handing them to a sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumenrec.operators.lists import fold_list, fold_scored

# Fixed value: seconds a published list lives.
TTL_LISTS = 1728000


def _json(fields: Sequence[Column]) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def pack_kv(
    df: DataFrame, key: str, prefix: str = "", extras: Mapping[str, str] | None = None
) -> DataFrame:
    """``(key, columns…)`` → ``(key = prefix + key, value = JSON of the columns, then the extras)``."""
    fields = [F.col(c) for c in df.columns if c != key]
    fields += [F.lit(v).alias(k) for k, v in (extras or {}).items()]
    return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("key"), _json(fields).alias("value"))


def pack_slot(df: DataFrame, key: str, slot: str, extras: Mapping[str, str]) -> DataFrame:
    """One struct column per slot, to be nested and serialised once by :func:`pack_kv`."""
    fields = [F.col(c) for c in df.columns if c != key]
    fields += [F.lit(v).alias(k) for k, v in extras.items()]
    return df.select(F.col(key).cast("string").alias("key"), F.struct(*fields).alias(slot))


def pack_zset(df: DataFrame, key: str, item: str, score: str, alg: str, n: int | None = None) -> DataFrame:
    """Key with its members ``(member, score)``, best first, all of them or the ``n`` best.

    A very long list comes as several rows with the same key: a sorted set takes members
    in any number of messages.
    """
    text = df.select(key, F.col(item).cast("string").alias("_member"), F.col(score).alias("_score"))
    folded = fold_scored(text, key, "_member", "_score", n, "member", "members")
    return folded.select(F.col(key).cast("string").alias("key"), "members", F.lit(alg).alias("alg"))


def pack_hash(df: DataFrame, key: str, field: str, value: str, prefix: str = "") -> DataFrame:
    """Key with a map of fields; a key has few distinct fields."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(field).alias("key"), F.col(value).alias("value"))))
    return df.groupBy(key).agg(F.map_from_entries(pairs).alias("fields")).select(
        F.concat(F.lit(prefix), F.col(key)).alias("key"), "fields"
    )


def publish_fanout(packed: DataFrame, targets: Sequence[str], ttl: int) -> DataFrame:
    """One copy of every message per target host."""
    return packed.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets]))).withColumn(
        "ttl", F.lit(ttl).cast("bigint")
    )


ENVELOPE = "target string, ttl bigint, payload string"


def write_messages(messages: DataFrame, fmt: str, topic: str, mode: str = "append", **options: str) -> None:
    """Send messages to Kafka, or to files for replay.

    ``(key, value)`` go as they are; with ``target`` and ``ttl`` the value sent is an
    envelope that holds both and the payload, so the consumer knows where it belongs.
    """
    if {"target", "ttl"} <= set(messages.columns):
        envelope = _json([F.col("target"), F.col("ttl"), F.col("value").alias("payload")])
        messages = messages.select("key", envelope.alias("value"))
    out = messages.withColumn("topic", F.lit(topic))
    writer = out.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode(mode).save()


def open_envelopes(messages: DataFrame) -> DataFrame:
    """Sent messages → ``(key, value, target, ttl)``."""
    inside = F.from_json("value", ENVELOPE)
    return messages.select("key", inside["payload"].alias("value"), inside["target"].alias("target"), inside["ttl"].alias("ttl"))


def sliced_key(folded: DataFrame, key: str) -> DataFrame:
    """Key column of folded lists as text; the second and later slices of a long list get ``#slice``."""
    text = F.col(key).cast("string")
    if "slice" not in folded.columns:
        return folded.withColumn(key, text)
    name = F.when(F.col("slice") == 0, text).otherwise(F.concat_ws("#", text, F.col("slice").cast("string")))
    return folded.withColumn(key, name).drop("slice")


def user_lists(df: DataFrame, prefix: str, alg: str, date: str, n: int | None = None) -> DataFrame:
    """Fold ``(user_id, item_id, pos)`` per user, the whole list or its first ``n``, and pack it."""
    folded = sliced_key(fold_list(df, "user_id", "item_id", "pos", n), "user_id")
    return pack_kv(folded, "user_id", prefix, {"date": date, "alg": alg})


def default_list(df: DataFrame, prefix: str, alg: str, date: str, n: int) -> DataFrame:
    """The first ``n`` of ``(item_id, pos)`` under the key ``default``, one message."""
    head = df.orderBy("pos", "item_id").limit(n).withColumn("user_id", F.lit("default"))
    return user_lists(head, prefix, alg, date, n)


def slot_union(slots: Mapping[str, DataFrame]) -> DataFrame:
    """Full outer union of keyed payloads: one row per key, one column per slot.

    A slot's frame has ``key`` and the slot's column. Rows are stacked and merged by
    one partial aggregation; a key in any subset of the slots gives exactly one row.
    """
    stacked = None
    for name, frame in slots.items():
        part = frame.select("key", name)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy("key").agg(*[F.max(name).alias(name) for name in slots])
