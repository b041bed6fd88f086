"""Change messages: reading, routing by topic, parsing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumenrec.functions.text import base64_text
from lumenrec.operators.filters import require_fields
from lumenrec.operators.postings import COLLECTION_CATEGORY, PERSON_CATEGORY
from lumenrec.streaming.joins import interval_left_join, prefer_source

PROGRAM, LINKED, SUBJECT, PERSON = "program", "linked", "subject", "person"

PROGRAM_SCHEMA = "item_id string, category string, title string, risk bigint, status bigint, update_ts timestamp_ntz"
CONTENT_SCHEMA = "array<struct<item_id: string, category: string, title: string, status: string, provider: string>>"
LINKED_SCHEMA = f"canonical_id string, contents {CONTENT_SCHEMA}, update_ts timestamp_ntz"
SUBJECT_SCHEMA = "code string, title string, status bigint, update_ts timestamp_ntz"
PERSON_SCHEMA = "person_id string, name string, status bigint, update_ts timestamp_ntz"

SCHEMAS = {
    PROGRAM: PROGRAM_SCHEMA, LINKED: LINKED_SCHEMA, SUBJECT: SUBJECT_SCHEMA, PERSON: PERSON_SCHEMA,
}
# Fields a usable message must have.
REQUIRED = {
    PROGRAM: ["item_id", "category", "title", "risk", "status", "update_ts"],
    LINKED: ["canonical_id", "contents", "update_ts"],
    SUBJECT: ["code", "title", "status"],
    PERSON: ["person_id", "name", "status"],
}


def read_messages(
    spark: SparkSession, fmt: str = "kafka", schema: str | None = None, **options: str
) -> DataFrame:
    """Stream of ``(key, value, topic)`` strings.

    For Kafka pass ``kafka.bootstrap.servers`` and ``subscribe`` (a comma list of
    topics); for files that hold messages pass their schema and ``path``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("failOnDataLoss", "false")
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.options(**options).load()
    return stream.select(*[F.col(c).cast("string") for c in ("key", "value", "topic")])


def route(messages: DataFrame, topic: str, kind: str) -> DataFrame:
    """The messages of one topic, parsed with a declared schema; incomplete ones are dropped."""
    parsed = messages.where(F.col("topic") == topic).select(
        F.from_json("value", SCHEMAS[kind]).alias("m")
    )
    return require_fields(parsed.select("m.*"), REQUIRED[kind])


def explode_contents(linked: DataFrame) -> DataFrame:
    """One row per linked item of a message."""
    return linked.select("canonical_id", "update_ts", F.explode("contents").alias("c")).select(
        "canonical_id", "update_ts", "c.item_id", "c.category", "c.title",
        F.col("c.status").cast("bigint").alias("status"), "c.provider",
    )


def event_time(column: str) -> Column:
    """Watermarks need an instant, not a local date-time."""
    return F.col(column).cast("timestamp")


def changes(messages: DataFrame, topics: Mapping[str, str], provider: str | None = None) -> DataFrame:
    """Messages of all kinds as one stream of item changes.

    ``topics`` maps the kinds to topic names. Columns: ``item_id, category, title,
    risk, status, ts``. With a topic for linked contents, programs are joined with the
    contents that follow within an hour, and the ``provider``'s items are preferred;
    programs without contents wait until the watermark has passed that hour. A subject
    or person message without its own time counts as of now; both have risk 0.
    """
    columns = ["item_id", "category", "title", "risk", "status", "ts"]
    program = route(messages, topics[PROGRAM], PROGRAM).withColumn("ts", event_time("update_ts"))
    if LINKED in topics:
        linked = route(messages, topics[LINKED], LINKED).select(
            F.col("canonical_id").alias("key"), event_time("update_ts").alias("ts"), "contents"
        )
        heads = program.drop("update_ts").withColumn("key", F.col("item_id"))
        program = prefer_source(interval_left_join(heads, linked, "1 HOUR", "1 hour"), provider)
    now = F.coalesce(event_time("update_ts"), F.current_timestamp())
    none = F.lit(0).cast("bigint").alias("risk")
    subject = route(messages, topics[SUBJECT], SUBJECT).select(
        base64_text(F.col("code")).alias("item_id"), F.lit(COLLECTION_CATEGORY).alias("category"),
        "title", none, "status", now.alias("ts"),
    )
    person = route(messages, topics[PERSON], PERSON).select(
        F.col("person_id").alias("item_id"), F.lit(PERSON_CATEGORY).alias("category"),
        F.col("name").alias("title"), none, "status", now.alias("ts"),
    )
    return program.select(*columns).unionByName(subject).unionByName(person)
