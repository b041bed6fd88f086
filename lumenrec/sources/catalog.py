"""Named sources: which table, which columns, which rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class SourceSpec:
    """A scan: table name, kept columns and an SQL predicate (both reach the reader)."""

    table: str
    columns: tuple[str, ...]
    predicate: str = "true"

    def read(self, table_reader: Callable[[str], DataFrame]) -> DataFrame:
        return table_reader(self.table).where(self.predicate).select(*self.columns)


# The six long-form categories of the sample catalogue.
LONG_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

VALID_ITEM = "item_id is not null and title is not null and status = 1 and feature_type = 1"

CATALOG: dict[str, SourceSpec] = {
    "long_items": SourceSpec("items", ("item_id", "category", "title", "risk"), VALID_ITEM),
    "short_items": SourceSpec(
        "short_items",
        ("item_id", "category", "title", "risk"),
        "item_id is not null and title is not null and risk is not null",
    ),
    "collections": SourceSpec("collections", ("code", "title"), "code is not null and title is not null"),
    "people": SourceSpec("people", ("person_id", "name"), "person_id is not null and name is not null"),
    "collection_links": SourceSpec(
        "collection_links",
        ("item_id", "code", "category"),
        "item_id is not null and code is not null and category is not null",
    ),
    "editor_picks": SourceSpec("items", ("item_id", "category"), "rating >= 48 and status = 1"),
    **{
        f"available_{category.lower()}": SourceSpec(
            "items", ("item_id", "category"), f"{VALID_ITEM} and category = '{category}'"
        )
        for category in LONG_CATEGORIES
    },
}


def source(tag: str) -> SourceSpec:
    """Look a source up; an unknown tag is an error, not an empty table."""
    try:
        return CATALOG[tag]
    except KeyError:
        raise KeyError(f"unknown source tag {tag!r}; known: {sorted(CATALOG)}") from None


def scan(table: DataFrame, columns: Iterable[str], predicate: str) -> DataFrame:
    """Plain filtered, pruned scan."""
    return table.where(predicate).select(*columns)


def available_items(items: DataFrame, category: str) -> DataFrame:
    """Items of one category that can be shown."""
    return items.where(VALID_ITEM).where(F.col("category") == category).select("item_id", "category")


def sql_scan(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Warehouse scan in SQL; ``{name}`` in the text stands for the table passed as ``name``."""
    return spark.sql(text, **tables)


def only_category(df: DataFrame, category: str) -> DataFrame:
    """Category selector; ``"all"`` keeps every row."""
    return df if category == "all" else df.where(F.col("category") == category)


def catalog_counts(table_reader: Callable[[str], DataFrame]) -> DataFrame:
    """Rows behind every tag, one pass per underlying table."""
    by_table: dict[str, list[str]] = {}
    for tag, spec in CATALOG.items():
        by_table.setdefault(spec.table, []).append(tag)
    parts = []
    for table, tags in by_table.items():
        counts = table_reader(table).agg(
            *[F.count_if(F.expr(CATALOG[tag].predicate)).alias(tag) for tag in tags]
        )
        parts.append(counts.unpivot([], tags, "source", "n_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
