"""Vectors stored as delimited text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def parse_vector_lines(lines: DataFrame, dim: int, sep: str = ",") -> DataFrame:
    """``id,<anything>,v1,…,v_dim`` → ``(item_id, vector)``; the last ``dim`` fields count."""
    fields = F.split(F.col("value"), sep)
    return lines.where(F.size(fields) > dim).select(
        F.element_at(fields, 1).alias("item_id"),
        F.slice(fields, -dim, dim).cast("array<double>").alias("vector"),
    )


def read_vector_text(spark: SparkSession, path: str, dim: int = 128) -> DataFrame:
    return parse_vector_lines(spark.read.text(path), dim)
