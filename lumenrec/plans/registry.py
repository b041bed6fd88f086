"""Registry of runnable queries, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenrec.plans.inputs import INPUT_SQL, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **shared: str) -> Callable:
    """Register ``fn(inputs) -> DataFrame``.

    ``sql`` is the DuckDB text; names of derived inputs used in it (and ``shared``
    sub-queries) are added in front as common table expressions.
    """

    def register(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_inputs(sql, shared)
        return fn

    return register


def with_inputs(sql: str, shared: dict[str, str] | None = None) -> str:
    """Prefix the common table expressions a query needs, in dependency order."""
    known = {**INPUT_SQL, **(shared or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for cte, body in known.items():
            if cte not in needed and re.search(rf"\b{cte}\b", text):
                needed.add(cte)
                visit(body)

    visit(sql)
    ctes = ",\n".join(f"{cte} AS ({body.strip()})" for cte, body in known.items() if cte in needed)
    return f"WITH {ctes}\n{sql.strip()}" if ctes else sql.strip()
