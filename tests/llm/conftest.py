from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """``docs((id, text), …)`` → documents, with columns whose names the operators use themselves."""

    def make(*rows, extra=True):
        full = [(i, t, "en", "s1", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if extra:
            for name in ("score", "fp", "key", "n", "bin_id", "spans", "part", "range", "Word", "kept_id", "quality_score"):
                df = df.selectExpr("*", f"'clash' as {name}")
        return df

    return make


LONG = "alpha beta gamma delta " * 3000


@pytest.fixture
def hard(docs):
    """Nulls, empty and blank texts, repeated rows, one id with two texts, no id, a long text."""
    return docs(
        (1, None), (2, ""), (3, " \t\n "), (4, "one two three four five"), (4, "one two three four five"),
        (5, "one two three four six"), (5, "another text under the same id"), (None, "no id here at all"), (None, None),
        (6, LONG), (7, LONG), (8, "Ünïcode — ñandú x 日本語 🙂 end"), (9, "a"),
    )


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")
