"""Collections (subjects) and the pages they appear on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Page modes that mark a hot collection, and modes that hide one.
HOT_MODES = (2, 4, 7, 8)
HIDDEN_MODES = (2, 3, 4, 5, 6, 7, 8, 10)


def hot_collections(subjects: DataFrame, pages: DataFrame, modes: Sequence[int] = HOT_MODES) -> DataFrame:
    """Collections once per page of a hot mode."""
    shown = pages.where(F.col("mode").isin(*modes)).select("subject_id")
    return subjects.join(shown, subjects.id == shown.subject_id).select("code", "copyright")


def available_collections(
    subjects: DataFrame, pages: DataFrame, hidden: Sequence[int] = HIDDEN_MODES
) -> DataFrame:
    """Every collection, once per visible page and once where it has none."""
    shown = pages.where(~F.col("mode").isin(*hidden)).select("subject_id")
    return subjects.join(shown, subjects.id == shown.subject_id, "left").select("category", "code")
