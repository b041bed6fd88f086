"""Dates relative to a reference time that the caller passes in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text forms used in keys and messages.
DAY_KEY, DAY_DASHED, SECONDS = "yyyyMMdd", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"


def days_before(reference: Column, days: int, form: str = DAY_DASHED) -> Column:
    """The reference time minus whole days, as text (24-hour clock)."""
    return F.date_format(reference - F.make_dt_interval(F.lit(days)), form)
