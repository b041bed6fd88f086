"""Text expressions used by the search jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Kept character ranges and token shape.
NOT_WORD = "[^\\u4e00-\\u9fa5a-zA-Z0-9]+"
NOT_WORD_OR_SPACE = "[^\\u4e00-\\u9fa5a-zA-Z0-9\\s]+"
CJK = "[\\u4e00-\\u9fa5]"
TOKEN = "[\\u4e00-\\u9fa5]|[0-9]+|[a-zA-Z]+"


def clean_title(title: Column) -> Column:
    """Only ideographs, ASCII letters and digits stay."""
    return F.regexp_replace(title, NOT_WORD, "")


def clean_keep_space(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, NOT_WORD_OR_SPACE, ""))


def has_cjk(text: Column) -> Column:
    return F.coalesce(text.rlike(CJK), F.lit(False))


def title_tokens(title: Column) -> Column:
    """One token per ideograph, per digit run and per letter run; the rest is skipped."""
    return F.regexp_extract_all(clean_keep_space(title), F.lit(TOKEN), F.lit(0))


def base64_text(text: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line; null and empty become null."""
    encoded = F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "[\\r\\n]", "")
    return F.when(text != "", encoded)


def unbase64_text(code: Column) -> Column:
    return F.when(code != "", F.decode(F.unbase64(code), "UTF-8"))


def word_terms(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script, over the whole text."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda t: t != "")


def ppm(value: Column) -> Column:
    """A score as whole millionths, half up."""
    return F.floor(value * F.lit(1000000.0) + F.lit(0.5)).cast("bigint")
