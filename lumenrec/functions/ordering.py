"""Repeatable pseudo-random order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def shuffle_digest(seed: int | str, *parts: str) -> Column:
    """Hex digest that orders rows at random but the same way on every run and engine."""
    pieces: list[Column] = [F.lit(str(seed))]
    pieces += [F.col(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *pieces))


def digest_number(*parts: str) -> Column:
    """First 32 bits of the digest of the given columns, as a non-negative bigint."""
    digest = F.md5(F.concat_ws(":", *[F.col(p).cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
