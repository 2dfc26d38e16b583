"""Deterministic hash columns: unlike a seeded random column they survive a recomputed partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts: Column | str | int) -> Column:
    """Hexadecimal md5 of the parts joined by a bar."""
    return F.md5(F.concat_ws("|", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts]))


def range_of(hex_digest: Column, hex_digits: int) -> Column:
    """Leading digits of a digest as a number: evenly filled, order-preserving ranges."""
    return F.conv(F.substring(hex_digest, 1, hex_digits), 16, 10).cast("int")
