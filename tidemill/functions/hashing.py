"""Keyed hashing, the one source of randomness: any engine can repeat it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_md5(*parts: Column | int | str) -> Column:
    """md5 of the parts joined by colons, as 32 hex digits."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws(":", *(c.cast("string") for c in columns)))


def hex_number(digest: Column, start: int, length: int) -> Column:
    """``length`` hex digits of a digest, counted from 1, as a number."""
    return F.conv(F.substring(digest, start, length), 16, 10).cast("long")
