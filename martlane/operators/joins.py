"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup_key(key: str, row_id: str, zero_is_none: bool = False) -> Column:
    """A join key for an optional reference, NULL (or 0) where there is none.

    As a shuffle key the missing references would all land in one task.  They get a key of
    their own below zero, which no id has, so they are dealt evenly and match nothing.
    """
    k = F.col(key)
    there = k > 0 if zero_is_none else k.isNotNull()
    return F.when(there, k).otherwise(-1 - F.xxhash64(row_id).bitwiseAND(F.lit((1 << 62) - 1)))
