"""Reproducible pseudo-random keys, equal on every engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def order_digest(seed: int, row_id: Column) -> Column:
    """Sort key of a seeded shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")))


def hash_bucket(token: Column, buckets: Column | int) -> Column:
    """Map a string to ``0 .. buckets-1`` by the first 32 bits of its digest."""
    size = F.lit(buckets) if isinstance(buckets, int) else buckets
    head = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, size.cast("bigint"))
