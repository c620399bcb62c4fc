"""Reproducible pseudo-random values: the same for an id and a seed under any partitioning or retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPAN = 1 << 32


def seeded_hash(key: Column | str, seed: int | str) -> Column:
    """Uniform integer in [0, 2^32) from the first 8 hex digits of ``md5(key|seed)``."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
