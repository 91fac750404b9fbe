"""Random-looking but repeatable numbers out of row keys.

A row keeps its number whatever the partitioning, so a re-run task or a lost executor gives the
same sample or split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 2**32


def digest(key: Column, seed: int | None = None) -> Column:
    text = key.cast("string")
    if seed is not None:
        text = F.concat_ws("#", text, F.lit(str(seed)))
    return F.md5(text.cast("binary"))


def bucket(key: Column, seed: int | None = None) -> Column:
    """First 32 bits of the digest as a long."""
    return F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("bigint")


def fraction(key: Column, seed: int | None = None) -> Column:
    """The bucket as a number in [0, 1)."""
    return bucket(key, seed) / F.lit(float(BUCKETS))
