"""Repeatable randomness: a hash of seed and key, so results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(seed: int | str, *keys: Column | str) -> Column:
    """Hex digest that orders rows at random, the same way on every run."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(seed: int | str, key: Column | str, draw: str) -> Column:
    """Uniform double in [0, 1) for one named draw of one row (52 random bits)."""
    digest = shuffle_key(seed, key, F.lit(draw))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
