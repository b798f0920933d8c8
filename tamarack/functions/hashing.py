"""Seeded keys for sampling.

The key is the same for a row whatever its partition, so a sample does not change when a lost
task is run again or the input is split another way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS = 52


def sample_key(seed: int, *ids: Column) -> Column:
    """Uniform integer in [0, 2^52) from a seed and a stable row identity."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def sample_uniform(seed: int, *ids: Column) -> Column:
    """Uniform double in [0, 1)."""
    return sample_key(seed, *ids) / F.lit(float(2**KEY_BITS))
