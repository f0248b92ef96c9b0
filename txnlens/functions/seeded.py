"""Reproducible pseudo-randomness from a row key.

``rand(seed)`` depends on the partitioning. A hash of (seed, key) gives the same number
for the same row on any cluster, and in any SQL engine with ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_digest(seed: int | str, *keys: Column) -> Column:
    """md5 of the seed and the keys; a null key has a digest of its own."""
    parts: list[Column] = [F.lit(str(seed))]
    for key in keys:
        parts += [F.lit("-"), F.coalesce(key.cast("string"), F.lit("\u0000"))]
    return F.md5(F.concat(*parts))


def digest_number(digest: Column) -> Column:
    """First 60 bits of a hex digest as a long in ``[0, 2**60)``."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def seeded_uniform(seed: int | str, *keys: Column) -> Column:
    """Double in ``[0, 1)``."""
    return digest_number(seeded_digest(seed, *keys)).cast("double") / F.lit(float(2**60))


def seeded_pick(size: Column, seed: int | str, *keys: Column) -> Column:
    """Long in ``[0, size)``."""
    return F.pmod(digest_number(seeded_digest(seed, *keys)), size.cast("long"))
