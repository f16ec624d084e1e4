"""Deterministic per-row uniform numbers.

``rand(seed)`` depends on how rows are laid out in partitions, so a rerun on
another cluster (or after an executor loss) can move a flight from train to
test.  A hash of the key and a salt does not: the same flight always gets the
same number.  The first 32 bits of md5 are used because any SQL engine can
recompute them, which lets the split be checked independently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uniform01(key, seed, salt) -> Column:
    """U[0,1) from ``md5(key:seed:salt)``; identical on every engine and layout."""
    text = F.concat_ws(":", _col(key).cast("string"), F.lit(str(seed)), F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)
