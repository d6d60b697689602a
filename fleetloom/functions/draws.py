"""Reproducible random numbers: a hash of the seed and a row's key.

The number of a row does not depend on how the data is partitioned or in which
order tasks run, so a lost task that is run again draws the same numbers.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, *keys: Column) -> Column:
    """A whole number below 2**60 for the seed and the keys' texts.

    Give whole numbers, dates or texts as keys: the text of a double is not the
    same everywhere.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def new_seed() -> int:
    """A seed to use, and to report, where the caller gives none."""
    return secrets.randbelow(2**32)
