"""Joins of many rows to at most one row per key, whatever the key's share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.functions.columns import quoted
from fleetloom.session import scratch_table

# A lookup side of at most this many rows, with at most this much text, is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def text_bytes(*columns: str) -> Column:
    """Bytes of the rows' values as text, added up."""
    return F.coalesce(F.sum(F.octet_length(F.concat_ws("", *[quoted(c).cast("string") for c in columns]))), F.lit(0))


def is_small(rows: int, size: int) -> bool:
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    """True if ``df`` is small enough to be broadcast; counted in one pass."""
    return is_small(*df.agg(F.count(F.lit(1)), text_bytes(*df.columns)).first())


def lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", small: bool | None = None
) -> DataFrame:
    """Join ``rows`` to ``table``, which has at most one row per key.

    A table of checked small size is broadcast, so ``rows`` is not shuffled. A
    larger one is written first, so that both sides come straight from a shuffle and
    adaptive execution can split the rows of a hot key, also equal ones or those
    without a key, over as many tasks as their size asks for.

    The size check computes ``table`` once more, so keep one that takes a pass over
    large data in scratch; or say whether it is ``small`` where that is known.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"a lookup keeps the rows' side; {how!r} does not")
    on = list(on)
    if fits_broadcast(table) if small is None else small:
        return rows.join(F.broadcast(table), on, how)
    return rows.join(scratch_table(table, "lookup"), on, how)
