"""Carrying all columns of a table through an operator, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.session import Scope, scratch_table

ROW = "_row"
# Keys of rows to leave out are sent to all tasks up to this many, so texts are not shuffled.
BROADCAST_ROWS = 500_000


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The given columns, and every column of ``df`` together in ``_row``."""
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    return df.select(*[c.alias(name) for name, c in columns.items()], whole.alias(ROW))


def unpacked(df: DataFrame, like: DataFrame, **instead: Column) -> DataFrame:
    """The columns of ``like`` out of ``_row``, with some of them replaced."""
    return df.select(
        *[instead.get(c, F.col(f"{ROW}.c{i}")).alias(c) for i, c in enumerate(like.columns)]
    )


def without(rows: DataFrame, keys: DataFrame, scope: Scope) -> DataFrame:
    """``rows`` but those whose doc_id and _text are among ``keys``; nulls equal nulls. The keys are kept from ``scope``."""
    keys = scope.keep(scratch_table(keys.select("doc_id", "_text").distinct(), "left-out"))
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    same = rows["doc_id"].eqNullSafe(keys["doc_id"]) & rows["_text"].eqNullSafe(keys["_text"])
    return rows.join(keys, same, "left_anti")


def among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose doc_id and _text are among ``keys``, a table in scratch without nulls."""
    keys = keys.select("doc_id", "_text")
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, ["doc_id", "_text"], "left_semi")
