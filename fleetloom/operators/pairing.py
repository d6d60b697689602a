"""Putting two bands of each key side by side, the second topped up by sampling.

Keys can be of any size: the rows of a large key are numbered in slices, and the
sampled side is joined on key and row number, so a large key's rows never meet in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions.columns import quoted
from fleetloom.functions.draws import draw
from fleetloom.operators.lookups import is_small, lookup, text_bytes
from fleetloom.operators.position import index_within, random_rank
from fleetloom.session import scratch_table

# Left rows that may share one copy of a right row.
ROWS_PER_COPY = 100_000


def matched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with ``side``."""
    lefts, rights = left.select(key).distinct(), right.select(key).distinct()
    only_left = lefts.join(rights, key, "left_anti").withColumn("side", F.lit("left"))
    only_right = rights.join(lefts, key, "left_anti").withColumn("side", F.lit("right"))
    return only_left.union(only_right)


def pair_sizes(left: DataFrame, right: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """Rows of each side per key: of the keys on both sides, or of the given ones."""
    counts = (
        left.select(quoted(key).alias(key), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .union(right.select(quoted(key).alias(key), F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(key)
        .agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    )
    if keys is None:
        return counts.where((F.col("left_rows") > 0) & (F.col("right_rows") > 0))
    return (
        keys.select(key)
        .distinct()
        .join(counts, key, "left")
        .na.fill(0, ["left_rows", "right_rows"])
    )


def zip_rows(left: DataFrame, right: DataFrame, key: str, name: str = "pos") -> DataFrame:
    """Join two numbered tables on key and place; the shorter side is filled with nulls."""
    return left.join(right, [key, name], "full")


def pair_rows(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_order: Sequence[Column | str],
    right_order: Sequence[Column | str],
    seed: int = fixed.BASE_SEED,
    prefixes: tuple[str, str] = ("low_", "medium_"),
    keys: DataFrame | None = None,
    name: str = "pos",
) -> DataFrame:
    """Put the left and right rows of each key side by side, numbered by ``name``.

    Where the right side is shorter, every right row is used once, the missing
    rows are drawn from it with replacement, and all are dealt out at random.
    Where it is not, it stays in order and the left side is filled with nulls. A
    key with left rows but no right ones gives nothing, and neither do rows without a
    key: they belong to no pair of files. ``pair_sizes`` does not count them either.

    Without ``keys``, only keys with rows on both sides are paired.
    """
    left_names = [c for c in left.columns if c != key]
    right_names = [c for c in right.columns if c != key]
    sizes = scratch_table(pair_sizes(left, right, key, keys).withColumnRenamed(key, "_key"), "pair-sizes")
    sizes = sizes.where("right_rows > 0")
    key_count, key_bytes, most_left, most_right = sizes.agg(
        F.count(F.lit(1)),
        text_bytes(*sizes.columns),
        F.coalesce(F.max("left_rows"), F.lit(0)),
        F.coalesce(F.max("right_rows"), F.lit(0)),
    ).first()
    few_keys = is_small(key_count, key_bytes)

    # Each left row is a slot. Its rank in a random order of the key's slots says
    # which right row it takes: a rank below the right side's size takes that very
    # row, a rank beyond it takes a drawn one.
    left_sized = lookup(left.withColumnRenamed(key, "_key"), sizes, ["_key"], "inner", few_keys)
    slots = index_within(left_sized, ["_key"], left_order, "_pos", sizes, "left_rows", most_left)
    topped_up = F.col("right_rows") < F.col("left_rows")
    ranked = random_rank(
        slots,
        ["_key"],
        F.col("left_rows"),
        most_left,
        draw(seed, F.col("_key"), F.col("_pos")),
        ["_pos"],
        "_rank",
    ).withColumn("_rank", F.when(topped_up, F.col("_rank")).otherwise(F.col("_pos")))
    drawn = F.pmod(draw(seed + 1, F.col("_key"), F.col("_rank")), F.col("right_rows"))
    # A right row wanted by very many left rows is copied, and they share the copies.
    copies = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("left_rows") / F.col("right_rows") / F.lit(ROWS_PER_COPY)))
    takers = ranked.select(
        "_key",
        F.when(F.col("_rank") < F.col("right_rows"), F.col("_rank"))
        .otherwise(drawn)
        .alias("_take"),
        F.pmod(F.col("_rank"), copies).alias("_copy"),
        "_pos",
        *[quoted(c).alias(prefixes[0] + c) for c in left_names],
    )
    right_sized = lookup(right.withColumnRenamed(key, "_key"), sizes, ["_key"], "inner", few_keys)
    offered = index_within(right_sized, ["_key"], right_order, "_take", sizes, "right_rows", most_right).select(
        "_key",
        "_take",
        F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)).alias("_copy"),
        (F.col("right_rows") >= F.col("left_rows")).alias("_unshuffled"),
        *[quoted(c).alias(prefixes[1] + c) for c in right_names],
    )
    zipped = takers.join(offered, ["_key", "_take", "_copy"], "full")
    return zipped.where(F.col("_pos").isNotNull() | F.col("_unshuffled")).select(
        F.col("_key").alias(key),
        F.coalesce("_pos", "_take").alias(name),
        *[quoted(prefixes[0] + c) for c in left_names],
        *[quoted(prefixes[1] + c) for c in right_names],
    )


def pair_report(sizes: DataFrame, key: str, seed: int = fixed.BASE_SEED) -> DataFrame:
    """Per key: rows of each side, rows of the topped-up side and of the result."""
    failed = (F.col("right_rows") == 0) & (F.col("left_rows") > 0)
    longer = F.greatest("left_rows", "right_rows")
    return sizes.select(
        key,
        "left_rows",
        "right_rows",
        F.when(failed, F.lit(0).cast("bigint")).otherwise(longer).alias("aligned_rows"),
        F.when(failed, F.lit(0).cast("bigint")).otherwise(longer).alias("merged_rows"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.lit(seed).cast("bigint").alias("seed"),
    )
