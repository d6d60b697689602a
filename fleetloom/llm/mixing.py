"""Mixing sources to target weights by a splitting tree of exact block quotas.

Documents are cut into blocks of words. Each source's blocks get a random order by hash;
the mix takes them in that order, pass after pass, up to the source's target, and the
last block is cut so that the target is met to the word. How many blocks that is, is the
source's quota. A tree then deals the quotas out among shards of equal size: a node halves
its shards, and how many blocks of each source go to the left half is a draw from the
multivariate hypergeometric distribution, as if all blocks had been shuffled together.
So a shard gets exact numbers of each source's blocks, the next ones of the random order,
which no other shard gets; inside a shard they are shuffled.

No step holds more than a shard's blocks, or one row per thousand sources, in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm import words
from fleetloom.operators.lookups import lookup
from fleetloom.operators.position import index_within, sorted_slices
from fleetloom.session import scratch_table

WEIGHTS = (1, 2, 3)
# No source is taken more often than this.
PASSES = 3
BLOCK_WORDS = 256
SHARD_BLOCKS = 8192
# Shards that one step of the tree makes out of a node, and sources that one task splits.
FAN, SOURCES_PER_GROUP = 64, 1024
SEED = 11
# numpy draws from populations below this; beyond, the normal of equal mean and variance, rounded, stands in.
POPULATION = 10**9


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        for first, last in words.slices(column):
            size = np.diff(words.texts_of(column, first, last).bounds)
            kept = [batch.column(c).slice(first, last - first) for c in ("doc_id", "source", "_text")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(size, pa.int64())], names=["doc_id", "source", "_text", "size"])


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, _text (``xxhash64(text)``) and size (words) of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", F.xxhash64("text").alias("_text"))
    return rows.mapInArrow(_count_words, "doc_id bigint, source string, _text bigint, size bigint")


def _share_beyond(level: Fraction, weight: str, size: str) -> Column:
    """Whether ``weight * level`` reaches ``PASSES * size``, in whole numbers."""

    def whole(n: int) -> Column:
        return F.lit(Decimal(n)).cast("decimal(19,0)")

    # A decimal product of more than 38 digits is null in Spark: 19 digits each leave room.
    left = F.col(weight).cast("decimal(19,0)") * whole(level.numerator)
    right = F.col(size).cast("decimal(19,0)") * whole(level.denominator * PASSES)
    return left >= right


def with_targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, _source, size, ...) with index, weight and target.

    Sources are numbered by code point, null last, and weigh 1, 2, 3, 1, ... The sum of
    all sizes is shared by weight; a share stops at three times its source's size, and
    the excess is shared again by weight among the others until none is above. A source
    without words, or all of them, has a target of 0.
    """
    numbered = index_within(sources, [], [F.col("source").asc_nulls_last()], "index")
    weights = F.array(*[F.lit(w).cast("bigint") for w in WEIGHTS])
    numbered = scratch_table(numbered.withColumn("weight", F.element_at(weights, (F.col("index") % len(WEIGHTS) + 1).cast("int"))), "sources")
    total, weight = numbered.agg(F.sum("size"), F.sum("weight")).first()
    level, before = Fraction(int(total or 0), int(weight or 1)), None
    while level != before:
        # One row a round; the level only rises, and each rise stops another source.
        before = level
        full = _share_beyond(level, "weight", "size")
        stopped, left = numbered.agg(F.sum(F.when(full, F.col("size") * PASSES)), F.sum(F.when(~full, F.col("weight")))).first()
        if left:
            level = Fraction(int(total) - int(stopped or 0), int(left))
    full = _share_beyond(level, "weight", "size")
    share = F.col("weight").cast("double") * F.lit(float(level))
    return numbered.withColumn("target", F.when(full, (F.col("size") * PASSES).cast("double")).otherwise(share))


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` are good."""
    if good + bad < POPULATION:
        return int(draw.hypergeometric(good, bad, taken))
    total = good + bad
    share = good / total
    spread = (taken * share * (1 - share) * ((total - taken) / max(1, total - 1))) ** 0.5
    return min(good, taken, max(0, taken - bad, round(taken * share + spread * draw.standard_normal())))


def split(draw: np.random.Generator, counts: np.ndarray, taken: int) -> np.ndarray:
    """A multivariate hypergeometric draw of ``taken`` from ``counts``."""
    total = int(counts.sum())
    if total < POPULATION:
        return draw.multivariate_hypergeometric(counts, taken, method="marginals") if total else np.zeros_like(counts)
    out = np.zeros_like(counts)
    for i, count in enumerate(counts.tolist()):
        total -= count
        out[i] = _hypergeometric(draw, count, total, taken)
        taken -= int(out[i])
    return out


def deal(draw: np.random.Generator, counts: np.ndarray, totals: list[int]) -> np.ndarray:
    """``counts`` split among bins of the given totals, by halves: a row per bin."""
    if len(totals) == 1:
        return counts[None, :]
    half = len(totals) // 2
    left = split(draw, counts, sum(totals[:half]))
    return np.vstack([deal(draw, left, totals[:half]), deal(draw, counts - left, totals[half:])])


def _children(first: int, last: int, fan: int) -> list[tuple[int, int]]:
    """The shards from ``first`` to ``last`` in at most ``fan`` runs."""
    parts = min(fan, last - first)
    edges = [first + (last - first) * i // parts for i in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _blocks_before(shard: int, shards: int, blocks: int) -> int:
    """Blocks in the shards before ``shard``: all of equal size, but for one block."""
    return blocks * shard // shards


CELLS = "first bigint, last bigint, part bigint, index bigint, count bigint"


def _deal_groups(shards: int, blocks: int, seed: int, fan: int):
    """A node's children get their share of each group of sources."""

    def run(table: pa.Table) -> pa.Table:
        first, last = table["first"][0].as_py(), table["last"][0].as_py()
        order = np.argsort(table["part"].to_numpy(), kind="stable")
        part, counts = table["part"].to_numpy()[order], table["count"].to_numpy()[order]
        runs = _children(first, last, fan)
        totals = [_blocks_before(b, shards, blocks) - _blocks_before(a, shards, blocks) for a, b in runs]
        dealt = deal(np.random.default_rng([seed, 0, first, last]), counts, totals)
        child, which = np.nonzero(dealt)
        ends = np.array(runs, dtype=np.int64)
        arrays = [np.full(len(child), first), np.full(len(child), last), part[which], ends[child, 0], ends[child, 1], dealt[child, which]]
        return pa.table([pa.array(a, pa.int64()) for a in arrays], names=["first", "last", "part", "child_first", "child_last", "total"])

    return run


def _deal_sources(seed: int):
    """A group's share of each child is split among its sources."""

    def run(sources: pa.Table, shares: pa.Table) -> pa.Table:
        first, last, part = (sources[c][0].as_py() for c in ("first", "last", "part"))
        order = np.argsort(sources["index"].to_numpy(), kind="stable")
        index, counts = sources["index"].to_numpy()[order], sources["count"].to_numpy()[order]
        by_child = np.argsort(shares["child_first"].to_numpy(), kind="stable")
        firsts, lasts = shares["child_first"].to_numpy()[by_child], shares["child_last"].to_numpy()[by_child]
        dealt = deal(np.random.default_rng([seed, 1, first, last, part]), counts, shares["total"].to_numpy()[by_child].tolist())
        child, which = np.nonzero(dealt)
        arrays = [firsts[child], lasts[child], np.full(len(child), part), index[which], dealt[child, which]]
        return pa.table([pa.array(a, pa.int64()) for a in arrays], names=["first", "last", "part", "index", "count"])

    return run


def shard_quotas(quotas: DataFrame, shards: int, blocks: int, seed: int = SEED) -> DataFrame:
    """shard, index, count: how many of each source's blocks each shard gets.

    ``quotas`` has index and count, ``blocks`` in all. A step splits every node into up
    to ``FAN`` runs of shards: first the groups of ``SOURCES_PER_GROUP`` sources, then the
    sources within each group and node, so a task holds one row per group or one group.
    """
    cells = quotas.where("count > 0").select(
        F.lit(0).cast("bigint").alias("first"), F.lit(shards).cast("bigint").alias("last"), F.expr(f"index div {SOURCES_PER_GROUP}").alias("part"), "index", "count"
    )
    node = ["first", "last"]
    widest = shards
    while widest > 1:
        groups = cells.groupBy(*node, "part").agg(F.sum("count").alias("count"))
        shares = groups.groupBy(*node).applyInArrow(
            _deal_groups(shards, blocks, seed, FAN), "first bigint, last bigint, part bigint, child_first bigint, child_last bigint, total bigint"
        )
        cells = cells.groupBy(*node, "part").cogroup(shares.groupBy(*node, "part")).applyInArrow(_deal_sources(seed), CELLS)
        cells = scratch_table(cells, "shard-quotas")
        widest = -(-widest // min(FAN, widest))
    return cells.select(F.col("first").alias("shard"), "index", "count")


def mix(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix, the sources and the sizes of all rows, each a table in scratch.

    mix: shard, place (from 0), doc_id, source, _text, copies, first, length: words
    ``first`` to ``first + length`` of a document, of each of its ``copies`` equal rows.
    sources: source, _source, size, index, weight, target and quota (words, whole).
    rows: doc_id, source, _text, size.

    A null text has no words; a null source is one of its own, named last. Rows equal in
    doc_id, source and text are one document, taken together; a null doc_id is an id
    like any other. Taken words of a source meet its target but for rounding and, where a
    document stands in many equal rows, fewer words than it has copies. Columns other than
    doc_id, source and text are not looked at. Empty tables and texts give no blocks.
    """
    rows = scratch_table(sized(docs), "sizes")
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    folded = rows.groupBy("doc_id", "source", "_text").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    folded = scratch_table(folded.withColumn("_blocks", F.ceil(F.col("size") / block_words)), "mixed-documents")
    sources = folded.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"), F.sum("_blocks").alias("blocks"))
    sources = with_targets(sources.withColumn("_source", key))
    quota = F.least(F.round("target").cast("bigint"), F.col("size") * PASSES)
    sources = scratch_table(sources.withColumn("quota", quota), "targets")

    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(block_words).cast("bigint")))
    blocks = folded.where("size > 0").select("doc_id", "source", "_text", "copies", "size", start.alias("first"))
    blocks = blocks.select(
        key.alias("_source"),
        F.xxhash64(F.lit(seed), "doc_id", "_text", "first").alias("_order"),
        *["doc_id", "source", "_text", "copies", "first"],
        F.least(F.lit(block_words).cast("bigint"), F.col("size") - F.col("first")).alias("length"),
    )
    order = [F.col(c) for c in ("_source", "_order", "doc_id", "_text", "first")]
    entries = scratch_table(_drawn(sorted_slices(blocks, order, "blocks"), sources), "drawn-blocks")

    quotas = scratch_table(entries.groupBy("index").agg(F.count(F.lit(1)).alias("count")), "quotas")
    total = quotas.agg(F.sum("count")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    cells = shard_quotas(quotas, shards, total, seed)
    upto = F.sum("count").over(Window.partitionBy("index").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.withColumn("_low", F.coalesce(upto, F.lit(0).cast("bigint"))).withColumn("_high", F.col("_low") + F.col("count"))
    # Runs of places as long as a mean share: a run meets few shards, a shard few runs.
    steps = quotas.select("index", F.greatest(F.lit(1).cast("bigint"), F.expr(f"count div {shards}")).alias("_step"))
    cells = cells.drop("count").join(steps, "index").withColumn("_run", F.expr("explode(sequence(_low div _step, (_high - 1) div _step))"))
    cells = scratch_table(cells.drop("_step"), "shard-places")
    placed = lookup(entries, steps, ["index"], "inner").withColumn("_run", F.expr("position div _step")).join(cells, ["index", "_run"])
    placed = placed.where("position >= _low and position < _high")
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "index", "position"), "index", "position")
    placed = placed.withColumn("place", (F.row_number().over(shuffled) - 1).cast("bigint"))
    return scratch_table(placed.select("shard", "place", "doc_id", "source", "_text", "copies", "first", "length"), "mix"), sources, rows


def _drawn(sliced: DataFrame, sources: DataFrame) -> DataFrame:
    """The blocks that the mix takes, once per pass, with their position among those of their source."""
    inside = Window.partitionBy("_source", "_slice").orderBy("_line")
    weight = F.col("length") * F.col("copies")
    earlier = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and source.
    starts = sliced.groupBy("_source", "_slice").agg(F.count(F.lit(1)).alias("_rows"), F.sum(weight).alias("_words"))
    starts = starts.select("_source", "_slice", *[F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("bigint")).alias(c) for c in ("_rows", "_words")])
    own = sliced.withColumn("_at", F.row_number().over(inside) - 1).withColumn(
        "_upto", F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    )
    own = own.join(scratch_table(starts, "block-starts"), ["_source", "_slice"])
    wanted = sources.select("_source", "index", "quota", F.col("size").alias("_size"), F.col("blocks").alias("_blocks"))
    own = lookup(own, wanted, ["_source"], "inner").withColumn("_at", F.col("_at") + F.col("_rows")).withColumn("_upto", F.col("_upto") + F.col("_words"))
    own = own.withColumn("_last", F.expr("greatest(0L, least(length, (quota % _size - _upto) div copies))"))
    full = F.expr("quota div _size")
    own = own.withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("bigint"), full))).withColumn("length", F.when(F.col("_pass") < full, F.col("length")).otherwise(F.col("_last")))
    return own.where("length > 0").select(
        "index", "doc_id", "source", "_text", "copies", "first", "length", (F.col("_pass") * F.col("_blocks") + F.col("_at")).alias("position")
    )


PIECES = "shard bigint, place bigint, copies bigint, first bigint, length bigint"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        for first, last in words.slices(column):
            texts = words.texts_of(column, first, last)
            pieces = batch.column("pieces").slice(first, last - first)
            row = np.repeat(np.arange(last - first), pieces.value_lengths().to_numpy())
            flat = pieces.flatten()
            begin = texts.bounds[:-1][row] + flat.field("first").to_numpy()
            end = begin + flat.field("length").to_numpy() - 1
            data = memoryview(np.ascontiguousarray(texts.data))
            cut = [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(texts.starts[begin], texts.ends[end], strict=True)]
            kept = [batch.column(c).slice(first, last - first).take(pa.array(row)) for c in ("doc_id", "source")]
            numbers = ["shard", "place", "copies", "first", "length"]
            yield pa.RecordBatch.from_arrays([*kept, *[flat.field(c) for c in numbers], pa.array(cut, pa.string())], names=["doc_id", "source", *numbers, "text"])


def mixed_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The pieces of the mix with their texts, from first word to last: doc_id, source, shard, place, copies, first, length, text.

    A text is carried once, with all its pieces.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", F.xxhash64("text").alias("_text"))
    texts = texts.groupBy("doc_id", "source", "_text").agg(F.any_value("text").alias("text"))
    pieces = mixed.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_text").alias("_t")).agg(
        F.collect_list(F.struct("shard", "place", "copies", "first", "length")).alias("pieces")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_text") == F.col("_t"))
    joined = texts.join(pieces, same).select("doc_id", "source", "text", "pieces")
    return joined.mapInArrow(_cut, f"doc_id bigint, source string, {PIECES}, text string")


def digest(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, size, source_size, target, taken, and where the mix has it first.

    ``n_pieces`` counts its pieces over all passes; ``first_shard`` and ``first_place``
    are those of the first of them, null if none is taken.
    """
    mixed, sources, rows = mix(docs)
    taken = mixed.groupBy("doc_id", "source", "_text").agg(
        F.sum("length").alias("taken"), F.count(F.lit(1)).alias("n_pieces"), F.min(F.struct("shard", "place")).alias("_first")
    )
    taken = scratch_table(taken.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_text").alias("_t"), "taken", "n_pieces", "_first"), "taken")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_text") == F.col("_t"))
    rows = rows.join(taken, same, "left").withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    rows = lookup(rows, sources.select("_source", F.col("size").alias("source_size"), "target"), ["_source"], "inner")
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", zero).alias("taken"),
        F.coalesce("n_pieces", zero).alias("n_pieces"),
        F.col("_first.shard").alias("first_shard"),
        F.col("_first.place").alias("first_place"),
    )
