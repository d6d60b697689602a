"""Row positions, ordering, shuffling and their audits, without a single-task sort.

Spark rows have no order, so every operator here takes an order key and gives
the place as a column. The sort is Spark's range-partitioned one: it splits on
the whole order key, so rows that share a date, a file or a group still spread
over many slices as long as the key's last part is unique. The sorted slices are
written to the shared scratch folder once; then only per-slice counts, a handful
of rows, go through a window to turn places within slices into global places.
A random order needs no such sort: its numbers are even, so they are cut at even
distances.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.functions.columns import quoted
from fleetloom.functions.dates import date_of_text
from fleetloom.functions.draws import draw
from fleetloom.operators.lookups import lookup
from fleetloom.session import scratch_table

# monotonically_increasing_id(): the slice above this bit, the row's place below.
_SLICE_SHIFT = 33

# Rows of one key, or of one piece of it, that one task may sort.
ROWS_PER_TASK = 500_000


def sorted_slices(
    df: DataFrame, order: Sequence[Column | str], label: str, keep: Sequence[Column] | None = None
) -> DataFrame:
    """The rows in sorted slices, kept in scratch, with ``_slice`` and ``_line``.

    ``_line`` grows along the order over all slices and without gaps inside one.
    ``order`` should end in a unique column, and be of columns rather than costly
    expressions. ``keep`` picks what is stored.
    """
    kept = list(keep) if keep is not None else [quoted(c) for c in df.columns]
    placed = df.orderBy(*order).select(*kept, F.monotonically_increasing_id().alias("_line"))
    stored = scratch_table(placed, label)
    return stored.withColumn("_slice", F.shiftright("_line", _SLICE_SHIFT))


def _sliced_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str
) -> DataFrame:
    """Number the rows of each key through sorted slices; a key may fill many of them."""
    sliced = sorted_slices(df, [*[quoted(k).asc_nulls_first() for k in keys], *order], name)
    renamed = {k: f"_key{i}" for i, k in enumerate(keys)}
    runs = sliced.groupBy("_slice", *[quoted(k).alias(renamed[k]) for k in keys]).agg(
        F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per slice and key: a key has at most as many rows here as there are slices.
    earlier = Window.partitionBy(*renamed.values()).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    runs = runs.select(F.col("_slice").alias("_run_slice"), *renamed.values(), shift.alias("_shift"))
    # Without keys there is one row per slice. With keys the stored size decides the join.
    runs = scratch_table(runs, f"{name}-runs") if keys else F.broadcast(runs)
    same = F.col("_slice") == F.col("_run_slice")
    for key, other in renamed.items():
        same = same & quoted(key).eqNullSafe(F.col(other))
    return sliced.join(runs, same).select(
        *[quoted(c) for c in df.columns], (F.col("_line") + F.col("_shift")).alias(name)
    )


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    """Rows per key, kept in scratch."""
    return scratch_table(df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(name)), "sizes")


def _of_sizes(df: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``sizes``, a null key too."""
    group = F.struct(*[quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return lookup(df.withColumn("_group", group), sizes.select(group.alias("_group")), ["_group"], "left_semi").drop("_group")


def index_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "pos",
    sizes: DataFrame | None = None,
    size: str = "rows",
    biggest: int | None = None,
) -> DataFrame:
    """Number the rows of each key from 0 along ``order``; no keys: all rows.

    Keys of up to ``ROWS_PER_TASK`` rows are numbered by a window. Larger ones go
    through sorted slices, so none is ever sorted by one task. ``sizes``, with the
    rows per key in column ``size``, and ``biggest`` save counting where the caller
    has them.
    """
    keys = list(keys)
    if not keys:
        return _sliced_index(df, keys, order, name)
    sizes = group_sizes(df, keys, size) if sizes is None else sizes
    numbered = (F.row_number().over(Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)) - 1).cast("bigint")
    biggest = (sizes.agg(F.max(size)).first()[0] or 0) if biggest is None else biggest
    if biggest <= ROWS_PER_TASK:
        return df.withColumn(name, numbered)
    small = _of_sizes(df, sizes.where(F.col(size) <= ROWS_PER_TASK), keys)
    large = _of_sizes(df, sizes.where(F.col(size) > ROWS_PER_TASK), keys)
    return small.withColumn(name, numbered).union(_sliced_index(large, keys, order, name))


def _cells_of(df: DataFrame, src_file: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """src_file, column, _o0, _o1, ... and cell (text) of every cell that is not null."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("cell")) for c in columns])
    placed = [quoted(c).alias(f"_o{i}") for i, c in enumerate(order)]
    exploded = df.select(quoted(src_file).alias("src_file"), *placed, F.explode(cells).alias("_c"))
    return exploded.where("_c.cell is not null").select("src_file", F.col("_c.column").alias("column"), *[f"_o{i}" for i in range(len(order))], F.col("_c.cell").alias("cell"))


def non_null_rank(df: DataFrame, src_file: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """src_file, column, rank (from 0 along ``order``), cell: every cell that is not null.

    Large files go through sorted slices, so none is sorted by one task.
    """
    cells = _cells_of(df, src_file, order, columns)
    ranked = index_within(cells, ["src_file", "column"], [f"_o{i}" for i in range(len(order))], "rank")
    return ranked.select("src_file", "column", "rank", "cell")


def first_non_null(df: DataFrame, src_file: str, order: Sequence[str], columns: Sequence[str], limit: int = 10) -> DataFrame:
    """The first ``limit`` cells that are not null of every file and column, ranked from 0.

    The limit goes in front of the shuffle: a task hands on that many cells per file and column at most.
    """
    cells = _cells_of(df, src_file, order, columns)
    place = Window.partitionBy("src_file", "column").orderBy(*[f"_o{i}" for i in range(len(order))])
    ranked = cells.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= limit)
    return ranked.select("src_file", "column", (F.col("_place") - 1).cast("bigint").alias("rank"), "cell")


def random_rank(
    df: DataFrame, keys: Sequence[str], size: Column, biggest: int, number: Column, tie: Sequence[str], name: str
) -> DataFrame:
    """Number the rows of each key from 0 along a random ``number`` below 2**60.

    As the numbers are spread evenly, a key of ``size`` rows is cut at even
    distances into pieces of about ``ROWS_PER_TASK`` rows. Pieces are sorted apart,
    and the counts of the pieces before a row's own give its rank. ``biggest`` is
    the largest size there is.
    """
    keys = list(keys)
    half = 30
    pieces = F.greatest(F.lit(1).cast("bigint"), F.ceil(size / F.lit(ROWS_PER_TASK)))
    cut = df.withColumn("_number", number).withColumn(
        "_piece", F.shiftright(F.shiftright("_number", half) * pieces, half)
    )
    of_piece = Window.partitionBy(*[quoted(k) for k in keys], "_piece")
    inside = (F.row_number().over(of_piece.orderBy("_number", *[quoted(t) for t in tie])) - 1).cast("bigint")
    columns = [quoted(c) for c in df.columns]
    if biggest <= ROWS_PER_TASK:
        return cut.withColumn(name, inside).select(*columns, name)
    renamed = {k: f"_key{i}" for i, k in enumerate(keys)}
    earlier = Window.partitionBy(*renamed.values()).orderBy("_cut_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row per piece: a millionth of the rows or less.
    starts = (
        cut.where(pieces > 1)
        .groupBy(*[quoted(k).alias(renamed[k]) for k in keys], F.col("_piece").alias("_cut_piece"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*renamed.values(), "_cut_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    starts = scratch_table(starts, f"{name}-pieces")
    same = F.col("_piece") == F.col("_cut_piece")
    for key, other in renamed.items():
        same = same & quoted(key).eqNullSafe(F.col(other))
    ranked = cut.withColumn("_inside", inside).join(starts, same, "left")
    return ranked.select(*columns, (F.col("_inside") + F.coalesce("_start", F.lit(0))).alias(name))


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """Number all rows from 0 along ``order``."""
    return index_within(df, [], order, name)


def running_totals(df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, Column]) -> DataFrame:
    """Sums over all earlier rows along ``order``, a column per name; 0 for the first row."""
    kept = [quoted(c) for c in df.columns]
    values = {name: f"_value{i}" for i, name in enumerate(totals)}
    sliced = sorted_slices(df, order, "-".join(totals), [*kept, *[totals[n].alias(v) for n, v in values.items()]])
    before_slice = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(v).alias(v) for v in values.values()])
        # One row per slice.
        .select("_slice", *[F.coalesce(F.sum(v).over(before_slice), F.lit(0)).alias(f"_start{v}") for v in values.values()])
    )
    before_row = Window.partitionBy("_slice").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    inside = {f"_inside{v}": F.coalesce(F.sum(v).over(before_row), F.lit(0)) for v in values.values()}
    return (
        sliced.withColumns(inside)
        .join(F.broadcast(starts), "_slice")
        .select(*kept, *[(F.col(f"_start{v}") + F.col(f"_inside{v}")).alias(n) for n, v in values.items()])
    )


def running_total(df: DataFrame, order: Sequence[Column | str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows along ``order``; 0 for the first."""
    return running_totals(df, order, {name: value})


def sort_by_text_date(df: DataFrame, column: str, tie: Sequence[str], name: str = "pos") -> DataFrame:
    """Number rows by the date a text column stands for; the text stays as it is.

    Rows without a date come last. ``tie`` orders the rows of one day and must be
    unique: it also lets one day's rows spread over several slices.
    """
    # The date is a column, as a sort would read it off the text at every comparison.
    dated = df.withColumn("_day", date_of_text(quoted(column)))
    return row_index(dated, [F.col("_day").asc_nulls_last(), *[quoted(t) for t in tie]], name).drop("_day")


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int, name: str = "pos") -> DataFrame:
    """Number the rows in a random order fixed by ``seed`` and the unique ``key``."""
    rows = df.count()
    return random_rank(df, [], F.lit(rows), rows, draw(seed, *[quoted(k) for k in key]), key, name)


def shuffle_right(
    df: DataFrame, left: Sequence[str], order: Sequence[Column | str], seed: int, name: str = "pos"
) -> DataFrame:
    """Keep the ``left`` columns in ``order``; deal the other columns out at random."""
    left = list(left)
    right = [c for c in df.columns if c not in left]
    indexed = row_index(df, order, name)
    fixed_side = indexed.select(name, *[quoted(c) for c in left])
    moved_side = shuffle_rows(
        indexed.select(F.col(name).alias("_from"), *[quoted(c) for c in right]), ["_from"], seed, name
    ).drop("_from")
    return zip_by_position(fixed_side, moved_side, name)


def zip_by_position(left: DataFrame, right: DataFrame, name: str = "pos") -> DataFrame:
    """Put two tables of equal length side by side."""
    return left.join(right, name)


def head_and_tail(df: DataFrame, order: Sequence[str], count: int = 10) -> DataFrame:
    """First and last ``count`` rows in order, told apart by ``part``."""
    first = df.orderBy(*[F.col(c).asc() for c in order]).limit(count).withColumn("part", F.lit("head"))
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(count).withColumn("part", F.lit("tail"))
    return first.union(last)


def _slice_drops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a sorted slice: its rows, nulls, drops, first and last value."""
    rows = nulls = drops = 0
    first = last = None
    for batch in batches:
        column = batch.column("_value")
        if not len(column):
            continue
        if rows:
            column = pa.concat_arrays([last, column])
        else:
            first = column.slice(0, 1)
        rows += len(batch)
        nulls += batch.column("_value").null_count
        drops += pc.sum(pc.less(column.slice(1), column.slice(0, len(column) - 1))).as_py() or 0
        last = column.slice(len(column) - 1)
    if rows:
        counts = [pa.array([n], pa.int64()) for n in (rows, nulls, drops)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), *counts, first, last],
            ["_slice", "_rows", "_nulls", "_drops", "_value", "_last"],
        )


def sortedness(df: DataFrame, order: Sequence[Column | str], value: Column) -> DataFrame:
    """How often ``value`` drops from one row to the next along ``order``.

    One row: ``rows``, ``nulls``, ``inversions``, ``is_sorted``. A null value makes
    the column unsorted.
    """
    drops = F.count_if(F.col("_value") < F.col("_previous"))
    values = df.orderBy(*order).select(value.alias("_value"))
    kind = values.schema["_value"].dataType.simpleString()
    slices = values.mapInArrow(
        _slice_drops, f"_slice int, _rows bigint, _nulls bigint, _drops bigint, _value {kind}, _last {kind}"
    ).withColumn("_previous", F.lag("_last").over(Window.orderBy("_slice")))  # one row per slice
    inversions = F.coalesce(F.sum("_drops"), F.lit(0)) + drops
    nulls = F.coalesce(F.sum("_nulls"), F.lit(0))
    return slices.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        nulls.alias("nulls"),
        inversions.alias("inversions"),
        ((inversions == 0) & (nulls == 0)).alias("is_sorted"),
    )


def multiset_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many rows were lost, and how many were added.

    Both tables go through one grouping that adds up map-side first.
    """
    columns = before.columns
    counted = before.select(*[quoted(c) for c in columns], F.lit(1).alias("_n")).union(
        after.select(*[quoted(c) for c in columns], F.lit(-1).alias("_n"))
    )
    balance = counted.groupBy(*[quoted(c) for c in columns]).agg(F.sum("_n").alias("_n"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0)).alias("added"),
    )


def shuffle_audit(before: DataFrame, after: DataFrame, name: str = "pos") -> DataFrame:
    """One row: of all places, how many hold the same row; rows lost and added."""
    columns = [c for c in before.columns if c != name]
    same = F.lit(True)
    for c in columns:
        same = same & F.col("b.`" + c + "`").eqNullSafe(F.col("a.`" + c + "`"))
    places = before.alias("b").join(after.alias("a"), name)
    none = F.lit(0).cast("bigint")
    stayed = places.agg(F.count(F.lit(1)).alias("compared"), F.count_if(same).alias("stayed"))
    moved = multiset_difference(before.drop(name), after.drop(name))
    both = stayed.select("*", none.alias("lost"), none.alias("added")).union(moved.select(none, none, "lost", "added"))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


# Executors need not have this package installed: the pass over slices travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
