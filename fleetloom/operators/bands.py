"""Splitting rows into value bands, which may overlap."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom import fixed
from fleetloom.functions.columns import quoted
from fleetloom.operators.lookups import fits_broadcast
from fleetloom.operators.position import running_totals
from fleetloom.session import scratch_table


class Band(NamedTuple):
    """Values from ``lo`` to ``hi``, both included."""

    lo: float
    hi: float
    label: str


def parse_band(text: str) -> Band:
    """A band written as min,max,label."""
    parts = text.split(",")
    if len(parts) != 3:
        raise ValueError(f"band {text!r} should be min,max,label")
    return Band(float(parts[0]), float(parts[1]), parts[2])


DEFAULT_BANDS = tuple(parse_band(text) for text in fixed.DEFAULT_BANDS)


def number(df: DataFrame, value: str) -> Column:
    """The column as a number; text that is none counts as no value."""
    return quoted(value).try_cast("double") if isinstance(df.schema[value].dataType, T.StringType) else quoted(value)


def in_band(df: DataFrame, value: str, band: Band) -> Column:
    return number(df, value).between(F.lit(band.lo), F.lit(band.hi))


def band_filter(df: DataFrame, value: str, band: Band) -> DataFrame:
    """Rows inside the band; rows without a value drop out."""
    return df.where(in_band(df, value, band))


def band_fan_out(df: DataFrame, value: str, bands: Iterable[Band] = DEFAULT_BANDS, label: str = "range_label") -> DataFrame:
    """One copy of a row for every band it is in; one scan, no shuffle."""
    labels = F.array(*[F.when(in_band(df, value, b), F.lit(b.label)) for b in bands])
    return df.withColumn(label, F.explode(F.array_compact(labels)))


# Lengths of bands of a table are told apart by powers of this: a band lies in so many cells, and one more, at most.
_CELL_BASE = 4.0
# The level of bands without bounds, which have one cell.
_UNBOUNDED = 2000


def _cell(value: Column, level: Column) -> Column:
    """The cell of a level that a value is in."""
    return F.when(level == _UNBOUNDED, F.lit(0).cast("bigint")).otherwise(F.floor(value / F.pow(F.lit(_CELL_BASE), level)).cast("bigint"))


def band_table_join(
    df: DataFrame,
    value: str,
    table: DataFrame,
    lo: str = "lo",
    hi: str = "hi",
    label: str = "label",
    name: str = "range_label",
    totals: Mapping[str, str] | None = None,
    rows_name: str = "rows",
) -> DataFrame:
    """One copy of a row for every band of ``table`` it is in, bounds included; any number of bands.

    A band belongs to the level whose cells are about as long as it is, and lies in a few
    of them; a row looks into its cell of every level there is. So rows and bands meet by
    equal cells, and no row is compared with bands far from it. The bands are broadcast if
    they are counted small; else both sides are written first, and adaptive execution
    splits cells that hold many rows. Bands with a null or NaN bound, or whose ``lo`` is
    above ``hi``, hold nothing; equal bands count each. Rows without a value drop out.

    With ``totals`` (names and the whole-number or decimal columns they sum) the copies are
    counted and summed by label and not made, as there are as many as rows times bands where
    bands are long: a row per label that holds any, with ``rows_name`` and the totals.
    """
    low, high = quoted(lo).cast("double"), quoted(hi).cast("double")
    bands = table.where((low <= high) & ~F.isnan(low) & ~F.isnan(high)).select(low.alias("_lo"), high.alias("_hi"), quoted(label).alias("_label"))
    if totals is not None:
        return _band_table_totals(df, value, bands, name, totals, rows_name)
    length = F.col("_hi") - F.col("_lo")
    level = F.ceil(F.log(F.greatest(length, F.abs("_hi") * 2.0**-40, F.abs("_lo") * 2.0**-40, F.lit(2.0**-60))) / math.log(_CELL_BASE))
    bounded = (F.abs("_lo") < float("inf")) & (F.abs("_hi") < float("inf")) & (length < float("inf"))
    bands = bands.withColumn("_level", F.when(bounded, level.cast("int")).otherwise(_UNBOUNDED))
    cells = F.sequence(_cell(F.col("_lo"), F.col("_level")), _cell(F.col("_hi"), F.col("_level")))
    cells = F.when(F.col("_level") == _UNBOUNDED, F.array(F.lit(0).cast("bigint"))).otherwise(cells)
    bands = scratch_table(bands.withColumn("_cell", F.explode(cells)), "band-cells")
    levels = [r[0] for r in bands.select("_level").distinct().collect()]  # a thousand at most: the exponents of doubles
    rows = df.withColumn("_value", number(df, value).cast("double")).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    rows = rows.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>")))
    rows = rows.withColumn("_cell", _cell(F.col("_value"), F.col("_level")))
    if fits_broadcast(bands):
        bands = F.broadcast(bands)
    else:
        rows = scratch_table(rows, "band-rows")
    met = rows.join(bands, ["_level", "_cell"]).where("_value >= _lo and _value <= _hi")
    return met.select(*[quoted(c) for c in df.columns], F.col("_label").alias(name))


def _band_table_totals(df: DataFrame, value: str, bands: DataFrame, name: str, totals: Mapping[str, str], rows_name: str) -> DataFrame:
    """Rows and sums per label from running totals over values and both ends of the bands, in one order.

    A band holds what has come by its upper end less what had come before its lower one.
    """
    kinds = {t: df.agg(F.sum(quoted(c))).schema[0].dataType for t, c in totals.items()}
    if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds.values()):
        raise ValueError("totals are sums of whole numbers or decimals")
    exact = {t: T.DecimalType(38, k.scale if isinstance(k, T.DecimalType) else 0) for t, k in kinds.items()}
    # Per total i its sum _s and the values _n that are not null; 0.0 is added so that -0.0 stands where 0.0 does.
    rows = df.withColumn("_value", number(df, value).cast("double") + F.lit(0.0)).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    sums = [F.count(F.lit(1)).cast("decimal(38,0)").alias("_rows")]
    for i, (t, c) in enumerate(totals.items()):
        sums += [F.coalesce(F.sum(quoted(c).cast(exact[t])), F.lit(0)).cast(exact[t]).alias(f"_s{i}"), F.count(quoted(c)).cast("decimal(38,0)").alias(f"_n{i}")]
    values = rows.groupBy("_value").agg(*sums)
    counted = values.columns[1:]
    ends = F.array(
        F.struct((F.col("_lo") + F.lit(0.0)).alias("_value"), F.lit(0).alias("_kind"), F.lit(-1).alias("_sign")),
        F.struct((F.col("_hi") + F.lit(0.0)).alias("_value"), F.lit(2).alias("_kind"), F.lit(1).alias("_sign")),
    )
    ends = bands.select("_label", F.explode(ends).alias("_end")).select("_label", "_end.*")
    ends = ends.groupBy("_value", "_kind", "_label").agg(F.sum("_sign").alias("_sign"))
    line = values.withColumn("_kind", F.lit(1)).unionByName(ends, allowMissingColumns=True)
    met = running_totals(line, ["_value", "_kind", "_label"], {f"{c}_before": F.coalesce(F.col(c), F.lit(0)) for c in counted})
    met = met.where("_sign is not null").groupBy("_label").agg(*[F.sum(F.col("_sign") * F.col(f"{c}_before")).alias(c) for c in counted])
    of_label = [F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}")).cast(kinds[t]).alias(t) for i, t in enumerate(totals)]
    return met.where("_rows > 0").select(F.col("_label").alias(name), F.col("_rows").cast("bigint").alias(rows_name), *of_label)


def band_counts(
    df: DataFrame, src_file: str, value: str, bands: Iterable[Band] = DEFAULT_BANDS, label: str = "range_label"
) -> DataFrame:
    """Rows before and after filtering for every file and band, empty ones too."""
    bands = list(bands)
    per_file = df.groupBy(src_file).agg(
        F.count(F.lit(1)).alias("rows_before"),
        *[F.count_if(in_band(df, value, b)).alias(f"_band{i}") for i, b in enumerate(bands)],
    )
    cells = F.array(
        *[F.struct(F.lit(b.label).alias("label"), F.col(f"_band{i}").alias("kept")) for i, b in enumerate(bands)]
    )
    return per_file.select(src_file, "rows_before", F.explode(cells).alias("_cell")).select(
        src_file, F.col("_cell.label").alias(label), "rows_before", F.col("_cell.kept").alias("rows_after")
    )


def unreadable_values(df: DataFrame, src_file: str, value: str) -> DataFrame:
    """Per file, the rows whose value is text but no number, so that the file can be named."""
    bad = quoted(value).isNotNull() & number(df, value).isNull()
    return df.groupBy(src_file).agg(F.count_if(bad).alias("rows_unreadable"))


def band_rollup(counts: DataFrame, label: str = "range_label") -> DataFrame:
    """Files and rows per band; a file without rows in a band still counts."""
    return counts.groupBy(label).agg(F.count(F.lit(1)).alias("files"), F.sum("rows_after").alias("rows"))
