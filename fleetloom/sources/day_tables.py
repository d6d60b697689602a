"""Directories of day tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom import fixed
from fleetloom.functions.paths import plain_path
from fleetloom.operators.concat import SchemaMismatch
from fleetloom.session import scratch_table
from fleetloom.sources.census import file_headers

# Names that do not start with one of the prefixes of temporary files, as a glob: a
# prefix of two letters may go on in any other way than with its second one.
_SINGLE = "".join(p for p in fixed.TEMP_FILE_PREFIXES if len(p) == 1)
_DOUBLE = [p for p in fixed.TEMP_FILE_PREFIXES if len(p) == 2]
_VALID_NAMES = "{" + ",".join([f"[!{''.join(p[0] for p in _DOUBLE)}{_SINGLE}]*", *[f"{p[0]}[!{p[1]}]*" for p in _DOUBLE]]) + "}"


def valid_name_glob(extension: str) -> str:
    """Glob of the names of this extension that are no temporary or system files."""
    return f"{_VALID_NAMES}.{extension}"


def _refuse_others(spark: SparkSession, path: str, format: str, recursive: bool) -> None:
    """Raise for the first file that can't be read, or whose columns are not those of the first one."""
    headers = scratch_table(file_headers(spark, path, format, recursive), "headers")
    first = headers.where("error is null").orderBy("src_file").first()
    if first is None:
        return
    found = F.col("columns")
    if format == "parquet":  # by name, whatever their order; CSV columns go by place
        found = F.array_sort(F.zip_with("columns", "types", lambda c, t: F.concat_ws(" ", c, t)))
        wanted = sorted(f"{c} {t}" for c, t in zip(first.columns, first.types, strict=True))
    else:
        wanted = first.columns
    same = found == F.lit(wanted) if wanted else F.size(found) == 0
    other = headers.where(F.col("error").isNotNull() | ~same).orderBy("src_file").first()
    if other is not None and other.error is not None:
        raise SchemaMismatch(f"{other.src_file} has no columns to read: {other.error}")
    if other is not None:
        described = [f"{h.src_file} has columns {', '.join(map(str, h.columns))}" + (f" of types {', '.join(h.types)}" if h.types else "") for h in (other, first)]
        raise SchemaMismatch("; ".join(described))


def read_day_tables(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    recursive: bool = False,
    schema: T.StructType | str | None = None,
    missing: str = "refuse",
) -> DataFrame:
    """All day tables of a directory as one, each file once, with ``src_file``.

    Files that have not all the same columns are refused, and the first such file is
    named; ``missing`` "fill" takes parquet columns by name instead, null in files that
    lack them. With ``schema`` its columns are read and others are not asked about.

    Parquet rows also get ``row_no``. For CSV, ``_block`` and ``_at`` order a
    file's rows; see ``number_csv_rows``.
    """
    if missing not in ("refuse", "fill"):
        raise ValueError(f"missing columns are refused or filled, not {missing!r}")
    if format not in ("parquet", "csv"):
        raise ValueError(f"day tables are parquet or csv, not {format!r}; for workbooks see read_workbooks")
    if format == "csv" and missing == "fill":
        raise ValueError("only parquet columns are found by name")
    if schema is None and missing == "refuse":
        _refuse_others(spark, path, format, recursive)
    reader = spark.read.option("pathGlobFilter", valid_name_glob(format)).option("recursiveFileLookup", recursive)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "parquet":
        order = [F.col("_metadata.row_index").alias("row_no")]
        table = reader.option("mergeSchema", missing == "fill").parquet(path)
    else:
        order = [
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        ]
        # A file whose header has other columns, or another order, is named in an error.
        table = reader.option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
    return table.select(plain_path(F.col("_metadata.file_path")).alias("src_file"), *order, "*")
