"""CSV directories: rectangular ones through Spark's reader, ragged ones cell by cell."""

from __future__ import annotations

import csv
import io
import itertools
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom.functions.paths import glob_literal, plain_path
from fleetloom.operators.lookups import lookup
from fleetloom.session import scratch_table
from fleetloom.sources.file_tree import spread_files, whole_content

RAW_CELLS = T.StructType(
    [
        T.StructField("src_file", T.StringType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

# What Spark's binaryFile source gives; a stream wants it spelled out.
FILE_CONTENTS = "path string, modificationTime timestamp, length bigint, content binary"

# Files up to this many bytes are parsed whole; longer ones line by line, to the same rows.
WHOLE_FILE_BYTES = 16 * 1024 * 1024
_ROWS_PER_BATCH = 20_000


def read_csv_tree(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True
) -> DataFrame:
    """Every ``*.csv`` below ``path`` as one table with ``src_file``; files are split.

    ``_block`` and ``_at`` order the rows of a file: the part of the file, and the
    row's place in it. ``number_csv_rows`` turns them into row numbers.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("header", header)
        .option("escape", '"')
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path).select(
        plain_path(F.col("_metadata.file_path")).alias("src_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "*",
    )


def _over_blocks(value: str) -> Column:
    """Sum of ``value`` over the earlier blocks of a file; one row per block goes through."""
    earlier = Window.partitionBy("src_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def number_csv_rows(df: DataFrame) -> DataFrame:
    """Replace ``_block`` and ``_at`` by ``row_no``, counted from 0 in each file.

    A block's rows are read one after the other, so a row's number is the count of
    the file's earlier blocks plus its distance from the block's first row. No row
    is sorted or shuffled. The rows are written once, since a second scan may split
    the files at other places.
    """
    df = scratch_table(df, "csv-rows")
    blocks = df.groupBy("src_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    shifts = scratch_table(blocks, "blocks").select(
        "src_file", "_block", (_over_blocks("_rows") - F.col("_first")).alias("_shift")
    )
    return (
        lookup(df, shifts, ["src_file", "_block"], "inner")
        .withColumn("row_no", F.col("_at") + F.col("_shift"))
        .drop("_block", "_at", "_shift")
    )


def small_csv_files(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    files_per_trigger: int | None = None,
    name_glob: str = "*.csv",
) -> DataFrame:
    """Paths, lengths and contents of the CSV files below ``path``."""
    # Files may arrive with old dates; none is ever too old to be read.
    reader = spark.readStream.option("maxFileAge", "36500d") if stream else spark.read
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return (
        reader.format("binaryFile")
        .schema(FILE_CONTENTS)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .load(path)
        .select("path", "length", "content")
    )


def short_bytes(spark: SparkSession, whole_file_bytes: int) -> int:
    """The length up to which files are parsed whole: never above what Spark reads of one file."""
    return min(whole_file_bytes, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))


def _parse_text(text: str) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(io.StringIO(text, newline=""))


def _parse_content(content: pa.Buffer, added: bytes = b"") -> Iterator[list[str]]:
    """The rows of a whole file, decoded as they are read."""
    csv.field_size_limit(sys.maxsize)
    parts = io.BufferedReader(pa.BufferReader(content)) if not added else io.BytesIO(content.to_pybytes() + added)
    return csv.reader(io.TextIOWrapper(parts, "utf-8-sig", newline=""))


def _checked_rows(content: pa.Buffer) -> Iterator[list[str]]:
    """The rows of a whole file; a fault anywhere in it is raised before the first one."""
    count, last = 0, None
    for last in _parse_content(content):
        count += 1
    # The line end that closes the file is no part of a cell whose quote is never closed.
    unclosed = last and last[-1].endswith("\n") and content.to_pybytes()[-1:] == b"\n" and sum(1 for _ in _parse_content(content, b"x\n")) == count

    def rows() -> Iterator[list[str]]:
        for i, row in enumerate(_parse_content(content), 1):
            if unclosed and i == count:
                row[-1] = row[-1][:-1]
            yield row

    return rows()


class RowBuffer:
    """Rows of many files, handed on in Arrow batches."""

    def __init__(self) -> None:
        self._columns: list[list] = [[], [], [], []]

    def add(self, path: str, rows: Iterable[list[str]], error: str | None = None) -> Iterator[pa.RecordBatch]:
        """Take a file's rows as they come; a file without any leaves one row that notes it."""
        rows, first = iter(rows), 0
        while some := list(itertools.islice(rows, _ROWS_PER_BATCH - len(self._columns[0]))):
            yield from self._put(path, first, some, error)
            first += len(some)
        if not first:
            yield from self._put(path, -1, [None], error)

    def _put(self, path: str, first: int, rows: list, error: str | None) -> Iterator[pa.RecordBatch]:
        new = ([path] * len(rows), range(first, first + len(rows)), rows, [error] * len(rows))
        for column, values in zip(self._columns, new):
            column.extend(values)
        if len(self._columns[0]) >= _ROWS_PER_BATCH:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        columns, self._columns = self._columns, [[], [], [], []]
        types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string())
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["src_file", "row_no", "cells", "error"])


def _parse_contents(contents: Iterable[tuple[str, pa.Buffer]]) -> Iterator[pa.RecordBatch]:
    buffer = RowBuffer()
    for path, content in contents:
        rows, error = [], None
        try:
            rows = _checked_rows(content)
        except (UnicodeDecodeError, csv.Error) as problem:
            error = f"{type(problem).__name__}: {problem}"
        yield from buffer.add(path, rows, error)
    yield from buffer.rest()


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = (zip(batch.column("path").to_pylist(), batch.column("content")) for batch in batches)
    yield from _parse_contents((path, content.as_buffer()) for files in columns for path, content in files)


def _parse_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _parse_contents((path, whole_content(path)) for batch in batches for path in batch.column("path").to_pylist())


def cells_of_files(files: DataFrame) -> DataFrame:
    """Rows of cells out of whole file contents.

    A file that cannot be read gives one row with ``error``, one without rows a row
    without; both have ``row_no`` -1 and no cells. Spark does not open files of zero
    bytes.
    """
    return files.select("path", "content").mapInArrow(_parse_files, RAW_CELLS)


def cells_of_listed(files: DataFrame) -> DataFrame:
    """As ``cells_of_files``, of listed files (path, length) that tasks open themselves.

    Spark's own sources would keep a driver's entry per file and start a task for a few of them.
    """
    return spread_files(files.select("path", "length")).select("path").mapInArrow(_parse_listed, RAW_CELLS)


def _parse_record(text: str) -> list[str]:
    # The line end is no part of a cell whose quote is never closed.
    rows = list(_parse_text(text.removesuffix("\n"))) or [[]]
    if len(rows) > 1:
        raise ValueError(f"a record of {len(rows)} rows")
    return rows[0]


def _parse_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [_parse_record(text) for text in batch.column("_text").to_pylist()]
        columns = [
            batch.column("src_file").cast(pa.string()),
            batch.column("row_no"),
            pa.array(cells, pa.list_(pa.string())),
            pa.nulls(len(cells), pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["src_file", "row_no", "cells", "error"])


def _ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell, as the csv module reads it.

    A quote opens a cell only at its start; two inside a quoted cell are one of its text;
    after the closing one the cell goes on without quotes.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1
        if not at:
            return False


def _line_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to each line what it makes of being inside a cell or not.

    ``_sets``: the state it ends in, whatever it began in; null if that depends.
    ``_turns``: 1 if it ends in the other state, 0 if it leaves things as they are.
    ``_opens``: a cell that it begins goes on in the next line.
    """
    for batch in batches:
        sets, turns, opens = [], [], []
        for line in batch.column("_text").to_pylist():
            outside, inside = ('"' in line and _ends_inside(line, False)), ('"' not in line or _ends_inside(line, True))
            sets.append(int(outside) if outside == inside else None)
            turns.append(int(outside and not inside))
            opens.append(outside)
        out = batch.append_column("_sets", pa.array(sets, pa.int32())).append_column("_turns", pa.array(turns, pa.int32()))
        yield out.append_column("_opens", pa.array(opens, pa.bool_()))


def long_file_text(
    spark: SparkSession,
    path: str | list[str],
    longer_than: int,
    name_glob: str = "*.csv",
    stream: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """src_file, _block and the text up to each \\n of the files longer than so many bytes; others are not opened."""
    reader = spark.readStream.option("maxFileAge", "36500d") if stream else spark.read
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)
    lines = reader.option("lineSep", "\n").text(path)  # a \r before it stays, as it may be in a cell
    return lines.where(F.col("_metadata.file_size") > longer_than).select(
        # As the listing of whole files spells a path.
        F.regexp_replace(plain_path(F.col("_metadata.file_path")), "^file:/+", "file:/").alias("src_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        "value",
    )


def lines_of_text(text: DataFrame) -> DataFrame:
    """Lines with their ends, in the order ``_at``. The csv module ends lines at a lone \\r too."""
    several = F.locate("\r", F.col("value")).between(1, F.length("value") - 1)
    parts = F.split(F.concat("value", F.lit("\n")), r"(?<=\r)(?!\n)")
    return text.select(
        "src_file",
        "_block",
        F.is_valid_utf8("value").alias("_valid"),
        F.explode(F.when(several, parts).otherwise(F.array(F.concat("value", F.lit("\n"))))).alias("_text"),
    ).select("src_file", "_block", F.monotonically_increasing_id().alias("_at"), "_valid", "_text")


def _state(start: Column, last: Column, turns: Column) -> Column:
    """Inside a cell (1) or not (0), after lines of which ``last`` was the last to set it.

    ``last`` holds the state it set and how many turns there were by then; ``turns`` counts all.
    """
    return F.when(last.isNotNull(), F.pmod(last["_sets"] + turns - last["_by_then"], F.lit(2))).otherwise(F.pmod(start + turns, F.lit(2)))


def _numbered_records(lines: DataFrame) -> DataFrame:
    """Lines put together to records where a quoted cell runs over lines.

    What a block of lines makes of either state is known without the blocks before it, so
    one row per block is enough to find the state each block begins in. Only the lines of
    one block, whose length is bounded, are ever ordered together.
    """
    in_block = Window.partitionBy("src_file", "_block").orderBy("_at")
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    setting = F.when(F.col("_sets").isNotNull(), F.struct("_sets", F.col("_by_then")))
    turned = scratch_table(lines.withColumn("_by_then", F.sum("_turns").over(upto)), "turned")
    blocks = turned.groupBy("src_file", "_block").agg(
        F.sum("_turns").alias("_turns"), F.max_by("_sets", F.when(F.col("_sets").isNotNull(), F.col("_at"))).alias("_sets"),
        F.max_by("_by_then", F.when(F.col("_sets").isNotNull(), F.col("_at"))).alias("_set_by_then"),
    )
    # As for lines: a block either sets the state or turns it.
    blocks = blocks.select(
        "src_file", "_block",
        F.pmod(F.col("_sets") + F.col("_turns") - F.col("_set_by_then"), F.lit(2)).alias("_sets"),
        F.when(F.col("_sets").isNull(), F.col("_turns")).otherwise(0).alias("_turns"),
    )
    of_file = Window.partitionBy("src_file").orderBy("_block")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_by_then", F.sum("_turns").over(of_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    start = _state(F.lit(0), F.last(setting, ignorenulls=True).over(earlier), F.coalesce(F.sum("_turns").over(earlier), F.lit(0)))
    block_starts = scratch_table(blocks.select("src_file", "_block", start.alias("_inside")), "block-states")
    known = lookup(turned, block_starts, ["src_file", "_block"], "inner")
    inside = _state(F.col("_inside"), F.last(setting, ignorenulls=True).over(before), F.coalesce(F.sum("_turns").over(before), F.lit(0)))
    opened = scratch_table(known.select("src_file", "_block", "_at", "_text", F.when(inside == 0, 1).otherwise(0).alias("_starts")), "opened")
    records = scratch_table(opened.groupBy("src_file", "_block").agg(F.sum("_starts").alias("_records")), "records")
    so_far = F.sum("_starts").over(upto)
    record_starts = records.select("src_file", "_block", _over_blocks("_records").alias("_record_start"))
    return (
        lookup(opened.withColumn("_so_far", so_far), record_starts, ["src_file", "_block"], "inner")
        # One group is one record; only a quote that is never closed makes one of all that follows.
        .groupBy("src_file", (F.col("_record_start") + F.col("_so_far") - 1).alias("row_no"))
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_at", "_text"))).alias("_lines"))
        .select("src_file", "row_no", F.concat_ws("", F.col("_lines._text")).alias("_text"))
    )


def cells_of_lines(lines: DataFrame) -> DataFrame:
    """Rows of cells out of the lines of files too long for one task, as whole files give them.

    In most files a line is a record, and its number follows from the counts of the
    file's blocks. Files with a quoted cell that runs on into the next line are put
    together. The lines are written once: a second scan may split the files at other places.
    """
    schema = lines.withColumns({"_sets": F.lit(None).cast("int"), "_turns": F.lit(0), "_opens": F.lit(False)}).schema
    lines = scratch_table(lines.withColumn("_text", F.make_valid_utf8("_text")).mapInArrow(_line_effects, schema), "csv-lines")
    blocks = scratch_table(
        lines.groupBy("src_file", "_block").agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("_at").alias("_first"),
            F.bool_and("_valid").alias("_valid"),
            F.bool_or("_opens").alias("_opens"),
        ),
        "blocks",
    )
    of_file = Window.partitionBy("src_file")
    starts = scratch_table(
        blocks.select(
            "src_file",
            "_block",
            (_over_blocks("_rows") - F.col("_first")).alias("_shift"),
            F.min("_valid").over(of_file).alias("_readable"),
            F.max("_opens").over(of_file).alias("_runs_on"),
        ),
        "block-starts",
    )
    known = lookup(lines, starts, ["src_file", "_block"], "inner")
    records = known.where("_readable and not _runs_on").select(
        "src_file", (F.col("_at") + F.col("_shift")).alias("row_no"), "_text"
    )
    if not starts.where("_readable and _runs_on").isEmpty():
        records = records.union(_numbered_records(known.where("_readable and _runs_on").select("src_file", "_block", "_at", "_text", "_sets", "_turns")))
    broken = starts.where("not _readable").select(
        "src_file",
        F.lit(-1).cast("bigint").alias("row_no"),
        F.lit(None).cast("array<string>").alias("cells"),
        F.lit("UnicodeDecodeError: not UTF-8").alias("error"),
    )
    return records.mapInArrow(_parse_records, RAW_CELLS).union(broken.distinct())


def ragged_csv_parts(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES, name_glob: str = "*.csv"
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of files parsed whole, a file's rows together and in order, and those of long files, if there are any."""
    limit = short_bytes(spark, whole_file_bytes)
    files = small_csv_files(spark, path, name_glob=name_glob)
    small = cells_of_files(files.where(F.col("length") <= limit))
    if files.where(F.col("length") > limit).select("path").isEmpty():
        return small, None
    return small, cells_of_lines(lines_of_text(long_file_text(spark, path, limit, name_glob)))


def listed_csv_parts(files: DataFrame, whole_file_bytes: int = WHOLE_FILE_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """``ragged_csv_parts`` of listed files (path, length) that are not empty; of these, the driver sees long ones only."""
    spark = files.sparkSession
    limit = short_bytes(spark, whole_file_bytes)
    small = cells_of_listed(files.where(F.col("length") <= limit))
    long = [glob_literal(f.path) for f in files.where(F.col("length") > limit).select("path").collect()]
    if not long:
        return small, None
    return small, cells_of_lines(lines_of_text(long_file_text(spark, long, limit, "*")))


def read_ragged_csv(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES, name_glob: str = "*.csv"
) -> DataFrame:
    """Every CSV file below ``path`` as rows of cells, blank and uneven rows kept.

    Gives ``src_file``, ``row_no`` counted from 0 with the header as row 0,
    ``cells`` and ``error``; an empty or unreadable file gives one row with
    ``row_no`` -1. Small files are parsed whole, many per task; long ones are split
    by lines.
    """
    small, long = ragged_csv_parts(spark, path, whole_file_bytes, name_glob)
    return small if long is None else small.union(long)


# Executors need not have this package installed: the parsers travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
