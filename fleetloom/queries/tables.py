"""Folders of day tables, workbooks and plate lists, made of the driver's tables and read back."""

from __future__ import annotations

import io
import sys
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions import paths
from fleetloom.operators import purge, reports
from fleetloom.plans import vehicles
from fleetloom.queries.calendar import LIST_DATES
from fleetloom.queries.registry import query, table
from fleetloom.session import scratch_path
from fleetloom.sources.census import file_headers
from fleetloom.sources.csv_files import read_ragged_csv
from fleetloom.sources.day_tables import read_day_tables
from fleetloom.sources.file_tree import in_files, write_named_files
from fleetloom.sources.plate_lists import read_dated_lists
from fleetloom.sources.sinks import csv_line
from fleetloom.sources.workbooks import read_workbooks

# Rows of one day in one workbook, whose format ends at about a million.
_EVENTS_PER_BOOK = 20_000


def _days(spark: SparkSession, sf_dir: str) -> str:
    """Events as day tables: some days have another column, lack one, or have them in another order."""
    root = scratch_path(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.dayofmonth("ts").alias("day"))
    kinds = {
        "day % 7 = 0": ["event_id", "user_id", "value", "note"],
        "day % 7 <> 0 AND day % 5 = 0": ["event_id", "value"],
        "day % 7 <> 0 AND day % 5 <> 0 AND day % 3 = 0": ["value", "user_id", "event_id"],
        "day % 7 <> 0 AND day % 5 <> 0 AND day % 3 <> 0": ["event_id", "user_id", "value"],
    }
    for kind, columns in kinds.items():
        rows = events.where(kind).withColumn("note", F.lit("x")).select(*columns, "day")
        rows.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(root)
    return root


_DAYS_SQL = """
    SELECT day, count(*) AS rows,
           CASE WHEN day % 7 = 0 THEN 'event_id,user_id,value,note' WHEN day % 5 = 0 THEN 'event_id,value'
                WHEN day % 3 = 0 THEN 'value,user_id,event_id' ELSE 'event_id,user_id,value' END AS columns
    FROM (SELECT day(ts) AS day FROM events) GROUP BY day
"""


@query(
    f"""
    SELECT day, columns, rows, columns IN ('event_id,user_id,value', 'value,user_id,event_id') AS whole
    FROM ({_DAYS_SQL})
    """
)
def day_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's columns and rows, out of the footers alone; days with others than the usual ones are named."""
    headers = file_headers(spark, _days(spark, sf_dir), recursive=True)
    usual = F.array(*[F.lit(c) for c in ("event_id", "user_id", "value")])
    return (
        headers.withColumn("day", F.regexp_extract("src_file", "/day=([0-9]+)/", 1).cast("bigint"))
        .groupBy("day", F.array_join("columns", ",").alias("columns"))
        .agg(F.sum("rows").alias("rows"), F.bool_and(F.array_sort("columns") == usual).alias("whole"))
    )


@query(
    """
    SELECT event_id, CASE WHEN day(ts) % 7 <> 0 AND day(ts) % 5 = 0 THEN NULL ELSE user_id END AS user_id, value,
           CASE WHEN day(ts) % 7 = 0 THEN 'x' END AS note
    FROM events
    """
)
def day_tables_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day tables of different columns as one, by name, nulls where a file lacks a column."""
    read = read_day_tables(spark, _days(spark, sf_dir), recursive=True, missing="fill")
    return read.select("event_id", "user_id", "value", "note")


@query(
    """
    SELECT '2024_0' || (user_id % 6 + 1) || '01_x.csv' AS file, CAST(event_id AS VARCHAR) AS "车牌号", event_type AS "Unnamed: 1",
           CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS "车牌号.1",
           CASE WHEN event_id % 5 = 0 AND event_id % 3 <> 0 THEN '+' END AS "Unnamed: 3",
           row_number() OVER (ORDER BY user_id % 6, event_id) - 1 AS pos
    FROM events
    """
)
def stack_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose header has a blank and a repeated name, and whose rows are shorter or longer than it."""
    root = scratch_path(spark, "stack")
    events, text = table(spark, sf_dir, "events"), F.col("user_id").cast("string")
    name = F.concat(F.lit("2024_0"), (F.col("user_id") % 6 + 1).cast("string"), F.lit("01_x.csv"))
    cells = F.array(F.col("event_id").cast("string"), "event_type", text, F.when(F.col("event_id") % 5 == 0, "+").otherwise(""))
    width = F.when(F.col("event_id") % 3 == 0, 2).when(F.col("event_id") % 5 == 0, 4).otherwise(3)
    rows = events.select(name.alias("name"), F.col("event_id").alias("row_no"), csv_line(F.slice(cells, F.lit(1), width)).alias("line"))
    heads = rows.select("name").distinct().select("name", F.lit(-1).cast("bigint"), F.lit("车牌号,,车牌号"))
    write_named_files(in_files(rows.union(heads)), root)
    stacked = vehicles.stack_files(read_ragged_csv(spark, root))
    return stacked.withColumn("file", paths.file_name(F.col("src_file"))).drop("src_file", "row_no")


def _book(rows: list[tuple[int, str, int, float]], from_1904: bool) -> bytes:
    """A workbook of plates, days (as the format counts them) and values; every seventh row has a cell more."""
    main, package = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/package/2006/relationships"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    words = ["车牌号", "日期", "总里程(公里)"]
    lines = ['<row r="1">' + "".join(f'<c t="s"><v>{i}</v></c>' for i in range(len(words))) + "</row>"]
    for place, (event_id, plate, day, value) in enumerate(rows, 2):
        more = '<c t="inlineStr"><is><t>more</t></is></c>' if event_id % 7 == 0 else ""
        lines.append(f'<row r="{place}"><c t="inlineStr"><is><t>{escape(plate)}</t></is></c><c s="1"><v>{day}</v></c><c><v>{value!r}</v></c>{more}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{office}"><workbookPr date1904="{int(from_1904)}"/><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>',
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        shared = "".join(f"<si><t>{w}</t><rPh><t>hint</t></rPh></si>" for w in words)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{shared}</sst>')
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


def _books(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("event_id")
    name = rows["name"][0].as_py()
    cells = list(zip(*[rows[c].to_pylist() for c in ("event_id", "plate", "day", "value")], strict=True))
    return pa.table({"name": [name], "content": pa.array([_book(cells, rows["from_1904"][0].as_py())], pa.binary())})


@query(
    f"""
    WITH books AS (
        SELECT event_id, strftime(ts, '%m%d') || '_' || (event_id // {_EVENTS_PER_BOOK}) || '.xlsx' AS book, event_type, ts, value FROM events
    )
    SELECT book, row_number() OVER (PARTITION BY book ORDER BY event_id) AS row_no, '豫' || event_type AS plate,
           strftime(ts, '%Y-%m-%d') || ' 00:00:00' AS day, value, CASE WHEN event_id % 7 = 0 THEN 'more' END AS more
    FROM books
    """
)
def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a workbook a day, some counting days from 1904, and their cells, also those right of the header."""
    root = scratch_path(spark, "books")
    day = F.to_date("ts")
    from_1904 = F.dayofmonth(day) % 2 == 0
    zero = F.when(from_1904, F.lit("1904-01-01").cast("date")).otherwise(F.lit("1899-12-30").cast("date"))
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.date_format(day, "MMdd"), F.lit("_"), F.expr(f"event_id div {_EVENTS_PER_BOOK}").cast("string"), F.lit(".xlsx")).alias("name"),
        "event_id",
        F.concat(F.lit("豫"), "event_type").alias("plate"),
        F.date_diff(day, zero).alias("day"),
        "value",
        from_1904.alias("from_1904"),
    )
    write_named_files(rows.groupBy("name").applyInArrow(_books, "name string, content binary"), root)
    cell = [F.get("cells", F.lit(i)) for i in range(4)]
    return read_workbooks(spark, root).where("row_no > 0").select(
        paths.file_name(F.col("src_file")).alias("book"), "row_no", cell[0].alias("plate"), cell[1].alias("day"), cell[2].cast("double").alias("value"), cell[3].alias("more")
    )


def _lists(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers on dated lists, each with its header twice and texts that are no plates; and a list without a date."""
    root = scratch_path(spark, "lists")
    place = (F.col("s_suppkey") % (len(LIST_DATES) + 1)).cast("int")
    day = F.get(F.array(*[F.lit(d.replace("-", "_")) for d in LIST_DATES], F.lit("later")), place)
    plate = F.when(F.col("s_suppkey") % 11 == 0, "NA").otherwise(F.col("s_name"))
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("from_"), day, F.lit(".csv")).alias("name"), F.col("s_suppkey").alias("row_no"), plate.alias("line"))
    heads = rows.select("name").distinct().select("name", F.explode(F.array(F.lit(-2).cast("bigint"), F.lit(-1).cast("bigint"))), F.lit(fixed.LIST_HEADER))
    write_named_files(in_files(rows.union(heads)), root)
    return root


_LISTS_SQL = f"""
    SELECT s_name AS plate, CAST(d AS DATE) AS from_date, 'from_' || replace(d, '-', '_') || '.csv' AS list_name
    FROM (SELECT s_suppkey, s_name, [{", ".join(f"'{d}'" for d in LIST_DATES)}][CAST(s_suppkey % {len(LIST_DATES) + 1} AS INT) + 1] AS d FROM supplier)
    WHERE d IS NOT NULL AND s_suppkey % 11 <> 0
"""


@query(f"SELECT plate, CAST(from_date AS VARCHAR) AS from_date, list_name FROM ({_LISTS_SQL})")
def dated_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dated lists of a folder, read back."""
    return read_dated_lists(spark, _lists(spark, sf_dir)).withColumn("from_date", F.col("from_date").cast("string"))


@query(
    f"""
    SELECT plate AS "车号", year(day) || '/' || month(day) || '/' || day(day) AS "日期", '{fixed.FILLER_PLATE}' AS "补充车辆",
           '{fixed.FILLER_DAY}' AS "补充日期", CAST(NULL AS VARCHAR) AS "备注"
    FROM (SELECT plate, CAST(unnest(generate_series(CAST(from_date AS TIMESTAMP), TIMESTAMP '{fixed.CALENDAR_END}', INTERVAL 1 DAY)) AS DATE) AS day FROM ({_LISTS_SQL}))
    UNION ALL
    SELECT c_name, '2024/1/1', NULL, NULL, c_mktsegment FROM customer
    """
)
def calendar_of_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of a folder of lists, stacked below a table that has other columns."""
    older = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias(fixed.CALENDAR_PLATE), F.lit("2024/1/1").alias(fixed.CALENDAR_DAY), F.col("c_mktsegment").alias("备注")
    )
    return vehicles.add_calendar(spark, _lists(spark, sf_dir), older)


@query(
    """
    SELECT CAST(0 AS BIGINT) AS files, CAST(0 AS BIGINT) AS ok, CAST(0 AS BIGINT) AS failed, 0.0::DOUBLE AS success_pct,
           count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS rows_deleted
    FROM orders WHERE o_totalprice < 0
    """
)
def purge_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table passes the purge, and nothing is deleted."""
    orders = table(spark, sf_dir, "orders").where("o_totalprice < 0")
    records = orders.select(F.col("o_custkey").cast("string").alias("plate"), F.to_date("o_orderdate").alias("file_date"), F.date_format("o_orderdate", "yyyyMM").alias("src_file"))
    lists = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("plate"), F.lit(None).cast("date").alias("from_date"))
    return reports.run_summary(purge.purge_report(purge.flag_purged(records, lists, "plate", "file_date"), "src_file"))


# Executors need not have this package installed: the workbooks' maker travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
