"""Positions, sorting, shuffling, stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions.dates import date_of_text, prefixed_name_date, short_day_text
from fleetloom.operators import concat, position, reports
from fleetloom.operators.lookups import lookup
from fleetloom.queries.cleanse import MIXED_DATE_SQL, SHORT_DAY_SQL, TIDY_SQL, mixed_date_texts
from fleetloom.queries.registry import draw_sql, query, table
from fleetloom.session import scratch_path, scratch_table
from fleetloom.sources.csv_files import number_csv_rows, read_csv_tree
from fleetloom.sources.day_tables import read_day_tables
from fleetloom.sources.sinks import write_by, write_csv, write_in_order

SEED = 42


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


_ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
"""

_SHUFFLED_SQL = f"""
    WITH placed AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM ({_ORDERS_SQL})),
    moved AS (
        SELECT o_totalprice, o_orderdate, o_orderpriority,
               row_number() OVER (ORDER BY {draw_sql(SEED, 'pos')}, pos) - 1 AS pos
        FROM placed
    )
    SELECT pos, p.o_orderkey, p.o_custkey, p.o_orderstatus, m.o_totalprice, m.o_orderdate, m.o_orderpriority
    FROM placed p JOIN moved m USING (pos)
"""


def _shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return position.shuffle_right(orders, orders.columns[:3], ["o_orderkey"], SEED)


@query(_SHUFFLED_SQL)
def shuffle_right_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shuffled(spark, sf_dir)


@query(
    f"""
    SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY {draw_sql(7, 'o_orderkey')}, o_orderkey) - 1 AS pos FROM orders
    """
)
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return position.shuffle_rows(orders, ["o_orderkey"], 7)


@query(
    f"""
    WITH b AS (SELECT o_totalprice, o_orderdate, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM ({_ORDERS_SQL})),
    a AS (SELECT pos, o_totalprice, o_orderdate, o_orderpriority FROM ({_SHUFFLED_SQL})),
    lost AS (SELECT o_totalprice, o_orderdate, o_orderpriority FROM b EXCEPT ALL SELECT o_totalprice, o_orderdate, o_orderpriority FROM a),
    added AS (SELECT o_totalprice, o_orderdate, o_orderpriority FROM a EXCEPT ALL SELECT o_totalprice, o_orderdate, o_orderpriority FROM b)
    SELECT (SELECT count(*) FROM b) AS compared,
           (SELECT count(*) FROM b JOIN a USING (pos) WHERE b.o_totalprice = a.o_totalprice
              AND b.o_orderdate = a.o_orderdate AND b.o_orderpriority = a.o_orderpriority) AS stayed,
           (SELECT count(*) FROM lost) AS lost, (SELECT count(*) FROM added) AS added
    """
)
def shuffle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = ["o_totalprice", "o_orderdate", "o_orderpriority"]
    before = position.row_index(_orders(spark, sf_dir).select("o_orderkey", *moved), ["o_orderkey"]).drop("o_orderkey")
    return position.shuffle_audit(before, _shuffled(spark, sf_dir).select("pos", *moved))


_SORTED_SQL = f"""
    SELECT o_orderkey, raw AS "日期",
           row_number() OVER (ORDER BY CAST(try_strptime({TIDY_SQL.format('raw')}, '%Y/%m/%d') AS DATE) ASC NULLS LAST, o_orderkey) - 1 AS pos
    FROM ({MIXED_DATE_SQL})
"""


@query(_SORTED_SQL)
def sort_by_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position.sort_by_text_date(mixed_date_texts(spark, sf_dir), "日期", ["o_orderkey"])


@query(
    f"""
    SELECT * FROM (SELECT *, 'head' AS part FROM ({_SORTED_SQL}) ORDER BY pos LIMIT 10)
    UNION ALL
    SELECT * FROM (SELECT *, 'tail' AS part FROM ({_SORTED_SQL}) ORDER BY pos DESC LIMIT 10)
    """
)
def preview_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position.head_and_tail(position.sort_by_text_date(mixed_date_texts(spark, sf_dir), "日期", ["o_orderkey"]), ["pos"])


@query(
    f"""
    WITH days AS (SELECT CAST(try_strptime({TIDY_SQL.format('raw')}, '%Y/%m/%d') AS DATE) AS d FROM ({MIXED_DATE_SQL}))
    SELECT CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day, count(*) FILTER (d IS NULL) AS undated_rows FROM days
    """
)
def text_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.date_range(mixed_date_texts(spark, sf_dir), date_of_text(F.col("日期")))
    return found.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


_SORTEDNESS_SQL = """
    SELECT '{0}' AS source, count(*) AS rows, count(*) FILTER (v IS NULL) AS nulls, count(*) FILTER (v < p) AS inversions,
           count(*) FILTER (v < p) = 0 AND count(*) FILTER (v IS NULL) = 0 AS is_sorted
    FROM (SELECT v, lag(v) OVER (ORDER BY k) AS p FROM ({1}))
"""


@query(
    _SORTEDNESS_SQL.format("orders", "SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS v FROM orders")
    + " UNION ALL "
    + _SORTEDNESS_SQL.format("events", "SELECT event_id AS k, ts AS v FROM events")
    + " UNION ALL "
    + _SORTEDNESS_SQL.format(
        "sorted",
        f"SELECT pos AS k, CAST(try_strptime({TIDY_SQL.format('t')}, '%Y/%m/%d') AS DATE) AS v FROM (SELECT pos, \"日期\" AS t FROM ({_SORTED_SQL}))",
    )
)
def sortedness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by key, events by id, and the audit of a sorted table."""
    by_date = position.sort_by_text_date(mixed_date_texts(spark, sf_dir), "日期", ["o_orderkey"])
    checks = {
        "orders": position.sortedness(table(spark, sf_dir, "orders"), ["o_orderkey"], F.to_date("o_orderdate")),
        "events": position.sortedness(table(spark, sf_dir, "events"), ["event_id"], F.col("ts")),
        "sorted": position.sortedness(by_date, ["pos"], date_of_text(F.col("日期"))),
    }
    named = [df.select(F.lit(name).alias("source"), "*") for name, df in checks.items()]
    return named[0].union(named[1]).union(named[2])


def _day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day with generated file names, some without year, some without date."""
    day = F.dayofmonth("ts")
    name = (
        F.when(day % 11 == 0, F.concat(F.lit("log_"), day.cast("string")))
        .when(day % 7 == 0, F.date_format("ts", "MMdd'_data'"))
        .otherwise(F.date_format("ts", "yyyy_MMdd'_data'"))
    )
    return table(spark, sf_dir, "events").select("event_id", name.alias("src_name"), "user_id", "value").withColumn(
        "file_date", prefixed_name_date(F.col("src_name"))
    )


_DAY_FILES_SQL = """
    SELECT event_id, CASE WHEN day(ts) % 11 = 0 THEN 'log_' || day(ts) WHEN day(ts) % 7 = 0 THEN strftime(ts, '%m%d_data')
                          ELSE strftime(ts, '%Y_%m%d_data') END AS src_name,
           CASE WHEN day(ts) % 11 <> 0 THEN CAST(ts AS DATE) END AS file_date, user_id, value
    FROM events
"""


@query(
    f"""
    SELECT event_id, src_name, user_id, value, row_number() OVER (ORDER BY src_name, event_id) - 1 AS pos FROM ({_DAY_FILES_SQL})
    """
)
def concat_strict_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat.concat_by_name(_day_files(spark, sf_dir).drop("file_date"), "src_name", "event_id")


@query(
    f"""
    SELECT event_id, src_name, CAST(file_date AS VARCHAR) AS file_date, user_id, value,
           row_number() OVER (ORDER BY file_date ASC NULLS FIRST, src_name, event_id) - 1 AS pos
    FROM ({_DAY_FILES_SQL})
    """
)
def concat_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = concat.concat_by_date(_day_files(spark, sf_dir), "file_date", "src_name", "event_id")
    return placed.withColumn("file_date", F.col("file_date").cast("string"))


_LINES_SQL = """
    SELECT src_name, unnest(generate_series(0, len(parts) - 1)) AS row_no, unnest(parts) AS line
    FROM (SELECT source || '_' || doc_id AS src_name, string_split(text, chr(10)) AS parts FROM documents)
"""


@query(f"SELECT src_name, row_no, line, row_number() OVER (ORDER BY src_name, row_no) - 1 AS pos FROM ({_LINES_SQL})")
def concat_numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files whose lines are already numbered: no row is sorted."""
    lines = table(spark, sf_dir, "documents").select(
        F.concat_ws("_", "source", F.col("doc_id").cast("string")).alias("src_name"),
        F.posexplode(F.split("text", "\n")).alias("row_no", "line"),
    )
    return concat.concat_by_name(lines.withColumn("row_no", F.col("row_no").cast("bigint")), "src_name", "row_no", dense=True)


@query(
    """
    SELECT o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS mark FROM orders
    UNION ALL
    SELECT l_orderkey, CAST(l_linenumber AS DOUBLE), CAST(l_linenumber AS VARCHAR) FROM lineitem
    """
)
def concat_wider_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same names, different types: numbers widen, text wins."""
    return concat.concat_strict(
        [
            table(spark, sf_dir, "orders").selectExpr("o_orderkey AS key", "o_totalprice AS amount", "o_orderstatus AS mark"),
            table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS key", "l_linenumber AS amount", "l_linenumber AS mark"),
        ]
    )


@query(
    """
    SELECT o_custkey AS custkey, o_orderkey, o_totalprice, NULL AS c_name FROM orders
    UNION ALL
    SELECT c_custkey, NULL, NULL, c_name FROM customer
    """
)
def concat_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat.concat_lenient(
        table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice"),
        table(spark, sf_dir, "customer").select("c_name", F.col("c_custkey").alias("custkey")),
    )


@query(
    """
    WITH headers AS (SELECT doc_id, split_part(text, chr(10), 1) AS header FROM documents),
    first AS (SELECT arg_min(header, doc_id) AS expected FROM headers)
    SELECT doc_id, header, expected, len(string_split(header, ' ')) AS columns FROM headers, first WHERE header <> expected
    """
)
def header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files whose first line holds the column names."""
    headers = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("src_file"), F.split(F.split_part("text", F.lit("\n"), F.lit(1)), " ").alias("columns")
    )
    return concat.header_offenders(headers).select(
        F.col("src_file").alias("doc_id"),
        F.array_join("columns", " ").alias("header"),
        F.array_join("expected", " ").alias("expected"),
        F.size("columns").cast("bigint").alias("columns"),
    )


@query(f"SELECT o_orderkey, {SHORT_DAY_SQL.format('o_orderdate')} AS day_text, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders")
def ordered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in order; the place is read off the files, not the column."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", short_day_text(F.col("o_orderdate")).alias("day_text"))
    path = scratch_path(spark, "ordered")
    write_in_order(position.sort_by_text_date(orders, "day_text", ["o_orderkey"]), path)
    stored = spark.read.schema("o_orderkey bigint, day_text string").parquet(path)
    files = stored.select("*", F.col("_metadata.file_name").alias("src_name"), F.col("_metadata.row_index").alias("row_no"))
    return concat.concat_by_name(files, "src_name", "row_no", dense=True).drop("src_name", "row_no")


@query("SELECT o_orderkey, o_custkey, o_orderpriority, true AS numbered FROM orders")
def csv_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV files and read back with row numbers.

    ``numbered`` says that the numbers of a row's file run from 0 without gaps.
    """
    path = scratch_path(spark, "tree")
    write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), f"{path}/sub")
    rows = number_csv_rows(read_csv_tree(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string"))
    rows = scratch_table(rows, "numbered")
    files = rows.groupBy("src_file").agg(
        ((F.min("row_no") == 0) & (F.max("row_no") + 1 == F.count(F.lit(1))) & (F.count_distinct("row_no") == F.count(F.lit(1)))).alias("numbered")
    )
    return lookup(rows, files, ["src_file"], "inner").drop("src_file", "row_no")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS event_ids FROM events GROUP BY 1, 2")
def day_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of day tables per day, read back as one table with file and row number."""
    path = scratch_path(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").cast("string").alias("day"))
    write_by(events, path, "day")
    read = read_day_tables(spark, path, recursive=True, schema="event_id bigint, event_type string")
    return (
        read.groupBy(F.regexp_extract("src_file", "/day=([^/]*)/", 1).alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("event_ids"))
    )
