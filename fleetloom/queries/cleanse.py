"""Cleansing: columns, cells, names and date texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import dates, paths
from fleetloom.functions.columns import drop_column_at
from fleetloom.functions.columns import keep_first_columns as first_columns
from fleetloom.operators import cleanse, reports
from fleetloom.plans.clean import clean_directory, clean_summary, dry_run_files
from fleetloom.queries.registry import query, table
from fleetloom.session import qualified, scratch_path, scratch_table
from fleetloom.sources.csv_files import read_ragged_csv
from fleetloom.sources.file_tree import file_digests, in_files, list_files, write_named_files
from fleetloom.sources.plate_lists import plates_of
from fleetloom.sources.sinks import csv_line, write_ragged_csv


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the date as text."""
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    """
    SELECT o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
    """
)
def drop_column_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_column_at(_orders(spark, sf_dir), 0)


@query(
    """
    SELECT doc_id, len(string_split(text, ' ')) AS cells,
           array_to_string(list_filter(string_split(text, ' '), lambda x, i: i <> 6), ' ') AS text
    FROM documents
    """
)
def drop_cell_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(cells).cast("bigint").alias("cells"),
        F.array_join(cleanse.drop_cell(cells, 5), " ").alias("text"),
    )


@query(
    """
    SELECT lang, cells, count(*) AS rows
    FROM (
        SELECT lang, array_to_string(list_filter(string_split(line, ' '), lambda x, i: i <> 2), '|') AS cells
        FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
    )
    GROUP BY lang, cells
    """
)
def drop_cell_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' lines written as ragged CSV files, read back, one cell dropped."""
    documents = table(spark, sf_dir, "documents")
    lines = documents.select("lang", "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = lines.select("lang", F.struct("doc_id", "line_no").alias("row_no"), F.split("line", " ").alias("cells"))
    path = scratch_path(spark, "ragged")
    write_ragged_csv(rows, path, "lang")
    read = read_ragged_csv(spark, path, name_glob="*.txt").where("row_no >= 0")
    return (
        read.select(
            F.regexp_extract("src_file", "/lang=([^/]*)/", 1).alias("lang"),
            F.array_join(cleanse.drop_cell(F.col("cells"), 1), "|").alias("cells"),
        )
        .groupBy("lang", "cells")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    """
    SELECT doc_id, replace(text, 'é', 'e') AS text, contains(text, 'é') AS changed FROM documents
    """
)
def replace_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.contains("text", F.lit("é")).alias("changed"))
    return cleanse.replace_in_table(documents, "é", "e")


@query(
    """
    WITH files AS (
        SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM pages
    ), parts AS (
        SELECT page_id, path, contains(path, '/') AS nested,
               CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*)/[^/]*$', 1) ELSE '' END AS folder,
               regexp_extract(path, '[^/]*$') AS name
        FROM files
    )
    SELECT page_id, path,
           CASE WHEN folder = '' THEN replace(name, '1', 'one') ELSE folder || '/' || replace(name, '1', 'one') END AS new_path,
           contains(name, '1') AS renamed
    FROM parts
    """
)
def rename_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^https?://", "").alias("path"))
    return cleanse.rename_files(files, "path", "1", "one")


_PLATE_FILES_SQL = """
    SELECT page_id, 'data/' || CAST(page_id % 20 AS VARCHAR) || CASE WHEN page_id % 3 = 0 THEN 'ԥ' ELSE '豫' END || '.csv' AS path
    FROM pages
"""


@query(
    f"""
    SELECT replace(path, 'ԥ', '豫') AS new_path, count(DISTINCT path) AS files
    FROM ({_PLATE_FILES_SQL})
    GROUP BY 1 HAVING count(DISTINCT path) > 1
    """
)
def rename_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    char = F.when(F.col("page_id") % 3 == 0, "ԥ").otherwise("豫")
    files = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("data/"), (F.col("page_id") % 20).cast("string"), char, F.lit(".csv")).alias("path")
    )
    return cleanse.rename_clashes(cleanse.rename_files(files, "path"), "path")


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files: some names hold é, the extensions differ."""
    page = F.col("page_id")
    name = F.concat(F.when(page % 2 == 0, "pé").otherwise("pe"), page.cast("string"))
    ext = F.when(page % 3 == 0, ".CSV").when(page % 3 == 1, ".csv").otherwise(".html")
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("data/é/"), name, ext).alias("path"), "html")


_PAGE_FILES_SQL = """
    SELECT page_id, html,
           CASE WHEN page_id % 2 = 0 THEN 'pé' ELSE 'pe' END || CAST(page_id AS VARCHAR)
               || CASE page_id % 3 WHEN 0 THEN '.CSV' WHEN 1 THEN '.csv' ELSE '.html' END AS name
    FROM pages
"""


@query(
    f"""
    SELECT page_id, 'data/é/' || name AS path, 'data/é/' || replace(name, 'é', 'e') AS new_path,
           contains(name, 'é') AS renamed,
           CASE WHEN lower(name) LIKE '%.csv' THEN replace(html, 'é', 'e') ELSE html END AS html
    FROM ({_PAGE_FILES_SQL})
    WHERE contains(name, 'é') OR lower(name) LIKE '%.csv'
    """
)
def clean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _page_files(spark, sf_dir).where(cleanse.needs_replacement(F.col("path"), "é"))
    return cleanse.clean_files(files, "path", "html", "é", "e")


@query(
    f"""
    SELECT count(*) AS files,
           count(*) FILTER (lower(name) LIKE '%.csv') AS csv_files,
           count(*) FILTER (contains(name, 'é') OR lower(name) LIKE '%.csv') AS files_to_process,
           count(*) FILTER (contains(name, 'é')) AS files_to_rename,
           count(*) FILTER (lower(name) LIKE '%.csv' AND contains(html, 'é')) AS contents_to_change
    FROM ({_PAGE_FILES_SQL})
    """
)
def clean_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse.dry_run(_page_files(spark, sf_dir), "path", "html", "é")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def keep_first_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_columns(table(spark, sf_dir, "lineitem"), 5)


def mixed_date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their date written in six ways."""
    day, shape = F.to_date("o_orderdate"), F.col("o_orderkey") % 6
    short = dates.short_day_text(day)
    text = (
        F.when(shape == 0, short)
        .when(shape == 1, F.date_format(day, "yyyy-MM-dd 00:00:00"))
        .when(shape == 2, F.date_format(day, "M/d/yyyy"))
        .when(shape == 3, F.concat(short, F.lit(" 0:00:00---"), short, F.lit(" 0:00:00合计:")))
        .when(shape == 4, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("n/a "), F.col("o_orderkey").cast("string")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("日期"))


SHORT_DAY_SQL = "year({0}) || '/' || month({0}) || '/' || day({0})"
_SHORT = SHORT_DAY_SQL.format("o_orderdate")

MIXED_DATE_SQL = f"""
    SELECT o_orderkey, CASE o_orderkey % 6
        WHEN 0 THEN {_SHORT}
        WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'
        WHEN 2 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
        WHEN 3 THEN {_SHORT} || ' 0:00:00---' || {_SHORT} || ' 0:00:00合计:'
        WHEN 4 THEN NULL
        ELSE 'n/a ' || o_orderkey END AS raw
    FROM orders
"""

TIDY_SQL = """
    CASE WHEN regexp_matches({0}, '\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}') THEN regexp_extract({0}, '\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}')
         WHEN regexp_matches({0}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN replace(regexp_extract({0}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}'), '-', '/')
         WHEN regexp_matches({0}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN regexp_extract({0}, '(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}})', 3)
              || '/' || regexp_extract({0}, '(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}})', 1)
              || '/' || regexp_extract({0}, '(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}})', 2)
         ELSE {0} END
"""


@query(
    f"""
    SELECT o_orderkey, {TIDY_SQL.format('raw')} AS "日期",
           coalesce(contains(raw, '---') AND contains(raw, '合计'), false) AS is_summary
    FROM ({MIXED_DATE_SQL})
    """
)
def tidy_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse.tidy_dates(mixed_date_texts(spark, sf_dir), summary_flag="is_summary")


def _dated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stems made of the orders' dates, some without year, some impossible."""
    shape = F.col("o_orderkey") % 5
    stem = (
        F.when(shape == 0, F.date_format("o_orderdate", "yyyy_MMdd'_day'"))
        .when(shape == 1, F.date_format("o_orderdate", "MMdd'_day'"))
        .when(shape == 2, F.date_format("o_orderdate", "MMdd"))
        .when(shape == 3, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("_0230_day")))
        .otherwise(F.concat(F.lit("day_"), F.col("o_orderkey").cast("string")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", stem.alias("stem"))


_DATED_NAMES_SQL = """
    SELECT o_orderkey, CASE o_orderkey % 5
        WHEN 0 THEN strftime(o_orderdate, '%Y_%m%d_day')
        WHEN 1 THEN strftime(o_orderdate, '%m%d_day')
        WHEN 2 THEN strftime(o_orderdate, '%m%d')
        WHEN 3 THEN strftime(o_orderdate, '%Y') || '_0230_day'
        ELSE 'day_' || o_orderkey END AS stem
    FROM orders
"""
_NAME_DATES_SQL = f"""
    SELECT o_orderkey, stem,
           CASE WHEN regexp_matches(stem, '^\\d{{4}}_\\d{{4}}_') AND CAST(substr(stem, 1, 4) AS INT) BETWEEN 1900 AND 2100
                THEN CAST(try_strptime(substr(stem, 1, 4) || substr(stem, 6, 4), '%Y%m%d') AS DATE) END AS with_year,
           CASE WHEN regexp_matches(stem, '^\\d{{4}}_')
                THEN CAST(try_strptime('2024' || substr(stem, 1, 4), '%Y%m%d') AS DATE) END AS without_year,
           CASE WHEN regexp_matches(stem, '^[0-9]{{4}}$')
                THEN CAST(try_strptime('2025' || stem, '%Y%m%d') AS DATE) END AS month_day
    FROM ({_DATED_NAMES_SQL})
"""


@query(
    f"""
    SELECT o_orderkey, stem, CAST(coalesce(with_year, without_year) AS VARCHAR) AS name_date,
           CASE WHEN with_year IS NOT NULL THEN 'with_year' WHEN without_year IS NOT NULL THEN 'without_year' ELSE 'failed' END AS kind,
           CAST(month_day AS VARCHAR) AS month_day_date
    FROM ({_NAME_DATES_SQL})
    """
)
def file_name_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.col("stem")
    return _dated_names(spark, sf_dir).select(
        "o_orderkey",
        "stem",
        dates.prefixed_name_date(stem).cast("string").alias("name_date"),
        dates.name_date_kind(stem).alias("kind"),
        dates.month_day_name_date(stem, 2025).cast("string").alias("month_day_date"),
    )


@query(
    f"""
    SELECT CASE WHEN with_year IS NOT NULL THEN 'with_year' WHEN without_year IS NOT NULL THEN 'without_year' ELSE 'failed' END AS kind,
           count(*) AS files,
           min(year(coalesce(with_year, without_year))) AS first_year,
           max(year(coalesce(with_year, without_year))) AS last_year
    FROM ({_NAME_DATES_SQL})
    GROUP BY 1
    """
)
def file_name_date_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.name_date_stats(_dated_names(spark, sf_dir), F.col("stem"))


@query(
    """
    SELECT c_custkey, split_part(c_name, '#', 1) AS pair_key, split_part(c_name, '#', 1) || '_merged.parquet' AS merged_name
    FROM customer
    """
)
def pair_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = paths.pair_key(F.col("c_name"), "#")
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("pair_key"), paths.merged_name(key).alias("merged_name"))


@query(
    """
    WITH names AS (
        SELECT page_id, url, regexp_extract(url, '[^/]*$') AS name FROM pages
    ), parts AS (
        SELECT page_id, url, name, regexp_extract(name, '^.+(\\.[^.]+)$', 1) AS ext FROM names
    )
    SELECT page_id, name, ext, left(name, length(name) - length(ext)) AS stem,
           regexp_extract(url, '^(.*)/[^/]*$', 1) AS parent,
           left(name, length(name) - length(ext)) || '_processed' || ext AS processed_name,
           left(name, length(name) - length(ext)) || '_low' || ext AS band_name,
           left(name, length(name) - length(ext)) || '_shuffled' || ext AS shuffled_name
    FROM parts
    """
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.file_name(url).alias("name"),
        paths.extension(url).alias("ext"),
        paths.stem(url).alias("stem"),
        paths.parent(url).alias("parent"),
        paths.processed_name(url).alias("processed_name"),
        paths.band_name(url, F.lit("low")).alias("band_name"),
        paths.shuffled_name(url).alias("shuffled_name"),
    )


@query(
    """
    SELECT DISTINCT trim(raw) AS plate
    FROM (SELECT CASE o_orderkey % 10 WHEN 0 THEN 'nan' WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE '  V' || o_custkey || ' ' END AS raw FROM orders)
    WHERE raw IS NOT NULL AND trim(raw) NOT IN ('', 'nan')
    """
)
def plate_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.col("o_orderkey") % 10
    raw = (
        F.when(shape == 0, "nan")
        .when(shape == 1, "  ")
        .when(shape > 2, F.concat(F.lit("  V"), F.col("o_custkey").cast("string"), F.lit(" ")))
    )
    return plates_of(table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("License Plate")))


def _event_files(spark: SparkSession, sf_dir: str, name: Column, cells: list[Column]) -> DataFrame:
    """Events as rows of named files, in the order of their ids."""
    return in_files(table(spark, sf_dir, "events").select(name.alias("name"), F.col("event_id").alias("row_no"), csv_line(F.array(*cells)).alias("line")))


@query(
    """
    SELECT event_id, 'event_type=' || event_type AS folder, '豫' || (user_id % 8) || '.csv' AS file, '豫' || user_id AS plate
    FROM events
    """
)
def clean_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in a folder per event type, cleaned to files of the new names in the same folders."""
    root, text = scratch_path(spark, "tree"), F.col("user_id").cast("string")
    name = F.concat(F.lit("event_type="), "event_type", F.lit("/ԥ"), (F.col("user_id") % 8).cast("string"), F.lit(".csv"))
    write_named_files(_event_files(spark, sf_dir, name, [F.col("props"), F.col("event_id").cast("string"), F.concat(F.lit("ԥ"), text)]), f"{root}/in")
    clean_directory(spark, f"{root}/in", f"{root}/out", layout="files")
    rows = read_ragged_csv(spark, f"{root}/out").where("row_no >= 0")
    return rows.select(
        F.get("cells", F.lit(0)).cast("bigint").alias("event_id"),
        F.substring_index(paths.parent(F.col("src_file")), "/", -1).alias("folder"),
        paths.file_name(F.col("src_file")).alias("file"),
        F.get("cells", F.lit(1)).alias("plate"),
    )


_KIND_NAMES = {0: ("ԥ", ".csv"), 1: ("", ".CSV"), 2: ("ԥ", ".txt"), 3: ("", ".log")}


@query(
    """
    WITH lines AS (
        SELECT event_type, user_id, user_id % 4 AS kind, event_id,
               CASE WHEN user_id % 4 < 2 THEN '豫' || event_type || ',' || user_id ELSE event_id || ',ԥ' || event_type || ',' || user_id END AS line
        FROM events
    ), files AS (
        SELECT event_type || '/' AS folder, kind,
               CASE kind WHEN 0 THEN 'ԥ' || user_id || '.csv' WHEN 1 THEN user_id || '.CSV' ELSE 'ԥ' || user_id || '.txt' END AS file,
               CASE WHEN kind < 2 THEN count(*) ELSE 0 END AS rows, md5(string_agg(line, chr(10) ORDER BY event_id) || chr(10)) AS digest
        FROM lines WHERE kind < 3 GROUP BY event_type, user_id, kind
        UNION ALL
        SELECT event_type || '/', kind, 'ԥempty' || ext, 0, md5('')
        FROM (SELECT DISTINCT event_type FROM events), (VALUES (0, '.csv'), (2, '.txt')) AS empties(kind, ext)
    )
    SELECT folder || file AS name, folder || replace(file, 'ԥ', '豫') AS new_name, kind < 2 AS is_csv, contains(file, 'ԥ') AS renamed,
           rows, digest
    FROM files
    """
)
def clean_tree_all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV, other and empty files: what the dry run says of each, next to what the clean has written."""
    root, user = scratch_path(spark, "all-files"), F.col("user_id")
    name = F.lit(None).cast("string")
    for kind, (first, ext) in _KIND_NAMES.items():
        name = F.when(user % 4 == kind, F.concat("event_type", F.lit(f"/{first}"), user.cast("string"), F.lit(ext))).otherwise(name)
    rows = _event_files(spark, sf_dir, name, [F.col("event_id").cast("string"), F.concat(F.lit("ԥ"), "event_type"), user.cast("string")])
    empty = table(spark, sf_dir, "events").select("event_type").distinct()
    empty = empty.select("event_type", F.explode(F.array(F.lit("/ԥempty.csv"), F.lit("/ԥempty.txt"))).alias("file"))
    empty = empty.select(F.concat("event_type", "file"), F.lit(-1).cast("bigint"), F.lit(None).cast("string"))
    write_named_files(rows.union(empty), f"{root}/in")
    planned = dry_run_files(spark, f"{root}/in")
    outcomes = clean_directory(spark, f"{root}/in", f"{root}/out", layout="files")
    folder = F.lit(f"{qualified(spark, root)}/")
    below = lambda path, part: F.substr(path, F.instr(path, F.concat(folder, F.lit(part))) + F.length(folder) + len(part))
    written = file_digests(list_files(spark, f"{root}/out")).select(below(F.col("path"), "out/").alias("new_name"), "digest")
    counted = outcomes.select(below(F.col("src_file"), "in/").alias("name"), F.col("rows_after").alias("rows"))
    return planned.join(written, "new_name", "full").join(counted, "name", "full").select("name", "new_name", "is_csv", "renamed", "rows", "digest")


@query(
    """
    SELECT count(DISTINCT user_id % 20) + 1 AS files, count(DISTINCT user_id % 20) AS ok, CAST(1 AS BIGINT) AS failed,
           count(DISTINCT user_id % 20) * 100.0::DOUBLE / (count(DISTINCT user_id % 20) + 1) AS success_pct,
           count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS rows_deleted
    FROM events
    """
)
def clean_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a run, observed while it writes; one of its files is no text."""
    root = scratch_path(spark, "outcomes-in")
    name = F.concat((F.col("user_id") % 20).cast("string"), F.lit(".csv"))
    no_text = scratch_table(table(spark, sf_dir, "region"), "no-text").select(F.col("_metadata.file_path").alias("copy_of")).limit(1)
    bad = no_text.select(F.lit("bad.csv"), F.lit(0).cast("bigint"), F.lit(None).cast("string"), "copy_of")
    rows = _event_files(spark, sf_dir, name, [F.col("props"), F.col("event_id").cast("string")]).withColumn("copy_of", F.lit(None).cast("string"))
    write_named_files(rows.union(bad), root)
    return clean_summary(spark, root, scratch_path(spark, "outcomes-out"))
