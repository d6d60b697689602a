"""Names, keys and checks that the other queries do not reach."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import paths
from fleetloom.functions.columns import normal_text, plate_column
from fleetloom.functions.dates import list_name_date
from fleetloom.operators import bands, concat
from fleetloom.plans import vehicles
from fleetloom.queries.registry import query, table
from fleetloom.session import scratch_path
from fleetloom.sources.sinks import write_by


@query(
    """
    SELECT s_suppkey, CAST(try_strptime(regexp_extract(name, '^from_([0-9]{4}_[0-9]{2}_[0-9]{2})[.]csv$', 1), '%Y_%m_%d') AS DATE) AS from_date
    FROM (SELECT s_suppkey, 'from_2025_' || lpad(CAST(s_suppkey % 14 AS VARCHAR), 2, '0') || '_' || lpad(CAST(s_suppkey % 33 AS VARCHAR), 2, '0') || '.csv' AS name FROM supplier)
    """
)
def list_name_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of list names, some of which name no day."""
    part = [F.lpad((F.col("s_suppkey") % n).cast("string"), 2, "0") for n in (14, 33)]
    name = F.concat(F.lit("from_2025_"), part[0], F.lit("_"), part[1], F.lit(".csv"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", list_name_date(name).alias("from_date"))


@query("SELECT c_custkey, lower(c_name) AS name FROM customer")
def normal_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.upper("c_name"), F.lit(" "))
    return table(spark, sf_dir, "customer").select("c_custkey", normal_text(padded).alias("name"))


@query(
    """
    SELECT CASE WHEN value <= 30 THEN 'low' ELSE 'medium' END AS range_label, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS event_ids
    FROM events WHERE value BETWEEN 0 AND 30 OR value BETWEEN 45 AND 85 GROUP BY 1
    """
)
def mileage_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value column is found by its name."""
    records = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("日期"), F.col("value").alias("总里程(公里)")
    )
    banded = vehicles.tidy_and_band(records, carry=("event_id",)).where(F.col("range_label").isin("low", "medium"))
    return banded.groupBy("range_label").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("event_ids"))


@query("SELECT strftime(ts, '%m%d') AS pair_key, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS event_ids FROM events GROUP BY 1")
def pair_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of processed day files in a folder per pair key, read back."""
    stem = F.concat(F.date_format("ts", "MMdd"), F.lit("_processed_"), "event_type")
    rows = table(spark, sf_dir, "events").select("event_id", paths.pair_key(stem).alias("pair_key"))
    path = scratch_path(spark, "pairs")
    write_by(rows, path, "pair_key")
    stored = spark.read.schema("event_id bigint, pair_key string").parquet(path)
    return stored.groupBy("pair_key").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("event_ids"))


def _verdict(check: Callable[[], object]) -> str:
    try:
        check()
    except (ValueError, LookupError) as problem:
        return type(problem).__name__
    return "ok"


@query(
    """
    SELECT 'equal types' AS name, 'ok' AS verdict, count(*) AS rows FROM supplier
    UNION ALL SELECT 'other types', 'SchemaMismatch', count(*) FROM supplier
    UNION ALL SELECT 'ten columns', 'ok', count(*) FROM lineitem
    UNION ALL SELECT 'five columns', 'SchemaMismatch', count(*) FROM lineitem
    UNION ALL SELECT 'no rows', 'SchemaMismatch', 0 FROM region WHERE r_regionkey = 0
    UNION ALL SELECT 'no plate column', 'ColumnNotFound', count(*) FROM nation
    UNION ALL SELECT 'band of two parts', 'ValueError', count(*) FROM nation
    """
)
def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per check: what it says of a table that passes or fails it, and the table's rows."""
    supplier, lineitem, nation = (table(spark, sf_dir, name) for name in ("supplier", "lineitem", "nation"))
    retyped = supplier.withColumn("s_suppkey", F.col("s_suppkey").cast("string"))
    ten, none = lineitem.select(lineitem.columns[:10]), lineitem.select(lineitem.columns[:10]).where("l_orderkey is null")
    checks = [
        ("equal types", supplier, lambda: concat.concat_strict([supplier, supplier], same_types=True)),
        ("other types", supplier, lambda: concat.concat_strict([supplier, retyped], same_types=True)),
        ("ten columns", ten, lambda: concat.check_paired_table(ten)),
        ("five columns", lineitem, lambda: concat.check_paired_table(lineitem.select(lineitem.columns[:5]))),
        ("no rows", none, lambda: concat.check_paired_table(none)),
        ("no plate column", nation, lambda: plate_column(nation)),
        ("band of two parts", nation, lambda: bands.parse_band("0,30")),
    ]
    return spark.createDataFrame([(name, _verdict(check), frame.count()) for name, frame, check in checks], "name string, verdict string, rows bigint")
