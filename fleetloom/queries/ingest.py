"""Cleaning files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.queries.registry import query, table
from fleetloom.session import scratch_path
from fleetloom.sources.sinks import write_csv
from fleetloom.streaming import ingest


def _arrivals(spark: SparkSession, sf_dir: str) -> str:
    """Write the events as CSV files in three slices; ingest after each one and once more."""
    root = scratch_path(spark, "arrivals")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.concat(F.lit("ԥ"), "event_type").alias("event_type"), "props"
    )
    for part in range(3):
        write_csv(events.where(F.col("event_id") % 3 == part), f"{root}/in/slice{part}")
        ingest.clean_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", column_index=1)
    ingest.clean_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", column_index=1)
    return f"{root}/out"


@query("SELECT event_id, '豫' || event_type AS event_type, props FROM events")
def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.cleaned_rows(spark, _arrivals(spark, sf_dir)).where("row_no > 0")
    cell = [F.get("cells", i) for i in range(3)]
    return rows.select(cell[0].cast("bigint").alias("event_id"), cell[1].alias("event_type"), cell[2].alias("props"))


@query("SELECT 'before' AS moment, true AS pending, 0 AS rows FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'after', false, count(*) FROM events")
def ingest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What waits before the first run, when nothing is stored yet, and after it."""
    root = scratch_path(spark, "pending")
    source, target = f"{root}/in", f"{root}/out"
    write_csv(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").repartition(3), source)
    seen = []
    for moment in ("before", "after"):
        stored = ingest.ledger(spark, target).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0))).first()[0]
        seen.append((moment, not ingest.pending_files(spark, source, target).isEmpty(), stored))
        if moment == "before":
            ingest.clean_new_files(spark, source, target, f"{root}/checkpoint")
    return spark.createDataFrame(seen, "moment string, pending boolean, rows bigint")


@query("SELECT event_id, '豫' || event_type AS event_type FROM events")
def ingest_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable files are tried twice under one label, are gone the second time, and come anew."""
    root = scratch_path(spark, "retry")
    source, target, checkpoint = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("ԥ"), "event_type").alias("event_type"))
    bad = events.where("event_id % 3 = 0")
    write_csv(events.where("event_id % 3 <> 0"), f"{source}/good")
    bad.write.option("header", True).option("encoding", "UTF-16").csv(f"{source}/bad")
    ingest.clean_new_files(spark, source, target, checkpoint, column_index=None)
    ingest.retry_failed(spark, target, "again", column_index=None)
    bad.write.mode("overwrite").option("header", True).csv(f"{source}/bad")
    ingest.retry_failed(spark, target, "again", column_index=None)
    ingest.clean_new_files(spark, source, target, checkpoint, column_index=None)
    rows = ingest.cleaned_rows(spark, target).where("row_no > 0")
    return rows.select(F.get("cells", F.lit(0)).cast("bigint").alias("event_id"), F.get("cells", F.lit(1)).alias("event_type"))


@query("SELECT 'ok' AS status, count(*) AS data_rows FROM events")
def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file counts its header row, which the ledger's rows include."""
    done = ingest.ledger(spark, _arrivals(spark, sf_dir))
    return done.groupBy("status").agg(F.sum(F.col("rows") - 1).alias("data_rows"))


@query(
    """
    SELECT event_id, '豫' || event_type AS event_type, 'a' || chr(10) || user_id AS note, event_id % 50 = 0 AS short FROM events
    """
)
def ingest_long_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files above and below a limit of 1,000 bytes, with cells that run over lines, in one run of the streams."""
    root = scratch_path(spark, "long")
    source, target = f"{root}/in", f"{root}/out"
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.concat(F.lit("ԥ"), "event_type").alias("event_type"), F.concat(F.lit("a\n"), F.col("user_id").cast("string")).alias("note")
    )
    write_csv(events.where("event_id % 50 <> 0"), f"{source}/long")
    events.where("event_id % 50 = 0").write.option("header", True).option("maxRecordsPerFile", 10).csv(f"{source}/short")
    ingest.clean_new_files(spark, source, target, f"{root}/checkpoint", column_index=1, whole_file_bytes=1000)
    cell = [F.get("cells", i) for i in range(3)]
    return ingest.cleaned_rows(spark, target).where("row_no > 0").select(
        cell[0].cast("bigint").alias("event_id"), cell[1].alias("event_type"), cell[2].alias("note"), F.contains("src_file", F.lit("/short/")).alias("short")
    )
