"""The plans have the shape large data needs."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetloom.operators import bands, lookups, purge


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def formatted(frame):
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def query(spark, name):
    return entry.queries()[name](spark, SF_DIR)


def test_band_filter_reaches_the_scan(spark):
    text = formatted(query(spark, "band_filter"))
    assert "GreaterThanOrEqual(value,0.0)" in text and "LessThanOrEqual(value,30.0)" in text
    assert "Exchange" not in text


def test_columns_are_pruned(spark):
    text = formatted(query(spark, "keep_first_columns"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double>" in text


@pytest.mark.parametrize("name", ["band_fanout", "tidy_date_text", "replace_literal", "drop_cell_ragged", "clean_files"])
def test_row_work_is_not_shuffled(spark, name):
    text = plan(query(spark, name))
    assert "Exchange" not in text and "Python" not in text


def test_small_list_is_broadcast(spark):
    text = plan(query(spark, "purge_from_date"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_list_is_joined_where_hot_keys_can_be_split(spark, monkeypatch):
    """Equal rows of a hot key go to more than one task."""
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 3)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(40_000).repartition(16).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"))
        terms = spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        for how, expected in (("left", 40_000), ("left_anti", 26_666), ("inner", 13_334)):
            joined = lookups.lookup(rows, terms, ["k"], how)
            assert joined.count() == expected
            joined.write.format("noop").mode("overwrite").save()
            assert "skew=true" in _ran(joined) or how == "inner"
    finally:
        for name in settings:
            spark.conf.unset(name)


def _ran(frame):
    frame.collect()
    return plan(frame)


def test_one_cell_per_file_leaves_a_task(spark):
    text = plan(query(spark, "content_date"))
    assert "partial_min_by" in text and "Window" not in text


def test_counts_combine_before_the_shuffle(spark):
    text = plan(bands.band_counts(spark.read.parquet(f"{SF_DIR}/events.parquet"), "event_type", "value"))
    assert text.count("HashAggregate") == 2 and "partial_count" in text


@pytest.mark.parametrize("name", ["align_top_up", "shuffle_right_half", "concat_by_date", "plate_calendar", "flagship"])
def test_no_cross_join(spark, name):
    text = plan(query(spark, name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_hot_key_is_spread(spark, small_limits):
    """A key with a third of all rows is sorted in many pieces."""
    from fleetloom.operators import position

    frame = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = position.sorted_slices(frame, ["k", "id"], "hot").where("k = 0").groupBy("_slice").count()
        assert spread.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranked = position.random_rank(
        frame.withColumn("n", F.when(F.col("k") == 0, 1000).otherwise(1)), ["k"], F.col("n"), 1000,
        F.shiftleft(F.col("id"), 48), ["id"], "r",
    )
    assert ranked.where("k = 0").agg(F.max("r"), F.count_distinct("r")).first()[:] == (999, 1000)


def test_purge_terms_have_one_row_per_plate(spark):
    lists = spark.range(100).selectExpr("cast(id % 7 as string) AS plate", "date_add(date'2025-01-01', cast(id as int)) AS from_date")
    assert purge.purge_terms(lists).count() == 7
