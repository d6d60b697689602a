"""Rules on single values, one case per rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetloom.functions import columns, dates, draws, paths
from fleetloom.operators import bands, cleanse


def one(spark, value, expression, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(expression(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("text", "tidied"),
    [
        ("2025/1/3", "2025/1/3"),
        ("2025-1-3", "2025/1/3"),
        ("2025-01-03 00:00:00", "2025/01/03"),
        ("11/30/2025", "2025/11/30"),
        ("2025/1/1 0:00:00---2025/1/1 0:00:00合计:", "2025/1/1"),
        ("1/2/2024 and 2025-3-4", "2025/3/4"),
        ("", ""),
        ("n/a", "n/a"),
        (None, None),
    ],
)
def test_tidy_date_text(spark, text, tidied):
    assert one(spark, text, dates.tidy_date_text) == tidied


def test_tidy_date_text_of_timestamps(spark):
    assert one(spark, dt.datetime(2025, 1, 3), dates.tidy_date_text, "timestamp") == "2025/01/03"


@pytest.mark.parametrize(
    ("stem", "day"),
    [("0101", dt.date(2025, 1, 1)), ("0230", None), ("20250101", None), ("abc", None), (None, None)],
)
def test_month_day_name_date(spark, stem, day):
    assert one(spark, stem, lambda c: dates.month_day_name_date(c, 2025)) == day


def test_month_day_name_date_with_year(spark):
    assert one(spark, "20240229", lambda c: dates.month_day_name_date(c, 2025, accept_year=True)) == dt.date(2024, 2, 29)


@pytest.mark.parametrize(
    ("stem", "day", "kind"),
    [
        ("2023_0101_x", dt.date(2023, 1, 1), "with_year"),
        ("2024_0101_x", dt.date(2024, 1, 1), "with_year"),
        ("0328_x", dt.date(2024, 3, 28), "without_year"),
        ("2023_0230_x", None, "failed"),
        ("0101_0203_x", dt.date(2024, 1, 1), "without_year"),
        ("x_0101_", None, "failed"),
    ],
)
def test_prefixed_name_date(spark, stem, day, kind):
    assert one(spark, stem, dates.prefixed_name_date) == day
    assert one(spark, stem, dates.name_date_kind) == kind


@pytest.mark.parametrize(
    ("name", "day"),
    [("from_2025_02_01.csv", dt.date(2025, 2, 1)), ("from_2025_02_30.csv", None), ("to_2025_02_01.csv", None)],
)
def test_list_name_date(spark, name, day):
    assert one(spark, name, dates.list_name_date) == day


def test_short_day_text(spark):
    assert one(spark, dt.date(2025, 2, 1), dates.short_day_text, "date") == "2025/2/1"


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2025/1/1 0:00:00---2025/1/1 0:00:00合计:", dt.date(2025, 1, 1)),
        ("2025/2/30 0:00:00---合计:", None),
        ("---合计", None),
    ],
)
def test_summary_cell(spark, text, day):
    assert one(spark, text, dates.is_summary_cell) is True
    assert one(spark, text, dates.summary_cell_date) == day


@pytest.mark.parametrize(
    ("path", "stem", "ext", "parent"),
    [
        ("a/b/c.d.csv", "c.d", ".csv", "a/b"),
        ("c", "c", "", ""),
        ("/a/.hidden", ".hidden", "", "/a"),
        ("a/x.CSV", "x", ".CSV", "a"),
    ],
)
def test_path_parts(spark, path, stem, ext, parent):
    assert one(spark, path, paths.stem) == stem
    assert one(spark, path, paths.extension) == ext
    assert one(spark, path, paths.parent) == parent


def test_output_names(spark):
    assert one(spark, "d/0101.xlsx", paths.processed_name) == "0101_processed.xlsx"
    assert one(spark, "d/0101.xlsx", lambda c: paths.band_name(c, F.lit("low"))) == "0101_low.xlsx"
    assert one(spark, "d/final.xlsx", paths.shuffled_name) == "final_shuffled.xlsx"
    assert paths.processed_dir("/data/20231201/") == "/data/20231201_处理后"


@pytest.mark.parametrize(("stem", "key"), [("0103_processed_low", "0103"), ("x", "x"), ("_a", "")])
def test_pair_key(spark, stem, key):
    assert one(spark, stem, paths.pair_key) == key


@pytest.mark.parametrize(("name", "temporary"), [("~$a.xlsx", True), (".a", True), ("#a", True), ("~a", False), ("a", False)])
def test_temporary_names(spark, name, temporary):
    assert one(spark, name, paths.is_temporary) is temporary


@pytest.mark.parametrize(
    ("cells", "index", "left"),
    [(["a", "b", "c"], 1, ["a", "c"]), (["a"], 1, ["a"]), ([], 1, []), (["a"], 0, [])],
)
def test_drop_cell(spark, cells, index, left):
    assert one(spark, cells, lambda c: cleanse.drop_cell(c, index), "array<string>") == left


def test_negative_index_is_rejected(spark):
    with pytest.raises(ValueError):
        cleanse.drop_cell(F.col("v"), -1)
    with pytest.raises(ValueError):
        columns.drop_column_at(spark.range(1), -1)


def test_replacing_nothing_is_rejected():
    with pytest.raises(ValueError):
        cleanse.replace_text(F.col("v"), "", "x")


def test_replace_is_literal(spark):
    assert one(spark, "a.b.c", lambda c: cleanse.replace_text(c, ".", "-")) == "a-b-c"


def test_replace_in_table_renames_columns(spark):
    frame = spark.createDataFrame([("ԥA", 1)], "`ԥx` string, n int")
    out = cleanse.replace_in_table(frame)
    assert out.columns == ["豫x", "n"]
    assert out.first()[0] == "豫A"


def test_column_lookup(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "`My Plate` int, `总里程` int, `mileage` int, `Date` int")
    assert columns.plate_column(frame) == "My Plate"
    assert columns.mileage_column(frame) == "总里程"
    assert columns.tidy_date_column(frame) == "Date"
    with pytest.raises(columns.ColumnNotFound, match="My Plate"):
        columns.plate_column(frame, "车号")
    assert columns.columns_by_keyword(frame, ("date",)) == ["Date"]


def test_column_choice(spark):
    frame = spark.range(1).selectExpr("1 a", "2 b", "3 c")
    assert columns.keep_first_columns(frame, 2).columns == ["a", "b"]
    assert columns.keep_first_columns(frame, 0).columns == ["a", "b", "c"]
    assert columns.drop_column_at(frame, 5).columns == ["a", "b", "c"]
    assert columns.split_columns(frame, 2) == (["a", "b"], ["c"])
    assert columns.prefix_columns(frame, "low_", ["a"]).columns == ["a", "low_b", "low_c"]


def test_normal_text(spark):
    assert one(spark, "  Ab ", columns.normal_text) == "ab"


def test_bands(spark):
    assert bands.parse_band("0,30,low") == bands.Band(0.0, 30.0, "low")
    with pytest.raises(ValueError):
        bands.parse_band("0,30")
    with pytest.raises(ValueError):
        bands.parse_band("a,30,low")
    frame = spark.createDataFrame([(0.0,), (30.0,), (30.01,), (None,)], "v double")
    assert [r.v for r in bands.band_filter(frame, "v", bands.Band(0, 30, "low")).collect()] == [0.0, 30.0]


def test_draws_are_even_and_fixed(spark):
    frame = spark.range(20000).select((draws.draw(1, F.col("id")) / F.lit(2**60)).alias("u"))
    mean, low, high = frame.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(mean - 0.5) < 0.01 and 0 <= low < 0.001 and 0.999 < high < 1
    assert one(spark, 7, lambda c: draws.draw(1, c), "int") == one(spark, 7, lambda c: draws.draw(1, c), "bigint")
    assert 0 <= draws.new_seed() < 2**32
