"""Operators on small tables made for one rule each."""

import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetloom.operators import bands, calendar, cleanse, concat, pairing, position, purge, reports
from fleetloom.operators.lookups import lookup

DAY = dt.date(2025, 1, 1)


def test_index_within_any_size(spark, small_limits):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 5 == 0, F.col("id")).alias("key"), (1000 - F.col("id")).alias("v")
    )
    got = position.index_within(frame, ["key"], ["v"])
    expected = frame.toPandas()
    expected["pos"] = expected.groupby("key", dropna=False)["v"].rank(method="first").astype(int) - 1
    assert values(got.select("v", "pos")) == sorted(map(tuple, expected[["v", "pos"]].to_numpy().tolist()), key=str)


def test_row_index_with_nulls(spark):
    frame = spark.createDataFrame([(None, 1), (2, 2), (None, 3), (1, 4)], "k int, id int")
    got = position.row_index(frame, [F.col("k").asc_nulls_last(), "id"])
    assert [r.id for r in got.orderBy("pos").collect()] == [4, 2, 1, 3]


def test_row_index_of_nothing(spark):
    assert position.row_index(spark.range(0), ["id"]).count() == 0


def test_running_total(spark):
    frame = spark.range(2000).select("id", (F.col("id") % 7).alias("n"))
    got = position.running_total(frame, ["id"], F.col("n"), "before").orderBy("id").collect()
    total = 0
    for row in got:
        assert row.before == total
        total += row.n


def test_random_order_is_a_permutation(spark, small_limits):
    frame = spark.range(500)
    got = position.shuffle_rows(frame, ["id"], 3).orderBy("id").collect()
    assert sorted(r.pos for r in got) == list(range(500))
    assert sum(r.pos == r.id for r in got) < 10
    again = position.shuffle_rows(frame.repartition(7), ["id"], 3).orderBy("id").collect()
    assert again == got
    other = position.shuffle_rows(frame, ["id"], 4).orderBy("id").collect()
    assert other != got


def test_shuffle_right_keeps_both_halves(spark):
    frame = spark.range(100).select("id", (F.col("id") * 2).alias("a"), (F.col("id") * 3).alias("b"))
    got = position.shuffle_right(frame, ["id"], ["id"], 42)
    assert values(got, "pos", "id") == sorted([(i, i) for i in range(100)], key=str)
    assert values(got, "a", "b") == values(frame, "a", "b")
    audit = position.shuffle_audit(position.row_index(frame, ["id"]).drop("id"), got.drop("id")).first()
    assert (audit.compared, audit.lost, audit.added) == (100, 0, 0) and audit.stayed < 10


def test_multiset_difference_sees_copies(spark):
    before = spark.createDataFrame([(1,), (1,), (None,)], "v int")
    after = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert tuple(position.multiset_difference(before, after).first()) == (1, 1)


@pytest.mark.parametrize(
    ("data", "expected"),
    [([1, 2, 2, 3], (4, 0, 0, True)), ([3, 1, 2], (3, 0, 1, False)), ([1, None, 0], (3, 1, 0, False)), ([], (0, 0, 0, True))],
)
def test_sortedness(spark, data, expected):
    frame = spark.createDataFrame(list(enumerate(data)), "k int, v int")
    assert tuple(position.sortedness(frame, ["k"], F.col("v")).first()) == expected


def test_text_dates_keep_their_text(spark):
    frame = spark.createDataFrame([(1, "2025/10/1"), (2, "2025/9/30"), (3, "junk"), (4, "2025-09-30")], "id int, day string")
    got = position.sort_by_text_date(frame, "day", ["id"]).orderBy("pos").collect()
    assert [(r.id, r.day) for r in got] == [(2, "2025/9/30"), (4, "2025-09-30"), (1, "2025/10/1"), (3, "junk")]


def _pairs(spark, low, medium, keys=None):
    left = spark.createDataFrame([("k", i) for i in range(low)], "key string, v int")
    right = spark.createDataFrame([("k", i) for i in range(medium)], "key string, v int")
    return pairing.pair_rows(left, right, "key", ["v"], ["v"], keys=keys).orderBy("pos").collect()


def test_one_medium_row_fills_all(spark):
    assert [(r.pos, r.low_v, r.medium_v) for r in _pairs(spark, 3, 1)] == [(0, 0, 0), (1, 1, 0), (2, 2, 0)]


def test_longer_medium_keeps_its_order(spark):
    assert [(r.pos, r.low_v, r.medium_v) for r in _pairs(spark, 1, 3)] == [(0, 0, 0), (1, None, 1), (2, None, 2)]


def test_no_medium_row_fails_the_pair(spark):
    assert _pairs(spark, 2, 0) == []
    sizes = spark.createDataFrame([("k", 2, 0), ("m", 0, 2)], "key string, left_rows bigint, right_rows bigint")
    got = {r.key: (r.status, r.merged_rows) for r in pairing.pair_report(sizes, "key").collect()}
    assert got == {"k": ("failed", 0), "m": ("ok", 2)}


def test_given_keys_pair_an_empty_low_side(spark):
    keys = spark.createDataFrame([("k",)], "key string")
    assert _pairs(spark, 0, 2) == []
    assert [(r.pos, r.low_v, r.medium_v) for r in _pairs(spark, 0, 2, keys)] == [(0, None, 0), (1, None, 1)]


@pytest.mark.parametrize("medium", [7, 60])
def test_top_up_uses_every_medium_row(spark, small_limits, medium):
    got = _pairs(spark, 500, medium)
    assert [r.pos for r in got] == list(range(500))
    assert [r.low_v for r in got] == list(range(500))
    used = [r.medium_v for r in got]
    assert set(used) == set(range(medium))
    # Dealt out at random: the first rows are not the medium rows in order.
    assert used[:medium] != list(range(medium))
    assert _pairs(spark, 500, medium) == got


def _records(spark, rows):
    return spark.createDataFrame(rows, "id int, plate string, file_date date")


def _lists(spark, rows):
    return spark.createDataFrame(rows, "plate string, from_date date")


def test_purge_by_date(spark):
    later, earlier = dt.date(2025, 3, 1), dt.date(2025, 2, 1)
    records = _records(spark, [(1, None, DAY), (2, "a", DAY), (3, "a", None), (4, "a", later), (5, "b", DAY), (6, "c", DAY)])
    lists = _lists(spark, [("a", later), ("a", earlier), ("b", None), (None, None)])
    left = purge.purge_from_date(records, lists, "plate", "file_date")
    assert [r.id for r in left.orderBy("id").collect()] == [1, 2, 6]
    flagged = purge.flag_purged(records, lists, "plate", "file_date")
    gone = flagged.where("purged").drop("listed", "purged")
    assert left.union(gone).exceptAll(records).isEmpty() and records.exceptAll(left.union(gone)).isEmpty()


def test_purge_spaces_in_data_are_kept(spark):
    records = _records(spark, [(1, " a", DAY), (2, "a", DAY)])
    left = purge.purge_listed(records, _lists(spark, [("a", None)]), "plate")
    assert [r.id for r in left.collect()] == [1]


def test_purge_of_an_empty_table(spark):
    lists = _lists(spark, [("a", None)])
    empty = _records(spark, [])
    assert purge.purge_from_date(empty, lists, "plate", "file_date").count() == 0
    flagged = purge.flag_purged(empty, lists, "plate", "file_date")
    summary = reports.run_summary(purge.purge_report(flagged.withColumn("src_file", F.lit("x")), "src_file")).first()
    assert (summary.files, summary.success_pct, summary.rows_deleted) == (0, 0.0, 0)


def test_purge_report_status(spark):
    records = _records(spark, [(1, "a", DAY), (2, "b", DAY), (3, "z", DAY)]).withColumn("src_file", F.col("id"))
    flagged = purge.flag_purged(records, _lists(spark, [("a", None), ("b", dt.date(2025, 3, 1))]), "plate", "file_date")
    got = {r.src_file: (r.status, r.rows_deleted) for r in purge.purge_report(flagged, "src_file").collect()}
    assert got == {1: ("purged", 1), 2: ("skipped", 0), 3: ("clean", 0)}


def test_lookup_ways_agree(spark, monkeypatch):
    from fleetloom.operators import lookups

    rows = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.lit(1)).when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    table = spark.range(0, 300, 6).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([(1, 5)], "k bigint, v bigint")
    )
    for how in ("inner", "left", "left_anti", "left_semi"):
        monkeypatch.setattr(lookups, "BROADCAST_ROWS", 1000)
        broadcast = values(lookup(rows, table, ["k"], how))
        monkeypatch.setattr(lookups, "BROADCAST_ROWS", 2)
        assert values(lookup(rows, table, ["k"], how)) == broadcast
    with pytest.raises(ValueError):
        lookup(rows, table, ["k"], "full")


def test_content_date_is_the_first_summary_wherever_it_stands(spark):
    mark = "2025/1/{0} 0:00:00---2025/1/{0} 0:00:00合计:"
    rows = [("early", i, "x" if i != 9 else mark.format(2), None) for i in range(12)]
    rows += [("late", i, "x" if i != 10 else mark.format(3), None) for i in range(12)]
    rows += [("nulls", i, None if i < 20 else mark.format(4), None) for i in range(22)]
    rows += [("other", 0, mark.format(99), mark.format(5)), ("other", 1, mark.format(7), None)]
    frame = spark.createDataFrame(rows, "src_file string, row_no int, `时间` string, `End Date` string")
    got = {r.src_file: r.file_date.day for r in purge.content_dates(frame, "src_file", "row_no").collect()}
    assert got == {"early": 2, "late": 3, "nulls": 4, "other": 5}


def test_name_date_goes_before_content_date(spark):
    frame = spark.createDataFrame([("0101",), ("x",), ("y",)], "src_file string")
    content = spark.createDataFrame([("0101", dt.date(2024, 5, 5)), ("x", dt.date(2024, 6, 6))], "src_file string, file_date date")
    from fleetloom.functions.dates import month_day_name_date

    got = purge.with_file_date(frame, "src_file", month_day_name_date(F.col("src_file"), 2025), content)
    assert dict(values(got)) == {"0101": DAY, "x": dt.date(2024, 6, 6), "y": None}


def test_bands_count_empty_files(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 50.0), ("b", None)], "f string, v double")
    counts = bands.band_counts(frame, "f", "v")
    assert values(counts) == [("a", "low", 2, 1), ("a", "medium", 2, 1), ("b", "low", 1, 0), ("b", "medium", 1, 0)]
    assert values(bands.band_rollup(counts)) == [("low", 2, 1), ("medium", 2, 1)]


def test_strict_concat(spark):
    a, b = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "b int, a int")
    with pytest.raises(concat.SchemaMismatch):
        concat.concat_strict([a, b])
    wide = spark.createDataFrame([(1.5, "x")], "a double, b string")
    assert values(concat.concat_strict([a, wide])) == [(1.0, "2"), (1.5, "x")]
    with pytest.raises(concat.SchemaMismatch):
        concat.concat_strict([a, wide], same_types=True)


def test_lenient_concat(spark):
    a, b = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "b int, c int")
    assert values(concat.concat_lenient(a, b)) == [(1, 2, None), (None, 3, 4)]
    assert concat.concat_lenient(None, b) is b


def test_header_check_names_the_offenders(spark):
    headers = spark.createDataFrame([("f1", ["a", "b"]), ("f2", ["b", "a"]), ("f3", ["a", "b"])], "src_file string, columns array<string>")
    assert [r.src_file for r in concat.header_offenders(headers).collect()] == ["f2"]
    with pytest.raises(concat.SchemaMismatch, match="f2"):
        concat.check_headers(headers)
    concat.check_headers(headers.where("src_file <> 'f2'"))


def test_paired_table_check(spark):
    ten = spark.range(1).selectExpr(*[f"id AS c{i}" for i in range(10)])
    concat.check_paired_table(ten)
    with pytest.raises(concat.SchemaMismatch):
        concat.check_paired_table(ten.limit(0))
    with pytest.raises(concat.SchemaMismatch):
        concat.check_paired_table(ten.drop("c9"))


@pytest.mark.parametrize("dense", [True, False])
def test_concat_by_date_puts_undated_files_first(spark, dense):
    rows = [(dt.date(2024, 1, 2), "b", 0), (None, "z", 1), (None, "z", 0), (dt.date(2024, 1, 1), "c", 0), (dt.date(2024, 1, 2), "a", 0)]
    frame = spark.createDataFrame(rows, "file_date date, src_name string, row_no bigint")
    got = concat.concat_by_date(frame, "file_date", "src_name", "row_no", dense=dense).orderBy("pos").collect()
    assert [(r.src_name, r.row_no, r.pos) for r in got] == [("z", 0, 0), ("z", 1, 1), ("c", 0, 2), ("a", 0, 3), ("b", 0, 4)]


def test_calendar(spark):
    plates = spark.createDataFrame(
        [("p", dt.date(2025, 6, 29), "l1"), ("q", dt.date(2025, 7, 1), "l2"), (None, dt.date(2025, 6, 1), "l1")],
        "plate string, from_date date, list_name string",
    )
    got = values(calendar.plate_calendar(plates))
    assert got == [("p", "2025/6/29", "豫ND7570", "2025/1/1"), ("p", "2025/6/30", "豫ND7570", "2025/1/1")]
    stats = {r.list_name: (r.plates, r.days, r.rows) for r in calendar.calendar_stats(plates.where("plate is not null")).collect()}
    assert stats == {"l1": (1, 2, 2), "l2": (1, 0, 0)}


def test_tidy_only_the_first_date_column(spark):
    frame = spark.createDataFrame([("2025-1-1", "2025-1-2")], "`日期` string, `date` string")
    assert tuple(cleanse.tidy_dates(frame).first()) == ("2025/1/1", "2025-1-2")
    assert tuple(cleanse.tidy_dates(frame, ["日期", "date"]).first()) == ("2025/1/1", "2025/1/2")


def test_file_outcomes(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", -1, "bad")], "f string, v int, e string")
    got = values(reports.file_outcomes(frame, "f", F.col("v") > 1, F.col("e"), F.col("v") >= 0))
    assert got == [("a", 2, 1, None, "ok"), ("b", 0, 0, "bad", "failed")]
    summary = reports.run_summary(reports.file_outcomes(frame, "f", F.col("v") > 1, F.col("e"), F.col("v") >= 0)).first()
    assert (summary.files, summary.ok, summary.failed, summary.success_pct) == (2, 1, 1, 50.0)
