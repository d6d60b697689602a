"""Headers, band tables, ranks of cells, purge of days laid out, run summaries and workbooks."""

import datetime as dt
import io
import math
import random
import zipfile
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetloom.operators import bands, concat, lookups, position, purge
from fleetloom.plans import clean, vehicles
from fleetloom.sources import census, csv_files, day_tables, workbooks
from fleetloom.sources.sinks import write_by

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def days(spark, tmp_path):
    """Parquet day tables (a, b), then (b, a) and (a, b, c)."""
    frame = spark.range(6).selectExpr("id AS a", "string(id) AS b", "double(id) AS c")
    for name, columns in (("0101", ["a", "b"]), ("0102", ["b", "a"]), ("0103", ["a", "b", "c"])):
        frame.select(columns).coalesce(1).write.parquet(str(tmp_path / name))
    return tmp_path


def test_census_reads_footers_and_first_lines(spark, days):
    (days / "0101" / "broken.parquet").write_bytes(b"PAR1 no footer")
    (days / "0101" / "~$lock.parquet").write_bytes(b"x")
    headers = census.file_headers(spark, str(days), recursive=True)
    found = {(r.src_file.split("/")[-2], tuple(r.columns or ())): (tuple(r.types or ()), r.rows, r.error is None) for r in headers.collect()}
    assert found == {
        ("0101", ("a", "b")): (("int64", "string"), 6, True),
        ("0101", ()): ((), None, False),
        ("0102", ("b", "a")): (("string", "int64"), 6, True),
        ("0103", ("a", "b", "c")): (("int64", "string", "double"), 6, True),
    }
    groups = census.header_groups(census.file_headers(spark, str(days / "0103"))).collect()
    assert [(r.files, r.rows, r.expected) for r in groups] == [(1, 6, True)]
    (days / "x.csv").write_bytes('﻿"a\nb",c\n1,2\n'.encode())
    (days / "empty.csv").write_bytes(b"")
    (days / "bad.csv").write_bytes(b"\xff\xfe,1\n")
    found = {r.src_file.rsplit("/", 1)[1]: (r.columns, r.error is None) for r in census.file_headers(spark, str(days), "csv").collect()}
    assert found == {"x.csv": (["a\nb", "c"], True), "empty.csv": ([], True), "bad.csv": (None, False)}
    with pytest.raises(ValueError):
        census.file_headers(spark, str(days), "xlsx")


def test_day_tables_of_other_columns_are_refused_or_filled(spark, days):
    with pytest.raises(concat.SchemaMismatch, match="0103/.*a, b, c of types"):
        day_tables.read_day_tables(spark, str(days), recursive=True)
    filled = day_tables.read_day_tables(spark, str(days), recursive=True, missing="fill")
    assert sorted(filled.columns) == ["a", "b", "c", "row_no", "src_file"]
    assert filled.count() == 18 and filled.where("c is null").count() == 12
    for name in ("0103",):
        for part in (days / name).iterdir():
            part.unlink()
    whole = day_tables.read_day_tables(spark, str(days), recursive=True)
    assert whole.count() == 12 and whole.where("string(a) <> b").isEmpty()
    spark.range(3).selectExpr("string(id) AS a", "'x' AS b").write.parquet(str(days / "0104"))
    with pytest.raises(concat.SchemaMismatch, match="0104"):
        day_tables.read_day_tables(spark, str(days), recursive=True)
    for options in ({"missing": "drop"}, {"format": "csv", "missing": "fill"}):
        with pytest.raises(ValueError):
            day_tables.read_day_tables(spark, str(days), **options)


def test_csv_day_tables_of_other_columns_are_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(concat.SchemaMismatch, match="b.csv has columns y, x"):
        day_tables.read_day_tables(spark, str(tmp_path), "csv")


def stacked(spark, folder, files):
    for name, content in files.items():
        (folder / name).write_text(content)
    return vehicles.stack_files(csv_files.read_ragged_csv(spark, str(folder)), by_date=False)


def test_stacked_files_keep_every_cell(spark, tmp_path):
    frame = stacked(spark, tmp_path, {"1.csv": "a,,a,pos\n1,2,3,4,5\n6\n", "2.csv": "a,,a,pos\n\n7,8,9,10,11\n"})
    assert frame.columns[2:] == ["a", "Unnamed: 1", "a.1", "pos.0", "Unnamed: 4", "pos"]
    assert values(frame.drop("src_file", "row_no")) == sorted(
        [("1", "2", "3", "4", "5", 0), ("6", None, None, None, None, 1), (None,) * 5 + (2,), ("7", "8", "9", "10", "11", 3)], key=str
    )


def test_wider_files_are_named(spark, tmp_path):
    with pytest.raises(concat.SchemaMismatch, match="2.csv"):
        stacked(spark, tmp_path, {"1.csv": "a,b\n1,2\n", "2.csv": "a,b\n1,2,3\n"})


def test_names_tell_columns_apart():
    assert workbooks.column_names(["a", "a", "a.1", "", None, " ", "a"]) == ["a", "a.1", "a.1.1", "Unnamed: 3", "Unnamed: 4", "Unnamed: 5", "a.2"]


ODD = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e300, -1e300, 5e-324, 1.0, 30.0, 30.000001, 2.0**53]


@pytest.mark.parametrize("rows", [lookups.BROADCAST_ROWS, 0])
def test_band_table_equals_comparing_all(spark, monkeypatch, rows):
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", rows)
    draw = random.Random(3)
    numbers = ODD + [draw.uniform(-50, 50) for _ in range(150)] + [draw.uniform(-1, 1) * 10 ** draw.randint(-9, 12) for _ in range(80)]
    table = [(lo, lo + abs(draw.gauss(0, 10 ** draw.randint(-6, 6)))) for lo in numbers[13:120]]
    table += [(0.0, 30.0), (0.0, 30.0), (30.0, 30.0), (5.0, 1.0), (-math.inf, math.inf), (None, 3.0), (math.nan, 3.0), (-math.inf, 0.0), (1e300, math.inf), (-1e300, 1e300), (5e-324, 1e-323)]
    frame = spark.createDataFrame(list(enumerate(numbers)), "id int, v double")
    given = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(table)], "label int, lo double, hi double")
    met = bands.band_table_join(frame, "v", given)
    expected = [(i, j) for i, v in enumerate(numbers) for j, (lo, hi) in enumerate(table) if v is not None and lo is not None and v == v and lo <= v <= hi]
    assert sorted((r.id, r.range_label) for r in met.collect()) == expected
    assert met.columns == ["id", "v", "range_label"]
    assert "NestedLoop" not in plan_of(met) and "Cartesian" not in plan_of(met)
    assert "BroadcastHashJoin" in plan_of(met) or not rows


def test_band_table_without_bands_or_numbers(spark):
    frame = spark.createDataFrame([(1, "12"), (2, "x"), (3, None)], "id int, v string")
    given = spark.createDataFrame([("low", 0.0, 30.0)], "label string, lo double, hi double")
    assert values(bands.band_table_join(frame, "v", given)) == [(1, "12", "low")]
    assert bands.band_table_join(frame, "v", given.limit(0)).collect() == []


def test_band_totals_equal_the_copies(spark):
    """Counts and sums by label without a copy per row and band, whose number is rows times bands."""
    draw = random.Random(4)
    numbers = ODD + [float(draw.randint(-20, 20)) for _ in range(200)]
    rows = [(v, draw.choice([None, 2**53, -(2**53), 7]), Decimal(draw.randint(-99, 99)) / 4) for v in numbers]
    ends = [(draw.choice(numbers), draw.choice(numbers)) for _ in range(150)] + [(-math.inf, math.inf), (0.0, -0.0), (-0.0, 0.0), (1e300, 1e300)]
    frame = spark.createDataFrame(rows, "v double, n bigint, d decimal(10,2)").repartition(5)
    given = spark.createDataFrame([(i % 40 if i % 7 else None, lo, hi) for i, (lo, hi) in enumerate(ends)], "label int, lo double, hi double")
    met = bands.band_table_join(frame, "v", given, totals={"n": "n", "d": "d"}, rows_name="k")
    copies = bands.band_table_join(frame, "v", given).groupBy("range_label")
    expected = copies.agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum("d").alias("d"))
    assert values(met.withColumn("n", F.col("n").cast("decimal(38,0)"))) == values(expected) != []
    assert met.schema["d"].dataType == expected.schema["d"].dataType and met.schema["n"].dataType.simpleString() == "bigint"
    assert "Join" not in plan_of(met).replace("BroadcastHashJoin", "")
    with pytest.raises(ValueError, match="whole numbers"):
        bands.band_table_join(frame, "v", given, totals={"v": "v"})


def test_ranks_of_cells_on_both_ways(spark, monkeypatch):
    rows = [("hot", i, f"c{i}" if i % 3 else None, None) for i in range(200)] + [("cold", 1, None, "x"), ("cold", 0, "y", "z"), (None, 5, "n", None)]
    frame = spark.createDataFrame(rows, "f string, o int, a string, b string").repartition(5)
    expected = []
    for f in ("hot", "cold", None):
        for k, column in ((2, "a"), (3, "b")):
            cells = [r[k] for r in sorted((r for r in rows if r[0] == f), key=lambda r: r[1]) if r[k] is not None]
            expected += [(f, column, i, c) for i, c in enumerate(cells)]
    for limit in (position.ROWS_PER_TASK, 20):
        monkeypatch.setattr(position, "ROWS_PER_TASK", limit)
        assert values(position.non_null_rank(frame, "f", ["o"], ["a", "b"])) == sorted(expected, key=str)
    first = position.first_non_null(frame, "f", ["o"], ["a", "b"], 4)
    assert values(first) == sorted([r for r in expected if r[2] < 4], key=str)
    first.collect()
    assert "WindowGroupLimit" in plan_of(first)


def test_untouched_days_are_not_joined(spark, tmp_path):
    days = [dt.date(2024, 1, d) for d in range(1, 11)] + [None]
    rows = [(f"p{i % 7}", i, day) for i in range(20) for day in days]
    records = spark.createDataFrame(rows, "plate string, v int, file_date date")
    write_by(records, str(tmp_path / "laid"), "file_date")
    laid = spark.read.schema(records.schema).parquet(str(tmp_path / "laid"))
    for lists in ([("p1", dt.date(2024, 1, 6)), ("p2", dt.date(2024, 1, 9))], [("p1", None), ("p2", dt.date(2024, 1, 9))], []):
        given = spark.createDataFrame(lists, "plate string, from_date date")
        kept = purge.purge_laid_out(laid, given, "plate", "file_date")
        assert values(kept, "plate", "v", "file_date") == values(purge.purge_from_date(records, given, "plate", "file_date"), "plate", "v", "file_date")
        plan = plan_of(kept)
        assert plan.count("PartitionFilters: [isnotnull(file_date") + plan.count("PartitionFilters: [(isnull(file_date") >= 2
        assert "ubquery" in plan.split("PartitionFilters")[1]


def test_summary_is_observed_while_writing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, content in {"a.csv": b"x,y\n1,2\n", "b.csv": b"x\n", "c.csv": b"", "bad.csv": b"\xff", "ԥ.txt": b"1\n2\n"}.items():
        (tmp_path / "in" / name).write_bytes(content)
    summary = clean.clean_summary(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert summary.inputFiles() == []  # made of what was counted on the way
    assert tuple(summary.first()) == (5, 4, 1, 80.0, 3, 3, 0)
    (tmp_path / "none").mkdir()
    assert tuple(clean.clean_summary(spark, str(tmp_path / "none"), str(tmp_path / "out2")).first()) == (0, 0, 0, 0.0, 0, 0, 0)


def book(rows, strings="", properties=""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as made:
        made.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">{properties}<sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        made.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="/xl/s.xml"/></Relationships>')
        made.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
        made.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        made.writestr("xl/s.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


def test_workbook_texts_and_days():
    strings = "<si><t>号牌</t><rPh><t>hint</t></rPh></si><si><r><t>日</t></r><r><t>期</t></r><phoneticPr/></si>"
    rows = '<row><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row><row r="3"><c t="inlineStr"><is><t>x</t><rPh><t>y</t></rPh></is></c><c s="1"><v>1.5</v></c><c r="E3"><v>9</v></c></row>'
    assert list(workbooks.sheet_rows(book(rows, strings))) == [["号牌", "日期"], [], ["x", "1899-12-31 12:00:00", None, None, "9"]]
    from_1904 = book(rows, strings, '<workbookPr date1904="1"/>')
    assert list(workbooks.sheet_rows(from_1904))[2][1] == "1904-01-02 12:00:00"


def test_a_sheet_that_breaks_off_gives_no_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "_ROWS_PER_BATCH", 2)
    good = "".join(f"<row><c><v>{i}</v></c></row>" for i in range(7))
    (tmp_path / "good.xlsx").write_bytes(book(good))
    (tmp_path / "empty.xlsx").write_bytes(book(""))
    (tmp_path / "broken.xlsx").write_bytes(book(good + '<row><c t="s"><v>99</v></c></row>'))
    cells = workbooks.read_workbooks(spark, str(tmp_path)).collect()
    found = {}
    for r in cells:
        found.setdefault(r.src_file.rsplit("/", 1)[1], []).append((r.row_no, r.cells, r.error))
    assert sorted(found["good.xlsx"]) == [(i, [str(i)], None) for i in range(7)]
    assert found["empty.xlsx"] == [(-1, None, None)]
    assert [(n, c) for n, c, _ in found["broken.xlsx"]] == [(-1, None)] and "IndexError" in found["broken.xlsx"][0][2]
