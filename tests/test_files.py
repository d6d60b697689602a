"""Reading and writing files, and cleaning them as they arrive."""

import csv
import datetime as dt
import io
import random
import tracemalloc
import zipfile

import pyarrow as pa
import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetloom import session
from fleetloom.operators import calendar, concat
from fleetloom.plans import clean, vehicles
from fleetloom.sources import csv_files, day_tables, plate_lists, sinks, workbooks
from fleetloom.streaming import ingest

VEHICLE = "线路,a,b\r\n1,ԥx,2\r\n\r\n3\r\n"
QUOTED = '线路,a,b\n1,"q\nr ""z"" \n\n,",2\n5\n'


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "ԥN00775D.csv").write_bytes(b"\xef\xbb\xbf" + VEHICLE.encode())
    (tmp_path / "in" / "a b%20+.csv").write_bytes(QUOTED.encode())
    (tmp_path / "in" / "sub" / "bad.csv").write_bytes(b"\xff\xfe,1\n")
    (tmp_path / "in" / "notes.txt").write_bytes(b"x")
    return tmp_path


def _name(row):
    return row.src_file.rsplit("/", 1)[1]


@pytest.mark.parametrize("whole_file_bytes", [csv_files.WHOLE_FILE_BYTES, 0])
def test_ragged_rows_whole_and_by_lines(spark, folder, whole_file_bytes, small_limits):
    rows = csv_files.read_ragged_csv(spark, str(folder / "in"), whole_file_bytes).collect()
    got = {(_name(r), r.row_no): r.cells for r in rows}
    assert got == {
        ("ԥN00775D.csv", 0): ["线路", "a", "b"],
        ("ԥN00775D.csv", 1): ["1", "ԥx", "2"],
        ("ԥN00775D.csv", 2): [],
        ("ԥN00775D.csv", 3): ["3"],
        ("a b%20+.csv", 0): ["线路", "a", "b"],
        ("a b%20+.csv", 1): ["1", 'q\nr "z" \n\n,', "2"],
        ("a b%20+.csv", 2): ["5"],
        ("bad.csv", -1): None,
    }
    assert [_name(r) for r in rows if r.error] == ["bad.csv"]


def test_long_file_is_split_and_numbered(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f'{i},"x{i}"' + (f',"a\n{i}"' if i % 50 == 0 else "") for i in range(3000)]
    (tmp_path / "in" / "long.csv").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        whole = values(csv_files.read_ragged_csv(spark, str(tmp_path / "in")))
        split = csv_files.read_ragged_csv(spark, str(tmp_path / "in"), 0)
        assert values(split) == whole
        assert len(whole) == 3000
        plain = "\n".join(f"{i},{i * 2}" for i in range(5000))
        (tmp_path / "in" / "long.csv").write_text("a,b\n" + plain)
        (tmp_path / "in" / "longer.csv").write_text("a,b\n" + plain + "\n5000,1")
        tree = csv_files.read_csv_tree(spark, str(tmp_path / "in"), "a bigint, b bigint")
        assert tree.select("_block").distinct().count() > 2
        numbered = csv_files.number_csv_rows(tree)
        assert numbered.where("row_no <> a").isEmpty() and numbered.count() == 10001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_tree(spark, folder):
    (folder / "in" / "sub" / "bad.csv").write_bytes(b"x,y\nk,l\n")
    table = csv_files.read_csv_tree(spark, str(folder / "in"), "route string, a string, b string")
    got = {(_name(r), r.row_no): (r.route, r.a, r.b) for r in csv_files.number_csv_rows(table).collect()}
    assert got[("ԥN00775D.csv", 0)] == ("1", "ԥx", "2")
    assert got[("ԥN00775D.csv", 1)] == ("3", None, None)
    assert got[("bad.csv", 0)] == ("k", "l", None)


def test_day_tables_skip_temporary_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("0101.csv", "~$0101.csv", "#x.csv", ".y.csv", "~z.csv", "sub/0102.csv"):
        (tmp_path / name).write_text("v\n1\n")
    flat = day_tables.read_day_tables(spark, str(tmp_path), "csv", schema="v string").collect()
    assert sorted(map(_name, flat)) == ["0101.csv", "~z.csv"]
    deep = day_tables.read_day_tables(spark, str(tmp_path), "csv", recursive=True, schema="v string").collect()
    assert sorted(map(_name, deep)) == ["0101.csv", "0102.csv", "~z.csv"]
    with pytest.raises(ValueError):
        day_tables.read_day_tables(spark, str(tmp_path), "xlsx")


def test_parquet_day_tables_know_their_rows(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "d"))
    got = day_tables.read_day_tables(spark, str(tmp_path / "d"))
    assert values(got, "row_no", "id") == sorted([(i, i) for i in range(100)], key=str)


def test_plate_lists(spark, tmp_path):
    (tmp_path / "all.csv").write_text("序号,车牌号\n1, 豫A1 \n2,豫A1\n3,nan\n4,\n5,NA\n6,豫B2\n")
    assert values(plate_lists.read_plate_list(spark, str(tmp_path / "all.csv"))) == [("豫A1",), ("豫B2",)]
    (tmp_path / "plain.csv").write_text("x,y\nv1,w1\n")
    assert values(plate_lists.read_plate_list(spark, str(tmp_path / "plain.csv"))) == [("v1",)]
    assert values(plate_lists.read_plate_list(spark, str(tmp_path / "plain.csv"), "y")) == [("w1",)]


def test_calendar_of_dated_lists(spark, tmp_path):
    sizes = {"2025_02_01": 4, "2025_02_18": 7, "2025_03_01": 2, "2025_03_20": 11, "2025_05_18": 10}
    for day, size in sizes.items():
        end = "\r\n" if day == "2025_05_18" else "\n"
        plates = [f"豫{day[5:].replace('_', '')}{i}" for i in range(size)]
        (tmp_path / f"from_{day}.csv").write_bytes(end.join(["车牌号", "车牌号", *plates, ""]).encode())
    (tmp_path / "from_later.csv").write_text("车牌号\nx\n")
    (tmp_path / "all.csv").write_text("车牌号\nx\n")
    lists = plate_lists.read_dated_lists(spark, str(tmp_path))
    stats = {r.list_name: (r.plates, r.days, r.rows) for r in calendar.calendar_stats(lists).collect()}
    assert stats == {
        "from_2025_02_01.csv": (4, 150, 600),
        "from_2025_02_18.csv": (7, 133, 931),
        "from_2025_03_01.csv": (2, 122, 244),
        "from_2025_03_20.csv": (11, 103, 1133),
        "from_2025_05_18.csv": (10, 44, 440),
    }
    table = spark.createDataFrame([("old", "2024/1/1")], "`车号` string, `日期` string")
    stacked = vehicles.add_calendar(spark, str(tmp_path), table)
    assert stacked.count() == 3348 + 1
    assert stacked.where("`补充车辆` is null").count() == 1
    assert stacked.where("`日期` = '2025/2/1'").count() == 4


def _workbook(path, rows):
    """A small workbook: shared and inline texts, a number, a date, gaps."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="S" sheetId="1" r:id="r7"/>'
            f'<sheet name="T" sheetId="2" r:id="r8"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}"><Relationship Id="r8" Target="worksheets/other.xml"/>'
            f'<Relationship Id="r7" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>车牌号</t></si><si><r><t>日</t></r><r><t>期</t></r></si></sst>')
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="165" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
            f'<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="165"/></cellXfs></styleSheet>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')


def test_workbooks(spark, tmp_path):
    rows = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>总里程</t></is></c></row>'
        '<row r="2"><c r="A2" t="str"><v>豫A1</v></c><c r="B2" s="1"><v>45658</v></c><c r="C2"><v>12.5</v></c></row>'
        '<row r="4"><c r="B4" s="2"><v>45658.5</v></c><c r="C4" t="b"><v>1</v></c></row>'
    )
    _workbook(tmp_path / "0101.xlsx", rows)
    (tmp_path / "0102.xlsx").write_bytes(b"no zip")
    (tmp_path / "~$0101.xlsx").write_bytes(b"lock")
    cells = workbooks.read_workbooks(spark, str(tmp_path))
    assert [r.error.split(":")[0] for r in cells.where("error is not null").collect()] == ["BadZipFile"]
    columns = workbooks.headers_of(cells).first().columns
    assert columns == ["车牌号", "日期", "总里程"]
    table = workbooks.table_of_cells(cells, columns).drop("src_file")
    assert values(table) == [
        (0, "豫A1", "2025-01-01 00:00:00", "12.5"),
        (1, None, None, None),
        (2, None, "2025-01-01 12:00:00", "True"),
    ]


def test_clean_directory(spark, folder):
    outcomes = clean.clean_directory(spark, str(folder / "in"), column_index=1)
    assert {(_name(r), r.rows_before, r.status) for r in outcomes.collect()} == {
        ("ԥN00775D.csv", 4, "ok"),
        ("a b%20+.csv", 3, "ok"),
        ("bad.csv", 0, "failed"),
    }
    stored = spark.read.parquet(str(folder / "in_处理后"))
    assert {(r.new_name, r.row_no): r.cells for r in stored.where("error is null").collect()} == {
        ("豫N00775D.csv", 0): ["线路", "b"],
        ("豫N00775D.csv", 1): ["1", "2"],
        ("豫N00775D.csv", 2): [],
        ("豫N00775D.csv", 3): ["3"],
        ("a b%20+.csv", 0): ["线路", "b"],
        ("a b%20+.csv", 1): ["1", "2"],
        ("a b%20+.csv", 2): ["5"],
    }
    plan = clean.dry_run_directory(spark, str(folder / "in")).first()
    assert (plan.csv_files, plan.files_to_process, plan.files_to_rename) == (3, 3, 1)


def test_clean_directory_to_csv_reads_back(spark, folder):
    clean.clean_directory(spark, str(folder / "in"), str(folder / "out"), column_index=None, layout="csv")
    back = csv_files.read_ragged_csv(spark, str(folder / "out"), name_glob="*.txt").where("row_no >= 0")
    assert [r.cells for r in back.where("src_file like '%豫N00775D%'").orderBy("row_no").collect()] == [
        ["线路", "a", "b"], ["1", "豫x", "2"], [], ["3"],
    ]
    assert [r.cells for r in back.where("src_file like '%a b%'").orderBy("row_no").collect()] == [
        ["线路", "a", "b"], ["1", 'q\nr "z" \n\n,', "2"], ["5"],
    ]


def test_clean_directory_to_folders(spark, folder):
    clean.clean_directory(spark, str(folder / "in"), str(folder / "out"), layout="folders")
    assert sorted(r.new_name for r in spark.read.parquet(str(folder / "out")).select("new_name").distinct().collect()) == [
        "a b%20+.csv", "豫N00775D.csv",
    ]
    with pytest.raises(ValueError):
        clean.clean_directory(spark, str(folder / "in"), str(folder / "x"), layout="zip")


def test_clashing_names_are_refused(spark, tmp_path):
    for name in ("ԥ1.csv", "豫1.csv"):
        (tmp_path / name).write_text("a\n")
    with pytest.raises(clean.RenameClash, match="豫1.csv"):
        clean.clean_directory(spark, str(tmp_path), str(tmp_path / "out"))


def test_ingestion_runs_once_per_file(spark, folder):
    source, target, checkpoint = (str(folder / n) for n in ("in", "out", "checkpoint"))
    ingest.clean_new_files(spark, source, target, checkpoint)
    first = values(ingest.cleaned_rows(spark, target))
    assert len(first) == 7
    ingest.clean_new_files(spark, source, target, checkpoint)
    assert values(ingest.cleaned_rows(spark, target)) == first
    assert ingest.pending_files(spark, source, target).isEmpty()
    (folder / "in" / "new.csv").write_text("x,y\n1,2\n")
    assert [r.path.rsplit("/", 1)[1] for r in ingest.pending_files(spark, source, target).collect()] == ["new.csv"]
    ingest.clean_new_files(spark, source, target, checkpoint)
    assert len(values(ingest.cleaned_rows(spark, target))) == 9
    assert [_name(r) for r in ingest.quarantine(spark, target).collect()] == ["bad.csv"]
    report = {r.status: (r.files, r.rows) for r in ingest.ledger_report(spark, target).collect()}
    assert report == {"ok": (3, 9), "failed": (1, 0)}


def test_failed_files_are_tried_again(spark, folder, monkeypatch):
    monkeypatch.setattr(ingest, "RETRY_FILES", 1)
    source, target, checkpoint = (str(folder / n) for n in ("in", "out", "checkpoint"))
    (folder / "in" / "worse[1].csv").write_bytes(b"\xff")
    ingest.clean_new_files(spark, source, target, checkpoint, files_per_run=2)
    assert ingest.retry_failed(spark, target, "first") == 2
    assert ingest.quarantine(spark, target).count() == 2
    (folder / "in" / "sub" / "bad.csv").write_text("good,1\n")
    assert ingest.retry_failed(spark, target, "second") == 2
    done = {_name(r): (r.status, r.attempts) for r in ingest.ledger(spark, target).collect()}
    assert done["bad.csv"] == ("ok", 3) and done["worse[1].csv"] == ("failed", 3)
    assert ["1"] in [r.cells for r in ingest.cleaned_rows(spark, target).collect()]


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    rows = csv_files.cells_of_files(spark.createDataFrame([("f.csv", bytearray(b"a,b\n"))], "path string, content binary"))
    for _ in range(2):
        ingest._store(ingest.clean_rows(rows), str(tmp_path), "batch-0")
    assert ingest.cleaned_rows(spark, str(tmp_path)).count() == 1


def test_sinks_write_the_same_again(spark, tmp_path):
    frame = spark.range(200).select("id", (F.col("id") % 3).alias("k"), F.col("id").alias("pos"))
    for _ in range(2):
        sinks.write_by(frame, str(tmp_path / "by"), "k", mode="overwrite")
        sinks.write_in_order(frame, str(tmp_path / "ordered"), mode="overwrite")
        sinks.write_csv(frame.select("id"), str(tmp_path / "csv"), mode="overwrite")
    assert sorted(p.name for p in (tmp_path / "by").iterdir() if p.is_dir()) == ["k=0", "k=1", "k=2"]
    assert spark.read.parquet(str(tmp_path / "by")).count() == 200
    files = day_tables.read_day_tables(spark, str(tmp_path / "ordered"))
    placed = concat.concat_by_name(files, "src_file", "row_no", "place", dense=True)
    assert placed.where("place <> pos").isEmpty() and placed.count() == 200
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 200
    with pytest.raises(Exception, match="already exists"):
        sinks.write_csv(frame.select("id"), str(tmp_path / "csv"))


def test_vehicle_plan(spark):
    mark = "2025/1/5 0:00:00---2025/1/5 0:00:00合计:"
    rows = []
    for name in ("0101", "x"):
        rows += [(name, i, f"豫A{i % 4}", mark if (name, i) == ("x", 1) else "2025-1-1 00:00:00", "r", "s", float(i * 3), "extra") for i in range(30)]
    records = spark.createDataFrame(
        rows, "src_file string, row_no bigint, `车牌号` string, `日期` string, r string, s string, `总里程(公里)` double, more string"
    )
    lists = spark.createDataFrame([("豫A0", dt.date(2025, 1, 3)), ("豫A1", None)], "plate string, from_date date")
    from fleetloom.functions.dates import month_day_name_date

    flagged = vehicles.purge_files(records, lists, name_date=month_day_name_date(F.col("src_file"), 2025))
    left = flagged.where("not purged").drop("listed", "purged")
    assert {(r.src_file, r["车牌号"]) for r in left.select("src_file", "车牌号").distinct().collect()} == {
        ("0101", "豫A0"), ("0101", "豫A2"), ("0101", "豫A3"), ("x", "豫A2"), ("x", "豫A3"),
    }
    banded = vehicles.tidy_and_band(left)
    assert banded.columns == ["src_file", "row_no", "车牌号", "日期", "r", "s", "总里程(公里)", "range_label"]
    done = vehicles.consolidate(banded.drop("r"), "src_file", ["row_no"])
    got = done.orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(len(got)))
    assert all(r["low_日期"] == "2025/1/1" for r in got if r["low_日期"])
    assert [r.src_file for r in got] == sorted(r.src_file for r in got)


class _Session:
    """As much of a session as the scratch folder depends on."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = self
        self.master, self.applicationId = master, "app-1"
        self._jsc = self

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isDefined(self):
        return False


def test_stack_files(spark, tmp_path):
    def day(value):
        return f"车牌号,日期\nv{value}a,x\nv{value}b,y\n"

    names = ["2023_1102_x.csv", "0101_x.csv", "zz.csv", "2023_0328_x.csv"]
    for name in names:
        (tmp_path / name).write_text(day(name[:6]))
    cells = csv_files.read_ragged_csv(spark, str(tmp_path))
    by_date = vehicles.stack_files(cells).orderBy("pos").collect()
    assert [r.pos for r in by_date] == list(range(8))
    assert [r["车牌号"][:3] for r in by_date] == ["vzz", "vzz", "v20", "v20", "v20", "v20", "v01", "v01"]
    assert [_name(r) for r in by_date[2:6:2]] == ["2023_0328_x.csv", "2023_1102_x.csv"]
    by_name = vehicles.stack_files(cells, by_date=False).orderBy("pos").collect()
    assert [_name(r) for r in by_name[::2]] == ["0101_x.csv", "2023_0328_x.csv", "2023_1102_x.csv", "zz.csv"]
    (tmp_path / "other.csv").write_text("日期,车牌号\n1,2\n")
    with pytest.raises(concat.SchemaMismatch, match="other.csv"):
        vehicles.stack_files(csv_files.read_ragged_csv(spark, str(tmp_path)))
    (tmp_path / "bad.csv").write_bytes(b"\xff")
    with pytest.raises(vehicles.UnreadableFile, match="bad.csv"):
        vehicles.stack_files(csv_files.read_ragged_csv(spark, str(tmp_path)))


def test_scratch_is_where_the_cluster_says():
    named = _Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/cp/"})
    assert session.scratch_root(named) == "hdfs://shared/cp/fleetloom/app-1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(_Session("yarn"))


def test_scratch_is_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "scratch"))
    assert session.scratch_table(spark.range(5), "t").count() == 5
    assert list(tmp_path.rglob("*.parquet"))
    assert session.drop_scratch(spark)
    assert not list(tmp_path.rglob("*.parquet"))


@pytest.mark.parametrize("split", ["700", "100000"])
def test_long_files_give_the_rows_of_whole_ones(spark, tmp_path, split):
    """Stray quotes, line ends in cells, an unclosed quote: the way of reading changes nothing."""
    draw = random.Random(4)
    noise = "".join(draw.choice(["a", ",", '"', '""', "\n", "b", "\r\n"]) for _ in range(6000))
    contents = {
        "stray": 'a,5" pipe,b\nx,y,z\n1,2,3\n',
        "crlf": 'a,"x\r\ny",b\r\nq,w,e\r\n',
        "multi": 'h,i\n"a\n\n""b,\n",2\n3,"4"\n"5"x"y,6\n' + "".join(f'{i},"v\n{i}"\n' for i in range(300)),
        "open": 'a,b\n1,"2\n3,4\n5,6\n',
        "noise": noise,
    }
    for name, text in contents.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        whole, by_lines = (values(csv_files.read_ragged_csv(spark, str(tmp_path), limit), "src_file", "row_no", "cells", "error") for limit in (1 << 30, 0))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert whole == by_lines and len(whole) > 300


@pytest.mark.parametrize("split", ["48", "128m"])
def test_a_lone_carriage_return_ends_a_row_in_long_files_too(spark, tmp_path, split):
    draw = random.Random(9)
    contents = {
        "lone": "a,b\rc,d\ne,f\n", "only": "a,b\r1,2\r3,4", "closed": "a,b\r1,2\r", "double": "a\r\rb\r\r\nc\n\rd",
        "quoted": 'a,"x\ry"\r"p\r\nq\nr\r",s\rt\n"u"\rv"w\r', "open": 'a\rb,"c\rd\r\ne\r\n', "mixed": "a\r\nb\rc\n" * 20,
    }
    for i in range(60):
        contents[f"drawn{i}"] = "".join(draw.choice(('a', ',', '"', '""', ',"', '",', '\r', '\r', '\n', '\r\n', 'é')) for _ in range(draw.randint(1, 60)))
    for name, text in contents.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        whole, by_lines = (values(csv_files.read_ragged_csv(spark, str(tmp_path), limit), "src_file", "row_no", "cells", "error") for limit in (1 << 30, 0))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert whole == by_lines
    assert [c for f, _, c, _ in sorted(whole) if f.endswith("/lone.csv")] == [["a", "b"], ["c", "d"], ["e", "f"]]


def test_line_ends_as_the_csv_module_sees_them():
    draw = random.Random(4)
    for _ in range(5000):
        line = "".join(draw.choice('a,"" b') for _ in range(draw.randint(0, 9)))
        for inside in (False, True):
            rows = list(csv.reader(io.StringIO(f"{'\"' if inside else ''}{line}\nnext\n", newline="")))
            assert csv_files._ends_inside(line, inside) == (len(rows) < 2)


def test_a_whole_file_is_parsed_in_little_memory():
    """Rows of a file leave in batches: no list of them all, no second copy of its text."""
    content = b"".join(b'%d,123,\xd4\xa5click,"{""k"": 12}"\n' % i for i in range(150_000))
    batch = pa.RecordBatch.from_arrays([pa.array(["a"]), pa.array([content])], ["path", "content"])
    tracemalloc.start()
    try:
        found = sum(b.num_rows for b in csv_files._parse_files(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 150_000 and most < 3 * len(content)


def test_faults_late_in_a_file_leave_none_of_its_rows():
    contents = [b"a,b\n" * 50_000 + b"\xff\n", b"\xef\xbb\xbfx,y\r\n1,2\r\n", b'1,"2\n', b'1,"2\n"\n', b"", b"a\rb"]
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(6)]), pa.array(contents)], ["path", "content"])
    found = [r for b in csv_files._parse_files(iter([batch])) for r in b.to_pylist()]
    assert [(r["src_file"], r["row_no"], r["cells"]) for r in found] == [
        ("0", -1, None), ("1", 0, ["x", "y"]), ("1", 1, ["1", "2"]), ("2", 0, ["1", "2"]), ("3", 0, ["1", "2\n"]), ("4", -1, None), ("5", 0, ["a"]), ("5", 1, ["b"]),
    ]
    assert [r["error"] for r in found][0].startswith("UnicodeDecodeError")
