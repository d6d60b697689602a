"""Listing and writing trees of files, the clean of whole trees, and long files in the streams."""

import gzip
import hashlib
import os

import pytest
from conftest import SF_DIR, values
from pyspark.sql import functions as F

from fleetloom.plans import clean
from fleetloom.queries import QUERIES
from fleetloom.sources import csv_files, file_tree
from fleetloom.streaming import ingest

LONG = "线路,a\n" + "".join(f'{i},"ԥ{i}\n{i}"\n' for i in range(400))


@pytest.fixture
def tree(tmp_path):
    """CSV files of all cases, others, empty and hidden ones, at several depths."""
    files = {
        "a.csv": "h,i\n1,ԥ\n",
        "sub/ԥb.CSV": "h,i\n2,ԥ\n",
        "sub/deep/er/ԥc%20 +[1].csv": LONG,
        "sub/ԥnote.txt": "ԥ stays\r\n",
        "sub/note.txt": "x",
        "ԥempty.csv": "",
        "sub/ԥempty.txt": "",
        ".hidden/x.csv": "1,2\n",
        "_x.csv": "1,2\n",
        "bad.csv": None,
    }
    for name, text in files.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"\xff\xfe,1\n" if text is None else text.encode())
    (tmp_path / "in" / "nothing").mkdir()
    os.symlink(tmp_path / "in", tmp_path / "in" / "sub" / "loop")
    return tmp_path


def _read(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(folder.rglob("*")) if p.is_file()}


def test_listing_holds_every_file(spark, tree):
    listed = file_tree.list_files(spark, str(tree / "in")).collect()
    root = f"file:{tree}/in/"
    assert {r.path.removeprefix(root): r.length for r in listed} == {
        name: len(content) for name, content in _read(tree / "in").items() if not name.startswith((".", "_"))
    }
    spark_paths = {r.path for r in csv_files.small_csv_files(spark, str(tree / "in"), name_glob="*").collect()}
    assert spark_paths == {r.path for r in listed if r.length and "loop" not in r.path} | {p for p in spark_paths if "/loop/" in p}
    assert file_tree.list_files(spark, str(tree / "gone")).collect() == []


@pytest.mark.parametrize("limit", [csv_files.WHOLE_FILE_BYTES, 1000, 1])
def test_files_keep_their_place_and_get_their_names(spark, tree, limit):
    os.unlink(tree / "in" / "sub" / "loop")
    planned = values(clean.dry_run_files(spark, str(tree / "in")), "name", "new_name", "is_csv", "renamed")
    outcomes = clean.clean_directory(spark, str(tree / "in"), str(tree / "out"), layout="files", whole_file_bytes=limit)
    written = _read(tree / "out")
    assert written == {
        "a.csv": "i\n豫\n".encode(),
        "sub/豫b.CSV": "i\n豫\n".encode(),
        "sub/deep/er/豫c%20 +[1].csv": ("a\n" + "".join(f'"豫{i}\n{i}"\n' for i in range(400))).encode(),
        "sub/豫note.txt": "ԥ stays\r\n".encode(),
        "豫empty.csv": b"",
        "sub/豫empty.txt": b"",
    }
    # The dry run names just these, and the one that can't be read.
    assert {new for _, new, _, _ in planned} == {*written, "bad.csv"}
    rows = {r.src_file.rsplit("/in/", 1)[1]: (r.rows_after, r.status) for r in outcomes.collect()}
    assert rows.keys() == {name for name, _, _, _ in planned}
    assert rows["bad.csv"] == (0, "failed") and rows["sub/deep/er/ԥc%20 +[1].csv"] == (401, "ok") and rows["ԥempty.csv"] == (0, "ok")
    plan = clean.dry_run_directory(spark, str(tree / "in")).first()
    assert (plan.csv_files, plan.files_to_process, plan.files_to_rename) == (5, 7, 5)


def test_table_of_a_tree_reports_all_files(spark, tree):
    os.unlink(tree / "in" / "sub" / "loop")
    outcomes = clean.clean_directory(spark, str(tree / "in"), str(tree / "table"))
    assert {r.src_file.rsplit("/in/", 1)[1] for r in outcomes.collect()} == {r.name for r in clean.dry_run_files(spark, str(tree / "in")).collect()}
    noted = spark.read.parquet(str(tree / "table")).where("row_no = -1 and error is null")
    assert {r.new_name for r in noted.collect()} == {"豫empty.csv", "sub/豫empty.txt", "sub/豫note.txt"}


def _named(spark, rows):
    return spark.createDataFrame(rows, "name string, row_no bigint, line string")


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    target = tmp_path / "made" / "out"
    rows = _named(spark, [(f"d/{i}.csv", 0, "x") for i in range(20)]).repartition(4)
    broken = rows.withColumn("line", F.when(F.col("name") == "d/7.csv", F.raise_error(F.lit("broken"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="broken"):
        file_tree.write_named_files(broken, str(target))
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []
    assert file_tree.write_named_files(rows, str(target)).count() == 20
    assert len(_read(target)) == 20
    with pytest.raises(FileExistsError):
        file_tree.write_named_files(rows, str(target))


def test_scattered_rows_of_a_name_are_refused(spark, tmp_path):
    rows = _named(spark, [("a", 0, "x"), ("b", 0, "y"), ("a", 1, "z")]).coalesce(1)
    with pytest.raises(Exception, match="do not stand together"):
        file_tree.write_named_files(rows, str(tmp_path / "out"))
    counted = file_tree.write_named_files(file_tree.in_files(rows), str(tmp_path / "out"))
    assert values(counted, "name", "rows") == [("a", 2), ("b", 1)]
    assert _read(tmp_path / "out") == {"a": b"x\nz\n", "b": b"y\n"}


def test_nothing_to_write(spark, tmp_path):
    assert file_tree.write_named_files(_named(spark, []), str(tmp_path / "out")).collect() == []
    assert (tmp_path / "out").is_dir()


def _ingest(spark, tree, **options):
    places = [str(tree / n) for n in ("in", "out", "checkpoint")]
    ingest.clean_new_files(spark, *places, column_index=None, **options)
    return places[1]


def test_long_files_stop_no_others(spark, tree):
    """Spark itself refuses files above 1,000 bytes here; they come by lines, to the rows of a whole parse."""
    os.unlink(tree / "in" / "sub" / "loop")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        target = _ingest(spark, tree)
        done = {r.src_file.rsplit("/in/", 1)[1]: (r.status, r.rows, r.attempts) for r in ingest.ledger(spark, target).collect()}
        assert done == {
            "a.csv": ("ok", 2, 1), "sub/deep/er/ԥc%20 +[1].csv": ("ok", 401, 1), "ԥempty.csv": ("ok", 0, 1), "bad.csv": ("failed", 0, 1),
        }
        rows = ingest.cleaned_rows(spark, target).where("src_file like '%[1].csv'").orderBy("row_no").collect()
        assert [r.cells for r in rows] == [["线路", "a"]] + [[str(i), f"豫{i}\n{i}"] for i in range(400)]
        _ingest(spark, tree)
        assert ingest.attempts(spark, target).count() == 4 and ingest.pending_files(spark, str(tree / "in"), target).isEmpty()
        (tree / "in" / "bad.csv").write_text(LONG)
        assert ingest.retry_failed(spark, target, "long", column_index=None) == 1
        assert ingest.cleaned_rows(spark, target).where("src_file like '%/bad.csv'").count() == 401
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_retry_finds_empty_and_gone_files(spark, tree):
    os.unlink(tree / "in" / "sub" / "loop")
    (tree / "in" / "sub" / "worse.csv").write_bytes(b"\xff")
    target = _ingest(spark, tree)
    (tree / "in" / "bad.csv").write_text("")
    os.unlink(tree / "in" / "sub" / "worse.csv")
    assert ingest.retry_failed(spark, target, "x") == 2
    done = {r.src_file.rsplit("/", 1)[1]: (r.status, r.error) for r in ingest.ledger(spark, target).where("attempts = 2").collect()}
    assert done == {"bad.csv": ("ok", None), "worse.csv": ("failed", "FileNotFoundError: no such file")}


def test_the_ledger_reads_itself_alone(spark, tree):
    os.unlink(tree / "in" / "sub" / "loop")
    target = _ingest(spark, tree)
    for frame in (ingest.ledger(spark, target), ingest.ledger_report(spark, target), ingest.pending_files(spark, str(tree / "in"), target)):
        plan = frame._jdf.queryExecution().toString()
        assert "cells" not in plan and "/rows" not in plan
        assert all("/ledger/" in f or "/listing-" in f for f in frame.inputFiles())


def test_long_stream_opens_long_files_only(spark, tree):
    frame = csv_files.long_file_text(spark, str(tree / "in" / "sub" / "deep"), 10**9)
    assert frame.rdd.getNumPartitions() == 0




def test_a_folder_is_made_once(tmp_path, monkeypatch):
    """What a file costs besides its rows: a task asks for a folder once, not once a file."""
    import types

    import pyarrow as pa

    from fleetloom.sources import file_tree

    monkeypatch.setattr(file_tree, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    asked = []

    class Counting(file_tree.fs.LocalFileSystem):
        def create_dir(self, path, *, recursive=True):
            asked.append(path)
            super().create_dir(path, recursive=recursive)

    monkeypatch.setattr(file_tree, "place", lambda uri: (Counting(), uri))
    names = [n for i in range(50) for n in [f"a/{i}.csv"] * 3] + ["b/none.csv", "b/bad.csv"]
    lines = [f"{i}" if i % 3 else None for i in range(150)] + [None, None]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(names), pa.array([*range(150), -1, -1]), pa.array(lines), pa.nulls(152, pa.binary()), pa.nulls(152, pa.string()), pa.array([None] * 151 + ["wrong"])],
        ["src_file", "name", "row_no", "line", "content", "copy_of", "error"],
    )
    writer = file_tree._TreeWriter(str(tmp_path / "out"), str(tmp_path / "outcomes"))
    writer.write(iter([rows.slice(0, 76), rows.slice(76)]))
    writer.commit([])
    assert len(asked) <= 10
    assert (tmp_path / "out/a/25.csv").read_text() == "76\n77\n" and (tmp_path / "out/b/none.csv").read_text() == ""
    assert len(list((tmp_path / "out/a").iterdir())) == 50 and not (tmp_path / "out/b/bad.csv").exists()


def test_a_clean_keeps_no_file_names_in_the_driver(spark, tree, monkeypatch):
    """Tasks open the files that the listing names, so many each; Spark's readers see none of them."""
    os.unlink(tree / "in" / "sub" / "loop")
    for i in range(60):
        (tree / "in" / f"{i}.csv").write_text(f"h,i\n1,{i}\n")
        (tree / "in" / f"ԥ{i}.txt").write_text(f"{i}")
    monkeypatch.setattr(file_tree, "FILES_PER_TASK", 5)
    rows, long = clean._cleaned(spark, str(tree / "in"), 0, "ԥ", "豫", False, csv_files.WHOLE_FILE_BYTES)
    assert long is None and not [f for f in rows.inputFiles() if "/in/" in f]
    # 64 CSV files with rows, and 63 others that are copied or empty.
    assert rows.rdd.getNumPartitions() == 2 * 13
    assert rows.select("new_name").distinct().count() == 127
    # Of files read by lines, the long ones alone.
    _, long = clean._cleaned(spark, str(tree / "in"), 0, "ԥ", "豫", False, 1000)
    assert {f.rsplit("/", 1)[1] for f in long.inputFiles() if "/in/" in f} <= {"%D4%A5c%2520%20+%5B1%5D.csv"}


def test_the_query_over_all_files_opens_them_in_tasks(spark):
    result = QUERIES["clean_tree_all_files"](spark, SF_DIR)
    assert result.inputFiles() and not [f for f in result.inputFiles() if "/all-files-" in f]


def test_digests_are_of_every_file(spark, tree, monkeypatch):
    monkeypatch.setattr(file_tree, "_READ_AT_ONCE", 7)
    digests = {r.path.split("/in/", 1)[1]: r.digest for r in file_tree.file_digests(file_tree.list_files(spark, str(tree / "in"))).collect()}
    there = {name: hashlib.md5(content).hexdigest() for name, content in _read(tree / "in").items() if not name.startswith((".", "_"))}
    assert digests == there


def test_a_file_is_copied_as_it_stands(spark, tmp_path):
    """A name that ends as those of compressed files do means nothing for its bytes."""
    files = {"ԥplain.gz": b"no gzip", "ԥpacked.gz": gzip.compress(b"x" * 1000, mtime=0), "ԥ.bz2": b""}
    (tmp_path / "in").mkdir()
    for name, content in files.items():
        (tmp_path / "in" / name).write_bytes(content)
    clean.clean_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), layout="files")
    assert _read(tmp_path / "out") == {name.replace("ԥ", "豫"): content for name, content in files.items()}


def test_a_folder_is_listed_in_parts(tmp_path, monkeypatch):
    import pyarrow as pa

    names = [f"{i}.csv" for i in range(10)] + ["_x", ".y"]
    for name in names:
        (tmp_path / name).write_text("x")
    (tmp_path / "below").mkdir()
    os.symlink(tmp_path / "gone", tmp_path / "broken")
    monkeypatch.setattr(file_tree, "_LISTED_AT_ONCE", 4)
    folders = pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}", f"file:{tmp_path}/below", f"file:{tmp_path}/gone"]})
    parts = list(file_tree._list_folders(iter([folders])))
    assert len(parts) == 4 and max(p.num_rows for p in parts) <= 4
    found = {r["path"].rsplit("/", 1)[1]: (r["is_folder"], r["length"]) for p in parts for r in p.to_pylist()}
    assert found == {f"{i}.csv": (False, 1) for i in range(10)} | {"below": (True, found["below"][1])}
