"""Word passages that repeat across documents, found by doubling the window length.

Level 1 takes windows of half the asked length, at anchors only: in every run of words
as long as the asked window, the inner window of smallest hash is an anchor, so equal
passages share an anchor wherever they stand. Anchors that occur in one document alone
are dropped. Level 2 extends the others: only windows of twice the length that hold a
surviving anchor are compared. A longer window removes no word that its parts of the
asked length do not, so no candidate is left beyond that length.

Copies of a whole word sequence are folded first: each copy but the one of smallest
doc_id is covered whole, and adds no window of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetloom.llm import words
from fleetloom.llm.rows import among, packed, unpacked, without
from fleetloom.session import forget_shuffles, release, scratch_scope, scratch_table

SIZE = 50


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """The least or greatest of every ``size`` neighbours, by doubling."""
    out, width = values, 1
    while width < size:
        step = min(width, size - width)
        if len(out) <= step:
            return values[:0]
        out = pick(out[:-step], out[step:])
        width += step
    return out


def _least_inner(grams: np.ndarray, whole: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words, the least hash of its inner windows."""
    n = len(whole)
    return _sliding(grams, size - size // 2 + 1, np.minimum)[:n]


def joined(texts: words.Texts, i: int, keep: np.ndarray | None = None) -> bytes:
    """The words of text ``i``, or those to keep, with one space between."""
    low, high = texts.bounds[i], texts.bounds[i + 1]
    data = memoryview(np.ascontiguousarray(texts.data))
    places = range(low, high) if keep is None else np.flatnonzero(keep[: high - low]) + low
    return b" ".join([data[texts.starts[w] : texts.ends[w]] for w in places])


def _describe(size: int):
    half = size // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in words.slices(column):
                texts = words.texts_of(column, first, last)
                hashes = texts.word_hashes()
                low, high = texts.bounds[:-1], texts.bounds[1:]
                whole = texts.inside(size)
                least = _least_inner(words.windows_hash(hashes, half), whole, size)
                text = texts.window_text(size)
                anchors = [np.unique(least[a:b][whole[a:b]]) for a, b in _ranges(text, len(texts))]
                sizes = np.cumsum([0, *map(len, anchors)])
                values = words.signed(np.concatenate(anchors)) if anchors else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        batch.column("_text").slice(first, last - first),
                        pa.array(high - low, pa.int64()),
                        pa.array(words.signed(words.spans_hash(hashes, low, high, words.WORD_BASE))),
                        pa.array(words.signed(words.spans_hash(hashes, low, high, words.OTHER_BASE))),
                        pa.array([hashlib.sha256(joined(texts, i)).hexdigest() for i in range(len(texts))], pa.string()),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values)),
                    ],
                    names=["doc_id", "_text", "n_words", "_f1", "_f2", "whole_sha256", "_anchors"],
                )

    return run


def _ranges(owner: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Where the entries of each of ``n`` ascending owners begin and end."""
    edges = np.searchsorted(owner, np.arange(n + 1))
    return list(zip(edges[:-1], edges[1:], strict=True))


def _extend(size: int):
    half = size // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, kept = batch.column("text"), batch.column("_anchors")
            for first, last in words.slices(column):
                texts = words.texts_of(column, first, last)
                hashes = texts.word_hashes()
                whole = texts.inside(size)
                least = _least_inner(words.windows_hash(hashes, half), whole, size)
                windows = words.windows_hash(hashes, size, words.OTHER_BASE)
                text = texts.window_text(size)
                for i, (low, high) in enumerate(_ranges(text, len(texts))):
                    anchors = kept[first + i].values.to_numpy(zero_copy_only=False).view(words.U64)
                    at = np.flatnonzero(whole[low:high] & np.isin(least[low:high], anchors))
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(words.signed(windows[low + at])),
                                pa.array(words.signed(least[low + at])),
                                pa.array(np.full(len(at), batch.column("doc_id")[first + i].as_py(), np.int64)),
                                pa.array(np.full(len(at), batch.column("_text")[first + i].as_py(), np.int64)),
                                pa.array(at.astype(np.int32)),
                            ],
                            names=["_window", "_anchor", "doc_id", "_text", "at"],
                        )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_text"))


def repeated_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """A row per row of ``docs``: doc_id, _text, n_words, whole_sha256, copy, starts.

    ``_text`` is ``xxhash64(text)``. ``copy`` says that a document of smaller doc_id has
    the same words, at least ``size`` of them; then every word is covered. ``starts`` are
    the places of the windows of ``size`` words that also stand in a document of smaller
    doc_id, null if there are none. Rows without a doc_id take no part: they cover
    nothing and nothing in them is covered. Rows of one doc_id do not cover each other;
    a repeated row is answered like the first.
    """
    if size < 4:
        raise ValueError("a window has at least four words")
    rows = _keyed(docs)
    described = scratch_table(
        rows.mapInArrow(
            _describe(size),
            "doc_id bigint, _text bigint, n_words bigint, _f1 bigint, _f2 bigint, whole_sha256 string, _anchors array<bigint>",
        ),
        "passages",
    )
    long = described.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= size))
    first = long.groupBy("_f1", "_f2").agg(F.min("doc_id").alias("_first"))
    folded = scratch_table(
        long.select("doc_id", "_text", "_f1", "_f2").distinct().join(first, ["_f1", "_f2"]).select("doc_id", "_text", (F.col("doc_id") > F.col("_first")).alias("copy")),
        "passage-copies",
    )
    single = folded.where("not copy").drop("copy")
    anchors = long.join(single, ["doc_id", "_text"], "left_semi").select("doc_id", "_text", F.explode("_anchors").alias("_anchor"))
    # What is joined is written first, so that both sides come from a shuffle and a hot key is split.
    shared = scratch_table(
        anchors.groupBy("_anchor").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).where("_low < _high").select("_anchor"),
        "shared-anchors",
    )
    survivors = anchors.join(shared, "_anchor").groupBy("doc_id", "_text").agg(F.collect_set("_anchor").alias("_anchors"))
    survivors = scratch_table(survivors, "passage-survivors")
    release(shared)
    forget_shuffles(docs.sparkSession)
    windows = scratch_table(
        rows.join(survivors, ["doc_id", "_text"]).mapInArrow(
            _extend(size), "_window bigint, _anchor bigint, doc_id bigint, _text bigint, at int"
        ),
        "passage-windows",
    )
    release(survivors)
    forget_shuffles(docs.sparkSession)
    firsts = windows.groupBy("_window", "_anchor").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    owner = scratch_table(firsts.where("_first < _last").drop("_last"), "passage-owners")
    found = (
        windows.join(owner, ["_window", "_anchor"])
        .where("doc_id > _first")
        .groupBy("doc_id", "_text")
        .agg(F.sort_array(F.collect_set("at")).alias("starts"))
    )
    marks = folded.where("copy").withColumn("starts", F.lit(None).cast("array<int>")).unionByName(found.withColumn("copy", F.lit(False)))
    return described.drop("_f1", "_f2", "_anchors").join(marks, ["doc_id", "_text"], "left").withColumn("copy", F.coalesce("copy", F.lit(False)))


def _covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    steps = np.zeros(n + size + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps)[:n] > 0


def _strip(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in words.slices(column):
                texts = words.texts_of(column, first, last)
                kept, removed = [], []
                for i, n in enumerate(np.diff(texts.bounds)):
                    starts = batch.column("_starts")[first + i].values
                    gone = _covered(n, starts.to_numpy(zero_copy_only=False).astype(np.int64), size)
                    kept.append(joined(texts, i, ~gone).decode("utf-8", "replace"))
                    removed.append(int(gone.sum()))
                out = batch.slice(first, last - first).drop_columns(["_starts"])
                out = out.set_column(out.schema.get_field_index("text"), "text", pa.array(kept, pa.string()))
                yield out.append_column("_removed", pa.array(removed, pa.int64()))

    return run


def stripped(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """``rows`` without the words that the windows at ``_starts`` cover, counted in ``_removed``."""
    schema = rows.drop("_starts").withColumn("_removed", F.lit(0).cast("bigint")).schema
    return rows.mapInArrow(_strip(size), schema)


def digest(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, a row per row of ``docs``."""
    with scratch_scope(docs.sparkSession) as scope:
        windows = scope.keep(scratch_table(repeated_windows(docs, size), "passage-rows"))
    cut = windows.where("starts is not null").select("doc_id", "_text", "n_words", F.col("starts").alias("_starts")).dropDuplicates(["doc_id", "_text"])
    changed = stripped(_keyed(docs).join(cut, ["doc_id", "_text"]), size)
    return (
        windows.where("starts is null")
        .select(
            "doc_id",
            "n_words",
            F.when(F.col("copy"), F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
            F.when(F.col("copy"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("whole_sha256")).alias("kept_sha256"),
        )
        .unionByName(changed.select("doc_id", "n_words", F.col("_removed").alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")))
    )


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, all other columns as they are.

    A text that loses words becomes its kept words with one space between; others stay
    unchanged, byte for byte. Documents left without a word by this are dropped.
    """
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), text=F.col("text"), _text=F.xxhash64("text"))
    with scratch_scope(docs.sparkSession) as scope:
        windows = repeated_windows(docs, size).where("copy or starts is not null")
        marks = scratch_table(windows.select("doc_id", "_text", F.col("starts").alias("_starts")).dropDuplicates(["doc_id", "_text"]), "passage-marks")
        whole = without(rows, marks, scope)
        cut = scope.keep(scratch_table(marks.where("_starts is not null"), "passage-cuts"))
    # Only the texts to cut are shuffled, not all.
    changed = stripped(among(rows, cut).join(cut, ["doc_id", "_text"]).select("text", "_row", "_starts"), size)
    return unpacked(whole.select("text", "_row").unionByName(changed.where("text <> ''").drop("_removed")), docs, text=F.col("text"))
