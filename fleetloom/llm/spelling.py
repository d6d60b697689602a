"""Spelling variants: words one edit apart, found by products of letter-count blocks.

One edit changes the letter counts of a word by little: a replaced letter gives a squared
distance of two between words of one length, an added one a distance of one between
neighbouring lengths. So words are put in cells by length and by how often they hold the
commonest letters, cells into blocks of bounded size, and only blocks of neighbouring
cells meet: the product of their letter-count matrices gives all squared distances at
once. Pairs at the right distance are compared letter by letter; no other pair leaves a
task.

The letters that make the cells are counted in the vocabulary, so they follow the texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetloom.llm import words
from fleetloom.operators.lookups import lookup
from fleetloom.session import release, scratch_table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST, RAREST = 5, 3
# Runs whose hash this divides lose a letter.
SLIP = 97
# A word's form is at least this many times as frequent.
TIMES = 2
# Letters that make the cells, words in a block, pairs in one batch of a task's output.
LETTERS, BLOCK_WORDS, PAIRS = 6, 2048, 100_000
# Words whose counts a task holds before it hands them on.
HELD = 300_000


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lower = words.LOWER.tobytes()
    found: Counter = Counter()
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for row, doc_id in enumerate(ids):
            text = batch.column("text")[row].as_py()
            if not text:
                continue
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(RUN.findall(text.encode().translate(lower).decode())).items():
                h = zlib.crc32(run.encode(), prefix)
                if h % SLIP == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= SHORTEST:
                    found[run] += n
            if len(found) > HELD:
                yield _counted(found)
                found = Counter()
    yield _counted(found)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of ``SHORTEST`` letters and ``RAREST`` occurrences at least, slips made."""
    counts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RAREST)


def _letter_counts(letters: np.ndarray) -> np.ndarray:
    """A row per word, a column per Latin-1 code point."""
    rows = np.repeat(np.arange(len(letters)), letters.shape[1])
    return np.bincount(rows * 256 + letters.ravel(), minlength=len(letters) * 256).reshape(-1, 256)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``a`` and ``b`` are one edit apart: matrices of code points, ``b`` as long or one longer.

    ``same`` says that both are one block: then each pair is given once.
    """
    length, longer = a.shape[1], b.shape[1] > a.shape[1]
    counts_a, counts_b = _letter_counts(a), _letter_counts(b)
    used = counts_a.any(axis=0) | counts_b.any(axis=0)
    counts_a, counts_b = counts_a[:, used].astype(np.float32), counts_b[:, used].astype(np.float32)
    # Whole numbers far below 2**24, so 32-bit floats are exact.
    distance = (counts_a**2).sum(axis=1)[:, None] + (counts_b**2).sum(axis=1)[None, :] - 2 * (counts_a @ counts_b.T)
    i, j = np.nonzero(distance == (1 if longer else 2))
    if same:
        i, j = i[i < j], j[i < j]
    kept = np.zeros(len(i), dtype=bool)
    for first in range(0, len(i), PAIRS):
        left, right = a[i[first : first + PAIRS]], b[j[first : first + PAIRS]]
        if longer:
            before = np.cumprod(left == right[:, :length], axis=1).sum(axis=1)
            after = np.cumprod((left == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            kept[first : first + PAIRS] = before + after >= length
        else:
            kept[first : first + PAIRS] = (left != right).sum(axis=1) == 1
    return i[kept], j[kept]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["a", "na", "b", "nb"]
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        made: list[list] = [[], [], [], []]
        for row in range(batch.num_rows):
            one, two = columns["words_a"][row].as_py(), columns["words_b"][row].as_py()
            la, lb = columns["length_a"][row].as_py(), columns["length_b"][row].as_py()
            a = np.frombuffer(one.encode("latin-1"), dtype=np.uint8).reshape(-1, la)
            b = np.frombuffer(two.encode("latin-1"), dtype=np.uint8).reshape(-1, lb)
            i, j = near_pairs(a, b, columns["same"][row].as_py())
            if len(i):
                made[0] += [one[k * la : k * la + la] for k in i.tolist()]
                made[1] += columns["ns_a"][row].values.to_numpy()[i].tolist()
                made[2] += [two[k * lb : k * lb + lb] for k in j.tolist()]
                made[3] += columns["ns_b"][row].values.to_numpy()[j].tolist()
            if len(made[0]) >= PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=names)
                made = [[], [], [], []]
        if made[0]:
            yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=names)


def _blocks(vocab: DataFrame, letters: list[str]) -> DataFrame:
    """cell, block, length, words (all of a block in one string), ns: a row per block."""
    counts = [F.length("word") - F.length(F.replace("word", F.lit(c), F.lit(""))) for c in letters]
    counted = vocab.withColumn("_counts", F.array(F.lit(0), *counts))
    rest = F.length("word") - F.aggregate("_counts", F.lit(0), lambda t, x: t + x)
    celled = counted.select("word", "n", F.array_append(F.slice("_counts", 2, len(letters)), rest).alias("cell"))
    sizes = scratch_table(celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_WORDS).alias("blocks")), "cells")
    placed = lookup(celled, sizes, ["cell"], "inner").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")))
    held = placed.groupBy("cell", "block").agg(F.collect_list(F.struct("word", "n")).alias("_held"))
    return held.select(
        "cell",
        "block",
        F.aggregate("cell", F.lit(0), lambda t, x: t + x).alias("length"),
        F.array_join(F.transform("_held", lambda x: x["word"]), "").alias("words"),
        F.transform("_held", lambda x: x["n"]).alias("ns"),
    )


def _neighbours(classes: int) -> list[list[int]]:
    """Steps from a cell to those that words one edit away can be in, each pair of cells once."""
    steps = [[0] * classes]
    for i in range(classes):
        steps.append([int(k == i) for k in range(classes)])
        steps += [[int(k == i) - int(k == j) for k in range(classes)] for j in range(i)]
    return steps


def near_words(vocab: DataFrame) -> DataFrame:
    """a, na, b, nb: every pair of words one edit apart, once."""
    letters = [r["c"] for r in vocab.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").count().orderBy(F.desc("count"), "c").limit(LETTERS).collect()]
    blocks = scratch_table(_blocks(vocab, letters), "letter-blocks")
    steps = F.array(*[F.array(*[F.lit(x) for x in step]) for step in _neighbours(len(letters) + 1)])
    left = blocks.withColumn("_cell", F.explode(F.transform(steps, lambda step: F.zip_with("cell", step, lambda x, y: x + y)))).where(F.array_min("_cell") >= 0)
    left = left.select(F.col("cell").alias("cell_a"), "_cell", F.col("block").alias("block_a"), F.col("length").alias("length_a"), F.col("words").alias("words_a"), F.col("ns").alias("ns_a"))
    right = blocks.select(F.col("cell").alias("_cell"), F.col("block").alias("block_b"), F.col("length").alias("length_b"), F.col("words").alias("words_b"), F.col("ns").alias("ns_b"))
    own = F.col("cell_a") == F.col("_cell")
    pairs = left.join(right, "_cell").where(~own | (F.col("block_a") <= F.col("block_b")))
    pairs = pairs.select("length_a", "words_a", "ns_a", "length_b", "words_b", "ns_b", (own & (F.col("block_a") == F.col("block_b"))).alias("same"))
    return pairs.mapInArrow(_near, "a string, na bigint, b string, nb bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last, twice as far each round."""
    now = scratch_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = scratch_table(now.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        release(now)
        now = step.drop("moved")
        now._scratch_path = step._scratch_path
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word of the vocabulary.

    A run's letters A-Z are lower-cased, no others; a run that the slip hits loses a code
    point, by its document's id (an empty one for null) and itself. Words of equal count
    tie by code points. A form has at least twice the word's count, so following forms
    ends, after as many steps as the largest count has bits at most. Null and empty texts
    have no words; repeated rows count each time; other columns are not looked at. An
    empty table gives an empty one.
    """
    vocab = scratch_table(vocabulary(docs), "vocabulary")
    pair = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m"))))
    near = near_words(vocab).select(pair.alias("_p")).select("_p.*")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("_best"))
    judged = vocab.join(scratch_table(best, "nearest-words"), "word", "left")
    is_form = -F.col("_best.less") >= TIMES * F.col("n")
    judged = judged.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("_best.near")).alias("form"),
        F.when(is_form, -F.col("_best.less")).alias("form_n"),
    )
    judged = scratch_table(judged, "judged-words")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
