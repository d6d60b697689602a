"""Documents scored by a bigram model with stupid backoff, counted over all of them.

A word after another scores count(pair) / count(first), or, for a pair that stands only
once in the corpus, ALPHA * count(word) / count(all). A document's score is the sum of
the decimal logarithms. That is a sum of terms, each of one word or one pair:

* every word as if no pair were seen, and
* for a seen pair, its gain: log10(count(pair) * count(all) / (ALPHA * count(first) * count(word))).

So the work is relational. Texts are exploded to words and to pairs; both are counted in
tables by hash, pairs one hash part after the other, so that no more than a part is under
way at a time; seen pairs are joined to the counts of their two words, which gives the
table of gains; and the exploded words and pairs of the documents are joined to their
tables and summed per document.

A few of the most frequent words and pairs, whose rows would be most of those joined and
would make hot keys, are looked up where the text is read instead. Their number is fixed.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.llm import words
from fleetloom.session import forget_shuffles, release, scratch_scope, scratch_table

ALPHA = 0.4
SEEN = 2
SLICE_BYTES = 2 << 20
# Pairs are counted and joined in so many parts by hash, one after the other.
PARTS = 3
# Words, and pairs, that every task knows.
FREQUENT = 100_000
# The part of a hash is told by its high bits; the low ones spread it over partitions.
_PART_BITS = 48


class Known:
    """The logarithms of the most frequent words or pairs, by ascending hash."""

    def __init__(self, hashes: np.ndarray, logs: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.logs = hashes[order], logs[order]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are known, and their logarithms, 0 for others."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        return known, np.where(known, self.logs[at], 0.0)


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, words.Texts]]:
    column = batch.column("text")
    for first, last in words.slices(column, size):
        yield first, last, words.texts_of(column, first, last, lower=True)


def _pairs(texts: words.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, and of each pair of neighbours, with the place of its first word."""
    hashes = texts.word_hashes()
    first = np.flatnonzero(texts.inside(2))
    return hashes, words.windows_hash(hashes, 2)[first], first


def _part(pairs: np.ndarray, part: int, parts: int) -> np.ndarray:
    return (pairs >> words.U64(_PART_BITS)) % words.U64(parts) == part


def _count_words(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _slices(batch, size):
                found, n = np.unique(texts.word_hashes(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.signed(found)), pa.array(n)], names=["word", "n"])

    return run


def _count_pairs(size: int, part: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _slices(batch, size):
                hashes, pairs, first = _pairs(texts)
                chosen = _part(pairs, part, parts)
                found, at, n = np.unique(pairs[chosen], return_index=True, return_counts=True)
                at = first[chosen][at]
                arrays = [words.signed(found), words.signed(hashes[at]), words.signed(hashes[at + 1]), n]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["pair", "a", "b", "n"])

    return run


def counted_words(rows: DataFrame) -> DataFrame:
    """word (its hash), n: how often it stands in all texts."""
    counts = rows.select("text").mapInArrow(_count_words(SLICE_BYTES), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return scratch_table(counts, "words")


def _seen_part(rows: DataFrame, part: int) -> DataFrame:
    counts = rows.select("text").mapInArrow(_count_pairs(SLICE_BYTES, part, PARTS), "pair bigint, a bigint, b bigint, n bigint")
    counts = counts.groupBy("pair").agg(F.sum("n").alias("n"), F.any_value("a").alias("a"), F.any_value("b").alias("b"))
    return scratch_table(counts.where(F.col("n") >= SEEN), "pairs")


def _in_turn(spark: SparkSession, work: Callable[[int], DataFrame]) -> list[DataFrame]:
    """``work`` of every part. What a part was made of is no longer referred to when it is done, so its shuffle files go."""
    made = []
    for part in range(PARTS):
        made.append(work(part))
        forget_shuffles(spark)
    return made


def gains(seen: DataFrame, counted: DataFrame, total: int) -> DataFrame:
    """pair, n, gain: what a seen pair scores above its second word alone."""
    # A word stands at least as often as a pair that it is in.
    often = counted.where(F.col("n") >= SEEN)
    first = often.select(F.col("word").alias("a"), F.col("n").alias("_na"))
    second = often.select(F.col("word").alias("b"), F.col("n").alias("_nb"))
    gain = F.log10("n") + math.log10(total / ALPHA) - F.log10("_na") - F.log10("_nb")
    return scratch_table(seen.join(first, "a").join(second, "b").select("pair", "n", gain.alias("gain")), "gains")


def _gains_part(rows: DataFrame, counted: DataFrame, total: int, part: int) -> DataFrame:
    """The gains of one part's pairs, which are not kept."""
    seen = _seen_part(rows, part)
    forget_shuffles(rows.sparkSession)
    made = gains(seen, counted, total)
    release(seen)
    return made


def _most_frequent(table: DataFrame, key: str, log: Column) -> Known:
    """The ``FREQUENT`` most frequent rows; only they come to the driver."""
    top = table.orderBy(F.desc("n"), key).limit(FREQUENT).select(key, log.alias("log")).toArrow()
    return Known(np.asarray(top[key]).view(np.uint64), np.asarray(top["log"], dtype=np.float64))


def _explode_words(size: int, known_words: Known, known_pairs: Known, log_total: float):
    """A row per document with what its known words and pairs score, and a row per other word.

    A document's row has its text's hash as word, so such rows spread like others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in _slices(batch, size):
                hashes, pairs, at = _pairs(texts)
                owner, n = texts.text_of_word, np.diff(texts.bounds)
                known, logs = known_words.find(hashes)
                score = np.bincount(owner, weights=logs, minlength=len(n)) - n * log_total + np.maximum(0, n - 1) * math.log10(ALPHA)
                score += np.bincount(owner[at], weights=known_pairs.find(pairs)[1], minlength=len(n))
                ids, keys = (batch.column(c).slice(first, last - first) for c in ("doc_id", "_text"))
                yield pa.RecordBatch.from_arrays([ids, keys, keys, pa.array(score), pa.array(n, pa.int64())], names=_WORD_NAMES)
                rare = np.flatnonzero(~known)
                rows = pa.array(owner[rare])
                nothing = [pa.nulls(len(rare), pa.float64()), pa.nulls(len(rare), pa.int64())]
                yield pa.RecordBatch.from_arrays([ids.take(rows), keys.take(rows), pa.array(words.signed(hashes[rare])), *nothing], names=_WORD_NAMES)

    return run


_WORD_NAMES = ["doc_id", "_text", "word", "score", "n_words"]


def _explode_pairs(size: int, known_pairs: Known, part: int, parts: int):
    """A row per pair of this part that tasks do not know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in _slices(batch, size):
                _, pairs, at = _pairs(texts)
                chosen = _part(pairs, part, parts)
                chosen[chosen] = ~known_pairs.find(pairs[chosen])[0]
                rows = pa.array(texts.text_of_word[at[chosen]])
                ids, keys = (batch.column(c).slice(first, last - first).take(rows) for c in ("doc_id", "_text"))
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(words.signed(pairs[chosen]))], names=["doc_id", "_text", "pair"])

    return run


DOCUMENT = ["doc_id", "_text"]


def _word_scores(rows: DataFrame, counted: DataFrame, known_words: Known, known_pairs: Known, log_total: float) -> DataFrame:
    """doc_id, _text, score, n_words, copies: what known words and pairs and all other words score."""
    exploded = rows.mapInArrow(_explode_words(SLICE_BYTES, known_words, known_pairs, log_total), "doc_id bigint, _text bigint, word bigint, score double, n_words bigint")
    # A word that stands once has a logarithm of 0.
    logs = counted.where("n > 1").select(F.col("word").alias("_word"), F.log10("n").alias("_log"))
    joined = exploded.join(logs, (F.col("word") == F.col("_word")) & F.col("score").isNull(), "left")
    worth = F.coalesce("score", "_log", F.lit(0.0))
    sums = joined.groupBy(*DOCUMENT).agg(F.sum(worth).alias("score"), F.sum("n_words").alias("n_words"), F.count("n_words").alias("copies"))
    return scratch_table(sums, "word-scores")


def _pair_scores(rows: DataFrame, gained: DataFrame, known_pairs: Known, part: int) -> DataFrame:
    """The same columns: what the seen pairs of this part, of which ``gained`` has the gains, add that tasks do not know."""
    pairs = rows.mapInArrow(_explode_pairs(SLICE_BYTES, known_pairs, part, PARTS), "doc_id bigint, _text bigint, pair bigint")
    gain = gained.select("pair", "gain")
    zero = F.lit(0).cast("bigint")
    sums = pairs.join(gain, "pair").groupBy(*DOCUMENT).agg(F.sum("gain").alias("score"))
    return scratch_table(sums.withColumn("n_words", zero).withColumn("copies", zero), "pair-scores")


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, score (sum of decimal logarithms), mean (score a word), a row per row of ``docs``.

    Words are lower-cased in A-Z; a null or empty text has none, score 0 and no mean. A
    repeated row counts again. Rows without a doc_id are scored like others, and columns
    other than doc_id and text are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_text"))
    spark = docs.sparkSession
    with scratch_scope(spark) as scope:
        counted = counted_words(rows)
        total = counted.agg(F.sum("n")).first()[0] or 1
        each_gained = _in_turn(spark, lambda part: _gains_part(rows, counted, total, part))
        gained = functools.reduce(DataFrame.unionByName, each_gained)
        known_words = _most_frequent(counted, "word", F.log10("n"))
        known_pairs = _most_frequent(gained, "pair", F.col("gain"))

        parts = [_word_scores(rows, counted, known_words, known_pairs, math.log10(total))]
        forget_shuffles(spark)
        parts += _in_turn(spark, lambda part: _pair_scores(rows, each_gained[part], known_pairs, part))
        release(counted, *each_gained)
        forget_shuffles(spark)
        whole = functools.reduce(DataFrame.unionByName, parts).groupBy(*DOCUMENT).agg(*[F.sum(c).alias(c) for c in ("score", "n_words", "copies")])
        # Rows of one doc_id and text were summed together.
        each = whole.select(
            F.col("doc_id").alias("_d"),
            F.col("_text").alias("_t"),
            (F.col("score") / F.col("copies")).alias("score"),
            (F.col("n_words") / F.col("copies")).cast("bigint").alias("n_words"),
        )
        each = scope.keep(scratch_table(each, "document-scores"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t"))
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))
    return rows.select("doc_id", "_text").join(each, same).select("doc_id", "n_words", "score", mean.alias("mean"))
