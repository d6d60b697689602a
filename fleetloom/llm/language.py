"""Language of whole texts: sparse multinomial regression on TF-IDF character n-grams.

Document frequencies are counted over all rows to learn from. The weights are fitted on a
bounded sample of them by follow-the-regularised-leader with elastic-net penalties, and a
temperature, chosen on a part of the sample that the weights have not seen, makes the
scores honest. Prediction reads the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm import words
from fleetloom.session import scratch_table

BUCKETS = 1 << 16
LONGEST = 3
# The sample: this many rows, shared evenly by the languages; one in five is for the temperature.
TRAIN_ROWS = 4000
EPOCHS = 3
RATE, SMOOTHING, L1, L2 = 0.5, 1.0, 0.02, 0.02
SCALE = 10.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket and the text of every n-gram, and which texts have a letter.

    Texts are lower-cased; other characters than letters count as spaces, and n-grams of
    spaces alone are left out.
    """
    lowered = [t.lower() for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[code]
    values = np.where(letter, code, np.uint32(0x20)).astype(np.uint64)
    buckets, owners, some = [], [], np.zeros(len(values), dtype=bool)
    for n in range(1, LONGEST + 1):
        some = letter | np.concatenate([[False], some[:-1]])[: len(some)]  # a letter among the n
        fits = some.copy()
        fits[: n - 1] = False
        fits[n - 1 :] &= owner[n - 1 :] == owner[: max(0, len(owner) - n + 1)]
        buckets.append((words.mixed(_ngram(values, n)[fits]) >> np.uint64(48)).astype(np.int64))
        owners.append(owner[fits])
    return np.concatenate(buckets), np.concatenate(owners), np.bincount(owner[letter], minlength=len(texts)) > 0


def _ngram(values: np.ndarray, n: int) -> np.ndarray:
    """A number for the n values that end at each place."""
    out = np.full(len(values), n, dtype=np.uint64)
    for back in range(n - 1, -1, -1):
        shifted = values if not back else np.concatenate([np.zeros(min(back, len(values)), np.uint64), values[: max(0, len(values) - back)]])
        out = out * np.uint64(words.WORD_BASE) + shifted
    return out


class Model(NamedTuple):
    languages: list[str]
    inverse: np.ndarray  # of document frequency, by bucket
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fitted(examples: list[tuple[str, np.ndarray, np.ndarray]], inverse: np.ndarray) -> Model | None:
    """The model from (language, buckets, counts), in the order given; every fifth sets the temperature."""
    languages = sorted({e[0] for e in examples})
    if not languages:
        return None
    k, index = len(languages), {x: i for i, x in enumerate(languages)}
    rows = [(index[x], b, (c / c.sum() * inverse[b] * SCALE).astype(np.float64)) for x, b, c in examples if len(b)]
    seen, unseen = [r for i, r in enumerate(rows) if i % 5], rows[::5]
    # One more coordinate, always 1, is the bias.
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        """The leader's weights in closed form: zero where the gradients stay within L1."""
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((SMOOTHING + np.sqrt(n[at])) / RATE + L2)

    for _ in range(EPOCHS):
        for label, b, x in seen:
            at, x = np.append(b, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1
            gradient = x[:, None] * error
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / RATE
            z[at] += gradient - step * w
            n[at] += gradient**2
    final = weights(slice(None))
    logits = np.array([x @ final[b] + final[BUCKETS] for _, b, x in unseen])
    labels = np.array([label for label, _, _ in unseen])

    def loss(t: float) -> float:
        p = _softmax(logits / t)[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    temperature = min(np.geomspace(0.05, 20, 121), key=loss) if len(labels) else 1.0
    return Model(languages, inverse, final[:BUCKETS], final[BUCKETS], float(temperature))


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
    column = batch.column("text")
    for first, last in words.slices(column):
        yield first, last, [t or "" for t in column.slice(first, last - first).to_pylist()]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, total = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in batches:
        for _, _, texts in _text_slices(batch):
            buckets, owner, _ = grams(texts)
            order = np.argsort(owner, kind="stable")
            for part in np.split(buckets[order], np.searchsorted(owner[order], np.arange(1, len(texts)))):
                here = np.zeros(BUCKETS, dtype=bool)
                here[part] = True
                counts += here
            total += len(texts)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1)), pa.array(np.append(counts[found], total))], names=["bucket", "n"]
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, texts in _text_slices(batch):
            buckets, owner, _ = grams(texts)
            order = np.argsort(owner, kind="stable")
            parts = np.split(buckets[order], np.searchsorted(owner[order], np.arange(1, len(texts))))
            pairs = [np.unique(p, return_counts=True) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang").slice(first, last - first),
                    batch.column("_place").slice(first, last - first),
                    pa.array([b for b, _ in pairs], pa.list_(pa.int64())),
                    pa.array([c for _, c in pairs], pa.list_(pa.int64())),
                ],
                names=["lang", "_place", "buckets", "counts"],
            )


def trained(learnable: DataFrame) -> Model | None:
    """The model from rows of text and lang (not null) with a unique, stable ``_place``."""
    frequencies = learnable.select("text").mapInArrow(_frequencies, "bucket bigint, n bigint")
    counted = {r["bucket"]: r["n"] for r in frequencies.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = counted.pop(-1, 0)
    by_language = {r["lang"]: r["n"] for r in learnable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total or not by_language:
        return None
    inverse = np.full(BUCKETS, np.log(1.0 + total))
    at = np.fromiter(counted, dtype=np.int64)
    inverse[at] = np.log((1.0 + total) / (1.0 + np.fromiter(counted.values(), dtype=np.float64)))
    each = max(5, TRAIN_ROWS // len(by_language))
    share = F.create_map(*[F.lit(x) for lang, n in by_language.items() for x in (lang, min(1.0, each / n))])
    drawn = F.pmod("_place", F.lit(1 << 40)) < share[F.col("lang")] * float(1 << 40)
    sample = scratch_table(learnable.where(drawn).mapInArrow(_counts, "lang string, _place bigint, buckets array<bigint>, counts array<bigint>"), "language-sample")
    rows = sample.orderBy("_place").limit(TRAIN_ROWS).collect()
    return fitted([(r["lang"], np.array(r["buckets"]), np.array(r["counts"])) for r in rows], inverse)


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``lang_pred`` and ``score`` for every row of ``docs``, whose other columns stay.

    ``und``, with score 0, where the text is null or has no letter, or nothing was learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if model is None else (model.weights * model.inverse[:, None] * SCALE).astype(np.float32)
        for batch in batches:
            for first, last, texts in _text_slices(batch):
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if table is not None:
                    buckets, owner, spoken = grams(texts)
                    total = np.maximum(1, np.bincount(owner, minlength=len(texts)))
                    sums = np.stack([np.bincount(owner, weights=table[:, j][buckets], minlength=len(texts)) for j in range(table.shape[1])], axis=1)
                    p = _softmax((sums / total[:, None] + model.bias) / model.temperature)
                    best = p.argmax(axis=1)
                    names = [model.languages[b] if s else UNKNOWN for b, s in zip(best, spoken, strict=True)]
                    scores = np.where(spoken, p[np.arange(len(texts)), best], 0.0)
                out = batch.slice(first, last - first).drop_columns(["text"])
                out = out.append_column("lang_pred", pa.array(names, pa.string()))
                yield out.append_column("score", pa.array(scores, pa.float64()))

    schema = docs.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The third of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out.

    Rows without a doc_id or a lang teach nothing. Repeated rows teach as often as they
    stand, and are answered alike.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    learnable = rows.where("not held_out and doc_id is not null and lang is not null and text is not null")
    model = trained(learnable.select("text", "lang", F.xxhash64("doc_id").alias("_place")))
    return predicted(rows.select("doc_id", "held_out", "text"), model)
