"""Whitening of vectors by exact integer scatter sums.

Every entry becomes a whole number. A task takes the distinct vectors a batch at a time,
shifts each dimension by its least entry of the batch, and packs each bit plane of the
shifted numbers across the rows into 64-bit words. The number of bits that two planes
share, weighted by both planes' places, adds up to the exact product sum of two
dimensions; the shifts are taken out again in whole numbers. Spark adds the tasks' sums,
cut into 32-bit limbs so that nothing overflows, and only these sums, of dimensions
squared and not of rows, reach the driver, which centres them as whole numbers before
the eigenvectors are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.session import scratch_table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Entries of this size or more have no whole number that a long holds.
LARGEST = 2.0**56
# An eigenvalue below this share of the largest one, times the dimensions, is rounding.
NO_VARIANCE = 2.0**-50
# Rows that are packed and multiplied together.
BLOCK_ROWS = 8192
LIMB, LIMBS = 32, 6


def whole_numbers(vector: str) -> Column:
    """floor(64 * c) + 1000000 of every entry c."""
    return F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(OFFSET).cast("bigint"))


def usable(vector: str) -> Column:
    """Neither null nor empty, and all entries finite numbers below ``LARGEST``."""
    fine = F.forall(F.col(vector), lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def _matrix(column: pa.Array, first: int, last: int, width: int) -> np.ndarray:
    return column.slice(first, last - first).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def block_scatter(x: np.ndarray) -> np.ndarray:
    """Exact product sums of the columns of ``x`` and of a column of ones, as Python integers."""
    rows, width = x.shape
    least = x.min(axis=0)
    shifted = (x - least).view(np.uint64)
    planes = [int(top).bit_length() for top in shifted.max(axis=0)]
    owner = np.repeat(np.arange(width), planes)
    place = np.concatenate([np.arange(p) for p in planes]) if len(owner) else np.zeros(0, dtype=np.int64)
    words = np.zeros((len(owner), -(-rows // 64) * 8), dtype=np.uint8)
    for k, (column, bit) in enumerate(zip(owner, place, strict=True)):
        words[k, : -(-rows // 8)] = np.packbits(((shifted[:, column] >> np.uint64(bit)) & np.uint64(1)).astype(bool))
    words = words.view(np.uint64)
    shared = np.zeros((len(owner), len(owner)), dtype=np.int64)
    for k in range(len(owner)):
        shared[k, k:] = np.bitwise_count(words[k] & words[k:]).sum(axis=1, dtype=np.int64)
        shared[k:, k] = shared[k, k:]
    # Weighted by 2 ** place and added up by dimension; in Python integers unless 63 bits hold every sum.
    kind = np.int64 if 2 * max(planes) + rows.bit_length() <= 62 else object
    weight = np.array([1 << int(p) for p in place], dtype=kind)
    products = np.zeros((width, width), dtype=object)
    sums = np.zeros(width, dtype=object)
    have = np.flatnonzero(np.array(planes) > 0)
    if len(have):
        starts = np.searchsorted(owner, have)
        weighted = shared.astype(kind) * weight[:, None] * weight[None, :]
        products[np.ix_(have, have)] = np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1).astype(object)
        sums[have] = np.add.reduceat(np.diagonal(shared).astype(kind) * weight, starts).astype(object)
    # Out of shifted coordinates: the sum of (u + s)(v + t) over the rows.
    shift = least.astype(object)
    out = np.empty((width + 1, width + 1), dtype=object)
    out[:width, :width] = products + np.outer(sums, shift) + np.outer(shift, sums) + rows * np.outer(shift, shift)
    out[:width, width] = out[width, :width] = sums + rows * shift
    out[width, width] = rows
    return out


def _scatter(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1), dtype=object)
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                total += block_scatter(_matrix(batch.column("x"), first, min(first + BLOCK_ROWS, batch.num_rows), width))
        if total[width, width]:
            i, j = np.triu_indices(width + 1)
            values = total[i, j]
            limbs = [pa.array([(int(v) >> (LIMB * k)) & ((1 << LIMB) - 1) for v in values], pa.int64()) for k in range(LIMBS - 1)]
            limbs.append(pa.array([int(v) >> (LIMB * (LIMBS - 1)) for v in values], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *limbs], names=["i", "j", *[f"l{k}" for k in range(LIMBS)]])

    return run


def exact_scatter(fit: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the sums S and the product sums of the vectors ``x`` of ``fit``, as Python integers."""
    limbs = [f"l{k}" for k in range(LIMBS)]
    schema = "i bigint, j bigint, " + ", ".join(f"{x} bigint" for x in limbs)
    sums = fit.select("x").mapInArrow(_scatter(width), schema).groupBy("i", "j").agg(*[F.sum(x).alias(x) for x in limbs])
    whole = np.zeros((width + 1, width + 1), dtype=object)
    for row in sums.collect():  # one row per pair of dimensions
        whole[row["i"], row["j"]] = whole[row["j"], row["i"]] = sum(row[x] << (LIMB * k) for k, x in enumerate(limbs))
    return whole[width, width], whole[width, :width], whole[:width, :width]


class Whitening:
    """Mean and components of a fit list, made from its exact sums."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, components: int):
        self.n, self.sums = int(n), [int(s) for s in sums]
        width = len(self.sums)
        # n squared times the covariance, exactly; one rounding each makes it double.
        covariance = np.array([[(self.n * int(products[i][j]) - self.sums[i] * self.sums[j]) / self.n**2 for j in range(width)] for i in range(width)])
        values, vectors = np.linalg.eigh(covariance)
        chosen = np.argsort(-values, kind="stable")[: min(components, width)]
        values, vectors = values[chosen], vectors[:, chosen]
        # Either sign may be taken: the entry of largest size is positive.
        vectors = vectors * np.where(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(chosen))] < 0, -1.0, 1.0)
        trace = float(np.trace(covariance))
        flat = values <= max(float(values[0]), 0.0) * NO_VARIANCE * width
        self.explained = [float(v) / trace if trace > 0 else None for v in np.where(flat, 0.0, values)]
        self.varied = ~flat
        self.scales = vectors / np.sqrt(np.where(flat, 1.0, values))
        self.quotients = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rests = np.array([s % self.n for s in self.sums], dtype=object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on every component, over the root of its variance."""
        centred = (x - self.quotients).astype(np.float64) - (self.rests / self.n).astype(np.float64)
        return centred @ self.scales

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum of (n * x - S) ** 2 over the dimensions, exactly."""
        near = x - self.quotients
        bound = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if bound * bound * len(self.sums) < 1 << 63:
            far = self.n * near - self.rests.astype(np.int64)
            return (far * far).sum(axis=1).tolist()
        far = near.astype(object) * self.n - self.rests
        return (far * far).sum(axis=1).tolist()


def _identity_sums(whitening: Whitening, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = whitening.scales.shape[1]
        i, j = np.triu_indices(k + 1)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                z = whitening.whitened(_matrix(batch.column("x"), first, min(first + BLOCK_ROWS, batch.num_rows), width))
                z = np.hstack([z, np.ones((len(z), 1))])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    return run


def identity_error(fit: DataFrame, whitening: Whitening, width: int) -> float | None:
    """How far the covariance of the whitened fit list is from the identity, at most in any entry."""
    sums = fit.select("x").mapInArrow(_identity_sums(whitening, width), "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    k = whitening.scales.shape[1]
    whole = np.zeros((k + 1, k + 1))
    for row in sums.collect():  # one row per pair of components
        whole[row["i"], row["j"]] = whole[row["j"], row["i"]] = row["v"]
    mean = whole[k, :k] / whitening.n
    off = np.abs(whole[:k, :k] / whitening.n - np.outer(mean, mean) - np.eye(k))[np.ix_(whitening.varied, whitening.varied)]
    return float(off.max()) if off.size else None


def _project(whitening: Whitening, width: int, error: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = whitening.scales.shape[1]
        flat = np.repeat(~whitening.varied[None, :], BLOCK_ROWS, axis=0)
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                last = min(first + BLOCK_ROWS, batch.num_rows)
                x = _matrix(batch.column("x"), first, last, width)
                rows = np.repeat(np.arange(len(x)), k)
                deviations = pa.array([d if d < 10**38 else None for d in whitening.deviations(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(first, last - first).take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), whitening.n, dtype=np.int64)),
                        deviations.take(pa.array(rows)),
                        pa.array(whitening.whitened(x).ravel(), mask=flat[: len(x)].ravel()),
                        pa.array(whitening.explained * len(x), pa.float64()),
                        pa.array([error] * len(rows), pa.float64()),
                    ],
                    names=["_row", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whitened(vectors: DataFrame, key: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """A row per usable row of ``vectors`` and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds a null, a non-finite entry or one of 2**56
    or more, which has no long, are left out. So are vectors of another length than most
    distinct vectors have (of equally many, the longest). The fit list is each distinct
    vector once, so repeated rows, however many, weigh like one; each of them gets its
    own rows, as do rows of a null or repeated key. ``deviation`` is a decimal of 38
    digits, null beyond. A component without variance (fewer distinct vectors than
    components, or a constant dimension) has explained 0 and whitened null; if no
    dimension varies, explained and identity_error are null too. Other columns are not
    looked at, whatever their names. An empty table gives an empty one.

    Memory: per task a block of ``BLOCK_ROWS`` rows with its bit planes; on the driver the
    square of the number of dimensions.
    """
    usable_rows = vectors.where(usable(vector)).select(F.col(key).alias("_row"), whole_numbers(vector).alias("x"))
    fit = scratch_table(usable_rows.select("x").distinct().withColumn("_width", F.size("x")), "distinct-vectors")
    commonest = fit.groupBy("_width").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("_width")).first()
    key_type = vectors.schema[key].dataType.simpleString()
    schema = f"_row {key_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if commonest is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("_row", key)
    width = commonest["_width"]
    fit = fit.where(F.col("_width") == width)
    whitening = Whitening(*exact_scatter(fit, width), components)
    error = identity_error(fit, whitening, width)
    return usable_rows.where(F.size("x") == width).mapInArrow(_project(whitening, width, error), schema).withColumnRenamed("_row", key)
