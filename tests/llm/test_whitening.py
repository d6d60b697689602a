"""Whitening: exact sums by brute force, the query on its whole table, odd vectors."""

import math

import numpy as np
import pytest

from fleetloom.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


@pytest.mark.parametrize("spread", [1, 5, 300, 2**40, 2**61])
@pytest.mark.parametrize("rows", [1, 63, 64, 65, 700])
def test_block_scatter_is_exact(spread, rows):
    draw = np.random.default_rng([spread, rows])
    x = np.hstack([draw.integers(-spread, spread + 1, (rows, 4)), np.full((rows, 1), 7)]).astype(np.int64)
    with_ones = np.hstack([x, np.ones((rows, 1), dtype=np.int64)]).astype(object)
    assert (whitening.block_scatter(x) == with_ones.T @ with_ones).all()


def check(frame, vectors, components=16):
    """``frame`` holds what numpy gives for the (key, vector) pairs."""
    xs = [(k, whole(v)) for k, v in vectors]
    fit = sorted({tuple(x) for _, x in xs})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(width)]
    centred = [[n * x[j] - sums[j] for j in range(width)] for x in fit]
    covariance = np.array([[sum(c[i] * c[j] for c in centred) / n**3 for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    rows = sorted((r for r in frame.collect()), key=lambda r: (r["vec_id"], r["component"]))
    assert [(r["vec_id"], r["component"]) for r in rows] == sorted((k, c + 1) for k, _ in xs for c in range(len(values)))
    signs = {}
    by_key = {k: x for k, x in xs}
    for r in rows:
        c, x = r["component"] - 1, by_key[r["vec_id"]]
        assert r["n"] == n
        assert r["deviation"] == sum((n * x[j] - sums[j]) ** 2 for j in range(width))
        assert r["explained"] == pytest.approx(values[c] / np.trace(covariance), rel=1e-4)
        mine = sum((n * x[j] - sums[j]) / n * axes[j, c] for j in range(width)) / math.sqrt(values[c])
        if abs(mine) > 0.01:
            signs.setdefault(c, math.copysign(1, mine * r["whitened"]))
        assert r["whitened"] == pytest.approx(signs.get(c, 1) * mine, abs=1e-7)
        assert 0 <= r["identity_error"] <= 1e-9
    assert len({r["identity_error"] for r in rows}) == 1


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(queries.op11_embedding_whitening(spark, SF_DIR), [(r["vec_id"], r["embedding"]) for r in rows])


def test_odd_vectors(spark):
    """Nulls, infinities, other lengths and copies; only distinct usable vectors are fitted."""
    draw = np.random.default_rng(1)
    fine = [(i, [float(c) for c in draw.normal(0, 3, 5)]) for i in range(40)]
    copies = [(100 + i, fine[0][1]) for i in range(500)]
    odd = [
        (900, None),
        (901, []),
        (902, [1.0, None, 0.0, 0.0, 0.0]),
        (903, [float("nan")] * 5),
        (904, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
        (905, [1e300] * 5),
        (906, [1.0, 2.0]),
    ]
    frame = spark.createDataFrame(fine + copies + odd, "vec_id bigint, v array<double>").selectExpr("*", "1 AS _row", "2 AS x", "3 AS n", "4 AS component")
    check(whitening.whitened(frame, "vec_id", "v"), fine + copies)


def test_repeated_and_null_keys_keep_their_rows(spark):
    rows = [(None, [1.0, 2.0]), (None, [3.0, 2.5]), (7, [1.0, 2.0]), (7, [1.0, 2.0])]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, v array<float>"), "vec_id", "v").collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in found) == sorted((str(k), c) for k, _ in rows for c in (1, 2))
    # Two points lie on a line: the second component has no variance.
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in found)
    assert {round(r["explained"], 9) for r in found} == {0.0, 1.0}


def test_equal_vectors_have_no_variance(spark):
    found = whitening.whitened(spark.createDataFrame([(i, [0.5, 0.25]) for i in range(3)], "vec_id bigint, v array<float>"), "vec_id", "v").collect()
    assert len(found) == 6
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 1 for r in found)


def test_wide_entries_stay_exact(spark):
    rows = [(i, [float(2**50 * i), float(i * i)]) for i in range(5)]
    check(whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, v array<double>"), "vec_id", "v", 1), rows, 1)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id bigint, v array<float>")
    found = whitening.whitened(empty, "vec_id", "v")
    assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
