"""Mixing: targets by plain fractions, quotas and disjoint blocks, odd rows, the query on its whole table."""

import collections
import re
from fractions import Fraction

import numpy as np
import pytest

from fleetloom.llm import mixing, queries
from test_llm_operators import DOCS, text

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Source to target, by sharing the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in open_)) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, Fraction(3 * sizes[s])) for s in names}
        stopped |= above


def check_digest(rows, docs, near):
    """``docs`` are (doc_id, source, text); every source's words come to its target within ``near`` words."""
    size = lambda t: len(WORD.findall(t or ""))
    sizes = collections.Counter()
    for _, source, t in docs:
        sizes[source] += size(t)
    wanted = targets(sizes)
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert len(rows) == len(docs)
    taken = collections.Counter()
    for doc_id, source, t in docs:
        fitting = [r for r in by_doc[doc_id] if r["size"] == size(t) and r["source_size"] == sizes[source]]
        r = fitting[0]
        by_doc[doc_id].remove(r)
        assert r["target"] == pytest.approx(float(wanted[source]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, words in taken.items():
        assert abs(words - wanted[source]) <= near


def test_query_meets_its_targets(spark):
    docs = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = queries.op12_source_mixing(spark, SF_DIR).collect()
    check_digest(rows, docs, near=0.5)
    again = queries.op12_source_mixing(spark, SF_DIR).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


@pytest.fixture(scope="module")
def sources(spark):
    """A hot source, small ones, one without words, a null source, copies, a long text, odd ids."""
    rows = [(i, text(("hot", i), 40 + i % 30), "hot") for i in range(300)]
    rows += [(1000 + i, text(("small", i), 3), "a") for i in range(4)]
    rows += [(2000, "", "empty"), (2001, None, "empty"), (2002, text("long", 5000), "long"), (2003, "one", "ä"), (2004, "x y\tz\n", None)]
    rows += [(3000, text("copy", 30), "b")] * 5 + [(None, text("no id", 20), "b"), (None, None, None)]
    return [(d, t, "en", s, 1) for d, t, s in rows]


def test_odd_sources(spark, sources):
    frame = spark.createDataFrame(sources, DOCS).selectExpr("*", "1 AS size", "2 AS taken", "3 AS shard", "4 AS first", "5 AS copies")
    rows = mixing.digest(frame).collect()
    # Five equal rows are taken together, so a source may end fewer than five words short.
    check_digest(rows, [(d, s, t) for d, t, _, s, _ in sources], near=5)
    assert len({r["taken"] for r in rows if r["doc_id"] == 3000}) == 1


@pytest.mark.parametrize("fan", [2, 64])
def test_shards_hold_disjoint_blocks(spark, sources, monkeypatch, fan):
    """Each position of a source goes to one shard; shards are equal to one block; texts are the words."""
    monkeypatch.setattr(mixing, "FAN", fan)
    monkeypatch.setattr(mixing, "SOURCES_PER_GROUP", 2)
    docs = spark.createDataFrame(sources, DOCS)
    mixed, named, _ = mixing.mix(docs, block_words=16, shard_blocks=37)
    rows = mixed.collect()
    per_shard = collections.defaultdict(list)
    for r in rows:
        per_shard[r["shard"]].append(r["place"])
    assert len(per_shard) > 20
    assert all(sorted(places) == list(range(len(places))) for places in per_shard.values())
    assert max(map(len, per_shard.values())) - min(map(len, per_shard.values())) <= 1
    # A block is taken at most once a pass, so whole blocks appear as often as the passes.
    quota = {r["source"]: (r["quota"], r["size"]) for r in named.collect()}
    times = collections.Counter((r["doc_id"], r["source"], r["_text"], r["first"]) for r in rows)
    for (_, source, _, _), n in times.items():
        wanted, size = quota[source]
        assert wanted // size <= n <= -(-wanted // size)
    by_doc = {(d, s): WORD.findall(t or "") for d, t, _, s, _ in sources}
    for r in mixing.mixed_texts(docs, mixed).collect():
        assert WORD.findall(r["text"]) == by_doc[r["doc_id"], r["source"]][r["first"] : r["first"] + r["length"]]


def test_shards_mix_the_sources(spark):
    """A shard's share of a source is that of the whole, as a shuffle would give."""
    quotas = spark.createDataFrame([(0, 6000), (1, 3000), (2, 1000)], "index bigint, count bigint")
    cells = mixing.shard_quotas(quotas, 100, 10_000).collect()
    found = np.zeros((100, 3))
    for r in cells:
        found[r["shard"], r["index"]] = r["count"]
    assert (found.sum(axis=0) == [6000, 3000, 1000]).all() and (found.sum(axis=1) == 100).all()
    assert found[:, 0].std() == pytest.approx((100 * 0.6 * 0.4 * 0.99) ** 0.5, rel=0.35)


def test_large_populations_are_split_exactly():
    draw = np.random.default_rng(0)
    counts = np.array([5 * 10**11, 3, 0, 7 * 10**10], dtype=np.int64)
    left = mixing.split(draw, counts, 2 * 10**11)
    assert left.sum() == 2 * 10**11 and (left <= counts).all() and (left >= 0).all()
    assert left[0] / 2e11 == pytest.approx(5 / 5.7, rel=1e-4)


def test_no_documents(spark):
    assert mixing.digest(spark.createDataFrame([], DOCS)).collect() == []
    assert [r["taken"] for r in mixing.digest(spark.createDataFrame([(1, "", "en", None, 0)], DOCS)).collect()] == [0]
