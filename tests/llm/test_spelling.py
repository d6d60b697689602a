"""Spelling variants: the query on its whole table and odd rows, against brute force."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from fleetloom.llm import queries, spelling
from test_llm_operators import DOCS

SF_DIR = "/root/testdata/sf0.001"


def counted(docs):
    """Word to count, from (doc_id, text)."""
    found = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def expected(docs):
    """Rows by comparing words that are equal, or have equal parts, without one letter."""
    n = counted(docs)
    shared = collections.defaultdict(set)
    for w in n:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            shared[key].add(w)
    near = collections.defaultdict(set)
    for group in shared.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def rows_of(frame):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect())


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    wanted = expected(docs)
    assert len({r[2] for r in wanted}) < len(wanted) > 500
    assert rows_of(queries.op13_spelling_variants(spark, SF_DIR)) == wanted


@pytest.fixture(scope="module")
def misspelt(spark):
    """Chains of ever rarer spellings, ties, letters beyond ASCII, odd rows and clashing names."""
    draw = random.Random(5)
    chain = ["receive", "recieve", "recievee", "recieveee", "rrecieveee"]
    texts = [(i, " ".join(w for k, w in enumerate(chain) for _ in range(max(1, 48 >> k)))) for i in range(3)]
    texts += [(10 + i, " ".join("".join(draw.choices("abé", k=draw.choice([4, 5, 6]))) for _ in range(800))) for i in range(3)]
    texts += [(20, "Éclair éclair éclair éclair eclair ECLAIR eclair ×÷straße straße straße strasse strasse strasse " * 2)]
    texts += [(30, None), (31, ""), (None, "nullid nullid nullidd nullidd nullidd"), (32, "a" * 70_000), (32, "a" * 70_000), (33, "a" * 69_999)] + [(34, "tied! tiel? tied tiel tied tiel ties ties ties ties ties ties ties ties")] * 3
    return texts


@pytest.mark.parametrize("block", [3, 2048])
def test_odd_rows(spark, misspelt, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "PAIRS", 7)
    frame = spark.createDataFrame([(d, t, None, None, None) for d, t in misspelt], DOCS).selectExpr("*", "1 AS word", "2 AS n", "3 AS cell", "4 AS block", "5 AS root")
    wanted = expected(misspelt)
    assert max(len([r for r in wanted if r[2] == root]) for root in {r[2] for r in wanted}) > 3
    assert rows_of(spelling.variants(frame)) == wanted


def test_blocks_of_letters_find_all_pairs():
    draw = random.Random(2)
    short = sorted({"".join(draw.choices("abc", k=5)) for _ in range(150)})
    long = sorted({"".join(draw.choices("abc", k=6)) for _ in range(300)})
    matrix = lambda ws: np.frombuffer("".join(ws).encode("latin-1"), dtype=np.uint8).reshape(len(ws), -1)
    for one, two, same in ((short, short, True), (short, long, False)):
        i, j = spelling.near_pairs(matrix(one), matrix(two), same)
        wanted = {(x, y) for x, a in enumerate(one) for y, b in enumerate(two) if one_edit(a, b) and (x < y or not same)}
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == wanted and len(i) == len(wanted)


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, "a b c", None, None, None)], DOCS)).collect() == []
