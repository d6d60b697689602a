"""The pipeline's stages: each takes what it should, and keeps clean documents."""

import random

import pytest

import corpus_pipeline
from fleetloom.session import scratch_table
from test_llm_operators import DOCS, text

SF_DIR = "/root/testdata/sf0.001"


def prose(seed, n):
    draw = random.Random(str(seed))
    return " ".join(w if i % 7 else draw.choice(["the", "of", "and", "to", "in", "is"]) for i, w in enumerate(text(seed, n).split())) + "."


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, by name."""
    clean = [(i, prose(("clean", i), 150), "en", "s", 1) for i in range(40)]
    near = prose("near", 200).split()
    copies = [(100 + i, " ".join(near[:50] + ([f"w{i}"] if i else []) + near[50:]), "en", "s", 1) for i in range(5)]
    passage = prose("shared", 70)
    sharing = [(200 + i, prose(("own", i), 80) + " " + passage + " " + prose(("more", i), 60), "en", "s", 1) for i in range(3)]
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first()["text"]
    leak = [(300, prose("host", 90) + " " + item + " " + prose("rest", 90), "en", "s", 1)]
    junk = [(400 + i, " ".join(w + "%%%" for w in text(("junk", i), 90).split()), "en", "s", 1) for i in range(8)]
    odd = [(500, None, None, None, None), (501, "", "en", "s", 0)]
    docs = spark.createDataFrame(clean + copies + sharing + leak + junk + odd, DOCS)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = scratch_table(stage(spark, docs, SF_DIR), "stage")
    return out


def ids(frame):
    return sorted({r["doc_id"] for r in frame.select("doc_id").collect()})


def test_each_stage_takes_its_own(stages):
    clean = list(range(40))
    names = [name for name, _ in corpus_pipeline.STAGES]
    quality, near, substring, benchmark, packed = (stages[n] for n in names)
    assert ids(quality) == [*clean, *range(100, 105), 200, 201, 202, 300]
    assert ids(near) == [*clean, 100, 200, 201, 202, 300]
    by_id = {r["doc_id"]: r["text"] for r in substring.collect()}
    assert sorted(by_id) == ids(near)
    assert len(by_id[200].split()) == 210 and len(by_id[201].split()) == len(by_id[202].split()) == 140
    assert ids(benchmark) == ids(packed) == [*clean, 100, 200, 201, 202]


def test_columns_stay(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.count() > 0 and "sequence_id" in packed.columns
