"""Each operator on rows of every odd kind: null, empty, repeated, tied, long, clashing names."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetloom.llm import (
    backoff,
    chat,
    components,
    decontaminate,
    jaccard_join,
    language,
    layout,
    packing,
    quality_votes,
    queries,
    substrings,
    url_graph,
    words,
)
from fleetloom import session
from fleetloom.llm import rows as row_columns

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def text(seed, n):
    draw = random.Random(str(seed))
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7))) for _ in range(n))


PASSAGE = text("passage", 60)
NEAR = text("near", 120)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, copies, near copies, a shared passage, an overlong word, repeated rows."""
    near = NEAR.split()
    near[60] = "other"
    rows = [
        (1, NEAR, "en", "a", 1),
        (2, " ".join(near), "en", None, None),
        (3, NEAR.replace(" ", "\n"), None, "a", 1),
        (4, text(4, 30) + " " + PASSAGE + " " + text(5, 30), "en", "a", 1),
        (5, text(6, 20) + "\t" + PASSAGE + "  " + text(7, 10), "en", "a", 1),
        (6, "", "en", "a", 1),
        (7, None, None, None, None),
        (8, " \n\t ", "en", "a", 1),
        (9, "x" * 50_000, "en", "a", 1),
        (10, "é\u00a0\u3000ü", "fr", "a", 1),
        (None, NEAR, "en", "a", 1),
        (11, text(11, 25), "en", "a", 1),
        (11, text(11, 25), "en", "a", 1),
        (12, text(12, 3000), "en", "a", 1),
        (13, "one two", "en", "a", 1),
        (14, "One two", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


CLASHING = ["_text", "_row", "kept", "copy", "starts", "node", "n", "words", "key", "at", "_rows", "component_id"]


@pytest.fixture(scope="module")
def clashing(odd_docs):
    return odd_docs.withColumns({c: F.lit(c) for c in CLASHING})


def test_words_and_hashes():
    import pyarrow as pa

    found = words.texts_of(pa.array(["a b  c\nd", None, "", " x ", "A b", "\u00a0"]), 0, 6)
    assert found.bounds.tolist() == [0, 4, 4, 4, 5, 7, 8]
    hashes = found.word_hashes()
    assert hashes[1] == hashes[6] and hashes[0] != hashes[5]
    several = words.windows_hash(hashes, 2)
    assert len(set(several.tolist())) == len(several) == 7


def test_substrings(odd_docs, empty_docs):
    found = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substrings.digest(odd_docs).collect()}
    assert found[1, 120] == 0 and found[3, 120] == 120 and found[None, 120] == 0
    assert found[4, 120] == 0 and found[5, 90] == 60
    assert found[2, 120] == 119
    assert found[7, 0] == found[6, 0] == 0 and found[11, 25] == 0
    assert substrings.digest(odd_docs).count() == odd_docs.count()
    assert substrings.digest(empty_docs).collect() == []


def test_substrings_keep_all_columns(odd_docs, clashing):
    kept = substrings.without_repeats(clashing)
    assert kept.columns == clashing.columns
    by_id = {r["doc_id"]: r for r in kept.collect()}
    assert 3 not in by_id and by_id[5]["text"] == text(6, 20) + " " + text(7, 10)
    assert by_id[4]["text"].endswith(text(5, 30)) and by_id[9]["n_chars"] == 1 and by_id[9]["_row"] == "_row"
    assert kept.where("doc_id = 11").count() == 2 and kept.where("doc_id is null").count() == 1


def test_jaccard_groups(odd_docs, empty_docs):
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_join.grouped(odd_docs).collect()}
    assert {k: v for k, v in found.items() if k[0] in (1, 2, 3)} == {(1, 117): 1, (2, 117): 1, (3, 117): 1}
    assert found[None, 117] is None and found[7, 0] == 7 and found[6, 0] == 6 and found[8, 0] == 8
    assert found[13, 1] == found[14, 1] == 13 and found[11, 22] == 11
    assert jaccard_join.grouped(empty_docs).collect() == []


@pytest.mark.parametrize("common", [2, 64])
def test_jaccard_chains(spark, monkeypatch, common):
    """Links in a chain, a hub that is not like all others, and shingles that all texts share."""
    from test_queries import groups

    monkeypatch.setattr(jaccard_join, "COMMON", common)
    base = text("chain", 90).split()
    shared = text("shared", 40)
    texts = {}
    for i in range(24):
        mine = list(base)
        mine[: i * 2] = text(("part", i // 3), 90).split()[: i * 2]
        texts[i] = " ".join(mine)
    texts |= {100 + i: shared + " " + text(("own", i), 30) for i in range(20)}
    texts |= {200 + i: text(("short", i // 2), 6 + i % 2) for i in range(40)}
    texts |= {300 + i: " ".join([*text("tail", 12).split(), *(["x"] if i % 2 else [])]) for i in range(4)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for width, percent in ((4, 85), (2, 60)):
        found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.grouped(frame, width, percent).collect())
        assert found == groups(texts, width, percent)


def test_jaccard_near_copies_of_one_text(spark, monkeypatch):
    """Copies with two words changed resemble the text, not each other; with three they resemble nothing."""
    from test_queries import groups

    base = text("template", 150).split()

    def copy(i, changed):
        mine = list(base)
        for p in random.Random(i).sample(range(5, 145, 5), changed):
            mine[p] = f"own{i}x{p}"
        return " ".join(mine)

    texts = {0: " ".join(base)} | {i: copy(i, 2) for i in range(1, 121)} | {i: copy(i, 3) for i in range(200, 280)}
    opening = text("opening", 9)
    texts |= {500 + i: opening + " " + text(("rest", i), 60) for i in range(30)}
    made = {}

    def counted(frame, label):
        made.setdefault(label, []).append((table := session.scratch_table(frame, label)).count())
        return table

    monkeypatch.setattr(jaccard_join, "scratch_table", counted)
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.grouped(frame).collect())
    assert found == groups(texts, 4, 85)
    assert sum(r[2] == 0 for r in found) == 121
    assert made["star-pairs"][0] < 121 * jaccard_join.HUBS + 30 * 29 / 2
    # The text is a hub of its copies' lists, so no pair of theirs is left over.
    assert made["other-pairs"][0] <= 30 * 29 / 2
    # Texts that only share an opening are told apart without their whole sets.
    assert made["met-sets"][0] <= 121


def test_one_of_each(clashing):
    kept = jaccard_join.one_of_each(clashing, 5, 80)
    assert kept.columns == clashing.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.collect())
    assert ids == [-1, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]


def test_shuffled_ways(spark, odd_docs, monkeypatch):
    """With the limits of all broadcasts at one row the same rows come out."""
    items = spark.createDataFrame([(1, " ".join(PASSAGE.split()[:40])), (2, text("short", 3)), (3, text("else", 30))], "item_id bigint, text string")
    ways = {
        "leaks": lambda: decontaminate.leaks(odd_docs, items),
        "groups": lambda: jaccard_join.grouped(odd_docs),
        "one": lambda: jaccard_join.one_of_each(odd_docs, 5, 80).select("doc_id", "text"),
        "cut": lambda: substrings.without_repeats(odd_docs).select("doc_id", "text"),
        "clean": lambda: decontaminate.clean_documents(odd_docs, items).select("doc_id", "text"),
        "kept": lambda: quality_votes.kept_documents(odd_docs).select("doc_id", "text"),
    }
    rows = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    expected = {name: rows(way()) for name, way in ways.items()}
    assert expected["leaks"]
    for module in (decontaminate, jaccard_join, row_columns):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    for name, way in ways.items():
        assert rows(way()) == expected[name], name


def test_scopes_delete_what_is_over(spark):
    def stands(table):
        return session.path_exists(spark, table._scratch_path)

    with session.scratch_scope(spark) as outer:
        first = outer.keep(session.scratch_table(spark.range(3), "first"))
        with session.scratch_scope(spark) as inner:
            second, third = (session.scratch_table(first, name) for name in ("second", "third"))
            inner.keep(third)
        assert stands(first) and not stands(second) and stands(third)
    assert stands(first) and not stands(third) and first.count() == 3
    session.release(first)


def test_items_of_one_id_are_told_apart(spark):
    one, two = text("one", 40), text("two", 44)
    items = spark.createDataFrame([(7, one), (7, two), (None, text("none", 30)), (7, one)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"{text('a', 9)} {one}"), (2, f"{two} {text('b', 9)}"), (3, f"{one} {two}"), (4, text("none", 30))], "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["item_id"], r["start"], r["similarity"]) for r in decontaminate.leaks(docs, items).collect())
    assert found == [(1, 7, 9, 1.0), (2, 7, 0, 1.0), (3, 7, 0, 1.0), (3, 7, 40, 1.0), (4, None, 0, 1.0)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7), (50, 51), (51, 50)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[100], found[101], found[103]} == {100}
    assert found[50] == found[51] == 50
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_packing_plan():
    draw = random.Random(3)
    for _ in range(200):
        capacity = draw.choice([10, 30, 100])
        counts = {draw.randint(1, capacity): draw.randint(1, 40) for _ in range(draw.randint(1, 25))}
        used = {}
        for times, content in packing.plan(counts, capacity):
            assert times > 0 and sum(content) <= capacity
            for length in content:
                used[length] = used.get(length, 0) + times
        assert used == counts
    assert packing.plan({}) == []
    # Perfect pairs are fixed, and a piece that fits with nothing stands alone.
    fixed = packing.reduced(packing.Lengths({7: 3, 3: 2, 10: 1}), 10)
    assert (1, (10,)) in fixed and (2, (7, 3)) in fixed
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_sequences_hold_the_documents(odd_docs, empty_docs):
    made = packing.sequences(odd_docs, queries.tokenizer_file(), 64).collect()
    assert all(len(r["ids"]) == 4 * r["length"] <= 256 for r in made)
    whole = packing.pieces(odd_docs, queries.tokenizer_file(), 64).agg(F.sum("length")).first()[0]
    assert sum(r["length"] for r in made) == whole
    assert packing.packed_pieces(empty_docs, queries.tokenizer_file()).collect() == []


def test_token_ids_of_odd_spaces():
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    from fleetloom.llm.tokens import TokenIds

    texts = ["a  b", " a", "a ", "a\n b", "a 's b", "é  x  y", "1 2 3..  !", "a\x1c b", "", "\n", " ", "x <|endoftext|> y", "<|endoftext|><|endoftext|>a", "  <|endoftext|>  <|endoftext", None, "ab cd ab", "a b\n", "\n a"]
    plain = Tokenizer.from_file(queries.tokenizer_file())
    for some in (texts, [*texts, "a\u00a0 b"]):
        ids, bounds = TokenIds(queries.tokenizer_file()).of(pa.array(some), 0, len(some))
        for i, t in enumerate(some):
            assert np.array_equal(ids[bounds[i] : bounds[i + 1]], plain.encode(t or "", add_special_tokens=False).ids)


def test_quality_of_odd_rows(odd_docs, empty_docs, clashing):
    judged = quality_votes.judged(odd_docs)
    assert judged.count() == odd_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in judged.where("n_words < 20").collect())
    assert quality_votes.judged(empty_docs).collect() == []
    assert quality_votes.kept_documents(clashing).columns == clashing.columns


def test_votes_find_the_bad_ones(spark):
    """Nobody says which rules are right; documents with faults that go together are found."""
    good = [(i, "The " + text(("g", i), 80) + " and to of in it is.") for i in range(60)]
    symbols = [(100 + i, " ".join(w + "###" for w in text(("s", i), 80).split())) for i in range(12)]
    plain = spark.createDataFrame(good + symbols, "doc_id bigint, text string")
    kept = {r["doc_id"] for r in quality_votes.judged(plain).where("kept").collect()}
    assert kept == {i for i, _ in good}


def test_repeated_windows_are_counted(spark):
    line = text("line", 9)
    frame = spark.createDataFrame([(1, f"{line}\n{line}\n{line}"), (2, " ".join(["w"] * 12)), (3, line)], "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_repeat_words"], r["n_dup_lines"]) for r in quality_votes.measured(frame).collect()}
    assert found == {1: (27, 2), 2: (12, 0), 3: (0, 0)}


def test_leaks(spark, odd_docs, empty_docs, clashing):
    item = PASSAGE.split()
    items = spark.createDataFrame([(1, " ".join(item[:40]).upper()), (2, None), (3, "two words"), (4, ""), (1, " ".join(item[:40]).upper()), (5, text("else", 30))], "item_id bigint, text string")
    found = sorted((r["doc_id"], r["item_id"], r["start"], r["similarity"]) for r in decontaminate.leaks(odd_docs, items).collect())
    assert found == [(4, 1, 30, 1.0), (5, 1, 20, 1.0)]
    kept = decontaminate.clean_documents(clashing, items)
    assert kept.columns == clashing.columns and kept.count() == clashing.count() - 2
    assert decontaminate.leaks(empty_docs, items).collect() == []
    assert decontaminate.leaks(odd_docs, items.limit(0)).collect() == []


def test_a_changed_passage_is_found(spark):
    item = text("item", 59).split()
    near, far = list(item), list(item)
    near[30] = "changed"
    far[10] = far[30] = far[50] = "changed"
    docs = spark.createDataFrame([(1, "- ".join(["x", *near, "y"])), (2, " ".join(far))], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    assert [(r["doc_id"], r["start"]) for r in decontaminate.leaks(docs, items).collect()] == [(1, 1)]


def test_short_items_are_found(spark):
    copies = {n: text(f"short{n}", n) for n in range(1, 9)}
    last = "z" * 100
    items = [(n, t.upper()) for n, t in copies.items()] + [(9, f"a b c d e {last}"), (10, ""), (11, text("nowhere", 5)), (12, text("item", 40))]
    docs = [(n, f"{text(n, 4)} {t}, {text(-n, 3)}") for n, t in copies.items()] + [(9, f"x y other b c d e {last}"), (10, copies[5]), (11, "other"), (12, copies[6].rsplit(" ", 1)[0]), (13, "")]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    expected = {(n, n): (4, 1.0) for n in copies} | {(10, 5): (0, 1.0), (9, 9): (2, (8 + 100) / (8 + 100 + 9 + 13))}
    assert {(r["doc_id"], r["item_id"]): (r["start"], pytest.approx(r["similarity"])) for r in found} == expected
    assert len(found) == len(expected)


def test_copies_with_words_put_in_or_left_out_are_found(spark):
    draw = random.Random(46)
    item, around = (["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)] for n in (46, 40))
    near = {1: item[:20] + ["other"] + item[20:], 2: item[:20] + item[21:], 3: item[:30] + ["other"] + item[30:], 4: item[:30] + item[31:]}
    docs = [(i, " ".join(around[:20] + words + around[20:])) for i, words in near.items()] + [(5, " ".join(item[:20] + ["other"] * 6 + item[20:]))]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")).collect()
    similar = {1: 38 / 47, 2: 37 / 46, 3: 38 / 47, 4: 37 / 46}
    assert {r["doc_id"]: (r["start"], r["similarity"]) for r in found} == {i: (20, pytest.approx(v)) for i, v in similar.items()}


def test_majority_of_bits(spark):
    draw = random.Random(5)
    values = [draw.getrandbits(64) - (1 << 63) for _ in range(63)]
    frame = spark.createDataFrame([(values,)], "h array<bigint>").select(*[F.get("h", F.lit(i)).alias(f"x{i}") for i in range(63)])
    for n in decontaminate.SIZES:
        found = decontaminate._majority(frame, [f"x{i}" for i in range(n)], "f").first()["f"]
        expected = sum(1 << bit for bit in range(64) if 2 * sum(v >> bit & 1 for v in values[:n]) > n)
        assert found & ((1 << 64) - 1) == expected


def test_backoff_scores(spark, odd_docs, empty_docs):
    import math

    frame = spark.createDataFrame([(1, "A b a b c"), (2, "a b"), (2, "a b"), (None, "c"), (3, None)], "doc_id bigint, text string")
    found = sorted(((r["doc_id"] or 0, r["n_words"], round(r["score"], 9)) for r in backoff.scored(frame).collect()))
    total, a, b, c = 10, 4, 4, 2
    one = math.log10(a / total) + math.log10(4 / a) + math.log10(0.4 * a / total) + math.log10(4 / a) + math.log10(0.4 * c / total)
    two = math.log10(a / total) + math.log10(4 / a)
    assert b == a
    assert found == [(0, 1, round(math.log10(c / total), 9)), (1, 5, round(one, 9)), (2, 2, round(two, 9)), (2, 2, round(two, 9)), (3, 0, 0.0)]
    assert backoff.scored(empty_docs).collect() == []
    assert backoff.scored(odd_docs).count() == odd_docs.count()


def test_backoff_keeps_the_pairs_of_one_part(spark, monkeypatch):
    """When the gains of pairs are made, no other part's counted pairs stand on disk."""
    pairs, standing, made = [], [], {}

    def watched(frame, label):
        table = session.scratch_table(frame, label)
        made[label] = made.get(label, 0) + table.count()
        if label == "pairs":
            pairs.append(table._scratch_path)
        if label == "gains":
            standing.append(sum(session.path_exists(spark, path) for path in pairs))
        return table

    monkeypatch.setattr(backoff, "scratch_table", watched)
    frame = spark.createDataFrame([(i, text(i % 7, 50)) for i in range(21)], "doc_id bigint, text string")
    assert backoff.scored(frame).count() == 21
    assert standing == [1] * backoff.PARTS
    assert made["gains"] == made["pairs"] > 7 * 40


@pytest.mark.parametrize(("frequent", "parts", "slice_bytes"), [(0, 1, 1 << 20), (10, 4, 2_000)])
def test_backoff_counts_every_word_in_its_own_right(spark, monkeypatch, frequent, parts, slice_bytes):
    """With no or few frequent words, in few or many slices and parts, against BACKOFF_SQL."""
    import duckdb

    for name, value in (("SLICE_BYTES", slice_bytes), ("FREQUENT", frequent), ("PARTS", parts)):
        monkeypatch.setattr(backoff, name, value)
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    clashing = frame.selectExpr("*", "1 AS word", "2 AS score", "3 AS n_words", "4 AS pair", "5 AS copies", "6 AS _text")
    found = {r["doc_id"]: (r["n_words"], r["score"]) for r in backoff.scored(clashing).collect()}
    with duckdb.connect() as db:
        db.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
        expected = {r[0]: (r[1], r[2]) for r in db.execute(queries.BACKOFF_SQL).fetchall()}
    assert found.keys() == expected.keys()
    for doc_id, (n_words, score) in expected.items():
        assert found[doc_id] == (n_words, pytest.approx(score, abs=1e-3))


def test_language_of_odd_rows(odd_docs, empty_docs):
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identified(odd_docs).collect()}
    assert found[7] == found[6] == found[8] == ("und", 0.0)
    assert found[1][0] in ("en", "fr")
    assert language.identified(empty_docs).collect() == []


def test_language_without_anything_to_learn(odd_docs):
    found = language.identified(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in found.collect()} == {("und", 0.0)}


def test_weights_are_sparse_and_scores_calibrated(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 3 = 0")
    model = language.trained(frame.select("text", "lang", F.xxhash64("doc_id").alias("_place")))
    assert set(model.languages) == {"de", "en", "es", "fr"}
    assert (model.weights == 0).mean() > 0.8 and 0.05 <= model.temperature <= 20


PAGE = """<html><head><title>x</title><style>p{}</style></head><body>A  b<p>Para &amp; one<br>two<p>three <b>bold</b>text
<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>three</ul>
<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td colspan=2>wide cell here</table><div hidden>no</div>
<div style="display: none">no</div><span style='visibility:hidden'>no</span><pre>a  b
  c</pre>end <script>var t="</p>";</script>tail<!-- c --><details><summary>S</summary>no</details><template>no</template>"""
SEEN = """A b

Para & one
two

three boldtext

- one
- two
  3. x
  4. y
- three

Name            Qty
apple           10
wide cell here

a  b
  c

end tail
S"""


def test_layout():
    assert layout.visible_text(PAGE) == SEEN
    assert layout.visible_text("a < b and <3 <p class=\"x>y\">z</p>") == "a < b and <3\n\nz"
    assert layout.visible_text("") == layout.visible_text("<p>") == layout.visible_text("<!-- x") == ""
    assert layout.visible_text("<div>" * 5000 + "x") == "x"
    assert layout.visible_text("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>") == "a  b\n   c"
    assert layout.visible_text("<textarea>a <b></textarea><p>x</div>y") == "a <b>\n\nxy"


def test_a_head_ends_without_its_end_tag(spark):
    for page, seen in {
        "<html><head><title>T</title><body><p>Hello</body></html>": "Hello",
        "<head><meta charset=utf-8><p>Hello": "Hello",
        "<head><link rel=x>\n Hello": "Hello",
        "<head><style>a</style><script>b</script><template><p>c</template>&nbsp;Hello": "\u00a0Hello",
        "<head></head><head>Hello": "Hello",
        "<p>Hello<head>there": "Hellothere",
    }.items():
        assert layout.visible_text(page) == seen
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect() if r["html"]]
    cut = [p for p in pages if "</head>" in p]
    assert cut
    for page in cut:
        assert layout.visible_text(page.replace("</head>", "")) == layout.visible_text(page) != ""


def test_drawings_and_formulas_end():
    for page, seen in {
        "<p><svg/>a</p>b": "a\n\nb",
        "<div><math />a</div>": "a",
        "<div><svg a='x=y/'/>a</div>": "a",
        "<div><svg a=x/>a</svg>b</div>": "b",
        "<svg><title/><path d='x'/><style/></svg>a": "a",
        "<svg><title>x</svg>a": "a",
        "<div><svg><g><p>a</div>b": "a\n\nb",
        "<svg><foreignObject><p>x</foreignObject></svg>a": "a",
        "<div/>a": "a",
    }.items():
        assert layout.visible_text(page) == seen


def test_nothing_in_a_table_is_lost():
    for page, seen in {
        "<table><form><tr><td>A</td></tr></form></table>": "A",
        "<form><table><form><tr><td>A</td></form><td>B</table></form>c": "A  B\n\nc",
        "<table><center><tr><td>A</td><td>B</td></tr></center><tr><td>C</table>": "A  B\nC",
        "<table><tr><form><td>A</td><td>B</td></form></tr></table>": "A  B",
        "<table>x<tr>y<td>A</td>z</tr></table>": "xyz\n\nA",
        "<table><tbody><tr><td>A</td></tr><p>p<p>q</tbody></table>": "p\n\nq\n\nA",
        "<table><tr><a href=u>k</a><td>A</td><div>d</div></tr></table>e": "k\nd\n\nA\n\ne",
        "<div>o<table><tr><td>A</div><td>B</tr></table></div>": "o\n\nA  B",
        "<ul><li>o<table><tr><td>A<li>m<td>B</table></ul>": "- o\n\n  A - m  B",
        "<table><tr><td><table><form><tr><td>i</table></td><td>B</table>": "i  B",
        "<table><tr><td>A</table><table><tr><td>B<caption>c</table>": "A\n\nc\nB",
        "<table><table><tr><td>A</table>": "A",
        "<table><colgroup><col>x<tr><td>A</table>": "x\n\nA",
        "<table><svg><text>no</text></svg><tr><td>A</table>": "A",
        "<div><tr><td>A</td>x</tr></div>": "Ax",
        "<table><caption><p>c</p></caption><tr><td><p>A</td></tr></table>": "c\nA",
    }.items():
        assert layout.visible_text(page) == seen, page


def test_words_in_tables_come_out_wherever_they_stand():
    """Random nests of table parts and other elements: every word comes out once."""
    draw = random.Random(8)
    names = "table tbody tr td th caption form center div p a b ul li font".split()
    for _ in range(3000):
        n, page = 0, "<table>"
        for _ in range(draw.randint(1, 25)):
            name = draw.choice(names)
            page += draw.choice((f"<{name}>", f"<{name}>", f"</{name}>", f" w{n} "))
            if page.endswith(f" w{n} "):
                n += 1
        seen = layout.visible_text(page)
        found = sorted(w for w in seen.split() if w.startswith("w"))
        assert found == sorted(f"w{i}" for i in range(n)), page


def test_hostile_pages_end_soon():
    """Deep, unclosed and spread-out markup: linear time, no recursion, bounded output."""
    started = time.monotonic()
    for name in ("div", "b", "p", "li", "ul", "table", "td", "tr", "svg", "form", "option", "dl"):
        layout.visible_text(f"<{name}>x" * 50_000)
        layout.visible_text(f"<{name}>x" * 25_000 + f"</{name}>" * 25_000)
    assert layout.visible_text("<table><tr><td>" * 10_000 + "x") == "x"
    assert len(layout.visible_text("<table>" + "<tr><td colspan=100 rowspan=1000>x" * 20_000)) < 10_000_000
    assert len(layout.visible_text("<table><tr><td>" + "w" * 100_000 + "<td>x" + "<tr><td>a<td>b" * 20_000)) < 500_000
    assert layout.visible_text("a " + "<a " * 100_000) == "a" and layout.visible_text("a" + "<!" * 100_000) == "a"
    assert layout.visible_text("&#" + "1" * 6000 + ";&#0000065;&#x41;") == "\ufffdAA"
    assert time.monotonic() - started < 240


def test_comments_tags_and_visibility():
    seen = {
        "a<!-->b": "ab",
        "a<!--->b<!-- x --!>c": "abc",
        "a<!-- x": "a",
        '<a href="x"">t</a> u': "t u",
        "<p style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</p>d": "b\n\nd",
        "<ol reversed><li>a<li>b<li value=9>c<li>d</ol>": "4. a\n3. b\n9. c\n8. d",
        "<ol start=0><li>a<li value=5>b<li>c</ol>": "0. a\n5. b\n6. c",
        "<table><tr><td>a<table><tr><td>b<td>c</table>d<td>e</table>": "a b c d  e",
    }
    for page, text_seen in seen.items():
        assert layout.visible_text(page) == text_seen, page


def test_pages_of_every_kind(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x"), (2, None, None), (None, "u", ""), (1, "u", "<p>x")], "page_id bigint, url string, html string")
    found = sorted(((r["page_id"] or 0), r["text"]) for r in layout.rendered(pages).collect())
    assert found == [(0, ""), (1, "x"), (1, "x"), (2, "")]
    assert layout.rendered(pages.limit(0)).collect() == []


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_chat_examples(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u\\<|x"), (1, 2, "assistant", "a<|im_end|>\n"), (1, 3, "assistant", ""), (1, 4, "user", None), (2, 0, None, "q"), (None, None, "as\nsistant", "x\\")]
    made = chat.examples(spark.createDataFrame(rows, TURNS).repartition(3))
    found = sorted(((r["conv_id"] or 0), r["example"], r["n_turns"], r["loss_chars"]) for r in made.collect())
    assert found == [(0, 0, 1, None), (1, 0, 3, 13), (1, 1, 4, 0), (1, 2, 5, None), (2, 0, 1, None)]
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [(r, t or "") for _, _, r, t in rows[:5]]
    assert back[1]["replies"] == ["a<|im_end|>\n", ""] and [tuple(t) for t in back[None]["turns"]] == [("as\nsistant", "x\\")]
    for r in made.collect():
        assert r["text"].count("<|im_start|>") == r["n_turns"] == r["text"].count("<|im_end|>")
    assert chat.digest(spark.createDataFrame([], TURNS)).collect() == []


def test_rows_without_a_conversation_stay_apart(spark):
    rows = [(None, i % 3, "assistant" if i % 2 else "user", f"t{i % 5}") for i in range(200)] + [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS parts", "2 AS example", "3 AS turns", "4 AS target")
    found = chat.digest(frame).collect()
    assert len(found) == 201
    alone = [r for r in found if r["conv_id"] is None]
    assert all(r["n_turns"] == 1 for r in alone) and sum(r["loss_chars"] for r in alone) == 200


def test_long_turns_are_formatted_whole(spark):
    long = "x\\<|" * 100_000
    back = chat.read_back(chat.examples(spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", long)], TURNS))).first()
    assert back["replies"] == [long]


def test_ties_and_repeated_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (1, 0, "user", "a")]
    back = chat.read_back(chat.examples(spark.createDataFrame(rows, TURNS))).first()
    assert [tuple(t) for t in back["turns"]] == [("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")]


def test_urls(spark):
    urls = ["HTTP://A.Example.ORG/es/x?q", "http://example.org", "x://notorg/", "http://org/en", None, "nothing", "http://b.com/fr/1#f", "http://com/de/", "http://é.COM/de"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_graph.judged(pages, queries.URL_RULES).collect()}
    assert found[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[1] == ("example.org", "", None, "allow") and found[2] == ("notorg", "/", None, "allow")
    assert found[3] == ("org", "/en", "org/", "allow") and found[4] == found[5] == ("", "", None, "allow")
    assert found[6][2:] == ("com/fr/", "allow") and found[7][2:] == ("com/de/", "block") and found[8] == ("é.com", "/de", None, "allow")


def test_trust_and_distrust_follow_links(spark):
    def page(i, host, *links):
        return i, f"http://{host}/x", "".join(f"<a href='http://{x}/'>" for x in links)

    rows = [page(1, "good.org", "fine.net", "fine.net"), page(2, "bad.com", "else.net"), page(3, "farm.net", "bad.com"), page(4, "fine.net"), page(5, "else.net", "good.org"), page(6, "alone.net")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    judged = {r["host"]: r for r in url_graph.judged(pages, [("org/", "allow"), ("com/", "block")]).collect()}
    assert {h for h, r in judged.items() if r["verdict"] == "block"} == {"bad.com", "farm.net"}
    assert judged["fine.net"]["trust"] > 0 == judged["alone.net"]["trust"] and judged["farm.net"]["distrust"] > 0
    assert sum(r["trust"] for r in judged.values()) == pytest.approx(1)
    assert url_graph.judged(pages.limit(0), queries.URL_RULES).collect() == []


def test_far_hosts_get_no_more_than_their_share(spark):
    """A chain of hosts, of which the last is blocked: distrust falls with each link, however long the chain."""
    n = 26
    rows = [(i, f"http://h{i}.net/x", f"<a href='http://h{i + 1}.net/'>" if i + 1 < n else "<a href='http://bad.com/'>") for i in range(n)] + [(n, "http://bad.com/", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "2 AS score", "3 AS kind", "4 AS verdict")
    judged = {r["host"]: r for r in url_graph.judged(pages, [("com/", "block")]).collect()}
    exact = {f"h{i}.net": 0.15 * 0.85 ** (n - i) for i in range(n)} | {"bad.com": 0.15}
    whole = sum(exact.values())
    for host, x in exact.items():
        assert judged[host]["distrust"] == pytest.approx(x / whole, abs=1e-7)
        assert judged[host]["verdict"] == ("block" if host == "bad.com" or x / whole > 1 / (n + 1) else "allow")


def test_packing_is_as_good_as_can_be_on_small_instances():
    """The dominance steps lose no sequence against the best of all partitions."""

    def best(lengths, capacity):
        found = len(lengths)
        bins = []

        def put(i):
            nonlocal found
            if len(bins) >= found:
                return
            if i == len(lengths):
                found = len(bins)
                return
            for k in {b: j for j, b in enumerate(bins)}.values():
                if bins[k] + lengths[i] <= capacity:
                    bins[k] += lengths[i]
                    put(i + 1)
                    bins[k] -= lengths[i]
            bins.append(lengths[i])
            put(i + 1)
            bins.pop()

        put(0)
        return found

    draw = random.Random(9)
    for _ in range(60):
        capacity = draw.choice([10, 17, 30])
        lengths = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 10))), reverse=True)
        counts = {n: lengths.count(n) for n in set(lengths)}
        fixed = packing.reduced(packing.Lengths(dict(counts)), capacity)
        taken = sum(times for times, _ in fixed)
        left = [n for n in lengths]
        for times, content in fixed:
            for n in content:
                for _ in range(times):
                    left.remove(n)
        # What dominates can be fixed: with the best partition of the rest it is a best one of all.
        assert taken + best(left, capacity) == best(lengths, capacity)
        whole = sum(times for times, _ in packing.plan(counts, capacity))
        assert best(lengths, capacity) <= whole <= best(lengths, capacity) + 1


def test_tokens_of_many_pieces_take_little_memory(spark, tmp_path):
    """Texts of many different pieces, more than a worker remembers, have the tokenizer's own ids."""
    from tokenizers import Tokenizer

    from fleetloom.llm import tokens
    from fleetloom.llm.queries import tokenizer_file

    draw = random.Random(8)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=9)) for _ in range(30_000)) for _ in range(8)]
    encoder = tokens.TokenIds(tokenizer_file())
    column = pa.array(texts)
    most, parts = 0, []
    for first, last in words.slices(column, tokens.BATCH_BYTES):
        ids, bounds = encoder.of(column, first, last)
        parts += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        most = max(most, len(encoder.keys))
    assert most <= 200_000
    own = Tokenizer.from_file(tokenizer_file())
    assert parts == [own.encode(t, add_special_tokens=False).ids for t in texts]
