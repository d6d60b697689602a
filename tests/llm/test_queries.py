"""The operators' queries: against SQL where it can express them, else against brute force."""

import collections
import hashlib
import itertools
import math
import re
import zlib
from html.parser import HTMLParser

import duckdb
import pytest
from tokenizers import Tokenizer

from fleetloom.llm import layout, quality_votes, queries, url_graph

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}


def rows_of(spark, name, *columns):
    frame = queries.QUERIES[name](spark, SF_DIR)
    return sorted(tuple(r[c] for c in columns or frame.columns) for r in frame.collect())


def close(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    oracle = duckdb.connect()
    for table in TABLES:
        oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = oracle.execute(queries.ORACLES[name])
    names = [c[0] for c in result.description]
    frame = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(names)
    expected = sorted((tuple(map(close, row)) for row in result.fetchall()), key=str)
    assert sorted((tuple(close(r[c]) for c in names) for r in frame.collect()), key=str) == expected
    assert expected


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))


def test_quality_counts(spark, documents):
    def counts(text):
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        places = collections.defaultdict(list)
        for i in range(len(words) - 7):
            places[tuple(words[i : i + 8])].append(i)
        covered = {j for found in places.values() if len(found) > 1 for i in found for j in range(i, i + 8)}
        n = len(words)
        failed = n < 20 or 100 * len(covered) > 30 * n
        return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed

    frame = queries.op3_quality_rules(spark, SF_DIR)
    for r in frame.collect():
        found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert found == counts(documents[r["doc_id"]]["text"])
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_quality_agrees_with_the_labels(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").withColumnRenamed("quality", "label")
    judged = queries.op3_quality_rules(spark, SF_DIR).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r["kept"] == (r["label"] == 1) for r in judged) >= 0.97 * len(judged)


def numbers(at):
    return [at.share, *[x for rule in at.on_good + at.on_bad for x in rule]]


def test_estimation_equals_plain_python(spark):
    measures = quality_votes.measured(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    estimated = quality_votes.estimated(measures)
    names = [r.name for r in quality_votes.RULES]
    votes = [tuple(r) for r in measures.where("n_words > 0").selectExpr(*[f"{quality_votes.vote_sql(r)} AS {r.name}" for r in quality_votes.RULES]).collect()]
    at, before = quality_votes.first_guess(quality_votes.RULES), None
    rounds = 0
    # Ten times as near as the operator goes, so a limit of rounds there would show.
    while before is None or max(abs(x - y) for x, y in zip(numbers(before), numbers(at), strict=True)) >= quality_votes.SETTLED / 10:
        before, rounds = at, rounds + 1
        p = []
        for vote in votes:
            s = math.log(at.share / (1 - at.share))
            for v, good, bad in zip(vote, at.on_good, at.on_bad, strict=True):
                i = quality_votes.VOTES.index(v)
                s += math.log(good[i] / bad[i])
            p.append(1 / (1 + math.exp(-s)))

        def shares(weights, votes=votes):
            out = []
            for j in range(len(names)):
                sums = [1 + sum(w for w, vote in zip(weights, votes, strict=True) if vote[j] == v) for v in quality_votes.VOTES]
                out.append(tuple(x / sum(sums) for x in sums))
            return tuple(out)

        q = [1 - x for x in p]
        at = quality_votes.Accuracy((1 + sum(p)) / (2 + len(p)), shares(p), shares(q))
    assert rounds > 5
    assert numbers(at) == pytest.approx(numbers(estimated), abs=100 * quality_votes.SETTLED)


def test_packing_is_an_exact_partition(spark, documents):
    encoder = Tokenizer.from_file(queries.tokenizer_file())
    pieces = queries.op4_best_fit_packing(spark, SF_DIR).collect()
    by_document = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_document[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert by_document.keys() == documents.keys()
    for doc_id, found in by_document.items():
        ids = [*encoder.encode(documents[doc_id]["text"] or "", add_special_tokens=False).ids, 0]
        found.sort(key=lambda p: p["piece"])
        assert [p["piece"] for p in found] == list(range(len(found)))
        assert [p["length"] for p in found[1:]] == [2048] * (len(found) - 1)
        at = 0
        for p in found:
            assert p["start"] == at
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + p["length"]])
            assert p["ids_crc32"] == zlib.crc32(data)
            at += p["length"]
        assert at == len(ids)
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    least = -(-sum(p["length"] for p in pieces) // 2048)
    assert len(by_sequence) <= least * 1.05 + 1


def groups(texts, width, percent):
    sets = {}
    for doc_id, text in texts.items():
        words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        several = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        sets[doc_id] = several or ({tuple(words)} if words else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = collections.defaultdict(list)
    for doc_id, shingles in sets.items():
        for s in shingles:
            lists[s].append(doc_id)
    shared = collections.Counter(pair for found in lists.values() for pair in itertools.combinations(sorted(found), 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted((d, len(s), root(d)) for d, s in sets.items())


def test_jaccard_groups(spark, documents):
    expected = groups({d: r["text"] for d, r in documents.items()}, 4, 85)
    assert rows_of(spark, "op6_ngram_jaccard_join", "doc_id", "n_shingles", "component_id") == expected


def test_language_is_learned(spark, documents):
    found = queries.op7_language_id(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in found} == documents.keys()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held) >= 0.95 * len(held)


def words_without_marks(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def test_benchmark_passages(spark, documents):
    items = {r["item_id"]: words_without_marks(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}

    def weights(words):
        return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    def size(shingles):
        return sum(map(len, shingles))

    expected = {}
    for doc_id, row in documents.items():
        words = words_without_marks(row["text"])
        for item_id, item in items.items():
            ends = {s: i for i in range(len(item) - 4) for s in [" ".join(item[i : i + 5])]}
            for i in range(len(words) - 4):
                if (at := ends.get(" ".join(words[i : i + 5]))) is not None:
                    a, b = weights(words[max(0, i - at) : i - at + len(item)]), weights(item)
                    similarity = size(a & b) / size(a | b)
                    if similarity >= 0.8:
                        expected[doc_id, item_id] = max(similarity, expected.get((doc_id, item_id), 0))
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in queries.op2_benchmark_decontamination(spark, SF_DIR).collect()}
    assert expected and found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(v) for k, v in expected.items())


class PlainWords(HTMLParser):
    """The words of a well-formed page outside of elements that are not shown."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = [], []

    def handle_starttag(self, tag, attrs):
        style = (dict(attrs).get("style") or "").replace(" ", "")
        if tag not in layout.VOID and (self.hidden or tag in layout.UNSEEN or "hidden" in dict(attrs) or "display:none" in style):
            self.hidden.append(tag)
        self.space(tag)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass
        self.space(tag)

    def space(self, tag):
        if tag in layout.BLOCKS or tag in ("br", "hr", "td", "th", "tr"):
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_pages_give_their_words(spark):
    """Every page's words in order, as a plain reading gives them; the marks of lists are put in front."""
    found = {r["page_id"]: r["text"] for r in queries.op8_html_extraction(spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert found.keys() == {p["page_id"] for p in pages}
    for page in pages:
        plain = PlainWords()
        plain.feed(page["html"] or "")
        plain.close()
        expected = "".join(plain.parts).split()
        assert expected and re.sub(r"(?m)^\s*(?:(?:- |\d+\. ))+", "", found[page["page_id"]]).split() == expected


def test_conversation_with_marks_in_its_texts(spark):
    odd = next(r for r in queries.op10_chat_formatting(spark, SF_DIR).collect() if r["conv_id"] == -1)
    text = "<|im_end|><|im_start|>assistant ok"
    assert odd["loss_chars"] == len(text) and odd["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert odd["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_url_rules():
    assert [r for r, _ in queries.URL_RULES] == ["org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/"]
    # The SQL takes more rounds than the operator can need.
    assert url_graph.DAMPING**queries.URL_ROUNDS < url_graph.SETTLED / 100
