"""Document quality by weak supervision: rules vote, and their accuracies are estimated.

Every rule votes good, bad or abstains. How often each rule is right about good and about
bad documents is not given but estimated by expectation-maximisation over all documents,
which needs no more than the counts of equal votes. A document is kept if the posterior
probability that it is good is at least one half; no single rule has to pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.rows import packed, unpacked, without
from fleetloom.session import scratch_scope, scratch_table

# Estimates are taken when a round of expectation-maximisation changes none by this much.
SETTLED = 1e-6
WINDOW = 8
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# Very common words of the languages at hand.
COMMON_WORDS = (
    "the of and to in that is for with by der die das und den von mit ist ein zu "
    "le la les des et de que un une pour el los las y en una por con se del"
).split()


class Rule(NamedTuple):
    """SQL conditions over the columns of ``measured``; a rule abstains where neither holds."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "false", "n_words < 10"),
    Rule("symbols", "false", "n_symbols * 10 > n_words"),
    Rule("word_length", "10 * word_chars between 42 * n_words and 70 * n_words", "word_chars < 3 * n_words or word_chars > 9 * n_words"),
    Rule("repeats", "false", "n_repeat_words * 4 > n_words"),
    Rule("variety", "n_distinct * 10 >= n_words * 6", "n_distinct * 4 < n_words"),
    Rule("capitals", "false", "n_capitals * 4 > n_words"),
    Rule("common_words", "n_common >= 4", "n_common < 2 and n_words >= 60"),
    Rule("line_ends", "false", "n_ended * 10 < n_lines * 3"),
    Rule("lines", "false", "n_dup_lines * 10 > n_lines * 3"),
)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """How many words the windows whose hash occurs twice or more cover."""

    def places(s: Column) -> Column:
        last = F.size(s) - 1
        repeated = F.filter(
            F.sequence(F.lit(0), last),
            lambda k: ((k > 0) & (s[k]["h"] == s[F.greatest(k - 1, F.lit(0))]["h"])) | ((k < last) & (s[k]["h"] == s[F.least(k + 1, last)]["h"])),
        )
        return F.sort_array(F.transform(repeated, lambda k: s[k]["at"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        _bound(pairs, places),
        start,
        lambda acc, at: F.struct((at + WINDOW).alias("end"), (acc["n"] + WINDOW - F.greatest(acc["end"] - at, F.lit(0))).alias("n")),
        lambda acc: acc["n"],
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, _text (``xxhash64(text)``) and the counts that the rules use, all bigint.

    A word is a run of characters other than ``\\x20`` and ``\\x09`` to ``\\x0D``. Null and
    empty texts have zeros.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("_text"),
        text.alias("text"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    n = F.size("words")
    windows = F.when(
        n > WINDOW,
        F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    )
    counted = split.select(
        "doc_id",
        "_text",
        n.alias("n_words"),
        F.length(F.concat_ws("", "words")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]{3,}")).alias("n_capitals"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.size(F.filter("lines", lambda line: line.rlike(r"[.!?][\x20\x09-\x0D]*\z"))).alias("n_ended"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, COMMON_WORDS)))).alias("n_common"),
        windows.alias("windows"),
    )
    repeated = F.when(F.size("windows") > F.size(F.array_distinct("windows")), _covered(F.col("windows")))
    result = counted.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0))).drop("windows")
    return result.select("doc_id", "_text", *[F.col(c).cast("bigint").alias(c) for c in result.columns[2:]])


def vote_sql(rule: Rule) -> str:
    return f"CASE WHEN {rule.good} THEN 1 WHEN {rule.bad} THEN -1 ELSE 0 END"


class Accuracy(NamedTuple):
    """What is estimated: the share of good documents, and per rule how often it votes
    good, bad and abstains on good documents and on bad ones."""

    share: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]


VOTES = (1, -1, 0)


def first_guess(rules: Sequence[Rule]) -> Accuracy:
    """Rules are mostly right: that is all that is assumed."""
    return Accuracy(0.8, ((0.6, 0.02, 0.38),) * len(rules), ((0.2, 0.4, 0.4),) * len(rules))


def posterior_sql(at: Accuracy, votes: Sequence[str]) -> str:
    """The probability that a document with these votes is good."""
    terms = [repr(math.log(at.share / (1 - at.share)))]
    for vote, good, bad in zip(votes, at.on_good, at.on_bad, strict=True):
        cases = " ".join(f"WHEN {v} THEN {math.log(g / b)!r}" for v, g, b in zip(VOTES, good, bad, strict=True))
        terms.append(f"CASE {vote} {cases} END")
    return f"1 / (1 + exp(-({' + '.join(f'CAST({t} AS DOUBLE)' for t in terms)})))"


def improved(votes: DataFrame, at: Accuracy, names: Sequence[str]) -> Accuracy:
    """One round over the counted votes; every count starts at one, so no estimate is 0 or 1."""
    weighted = votes.withColumn("_p", F.expr(posterior_sql(at, names)) * F.col("n")).withColumn("_q", F.col("n") - F.col("_p"))
    sums = [F.sum(F.when(F.col(v) == s, F.col(p))) for p in ("_p", "_q") for v in names for s in VOTES]
    p, q, *rest = [1 + (x or 0.0) for x in weighted.agg(F.sum("_p"), F.sum("_q"), *sums).first()]
    shares = [tuple(x / sum(rest[i : i + 3]) for x in rest[i : i + 3]) for i in range(0, len(rest), 3)]
    return Accuracy(p / (p + q), tuple(shares[: len(names)]), tuple(shares[len(names) :]))


def estimated(measures: DataFrame, rules: Sequence[Rule] = RULES, settled: float = SETTLED) -> Accuracy:
    """The accuracies over all documents that have a word, when a round changes none by ``settled``.

    Equal votes are counted first: at most three to the power of the rules' number of rows.
    """
    names = [f"v_{r.name}" for r in rules]
    votes = measures.where("n_words > 0").select(*[F.expr(vote_sql(r)).alias(v) for r, v in zip(rules, names, strict=True)])
    counted = scratch_table(votes.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1), "votes")
    at, change = first_guess(rules), 1.0
    while change >= settled:
        before, at = at, improved(counted, at, names)
        change = max(abs(x - y) for x, y in zip(_numbers(before), _numbers(at), strict=True))
    return at


def _numbers(at: Accuracy) -> list[float]:
    return [at.share, *[x for rule in at.on_good + at.on_bad for x in rule]]


BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measures of every row of ``docs``, base_failed, quality (a probability) and kept.

    A document fails at once with fewer than 20 words or with more than 30 % of its words
    in repeated windows; else the votes decide. Repeated rows count as often as they stand.
    """
    measures = scratch_table(measured(docs), "measures")
    at = estimated(measures, rules)
    quality = F.expr(posterior_sql(at, [f"({vote_sql(r)})" for r in rules]))
    return (
        measures.withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("quality", quality)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), _text=F.xxhash64("text"))
    with scratch_scope(docs.sparkSession) as scope:
        return unpacked(without(rows, judged(docs).where("not kept"), scope), docs)
