"""Documents that hold a passage of a benchmark, by SimHash windows as long as its items ask.

An item is cut into windows, at every word, of 7, 15, 31 or 63 words: the largest number
that is at most half of its words. Texts are cut alike. A window's SimHash has in each of
64 bits what most of its words' hashes have there. For such odd lengths that majority is
the last carry of adders that work on all bits at once, so it takes a few operations a
word. Fingerprints are compared by blocks: two that differ in at most RADIUS bits agree in
one of RADIUS + 1 blocks, so a join on blocks finds every such pair. Each candidate places
the item in the text, and the weighted Jaccard similarity of the item's shingles and of
those found there, exact, decides.

A copy that reaches the similarity has a stretch of half its words unchanged, so its
windows there are equal to the item's. Words put in or left out shift the rest, so not only
as many words as the item has are compared, but also all between the first and the last of
its shingles nearby where the former are not similar. Items of fewer than seven words have windows of up
to WIDTH words, as long as their shingles, and a hash of the whole window: whatever has
anything in common with such an item has a window equal to one of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.rows import packed, unpacked, without
from fleetloom.session import scratch_scope, scratch_table

SIZES = (7, 15, 31, 63)
RADIUS = 3
WIDTH = 5
SIMILAR = 0.8
# The items' fingerprints are sent to all tasks up to this many rows; more are shuffled.
BROADCAST_ROWS = 2_000_000
BLOCK_BITS = 64 // (RADIUS + 1)


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _majority(rows: DataFrame, inputs: Sequence[str], name: str) -> DataFrame:
    """``name``: the bits that most of ``inputs`` have, whose number is 2**k - 1.

    Three values of one weight add to a sum of that weight and a carry of the next; the
    one value of the highest weight that is left at the end is the majority.
    """
    made = 0
    level = list(inputs)
    while len(level) > 1:
        carries: list[str] = []
        while len(level) > 1:
            threes = [level[i : i + 3] for i in range(0, len(level) - 2, 3)]
            level = level[3 * len(threes) :]
            added = {}
            for a, b, c in threes:
                total, carry = f"{name}_s{made}", f"{name}_c{made}"
                added[total] = F.expr(f"{a} ^ {b} ^ {c}")
                added[carry] = F.expr(f"({a} & {b}) | ({c} & ({a} ^ {b}))")
                level.append(total)
                carries.append(carry)
                made += 1
            rows = rows.withColumns(added)
        level = carries
    return rows.withColumn(name, F.col(level[0]))


def fingerprints(rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``rows`` (words: array<string>) with a row per word ``at``, and ``f7``, ``f15``, ...:
    the SimHash of the window of so many words that begins there, null where it does not fit.
    That of at most WIDTH words is a hash of the whole window."""
    kept = rows.columns
    hashed = rows.withColumn("_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    at = F.explode(F.sequence(F.lit(0), F.size("words") - min(sizes)))
    out = hashed.where(F.size("words") >= min(sizes)).select("*", at.alias("at"))
    out = out.select(*kept, "at", *[F.get("_hashes", F.col("at") + i).alias(f"_x{i}") for i in range(max(sizes))])
    for n in sizes:
        if n <= WIDTH:
            out = out.withColumn(f"f{n}", F.when(F.col(f"_x{n - 1}").isNotNull(), F.xxhash64(*[f"_x{i}" for i in range(n)])))
        else:
            out = _majority(out, [f"_x{i}" for i in range(n)], f"f{n}")
    return out.select(*kept, "at", *[f"f{n}" for n in sizes])


def _blocks(rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """A row per fingerprint and block: ``size``, ``print``, ``block``, and ``key``, equal where blocks are."""
    each = RADIUS + 1
    numbered = rows.withColumn("_n", F.explode(F.array(*[F.lit(i) for i in range(len(sizes) * each)])))
    chosen = F.coalesce(*[F.when(F.expr(f"_n div {each} = {i}"), F.col(f"f{n}")) for i, n in enumerate(sizes)])
    out = numbered.withColumn("print", chosen).withColumn("block", F.expr(f"_n % {each}")).where("print is not null")
    size = F.element_at(F.array(*map(F.lit, sizes)), F.expr(f"int(_n div {each}) + 1"))
    key = F.expr(f"(shiftrightunsigned(print, block * {BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1}L) | shiftleft(CAST(_n AS BIGINT), {BLOCK_BITS})")
    # Windows of at most WIDTH words are equal or not, and one block tells.
    return out.withColumn("size", size).where(f"size > {WIDTH} or block = 0").withColumn("key", key).drop("_n", *[f"f{n}" for n in sizes])


def shingles(found: Column) -> Column:
    """The distinct runs of WIDTH words; all words as one where there are fewer."""
    several = F.transform(F.sequence(F.lit(1), F.size(found) - WIDTH + 1), lambda i: F.concat_ws(" ", F.slice(found, i, WIDTH)))
    return F.when(F.size(found) >= WIDTH, F.array_distinct(several)).otherwise(F.array(F.concat_ws(" ", found)))


def weight(of: Column) -> Column:
    """A shingle weighs as much as it has characters: long words are rare ones."""
    return F.aggregate(of, F.lit(0), lambda total, s: total + F.length(s))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, _text (``xxhash64(text)``), item_id, start (in words), similarity of every passage found.

    Items without any word are never found. Repeated items and rows count once; items of
    one item_id but different words are told apart, and each is found for itself. A null
    doc_id or item_id is kept as it is. Up to ``BROADCAST_ROWS`` fingerprints of items are
    sent to all tasks; more are shuffled to the texts' ones, without the texts, whose
    words are fetched for the candidates alone.
    """
    items = benchmark.select(F.col("item_id").alias("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0).dropDuplicates()
    items = items.withColumn("_item_key", F.xxhash64("item_id", F.concat_ws(" ", "words")))
    length = F.size("words")
    fitting = F.coalesce(*[F.when(length >= 2 * n, n) for n in reversed(SIZES)], F.when(length >= SIZES[0], SIZES[0]), F.least(length, F.lit(WIDTH)))
    items = scratch_table(items.select("item_id", "_item_key", "words", length.alias("length"), fitting.alias("fit")), "items")
    sizes = sorted(r["fit"] for r in items.select("fit").distinct().collect()) or [SIZES[0]]
    cut = _blocks(fingerprints(items.drop("item_id"), sizes), sizes).where("size = fit")
    marks = scratch_table(cut.select("key", F.col("print").alias("_mark"), "_item_key", F.col("at").alias("_offset"), "length"), "item-blocks")
    known = items.select("_item_key", "item_id", shingles(F.col("words")).alias("_item")).withColumn("_weight", weight(F.col("_item")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("_text"), words_of(F.col("text")).alias("words"))
    near = F.expr(f"bit_count(print ^ _mark) <= {RADIUS}")
    # An equal block before this one has found the pair already.
    mask = (1 << BLOCK_BITS) - 1
    before = F.expr(" and ".join(f"(block <= {i} or ((shiftrightunsigned(print ^ _mark, {i * BLOCK_BITS}) & {mask}L) <> 0))" for i in range(RADIUS)))
    windows = _blocks(fingerprints(rows, sizes), sizes)
    begin = (F.col("at") - F.col("_offset")).alias("_begin")
    if marks.count() <= BROADCAST_ROWS:
        met = windows.join(F.broadcast(marks), (windows["key"] == marks["key"]) & near & before).select("doc_id", "_text", "_item_key", begin, "length", "words")
    else:
        bare = scratch_table(windows.drop("words"), "text-blocks")
        met = bare.join(marks, (bare["key"] == marks["key"]) & near & before).select("doc_id", "_text", "_item_key", begin, "length").distinct()
        met = scratch_table(met, "candidates")
        wanted, texts = met.select("doc_id", "_text").distinct(), rows.select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t"), "words")
        same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t"))
        found = texts.join(wanted, same, "left_semi").dropDuplicates(["_d", "_t"])
        met = met.join(scratch_table(found, "candidate-texts"), same).drop("_d", "_t")
    # A passage that reaches the similarity is longer than its item by a quarter at most.
    reach = F.floor(F.col("length") / 4).cast("int")
    begin = F.col("_begin")
    start, low = F.greatest(begin, F.lit(0)), F.greatest(begin - reach, F.lit(0))
    placed = met.select(
        "doc_id", "_text", "_item_key", "_begin", low.alias("_low"), F.slice("words", low + 1, begin + F.col("length") + reach - low).alias("_near"),
        (start - low).alias("_skip"), (begin + F.col("length") - start).alias("_long"),
    )
    placed = placed.dropDuplicates(["doc_id", "_text", "_item_key", "_begin"])
    compared = placed.join(known, "_item_key")
    here = F.transform(F.sequence(F.lit(1), F.size("_near") - WIDTH + 1), lambda i: F.when(F.array_contains("_item", F.concat_ws(" ", F.slice("_near", i, WIDTH))), i))
    compared = compared.withColumn("_hits", F.when(F.size("_near") >= WIDTH, here))
    first, last = F.array_min("_hits"), F.array_max("_hits")
    # As many words as the item has, and all from the first to the last shingle of it.
    spans = F.array(
        F.struct((F.col("_low") + F.col("_skip")).alias("start"), F.slice("_near", F.col("_skip") + 1, F.col("_long")).alias("words")),
        F.struct((F.col("_low") + first - 1).alias("start"), F.slice("_near", first, last - first + WIDTH).alias("words")),
    )
    compared = compared.select("doc_id", "_text", "_item_key", "item_id", "_item", "_weight", F.posexplode(spans).alias("_which", "_span")).where("_span.words is not null")
    compared = compared.withColumn("start", F.col("_span.start")).withColumn("_found", shingles(F.col("_span.words")))
    common = weight(F.array_intersect("_found", "_item"))
    similarity = common / (weight(F.col("_found")) + F.col("_weight") - common)
    return (
        compared.withColumn("similarity", similarity)
        .where(F.col("similarity") >= SIMILAR)
        .groupBy("doc_id", "_text", "_item_key", "item_id")
        # The other span counts where none of the item's length is similar.
        .agg(F.max_by(F.struct("start", "similarity"), F.struct(-F.col("_which"), "similarity")).alias("_best"))
        .select("doc_id", "_text", "item_id", "_best.start", "_best.similarity")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any passage of the benchmark, with all their columns."""
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), _text=F.xxhash64("text"))
    with scratch_scope(docs.sparkSession) as scope:
        return unpacked(without(rows, leaks(docs, benchmark), scope), docs)
