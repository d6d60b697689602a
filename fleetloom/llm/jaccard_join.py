"""Documents joined by the Jaccard similarity of their word shingles, exactly.

Documents with equal sets are folded into one node. In every set the shingles have one
order: those that many texts share last, then by hash. Two similar sets share a shingle
among the first few of each (as many as may be missing, and one more), and two shingles
among one more. So

* a small set is listed under every pair of its first shingles,
* a large set, and a small one that a large one may resemble, under each of them,

and similar sets meet in a list. The size that divides small from large is the one of
least cost, from the rows both ways make and the pairs the lists of single shingles hold.

A list of m sets gives fewer than m pairs with each of a few of its sets, its hubs, not all
pairs. The hubs are those with the fewest shingles before the list's: of a group of near
copies the ones with least of their own, to which most others are similar. Pairs that prove
similar join their components; after that only pairs of different components are left in a
list, and all of them that its sizes and places allow are compared. No pair of similar sets
stays unjoined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm import words
from fleetloom.llm.components import components
from fleetloom.llm.rows import packed, unpacked, without
from fleetloom.session import forget_shuffles, release, scratch_scope, scratch_table

WIDTH, PERCENT = 4, 85
# Sets above this size are never listed by pairs.
SMALL_MOST = 128
# A shingle found this often in shared blocks of text is ordered last; at most so many are.
COMMON, COMMON_MOST = 64, 100_000
BLOCK_BYTES = 2 << 20
# A set's size and the place of a shingle in it, as one number: size * AT + place.
AT = 1 << 31
# The documents whose sets are compared are sent to all tasks up to this many.
BROADCAST_ROWS = 500_000
# A set's parity: for every value of this many, whether an odd number of shingles has it.
PARITY_BITS = 4096
# Sets whose parities are made together.
PARITY_ROWS = 256
# The hubs of a list: its sets of least place, and of these the least by so many different hashes.
HUBS = 4
# What a pair to compare costs, in rows of a list.
PAIR_COST = 4


def _sets(column: pa.Array, first: int, last: int, width: int):
    """owner, shingle (sorted within an owner, no repeats) and bounds of rows ``first`` to ``last``."""
    texts = words.texts_of(column, first, last, lower=True)
    hashes = texts.word_hashes()
    shingles = words.windows_hash(hashes, width)
    inside = texts.inside(width)
    owner = texts.window_text(width)[inside]
    short = np.flatnonzero((np.diff(texts.bounds) > 0) & (np.diff(texts.bounds) < width))
    whole = words.spans_hash(hashes, texts.bounds[short], texts.bounds[short + 1], words.OTHER_BASE)
    owner, shingles = np.concatenate([owner, short]), np.concatenate([shingles[inside], whole])
    order = np.lexsort((shingles, owner))
    owner, shingles = owner[order], shingles[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])
    owner, shingles = owner[new], shingles[new]
    return owner, shingles, np.searchsorted(owner, np.arange(last - first + 1))


def _node(shingles: np.ndarray, bounds: np.ndarray, base: int) -> np.ndarray:
    return words.signed(words.spans_hash(shingles, bounds[:-1], bounds[1:], base))


def _describe(width: int):
    """A row per text (n, node, check), and rows without a text for shingles that texts of a block share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in words.slices(column, BLOCK_BYTES):
                owner, shingles, bounds = _sets(column, first, last, width)
                common, found = np.unique(shingles, return_counts=True)
                common, found = common[found > 1], found[found > 1]
                nulls = pa.nulls(len(common), pa.int64())
                part = [pa.concat_arrays([batch.column(c).slice(first, last - first).cast(pa.int64()), nulls]) for c in ("doc_id", "_text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([True, False], [last - first, len(common)])),
                        *part,
                        pa.array(np.concatenate([np.diff(bounds), found])),
                        pa.array(np.concatenate([_node(shingles, bounds, words.WORD_BASE), words.signed(common)])),
                        pa.array(np.concatenate([_node(shingles, bounds, words.OTHER_BASE), np.zeros(len(common), np.int64)])),
                    ],
                    names=["is_text", "doc_id", "_text", "n", "node", "check"],
                )

    return run


def least_overlap(n: np.ndarray | int, percent: int):
    """The least part of a set of ``n`` that a similar set holds."""
    return -(-percent * n // 100)


def _list_keys(width: int, percent: int, common: np.ndarray):
    """The lists that a set stands in; a task lists equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.zeros(0, dtype=np.int64)
        for batch in batches:
            column = batch.column("text")
            for first, last in words.slices(column):
                owner, shingles, bounds = _sets(column, first, last, width)
                node = _node(shingles, bounds, words.WORD_BASE)
                order = np.lexsort((shingles, np.isin(shingles, common), owner))
                owner, shingles = owner[order], shingles[order]
                n = np.diff(bounds)
                leading = n - least_overlap(n, percent) + 1
                rank = np.arange(len(owner)) - bounds[owner]
                new = np.zeros(len(node), dtype=bool)
                new[np.unique(node, return_index=True)[1]] = True
                new &= (n > 1) & ~np.isin(node, listed)
                listed = np.concatenate([listed, node[new]])
                single = (rank < leading[owner]) & new[owner]
                keys, owners, pairs = [words.mixed(shingles[single])], [owner[single]], [np.zeros(int(single.sum()), dtype=bool)]
                ranks = [rank[single]]
                for i in np.flatnonzero(new & (n <= SMALL_MOST)):
                    some = shingles[bounds[i] : bounds[i] + leading[i] + 1]
                    a, b = np.triu_indices(len(some), 1)
                    low, high = np.minimum(some[a], some[b]), np.maximum(some[a], some[b])
                    keys.append(words.mixed(low * words.U64(words.WORD_BASE) ^ words.mixed(high)))
                    owners.append(np.full(len(a), i))
                    pairs.append(np.ones(len(a), dtype=bool))
                    ranks.append(b - 1)
                owners = np.concatenate(owners)
                at = n[owners].astype(np.int64) * AT + np.concatenate(ranks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(np.concatenate(keys))), pa.array(np.concatenate(pairs)), pa.array(node[owners]), pa.array(at)],
                    names=["key", "by_pair", "node", "at"],
                )

    return run


def _boundary(lists: DataFrame, percent: int) -> int:
    """The size below which listing by pairs costs least."""
    by_size = (
        lists.where("not by_pair").withColumn("n", F.expr(f"at div {AT}")).where(f"n <= {SMALL_MOST}")
        .groupBy("key", "n")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("n")
        .agg(F.sum("c").alias("rows"), F.sum(F.expr("c * (c - 1) / 2")).alias("pairs"))
        .collect()
    )

    def cost(size: int) -> float:
        total = 0.0
        for r in by_size:
            leading = r["n"] - least_overlap(r["n"], percent) + 1
            if r["n"] < size:
                total += r["rows"] / leading * (leading + 1) * leading / 2
            if r["n"] * 100 >= size * percent:
                total += r["rows"]
            if r["n"] >= size:
                total += r["pairs"] * PAIR_COST
        return total

    return min(range(SMALL_MOST + 2), key=cost)


def _parities(place: np.ndarray, bounds: np.ndarray, first: int, last: int) -> np.ndarray:
    """The parities of sets ``first`` to ``last``, whose shingles have these places, as words."""
    own = place[bounds[first] : bounds[last]] - first * PARITY_BITS
    odd = np.bincount(own, minlength=(last - first) * PARITY_BITS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _parity_arrays(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in words.slices(column):
                owner, shingles, bounds = _sets(column, first, last, width)
                place = owner * PARITY_BITS + (shingles & words.U64(PARITY_BITS - 1)).astype(np.int64)
                parity = np.concatenate([_parities(place, bounds, i, min(i + PARITY_ROWS, last - first)) for i in range(0, last - first, PARITY_ROWS)])
                each = np.arange(last - first + 1) * (PARITY_BITS // 64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_node(shingles, bounds, words.WORD_BASE)),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.array(parity)),
                    ],
                    names=["node", "n", "parity"],
                )

    return run


def _shingle_arrays(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in words.slices(column):
                _, shingles, bounds = _sets(column, first, last, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_node(shingles, bounds, words.WORD_BASE)),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(words.signed(shingles))),
                    ],
                    names=["node", "shingles"],
                )

    return run


def _met_texts(rows: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """A text of each node that stands in ``pairs``; a text that stands twice gives two rows."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    met = scratch_table(classes.join(nodes, "node", "left_semi").select(F.col("_first").alias("doc_id"), "_text").distinct(), "met")
    if met.count() <= BROADCAST_ROWS:  # else the texts are shuffled
        met = F.broadcast(met)
    return rows.join(met, ["doc_id", "_text"], "left_semi").select("text")


def _similar(pairs: DataFrame, rows: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar.

    A shingle that only one of two sets has changes one bit of their parities, so the
    bits in which these differ are at most what the sets differ by. Pairs that differ by
    too many are left out, and whole sets are made and joined for the other ones only.
    """
    sets = scratch_table(_met_texts(rows, classes, pairs).mapInArrow(_parity_arrays(width), "node bigint, n bigint, parity array<bigint>"), "parities")
    bits = F.aggregate(F.zip_with("_pa", "_pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    total = F.col("_na") + F.col("_nb")
    close = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("parity").alias("_pa")), "a")
    close = close.join(sets.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("parity").alias("_pb")), "b")
    close = close.where(F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * percent).where(bits * (100 + percent) <= total * (100 - percent))
    close = scratch_table(close.select("a", "b").distinct(), "close-pairs")
    release(sets)
    forget_shuffles(rows.sparkSession)
    whole = scratch_table(_met_texts(rows, classes, close).mapInArrow(_shingle_arrays(width), "node bigint, shingles array<bigint>"), "met-sets")
    left = whole.select(F.col("node").alias("a"), F.col("shingles").alias("_a")).join(close.select("a").distinct(), "a", "left_semi")
    right = whole.select(F.col("node").alias("b"), F.col("shingles").alias("_b")).join(close.select("b").distinct(), "b", "left_semi")
    shared = F.size(F.array_intersect("_a", "_b"))
    similar = shared * 100 >= (F.size("_a") + F.size("_b") - shared) * percent
    return close.join(left, "a").join(right, "b").where(similar).select("a", "b").distinct()


def _may_be_similar(a: str, b: str, percent: int) -> str:
    """SQL: two sets whose first common shingle stands at these places may be similar.

    All that is common stands from there on, and that must reach the share asked for.
    """
    na, nb, ra, rb = f"({a} div {AT})", f"({b} div {AT})", f"({a} % {AT})", f"({b} % {AT})"
    return f"least({na} - {ra}, {nb} - {rb}) * {100 + percent} >= ({na} + {nb}) * {percent}"


def _entries(used: DataFrame, percent: int) -> DataFrame:
    """key, node, at of the lists of two sets or more, and the hubs of its list that a set may resemble."""
    whole = Window.partitionBy("key")

    def hub(i: int) -> Column:
        least = F.min(F.struct(F.expr(f"at % {AT}"), F.xxhash64("node", F.lit(i)), F.col("node").alias("node"), F.col("at").alias("at"))).over(whole)
        return F.struct(least["node"].alias("hub"), least["at"].alias("hub_at"))

    # Dealt out first, so that no more than the lists is shuffled.
    dealt = used.select("key", "node", "at").repartition("key")
    lists = dealt.select("key", "node", "at", F.min("node").over(whole).alias("_least"), F.max("node").over(whole).alias("_most"), *[hub(i).alias(f"_hub{i}") for i in range(HUBS)])
    flat = [F.col(f"_hub{i}.{c}").alias(f"{c}{i}") for i in range(HUBS) for c in ("hub", "hub_at")]
    lists = lists.where("_least < _most").select("key", "node", "at", *flat).dropDuplicates(["key", "node", "at"])
    hubs = [F.when(F.expr(f"node <> hub{i} and {_may_be_similar('at', f'hub_at{i}', percent)}"), F.col(f"hub{i}")) for i in range(HUBS)]
    return scratch_table(lists.select("key", "node", "at", F.array_distinct(F.array_compact(F.array(*hubs))).alias("hubs")), "entries")


def _left_over(entries: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list but different components that may be similar.

    A set that stands too far back in its place even for the least set of the list is similar
    to none by that list.
    """
    size, place, whole = F.expr(f"at div {AT}"), F.expr(f"at % {AT}"), Window.partitionBy("key")
    placed = entries.join(linked, "node", "left").select("key", "node", "at", F.coalesce("component", "node").alias("component"))
    partner = F.greatest(F.min(size).over(whole), F.ceil(size * percent / 100))
    near = placed.withColumn("_partner", partner).where((size - place) * (100 + percent) >= (size + F.col("_partner")) * percent)
    mixed = near.withColumns({"_x": F.min("component").over(whole), "_y": F.max("component").over(whole)}).where("_x < _y")
    rows = scratch_table(mixed.select("key", "node", "at", "component"), "mixed-lists")
    parts = scratch_table(rows.groupBy("key", "component").agg(F.min(size).alias("least"), F.max(size).alias("most")), "mixed-parts")
    one = parts.select("key", F.col("component").alias("ca"), F.col("least").alias("la"), F.col("most").alias("ma"))
    two = parts.select("key", F.col("component").alias("cb"), F.col("least").alias("lb"), F.col("most").alias("mb"))
    meet = one.join(two, "key").where(f"ca < cb and ma * 100 >= lb * {percent} and mb * 100 >= la * {percent}").select("key", "ca", "cb")
    first = rows.select("key", F.col("component").alias("ca"), F.col("node").alias("a"), F.col("at").alias("at_a"))
    second = rows.select("key", F.col("component").alias("cb"), F.col("node").alias("b"), F.col("at").alias("at_b"))
    return (
        meet.join(first, ["key", "ca"])
        .join(second, ["key", "cb"])
        .where(_may_be_similar("at_a", "at_b", percent))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def grouped(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, _text (``xxhash64(text)``), n_shingles, component_id: a row per row of ``docs``.

    Words are lower-cased in A-Z only. A text of fewer than ``width`` words is one
    shingle; one without words, or null, has none and is linked with nothing. Rows link
    when 100 times their common shingles is at least ``percent`` times all of theirs.
    component_id is the smallest doc_id that links reach. A row without a doc_id takes no
    part and has no component; rows of one doc_id are linked by their texts like others.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent is above 50 and at most 100")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_text"))
    with scratch_scope(docs.sparkSession) as scope:
        made = rows.mapInArrow(_describe(width), "is_text boolean, doc_id bigint, _text bigint, n bigint, node bigint, check bigint")
        described = scope.keep(scratch_table(made, "sets"))
        texts = described.where("is_text").drop("is_text")
        often = described.where("not is_text").groupBy("node").agg(F.sum("n").alias("c")).where(F.col("c") >= COMMON)
        common = np.array([r[0] for r in often.orderBy(F.desc("c"), "node").limit(COMMON_MOST).collect()], dtype=np.int64).view(np.uint64)

        lists = scratch_table(
            rows.where("doc_id is not null").select("text").mapInArrow(_list_keys(width, percent, common), "key bigint, by_pair boolean, node bigint, at bigint"),
            "lists",
        )
        size = _boundary(lists, percent)
        used = lists.where(f"if(by_pair, at < {size * AT}, (at div {AT}) * 100 >= {size * percent})").drop("by_pair")
        entries = _entries(used, percent)
        release(lists)
        forget_shuffles(docs.sparkSession)
        classes = scratch_table(
            texts.where("doc_id is not null and n > 0").groupBy("node", "n", "check").agg(F.min("doc_id").alias("_first"), F.min_by("_text", "doc_id").alias("_text")), "classes"
        )
        stars = entries.select("node", F.explode("hubs").alias("hub")).select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b"))
        stars = scratch_table(stars.distinct(), "star-pairs")
        forget_shuffles(docs.sparkSession)
        with scratch_scope(docs.sparkSession) as inner:
            links = inner.keep(scratch_table(_similar(stars, rows, classes, width, percent), "links"))
        linked = scratch_table(components(links), "linked")
        with scratch_scope(docs.sparkSession) as inner:
            others = inner.keep(scratch_table(_left_over(entries.drop("hubs"), linked, percent).join(stars, ["a", "b"], "left_anti"), "other-pairs"))
        release(entries, stars)
        if not others.isEmpty():
            with scratch_scope(docs.sparkSession) as inner:
                more = inner.keep(scratch_table(_similar(others, rows, classes, width, percent), "links"))
            hung = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
            linked = scratch_table(components(hung.unionByName(more)), "linked")
        named = classes.join(linked, "node", "left").select("node", "n", "check", "_first", F.coalesce("component", "node").alias("component"))
        least = named.groupBy("component").agg(F.min("_first").alias("_component"))
        # Without links a class is a component of its own, even if two share a hash.
        alone = named.where("component = node").groupBy("component").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()
        if not alone:
            raise RuntimeError("two different sets of shingles have one 64-bit hash")
        answer = scope.keep(scratch_table(named.join(least, "component").select("node", "n", "check", "_component"), "set-components"))
    return texts.join(answer, ["node", "n", "check"], "left").select(
        "doc_id",
        "_text",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``docs`` with one row of each group: that of smallest doc_id; rows without a doc_id stay."""
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), _text=F.xxhash64("text"))
    with scratch_scope(docs.sparkSession) as scope:
        groups = scratch_table(grouped(docs, width, percent), "groups")
        kept = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.min("_text").alias("_text"), F.count(F.lit(1)).alias("_rows"))
        kept = scratch_table(kept, "kept-ids")
        stay = without(rows, groups.where("doc_id is not null").join(kept, ["doc_id", "_text"], "left_anti"), scope)
        repeated = kept.where("_rows > 1")
        if repeated.isEmpty():
            return unpacked(stay, docs)
        scope.keep(kept)
        one = stay.join(repeated, ["doc_id", "_text"], "left_semi").groupBy("doc_id").agg(F.any_value("_row").alias("_row"))
        return unpacked(without(stay, repeated, scope).select("_row").unionByName(one.select("_row")), docs)
