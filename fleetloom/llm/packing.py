"""Documents packed into sequences of at most ``capacity`` tokens.

Pieces are tokenized once, inside tasks. How many pieces of each length there are is all
that packing needs, and that table has at most ``capacity`` rows whatever the input. On
it, dominance in the manner of Martello and Toth fixes small sets that are at least as
good as any other use of their longest piece; the rest goes best-fit, longest first. The
outcome, runs of equal bins, is joined back to the pieces by length and rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm.tokens import BATCH_BYTES, token_ids
from fleetloom.llm.words import slices
from fleetloom.session import scratch_table

CAPACITY = 2048
SEPARATOR = 0


class Lengths:
    """A multiset of lengths, counted, with the longest that still fits at hand."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {n: c for n, c in counts.items() if c > 0}
        self.sorted = sorted(self.counts)

    def take(self, length: int, count: int) -> None:
        self.counts[length] -= count
        if not self.counts[length]:
            del self.counts[length]
            self.sorted.pop(bisect_left(self.sorted, length))

    def put(self, length: int, count: int) -> None:
        if length not in self.counts:
            insort(self.sorted, length)
        self.counts[length] = self.counts.get(length, 0) + count

    def up_to(self, limit: int) -> int | None:
        i = bisect_left(self.sorted, limit + 1)
        return self.sorted[i - 1] if i else None

    def least(self, n: int) -> int:
        """The sum of the ``n`` shortest, or infinity if there are fewer."""
        total = 0
        for length in self.sorted:
            used = min(n, self.counts[length])
            total, n = total + used * length, n - used
            if not n:
                return total
        return 1 << 62


def _best_pair(lengths: Lengths, room: int) -> int:
    """The greatest sum of two lengths that fit into ``room``, 0 if none do."""
    best = 0
    for a in reversed(lengths.sorted):
        if 2 * a <= best:
            break
        b = lengths.up_to(min(a, room - a))
        if b == a and lengths.counts[a] < 2:
            i = bisect_left(lengths.sorted, a)
            b = lengths.sorted[i - 1] if i else None
        if b is not None and a + b <= room:
            best = max(best, a + b)
    return best


def reduced(lengths: Lengths, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Bins that dominance fixes, as (how many, lengths); they leave ``lengths``.

    For each length, longest first: a piece that nothing else fits beside is a bin; so is
    a piece with the longest partner that fits, if that fills the bin, or if no two others
    fit beside the piece, or no three do and no two exceed the partner's length. Fixing a
    pair only shrinks what is left, so the reason holds until the partner runs out.
    """
    fixed = []
    for longest in list(reversed(lengths.sorted)):
        while lengths.counts.get(longest):
            room, count = capacity - longest, lengths.counts[longest]
            others = Lengths(lengths.counts)
            others.take(longest, 1)
            partner = others.up_to(room)
            if partner is None:
                fixed.append((count, (longest,)))
                lengths.take(longest, count)
                break
            dominant = partner == room or others.least(2) > room
            if not dominant and others.least(3) > room:
                dominant = _best_pair(others, room) <= partner
            if not dominant:
                break
            pairs = count // 2 if partner == longest else min(count, lengths.counts[partner])
            fixed.append((pairs, (longest, partner)))
            lengths.take(longest, pairs)
            lengths.take(partner, pairs)
    return fixed


def best_fit(lengths: Lengths, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """The remaining lengths, longest first, each into the fullest bin that has room.

    Equal bins are handled together. A bin that has taken a piece is fuller than its
    equals, so it takes all of that length it can before the next one gets any.
    """
    open_bins: dict[int, list[tuple[int, tuple[int, ...]]]] = {0: []}
    rooms: list[int] = []

    def add(room: int, times: int, content: tuple[int, ...]) -> None:
        if times and room and room not in open_bins:
            insort(rooms, room)
        if times:
            open_bins.setdefault(room, []).append((times, content))

    for length in reversed(lengths.sorted):
        left = lengths.counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                room, times, content = capacity, left, ()
            else:
                room = rooms[i]
                times, content = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(i)
            each = room // length
            full = min(times, left // each)
            add(room - each * length, full, content + (length,) * each)
            left -= full * each
            if full < times and left:
                add(room - left * length, 1, content + (length,) * left)
                full, left = full + 1, 0
            if content:
                add(room, times - full, content)
    return [run for runs in open_bins.values() for run in runs]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Runs of equal bins for the counted lengths: dominance first, best-fit for the rest."""
    lengths = Lengths(counts)
    if lengths.sorted and not 1 <= lengths.sorted[0] <= lengths.sorted[-1] <= capacity:
        raise ValueError("a length must be between 1 and the capacity")
    return reduced(lengths, capacity) + best_fit(lengths, capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and where they stand.

    A document is its token ids and then the separator; a null text has the separator
    alone. Only documents longer than ``capacity`` are cut, the rest of the division first.
    ``_part``, ``_row`` number the pieces, ``_nth`` those of one length in a part.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(tokenizer)
        part, row = TaskContext.get().partitionId(), 0
        seen = np.zeros(capacity + 1, dtype=np.int64)
        separator = SEPARATOR.to_bytes(4, "little")
        for batch in batches:
            column = batch.column("text")
            for first, last in slices(column, BATCH_BYTES):
                out: list[tuple] = []
                tokens, bounds = encoder.of(column, first, last)
                doc_ids = batch.column("doc_id").slice(first, last - first).to_pylist()
                for doc_id, low, high in zip(doc_ids, bounds[:-1], bounds[1:], strict=True):
                    ids = tokens[low:high].tobytes() + separator
                    n = len(ids) // 4
                    start, length = 0, (n - 1) % capacity + 1 if n > capacity else n
                    number = 0
                    while start < n:
                        out.append((doc_id, number, start, length, ids[4 * start : 4 * (start + length)], part, row, int(seen[length])))
                        seen[length] += 1
                        start, length, number, row = start + length, capacity, number + 1, row + 1
                yield _piece_batch(out)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return scratch_table(rows.mapInArrow(cut, PIECE_SCHEMA), "pieces")


PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids binary, _part int, _row bigint, _nth bigint"


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _slots(runs: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Per run and length: length, first rank, pieces a bin, first sequence, first offset."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, content in runs:
        offset = 0
        for length in dict.fromkeys(content):
            each = content.count(length)
            low = rank.get(length, 0)
            rows.append((length, low, each, sequence, offset))
            rank[length] = low + each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows of ``pieces``, with any columns) with sequence_id and offset.

    Only counts by length, at most ``capacity`` rows, come to the driver, and the runs of
    equal bins that go back are as bounded.
    """
    by_part = scratch_table(cut.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    totals = by_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    slots = _slots(plan({r["length"]: r["n"] for r in totals}, capacity))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_part.select("_part", "length", F.coalesce(before, F.lit(0)).alias("_base"))
    ranked = cut.join(bases, ["_part", "length"]).withColumn("_rank", F.col("_base") + F.col("_nth")).drop("_base")
    keys = (slots[:, 0] << 50) + slots[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            run = slots[np.searchsorted(keys, (length << 50) + rank, side="right") - 1]
            within = rank - run[:, 1]
            out = batch.drop_columns(["_rank"])
            out = out.append_column("sequence_id", pa.array(run[:, 3] + within // run[:, 2]))
            yield out.append_column("offset", pa.array(run[:, 4] + within % run[:, 2] * length))

    schema = ranked.drop("_rank").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema
    return ranked.mapInArrow(place, schema)


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    Null, repeated and empty documents are packed like any others; other columns of
    ``docs`` are not read. An empty table gives an empty one.
    """
    cut = pieces(docs, tokenizer, capacity)
    narrow = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return placed(narrow, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, length, doc_ids, ids: the packed sequences themselves."""
    cut = pieces(docs, tokenizer, capacity)
    places = placed(cut.drop("ids"), capacity).select("_part", "_row", "sequence_id", "offset")
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return (
        cut.join(places, ["_part", "_row"])
        .groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), parts.alias("parts"))
        .select("sequence_id", "length", F.col("parts.doc_id").alias("doc_ids"), F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
    )
