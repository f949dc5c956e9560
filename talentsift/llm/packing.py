"""Best-fit packing of token sequences by exact complements of lengths.

Documents become pieces of at most ``capacity`` tokens. What decides the
packing is only how many pieces there are of each length, at most
``capacity`` numbers at any corpus size; the driver plans on those. Sums of
one, two and three lengths are looked up for the exact gap that a piece
leaves and are used up as often as the counts allow; what remains goes
best-fit into the smallest gap that holds it. Pieces then find their places
by rank within their length, computed over salted buckets so that one common
length never meets in one task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentsift.llm.common import byte_bpe, stored

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
SLOTS = "length bigint, first_rank bigint, ranks bigint, per_sequence bigint, base bigint, first_offset bigint"
ROWS_PER_BUCKET = 50_000


def tokenize(docs: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Token pieces (``doc_id, piece, start, length, ids``) of every whole text.

    ``ids`` holds little-endian unsigned 32-bit numbers. A null text is empty
    and yields the end id alone. A document longer than ``capacity`` is cut into pieces
    of ``capacity`` tokens, the first of which takes the remainder. Rows that
    repeat are packed as often as they occur; other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: list[list] = [[], [], [], [], []]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.array([*encoder.ids(text or ""), end_id], dtype="<u4")
                    first = len(ids) % capacity or capacity
                    ends = range(first, len(ids) + 1, capacity) if len(ids) > capacity else [len(ids)]
                    start = 0
                    for piece, end in enumerate(ends):
                        for column, value in zip(out, (doc, piece, start, end - start, ids[start:end].tobytes()), strict=True):
                            column.append(value)
                        start = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


def _complements(gap: int, left: dict[int, int], pairs: dict[int, list[tuple[int, int]]]) -> Iterator[tuple[int, ...]]:
    """Sums of one, two and three lengths that fill the gap exactly, larger parts first."""
    if left.get(gap):
        yield (gap,)
    yield from pairs.get(gap, ())
    for part in sorted((k for k, n in left.items() if n and k < gap), reverse=True):
        if part * 3 < gap:
            break
        for pair in pairs.get(gap - part, ()):
            if pair[0] <= part:
                yield (part, *pair)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: equal lengths fill the smallest gaps that hold them, class by class."""
    patterns: list[tuple[tuple[int, ...], int]] = []
    open_ones: dict[int, Counter] = defaultdict(Counter)  # gap -> patterns
    for length in sorted((k for k, n in left.items() if n > 0), reverse=True):
        count = left[length]
        while count:
            gap = min((g for g, held in open_ones.items() if held and g >= length), default=None)
            if gap is None:
                fit = capacity // length
                whole, rest = divmod(count, fit)
                for size, times in ((fit, whole), (rest, 1)):
                    if size and times:
                        open_ones[capacity - fit * length if size == fit else capacity - size * length][(length,) * size] += times
                break
            pattern, n = next(iter(open_ones[gap].items()))
            times = min(n, count)
            open_ones[gap][pattern] -= times
            open_ones[gap] = +open_ones[gap]
            open_ones[gap - length][(*pattern, length)] += times
            count -= times
    patterns += [(p, n) for held in open_ones.values() for p, n in held.items()]
    return patterns


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how often each is used; together they use every count up.

    Each step empties one length or one class of open sequences, so the plan
    has a few entries per length whatever the counts are. Where few lengths
    occur, filling gaps exactly can cost more than it saves; then best-fit
    over all counts is the plan, if it needs fewer sequences.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    lengths = sorted(left, reverse=True)
    pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for a in lengths:
        for b in lengths:
            if b <= a and a + b <= capacity:
                pairs[a + b].append((a, b))
    used: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...]) -> None:
        need = Counter(pattern)
        times = min(left.get(k, 0) // n for k, n in need.items())
        if times:
            used.append((pattern, times))
            for k, n in need.items():
                left[k] -= times * n

    for length in lengths:
        if length == capacity:
            use((length,))
            continue
        for others in _complements(capacity - length, left, pairs):
            if not left[length]:
                break
            use((length, *others))
    exact, plain = used + best_fit(left, capacity), best_fit(counts, capacity)
    return min(exact, plain, key=lambda patterns: sum(n for _, n in patterns))


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length, ranges of ranks and the sequences and offsets they go to."""
    rank: Counter = Counter()
    out, base = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, same in groupby(pattern):
            each = len(list(same))
            out.append((length, rank[length], times * each, each, base, offset))
            rank[length] += times * each
            offset += each * length
        base += times
    return out


def pack(pieces: DataFrame, *, capacity: int = 1024, planner: Callable = plan) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``doc_id, piece, start, length``.

    Ties of length go by the hash of the row and then by its columns, so a
    retry gives the same places. No rows in, no rows out.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    places = spark.createDataFrame(slots(planner(histogram, capacity)), SLOTS)

    buckets = 1 + sum(histogram.values()) // ROWS_PER_BUCKET
    order = [c for c in pieces.columns if c != "length"]
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("length", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)) - 1
    ranked = pieces.withColumn("_within", within).join(starts, ["length", "_bucket"]).withColumn("_rank", F.col("_within") + F.col("_before"))
    # One row per pattern and length: bounded by the capacity, not by the corpus.
    step = F.col("_rank") - F.col("first_rank")
    return (
        ranked.join(F.broadcast(places), "length")
        .where((step >= 0) & (step < F.col("ranks")))
        .select(
            *[c for c in pieces.columns if c != "_bucket"],
            (F.col("base") + F.floor(step / F.col("per_sequence"))).alias("sequence_id"),
            (F.col("first_offset") + step % F.col("per_sequence") * F.col("length")).alias("offset"),
        )
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves: one row per ``sequence_id`` with its ids in order and its documents.

    A sequence holds at most ``capacity`` tokens, so the groups are bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
            F.transform("parts", lambda p: p["length"]).alias("lengths"),
            F.concat_ws("", F.transform("parts", lambda p: F.hex(p["ids"]))).alias("ids_hex"),
        )
    )
