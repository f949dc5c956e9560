"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Of all suffixes an array keeps those that start at an anchor: in every window
of ``length`` bytes the place of the smallest hash of ``prefix`` bytes. Equal
windows choose the same place, so two occurrences of a long string always
have anchors at equal distance into it, and about one position in eighty is
kept. Starts that share an anchor form a run, and a run stands for all the
windows that begin in it. The text of a suffix goes from its anchor as far as
a window of its run does, and suffixes are ordered by its first ``depth`` bytes.

A new batch gets a suffix array: its suffixes in byte order, in ranges over the
executors and sorted within them; equal texts may lie in several ranges, so a
frequent text is no heavy one. The order is made by merging the batch with the
arrays of all levels, and there the longest match of a suffix lies right before
or after it. A window whose part behind the anchor is longer than this match
occurs nowhere else; a match of ``depth`` bytes may be longer and counts as
long enough. Levels of equal weight merge when the next batch comes, so a
suffix is merged at most as often as the logarithm of the number of batches.

A match behind the anchor leaves open whether the bytes before it agree as
well, with the same partner. This is settled among the few suffixes that are
left: first whole runs, then, where runs differ, blocks of eight windows, and
only where blocks agree in what their windows share but not in all, each
window. Every such comparison is a grouping by hash that combines before its
shuffle, so a passage in a third of all documents costs what its occurrences
cost. Equality is decided by two 64-bit hashes, of the prefix and of the
longer string.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift.llm.common import chunks, forget, prefix_hash, span_hash
from talentsift.llm.common import stored as stored_step

LENGTH = 200
PREFIX = 40
DEPTH = 64
#: Bytes of text that a worker computes over at once; hashes and places take about a hundred times as much.
SLICE = 1 << 17
POSTINGS = "doc bigint, body bigint, key bigint, tail bigint, run bigint, start int, n int, lead int, text binary"
ARRAY = "text binary, tail bigint, at bigint, reach int, fresh boolean, edge boolean"
STARTS = 8
BLOCKS = "doc bigint, body bigint, key bigint, block int, core bigint, left bigint, right bigint, first int, n int, start int"
CUTS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
NO_ID = -(1 << 63)
#: Above 200 partitions a shuffle task writes one sorted file; up to there it opens a file for each partition.
PARTITIONS = 256
#: Of the rows that a worker gets at once, so that long texts come in smaller batches.
BATCH_BYTES = "1m"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    partitions = max(PARTITIONS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stored_step(rows, purpose, {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES})


def _named(docs: DataFrame) -> DataFrame:
    """Rows by id and content, so repeated ids with different texts stay apart and repeated rows stay equal."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("body"), text.cast("binary").alias("bytes")
    )


def anchored_runs(data: np.ndarray, ends: np.ndarray, length: int, prefix: int, depth: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts in joined documents: first start, number of starts, distance to the anchor, and hashes of the prefix, of the suffix's first ``depth`` bytes and of the run's bytes.

    ``ends`` has the end of each document in ``data``; no window crosses one.
    """
    sums = prefix_hash(data)
    at = np.arange(len(data) - prefix + 1)
    hashes = span_hash(sums, at, at + prefix)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    low = (hashes & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
    width, have = length - prefix + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    anchors = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    starts = np.arange(len(anchors))
    valid = starts + length <= np.repeat(ends, np.diff(ends, prepend=0))[: len(starts)]
    starts, anchors = starts[valid], anchors[valid]
    if not len(starts):
        return (np.empty(0, np.int64),) * 6
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], anchors[first]
    end = begin + n - 1 + length
    tail, run = span_hash(sums, anchor, np.minimum(end, anchor + depth)), span_hash(sums, begin, end)
    return begin, n, anchor - begin, hashes[anchor].view(np.int64), tail.view(np.int64), run.view(np.int64)


def _texts(rows: np.ndarray) -> pa.Array:
    """Binary values from rows of equal width."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _rows(texts: pa.Array, width: int) -> np.ndarray:
    """The bytes of binary values of one width, a row each."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, width)


def _listed(lists: pa.Array, names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Values before each row of a column of lists, a null one being empty, and the fields of all values."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    values = lists.flatten()
    return np.concatenate([[0], np.cumsum(sizes)]), [np.asarray(values.field(values.type.get_field_index(c))).astype(np.int64) for c in names]


def _slices(bodies: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Documents (index, offset, bytes) in groups of about ``SLICE`` bytes; longer ones in overlapping slices."""
    group, size = [], 0
    for k, body in enumerate(bodies):
        if len(body) < length:
            continue
        for at in range(0, max(1, len(body) - length + 1), 4 * SLICE):
            part = body[at : at + 4 * SLICE + length - 1]
            group.append((k, at, part))
            size += len(part)
            if size >= SLICE:
                yield group
                group, size = [], 0
    if group:
        yield group


def suffixes(docs: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, depth: int = DEPTH) -> DataFrame:
    """The anchored suffixes of every whole text as runs of window starts.

    ``text`` has the first ``depth`` bytes (at least ``prefix``), a shorter one filled up with zeros, ``tail`` its hash.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, bodies = [np.asarray(batch.column(k)) for k in (0, 1)], batch.column(2).to_pylist()
            for group in _slices(bodies, length):
                data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
                ends = np.cumsum([len(part) for _, _, part in group])
                begin, n, lead, key, tail, run = anchored_runs(data, ends, length, prefix, depth)
                if not len(begin):
                    continue
                which = np.searchsorted(ends, begin, side="right")
                rows = np.array([k for k, _, _ in group])[which]
                shift = np.array([at for _, at, _ in group]) - np.concatenate([[0], ends[:-1]])
                start = (begin + shift[which]).astype(np.int32)
                padded = np.concatenate([data, np.zeros(depth, np.uint8)])
                text = np.lib.stride_tricks.sliding_window_view(padded, depth)[begin + lead]
                known = n - 1 + length - lead
                short = np.flatnonzero(known < depth)
                text[short] *= np.arange(depth) < known[short, None]
                columns = names[0][rows], names[1][rows], key, tail, run, start, n.astype(np.int32), lead.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in columns), _texts(text)],
                    names=["doc", "body", "key", "tail", "run", "start", "n", "lead", "text"],
                )

    return _named(docs).mapInArrow(scan, POSTINGS)


def _neighbours(prefix: int, depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over the sorted suffixes of a part: the longest match of each with the one before or after it.

    Returns all suffixes of the batch, in order, and of the others those that
    match from ``prefix`` bytes on, one of equal ones. The first and the last
    of a part are marked, since their neighbours in other parts are not known.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty((0, depth), np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int32), np.empty(0, bool))

        def rows(keep: np.ndarray, edge: bool = False) -> pa.RecordBatch:
            text, tail, at, fresh, reach = (c[keep] for c in held[:5])
            edges = np.full(len(keep), edge)
            return pa.RecordBatch.from_arrays([_texts(text), *(pa.array(c) for c in (tail, at, reach, fresh, edges))], names=["text", "tail", "at", "reach", "fresh", "edge"])

        opened = False
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = batch.column(3).to_numpy(zero_copy_only=False)
            came = (_rows(batch.column(0), depth), np.asarray(batch.column(1)), np.asarray(batch.column(2)), fresh, np.zeros(len(fresh), np.int32), np.zeros(len(fresh), bool))
            text, tail, at, fresh, reach, again = (np.concatenate(pair) for pair in zip(held, came, strict=True))
            same = text[1:] == text[:-1]
            common = np.where(same.all(axis=1), depth, same.argmin(axis=1)).astype(np.int32)
            np.maximum(reach[1:], common, out=reach[1:])
            np.maximum(reach[:-1], common, out=reach[:-1])
            again[1:] = common == depth
            held = text, tail, at, fresh, reach, again
            # The first row of a part leaves as an edge, the last as well; a part of one row leaves once.
            done = np.flatnonzero(fresh[:-1] | ((reach[:-1] >= prefix) & ~again[:-1]))
            if not opened and len(text) > 1:
                opened = True
                yield rows(np.array([0]), True)
                done = done[done > 0]
            yield rows(done)
            held = tuple(c[-1:] for c in held)
        if len(held[0]):
            yield rows(np.array([0]), True)

    return scan


class IndexFamily:
    """Suffix arrays whose sizes grow geometrically: ``levels`` holds weights (numbers of batches) and tables.

    A level has ``text, tail, at`` in the order of ``text``: a suffix, its hash
    and a number that tells equal suffixes apart. The tables lie below
    ``spark.checkpoint.dir``; ``folders`` names them and ``opened`` goes on
    from there, also in another session.
    """

    def __init__(self, *, prefix: int = PREFIX, depth: int = DEPTH) -> None:
        self.prefix, self.depth = prefix, depth
        self.levels: list[tuple[int, DataFrame]] = []

    def folders(self) -> list[tuple[int, str]]:
        return [(weight, level.inputFiles()[0].rsplit("/", 1)[0]) for weight, level in self.levels]

    @classmethod
    def opened(cls, spark: SparkSession, folders: list[tuple[int, str]], *, prefix: int = PREFIX, depth: int = DEPTH) -> IndexFamily:
        family = cls(prefix=prefix, depth=depth)
        family.levels = [(weight, spark.read.parquet(folder).where("fresh").select("text", "tail", "at")) for weight, folder in folders]
        return family

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Index the ``text, tail, at`` of a batch; ``tail, reach`` of all suffixes, old and new, that its arrival shows to match.

        ``reach`` counts the bytes that the suffix shares with the closest
        other one, up to ``depth`` and never too few. A batch without suffixes
        adds no level.
        """
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (weight, a), (_, b) = self.levels.pop(), self.levels.pop()
            merged = _in_order(a.unionByName(b)).withColumn("fresh", F.lit(True))
            self.levels.append((2 * weight, stored(merged, "level").where("fresh").select("text", "tail", "at")))
            forget(a)
            forget(b)
        parts = [suffixes.withColumn("fresh", F.lit(True)), *(level.withColumn("fresh", F.lit(False)) for _, level in self.levels)]
        compare = _neighbours(self.prefix, self.depth)
        ordered = _in_order(reduce(DataFrame.unionByName, parts))
        array = stored(ordered.select("text", "tail", "at", "fresh").mapInArrow(compare, ARRAY), "level")
        # Two rows a part, so one task has the neighbours across all borders.
        edges = array.where("edge").select("text", "tail", "at", "fresh")
        across = edges.repartition(1).sortWithinPartitions("text").mapInArrow(compare, ARRAY)
        matches = array.unionByName(across).where(F.col("reach") >= self.prefix).groupBy("tail").agg(F.max("reach").alias("reach"))
        matches = stored(matches, "matches")
        level = array.where("fresh").select("text", "tail", "at")
        if level.isEmpty():
            forget(array)
        else:
            self.levels.append((1, level))
        return matches


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("text", "at").sortWithinPartitions("text")


def _one(*names: str) -> list[Column]:
    """Any one row of a group, a column each.

    All columns see the rows in one order, so what they take is of one row.
    Numbers aggregate by hash; the least of a struct would sort the rows twice.
    """
    return [F.first(name).alias(name) for name in names]


def _blocks(docs: DataFrame, work: DataFrame, length: int) -> DataFrame:
    """The runs of ``work`` cut into blocks of eight starts at fixed distances from the anchor.

    ``core`` hashes what all windows of a block share; ``left`` and ``right``
    are the seven bytes on either side of it, as far as windows of the block
    need them. Core and sides together tell each of its windows. A row that
    repeats gives its blocks each time: their windows do start elsewhere as well.
    """
    lists = work.groupBy("doc", "body").agg(F.collect_list(F.struct("key", "start", "n", "lead")).alias("runs"))
    joined = _named(docs).join(lists.hint("shuffle_hash"), ["doc", "body"])
    shared = length - STARTS + 1

    def side(data: np.ndarray, at: np.ndarray, step: int, count: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for q in range(STARTS - 1):
            use = count > q
            out[use] |= data[at[use] + step * q].astype(np.int64) << (8 * q)
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, bodies, texts = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(2).to_pylist()
            before, fields = _listed(batch.column(3), ("start", "n", "lead", "key"))
            for a, b in chunks(texts, SLICE):
                data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
                base = np.concatenate([[0], np.cumsum([len(t) for t in texts[a:b]])[:-1]])
                row = np.repeat(np.arange(b - a), np.diff(before[a : b + 1]))
                start, n, lead, key = (c[before[a] : before[b]] for c in fields)
                last = lead - n + 1
                count = lead // STARTS - last // STARTS + 1
                which = np.repeat(np.arange(len(start)), count)
                block = (lead // STARTS)[which] - (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count))
                high = np.minimum(STARTS * block + STARTS - 1, lead[which])
                low = np.maximum(STARTS * block, last[which])
                anchor = (start + lead)[which]
                place = base[row][which]
                core = place + anchor - STARTS * block
                first = low - STARTS * block
                columns = {
                    "doc": docs[a:b][row][which],
                    "body": bodies[a:b][row][which],
                    "key": key[which],
                    "block": block.astype(np.int32),
                    "core": span_hash(prefix_hash(data), core, core + shared).view(np.int64),
                    "left": side(data, core - 1, -1, high - STARTS * block),
                    "right": side(data, core + shared, 1, STARTS - 1 - first),
                    "first": first.astype(np.int32),
                    "n": (high - low + 1).astype(np.int32),
                    "start": (anchor - high).astype(np.int32),
                }
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))

    return joined.select("doc", "body", "bytes", "runs").mapInArrow(scan, BLOCKS)


def _equal_windows(blocks: DataFrame) -> list[DataFrame]:
    """``doc, body, start, n`` of the windows in ``blocks`` that occur in two of them; takes the files of ``blocks`` away."""
    same_core, content = ["key", "block", "core"], ["left", "right", "first", "n"]
    contents = blocks.groupBy(*same_core, *content).agg(F.count("*").alias("times"), *_one("doc", "body", "start"))
    contents = stored(contents, "contents")
    repeated = stored(contents.where("times > 1").select(*same_core, *content), "repeated")
    whole = stored(blocks.join(repeated.hint("shuffle_hash"), [*same_core, *content]).select("doc", "body", "start", "n"), "found")
    forget(blocks)
    # Only blocks with equal cores can share a window, and only unequal blocks have anything left to compare.
    mixed = contents.groupBy(*same_core).agg(F.count("*").alias("ways"), F.min("times").alias("least")).where("ways > 1 and least = 1")
    mask = lambda k: F.shiftleft(F.lit(1).cast("long"), 8 * k) - 1
    steps = [
        F.struct(
            F.lit(k).alias("k"),
            F.xxhash64(*same_core, F.lit(k), F.col("left").bitwiseAND(mask(k)), F.col("right").bitwiseAND(mask(STARTS - 1 - k))).alias("hash"),
        )
        for k in range(STARTS)
    ]
    windows = (
        contents.join(mixed.select(*same_core).hint("shuffle_hash"), same_core)
        .select("key", "times", "doc", "body", "start", "first", "n", F.explode(F.slice(F.array(*steps), F.col("first") + 1, F.col("n"))).alias("w"))
        .select("key", "times", "doc", "body", "start", (F.col("first") + F.col("n") - 1 - F.col("w.k")).alias("after"), "w.hash")
    )
    equal = stored(windows.groupBy("key", "hash").agg(F.count("*").alias("ways")).where("ways > 1").select("key", "hash"), "equal")
    single = windows.where("times = 1").join(equal.hint("shuffle_hash"), ["key", "hash"])
    single = single.select("doc", "body", (F.col("start") + F.col("after")).alias("start"), F.lit(1).alias("n"))
    single = stored(single, "found")
    forget(contents)
    return [whole, single]


def find_repeats(docs: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, batches: int = 4) -> DataFrame:
    """``doc, body, start, n``: runs of starts whose windows of ``length`` bytes start anywhere else as well."""
    depth = min(length, max(prefix, DEPTH))
    family = IndexFamily(prefix=prefix, depth=depth)
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    postings, matches = [], []
    for k in range(batches):
        postings.append(stored(suffixes(docs.where(batch == k), length=length, prefix=prefix, depth=depth), "postings"))
        matches.append(family.add(postings[-1].select("text", "tail", F.xxhash64("doc", "body", "start").alias("at"))))
    reach = stored(reduce(DataFrame.unionByName, matches).groupBy("tail").agg(F.max("reach").alias("reach")), "reach")
    for done in (*matches, *(level for _, level in family.levels)):
        forget(done)
    # A window needs the match to go on to its end: what lies behind the anchor is ``length`` less the distance to it.
    enough = F.when(F.col("reach") < depth, F.expr(f"least(n, lead + reach - {length} + 1)")).otherwise(F.col("n"))
    again = reduce(DataFrame.unionByName, postings).join(reach.hint("shuffle_hash"), "tail").withColumn("n", enough)
    again = stored(again.where("n > 0").select("doc", "body", "key", "run", "start", "n", "lead"), "again")
    for done in (reach, *postings):
        forget(done)

    runs = again.groupBy("key", "run").agg(F.count("*").alias("times"), *_one("doc", "body", "start", "n", "lead"))
    runs = stored(runs, "runs")
    whole = stored(again.join(runs.where("times > 1").select("key", "run").hint("shuffle_hash"), ["key", "run"]).select("doc", "body", "start", "n"), "found")
    forget(again)
    # Where a prefix continues in several ways, parts of these may agree: one occurrence of each is compared by window.
    differing = stored(runs.groupBy("key").agg(F.count("*").alias("ways")).where("ways > 1").select("key"), "differing")
    blocks = stored(_blocks(docs, runs.join(differing.hint("shuffle_hash"), "key"), length), "blocks")
    forget(runs)
    return reduce(DataFrame.unionByName, [whole, *_equal_windows(blocks)])


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, prefix: int = PREFIX, batches: int = 4) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` of every row.

    Every byte goes that a string of ``length`` bytes covers which also starts
    anywhere else in the input, in the same text too. A null text is empty and
    a text shorter than ``length`` stays whole. Rows that repeat lose all
    their windows, since each starts in the other. Other columns are ignored.
    """
    found = find_repeats(docs, length=length, prefix=prefix, batches=batches)
    cuts = found.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "n")).alias("cuts"))
    joined = _named(docs).join(cuts.hint("shuffle_hash"), ["doc", "body"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            before, fields = _listed(batch.column(2), ("start", "n"))
            for a, b in chunks(texts, SLICE):
                data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
                edge = np.concatenate([[0], np.cumsum([len(t) for t in texts[a:b]])])
                start, n = (c[before[a] : before[b]] for c in fields)
                start = start + np.repeat(edge[:-1], np.diff(before[a : b + 1]))
                change = np.zeros(len(data) + 1, np.int32)
                np.add.at(change, start, 1)
                np.add.at(change, start + n - 1 + length, -1)
                gone = np.cumsum(change[:-1], dtype=np.int32) > 0
                # A span ends where its document does, even if the next one begins with a span.
                border = np.zeros(len(data) + 1, bool)
                border[edge] = True
                opens = np.flatnonzero(gone & (border[:-1] | ~np.concatenate([[False], gone])[:-1]))
                ends = np.flatnonzero(gone & (border[1:] | ~np.append(gone, False)[1:])) + 1
                spans = np.searchsorted(opens, edge)
                shift = np.repeat(edge[:-1], np.diff(spans))
                removed = np.concatenate([[0], np.cumsum(gone)])[edge]
                kept = (edge - removed).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(opens - shift), pa.array(ends - shift)], names=["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[a:b], mask=docs[a:b] == NO_ID),
                        *(pa.array(np.diff(c)) for c in (edge, removed, spans)),
                        pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), pairs),
                        pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(kept), pa.py_buffer(data[~gone])]),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
                )

    rest = stored(joined.select("doc", "bytes", "cuts").mapInArrow(cut, CUTS), "kept")
    forget(found)
    return rest
