"""Near-duplicate classes by DartMinHash signatures and banded joining.

An element of weight w owns the region [0, w) x [0, inf) of weights and ranks.
Its hash throws darts into that region, one per unit of area on average, and
each dart falls on one of ``k`` coordinates. A document keeps the dart of
smallest rank on every coordinate. Two documents agree on a coordinate with
the probability of their weighted Jaccard similarity, and the work is one
dart per coordinate and logarithm rather than one hash per coordinate and
element. Elements are five-word shingles of weight one by default, so the
similarity is that of shingle sets.

Documents that agree on all coordinates of a band share a bucket. Exact
copies are one node before that. In each bucket, all members are compared with
one pivot, the member with the most company over all its buckets, and what is
similar enough is linked. Members of one component need no further
comparison; the others are compared where their signatures and, by the
triangle inequality, their distances to the pivot allow a link. So a group of
copies costs rows in proportion to its size, and no link that the bands
propose is left out. Large buckets are compared in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import forget, mix64, prefix_hash, shingle_hashes, span_hash, stored, word_spans
from talentsift.llm.graph import components

SIGNATURES = "node bigint, body string, bands array<bigint>, sig binary"
BLOCK = 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Settings:
    """54 bands of 7 coordinates miss a pair of similarity 0.8 once in 300,000, and more similar ones less."""

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 54
    rows: int = 7
    weighted: bool = False

    @property
    def k(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        """Agreeing coordinates below which similarity at the threshold lies over 4.5 deviations away."""
        deviation = sqrt(self.threshold * (1 - self.threshold) / self.k)
        return max(self.rows, int(self.k * (self.threshold - 4.5 * deviation)))


@lru_cache(maxsize=1)
def _poisson_steps() -> np.ndarray:
    """Upper ends, as 24-bit numbers, of the ranges that mean 0, 1, 2 ... darts in a unit of area."""
    p, total, out = np.exp(-1.0), 0.0, []
    for n in range(12):
        total += p
        out.append(int(total * (1 << 24)))
        p /= n + 1
    return np.array(out, np.uint64)


def dart_signature(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, k: int) -> np.ndarray:
    """Smallest dart per document and coordinate (docs x k); documents without elements stay unset."""
    # One region per unit of weight; the last may be cut, and darts above the cut are dropped.
    units = np.ceil(weight).astype(np.int64)
    doc, part = np.repeat(doc, units), np.repeat(weight, units)
    level = np.arange(len(doc)) - np.repeat(np.cumsum(units) - units, units)
    with np.errstate(over="ignore"):
        region = mix64(np.repeat(element, units) + (level.astype(np.uint64) + np.uint64(1)) * _STEP)
    fraction = part - level
    total = np.bincount(doc, weights=np.minimum(fraction, 1.0), minlength=docs)
    out = np.full((docs, k), _UNSET, np.uint64)
    flat = out.reshape(-1)
    low = np.zeros(docs, np.int64)
    high = np.ceil((k * log(k) + 2 * k) / np.maximum(total, 1e-9)).clip(1, 1 << 23).astype(np.int64)
    open_ones = total > 0
    while open_ones.any():
        use = open_ones[doc]
        d, r, f = doc[use], region[use], fraction[use]
        cells = (high - low)[d]
        rank = np.arange(int(cells.sum())) - np.repeat(np.cumsum(cells) - cells, cells) + np.repeat(low[d], cells)
        with np.errstate(over="ignore"):
            cell = mix64(np.repeat(r, cells) ^ mix64(rank.astype(np.uint64) + _STEP))
            darts = np.searchsorted(_poisson_steps(), cell >> np.uint64(40), side="right")
            which = np.repeat(np.arange(len(cell)), darts)
            number = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mix64(cell[which] + (number.astype(np.uint64) + np.uint64(1)) * _STEP)
        owner = np.repeat(d, cells)[which]
        height = np.repeat(f, cells)[which]
        if (height < 1).any():
            inside = (mix64(dart) >> np.uint64(11)).astype(np.float64) / (1 << 53) < height
            dart, owner, which = dart[inside], owner[inside], which[inside]
        packed = (rank[which].astype(np.uint64) << np.uint64(40)) | (dart & np.uint64((1 << 40) - 1))
        np.minimum.at(flat, owner * k + ((dart >> np.uint64(40)) % np.uint64(k)).astype(np.int64), packed)
        open_ones &= (out == _UNSET).any(axis=1)
        low, high = high, high * 2
    return out


def shingles(bodies: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of every shingle, in order; a text of fewer words than ``n`` is one shingle."""
    data = np.frombuffer(b" ".join(bodies) + b" ", np.uint8)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    starts, stops = word_spans(data)
    words = span_hash(prefix_hash(data), starts, stops)
    owner = np.searchsorted(ends, starts, side="right")
    if len(words) >= n:
        runs = shingle_hashes(words, n)
        same = owner[: len(runs)] == owner[n - 1 :]
        docs, values = [owner[: len(runs)][same]], [runs[same]]
    else:
        docs, values = [], []
    counts = np.bincount(owner, minlength=len(bodies))
    firsts = np.cumsum(counts) - counts
    for k in np.flatnonzero((counts > 0) & (counts < n)):
        values.append(shingle_hashes(words[firsts[k] : firsts[k] + counts[k]], n))
        docs.append(np.array([k]))
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(docs), np.concatenate(values)


def distinct_elements(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each element of a document once, sorted, with its number of occurrences."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def node_key(docs: DataFrame) -> DataFrame:
    """Rows with ``node``: the document's id, or for a null id a negative number from its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("node", F.coalesce(F.col("doc_id").cast("long"), -F.shiftrightunsigned(F.xxhash64(text), 1) - 1))


def _bodies(docs: DataFrame, *columns: str) -> DataFrame:
    """``node``, ``body`` (a hash of the text) and some columns of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return node_key(docs).select("node", F.md5(text.cast("binary")).alias("body"), *columns)


def _worded(docs: DataFrame) -> DataFrame:
    words = F.lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary")
    return _bodies(docs.withColumn("words", words), "words")


def _parts(sizes: list[int], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= limit or k - start >= 255:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``node, body, bands, sig``: band hashes and one byte per coordinate; texts without words have no bands."""
    k, rows = settings.k, settings.rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(2).to_pylist()
            for a, b in _parts([len(x) for x in bodies]):
                doc, value, times = distinct_elements(*shingles(bodies[a:b], settings.shingle))
                weight = times.astype(np.float64) if settings.weighted else np.ones(len(doc))
                darts = dart_signature(doc, value, weight, b - a, k)
                signed = darts[:, 0] != _UNSET
                bands = np.zeros((b - a, settings.bands), np.uint64)
                with np.errstate(over="ignore"):
                    for r in range(rows):
                        bands = mix64(bands * _STEP + darts[:, r::rows] + np.arange(settings.bands, dtype=np.uint64)[None, :])
                low = (mix64(darts) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array([x if s else None for x, s in zip(bands.view(np.int64), signed, strict=True)], pa.list_(pa.int64())),
                        pa.array([x.tobytes() if s else None for x, s in zip(low, signed, strict=True)], pa.binary()),
                    ],
                    names=["node", "body", "bands", "sig"],
                )

    return _worded(docs).mapInArrow(sign, SIGNATURES)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """``a, b, similarity`` of node pairs, from the whole shingle sets of their texts."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "body"), "node")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for a, b in _parts([len(x) for x in bodies]):
                doc, value, times = distinct_elements(*shingles(bodies[a:b], settings.shingle))
                if settings.weighted:  # the n-th occurrence is an element of its own
                    n = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    with np.errstate(over="ignore"):
                        doc, value = np.repeat(doc, times), mix64(np.repeat(value, times) + n.astype(np.uint64) * _STEP)
                offsets = np.searchsorted(doc, np.arange(b - a + 1))
                sets = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), sets], names=["node", "elements"])

    texts = _worded(docs).join(wanted, ["node", "body"], "left_semi").dropDuplicates(["node", "body"]).select("node", "words")
    sets = texts.mapInArrow(spell, "node bigint, elements array<bigint>")
    sets = stored(sets, "sets")
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b"
    )
    both = F.size(F.array_intersect("x", "y"))
    rows = joined.select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), both.alias("both"))
    similarity = F.col("both") / (F.col("nx") + F.col("ny") - F.col("both"))
    found = stored(rows.groupBy("a", "b").agg(F.max(similarity).alias("similarity")), "similar")
    forget(sets)
    forget(pairs)
    return found


def _remaining(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in one bucket whose signatures and pivot distances allow a link."""
    least, k, slack = settings.least_agreement, settings.k, 1 - settings.threshold + 1e-9

    def compare(rows: list[dict], lo: int, hi: int, band: int) -> pa.RecordBatch | None:
        sig = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint8).reshape(len(rows), k)
        bands = np.array([r["bands"] for r in rows], np.int64)
        block, comp, sim, node = (np.array([r[c] for r in rows]) for c in ("block", "component", "similarity", "node"))
        left, right = [], []
        for i in np.flatnonzero(block == lo):
            j = np.flatnonzero((comp != comp[i]) & (np.abs(sim - sim[i]) <= slack) & ((node > node[i]) if lo == hi else (block == hi)))
            if not len(j):
                continue
            j = j[(sig[j] == sig[i]).sum(axis=1) >= least]
            # A pair that shares several buckets belongs to the first of them; bytes of ``sig`` may agree by chance.
            j = j[(bands[j] == bands[i]).argmax(axis=1) == band]
            left.append(np.minimum(node[i], node[j]))
            right.append(np.maximum(node[i], node[j]))
        if not left:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    here, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["bucket"], row["lo"], row["hi"], row["band"])
            if key != here:
                if len(rows) > 1 and (out := compare(rows, *here[1:])) is not None:
                    yield out
                here, rows = key, []
            rows.append(row)
    if len(rows) > 1 and (out := compare(rows, *here[1:])) is not None:
        yield out


def links(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Members (``id, node``) with the text they share, and verified links (``a, b``) between nodes."""
    signed = stored(signatures(docs, settings), "signatures")
    nodes = stored(
        signed.groupBy("body").agg(F.min("node").alias("node"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig")), "nodes"
    )
    members = signed.select(F.col("node").alias("id"), "body").distinct().join(nodes.select("node", "body"), "body").select("id", "node").distinct()
    members = stored(members, "members")
    forget(signed)

    buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    sizes = buckets.groupBy("bucket", "band").agg(F.count("*").alias("size")).where("size > 1")
    found = stored(buckets.join(sizes, ["bucket", "band"]), "buckets")
    company = found.groupBy("node").agg(F.sum("size").alias("company"))
    pivots = found.join(company, "node").groupBy("bucket", "band").agg(F.max(F.struct("company", -F.col("node"))).alias("best"))
    pivots = pivots.select("bucket", "band", (-F.col("best")["col2"]).alias("pivot"))
    shared = stored(found.join(pivots, ["bucket", "band"]), "buckets")
    forget(found)
    first = _verified(docs, nodes, shared.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), settings)
    near = first.where(F.col("similarity") >= settings.threshold).select("a", "b")

    known = components(near)
    open_rows = (
        shared.where("node <> pivot")
        .join(known, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(first.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "similarity"), ["pivot", "node"])
    )
    open_rows = stored(open_rows, "open")
    forget(shared)
    mixed = open_rows.groupBy("bucket", "band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket", "band")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        open_rows.join(mixed, ["bucket", "band"])
        .withColumn("blocks", blocks)
        .withColumn("block", block)
        .select("bucket", "band", "node", "component", "similarity", "block", partner.alias("other"))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .join(nodes.select("node", "sig", "bands"), "node")
        .select("bucket", "band", "lo", "hi", "block", "node", "component", "similarity", "sig", "bands")
        .repartition("bucket", "band", "lo", "hi")
        .sortWithinPartitions("bucket", "lo", "hi", "band")
    )
    more = _verified(docs, nodes, dealt.mapInArrow(lambda batches: _remaining(batches, settings), "a bigint, b bigint").distinct(), settings)
    forget(open_rows)
    forget(nodes)
    return members, near.unionByName(more.where(F.col("similarity") >= settings.threshold).select("a", "b"))


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``id, class_id``: the class of each document id, named by its smallest id.

    Equal texts and texts linked by a similarity of at least the threshold
    share a class, through others too. A null text is empty, and empty texts
    are copies of each other; a text without words has only its copies. A null
    id stands as a negative number from its text. An id with several texts
    joins their classes.
    """
    members, found = links(docs, settings)
    several = members.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("id", "a")
    joined = members.join(several, "id").select("a", F.col("node").alias("b"))
    whole = components(found.unionByName(joined))
    return (
        members.join(whole, "node", "left")
        .groupBy("id")
        .agg(F.min(F.coalesce("component", "node")).alias("class_id"))
    )


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, class_id`` of every document; see ``classes``."""
    rows = node_key(docs).select("node", "doc_id").distinct()
    return rows.join(classes(docs, settings).withColumnRenamed("id", "node"), "node").select("doc_id", "class_id")


def keep_one_text(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each group of copies, with all its columns: of the smallest id and, among its texts, that of the smallest hash.

    Groups are linked by similarity of texts alone, so different texts of one
    id stay apart and each keeps a row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    members, found = links(docs.select(F.shiftrightunsigned(F.xxhash64(text), 1).alias("doc_id"), "text"), settings)
    forget(members)
    group = components(found).select(F.col("node").alias("_text"), "component")
    keyed = _bodies(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), "row", F.shiftrightunsigned(F.xxhash64(text), 1).alias("_text"))
    first = keyed.groupBy("_text").agg(F.min(F.struct("node", "body")).alias("first"))
    lowest = first.join(group, "_text", "left").groupBy(F.coalesce("component", "_text")).agg(F.min("first").alias("first"))
    lowest = stored(lowest.select("first.*"), "kept")
    return keyed.join(lowest, ["node", "body"], "left_semi").dropDuplicates(["node", "body"]).select("row.*")


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each class, with all its columns: of the smallest id and, among its texts, that of the smallest hash.

    Classes join the texts of an id; ``keep_one_text`` does not.
    """
    keyed = _bodies(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), "row")
    kept = classes(docs, settings).where("id = class_id").select(F.col("id").alias("node"))
    lowest = stored(keyed.groupBy("node").agg(F.min("body").alias("body")).join(kept, "node"), "kept")
    return keyed.join(lowest, ["node", "body"], "left_semi").dropDuplicates(["node", "body"]).select("row.*")
