"""Benchmark decontamination: BM25 over test items with block-max WAND pruning, then an overlap check.

The index holds the test items. Every training text is cut into overlapping
passages, and each passage is a query of its distinct words. Impacts are BM25
weights divided by what the item would score for its own text, so a score is
the weighted share of an item that a passage covers and one threshold serves
all items. A batch of passages goes through the tests of the method together: the
sum of the largest impacts of its words must reach the threshold (the WAND
pivot), then the sum of the largest impacts within a block of items must, and
only then are the items of that block scored in full.

Items that score are checked against the text: five-word shingles of the item
and the words of its question (all but the last sentence) and answer (the last
sentence) must be there. Items are indexed in shards of bounded size; further
shards cost further passes and never more memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import chunks, prefix_hash, shingle_hashes, span_hash, word_spans

MATCHES = "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double"
ITEMS_PER_BLOCK = 16
SHARD_BYTES = 1 << 20
PART_WORDS = 256
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Settings:
    score: float = 0.7
    overlap: float = 0.8
    shingle: int = 5
    passage_words: int = 128


def hashed_words(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the index of its text."""
    data = np.frombuffer(b" ".join(bodies) + b" ", np.uint8)
    starts, stops = word_spans(data)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    return span_hash(prefix_hash(data), starts, stops), np.searchsorted(ends, starts, side="right")


def _body(text: str) -> bytes:
    return text.lower().encode()


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    question: np.ndarray
    answer: np.ndarray
    shingles: np.ndarray


def read_items(rows: list[tuple[int, str]], n: int) -> list[Item]:
    """Items with at least one shingle; a text of one sentence is question and answer at once."""
    out = []
    for item_id, text in rows:
        sentences = [s for s in _SENTENCE.split((text or "").strip()) if s]
        words, _ = hashed_words([_body(text or "")])
        if len(words) < n:
            continue
        question, _ = hashed_words([_body(" ".join(sentences[:-1] or sentences))])
        answer, _ = hashed_words([_body(sentences[-1])])
        answer = answer if len(answer) else words
        question = question if len(question) else words
        out.append(Item(item_id, words, np.unique(question), np.unique(answer), np.unique(shingle_hashes(words, n))))
    return out


class ImpactIndex:
    """Normalised BM25 impacts of item parts, with their maxima per word and per word and block."""

    def __init__(self, items: list[Item]):
        parts = [(k, item.words[at : at + PART_WORDS]) for k, item in enumerate(items) for at in range(0, len(item.words), PART_WORDS)]
        self.items = items
        self.owner = np.array([k for k, _ in parts])
        self.longest = max(len(w) for _, w in parts)
        sizes = np.array([len(w) for _, w in parts])
        counted = [np.unique(w, return_counts=True) for _, w in parts]
        self.terms, term = np.unique(np.concatenate([t for t, _ in counted]), return_inverse=True)
        part = np.repeat(np.arange(len(parts)), [len(t) for t, _ in counted])
        tf = np.concatenate([n for _, n in counted]).astype(np.float64)
        df = np.bincount(term)
        idf = np.log1p((len(parts) - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[part] / sizes.mean()))
        impact = weight / np.bincount(part, weights=weight)[part]
        self.blocks = -(-len(parts) // ITEMS_PER_BLOCK)
        self.block_max = np.zeros((self.blocks, len(self.terms)))
        np.maximum.at(self.block_max, (part // ITEMS_PER_BLOCK, term), impact)
        self.top = self.block_max.max(axis=0)
        # Per block: its words in order and their impacts on its items, zero-padded.
        self.block_terms, self.block_impacts = [], []
        for b in range(self.blocks):
            here = part // ITEMS_PER_BLOCK == b
            terms, row = np.unique(term[here], return_inverse=True)
            table = np.zeros((len(terms) + 1, ITEMS_PER_BLOCK))
            table[row, part[here] % ITEMS_PER_BLOCK] = impact[here]
            self.block_terms.append(terms)
            self.block_impacts.append(table)

    def search(self, words: np.ndarray, text: np.ndarray, texts: int, threshold: float, passage: int) -> Iterator[tuple[int, int, float]]:
        """(text, item, best passage score) at or above the threshold."""
        term = np.searchsorted(self.terms, words).clip(max=len(self.terms) - 1)
        known = np.flatnonzero(self.terms[term] == words)
        if not len(known):
            return
        counts = np.bincount(text, minlength=texts)
        place = np.arange(len(words)) - (np.cumsum(counts) - counts)[text]
        width = max(passage, 2 * self.longest)
        stride = width - self.longest
        # Word p of a text lies in the passages that start at multiples of the stride in (p - width, p].
        spread = -(-width // stride)
        cells = np.cumsum(counts // stride + spread) - (counts // stride + spread)
        keys = []
        for back in range(spread):
            start = place[known] // stride - back
            inside = (start >= 0) & (place[known] < start * stride + width)
            keys.append((cells[text[known]] + start)[inside] * len(self.terms) + term[known][inside])
        pairs = np.unique(np.concatenate(keys))
        where, term = np.divmod(pairs, len(self.terms))
        first = np.flatnonzero(np.diff(where, prepend=-1))
        which = np.cumsum(np.diff(where, prepend=-1) > 0) - 1  # passages numbered in order
        source = np.searchsorted(cells, where[first], side="right") - 1
        slack = threshold - 1e-9

        alive = np.bincount(which, weights=self.top[term]) >= slack
        use = alive[which]
        which, term = which[use], term[use]
        if not len(which):
            return
        best: dict[tuple[int, int], float] = {}
        for b in range(self.blocks):
            bound = np.bincount(which, weights=self.block_max[b][term], minlength=len(first)) >= slack
            use = bound[which]
            if not use.any():
                continue
            w, t = which[use], term[use]
            row = np.searchsorted(self.block_terms[b], t)
            row[(row == len(self.block_terms[b])) | (self.block_terms[b][row.clip(max=len(self.block_terms[b]) - 1)] != t)] = -1
            begin = np.flatnonzero(np.diff(w, prepend=-1))
            scores = np.add.reduceat(self.block_impacts[b][row], begin, axis=0)
            for i, j in zip(*np.nonzero(scores >= slack), strict=True):
                key = (int(source[w[begin[i]]]), int(self.owner[b * ITEMS_PER_BLOCK + j]))
                best[key] = max(best.get(key, 0.0), float(scores[i, j]))
        for (k, item), score in best.items():
            yield k, item, score


def _scan(docs: DataFrame, index: ImpactIndex, settings: Settings) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)  # at most one shard

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, end in chunks(bodies):
                words, text = hashed_words(bodies[at:end])
                out = []
                bounds = np.searchsorted(text, np.arange(end - at + 1))
                for k, which, score in held.search(words, text, end - at, settings.score, settings.passage_words):
                    item, own = held.items[which], words[bounds[k] : bounds[k + 1]]
                    overlap = np.isin(item.shingles, shingle_hashes(own, settings.shingle)).mean()
                    question, answer = np.isin(item.question, own).mean(), np.isin(item.answer, own).mean()
                    if min(overlap, question, answer) >= settings.overlap:
                        out.append((ids[at + k], item.item_id, round(score, 6), float(overlap), float(question), float(answer)))
                if out:
                    kinds = (pa.int64(), pa.int64(), *(pa.float64(),) * 4)
                    names = ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    body = F.lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary")
    return docs.select(F.col("doc_id").cast("long"), body).mapInArrow(scan, MATCHES)


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id`` and scores for every text that holds a test item.

    All passages of all texts are searched. Null texts hold nothing, and an
    item with fewer words than a shingle is found nowhere. Rows that repeat
    match as often as they occur; a text that holds several items has a row for each; items
    of equal text all match. Other columns are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + total // SHARD_BYTES
    found = []
    for k in range(shards):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).orderBy("item_id", "text").collect()
        parts = read_items([tuple(r) for r in rows], settings.shingle)
        if parts:
            found.append(_scan(docs, ImpactIndex(parts), settings))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], MATCHES)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, with all their columns, in which no test item was found; null ids are matched as one id."""
    found = contaminated(docs, benchmark, settings).select(F.col("doc_id").alias("found")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(found, F.col("id").eqNullSafe(F.col("found")), "left_anti").select("row.*")
