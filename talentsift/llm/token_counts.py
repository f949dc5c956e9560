"""Token counts that follow edits.

A document is cut into segments at white space that follows other text. The
pre-token pattern always breaks there, whatever stands further away, so the
counts of segments add up to the count of the document. The counts and
lengths are the leaves of a segment tree per document. An edit descends to
the segments it touches, together with the characters next to it; these are
cut and encoded again, and the sums above them are updated. Nothing else of
the document is read by the encoder. The leaves come back with the counts, so
stored results take the next edits without another encoding.

Special strings of a vocabulary count as the plain text they are spelled in,
unlike in packing, which reads them as one id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import ByteBpe, byte_bpe

TREES = "doc_id bigint, text string, leaf_chars array<int>, leaf_tokens array<int>"
COUNTS = "doc_id bigint, text string, n_tokens_before bigint, n_tokens bigint, n_edits bigint, n_chars bigint, n_reencoded_chars bigint, leaf_chars array<int>, leaf_tokens array<int>"
SEGMENT_CHARS = 192
_CUT = re.compile(r"(?<=[^\s])[ \n]")


def segments(text: str, size: int) -> list[str]:
    """Pieces of about ``size`` characters, cut only where every context cuts; longer where no such place is near."""
    out, start = [], 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    if start < len(text):
        out.append(text[start:])
    return out


class CountTree:
    """Sums of characters and tokens over the segments of one document."""

    def __init__(self, leaves: list[str], tokens: list[int]):
        self.leaves, self.reencoded, self.before = leaves, 0, sum(tokens)
        self._build(tokens)

    def _build(self, tokens: list[int]) -> None:
        self.width = 1 << max(0, len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + len(tokens)] = np.array([[len(x) for x in self.leaves], tokens]).T.reshape(-1, 2)
        at = self.width
        while at > 1:
            self.sums[at // 2 : at] = self.sums[at : 2 * at : 2] + self.sums[at + 1 : 2 * at : 2]
            at //= 2

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the segments, without those that edits have emptied."""
        sums = self.sums[self.width : self.width + len(self.leaves)]
        chars, tokens = sums[sums[:, 0] > 0].T.tolist()
        return chars, tokens

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, char: int) -> tuple[int, int]:
        """The segment that holds a character, and where that segment starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if char >= start + self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.width, start

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.width
        change = np.array([len(text), tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int, length: int, text: str, encoder: ByteBpe, size: int) -> None:
        """Replace ``length`` characters at ``start``; positions outside the text mean its nearest end."""
        end_of_text = self.chars
        start = min(max(start, 0), end_of_text)
        end = min(max(start + length, start), end_of_text)
        if end_of_text == 0:
            first = last = first_at = 0
            old = ""
        else:
            # One character on either side decides whether the cuts around the region still hold.
            first, first_at = self.find(max(0, start - 1))
            last, _ = self.find(min(end, end_of_text - 1))
            old = "".join(self.leaves[first : last + 1])
        new = old[: start - first_at] + text + old[end - first_at :]
        parts = segments(new, size)
        self.reencoded += len(new)
        counts = [len(encoder.ids(part)) for part in parts]
        room = max(1, last - first + 1) if self.leaves else 0
        if len(parts) <= room:
            for k in range(room):
                self._set(first + k, *((parts[k], counts[k]) if k < len(parts) else ("", 0)))
        else:
            tokens = self.sums[self.width : self.width + len(self.leaves), 1].tolist()
            self.leaves[first : last + 1] = parts
            tokens[first : last + 1] = counts
            self._build(tokens)


def build_trees(docs: DataFrame, tokenizer: str, *, size: int = SEGMENT_CHARS) -> DataFrame:
    """``doc_id, text, leaf_chars, leaf_tokens`` of every whole text; a null text is empty and has no leaves."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer, False)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                leaves = [segments(t, size) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(texts, pa.string()),
                        pa.array([[len(x) for x in leaf] for leaf in leaves], pa.list_(pa.int32())),
                        pa.array([[len(encoder.ids(x)) for x in leaf] for leaf in leaves], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "text", "leaf_chars", "leaf_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, TREES)


def apply_edits(trees: DataFrame, tokenizer: str, *, size: int = SEGMENT_CHARS) -> DataFrame:
    """Counts after the edits of a column ``edits`` (array of ``start, length, text``), applied in order.

    Each edit speaks of the text that the one before it left. Null edits and
    null members change nothing; a null replacement is empty. Rows that repeat
    are counted as often as they occur.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer, False)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out: list[tuple] = []
                for doc, text, chars, tokens, edits in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True):
                    ends = np.cumsum([0, *(chars or [])]).tolist()
                    tree = CountTree([text[a:b] for a, b in zip(ends, ends[1:], strict=False)], tokens or [])
                    known = [e for e in edits or [] if e is not None]
                    for e in known:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "", encoder, size)
                    out.append((doc, "".join(tree.leaves), tree.before, tree.tokens, len(known), tree.chars, tree.reencoded, *tree.leaf_sums()))
                kinds = (pa.int64(), pa.string(), *(pa.int64(),) * 5, *(pa.list_(pa.int32()),) * 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["doc_id", "text", "n_tokens_before", "n_tokens", "n_edits", "n_chars", "n_reencoded_chars", "leaf_chars", "leaf_tokens"],
                )

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits").mapInArrow(apply, COUNTS)


EDITS = "array<struct<start:int,length:int,text:string>>"
PERSONAL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\b\d{1,3}(?:\.\d{1,3}){3}\b")


def redactions(trees: DataFrame, pattern: str = PERSONAL.pattern, replacement: str = "[hidden]") -> DataFrame:
    """Add ``edits`` that replace what a pattern finds, last one first so that earlier positions stay valid."""
    found = re.compile(pattern)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            edits = [
                [{"start": m.start(), "length": m.end() - m.start(), "text": replacement} for m in found.finditer(t or "")][::-1]
                for t in texts
            ]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, kind)], names=[*batch.schema.names, "edits"])

    trees = trees.select("doc_id", "text", "leaf_chars", "leaf_tokens")
    return trees.mapInArrow(find, f"{TREES}, edits {EDITS}")
