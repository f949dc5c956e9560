"""Spelling variants: words one edit apart, found by composing the vocabulary's acceptor with a one-edit transducer.

A pair of words one edit apart, the shorter of length ``s``, has its edit in
one of the consecutive windows of positions that ``0..s`` is cut into. Before
the window and behind it the two words are equal. So every word stands once
for each window and each role (shorter or equal, longer) under a key of these
equal ends. A key names an initial state of the composed machine: what is
accepted from there are the middles of the words that share the ends. Each
partition of keys builds the minimised acceptor of a key's middles, composes
it with the transducer and with itself, and enumerates what the machine
accepts. The first difference of a pair lies in exactly one window, so each
pair is enumerated once.

Keys with more than ``CROWDED`` words are cut again into half as wide windows,
down to windows of one position, where a key holds two characters of middle at
most. So no group grows beyond what one task can hold, whatever the words are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import forget, stored

RUN, ANY_CASE = re.compile("[a-zÀ-ÿ]+"), re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT = 5, 3
CROWDED = 20_000  # words under one key before its window is halved
HELD_WORDS = 400_000  # distinct words that a task counts before it hands them on
SLICE = 1 << 20  # characters of a text that are searched at once
REMEMBERED_CHARS = 4096  # longer results of the composition are computed again when needed

WORDS = "word string, n bigint"
PAIRS = "word string, n bigint, near string, near_n bigint"
SUMMARIES = "word string, n_near bigint, less bigint, near string"


def runs_of(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of a text, some at a time; only A to Z change case."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        part = text[at:end].encode().lower().decode()
        found = RUN.findall(part)
        if end < len(text) and found and part.endswith(found[-1]):
            if len(found[-1]) == len(part):  # a run longer than a slice
                end = ANY_CASE.match(text, at).end()
                yield [text[at:end].encode().lower().decode()]
                at = end
                continue
            end -= len(found.pop())
        yield found
        at = end


def noisy(word: str, seed: int, every: int) -> str:
    """The word, without one of its code points when ``every`` divides its crc32 after ``seed``."""
    h = zlib.crc32(word.encode(), seed)
    if h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def word_counts(docs: DataFrame, *, every: int = 97, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` over all whole texts, after the planted deletions.

    A task counts what its documents hold before anything is shuffled, so a
    word that makes up a third of all text is a few rows per task. A null text
    has no words, a null id reads as an empty one, rows that repeat count as
    often as they occur, a text of any length is searched slice by slice.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                own: Counter[str] = Counter()
                for found in runs_of(text.as_py() or ""):
                    own.update(found)
                seed = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for word, n in own.items():
                    word = noisy(word, seed, every)
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield flush()
        if total:
            yield flush()

    counted = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(count, WORDS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Acceptor:
    """The minimal deterministic acceptor of sorted distinct strings; states with equal futures are one."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.size: list[int] = []  # strings accepted from a state
        known: dict[tuple, int] = {}
        path: list[tuple[str, dict[str, int]]] = []
        ends: list[bool] = [False]
        open_arcs: list[dict[str, int]] = [{}]

        def close(depth: int) -> None:
            while len(open_arcs) > depth + 1:
                arcs, final = open_arcs.pop(), ends.pop()
                open_arcs[-1][path.pop()[0]] = self._state(known, arcs, final)

        before = ""
        for word in words:
            shared = 0
            while shared < min(len(before), len(word)) and before[shared] == word[shared]:
                shared += 1
            close(shared)
            for char in word[shared:]:
                path.append((char, open_arcs[-1]))
                open_arcs.append({})
                ends.append(False)
            ends[-1] = True
            before = word
        close(0)
        self.start = self._state(known, open_arcs[0], ends[0])
        self._shared: dict[tuple[int, int], list[str]] = {}

    def _state(self, known: dict[tuple, int], arcs: dict[str, int], final: bool) -> int:
        key = (final, tuple(arcs.items()))
        if key not in known:
            known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
            self.size.append(final + sum(self.size[q] for q in arcs.values()))
        return known[key]

    def only(self, q: int) -> str:
        """The string of a state that accepts one."""
        out = []
        while not self.final[q]:
            ((char, q),) = self.arcs[q].items()
            out.append(char)
        return "".join(out)

    def accepts(self, q: int, string: str) -> bool:
        for char in string:
            q = self.arcs[q].get(char, -1)
            if q < 0:
                return False
        return self.final[q]

    def shared(self, p: int, q: int) -> list[str]:
        """Strings accepted from both states: the composed machine behind its edit, where both sides read the same."""
        key = (p, q) if p <= q else (q, p)
        if key in self._shared:
            return self._shared[key]
        out: list[str] = []
        todo = [(p, q, "")]
        while todo:
            x, y, read = todo.pop()
            if self.size[y] < self.size[x]:
                x, y = y, x
            if self.size[x] == 1:
                rest = self.only(x)
                if self.accepts(y, rest):
                    out.append(read + rest)
                continue
            if self.final[x] and self.final[y]:
                out.append(read)
            others = self.arcs[y]
            todo += [(z, others[char], read + char) for char, z in self.arcs[x].items() if char in others]
        if sum(map(len, out)) < REMEMBERED_CHARS:
            self._shared[key] = out
        return out

    def one_edit_pairs(self, at_end: bool) -> Iterator[tuple[str, str]]:
        """Accepted pairs whose first difference is the edit: ``(x, y)`` of equal length, or ``y`` one longer.

        An insertion behind the last character counts only ``at_end``.
        """
        todo = [(self.start, "")]
        while todo:
            q, head = todo.pop()
            arcs = list(self.arcs[q].items())
            for k, (a, p) in enumerate(arcs):
                if self.size[p] > 1:
                    todo.append((p, head + a))
                for b, r in arcs[k + 1 :]:  # replaced: a on one side, b on the other
                    for rest in self.shared(p, r):
                        yield head + a + rest, head + b + rest
                if at_end and self.final[q] and self.final[p]:  # inserted at the end
                    yield head, head + a
                for c, r in arcs:  # inserted: a on one side, after which both sides read c
                    if c != a and c in self.arcs[p]:
                        for rest in self.shared(r, self.arcs[p][c]):
                            yield head + c + rest, head + a + c + rest


KEY = ["s", "lo", "hi", "head", "tail"]


def _halves(lo: Column, hi: Column) -> Column:
    """A window of positions cut in two; the first half of a window of one position is empty."""
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def _under_keys(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Rows ``word, n, s`` under the keys of both halves of their window."""
    cut = rows.withColumn("window", F.explode(_halves(lo, hi))).select("word", "n", "s", "window.lo", "window.hi").where("lo < hi")
    behind = F.col("s") - F.col("hi")
    head = F.substring("word", F.lit(1), F.col("lo"))
    tail = F.substring("word", F.length("word") - behind + 1, behind)
    return cut.select("s", "lo", "hi", head.alias("head"), tail.alias("tail"), "word", "n")


def keyed(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Each word under its keys; a key of over ``crowded`` words is cut while its window is wider than one position."""
    length = F.length("word").cast("int")
    roles = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("s")).where("s > 0")
    rows = _under_keys(roles, F.lit(0), F.col("s"))
    done = []
    while True:
        ends = F.xxhash64(*KEY)
        sizes = rows.groupBy(ends.alias("ends")).agg(F.count(F.lit(1)).alias("words"), F.max(F.col("hi") - F.col("lo")).alias("width"))
        full = stored(sizes.where((F.col("words") > crowded) & (F.col("width") > 1)).select("ends"), "crowded")
        if full.isEmpty():
            forget(full)
            break
        marked = rows.withColumn("ends", ends)
        # Two keys of one hash may come here together; a window of one position among them stays as it is.
        done.append(marked.join(full, "ends", "left_anti").drop("ends"))
        again = marked.join(full, "ends", "left_semi").drop("ends")
        done.append(again.where("hi - lo = 1"))
        again = again.where("hi - lo > 1")
        rows = stored(_under_keys(again, F.col("lo"), F.col("hi")), "narrower")
    for part in done:
        rows = rows.unionByName(part)
    return rows


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, int]]]:
    """Words with counts of each key, from rows sorted by key."""
    key, words = None, {}
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if row[:5] != key:
                if len(words) > 1:
                    yield key, words
                key, words = row[:5], {}
            words[row[5]] = row[6]
    if len(words) > 1:
        yield key, words


def _pairs(key: tuple, words: dict[str, int]) -> Iterator[tuple[str, str]]:
    """Pairs of one key: the shorter or equal word first."""
    s, lo, hi, head, tail = key
    middles = sorted(word[lo : len(word) - (s - hi)] for word in words)
    for x, y in Acceptor(middles).one_edit_pairs(hi == s):
        if len(x) == hi - lo:  # pairs of two longer words belong to the keys of their own length
            yield head + x + tail, head + y + tail


def _composed(words: DataFrame, crowded: int) -> DataFrame:
    return keyed(words, crowded).repartition(*KEY).sortWithinPartitions(*KEY)


def near_words(words: DataFrame, *, crowded: int = CROWDED) -> DataFrame:
    """``word, n, near, near_n``: every pair of words ``(word, n)`` one edit apart, the shorter or smaller one first.

    Words are taken as distinct; null words have no neighbours. An empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, known in _groups(batches):
            out = [(x, known[x], y, known[y]) for x, y in _pairs(key, known)]
            if out:
                yield _batch(out, PAIRS)

    return _composed(words, crowded).mapInArrow(run, PAIRS)


def neighbours(words: DataFrame, *, crowded: int = CROWDED) -> DataFrame:
    """``word, n_near, form_n, form``: how many words are one edit away, and the commonest of them.

    A partition sums up its pairs by word before they are shuffled. Ties go to
    the word that comes first in code-point order. Words without a neighbour
    give no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, known in _groups(batches):
            best: dict[str, tuple[int, int, str]] = {}
            for x, y in _pairs(key, known):
                for word, near in ((x, y), (y, x)):
                    count, n, form = best.get(word, (0, 0, ""))
                    if (-known[near], near) < (n, form):
                        n, form = -known[near], near
                    best[word] = (count + 1, n, form)
            if best:
                yield _batch([(word, *rest) for word, rest in best.items()], SUMMARIES)

    parts = _composed(words, crowded).mapInArrow(run, SUMMARIES)
    summed = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "near")).alias("best"))
    return summed.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.near").alias("form"))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)], names=[name for name, _ in fields]
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``: the last word on the way from form to form.

    Each round doubles the steps taken. A form is at least twice as common as
    its word, so a way has fewer than 64 steps and six rounds are enough.
    """
    links = stored(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = links.join(ahead, "root", "left")
        moved = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "links")
        forget(links)
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, *, every: int = 97, crowded: int = CROWDED) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of at least 5 code points that occurs 3 times.

    ``form`` is the commonest word one edit away, if it is at least twice as
    common as the word. A table without such words gives no rows; documents
    with null ids or texts, repeats, and very long texts count as in
    ``word_counts``; columns other than ``doc_id`` and ``text`` are not read.
    """
    words = stored(word_counts(docs, every=every), "words")
    near = words.join(neighbours(words, crowded=crowded), "word", "left")
    twice = F.col("form_n") >= 2 * F.col("n")
    judged = stored(
        near.select(
            "word",
            F.when(twice, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(twice, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    forget(words)
    last = judged.join(roots(judged), "word", "left")
    return last.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
