"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Merges run in rank order. Take a text and any extension of it, and run both.
At first they agree on everything left of where the text ends; this frontier
moves left only when a rule joins the token before it with a token that starts
at it, in one of the two runs. Each such rule ranks above the one before it,
and its right side begins with the token that the earlier rule made (in the
run that merged) or with that rule's left side (in the run that did not). So
the heaviest chain of rules linked in this way, weighed by the bytes of their
left sides, bounds how far the frontier ever moves: the sufficient lookahead
of the merge list. Tokens that end before it are stable whatever follows, and
since neighbours in an encoding are neighbours in every part of it, encoding
may restart behind them. A pre-token of any length therefore passes through a
buffer of a few lookaheads.

The pattern of pre-tokens needs two characters of lookahead. Text comes in
pieces of any size; what is not yet decided is carried, and so is the open end
of a run that exceeds a piece. Decoding carries at most three bytes of an
unfinished character.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import _byte_alphabet

ENCODED = "doc_id bigint, n_tokens bigint, ids binary"
DECODED = f"{ENCODED}, text string"

PIECE_CHARS = 1 << 16  # text is fed to the encoder in pieces of this size
CACHED_CHARS = 40  # longer pre-tokens are not remembered
CACHED_WORDS = 500_000  # pre-tokens that a worker remembers, over all its tasks
BATCH_BYTES = 4 << 20  # results leave a worker in batches of about this size

SHORT_BYTES = 40  # up to here a merge looks through all neighbours, beyond it keeps a heap
_PAIR_BITS, _PLACE_BITS = 24, 24


class Merges:
    """The tables of a tokenizer file: merge rules, byte tokens, special tokens and the sufficient lookahead."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int]):
        alphabet = _byte_alphabet()
        self.special = added
        self.byte_ids = [0] * 256
        self.token_bytes: dict[int, bytes] = {}
        for token, i in {**vocabulary, **added}.items():
            known = all(c in alphabet for c in token)
            self.token_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        for char, byte in alphabet.items():
            if char in vocabulary:
                self.byte_ids[byte] = vocabulary[char]
        rules = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        self.rank = {a << _PAIR_BITS | b: r for r, (a, b, _) in enumerate(rules)}
        self.result = [c for _, _, c in rules]
        self.lookahead = self._lookahead(rules)

    def _lookahead(self, rules: list[tuple[int, int, int]]) -> int:
        """Weight of the heaviest chain; rules come in rank order, so each is final when its turn comes."""
        made: dict[int, int] = {}  # token -> heaviest chain that ends with a rule that makes it or starts with it
        starts: dict[int, set[int]] = {}  # token -> tokens that it may begin with, itself included
        formed = {token: rank for rank, (_, _, token) in reversed(list(enumerate(rules)))}
        heaviest = 0
        for rank, (left, right, token) in enumerate(rules):
            if max(formed.get(left, -1), formed.get(right, -1)) >= rank:
                raise ValueError("a merge rule ranks below one that makes its sides")
            weight = len(self.token_bytes[left]) + max(made.get(t, 0) for t in starts.get(right, {right}))
            for t in (left, token):
                made[t] = max(made.get(t, 0), weight)
            starts.setdefault(token, {token}).update(starts.get(left, {left}))
            heaviest = max(heaviest, weight)
        return heaviest

    def merge(self, data: bytes) -> list[int]:
        """Ids of a whole byte string: the lowest rank first, from the left among equals."""
        byte_ids, rank = self.byte_ids, self.rank
        ids = [byte_ids[b] for b in data]
        n = len(ids)
        if n <= SHORT_BYTES:
            return self._merge_short(ids)
        heap = []
        for i in range(n - 1):
            r = rank.get(ids[i] << _PAIR_BITS | ids[i + 1])
            if r is not None:
                heap.append(r << _PLACE_BITS | i)
        if not heap:
            return ids
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        result, place = self.result, (1 << _PLACE_BITS) - 1
        while heap:
            top = heappop(heap)
            i, r = top & place, top >> _PLACE_BITS
            j = after[i]
            if ids[i] < 0 or j >= n or rank.get(ids[i] << _PAIR_BITS | ids[j]) != r:
                continue  # one of its sides has gone into another token
            ids[i], ids[j] = result[r], -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                r = rank.get(ids[i] << _PAIR_BITS | ids[j])
                if r is not None:
                    heappush(heap, r << _PLACE_BITS | i)
            j = before[i]
            if j >= 0:
                r = rank.get(ids[j] << _PAIR_BITS | ids[i])
                if r is not None:
                    heappush(heap, r << _PLACE_BITS | j)
        return [x for x in ids if x >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        """``merge`` without a heap: a word has few neighbours to look through."""
        rank, result, none = self.rank.get, self.result, len(self.result)
        ranks = [rank(a << _PAIR_BITS | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            ids[i : i + 2] = [result[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << _PAIR_BITS | ids[i], none)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << _PAIR_BITS | ids[i + 1], none)
        return ids


@functools.lru_cache(maxsize=1)
def _remembered(path: str) -> dict[str, bytes]:
    return {}


class Run:
    """The transducer over the bytes of one pre-token."""

    def __init__(self, merges: Merges):
        self.merges, self.pending = merges, b""
        self.room = 4 * merges.lookahead + 64

    def push(self, data: bytes) -> list[int]:
        """Tokens that have become stable."""
        out: list[int] = []
        for at in range(0, len(data), self.room):
            self.pending += data[at : at + self.room]
            if len(self.pending) >= self.room:
                end, stable = 0, len(self.pending) - self.merges.lookahead
                for i in self.merges.merge(self.pending):
                    size = len(self.merges.token_bytes[i])
                    if end + size > stable:
                        break
                    out.append(i)
                    end += size
                self.pending = self.pending[end:]
        return out

    def finish(self) -> list[int]:
        ids, self.pending = self.merges.merge(self.pending), b""
        return ids


@functools.lru_cache(maxsize=4)
def merges_of(path: str) -> Merges:
    """The tables of a ``tokenizers`` file, once per worker process."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
    added = {token["content"]: token["id"] for token in content["added_tokens"]}
    vocabulary = {token: i for token, i in content["model"]["vocab"].items() if token not in added}
    return Merges(vocabulary, rules, added)


def _ranges(chars: list[str]) -> str:
    """Characters in ascending order as ranges of a pattern's set."""
    out: list[list[str]] = []
    for c in chars:
        if out and ord(c) == ord(out[-1][1]) + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{a}-{b}" for a, b in out)


@functools.lru_cache(maxsize=1)
def _classes() -> tuple[str, str]:
    """Letters and numbers as the ``tokenizers`` library knows them.

    Its Unicode version lies between those of Python and of the pattern
    engine. Only code points that the engine knows and Python does not can
    differ, so the library is asked about these.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    newer = [c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, range(0x110000)))) if unicodedata.category(c) == "Cn"]
    splitter = ByteLevel(add_prefix_space=False)
    spans = {begin for _, (begin, _) in splitter.pre_tokenize_str("!".join(f"a{c}1" for c in newer))}
    unknown = _ranges([c for k, c in enumerate(newer) if 4 * k + 1 in spans and 4 * k + 2 in spans])
    return (rf"[\p{{L}}--[{unknown}]]", rf"[\p{{N}}--[{unknown}]]") if unknown else (r"\p{L}", r"\p{N}")


@functools.lru_cache(maxsize=2)
def _patterns(latin: bool) -> tuple[regex.Pattern, dict[str, regex.Pattern]]:
    """The split pattern of byte-level vocabularies (fixed value), and its runs without the leading space."""
    letter, number = (r"\p{L}", r"\p{N}") if latin else _classes()
    other = r"[^\s\p{L}\p{N}]" if latin else rf"[^\s{letter}{number}]"
    whole = rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+"
    runs = {"letter": f"{letter}+", "number": f"{number}+", "other": f"{other}+", "space": r"\s+"}
    return regex.compile(whole, regex.V1), {name: regex.compile(run, regex.V1) for name, run in runs.items()}


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Text pieces to ids, as unsigned 32-bit little-endian bytes, which leave as soon as they are stable."""

    def __init__(self, merges: Merges, words: dict[str, bytes] | None = None):
        self.merges, self.words = merges, {} if words is None else words
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(merges.special, key=len, reverse=True))) if merges.special else None
        self.held = ""  # may become a special token
        self.rest = ""  # pre-tokens that may still change
        self.run: Run | None = None  # an open pre-token longer than a piece
        self.kind = ""

    def push(self, text: str, last: bool = False) -> bytes:
        """Ids that have become stable; all of them when this piece is the last one."""
        if self.special is None:
            return self._segment(text, last)
        text, self.held = self.held + text, ""
        out, at = [], 0
        for hit in self.special.finditer(text):
            out += self._segment(text[at : hit.start()], True), _packed([self.merges.special[hit.group()]])
            at = hit.end()
        end = len(text) if last else self._undecided(text, at)
        self.held = text[end:]
        out.append(self._segment(text[at:end], last))
        return b"".join(out)

    def _undecided(self, text: str, at: int) -> int:
        """Where the longest end of the text that could grow into a special token begins."""
        longest = max(map(len, self.merges.special)) - 1
        for start in range(max(at, len(text) - longest), len(text)):
            if any(s.startswith(text[start:]) for s in self.merges.special):
                return start
        return len(text)

    def _segment(self, text: str, end: bool) -> bytes:
        text = self.rest + text
        out = []
        if self.run is not None:
            text = self._continue(text, end, out)
        if self.run is None:
            whole, runs = _patterns(_is_latin(text))
            pieces = whole.findall(text)
            kept = len(text)
            if not end:
                # A contraction is decided two characters after its quote, a run one character after its end.
                while pieces and kept > len(text) - 2:
                    kept -= len(pieces.pop())
            out.append(self._encode(pieces))
            text = text[kept:]
            if len(text) > max(PIECE_CHARS, 8):  # longer than any contraction
                text = self._open(text, runs, out)
        self.rest = "" if end else text
        return b"".join(out)

    def _open(self, text: str, runs: dict[str, regex.Pattern], out: list[bytes]) -> str:
        """Start an open run at a pre-token that fills a whole piece."""
        at = 1 if text[0] == " " and not runs["space"].match(text, 1) else 0
        self.kind = next(name for name, run in runs.items() if run.match(text, at))
        self.run = Run(self.merges)
        out.append(_packed(self.run.push(text[:at].encode())))
        return self._continue(text[at:], False, out)

    def _continue(self, text: str, end: bool, out: list[bytes]) -> str:
        """Feed what belongs to the open run; what is left over when it has ended."""
        found = _patterns(_is_latin(text))[1][self.kind].match(text)
        stop = found.end() if found else 0
        ended = stop < len(text)
        if self.kind == "space" and (ended or not end):
            stop = max(0, stop - 1)  # the last space goes with what follows it
        for at in range(0, stop, PIECE_CHARS):
            out.append(_packed(self.run.push(text[at : min(stop, at + PIECE_CHARS)].encode())))
        if ended or end:
            out.append(_packed(self.run.finish()))
            self.run = None
        return text[stop:]

    def _encode(self, pieces: list[str]) -> bytes:
        found = list(map(self.words.get, pieces))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._word(pieces[k])
        return b"".join(found)

    def _word(self, piece: str) -> bytes:
        known = self.words.get(piece)
        if known is not None:
            return known
        data = piece.encode()
        if len(data) <= self.merges.lookahead:  # nothing of it is stable before its end
            ids = _packed(self.merges.merge(data))
        else:
            run = Run(self.merges)
            ids = _packed([*run.push(data), *run.finish()])
        if len(piece) <= CACHED_CHARS:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            self.words[piece] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Decoder:
    """Ids to text; the bytes of an unfinished character wait for the next ids.

    The state is what has been read of a character: its lead byte fixes how
    many bytes follow and which second byte is allowed. Bytes that cannot
    belong to a character become U+FFFD, one for each maximal broken start.
    Ids without a token are skipped.
    """

    def __init__(self, merges: Merges):
        self.token_bytes, self.state = merges.token_bytes, b""

    def push(self, ids: bytes, last: bool = False) -> str:
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        data = self.state + b"".join([self.token_bytes.get(i, b"") for i in numbers])
        end = len(data) if last else _finished(data)
        self.state = data[end:]
        return data[:end].decode("utf-8", "replace")


#: Lead bytes whose second byte is restricted, and the range that it must lie in (fixed values of UTF-8).
SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def _finished(data: bytes) -> int:
    """Where the character begins that the last bytes have started and not ended; the length if there is none."""
    for back in range(1, min(3, len(data)) + 1):
        lead = data[-back]
        if lead & 0xC0 == 0x80:
            continue
        size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
        if back >= size:
            break
        low, high = SECOND.get(lead, (0x80, 0xBF))
        if back > 1 and not low <= data[1 - back] <= high:
            break
        return len(data) - back
    return len(data)


def _batches(rows: Iterator[tuple[int, ...]], schema: pa.Schema, weight: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH_BYTES`` of column ``weight``."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[weight]) + 64
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
_DECODED = pa.schema([*_ENCODED, ("text", pa.string())])


def encode_text(text: str, merges: Merges, words: dict[str, bytes] | None = None) -> bytes:
    """Ids of a text, fed to the encoder piece by piece."""
    encoder = Encoder(merges, words)
    out = bytearray()
    for at in range(0, len(text), PIECE_CHARS):
        out += encoder.push(text[at : at + PIECE_CHARS], at + PIECE_CHARS >= len(text))
    return bytes(out)


def decode_ids(ids: bytes, merges: Merges) -> str:
    """Text of ids, fed to the decoder piece by piece."""
    decoder, step = Decoder(merges), 4 * PIECE_CHARS
    return "".join([decoder.push(ids[at : at + step], at + step >= len(ids)) for at in range(0, len(ids), step)])


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every whole text; ``ids`` are unsigned 32-bit little-endian numbers.

    The string of a special token is one id, as the library has it by default.
    A null or empty text has no ids; a null id, repeated rows and ties stay as
    they are, one row each; an empty table gives no rows; other columns, whatever
    their names, are not read. A very long text passes through a buffer of a
    piece and a few lookaheads, and only its ids are held whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, words = merges_of(tokenizer), _remembered(tokenizer)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                    ids = encode_text(text.as_py() or "", merges, words)
                    yield doc.as_py(), len(ids) // 4, ids

        yield from _batches(rows(), _ENCODED, 2)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Rows of ``encode`` with the ``text`` that their ids spell, special tokens included.

    Null and empty ids give an empty text, ids outside the vocabulary give
    nothing, broken characters become U+FFFD as in the library. Repeated rows
    stay; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(tokenizer)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, n, ids in zip(*batch.columns, strict=True):
                    ids = ids.as_py() or b""
                    yield doc.as_py(), n.as_py(), ids, decode_ids(ids, merges)

        yield from _batches(rows(), _DECODED, 2)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, DECODED)
