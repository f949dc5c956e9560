"""Toxic spans by a linear-chain conditional random field over words.

Only whole documents are labelled, so the training tokens get their labels
from words that set toxic documents apart, chosen one after another: each
must explain toxic documents that no earlier one does, which keeps words out
that only come along in copies. A chain is a run of words up to a sentence
end or line break. Its potentials come from the word, its stem, its
neighbours and its length, and from transitions between the labels. Forward-backward gives each
token its marginal; a document scores by a logistic unit over the marginals
of its tokens, and tokens above the threshold make up the offending spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import chunks, mix64, prefix_hash, span_hash, word_spans
from talentsift.llm.labelled import held_out, training_sample

SCORES = "doc_id bigint, score double, n_tokens bigint, spans array<struct<start:bigint,end:bigint>>"
TRAINING_ROWS = 4000
CHAINS_A_ROUND = 40_000  # chains without a toxic token take turns in shares of about this size
THRESHOLD = 0.7
STEMS = (4, 5, 6, 7, 8)
SMALL = 1e-12


@dataclass
class Tokens:
    """Words of several texts in order: hash, text, place of the first and last byte, the chain they belong to, and their stems.

    ``stems`` has a row for each prefix length of ``STEMS``, with the hash of
    the word's first bytes, or 0 where the word is not longer than these.
    """

    word: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    chain: np.ndarray
    stems: np.ndarray

    def where(self, use: np.ndarray) -> Tokens:
        return Tokens(self.word[use], self.text[use], self.start[use], self.end[use], self.chain[use], self.stems[:, use])


def _sentence_ends() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in ".!?\n"]] = True
    return table


def tokens(bodies: list[bytes], lengths: tuple[int, ...] = ()) -> Tokens:
    """Words of some texts, with stems of the given lengths in bytes."""
    data = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, stops = word_spans(data)
    bounds = np.cumsum([0, *(len(b) + 1 for b in bodies)])
    text = np.searchsorted(bounds, starts, side="right") - 1
    ends = np.cumsum(_sentence_ends()[data])
    chain = np.unique(ends[starts], return_inverse=True)[1] if len(starts) else np.empty(0, np.int64)
    sums = prefix_hash(lower)
    stems = np.zeros((len(lengths), len(starts)), np.uint64)
    for row, n in zip(stems, lengths, strict=True):
        longer = stops - starts > n
        row[longer] = mix64(span_hash(sums, starts[longer], starts[longer] + n))
    return Tokens(span_hash(sums, starts, stops), text, starts - bounds[text], stops - bounds[text], chain, stems)


def all_tokens(bodies: list[bytes], lengths: tuple[int, ...] = ()) -> Tokens:
    """``tokens`` of many texts, taken in chunks."""
    parts, chains = [], 0
    for a, b in chunks(bodies):
        t = tokens(bodies[a:b], lengths)
        small = (x.astype(np.int32) for x in (t.text + a, t.start, t.end, t.chain + chains))
        parts.append(Tokens(t.word, *small, t.stems))
        chains += int(t.chain[-1]) + 1 if len(t.chain) else 0
    if not parts:
        return tokens([], lengths)
    columns = ("word", "text", "start", "end", "chain")
    return Tokens(*(np.concatenate([getattr(p, c) for p in parts]) for c in columns), np.concatenate([p.stems for p in parts], axis=1))


def _ratios(odds: np.ndarray, chain: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios of label 1 to label 0; ``pair[i, j]`` is the potential of label i before j.

    Chains advance together, longest first, so step t works on the t-th token
    of all chains that have one.
    """
    forward, backward = np.empty(len(odds)), np.ones(len(odds))
    if not len(odds):
        return forward, backward
    first = np.flatnonzero(np.diff(chain, prepend=-1))
    size = np.diff(np.append(first, len(odds)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    forward[first] = odds[first]
    for t in range(1, size[0]):
        at = first[: alive[t]] + t
        r = forward[at - 1]
        forward[at] = odds[at] * (pair[0, 1] + r * pair[1, 1]) / (pair[0, 0] + r * pair[1, 0])
    for t in range(size[0] - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        b = odds[at + 1] * backward[at + 1]
        backward[at] = (pair[1, 0] + pair[1, 1] * b) / (pair[0, 0] + pair[0, 1] * b)
    return forward, backward


def lexicon(words: list[np.ndarray], labels: np.ndarray, *, purity: float = 0.6, margin: float = 3.0) -> np.ndarray:
    """Words and stems that tell toxic texts, each judged on the toxic texts that earlier ones leave.

    One counts when at least ``purity`` of its texts are toxic and when its
    share of toxic texts is too large for chance, given how many words are
    looked at: its divergence from the base rate must exceed the logarithm of
    the vocabulary by ``margin``.
    """
    toxic = np.flatnonzero(labels == 1)
    if not len(toxic):
        return np.empty(0, np.uint64)
    distinct = [np.unique(w) for w in words]
    vocabulary, where = np.unique(np.concatenate([distinct[k] for k in toxic]), return_inverse=True)
    owner = np.repeat(toxic, [len(distinct[k]) for k in toxic])
    clean = np.zeros(len(vocabulary))
    for k in np.flatnonzero(labels == 0):
        at = np.searchsorted(vocabulary, distinct[k]).clip(max=len(vocabulary) - 1)
        np.add.at(clean, at[vocabulary[at] == distinct[k]], 1)
    n_clean = int((labels == 0).sum())
    chosen, left = [], labels == 1
    while left.any() and len(vocabulary):
        base = left.sum() / (left.sum() + n_clean + 1)
        gain = np.bincount(where, weights=left[owner], minlength=len(vocabulary))
        share = (gain / np.maximum(gain + clean, 1)).clip(1e-9, 1 - 1e-9)
        evidence = (gain + clean) * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
        gain[(share < purity) | (evidence < np.log(len(vocabulary)) + margin)] = 0
        best = int(np.argmax(gain))
        if gain[best] == 0:
            break
        chosen.append(best)
        left[owner[where == best]] = False
    return np.sort(vocabulary[chosen])


@dataclass
class SpanModel:
    """Weights of known words in three places, of told stems, of word lengths and of transitions; then of the document score."""

    vocabulary: np.ndarray
    told: np.ndarray
    lengths: tuple[int, ...]
    here: np.ndarray
    before: np.ndarray
    after: np.ndarray
    stem: np.ndarray
    length: np.ndarray
    bias: float
    pair: np.ndarray
    document: np.ndarray

    def stem_place(self, t: Tokens) -> np.ndarray:
        """Place in ``told`` of the longest stem of each word that is there; the last place means none."""
        out = np.full(len(t.word), len(self.told))
        for row in t.stems:
            at = np.searchsorted(self.told, row).clip(max=max(0, len(self.told) - 1))
            hit = (self.told[at] == row) if len(self.told) else np.zeros(len(row), bool)
            out[hit] = at[hit]
        return out

    def features(self, t: Tokens) -> dict[str, np.ndarray]:
        """Vocabulary places of each word and of its neighbours in the chain (the last place means unknown), stem and length."""
        none = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, t.word)
        known = at < none
        known[known] = self.vocabulary[at[known]] == t.word[known]
        at = np.where(known, at, none)
        before, after = np.full(len(at), none), np.full(len(at), none)
        same = t.chain[1:] == t.chain[:-1]
        before[1:][same] = at[:-1][same]
        after[:-1][same] = at[1:][same]
        return {"here": at, "before": before, "after": after, "stem": self.stem_place(t), "length": np.minimum(t.end - t.start, 15)}

    def odds(self, places: dict[str, np.ndarray]) -> np.ndarray:
        return np.exp(np.clip(self.bias + sum(getattr(self, k)[at] for k, at in places.items()), -30, 30))

    def marginals(self, t: Tokens) -> np.ndarray:
        forward, backward = _ratios(self.odds(self.features(t)), t.chain, np.exp(self.pair))
        both = np.clip(forward * backward, 1e-30, 1e30)
        return both / (1 + both)

    def document_features(self, marginal: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        top = np.full(texts, SMALL)
        np.maximum.at(top, text, marginal)
        surely = np.bincount(text, weights=marginal * (marginal > 0.5), minlength=texts)
        top = top.clip(SMALL, 1 - 1e-9)
        share = surely / np.maximum(np.bincount(text, minlength=texts), 1)
        return np.stack([np.ones(texts), np.log(top / (1 - top)) / 3, np.log1p(surely), np.log1p(1000 * share)], axis=1)

    def scores(self, marginal: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.document_features(marginal, text, texts) @ self.document, -40, 40)))


def train(samples: list[tuple[str, int]], *, rounds: int = 40, least_df: int = 5) -> SpanModel:
    """Fit the field by gradient steps on its likelihood, then the document unit; no toxic texts give a model that finds none."""
    labels = np.array([y for _, y in samples])
    t = all_tokens([s.encode() for s, _ in samples], STEMS)
    bounds = np.searchsorted(t.text, np.arange(len(samples) + 1))
    spans = list(zip(bounds, bounds[1:], strict=False))
    told = lexicon([np.unique(np.concatenate([t.word[a:b], t.stems[:, a:b].ravel()])) for a, b in spans], labels)
    told = told[told != 0]
    stem_rows = np.stack([np.isin(row, told) for row in t.stems])
    lengths = tuple(n for n, row in zip(STEMS, stem_rows, strict=True) if row.any())
    t.stems = t.stems[stem_rows.any(axis=1)]
    truth = (np.isin(t.word, told) | stem_rows.any(axis=0)) & (labels[t.text] == 1) if len(t.word) else np.zeros(0, bool)
    # Chains with a toxic token teach in every round; the others take turns, so that all of them teach and a round stays small.
    chains = np.bincount(t.chain, weights=truth) > 0 if len(t.chain) else np.zeros(0, bool)
    shares = max(1, len(chains) // CHAINS_A_ROUND)
    vocabulary, df = np.unique(np.concatenate([np.unique(t.word[a:b]) for a, b in spans]) if spans else np.empty(0, np.uint64), return_counts=True)
    vocabulary = vocabulary[df >= least_df]
    n = len(vocabulary) + 1
    zeros = {"here": np.zeros(n), "before": np.zeros(n), "after": np.zeros(n), "stem": np.zeros(len(told) + 1), "length": np.zeros(16)}
    model = SpanModel(vocabulary, told, lengths, **zeros, bias=-4.0, pair=np.zeros((2, 2)), document=np.array([-4.0, 0.0, 0.0, 0.0]))
    if not truth.any():
        return model
    step = {k: np.zeros_like(v) for k, v in zeros.items()} | {"bias": 0.0, "pair": np.zeros((2, 2))}
    square = {k: np.zeros_like(v) for k, v in step.items()}
    for turn in range(1, max(rounds, shares) + 1):
        if shares > 1 or turn == 1:
            use = (chains | (np.arange(len(chains)) % shares == turn % shares))[t.chain]
            t_used, y = t.where(use), truth[use].astype(np.float64)
            parts = model.features(t_used)
            linked = np.flatnonzero(t_used.chain[1:] == t_used.chain[:-1])
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[linked].astype(int), y[linked + 1].astype(int)), 1)
        odds, pair = model.odds(parts), np.exp(model.pair)
        forward, backward = _ratios(odds, t_used.chain, pair)
        both = np.clip(forward * backward, 1e-30, 1e30)
        error = y - both / (1 + both)
        r, b = forward[linked], odds[linked + 1] * backward[linked + 1]
        cells = np.stack([np.full(len(r), pair[0, 0]), pair[0, 1] * b, pair[1, 0] * r, pair[1, 1] * r * b])
        expected = (cells / cells.sum(axis=0)).sum(axis=1).reshape(2, 2)
        gradient = {k: np.bincount(where, weights=error, minlength=len(getattr(model, k))) for k, where in parts.items()}
        gradient |= {"bias": error.sum(), "pair": seen - expected}
        for k, g in gradient.items():
            decay = 2.0 if k in ("before", "after") else 0.05
            g = g - decay * getattr(model, k)
            step[k] = 0.9 * step[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            change = 0.5 * (step[k] / (1 - 0.9**turn)) / (np.sqrt(square[k] / (1 - 0.99**turn)) + 1e-3)
            setattr(model, k, getattr(model, k) + change)
    x = model.document_features(model.marginals(t), t.text, len(samples))
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, np.where(labels == 1, -1, 1) * (x @ w)).sum() + 0.05 * w @ w)

    for _ in range(30):  # Newton steps on the penalised logistic likelihood, halved while they overshoot
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (labels - p) - 0.1 * w)
        while loss(w + move) > loss(w) and np.abs(move).max() > 1e-6:
            move = move / 2
        w = w + move
    model.document = w
    return model


def score(docs: DataFrame, model: SpanModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, n_tokens, spans``: ``spans`` are byte ranges of neighbouring tokens above the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words of a bounded sample

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for at, end in chunks(bodies):
                t = tokens(bodies[at:end], held.lengths)
                marginal = held.marginals(t)
                scores = held.scores(marginal, t.text, end - at)
                spans: list[list[dict]] = [[] for _ in range(end - at)]
                previous = -2
                for k in np.flatnonzero(marginal >= threshold).tolist():
                    own = spans[t.text[k]]
                    if k == previous + 1 and own and t.chain[k] == t.chain[previous]:
                        own[-1]["end"] = int(t.end[k])
                    else:
                        own.append({"start": int(t.start[k]), "end": int(t.end[k])})
                    previous = k
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                counts = np.bincount(t.text, minlength=end - at).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(scores), pa.array(counts), pa.array(spans, kind)],
                    names=["doc_id", "score", "n_tokens", "spans"],
                )

    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body).mapInArrow(scan, SCORES)


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` with token count and offending spans, for every row of ``docs``.

    ``rows`` bounds the labelled texts the model learns from. A null text is
    empty; a text without words scores as one without any toxic token. Rows that repeat
    score alike; other columns are ignored.
    """
    model = train(training_sample(docs, labels, "toxic", rows))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_tokens",
        "spans",
    )
