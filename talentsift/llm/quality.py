"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Each passage is
encoded from its characters and words; gated attention, tanh(Vh) * sigmoid(Uh)
scored by a vector w, weighs the passages, and a logistic unit scores the
weighted sum of their representations. All parts are learned together from
document labels. Scores depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import chunks, prefix_hash, span_hash, word_spans
from talentsift.llm.labelled import held_out, training_sample

SCORES = "doc_id bigint, score double, passages bigint, top_passage bigint, top_weight double"
TRAINING_ROWS = 3000
PASSAGE_BYTES = 512
HIDDEN, GATE = 24, 12
EXTRA = 8


def passages(bodies: list[bytes], size: int = PASSAGE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and the index of its document; an empty text is one passage of zeros.

    A passage is ``size`` bytes, the last one what is left. Features are shares
    of each ASCII character and of all others, and shares of repeated, doubled,
    capital and long words.
    """
    lengths = np.array([len(b) for b in bodies])
    counts = np.maximum(1, -(-lengths // size))
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(bodies)), counts)
    total = int(counts.sum())
    data = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(bodies)), lengths)
    cell = first[doc] + (np.arange(len(data)) - (ends - lengths)[doc]) // size
    folded = np.minimum(data, 128).astype(np.int64)
    chars = np.bincount(cell * 129 + folded, minlength=total * 129).reshape(total, 129).astype(np.float64)
    n_chars = np.maximum(chars.sum(axis=1), 1)

    starts, stops = word_spans(data)
    inside = np.searchsorted(ends, starts, side="right") == np.searchsorted(ends, stops - 1, side="right")
    starts, stops = starts[inside], stops[inside]
    extra = np.zeros((total, EXTRA))
    if len(starts):
        where = cell[starts]
        words = span_hash(prefix_hash(data), starts, stops)
        n_words = np.maximum(np.bincount(where, minlength=total), 1)
        order = np.lexsort((words, where))
        w, h = where[order], words[order]
        again = np.zeros(len(w), bool)
        again[1:] = (w[1:] == w[:-1]) & (h[1:] == h[:-1])
        doubled = np.zeros(len(words), bool)
        doubled[1:] = (words[1:] == words[:-1]) & (where[1:] == where[:-1])
        capital = (data[starts] >= 65) & (data[starts] <= 90)
        size_of = stops - starts
        for k, weight in enumerate((doubled, capital, size_of > 12, size_of <= 2)):
            extra[:, k] = np.bincount(where, weights=weight, minlength=total) / n_words
        extra[:, 4] = np.bincount(w, weights=again, minlength=total) / n_words
        extra[:, 5] = np.bincount(where, weights=size_of, minlength=total) / n_words / 10
        extra[:, 6] = n_words / n_chars
    extra[:, 7] = np.log1p(chars.sum(axis=1)) / np.log1p(size)
    return np.hstack([np.sqrt(chars / n_chars[:, None]), extra]), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and classifier; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float | None = None

    def forward(self, x: np.ndarray, owner: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        p = self.weights
        x = (x - self.mean) / self.scale
        h = np.maximum(x @ p["E"] + p["e"], 0)
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        begin = np.searchsorted(owner, np.arange(bags))
        raw = (v * u) @ p["w"]
        raw = np.exp(raw - np.maximum.reduceat(raw, begin)[owner])
        a = raw / np.add.reduceat(raw, begin)[owner]
        z = np.add.reduceat(h * a[:, None], begin, axis=0)
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "score": _sigmoid(z @ p["c"] + p["b"]), "begin": begin}

    def score(self, x: np.ndarray, owner: np.ndarray, bags: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.prior is not None:
            return np.full(bags, self.prior), np.ones(len(owner)), np.searchsorted(owner, np.arange(bags))
        out = self.forward(x, owner, bags)
        return out["score"], out["a"], out["begin"]

    def gradients(self, x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, o = self.weights, self.forward(x, owner, len(y))
        d = (o["score"] - y) / len(y)
        g = {"c": o["z"].T @ d, "b": np.array([d.sum()])}
        dz = (d[:, None] * p["c"])[owner]
        da = (dz * o["h"]).sum(axis=1)
        dr = o["a"] * (da - np.add.reduceat(da * o["a"], o["begin"])[owner])
        g["w"] = (o["v"] * o["u"]).T @ dr
        dvu = dr[:, None] * p["w"]
        dv, du = dvu * o["u"] * (1 - o["v"] ** 2), dvu * o["v"] * o["u"] * (1 - o["u"])
        g["V"], g["U"] = o["h"].T @ dv, o["h"].T @ du
        dh = (dz * o["a"][:, None] + dv @ p["V"].T + du @ p["U"].T) * (o["h"] > 0)
        g["E"], g["e"] = o["x"].T @ dh, dh.sum(axis=0)
        return g


def train(texts: list[tuple[str, int]], *, epochs: int = 30, batch: int = 128, seed: int = 7) -> AttentionModel:
    """Fit the model to (text, label). Without labels, or with one kind only, every score is their share (0.5 if none)."""
    labels = np.array([y for _, y in texts], np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        return AttentionModel(np.zeros(1), np.ones(1), {}, prior=float(labels.mean()) if len(labels) else 0.5)
    bodies = [t.encode() for t, _ in texts]
    parts = [(*passages(bodies[a:b]), a) for a, b in chunks(bodies)]
    x, owner = np.concatenate([x for x, _, _ in parts]), np.concatenate([o + a for _, o, a in parts])
    model = AttentionModel(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), {})
    rng = np.random.default_rng(seed)
    draw = lambda n, m: rng.normal(0, np.sqrt(1 / n), (n, m))
    model.weights = {
        "E": draw(x.shape[1], HIDDEN), "e": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE),
        "w": rng.normal(0, 0.1, GATE), "c": rng.normal(0, 0.1, HIDDEN), "b": np.zeros(1),
    }
    begin = np.searchsorted(owner, np.arange(len(labels) + 1))
    m = {k: np.zeros_like(v) for k, v in model.weights.items()}
    s = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = begin[chosen + 1] - begin[chosen]
            rows = np.repeat(begin[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            g = model.gradients(x[rows], np.repeat(np.arange(len(chosen)), sizes), labels[chosen])
            step += 1
            for k, v in model.weights.items():  # Adam with a little weight decay
                grad = g[k] + (1e-4 * v if v.ndim == 2 else 0)
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad**2
                v -= 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return model


def score(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``doc_id, score`` of every whole text, with its passage of most attention."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for at, end in chunks(bodies):
                x, owner = passages(bodies[at:end])
                scores, weight, begin = model.score(x, owner, end - at)
                counts = np.diff(np.append(begin, len(owner)))
                top = [int(np.argmax(weight[b : b + n])) for b, n in zip(begin, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(scores), pa.array(counts), pa.array(top), pa.array(weight[begin + np.array(top)])],
                    names=["doc_id", "score", "passages", "top_passage", "top_weight"],
                )

    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body).mapInArrow(scan, SCORES)


def quality_scores(docs: DataFrame, labels: DataFrame, *, rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the passage that weighed most, for every row of ``docs``.

    ``rows`` bounds the labelled texts the model learns from. A null text is
    empty and scores as one passage without characters; rows that repeat score alike; other columns
    are ignored.
    """
    scored = score(docs, train(training_sample(docs, labels, "quality", rows)))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
        "top_passage",
        "top_weight",
    )


def drop_rejected(docs: DataFrame, labels: DataFrame, *, rows: int = TRAINING_ROWS) -> DataFrame:
    """The documents, with all their columns, that score at least 0.5."""
    model = train(training_sample(docs, labels, "quality", rows))

    @F.pandas_udf("double")
    def quality(text):
        bodies = [t.encode() for t in text.fillna("")]
        out = np.empty(len(bodies))
        for at, end in chunks(bodies):
            out[at:end] = model.score(*passages(bodies[at:end]), end - at)[0]
        return type(text)(out)

    rows = docs.select(F.struct(*docs.columns).alias("row"), quality("text").alias("quality"))
    return rows.where(F.col("quality") >= 0.5).select("row.*")
