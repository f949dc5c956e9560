from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from talentsift.llm import quality, toxicity
from talentsift.llm.labelled import training_sample
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.mark.parametrize(("operator", "label", "least", "cut"), [(quality.quality_scores, "quality", 0.97, 0.5), (toxicity.toxicity_scores, "toxic", 0.9, 0.7)])
def test_held_out_accuracy_and_columns(tables, operator, label, least, cut):
    docs, labels = tables
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    rows = operator(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    judged = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(judged) / len(judged) >= least


@pytest.mark.parametrize("operator", [quality.quality_scores, toxicity.toxicity_scores])
def test_held_out_labels_ids_and_other_columns_do_not_matter(spark, tables, operator):
    docs, labels = tables
    small, some = docs.limit(120), labels.limit(200)
    score = lambda d, l: {r["doc_id"]: round(r["score"], 12) for r in operator(d, l).collect()}
    flipped = some.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) toxic")
    first = score(small, some)
    assert first == score(small, flipped)
    assert first == score(small.selectExpr("doc_id", "text", "'zz' lang", "'other' source", "1 score", "2 predicted", "3 y"), some)


@pytest.mark.parametrize(("operator", "label"), [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_odd_documents_and_labels(spark, make_docs, operator, label):
    frame = make_docs(ODD, "score", "held_out", "spans", "y")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0), (5, 1), (6, 1), (6, 0)], f"doc_id bigint, {label} int")
    rows = operator(frame, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["doc_id"] is None and rows[0]["held_out"] is False
    none = spark.createDataFrame([], f"doc_id bigint, {label} int")
    assert operator(frame, none).count() == len(ODD)
    assert operator(make_docs([]), labels).count() == 0
    one_kind = spark.createDataFrame([(i, 1) for i in range(10)], f"doc_id bigint, {label} int")
    assert all(0 <= r["score"] <= 1 for r in operator(frame, one_kind).collect())


def test_sample_is_bounded_repeatable_and_leaves_out_what_teaches_nothing(spark, make_docs):
    docs = make_docs([(i, f"text {i % 700}") for i in range(2000)])
    labels = spark.createDataFrame([(i, int(i % 700 % 2)) for i in range(2000)], "doc_id bigint, quality int")
    sample = training_sample(docs, labels, "quality", 300)
    assert sample == training_sample(docs, labels, "quality", 300) and 150 < len(sample) < 400
    assert len({t for t, _ in sample}) == len(sample) and all(int(t.split()[1]) % 2 == y for t, y in sample)


def test_quality_passages_count_characters():
    x, owner = quality.passages([b"", b"a" * 600, "é!".encode()], 512)
    assert owner.tolist() == [0, 1, 1, 2] and not x[0].any() and x[1][97] == 1.0
    assert np.isclose(x[3][128] ** 2, 2 / 3)


def test_gradients_of_the_attention_model_match_differences():
    texts = [("good words here. " * 60, 1), ("bad### bad### " * 50, 0), ("other fine text", 1), ("###", 0)]
    model = quality.train(texts, epochs=1)
    x, owner = quality.passages([t.encode() for t, _ in texts])
    y = np.array([float(v) for _, v in texts])

    def loss():
        p = model.forward(x, owner, len(y))["score"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    gradient = model.gradients(x, owner, y)
    for name, weights in model.weights.items():
        at = tuple(np.unravel_index(np.argmax(np.abs(gradient[name])), weights.shape))
        before = weights[at]
        weights[at] = before + 1e-6
        up = loss()
        weights[at] = before - 1e-6
        down = loss()
        weights[at] = before
        assert np.isclose((up - down) / 2e-6, gradient[name][at], rtol=1e-3, atol=1e-7)


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(1)
    sizes = [1, 4, 2, 7]
    chain = np.repeat(np.arange(4), sizes)
    odds, pair = np.exp(r.normal(0, 2, len(chain))), np.exp(r.normal(0, 1, (2, 2)))
    forward, backward = toxicity._ratios(odds, chain, pair)
    got = forward * backward / (1 + forward * backward)
    for c, size in enumerate(sizes):
        at = np.flatnonzero(chain == c)
        total, on = 0.0, np.zeros(size)
        for labels in itertools.product((0, 1), repeat=size):
            w = np.prod([odds[i] ** y for i, y in zip(at, labels, strict=True)]) * np.prod([pair[a, b] for a, b in zip(labels, labels[1:], strict=False)])
            total += w
            on += w * np.array(labels)
        assert np.allclose(got[at], on / total)


def test_spans_point_at_toxic_words(spark, make_docs):
    filler = [f"plain words number {k} stand here quite calm." for k in range(120)]
    docs = make_docs([(k, f + (" What an awful grumpf you are." if k % 3 == 0 else " All is well.")) for k, f in enumerate(filler)])
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)], "doc_id bigint, toxic int")
    for row in toxicity.toxicity_scores(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = row["text"].encode()
        assert row["predicted"] == int(row["doc_id"] % 3 == 0)
        for span in row["spans"]:
            assert text[span["start"] : span["end"]].decode().lower() in "what an awful grumpf you are"
        assert bool(row["spans"]) == (row["doc_id"] % 3 == 0)
