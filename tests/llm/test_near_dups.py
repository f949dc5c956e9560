from __future__ import annotations

import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from talentsift.llm import near_dups
from talentsift.llm.graph import components
from tests.llm.conftest import ODD


def shingle_set(text):
    words = re.findall(rb"[0-9a-z_\x80-\xff]+", (text or "").lower().encode())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute(rows):
    sets, joined, texts = [shingle_set(t) for _, t in rows], Union(), {}
    for k, (i, t) in enumerate(rows):
        joined.find(i)
        joined.join(i, texts.setdefault(t or "", i))
        for j in range(k):
            both = len(sets[k] & sets[j])
            if both and both / (len(sets[k]) + len(sets[j]) - both) >= 0.8:
                joined.join(i, rows[j][0])
    return {i: joined.find(i) for i, _ in rows}


def edited(r, words, share):
    return [f"new{r.randrange(10**6)}" if r.random() < share else w for w in words]


def star(r, first, size):
    """A text and copies of it of which about half are near enough to it, few to each other."""
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    return [(first, " ".join(base))] + [(first + k, " ".join(edited(r, base, r.uniform(0.0, 0.05)))) for k in range(1, size)]


@pytest.mark.parametrize("block", [1024, 16])
def test_classes_match_brute_force(make_docs, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    r = random.Random(block)
    rows = star(r, 1000, 120) + star(r, 2000, 3) + [(3000 + k, "same text for all of these rows here") for k in range(50)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(4000 + k, passage + " " + " ".join(f"w{r.randrange(10**6)}" for _ in range(r.choice([5, 40, 80])))) for k in range(60)]
    chain = [f"c{k}" for k in range(100)]
    for k in range(8):
        rows.append((5000 + k, " ".join(chain)))
        chain = chain[6:] + [f"d{k}{j}" for j in range(6)]
    rows += [(i, t) for i, t in ODD if i is not None]
    found = near_dups.near_duplicates(make_docs(rows, "node", "body", "bucket", "band", "size")).collect()
    assert len(found) == len({i for i, _ in rows})
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(rows)


def test_odd_documents(make_docs):
    frame = make_docs(ODD + [(None, "another text without an id, of several words")], "node", "class_id", "_text")
    found = near_dups.near_duplicates(frame).collect()
    by = {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None}
    assert (by[1], by[2], by[3], by[4], by[5], by[6], by[7]) == (1, 1, 3, 4, 4, 6, 7)
    assert len({r["class_id"] for r in found if r["doc_id"] is None}) == 2
    kept = near_dups.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:5]) for r in kept.collect()) == [(0, "One t"), (0, "anoth"), (1, ""), (3, "xxxxx"), (4, "alpha"), (6, "first"), (7, "  !? ")]
    assert near_dups.near_duplicates(make_docs([])).count() == 0 and near_dups.keep_one(make_docs([])).count() == 0


@pytest.mark.parametrize("weighted", [False, True])
def test_darts_agree_as_often_as_the_weighted_similarity(weighted):
    r, k = np.random.default_rng(3), 2000
    for shared, own in ((80, 10), (30, 30), (4, 1), (400, 300)):
        a = r.integers(1, 1 << 62, shared + own).astype(np.uint64)
        b = np.concatenate([a[:shared], r.integers(1, 1 << 62, own).astype(np.uint64)])
        wa = r.uniform(0.2, 3.5, len(a)) if weighted else np.ones(len(a))
        wb = np.concatenate([wa[:shared] * r.uniform(0.5, 1.5, shared), r.uniform(0.2, 3.5, own)]) if weighted else np.ones(len(b))
        doc = np.repeat([0, 1], [len(a), len(b)])
        sig = near_dups.dart_signature(doc, np.concatenate([a, b]), np.concatenate([wa, wb]), 2, k)
        low, high = np.minimum(wa[:shared], wb[:shared]).sum(), np.maximum(wa[:shared], wb[:shared]).sum()
        similarity = low / (high + wa[shared:].sum() + wb[shared:].sum())
        assert abs((sig[0] == sig[1]).mean() - similarity) < 5 * np.sqrt(0.25 / k)


def test_components_of_chains_stars_and_loops(spark):
    r, joined = random.Random(4), Union()
    edges = [(k, k + 1) for k in range(100, 200)] + [(0, k) for k in range(1, 60)] + [(300, 300), (301, 302), (302, 301)]
    edges += [(r.randrange(400, 500), r.randrange(400, 500)) for _ in range(60)]
    for a, b in edges:
        joined.join(a, b)
    by = defaultdict(set)
    for x in list(joined):
        by[joined.find(x)].add(x)
    expected = {x: root for root, xs in by.items() for x in xs if len(xs) > 1 and x != root}
    found = {row["node"]: row["component"] for row in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {k: v for k, v in found.items() if k != v} == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_bytes_that_collide_in_an_earlier_band_do_not_hide_a_pair():
    settings = near_dups.Settings()
    r = np.random.default_rng(5)
    sig = r.integers(0, 256, (2, settings.k), dtype=np.uint8)
    sig[1] = sig[0]
    bands = r.integers(1, 1 << 62, (2, settings.bands))
    bands[1, 3] = bands[0, 3]  # bands 0 to 2 agree in all bytes but are different buckets
    bands[1, 7] = bands[0, 7]

    def pairs(band):
        shared = {"bucket": int(bands[0, band]), "band": band, "lo": 0, "hi": 0, "block": 0, "similarity": 0.7}
        rows = [{**shared, "node": n, "component": n, "sig": s.tobytes(), "bands": b.tolist()} for n, s, b in zip((11, 12), sig, bands, strict=True)]
        return [p for out in near_dups._remaining(pa.Table.from_pylist(rows).to_batches(), settings) for p in out.to_pylist()]

    assert [pairs(band) for band in (3, 7)] == [[{"a": 11, "b": 12}], []]


def test_different_texts_of_one_id_each_keep_a_row(make_docs):
    r = random.Random(6)
    base = [f"w{r.randrange(10**6)}" for _ in range(100)]
    near = " ".join([*base[:98], "new", "end"])
    rows = [(1, "one text of several words here"), (1, " ".join(base)), (2, near), (3, near), (3, "third text of other words again"), (4, "x y"), (4, "x y"), (5, "x y")]
    rows += [(None, "a text without an id"), (None, "one text of several words here"), (6, None), (7, "")]
    frame = make_docs(rows, "node", "body", "component", "first", "_text")
    kept = near_dups.keep_one_text(frame)
    assert kept.columns == frame.columns
    found = sorted((r["doc_id"] or 0, (r["text"] or "")[:9]) for r in kept.collect())
    assert found == [(0, "a text wi"), (0, "one text "), (1, " ".join(base)[:9]), (3, "third tex"), (4, "x y"), (6, "")]
    assert near_dups.keep_one_text(make_docs([])).count() == 0


def test_the_pipeline_keeps_different_texts_of_one_id(spark):
    rows = [(1, "first text of several words"), (1, "second text of quite other words"), (2, "second text of quite other words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in corpus_pipeline.keep_one_copy(spark, docs, "").collect()) == rows[:2]
