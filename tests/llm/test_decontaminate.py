from __future__ import annotations

import random
import re

import numpy as np

from talentsift.llm import decontaminate as D
from tests.llm.conftest import ODD

ITEMS = "item_id bigint, text string"


def words(text):
    return re.findall(rb"[0-9a-z_\x80-\xff]+", (text or "").lower().encode())


def grams(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def corpus(seed=5):
    r = random.Random(seed)
    stock = [f"w{k}" for k in range(300)]
    line = lambda n: " ".join(r.choice(stock) for _ in range(n))
    items = [(k, f"{line(r.randint(6, 40)).capitalize()}? {line(r.randint(1, 12)).capitalize()}.") for k in range(60)]
    docs = []
    for k in range(300):
        parts = [line(r.randint(0, 300))]
        if k % 4 == 0:
            parts.append(r.choice(items)[1].upper())
        if k % 9 == 0:  # question without its answer
            parts.append(r.choice(items)[1].split("?")[0])
        docs.append((k, ". ".join([*parts, line(r.randint(0, 100))])))
    return items, docs


def brute(items, docs):
    out = set()
    for d, text in docs:
        own, have = grams(text), set(words(text))
        for i, item in items:
            g = grams(item)
            if not g or len(g & own) / len(g) < 0.8:
                continue
            question, answer = item.split("?")
            parts = [set(words(question)), set(words(answer))]
            if all(len(p & have) / len(p) >= 0.8 for p in parts):
                out.add((d, i))
    return out


def found(spark, items, docs):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as score", "2 as item_id", "3 as found", "4 as id")
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' as doc_id")
    return frame, bench, {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame, bench).collect()}


def test_matches_equal_brute_force_in_one_shard_and_in_many(spark, monkeypatch):
    items, docs = corpus()
    frame, bench, pairs = found(spark, items, docs)
    assert pairs == brute(items, docs) and len(pairs) >= 75
    monkeypatch.setattr(D, "SHARD_BYTES", 2000)
    assert found(spark, items, docs)[2] == pairs
    clean = D.drop_contaminated(frame, bench)
    assert clean.columns == frame.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in pairs}


def test_pruning_loses_no_passage(spark):
    items, docs = corpus(8)
    index = D.ImpactIndex(D.read_items(items, 5))
    bodies = [t.lower().encode() for _, t in docs]
    hashed, owner = D.hashed_words(bodies)
    got = {(k, i): s for k, i, s in index.search(hashed, owner, len(docs), 0.4, 128)}
    impact = {}
    for b in range(index.blocks):
        for row, term in enumerate(index.block_terms[b]):
            for col in np.flatnonzero(index.block_impacts[b][row]):
                impact[(int(index.terms[term]), int(index.owner[b * D.ITEMS_PER_BLOCK + col]))] = index.block_impacts[b][row][col]
    width, expected = max(128, 2 * index.longest), {}
    stride = width - index.longest
    for k in range(len(docs)):
        own = hashed[owner == k]
        for start in range(0, max(1, len(own)), stride):
            seen = set(own[start : start + width].tolist())
            for i in range(len(items)):
                score = sum(impact.get((w, i), 0.0) for w in seen)
                if score >= 0.4:
                    expected[(k, i)] = max(expected.get((k, i), 0.0), score)
    assert got.keys() == expected.keys()
    assert all(abs(got[key] - expected[key]) < 1e-9 for key in got)


def test_odd_documents_and_items(spark):
    long_item = " ".join(f"q{k}" for k in range(700)) + "? The answer is here."
    items = [(1, ODD[0][1]), (1, ODD[0][1]), (2, None), (3, ""), (4, "too short"), (None, ODD[4][1]), (6, long_item), (7, ODD[4][1])]
    docs = [*ODD, (20, "before " * 40 + long_item + " after" * 40)]
    frame, bench, pairs = found(spark, items, docs)
    assert pairs == {(None, 1), (4, None), (5, None), (4, 7), (5, 7), (20, 6)}
    assert sorted(r["doc_id"] for r in D.drop_contaminated(frame, bench).collect()) == [1, 2, 3, 6, 6, 7]
    assert D.contaminated(frame, spark.createDataFrame([], ITEMS)).count() == 0
    assert D.drop_contaminated(frame, spark.createDataFrame([], ITEMS)).count() == len(docs)
    assert D.contaminated(frame.limit(0), bench).count() == 0
