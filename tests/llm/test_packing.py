from __future__ import annotations

import random
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from talentsift.llm import packing
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_hold_the_ids_of_the_library(spark, make_docs):
    texts = ["", None, "plain words", "<|endoftext|> inside <|endoftext|>", "  spaced   out \n\n x", "ünï 漢字 🙂" * 300, "word " * 3000, "z" * 5000]
    rows = packing.tokenize(make_docs(list(enumerate(texts)), "ids", "piece", "length"), PATH, capacity=256).collect()
    library, by = Tokenizer.from_file(PATH), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for k, text in enumerate(texts):
        pieces = sorted(by[k], key=lambda r: r["piece"])
        ids = [x for p in pieces for x in struct.unpack(f"<{p['length']}I", p["ids"])]
        assert ids == library.encode(text or "", add_special_tokens=False).ids + [2]
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert all(p["length"] == 256 for p in pieces[1:]) and pieces[0]["length"] <= 256
        assert [p["start"] for p in pieces] == [sum(q["length"] for q in pieces[:i]) for i in range(len(pieces))]


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_count_and_stay_near_the_bound(seed):
    r = random.Random(seed)
    capacity = r.choice([16, 100, 1024])
    counts = {k: r.randint(1, 500) for k in r.sample(range(1, capacity + 1), min(capacity, r.randint(1, 200)))}
    plan, used, sequences = packing.plan(counts, capacity), Counter(), 0
    for pattern, times in plan:
        assert sum(pattern) <= capacity and times > 0
        sequences += times
        for length in pattern:
            used[length] += times
    assert used == counts
    assert sequences <= sum(n for _, n in packing.best_fit(counts, capacity))


def test_many_lengths_reach_the_lower_bound():
    counts = {k: 1 + 4000 // k for k in range(1, 1024)}
    sequences = sum(n for _, n in packing.plan(counts, 1024))
    assert sequences == max(-(-sum(k * n for k, n in counts.items()) // 1024), sum(n for k, n in counts.items() if k > 512))


def test_exact_complements_are_found():
    assert {p for p, _ in packing.plan({7: 2, 3: 2, 5: 2, 4: 1, 2: 1}, 10)} <= {(7, 3), (5, 5), (4, 2)}
    assert packing.plan({6: 3, 2: 6}, 10) == [((6, 2, 2), 3)]
    assert packing.plan({}, 10) == []


def test_hot_lengths_repeats_and_odd_documents_are_all_placed(spark, make_docs, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", 20)
    docs = make_docs(ODD + [(100 + k, "same length text") for k in range(300)] + [(500 + k, "w " * (k % 90)) for k in range(200)], "sequence_id", "offset")
    pieces = packing.tokenize(docs, PATH, capacity=64)
    packed = packing.pack(pieces, capacity=64)
    rows = packed.collect()
    count = lambda rows: Counter((r["doc_id"], r["piece"], r["length"]) for r in rows)
    assert count(rows) == count(pieces.collect())
    total = sum(r["length"] for r in rows)
    assert check_places(rows, 64) <= -(-total // 64) + 2
    assert Counter(map(tuple, packing.pack(pieces, capacity=64).collect())) == Counter(map(tuple, rows))
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids_hex"]) // 8 for r in whole) == total


def test_empty_table(spark, make_docs):
    assert packing.pack(packing.tokenize(make_docs([]), PATH)).count() == 0
