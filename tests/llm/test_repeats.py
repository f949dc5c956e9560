from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from talentsift.llm import repeats
from talentsift.llm.repeats import IndexFamily, find_repeats, remove_repeats, suffixes
from tests.conftest import plan_of
from tests.llm.conftest import ODD


def brute(texts, length):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def run(frame, length, prefix, batches=4):
    return remove_repeats(frame, length=length, prefix=prefix, batches=batches)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_match_brute_force(make_docs, seed):
    r = random.Random(seed)
    letters = ["ab", "abc d", "abcdefghij é"][seed]
    stock = ["".join(r.choice(letters) for _ in range(r.randint(10, 90))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [r.choice(stock) if r.random() < 0.4 else "".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(r.randint(0, 5))]
        texts.append("".join(parts))
    rows = list(enumerate(texts))
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in run(make_docs(rows, "key", "start", "n", "doc"), 24, 6, 1 + seed * 2).collect()}
    assert found == dict(enumerate(brute([t.encode() for t in texts], 24)))


def test_odd_documents_match_brute_force(make_docs):
    rows = ODD + [(10, "abcdefgh" * 12), (11, "x" * 30), (12, ODD[0][1] + " And more text that is nowhere else.")]
    expected = Counter((i, *row) for (i, _), row in zip(rows, brute([(t or "").encode() for _, t in rows], 32), strict=True))
    found = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in run(make_docs(rows, "spans", "bytes", "body"), 32, 8).collect())
    assert found == expected


def test_spans_are_the_removed_ranges(make_docs):
    text = "0123456789" * 30
    (a, b) = run(make_docs([(1, "only here " * 1 + text), (2, text + " tail")]), 200, 40).orderBy("doc_id").collect()
    assert [tuple(s) for s in a["spans"]] == [(10, 310)] and [tuple(s) for s in b["spans"]] == [(0, 300)]
    assert bytes(a["kept"]) == b"only here " and bytes(b["kept"]) == b" tail"


def test_empty_table_and_texts_shorter_than_the_length(make_docs):
    assert run(make_docs([]), 200, 40).count() == 0
    assert find_repeats(make_docs([(1, "short"), (2, "short")]), length=200, prefix=40).count() == 0


def _common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


def _suffixes(docs):
    return suffixes(docs, length=32, prefix=8, depth=24).selectExpr("text", "tail", "xxhash64(doc, body, start) as at")


def _texts_of(family):
    return [[bytes(r["text"]) for r in level.collect()] for _, level in family.levels]


def test_levels_stay_and_give_the_longest_matches_of_later_batches(make_docs, spark):
    r = random.Random(5)
    stock = ["".join(r.choice("abc") for _ in range(60)) for _ in range(6)]
    batches = [[(10 * k + i, "".join(r.choice(stock) if r.random() < 0.6 else "".join(r.choice("abc") for _ in range(50)) for _ in range(4))) for i in range(8)] for k in range(5)]
    family = IndexFamily(prefix=8, depth=24)
    seen, reaches = [], {}
    for k, rows in enumerate(batches):
        found = _suffixes(make_docs(rows))
        if k == 2:
            family = IndexFamily.opened(spark, family.folders(), prefix=8, depth=24)
        for row in family.add(found).collect():
            reaches[row["tail"]] = max(reaches.get(row["tail"], 0), row["reach"])
        seen += [(row["tail"], bytes(row["text"])) for row in found.collect()]
        assert Counter(t for level in _texts_of(family) for t in level) == Counter(t for _, t in seen)
    assert [weight for weight, _ in family.levels] == [4, 1]
    best = {}
    for i, (tail, text) in enumerate(seen):
        best[tail] = max([best.get(tail, 0), *(_common(text, other) for j, (_, other) in enumerate(seen) if j != i)])
    assert reaches == {tail: n for tail, n in best.items() if n >= 8}


def test_a_level_is_in_byte_order_and_equal_texts_lie_in_several_parts(make_docs):
    family = IndexFamily(prefix=8, depth=24)
    text = "the same words stand in every one of these rows, again and again"
    matches = family.add(_suffixes(make_docs([(i, text) for i in range(300)])))
    assert all(r["reach"] == 24 for r in matches.collect()) and matches.count() > 0
    parts = [[bytes(r["text"]) for r in part] for part in family.levels[0][1].rdd.glom().collect()]
    assert all(texts == sorted(texts) for texts in parts)
    assert all(n == 300 for n in Counter(t for texts in parts for t in texts).values())


def test_a_batch_without_suffixes_adds_no_level(make_docs):
    family = IndexFamily(prefix=8, depth=24)
    assert family.add(_suffixes(make_docs([(1, "short"), (2, None)]))).count() == 0
    assert family.levels == []


def test_neighbouring_documents_that_go_as_a_whole_keep_spans_of_their_own(make_docs):
    text = "0123456789abcdef" * 4
    rows = [(1, text), (2, text), (3, ""), (4, text + "tail"), (5, "head" + text), (6, None), (7, "only here, once and for all, so it stays"), (None, text)]
    found = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]), tuple(map(tuple, r["spans"]))) for r in run(make_docs(rows).coalesce(1), 32, 8).collect())
    whole = (64, 64, 1, b"", ((0, 64),))
    assert found == Counter(
        [(1, *whole), (2, *whole), (None, *whole), (3, 0, 0, 0, b"", ()), (6, 0, 0, 0, b"", ()), (4, 68, 64, 1, b"tail", ((0, 64),)), (5, 68, 64, 1, b"head", ((4, 68),)), (7, 40, 0, 0, rows[6][1].encode(), ())]
    )


def test_one_row_of_a_group_is_taken_by_hash_and_whole(spark):
    rows = spark.range(20_000, numPartitions=7).selectExpr("id % 50 as key", "id as doc", "id * 3 as body", "cast(id as int) as start")
    taken = rows.groupBy("key").agg(*repeats._one("doc", "body", "start"))
    assert all(r["body"] == 3 * r["doc"] and r["start"] == r["doc"] and r["doc"] % 50 == r["key"] for r in taken.collect())
    assert "HashAggregate" in plan_of(taken) and "SortAggregate" not in plan_of(taken)


def test_blocks_leave_in_large_batches(make_docs, spark, monkeypatch):
    """Documents of a megabyte together make one Arrow batch of blocks, not one each."""
    r = random.Random(3)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(120)) for _ in range(40)]
    batches = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda frame, scan, schema: batches.append(scan) or frame)
    repeats._blocks(make_docs(list(enumerate(texts))), spark.createDataFrame([], "doc bigint, body bigint, key bigint, start int, n int, lead int"), 32)
    kind = pa.list_(pa.struct([("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("lead", pa.int32())]))
    runs = [[{"key": 7, "start": 5, "n": 12, "lead": 16}] for _ in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(range(40), pa.int64()), pa.array([t.encode() for t in texts]), pa.array(runs, kind)], names=["doc", "body", "bytes", "runs"])
    (out,) = batches[0](iter([batch]))
    windows = Counter((row["doc"], s) for row in out.to_pylist() for s in range(row["start"], row["start"] + row["n"]))
    assert windows == Counter((d, s) for d in range(40) for s in range(5, 17))


def test_a_worker_needs_little_memory_for_a_batch_of_texts(make_docs, spark, monkeypatch):
    """Hashes and places of some megabytes of text are never held at once."""
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(4000)) for _ in range(512)]
    scans = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda frame, scan, schema: scans.append(scan) or frame)
    suffixes(make_docs([]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(512), pa.int64()), pa.array(range(512), pa.int64()), pa.array([t.encode() for t in texts])], names=["doc", "body", "bytes"])
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in scans[0](iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 512 * 20 and peak < 40e6


def test_long_texts_come_to_a_worker_in_small_batches(make_docs, spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    docs = make_docs([(i, "0123456789" * 1000) for i in range(900)]).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = [r["n"] for r in repeats.stored(docs.mapInArrow(sizes, "n bigint"), "sizes").collect()]
    assert sum(found) > 9_000_000 and max(found) < 1_500_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_whole_texts_are_neither_sorted_nor_cut_under_other_settings(make_docs, spark):
    docs = make_docs([(1, "0123456789" * 8), (1, "0123456789" * 8), (2, "abcdefghij" * 8 + "x")])
    work = spark.createDataFrame([], "doc bigint, body bigint, key bigint, start int, n int, lead int")
    plan = plan_of(repeats._blocks(docs, work, 32))
    assert "SortAggregate" not in plan and "Sort [" not in plan
    assert "MapInArrow" not in plan_of(run(docs, 32, 8))
