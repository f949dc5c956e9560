from __future__ import annotations

import random
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from talentsift.llm import catalog, transducer
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "é", "漢", "🎉", "1", "23", "!", "<|endoftext|>", "<|endo", "\u0085", "\x1c", "ᲊ", "　", "꟎", "ab" * 20, "x" * 30]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def merges():
    return transducer.merges_of(PATH)


def ids_of(data: bytes) -> list[int]:
    return list(array("I", data))


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@pytest.mark.parametrize("piece", [1, 2, 7, 1 << 16])
def test_random_texts_in_pieces_equal_the_library(library, merges, monkeypatch, piece):
    monkeypatch.setattr(transducer, "PIECE_CHARS", piece)
    random_, words = random.Random(piece), {}
    for _ in range(500):
        text = "".join(random_.choice(PARTS) for _ in range(random_.randint(0, 14)))
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids_of(transducer.encode_text(text, merges, words)) == expected
        assert transducer.decode_ids(packed(expected), merges) == library.decode(expected, skip_special_tokens=False)


def test_every_code_point_falls_into_the_class_that_the_library_gives_it(library, merges):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        text = "".join(f"a{c}!" for c in points[at : at + 20_000])
        assert ids_of(transducer.encode_text(text, merges)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["x" * 150_000, " " * 140_000 + "a", "ab" * 40_000 + " " * 70_001, "!" * 90_000 + "1" * 90_000, " " + "é" * 80_000, "漢" * 70_000 + "'re"])
def test_runs_longer_than_a_piece_equal_the_library(library, merges, text):
    assert ids_of(transducer.encode_text(text, merges)) == library.encode(text, add_special_tokens=False).ids


def _random_merges(random_: random.Random, n: int) -> transducer.Merges:
    alphabet = ["a", "b", "c"]
    vocabulary, rules = {c: i for i, c in enumerate(alphabet)}, []
    while len(rules) < n:
        left, right = random_.choice(list(vocabulary)), random_.choice(list(vocabulary))
        if left + right not in vocabulary and len(left + right) < 9:
            vocabulary[left + right] = len(vocabulary)
            rules.append((left, right))
    return transducer.Merges(vocabulary, rules, {})


def test_tokens_before_the_lookahead_are_stable_under_every_extension():
    random_ = random.Random(5)
    for _ in range(300):
        merges = _random_merges(random_, random_.randint(1, 25))
        for _ in range(8):
            text = "".join(random_.choice("abc") for _ in range(random_.randint(0, 60))).encode()
            longer = text + "".join(random_.choice("abc") for _ in range(random_.randint(1, 20))).encode()
            whole, end, stable = merges.merge(longer), 0, []
            for i in merges.merge(text):
                end += len(merges.token_bytes[i])
                if end > len(text) - merges.lookahead:
                    break
                stable.append(i)
            assert whole[: len(stable)] == stable


def test_a_run_in_any_steps_equals_one_merge_and_holds_a_bounded_buffer():
    random_ = random.Random(6)
    for _ in range(60):
        merges = _random_merges(random_, random_.randint(1, 25))
        data = "".join(random_.choice("abc") for _ in range(1500)).encode()
        run, out, at = transducer.Run(merges), [], 0
        while at < len(data):
            step = random_.choice([1, 3, 50, 400])
            out += run.push(data[at : at + step])
            at += step
            assert len(run.pending) < 2 * run.room
        assert out + run.finish() == merges.merge(data)
        assert len(out) > 0


def test_short_and_long_merging_agree(merges, monkeypatch):
    random_ = random.Random(7)
    for _ in range(300):
        data = "".join(random_.choice(["th", "e", "aa", "ing", "é", "1"]) for _ in range(random_.randint(0, 12))).encode()
        short = merges.merge(data)
        monkeypatch.setattr(transducer, "SHORT_BYTES", -1)
        assert merges.merge(data) == short
        monkeypatch.undo()


def test_a_list_whose_rules_come_too_early_is_refused():
    with pytest.raises(ValueError):
        transducer.Merges({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")], {})


def test_broken_bytes_decode_as_in_the_library_wherever_they_are_split(library, merges):
    random_ = random.Random(8)
    for _ in range(800):
        ids = [random_.randint(0, 50256) if random_.random() < 0.2 else random_.randint(90, 260) for _ in range(random_.randint(0, 20))]
        decoder, out, at = transducer.Decoder(merges), "", 0
        while at < len(ids):
            step = random_.randint(1, 4)
            out += decoder.push(packed(ids[at : at + step]))
            assert len(decoder.state) <= 3
            at += step
        assert out + decoder.push(b"", True) == library.decode(ids, skip_special_tokens=False)


def test_odd_documents_keep_one_row_each(spark, make_docs, library):
    docs = make_docs(ODD, "ids", "n_tokens", "row")
    rows = transducer.decode(transducer.encode(docs, PATH), PATH).collect()
    expected = sorted((i if i is not None else -1, t or "") for i, t in ODD)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in rows) == expected
    for row in rows:
        assert ids_of(row["ids"]) == library.encode(row["text"], add_special_tokens=False).ids and row["n_tokens"] == len(row["ids"]) // 4
    assert transducer.decode(transducer.encode(make_docs([]), PATH), PATH).count() == 0
    unknown = spark.createDataFrame([(1, 1, bytearray(packed([99_999_999, 97]))), (2, 0, None)], "doc_id bigint, n_tokens bigint, ids binary")
    assert {r["doc_id"]: r["text"] for r in transducer.decode(unknown, PATH).collect()} == {1: transducer.decode_ids(packed([97]), transducer.merges_of(PATH)), 2: ""}


def test_query_equals_the_library_on_the_sample(spark, library):
    import hashlib

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.col("text")).collect()}
    found = catalog.op11_streaming_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(packed(ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
