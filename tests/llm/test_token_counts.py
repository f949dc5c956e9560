from __future__ import annotations

import random

import public_tokenizers
import pytest

from talentsift.llm.common import byte_bpe
from talentsift.llm.token_counts import CountTree, apply_edits, build_trees, redactions, segments
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("size", [4, 16, 64])
def test_counts_after_random_edits_equal_a_full_encoding(size):
    encoder, random_ = byte_bpe(PATH, False), random.Random(size)
    letters = list("abc 's  \n\n!?12é漢 \t")
    for _ in range(120):
        text = "".join(random_.choice(letters) for _ in range(random_.randint(0, 300)))
        leaves = segments(text, size)
        assert "".join(leaves) == text
        tree = CountTree(leaves, [len(encoder.ids(x)) for x in leaves])
        for _ in range(6):
            at, n = random_.randint(0, len(text)), random_.randint(0, 20)
            new = "".join(random_.choice(letters) for _ in range(random_.choice([0, 1, 3, 40])))
            tree.edit(at, n, new, encoder, size)
            text = text[:at] + new + text[at + n :]
            assert ("".join(tree.leaves), tree.chars, tree.tokens) == (text, len(text), len(encoder.ids(text)))


def test_a_small_edit_reads_little_of_a_long_text():
    encoder = byte_bpe(PATH, False)
    leaves = segments("some words of text " * 5000, 192)
    tree = CountTree(leaves, [len(encoder.ids(x)) for x in leaves])
    tree.edit(40_000, 3, "other", encoder, 192)
    assert tree.reencoded < 1000


def test_odd_documents_and_edits(spark, make_docs):
    trees = build_trees(make_docs(ODD, "leaf_chars", "edits", "n_tokens"), PATH)
    edits = "array(named_struct('start', 0, 'length', 3, 'text', 'Zero'), null, named_struct('start', 1000000, 'length', 5, 'text', cast(null as string)))"
    rows = apply_edits(trees.selectExpr("*", f"if(doc_id = 1, null, {edits}) as edits"), PATH).collect()
    encoder = byte_bpe(PATH, False)
    assert len(rows) == len(ODD)
    for row in rows:
        assert row["n_tokens"] == len(encoder.ids(row["text"])) and row["n_chars"] == len(row["text"])
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[1]["n_edits"], by_id[2]["text"], by_id[2]["n_tokens_before"], by_id[3]["n_edits"]) == (0, "Zero", 0, 2)


def test_redactions_replace_what_the_pattern_finds(spark, make_docs):
    text = "Write to a.b@mail.example.com or 10.0.0.1, then c@d.example. " + "filler words " * 50
    (row,) = apply_edits(redactions(build_trees(make_docs([(1, text)]), PATH)), PATH).collect()
    assert row["text"].startswith("Write to [hidden] or [hidden], then [hidden]") and row["n_edits"] == 3
    assert row["n_tokens"] == len(byte_bpe(PATH, False).ids(row["text"]))
    assert apply_edits(redactions(build_trees(make_docs([]), PATH)), PATH).count() == 0


def test_stored_trees_take_further_edits(spark, make_docs):
    """Two batches of edits give the counts of one full encoding, and the second reads little of the text."""
    encoder = byte_bpe(PATH, False)
    texts = [(1, "some words, 12 of them " * 400), (2, ""), (3, None), (4, "x" * 3000), (5, "a <|endoftext|> b")]
    first = "array(named_struct('start', 700, 'length', 9, 'text', 'new words'), named_struct('start', 0, 'length', 2, 'text', ''))"
    second = "array(named_struct('start', 705, 'length', 300, 'text', ' '), named_struct('start', 3, 'length', 0, 'text', 'more text '))"
    trees = build_trees(make_docs(texts), PATH)
    once = apply_edits(trees.selectExpr("*", f"{first} AS edits"), PATH)
    twice = {row["doc_id"]: row for row in apply_edits(once.selectExpr("*", f"{second} AS edits"), PATH).collect()}
    for doc, text in texts:
        text = text or ""
        for at, n, new in ((700, 9, "new words"), (0, 2, ""), (705, 300, " "), (3, 0, "more text ")):
            at = min(at, len(text))
            text = text[:at] + new + text[at + n :]
        row = twice[doc]
        assert (row["text"], row["n_tokens"], row["n_chars"]) == (text, len(encoder.ids(text)), len(text))
        assert (sum(row["leaf_chars"]), sum(row["leaf_tokens"])) == (row["n_chars"], row["n_tokens"])
    before = {row["doc_id"]: row["n_tokens"] for row in once.collect()}
    assert {doc: row["n_tokens_before"] for doc, row in twice.items()} == before
    assert twice[1]["n_reencoded_chars"] < 2000
