from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from talentsift.llm import catalog, spelling
from tests.conftest import rows as rows_of
from tests.llm.conftest import ODD

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs, every=97, least=3):
    total = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 5:
                total[word] += 1
    return {w: n for w, n in total.items() if n >= least}


def near(x: str, y: str) -> bool:
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def expected(words):
    out = {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, None, n, len(close), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return sorted((w, *v) for w, v in out.items())


def found(frame):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect())


def invented(seed, n, letters="abé"):
    """Documents of words that are near one another, in very different numbers."""
    random_ = random.Random(seed)
    stock = ["".join(random_.choice(letters) for _ in range(random_.randint(4, 7))) for _ in range(60)]
    weight = [2 ** random_.randint(0, 7) for _ in stock]
    return [(i, random_.choice([" ", "\n", "1", "-"]).join(w.upper() if random_.random() < 0.1 else w for w in random_.choices(stock, weight, k=80))) for i in range(n)]


@pytest.mark.parametrize("crowded", [1, 4, 20_000])
def test_variants_equal_brute_force_however_keys_are_cut(spark, make_docs, crowded):
    docs = invented(crowded, 60)
    result = spelling.spelling_variants(make_docs(docs, "word", "n", "s"), every=7, crowded=crowded)
    assert found(result) == expected(counted(docs, every=7))


def test_pairs_are_enumerated_once(spark):
    random_ = random.Random(4)
    words = sorted({"".join(random_.choice("abc") for _ in range(random_.randint(1, 7))) for _ in range(250)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    for crowded in (1, 10, 1000):
        pairs = [(r["word"], r["near"]) for r in spelling.near_words(frame, crowded=crowded).collect()]
        assert sorted(map(sorted, pairs)) == sorted(sorted((x, y)) for k, x in enumerate(words) for y in words[k + 1 :] if near(x, y))


def test_the_acceptor_is_minimal_and_accepts_its_words_only():
    random_ = random.Random(9)
    words = sorted({"".join(random_.choice("ab") for _ in range(random_.randint(0, 6))) for _ in range(40)})
    machine = spelling.Acceptor(words)
    language = {q: frozenset(machine.shared(q, q)) for q in range(len(machine.arcs))}
    assert len(set(language.values())) == len(language) and language[machine.start] == set(words)
    assert machine.size[machine.start] == len(words) and all(machine.accepts(machine.start, w) for w in words)


def test_a_chain_of_forms_ends_at_its_last_word(spark, make_docs):
    chain = ["aaaaaaaa"[:k] + "bbbbbbbb"[k:] for k in range(9)]
    docs = [(k, " ".join([w] * (3 * 2**k))) for k, w in enumerate(chain)]
    by_word = {r["word"]: r for r in spelling.spelling_variants(make_docs(docs), every=10**9).collect()}
    assert [by_word[w]["form"] for w in chain] == [*chain[1:], None]
    assert {by_word[w]["root"] for w in chain} == {chain[-1]}


def test_odd_documents_and_empty_tables(spark, make_docs):
    docs = [*ODD, *ODD, (8, None), (9, "y" * 40_000), (9, "y" * 40_000), (9, "y" * 39_999), (9, "y" * 39_999), (9, "y" * 39_999 + " y" + "y" * 39_999), (10, "×÷ÀÀà " * 3)]
    assert found(spelling.spelling_variants(make_docs(docs, "form", "root"))) == expected(counted(docs))
    assert spelling.spelling_variants(make_docs([])).count() == 0
    assert spelling.spelling_variants(make_docs([(1, "a b c"), (None, None)])).count() == 0


def test_runs_do_not_depend_on_slices(monkeypatch):
    random_ = random.Random(11)
    texts = ["".join(random_.choice(["ab", "É", "z" * 30, " ", "1", "漢", "K"]) for _ in range(40)) for _ in range(200)]
    for size in (1, 5, 64):
        monkeypatch.setattr(spelling, "SLICE", size)
        for text in texts:
            lowered = ["".join(c.lower() if "A" <= c <= "Z" else c for c in run) for run in RUN.findall(text)]
            assert [w for part in spelling.runs_of(text) for w in part] == lowered


def test_query_equals_brute_force_on_the_sample(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    words = counted(docs)
    by_hole = {}
    for w in words:
        for k in range(len(w)):
            by_hole.setdefault((w[:k], w[k + 1 :]), []).append(w)
    close = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            close[w].update(x for x in by_hole[w[:k], w[k + 1 :]] if x != w)
            shorter = w[:k] + w[k + 1 :]
            if shorter in words:
                close[w].add(shorter)
                close[shorter].add(w)
    result = found(catalog.op12_spelling_variants(spark, folder))
    assert [(r[0], r[3], r[4]) for r in result] == sorted((w, n, len(close[w])) for w, n in words.items())
    for word, form, root, n, _, form_n in result:
        best = min(close[word], key=lambda x: (-words[x], x), default=None)
        assert form == (best if best is not None and words[best] >= 2 * n else None)
        assert form_n == (words[form] if form else None) and (form or root == word)
    assert rows_of(spelling.near_words(spark.createDataFrame([], "word string, n bigint"))) == []
