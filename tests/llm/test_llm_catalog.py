from __future__ import annotations

import re

import __spark_entry__ as entry_point
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from talentsift.llm import catalog
from tests.oracle import connect, differences

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_every_operator_and_the_pipeline_are_registered():
    names = entry_point.queries()
    assert sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m) == list(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run
    assert set(catalog.ORACLES) <= set(entry_point.oracle_sql()) and "pipeline" not in entry_point.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(catalog.QUERIES[name](spark, FOLDER), connect(FOLDER), catalog.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - {"op12_spelling_variants"}))
def test_other_queries_return_a_row_for_each_document(spark, name):
    ids = {r["doc_id"] for r in catalog.QUERIES[name](spark, SMALL).select("doc_id").collect()}
    documents = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    assert ids <= documents if name.startswith("op9") else ids == documents


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).persist()
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SMALL).agg(F.countDistinct("doc_id")).first()[0] == before


def test_stages_run_on_empty_and_odd_documents(spark):
    """Odd rows: each stage is held against the rows that it must keep; columns with the stages' own names pass through."""
    own = ["_site", "n_lines", "n_dropped", "row", "document", "site", "score", "class_id", "words"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{name} string" for name in own)
    texts = [(None, None, 0), (1, "", 0), (1, "", 0), (2, "some words " * 40, 440), (3, "x" * 30_000, 30_000)]
    rows = [(i, text, "en", "s" if i else None, n, *(f"{name} of {i}" for name in own)) for i, text, n in texts]
    empty, odd = spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0

    def told(frame):
        return sorted(map(str, frame.collect()))

    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, odd, SMALL)
    assert good.columns == odd.columns and set(told(good)) <= set(told(odd))
    assert told(stages["line dedup"](spark, odd, SMALL)) == told(odd)
    single = stages["MinHash near-dedup"](spark, odd, SMALL)
    assert single.columns == odd.columns and set(told(single)) <= set(told(odd))
    assert sorted(r["text"] or "" for r in single.where("text <> ''").collect()) == sorted(t for _, t, _ in texts if t)
    assert told(stages["benchmark decontamination"](spark, odd, SMALL)) == told(odd)
    packed = stages["best-fit packing"](spark, odd, SMALL)
    assert packed.agg(F.countDistinct(F.coalesce("doc_id", F.lit(-1)))).first()[0] == 4
    assert packed.where("length > 1024 or offset + length > 1024").count() == 0


def test_repeated_lines_of_small_large_and_hot_sources_go_and_single_lines_stay(spark):
    rows = []
    for source, size in (("small", 500), ("large", 2_000), ("hot", 20_000)):
        for k in range(size):
            shares = [p for p in (1, 2, 5, 10) if k % (100 // p) == 0]
            rows.append((len(rows), "\n".join([*(f"notice {p}" for p in shares), f"body {k} of {source}", f"pair {k // 2}"]), source))
    rows += [(len(rows) + k, "copied text\nof two lines", "small") for k in range(100)]  # one text, copied often
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n_chars", F.length("text").cast("long"))
    found = corpus_pipeline.drop_boilerplate_lines(spark, docs.repartition(8), SMALL)
    kept = {r["doc_id"]: r for r in found.collect()}
    for i, text, _ in rows:
        assert kept[i]["text"] == "\n".join(x for x in text.split("\n") if not x.startswith("notice"))
        assert kept[i]["n_chars"] == len(kept[i]["text"])


def test_line_query_matches_sql_where_lines_go(spark):
    folder, name = "/root/testdata/sf0.1", "op2_site_relative_lines"
    found = catalog.QUERIES[name](spark, folder)
    assert found.agg(F.sum("n_dropped")).first()[0] > 0
    assert differences(found, connect(folder), catalog.ORACLES[name]) == []
