"""A training corpus in five stages: good documents, without boilerplate lines, copies and test items, packed into sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift.llm import decontaminate, lines, near_dups, packing, quality
from talentsift.llm.common import stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A line is boilerplate on a site that holds it on over a tenth of its pages. A source is a bundle of sites, and a
# site counts from a twentieth of its source; five different texts are more than near copies of one usually are.
SOURCE_RATIO = 0.1 / 20
SOURCE_DOCUMENTS = 5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that over ``SOURCE_RATIO`` of their source's texts and ``SOURCE_DOCUMENTS`` of them hold."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("document"), F.col("source").alias("site"), "text")
    kept = lines.drop_boilerplate(rows, host="site", ratio=SOURCE_RATIO, min_pages=SOURCE_DOCUMENTS, copies_count=False)
    columns = {c: F.col("document").getField(c) for c in others} | {"text": F.col("text")}
    columns["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(columns["n_chars"])
    return kept.select(*[columns[c].alias(c) for c in docs.columns])


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies; different texts of one id are different documents."""
    return near_dups.keep_one_text(docs).select(*docs.columns)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and the offset they go to."""
    pieces = packing.tokenize(docs, TOKENIZER)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_boilerplate_lines),
    ("MinHash near-dedup", keep_one_copy),
    ("benchmark decontamination", drop_test_items),
    ("best-fit packing", pack),
]

# Signatures, learned scores and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
