"""Bounded training samples and the split that keeps held-out labels unseen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may learn from: crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> list[tuple[str, int]]:
    """At most about ``rows`` distinct labelled texts outside the held-out part, the same ones on every run.

    Ids are chosen by hash before any text is read. Null labels, and ids
    labelled both ways, teach nothing.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("y2"))
        .where("y = y2")
        .select("doc_id", F.col("y").cast("int").alias("y"))
    )
    total = known.count()
    if total == 0:
        return []
    cells = 1_000_003
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(cells)) < max(1, cells * rows // max(total, rows)))
    # The sample is bounded by `rows`, so it may be broadcast and its texts collected.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    found = texts.groupBy("text").agg(F.min("y").alias("y"), F.max("y").alias("y2"), F.min("doc_id").alias("id")).where("y = y2")
    return [(r["text"], r["y"]) for r in found.orderBy("id").collect()]
