"""Work-queue batches and transitions as functions from queue state to queue state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.rules import IN_PROGRESS, PENDING

def next_batch(queue: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` most urgent pending rows: lowest priority number, then oldest.

    Plans as a per-partition top-k followed by a merge of those heads.
    """
    urgency = [F.asc("priority"), F.asc("enqueued_at"), F.asc("queue_id")]
    return queue.where(F.col("status") == PENDING).orderBy(*urgency).limit(limit)


def mark_in_progress(queue: DataFrame, limit: int) -> DataFrame:
    """Queue state after the next batch has been taken."""
    taken = next_batch(queue, limit).select("queue_id", F.lit(True).alias("taken"))
    status = F.when(F.col("taken"), IN_PROGRESS).otherwise(F.col("status"))
    return queue.join(taken, "queue_id", "left").withColumn("status", status).select(*queue.columns)


def complete(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Queue state after fetch outcomes ``(queue_id, status, error)``, one per item.

    An outcome without an error text leaves the earlier text in place.
    """
    result = outcomes.select(
        "queue_id", F.col("status").alias("new_status"), F.col("error").alias("new_error")
    )
    updated = queue.join(result, "queue_id", "left").withColumns(
        {"status": F.coalesce("new_status", "status"), "error": F.coalesce("new_error", "error")}
    )
    return updated.select(*queue.columns)
