"""Ingestion job: the next queue batch and what its fetches brought, to landed payloads and new queue states."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.failures import summarize
from talentsift.functions.keys import digest
from talentsift.operators.envelope import fetch_envelopes
from talentsift.operators.queue import complete, next_batch
from talentsift.rules import DONE, FAILED, PENDING, Rules


@dataclass(frozen=True)
class Ingestion:
    """Rows to append to the payloads, and the queue after the batch."""

    raw_payloads: DataFrame
    queue: DataFrame


def fetch_requests(queue: DataFrame, rules: Rules) -> DataFrame:
    """Requests ``(request_id, platform, external_id)`` of the next batch."""
    batch = next_batch(queue, rules.fetch_batch)
    return batch.select(F.col("queue_id").alias("request_id"), "platform", "external_id")


def ingest(queue: DataFrame, items: DataFrame, raised: DataFrame, as_of: Column, rules: Rules) -> Ingestion:
    """Outcome of one batch.

    ``items (request_id, pos, item)`` are the responses and ``raised
    (request_id, kind, status_code, error_type, message)`` the fetches that
    failed, one row each. A failed fetch lands nothing and keeps its error on
    the queue row; a response without items lands as a soft failure. Ids come
    from the request and the run, so a rerun makes the same rows.
    """
    requests = fetch_requests(queue, rules)
    error = summarize(F.col("kind"), F.col("status_code"), F.col("error_type"), F.col("message"), rules)
    errors = raised.select("request_id", error.alias("error"))
    outcomes = requests.select("request_id").join(errors, "request_id", "left")
    fetched = requests.join(errors.select("request_id"), "request_id", "left_anti")
    wanted = items.join(fetched.select("request_id"), "request_id", "left_semi")
    landed = fetch_envelopes(fetched, wanted, rules).select(
        digest(F.lit("payload"), F.col("request_id"), F.col("page"), as_of).alias("raw_id"),
        "platform",
        "source_type",
        "external_id",
        "payload",
        as_of.alias("fetched_at"),
        F.lit(PENDING).alias("parse_status"),
    )
    states = outcomes.select(
        F.col("request_id").alias("queue_id"),
        F.when(F.col("error").isNotNull(), FAILED).otherwise(DONE).alias("status"),
        "error",
    )
    return Ingestion(landed, complete(queue, states))
