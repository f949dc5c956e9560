"""Discovery job: provenance events, new queue rows, scheduled refreshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.keys import digest
from talentsift.functions.tiering import refresh_interval
from talentsift.operators import dedup
from talentsift.operators.discovery import queue_candidates
from talentsift.operators.latest import latest, score_order, snapshot_order
from talentsift.operators.reports import active_creators
from talentsift.rules import SCHEDULED_REFRESH, SUCCESS, Rules


def discovery_events(candidates: DataFrame, as_of: Column) -> DataFrame:
    """One event per query and candidate; only the queue deduplicates across queries."""
    return candidates.select("platform", "external_id", "source", "query", as_of.alias("discovered_at"))


def due_for_refresh(
    creators: DataFrame, scores: DataFrame, snapshots: DataFrame, as_of: Column, rules: Rules, last_success_handle: bool = False
) -> DataFrame:
    """Active creators whose last snapshot is at least their tier's interval old, or missing.

    The tier is that of the latest score of any version; without a snapshot
    the external id stands in for the handle. A failed fetch leaves the
    external id as handle; with ``last_success_handle`` the handle is that of
    the latest fetch that succeeded.
    """
    tiers = latest(scores, ["creator_id"], score_order()).select("creator_id", "tier")
    seen = latest(snapshots, ["creator_id"], snapshot_order()).select(
        "creator_id", "snapshot_date", F.col("handle").alias("last_handle")
    )
    if last_success_handle:
        succeeded = latest(snapshots.where(F.col("scrape_status") == SUCCESS), ["creator_id"], snapshot_order())
        known = succeeded.select("creator_id", F.col("handle").alias("known_handle"))
        seen = seen.join(known, "creator_id", "left").withColumn("last_handle", F.coalesce("known_handle", "last_handle"))
    age = F.datediff(F.to_date(as_of), "snapshot_date")
    due = F.col("snapshot_date").isNull() | (age >= refresh_interval(F.col("tier"), rules))
    return (
        active_creators(creators)
        .join(tiers, "creator_id", "left")
        .join(seen, "creator_id", "left")
        .where(due)
        .select("platform", "external_id", F.coalesce("last_handle", "external_id").alias("handle"))
    )


def queue_refreshes(due: DataFrame, rules: Rules) -> DataFrame:
    return due.select(
        "platform",
        "external_id",
        "handle",
        F.lit(SCHEDULED_REFRESH).alias("reason"),
        F.lit(rules.refresh_priority).alias("priority"),
    )


def enqueue_round(candidates: DataFrame, due: DataFrame, queue: DataFrame, rules: Rules) -> DataFrame:
    """New queue rows of one round: candidates were enqueued before refreshes, so they win.

    A candidate found by several queries is enqueued as its first sighting.
    """
    arrivals = queue_candidates(candidates, rules).withColumn("turn", F.lit(0))
    refreshes = queue_refreshes(due, rules).withColumn("turn", F.lit(1))
    order = [F.asc("turn"), F.asc_nulls_last("query"), F.asc_nulls_last("pos")]
    incoming = arrivals.unionByName(refreshes, allowMissingColumns=True)
    return dedup.enqueue(incoming, queue, order).drop("turn", "query", "pos")


def queue_rows(incoming: DataFrame, as_of: Column) -> DataFrame:
    """Rows of ``enqueue_round`` as the queue table stores them: with an id, a time, and no attempt yet.

    The id comes from the creator and the run, so a rerun makes the same rows.
    """
    return incoming.select(
        digest(F.lit("queue"), F.col("platform"), F.col("external_id"), as_of).alias("queue_id"),
        "platform",
        "external_id",
        "handle",
        "reason",
        F.col("priority").cast("int").alias("priority"),
        "status",
        F.lit(None).cast("string").alias("error"),
        as_of.alias("enqueued_at"),
        F.lit(0).alias("attempts"),
    )
