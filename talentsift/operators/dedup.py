"""Idempotent writes as functions from existing and incoming rows to rows to add."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.keys import creator_key
from talentsift.operators.latest import latest
from talentsift.rules import ACTIVE, PENDING

CREATOR_KEY = ("platform", "external_id")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return latest(rows, keys, order)


def insert_if_absent(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Incoming rows to append: the first per key, unless the key is already stored.

    Incoming rows collapse before the anti join, so both join sides hold one
    row per key and no key can be hot in it.
    """
    return first_per_key(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti")


def enqueue(incoming: DataFrame, queue: DataFrame, order: Sequence[Column]) -> DataFrame:
    """New queue rows. A pending row of the same creator wins, with its priority and reason.

    Finished and failed rows do not block: a creator is fetched again on refresh.
    """
    pending = queue.where(F.col("status") == PENDING)
    return insert_if_absent(incoming, pending, CREATOR_KEY, order).withColumn("status", F.lit(PENDING))


def sighting_range(seen: DataFrame) -> DataFrame:
    """First and last sighting of each creator in ``(platform, external_id, seen_at)``."""
    return seen.groupBy(*CREATOR_KEY).agg(
        F.min("seen_at").alias("first_sighting"), F.max("seen_at").alias("last_sighting")
    )


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges of several batches as one per creator."""
    return ranges.groupBy(*CREATOR_KEY).agg(
        F.min("first_sighting").alias("first_sighting"), F.max("last_sighting").alias("last_sighting")
    )


def upsert_creators(existing: DataFrame, seen: DataFrame) -> DataFrame:
    """Next state of the creators table after sightings ``(platform, external_id, seen_at)``."""
    return upsert_ranges(existing, sighting_range(seen))


def upsert_ranges(existing: DataFrame, sightings: DataFrame) -> DataFrame:
    """Next state of the creators table after sightings given as one range per creator.

    A sighting reactivates its creator and moves ``last_seen_at``; the first
    discovery time never changes.
    """
    joined = existing.join(sightings, list(CREATOR_KEY), "full_outer")
    return joined.select(
        F.coalesce("creator_id", creator_key(F.col("platform"), F.col("external_id"))).alias("creator_id"),
        *CREATOR_KEY,
        F.coalesce("first_discovered_at", "first_sighting").alias("first_discovered_at"),
        F.greatest("last_seen_at", "last_sighting").alias("last_seen_at"),
        F.when(F.col("last_sighting").isNotNull(), ACTIVE).otherwise(F.col("status")).alias("status"),
    )
