"""Handoff job: who goes to outreach, and the A-tier report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.operators.dedup import insert_if_absent
from talentsift.operators.latest import latest, snapshot_order
from talentsift.rules import PENDING, TIER_A, Rules


def outreach_ready(scores: DataFrame, outreach: DataFrame, rules: Rules) -> DataFrame:
    """Creators whose latest score qualifies and who are not queued yet.

    Scores that tie for latest all count, so a creator may appear twice. The
    queue check runs on one row per creator; the score table, where a creator
    may be hot, takes part in a single join that AQE can split.
    """
    newest = scores.groupBy("creator_id").agg(F.max("computed_at").alias("computed_at"))
    unqueued = newest.join(outreach.select("creator_id"), "creator_id", "left_anti")
    return (
        scores.where(F.col("tier").isin(*rules.handoff_tiers))
        .join(unqueued, ["creator_id", "computed_at"], "left_semi")
        .select("creator_id", "tier")
    )


def outreach_push(scores: DataFrame, outreach: DataFrame, as_of: Column, rules: Rules) -> DataFrame:
    """Outreach rows to append, one per creator; the better tier wins a tie."""
    ready = outreach_ready(scores, outreach, rules)
    return insert_if_absent(ready, outreach, ["creator_id"], [F.asc("tier")]).select(
        "creator_id", "tier", as_of.alias("pushed_at"), F.lit(PENDING).alias("status")
    )


def a_tier_candidates(
    scores: DataFrame, creators: DataFrame, snapshots: DataFrame, outreach: DataFrame, rules: Rules
) -> DataFrame:
    """A-tier scores of the current version with the creator's latest handle, best first.

    Every such score is listed, not only the latest. Queued creators leave on
    the side with one row per creator, so the scores join once.
    """
    scored = scores.where((F.col("tier") == TIER_A) & (F.col("score_version") == rules.score_version))
    handles = latest(snapshots, ["creator_id"], snapshot_order()).select("creator_id", "handle")
    unqueued = (
        creators.select("creator_id")
        .join(handles, "creator_id")
        .join(outreach.select("creator_id"), "creator_id", "left_anti")
    )
    return (
        scored.select("creator_id", "engagement_rate", "tier")
        .join(unqueued, "creator_id")
        .select("creator_id", "handle", "engagement_rate", "tier")
        .orderBy(F.desc_nulls_first("engagement_rate"))
    )
