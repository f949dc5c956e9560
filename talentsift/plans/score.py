"""Scoring job: signals, tier and posting rate of every active creator in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions import signals as S
from talentsift.functions.keys import digest
from talentsift.functions.tiering import assign_tier
from talentsift.operators.latest import latest_with_previous, snapshot_order
from talentsift.operators.reports import active_creators
from talentsift.operators.videos import recent_video_engagement, video_summary
from talentsift.rules import FETCH_FAILED, SUCCESS, Rules


def current_and_previous(snapshots: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    return latest_with_previous(
        snapshots, ["creator_id"], order or snapshot_order(), ["snapshot_date", "follower_count"]
    )


def snapshot_signals(pair: DataFrame, rules: Rules) -> DataFrame:
    """Signals that the latest two snapshots give on their own, before any status rule."""
    return pair.select(
        "creator_id",
        "scrape_status",
        "follower_count",
        S.lifetime_engagement(
            F.col("lifetime_likes"), F.col("video_count"), F.col("follower_count")
        ).alias("lifetime_rate"),
        S.growth(
            F.col("previous_follower_count"),
            F.col("previous_snapshot_date"),
            F.col("follower_count"),
            F.col("snapshot_date"),
            rules,
        ).alias("growth"),
        S.account_type(F.col("bio"), F.col("bio_link"), F.col("is_commerce_account"), rules).alias("account"),
    )


def creator_signals(
    creators: DataFrame,
    snapshots: DataFrame,
    videos: DataFrame,
    video_snapshots: DataFrame,
    as_of: Column,
    rules: Rules,
    video_snapshot_order: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per active creator with every input of the tier decision.

    A creator without snapshots counts as a failed fetch; any other
    unsuccessful scrape keeps its follower count and has no signals. The video
    aggregate feeds both the engagement fallback and the posting rate.
    """
    active = active_creators(creators).select("creator_id")
    figures = snapshot_signals(current_and_previous(snapshots), rules)
    recent = recent_video_engagement(videos, video_snapshots, rules, video_snapshot_order)
    activity = video_summary(recent, as_of, rules)
    scraped = F.col("scrape_status") == SUCCESS
    recent_rate = S.recent_engagement(
        F.col("organic_interactions"), F.col("organic_videos"), F.col("follower_count")
    )
    measured = (
        active.join(figures, "creator_id", "left")
        .join(activity, "creator_id", "left")
        .select(
            "creator_id",
            "follower_count",
            F.when(scraped, F.coalesce("lifetime_rate", recent_rate)).alias("engagement_rate"),
            F.when(scraped, F.col("growth")).alias("growth_rate"),
            F.when(scraped, F.col("account")).otherwise(F.lit("creator")).alias("account_type"),
            F.coalesce("scrape_status", F.lit(FETCH_FAILED)).alias("scrape_status"),
            S.posting_rate(F.col("videos_in_window"), F.col("dated_videos"), rules).alias(
                "posting_consistency"
            ),
        )
    )
    return measured.withColumn(
        "suspicious_growth", S.suspicious(F.col("growth_rate"), F.col("engagement_rate"), rules)
    )


def with_tier(signals: DataFrame, rules: Rules) -> DataFrame:
    verdict = assign_tier(
        F.col("follower_count"),
        F.col("engagement_rate"),
        F.col("growth_rate"),
        F.col("account_type"),
        F.col("scrape_status"),
        F.col("suspicious_growth"),
        rules,
    )
    return signals.withColumn("verdict", verdict).select("*", "verdict.*").drop("verdict")


def score_creators(
    creators: DataFrame,
    snapshots: DataFrame,
    videos: DataFrame,
    video_snapshots: DataFrame,
    as_of: Column,
    rules: Rules,
    video_snapshot_order: Sequence[Column] | None = None,
) -> DataFrame:
    """Versioned score rows to append; earlier versions stay."""
    signals = creator_signals(
        creators, snapshots, videos, video_snapshots, as_of, rules, video_snapshot_order
    )
    return with_tier(signals, rules).select(
        digest(F.lit("score"), F.lit(rules.score_version), F.col("creator_id"), as_of).alias("score_id"),
        "creator_id",
        F.lit(rules.score_version).alias("score_version"),
        as_of.alias("computed_at"),
        "engagement_rate",
        "growth_rate",
        "posting_consistency",
        "account_type",
        "tier",
        "flags",
    )
