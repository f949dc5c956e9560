"""Recent videos per creator with their latest counters, and their summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions import signals as S
from talentsift.operators.latest import latest, latest_n, snapshot_order, video_order
from talentsift.rules import Rules


def recent_video_engagement(
    videos: DataFrame,
    video_snapshots: DataFrame,
    rules: Rules,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The latest counters of each creator's ``recent_videos`` newest videos.

    The limit comes before both the loss of videos without a snapshot and the
    ad filter, so a creator may end with fewer rows. Both inputs shrink on the
    map side first: at most that many videos per creator and one snapshot per
    video reach the join.
    """
    newest = latest_n(
        videos.select("creator_id", "video_id", "posted_at", "is_ad"),
        ["creator_id"],
        video_order(),
        rules.recent_videos,
    )
    counters = latest(video_snapshots, ["video_id"], order or snapshot_order()).select(
        "video_id", "play_count", "digg_count", "comment_count", "share_count"
    )
    return newest.join(counters, "video_id")


def video_summary(recent: DataFrame, as_of: Column, rules: Rules) -> DataFrame:
    """Everything scoring needs from the recent videos, in one aggregate per creator."""
    organic = ~F.col("is_ad")
    posted_on = F.to_date("posted_at")
    total = S.interactions(F.col("digg_count"), F.col("comment_count"), F.col("share_count"))
    return recent.groupBy("creator_id").agg(
        F.sum(F.when(organic, total)).alias("organic_interactions"),
        F.count(F.when(organic, F.lit(1))).alias("organic_videos"),
        F.count(posted_on).alias("dated_videos"),
        F.count_if(S.in_posting_window(posted_on, as_of, rules)).alias("videos_in_window"),
    )
