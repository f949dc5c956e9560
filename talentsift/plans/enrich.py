"""Enrichment job: parsed payloads to creators, snapshots, videos and quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.keys import creator_key, digest
from talentsift.operators import dedup, parsing
from talentsift.rules import SUCCESS

_PROFILE_COLUMNS = (
    "handle",
    "follower_count",
    "following_count",
    "lifetime_likes",
    "video_count",
    "bio",
    "bio_link",
    "is_verified",
    "is_private",
    "is_commerce_account",
)


@dataclass(frozen=True)
class Enrichment:
    """Rows to append, and the sightings that update the creators table."""

    profile_snapshots: DataFrame
    videos: DataFrame
    video_snapshots: DataFrame
    parse_errors: DataFrame
    sightings: DataFrame


def profile_snapshots(parsed: DataFrame, as_of: Column) -> DataFrame:
    """One snapshot per fetch, failed ones included: an attempt must leave a trace.

    The creator is the one the fetch was made for, whatever id the payload
    names. A failed fetch keeps the external id as handle and no figures.
    """
    return snapshot_rows(parsing.fetches(parsed), as_of)


def snapshot_rows(fetches: DataFrame, as_of: Column) -> DataFrame:
    """``profile_snapshots`` of fetches whose fields have been read."""
    handle = F.when(F.col("missed"), F.col("external_id")).otherwise(F.col("handle"))
    return fetches.select(
        digest(F.lit("profile"), F.col("raw_id")).alias("snapshot_id"),
        creator_key(F.col("platform"), F.col("external_id")).alias("creator_id"),
        as_of.cast("date").alias("snapshot_date"),
        handle.alias("handle"),
        *_PROFILE_COLUMNS[1:],
        F.when(F.col("missed"), F.col("reason")).otherwise(SUCCESS).alias("scrape_status"),
        as_of.alias("created_at"),
        "raw_id",
    )


def video_rows(listed: DataFrame, as_of: Column) -> DataFrame:
    """Candidate rows for the videos table, still with repeats."""
    return listed.select(
        "video_id",
        creator_key(F.col("platform"), F.col("external_id")).alias("creator_id"),
        "posted_at",
        "is_ad",
        "text_language",
        "web_video_url",
        as_of.alias("first_seen_at"),
        "fetched_at",
        "raw_id",
        "pos",
    )


def new_videos(listed: DataFrame, existing: DataFrame, as_of: Column) -> DataFrame:
    """Videos to insert: the first sighting decides owner and ad flag, stored videos stay."""
    order = [F.asc("fetched_at"), F.asc("raw_id"), F.asc("pos")]
    fresh = dedup.insert_if_absent(video_rows(listed, as_of), existing, ["video_id"], order)
    return fresh.drop("fetched_at", "raw_id", "pos")


def merged_videos(listed: DataFrame, arriving: Column, as_of: Column) -> DataFrame:
    """The videos table after ``arriving`` rows come on top of the others, in one ranking per video."""
    rows = video_rows(listed, as_of).withColumn("arriving", arriving)
    order = [F.asc("arriving"), F.asc("fetched_at"), F.asc("raw_id"), F.asc("pos")]
    return dedup.first_per_key(rows, ["video_id"], order).drop("fetched_at", "raw_id", "pos", "arriving")


def video_snapshots(listed: DataFrame, as_of: Column) -> DataFrame:
    return listed.select(
        digest(F.lit("video"), F.col("raw_id"), F.col("pos")).alias("snapshot_id"),
        "video_id",
        as_of.cast("date").alias("snapshot_date"),
        "play_count",
        "digg_count",
        "comment_count",
        "share_count",
        "collect_count",
        as_of.alias("created_at"),
        "raw_id",
    )


def sightings(parsed: DataFrame, as_of: Column) -> DataFrame:
    """Creators seen by a fetch, soft failures included; quarantined payloads name nobody."""
    return parsing.handled(parsed).select("platform", "external_id", as_of.alias("seen_at"))


def enrich_opened(opened: DataFrame, existing_videos: DataFrame, as_of: Column) -> Enrichment:
    """All outputs of one batch, from rows that ``parsing.opened`` has written."""
    listed = parsing.opened_videos(opened)
    return Enrichment(
        profile_snapshots=snapshot_rows(parsing.opened_fetches(opened), as_of),
        videos=new_videos(listed, existing_videos, as_of),
        video_snapshots=video_snapshots(listed, as_of),
        parse_errors=parsing.errors(opened),
        sightings=sightings(opened, as_of),
    )


def enrich(
    parsed: DataFrame, existing_videos: DataFrame, as_of: Column, listed: DataFrame | None = None
) -> Enrichment:
    """All outputs of one batch.

    ``as_of`` stamps the rows: a literal for a run, or ``fetched_at`` for a
    backfill. A caller that writes several outputs persists ``parsed`` and its
    videos and passes the latter as ``listed``, so that payloads are read once.
    """
    if listed is None:
        listed = parsing.videos(parsed)
    return Enrichment(
        profile_snapshots=profile_snapshots(parsed, as_of),
        videos=new_videos(listed, existing_videos, as_of),
        video_snapshots=video_snapshots(listed, as_of),
        parse_errors=parsing.errors(parsed),
        sightings=sightings(parsed, as_of),
    )
