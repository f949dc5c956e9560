"""Table schemas, as DDL strings that ``spark.read.schema`` and tests share.

Follower, video and engagement counts are 64-bit because source integers are
unbounded; identifiers are text; score arithmetic is double.
"""

from __future__ import annotations

CREATORS = """
    creator_id string, platform string, external_id string,
    first_discovered_at timestamp, last_seen_at timestamp, status string
"""

DISCOVERY_EVENTS = """
    platform string, external_id string, source string, query string, discovered_at timestamp
"""

INGESTION_QUEUE = """
    queue_id string, platform string, external_id string, handle string, reason string,
    priority int, status string, error string, enqueued_at timestamp, attempts int
"""

RAW_PAYLOADS = """
    raw_id string, platform string, source_type string, external_id string,
    payload string, fetched_at timestamp, parse_status string
"""

PARSE_ERRORS = "raw_id string, error string, occurred_at timestamp"

PROFILE_SNAPSHOTS = """
    snapshot_id string, creator_id string, snapshot_date date, handle string,
    follower_count bigint, following_count bigint, lifetime_likes bigint, video_count bigint,
    bio string, bio_link string, is_verified boolean, is_private boolean,
    is_commerce_account boolean, scrape_status string, created_at timestamp
"""

VIDEOS = """
    video_id string, creator_id string, posted_at timestamp, is_ad boolean,
    text_language string, web_video_url string, first_seen_at timestamp
"""

VIDEO_SNAPSHOTS = """
    snapshot_id string, video_id string, snapshot_date date, play_count bigint,
    digg_count bigint, comment_count bigint, share_count bigint, collect_count bigint,
    created_at timestamp
"""

CREATOR_SCORES = """
    score_id string, creator_id string, score_version string, computed_at timestamp,
    engagement_rate double, growth_rate double, posting_consistency double,
    account_type string, tier string, flags array<string>
"""

OUTREACH_QUEUE = "creator_id string, tier string, pushed_at timestamp, status string"
