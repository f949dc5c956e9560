"""Business rules as one immutable value that every operator accepts.

A campaign changes behaviour with ``dataclasses.replace(Rules(), ...)``; no
operator holds a threshold of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

# Status, tier and reason names found in stored rows.
ACTIVE = "active"
PENDING, IN_PROGRESS, DONE, FAILED = "pending", "in_progress", "done", "failed"
PARSED = "parsed"
SUCCESS, NO_DATA, FETCH_FAILED = "success", "no_data", "fetch_failed"
TIER_A, TIER_B, TIER_C = "A", "B", "C"
REJECT, NEEDS_REVIEW = "Reject", "needs_review"
NEW_CANDIDATE, SCHEDULED_REFRESH = "new_candidate", "scheduled_refresh"
PLATFORM, HASHTAG_SOURCE = "tiktok", "tiktok_hashtag"

# Error texts written to the quarantine table.
MISSING_AUTHOR = "Missing or malformed authorMeta in hashtag payload"
MISSING_PROFILE = "Profile fetch payload missing 'profile_item'"
NOT_AN_OBJECT = "Payload is not a JSON object"

# What an HTTP status means for whoever reads the failure report.
HTTP_LABELS = (
    (401, "auth failed"),
    (402, "quota exhausted"),
    (403, "forbidden"),
    (404, "source not found"),
    (429, "rate limited"),
    (500, "server error"),
    (503, "service unavailable"),
)


@dataclass(frozen=True)
class Rules:
    # Tiering
    min_followers: int = 5_000
    engagement_a: float = 0.06
    engagement_b: float = 0.03
    engagement_c: float = 0.01

    # Suspicion, both strict
    max_engagement: float = 0.25
    max_growth: float = 1.0

    # Signal windows
    growth_days: int = 30
    posting_days: int = 30
    recent_videos: int = 30

    # Account type, matched as lower-case substrings
    reseller_keywords: tuple[str, ...] = ("shop", "store", "discount code", "use code", "link in bio")
    storefront_domains: tuple[str, ...] = ("shopify", "etsy.com", "gumroad", "linktr.ee/shop")
    excluded_accounts: tuple[str, ...] = ("brand", "reseller")

    # Handoff and refresh
    handoff_tiers: tuple[str, ...] = (TIER_A, TIER_B)
    # Days between refreshes of a tier
    refresh_days: tuple[tuple[str, int], ...] = (
        (TIER_A, 7),
        (TIER_B, 14),
        (TIER_C, 30),
        (REJECT, 90),
        (NEEDS_REVIEW, 3),
    )
    other_refresh_days: int = 30
    candidate_priority: int = 5
    refresh_priority: int = 1
    score_version: str = "v1"

    # Batch sizes of the polled jobs
    fetch_batch: int = 25
    items_per_fetch: int = 30

    # Monitoring
    discovery_hours: int = 24
    ingestion_hours: int = 2
    min_arrivals: int = 1
    max_queue_failures: float = 0.2
    max_parse_failures: float = 0.1
    max_quota_errors: int = 5
    freshness_grace_days: int = 2
    # Marks of exhausted quota in error texts
    quota_markers: tuple[str, ...] = ("402", "429", "payment required", "rate limit")

    # Failure summaries
    http_labels: tuple[tuple[int, str], ...] = HTTP_LABELS
    message_chars: int = 200
