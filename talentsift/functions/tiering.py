"""Tier decision as one CASE expression, and the per-tier refresh interval."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talentsift.rules import (
    FETCH_FAILED,
    NEEDS_REVIEW,
    NO_DATA,
    REJECT,
    TIER_A,
    TIER_B,
    TIER_C,
    Rules,
)

UNKNOWN_GROWTH = "growth_unknown_first_snapshot"
LOW_ENGAGEMENT = "below_engagement_threshold"


def _verdict(tier: str, *flags: Column | str) -> Column:
    listed = [F.lit(flag) if isinstance(flag, str) else flag for flag in flags]
    return F.struct(
        F.lit(tier).alias("tier"),
        F.array_compact(F.array(*listed)).cast("array<string>").alias("flags"),
    )


def assign_tier(
    followers: Column,
    engagement: Column,
    growth_rate: Column,
    account: Column,
    scrape_status: Column,
    is_suspicious: Column,
    rules: Rules,
) -> Column:
    """``struct(tier, flags)``; the first matching arm decides.

    Failed scrapes come first because their empty signals look like low
    engagement. An unknown growth rate only marks the tier as provisional.
    """
    big_enough = F.coalesce((followers != 0) & (followers >= rules.min_followers), F.lit(False))
    provisional = F.when(growth_rate.isNull(), F.lit(UNKNOWN_GROWTH))
    return (
        F.when(scrape_status == FETCH_FAILED, _verdict(NEEDS_REVIEW, "fetch_failed"))
        .when((scrape_status == NO_DATA) & big_enough, _verdict(NEEDS_REVIEW, "no_data_high_followers"))
        .when(scrape_status == NO_DATA, _verdict(REJECT, "no_data_low_followers"))
        .when(
            account.isin(*rules.excluded_accounts),
            _verdict(REJECT, F.concat(F.lit("excluded_account_type:"), account)),
        )
        .when(~big_enough, _verdict(REJECT, "below_minimum_followers"))
        .when(is_suspicious, _verdict(NEEDS_REVIEW, "suspicious_growth"))
        .when(engagement.isNull(), _verdict(NEEDS_REVIEW, "insufficient_engagement_data"))
        .when(engagement >= rules.engagement_a, _verdict(TIER_A, provisional))
        .when(engagement >= rules.engagement_b, _verdict(TIER_B, provisional))
        .when(engagement >= rules.engagement_c, _verdict(TIER_C, provisional))
        .otherwise(_verdict(REJECT, provisional, LOW_ENGAGEMENT))
    )


def refresh_interval(tier: Column, rules: Rules) -> Column:
    """Days between refreshes; unscored creators wait as long as ones under review."""
    arms = F
    for name, days in rules.refresh_days:
        arms = arms.when(F.coalesce(tier, F.lit(NEEDS_REVIEW)) == name, F.lit(days))
    return arms.otherwise(F.lit(rules.other_refresh_days))
