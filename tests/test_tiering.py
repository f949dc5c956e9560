from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from talentsift.functions.tiering import refresh_interval
from talentsift.plans.score import with_tier
from talentsift.rules import Rules

SCHEMA = """follower_count bigint, engagement_rate double, growth_rate double, account_type string,
            scrape_status string, suspicious_growth boolean"""
BASE = {
    "follower_count": 50_000,
    "engagement_rate": 0.08,
    "growth_rate": 0.05,
    "account_type": "creator",
    "scrape_status": "success",
    "suspicious_growth": False,
}


def verdict(spark, rules: Rules = Rules(), **changes):
    signals = {**BASE, **changes}
    row = with_tier(spark.createDataFrame([tuple(signals.values())], SCHEMA), rules).first()
    return row.tier, row.flags


@pytest.mark.parametrize(
    ("changes", "tier", "flags"),
    [
        ({}, "A", []),
        ({"engagement_rate": 0.06}, "A", []),
        ({"engagement_rate": 0.04}, "B", []),
        ({"engagement_rate": 0.03}, "B", []),
        ({"engagement_rate": 0.015}, "C", []),
        ({"engagement_rate": 0.005}, "Reject", ["below_engagement_threshold"]),
        ({"growth_rate": None}, "A", ["growth_unknown_first_snapshot"]),
        (
            {"growth_rate": None, "engagement_rate": 0.005},
            "Reject",
            ["growth_unknown_first_snapshot", "below_engagement_threshold"],
        ),
        ({"scrape_status": "fetch_failed", "engagement_rate": None}, "needs_review", ["fetch_failed"]),
        (
            {"scrape_status": "no_data", "follower_count": 200_000, "engagement_rate": None},
            "needs_review",
            ["no_data_high_followers"],
        ),
        ({"scrape_status": "no_data", "follower_count": 1_000}, "Reject", ["no_data_low_followers"]),
        ({"scrape_status": "no_data", "follower_count": None}, "Reject", ["no_data_low_followers"]),
        ({"scrape_status": "private_account", "follower_count": None}, "Reject", ["below_minimum_followers"]),
        ({"account_type": "reseller", "engagement_rate": 0.2}, "Reject", ["excluded_account_type:reseller"]),
        ({"account_type": "brand", "follower_count": 1}, "Reject", ["excluded_account_type:brand"]),
        ({"follower_count": 500, "engagement_rate": 0.5}, "Reject", ["below_minimum_followers"]),
        ({"follower_count": 0}, "Reject", ["below_minimum_followers"]),
        ({"engagement_rate": 0.3, "suspicious_growth": True}, "needs_review", ["suspicious_growth"]),
        ({"engagement_rate": None}, "needs_review", ["insufficient_engagement_data"]),
    ],
)
def test_decision_list(spark, changes, tier, flags):
    assert verdict(spark, **changes) == (tier, flags)


def test_rules_move_the_thresholds(spark):
    assert verdict(spark, replace(Rules(), engagement_a=0.1)) == ("B", [])
    assert verdict(spark, replace(Rules(), min_followers=0), follower_count=0)[0] == "Reject"
    assert verdict(spark, replace(Rules(), excluded_accounts=("brand",)), account_type="reseller") == ("A", [])


def test_refresh_interval_defaults(spark):
    tiers = ["A", "B", "C", "Reject", "needs_review", "unheard_of", None]
    frame = spark.createDataFrame([(t,) for t in tiers], "tier string")
    days = [row.d for row in frame.select(refresh_interval(F.col("tier"), Rules()).alias("d")).collect()]
    assert days == [7, 14, 30, 90, 3, 30, 3]
