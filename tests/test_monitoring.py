from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from talentsift.operators import monitor, reports
from talentsift.rules import Rules

RULES = Rules()
NOW = datetime(2026, 1, 31)
EVENTS = "source string, discovered_at timestamp"
RAW = "fetched_at timestamp, parse_status string"
QUEUE = "status string, error string"
SCORES = "creator_id int, tier string"
SNAPSHOTS = "creator_id int, snapshot_date date"


def named(frame):
    return {r["name"]: r for r in frame.collect()}


def all_checks(spark, events=(), raw=(), queue=(), scores=(), snapshots=()):
    make = spark.createDataFrame
    return monitor.all_checks(
        make(list(events), EVENTS),
        make(list(raw), RAW),
        make(list(queue), QUEUE),
        make(list(scores), SCORES),
        make(list(snapshots), SNAPSHOTS),
        F.lit(NOW),
        RULES,
    )


def test_empty_tables_alarm_on_freshness_only(spark):
    checks = named(all_checks(spark))
    assert len(checks) == 10
    assert {name for name, check in checks.items() if not check.passed} == {
        "discovery_freshness",
        "ingestion_freshness",
    }
    assert checks["ingestion_health"].message == "No ingestion queue activity yet"
    assert checks["parse_error_rate"].message == "No raw payloads processed yet"
    assert checks["tier_freshness_A"].message == "No creators in tier A yet"
    assert checks["discovery_freshness"].message == "0 discovery events in the last 24h (expected >= 1)"


def test_cutoffs_include_their_moment(spark):
    events = [("s", NOW - timedelta(hours=24))]
    raw = [(NOW - timedelta(hours=2, seconds=1), "parsed")]
    checks = named(all_checks(spark, events=events, raw=raw))
    assert checks["discovery_freshness"].passed
    assert not checks["ingestion_freshness"].passed


def test_quota_exhaustion_says_what_to_check(spark):
    checks = named(all_checks(spark, queue=[("failed", "HTTP 402 (x)")] * 54 + [("done", None)] * 300))
    assert not checks["quota_exhaustion"].passed
    assert "54" in checks["quota_exhaustion"].message and "check usage" in checks["quota_exhaustion"].message
    assert checks["ingestion_health"].passed
    few = named(all_checks(spark, queue=[("failed", "HTTP 429")] * 5 + [("done", None)] * 95))
    assert few["quota_exhaustion"].passed and "check usage" not in few["quota_exhaustion"].message


@pytest.mark.parametrize(("failed", "passed"), [(20, True), (21, False)])
def test_failure_rate_limit_is_inclusive(spark, failed, passed):
    queue = [("failed", None)] * failed + [("done", None)] * (100 - failed)
    assert named(all_checks(spark, queue=queue))["ingestion_health"].passed is passed


def test_failure_rate_of_an_empty_table_is_unknown(spark):
    row = reports.failure_rate(spark.createDataFrame([], QUEUE), "status").first()
    assert (row.failed, row.total, row.rate) == (0, 0, None)


def test_tier_freshness_uses_any_creator_ever_in_the_tier(spark):
    day = NOW.date()
    scores = [(1, "A"), (1, "B"), (2, "A"), (2, "A"), (3, "C")]
    snapshots = [(1, day - timedelta(days=17)), (2, day - timedelta(days=10)), (2, day - timedelta(days=90))]
    checks = named(all_checks(spark, scores=scores, snapshots=snapshots))
    assert (checks["tier_freshness_A"].measured, checks["tier_freshness_A"].passed) == (10.0, False)
    assert (checks["tier_freshness_B"].measured, checks["tier_freshness_B"].passed) == (17.0, False)
    assert checks["tier_freshness_C"].passed
    assert checks["tier_freshness_A"].message == "Tier A most recent snapshot is 10d old (SLA 7d)"
    ok = named(all_checks(spark, scores=[(1, "A")], snapshots=[(1, day - timedelta(days=9))]))
    assert ok["tier_freshness_A"].passed


def test_alarms_join_tiers_and_fail_the_job(spark):
    day = NOW.date()
    old = [(1, day - timedelta(days=100))]
    checks = all_checks(spark, events=[("s", NOW)], raw=[(NOW, "parsed")], scores=[(1, "A"), (1, "B")], snapshots=old)
    alarms = monitor.failed_checks(checks).collect()
    assert [a.alarm for a in alarms] == ["tier_freshness"]
    assert alarms[0].message.count("; ") == 1
    with pytest.raises(RuntimeError, match=r"\[tier_freshness\] Tier A .*; Tier B"):
        monitor.raise_on_failure(checks)
    monitor.raise_on_failure(checks.where(F.col("passed")))


def test_counts_on_empty_input_still_give_a_row(spark):
    empty = spark.createDataFrame([], EVENTS)
    assert reports.count_since(empty, "discovered_at", F.lit(NOW)).first().n == 0


def test_silent_windows_show_as_zero(spark):
    stamp = datetime(2026, 1, 1)
    counts = spark.createDataFrame(
        [(stamp, 3), (stamp + timedelta(hours=1), 4)], "window_start timestamp, n bigint"
    )
    filled = monitor.with_silent_windows(counts, "15 minutes").orderBy("window_start").collect()
    assert [r.n for r in filled] == [3, 0, 0, 0, 4]


def test_silence_of_years_is_listed_by_day_in_many_tasks(spark):
    stamp = datetime(2020, 3, 1, 23, 50)
    frame = [(stamp, 1), (stamp + timedelta(minutes=50 * 25_000), 2)]
    filled = monitor.with_silent_windows(spark.createDataFrame(frame, "window_start timestamp, n bigint"), "50 minutes")
    assert filled.count() == 25_001 and filled.agg(F.sum("n")).first()[0] == 3
    gaps = filled.select((F.unix_seconds("window_start") - F.unix_seconds(F.lit(stamp).cast("timestamp"))) % 3000).distinct().collect()
    assert [r[0] for r in gaps] == [0]


def test_latest_by_tier_does_not_multiply_scores_by_snapshots(spark):
    scores = spark.createDataFrame([(1, "A")] * 50 + [(2, "B")], SCORES)
    snapshots = spark.createDataFrame([(1, date(2026, 1, d)) for d in range(1, 29)] + [(9, date(2026, 2, 1))], SNAPSHOTS)
    got = {r.tier: r.latest_snapshot for r in monitor.latest_snapshot_by_tier(scores, snapshots).collect()}
    assert got == {"A": date(2026, 1, 28)}
