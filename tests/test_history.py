from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from talentsift.operators import dedup, latest, videos
from talentsift.plans import discover, enrich, handoff, score
from talentsift.operators.parsing import parse_payloads
from talentsift.operators.parsing import videos as parsed_videos
from talentsift.functions.keys import creator_key
from talentsift.rules import Rules
from tests.conftest import plan_of, rows
from tests.test_parsing import ITEM, RAW, SECOND, STAMP

RULES = Rules()
SNAPSHOTS = "snapshot_id int, creator_id int, snapshot_date date, created_at timestamp, follower_count bigint"


def history(hot_share: float, n: int = 3000, seed: int = 7):
    """Snapshots where creator 0 owns a third of all rows and days repeat."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        creator = 0 if rng.random() < hot_share else rng.randint(1, 200)
        day = date(2026, 1, 1) + timedelta(days=rng.randint(0, 40))
        data.append((i, creator, day, datetime(2026, 3, 1) + timedelta(seconds=rng.randint(0, 500)), rng.randint(0, 10**6)))
    return data


def newest_first(data):
    grouped: dict[int, list] = {}
    for row in data:
        grouped.setdefault(row[1], []).append(row)
    return {k: sorted(v, key=lambda r: (r[2], r[3], r[0]), reverse=True) for k, v in grouped.items()}


def test_latest_n_with_a_hot_key_equals_brute_force(spark):
    data = history(1 / 3)
    frame = spark.createDataFrame(data, SNAPSHOTS).repartition(8)
    got = latest.latest_n(frame, ["creator_id"], latest.snapshot_order(), 2, rank_as="n")
    expected = {(r[0], i + 1) for group in newest_first(data).values() for i, r in enumerate(group[:2])}
    assert {(r.snapshot_id, r.n) for r in got.collect()} == expected
    plan = plan_of(got)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_previous_snapshot_comes_from_the_same_sort(spark):
    data = history(1 / 3, seed=8)
    frame = spark.createDataFrame(data, SNAPSHOTS).repartition(8)
    pair = latest.latest_with_previous(frame, ["creator_id"], latest.snapshot_order(), ["follower_count"])
    expected = {k: (g[0][0], g[1][4] if len(g) > 1 else None) for k, g in newest_first(data).items()}
    assert {r.creator_id: (r.snapshot_id, r.previous_follower_count) for r in pair.collect()} == expected
    assert plan_of(pair).count("Exchange hashpartitioning(creator_id") == 1


def test_ties_for_latest_are_all_kept(spark):
    data = [(1, 1, 5), (2, 1, 5), (3, 1, 4), (4, 2, 1)] + [(10 + i, 9, 7) for i in range(500)]
    frame = spark.createDataFrame(data, "id int, k int, t int").repartition(8)
    kept = {r.id for r in latest.latest_with_ties(frame, ["k"], "t").collect()}
    assert kept == {1, 2, 4} | {10 + i for i in range(500)}


VIDEOS = "video_id string, creator_id int, posted_at timestamp, is_ad boolean"
COUNTERS = """snapshot_id int, video_id string, snapshot_date date, created_at timestamp, play_count bigint,
              digg_count bigint, comment_count bigint, share_count bigint"""
DAY = datetime(2026, 1, 10)


def counters(spark, *data):
    full = [(i, v, date(2026, 1, day), DAY, None, digg, comment, share) for i, (v, day, digg, comment, share) in enumerate(data)]
    return spark.createDataFrame(full, COUNTERS)


def test_recent_videos_limit_precedes_losses_and_puts_undated_first(spark):
    listed = spark.createDataFrame(
        [("old", 1, DAY - timedelta(days=9), False), ("undated", 1, None, False), ("bare", 1, DAY, False), ("ad", 1, DAY - timedelta(days=1), True)],
        VIDEOS,
    )
    snapshots = counters(spark, ("old", 1, 1, 1, 1), ("undated", 1, 5, None, 1), ("undated", 2, 7, None, None), ("ad", 1, 9, 9, 9))
    rules = Rules(recent_videos=3)
    recent = videos.recent_video_engagement(listed, snapshots, rules)
    assert {(r.video_id, r.digg_count) for r in recent.collect()} == {("undated", 7), ("ad", 9)}
    summary = videos.video_summary(recent, F.lit("2026-01-31").cast("date"), rules).first()
    assert (summary.organic_interactions, summary.organic_videos) == (7, 1)
    assert (summary.dated_videos, summary.videos_in_window) == (1, 1)


FULL = SNAPSHOTS + """, handle string, lifetime_likes bigint, video_count bigint, bio string, bio_link string,
    is_commerce_account boolean, scrape_status string"""


def snapshot(i, creator, day, followers=100_000, likes=8_000_000, count=200, status="success", bio="skin tips", commerce=False):
    return (i, creator, day, DAY, followers, f"h{creator}", likes, count, bio, None, commerce, status)


def creators(spark, *ids, status="active"):
    return spark.createDataFrame([(i, "tiktok", str(i), status) for i in ids], "creator_id int, platform string, external_id string, status string")


def signals(spark, who, snaps, listed=(), counts=()):
    frame = score.creator_signals(
        who,
        spark.createDataFrame(list(snaps), FULL),
        spark.createDataFrame(list(listed), VIDEOS),
        counters(spark, *counts) if counts else spark.createDataFrame([], COUNTERS),
        F.lit("2026-01-31").cast("timestamp"),
        RULES,
    )
    return {r.creator_id: r for r in frame.collect()}


def test_signals_of_a_first_snapshot(spark):
    got = signals(spark, creators(spark, 1), [snapshot(1, 1, date(2026, 1, 5))])[1]
    assert (got.engagement_rate, got.growth_rate, got.scrape_status) == (0.4, None, "success")
    assert (got.account_type, got.suspicious_growth) == ("creator", True)


def test_signals_without_snapshot_or_with_failed_scrape(spark):
    snaps = [snapshot(1, 2, date(2026, 1, 5)), snapshot(2, 2, date(2026, 1, 6), None, None, None, "no_data", None)]
    got = signals(spark, creators(spark, 1, 2).unionByName(creators(spark, 3, status="inactive")), snaps)
    assert set(got) == {1, 2}
    assert (got[1].scrape_status, got[1].follower_count, got[1].account_type) == ("fetch_failed", None, "creator")
    assert (got[2].scrape_status, got[2].engagement_rate, got[2].growth_rate) == ("no_data", None, None)


def test_failed_previous_snapshot_hides_older_success(spark):
    snaps = [
        snapshot(1, 1, date(2026, 1, 1), 1000),
        snapshot(2, 1, date(2026, 1, 10), None, None, None, "fetch_failed"),
        snapshot(3, 1, date(2026, 1, 16), 1100),
    ]
    assert signals(spark, creators(spark, 1), snaps)[1].growth_rate is None


def test_engagement_falls_back_to_recent_videos(spark):
    listed = [("v", 1, DAY, False), ("ad", 1, DAY, True)]
    counts = [("v", 1, 100, 10, 5), ("ad", 1, 99_999, 0, 0)]
    got = signals(spark, creators(spark, 1), [snapshot(1, 1, date(2026, 1, 5), 1000, None)], listed, counts)[1]
    assert got.engagement_rate == 0.115
    assert got.posting_consistency == 2 / (30 / 7)


def test_scores_carry_version_and_posting_rate_of_failed_scrapes(spark):
    frame = score.score_creators(
        creators(spark, 1),
        spark.createDataFrame([snapshot(1, 1, date(2026, 1, 5), status="fetch_failed")], FULL),
        spark.createDataFrame([("v", 1, DAY, False)], VIDEOS),
        counters(spark, ("v", 1, 1, 1, 1)),
        F.lit("2026-01-31").cast("timestamp"),
        RULES,
    )
    row = frame.first()
    assert (row.tier, row.flags, row.score_version) == ("needs_review", ["fetch_failed"], "v1")
    assert row.posting_consistency == 1 / (30 / 7)
    assert frame.first().score_id == row.score_id


SCORES = "score_id int, creator_id int, score_version string, computed_at timestamp, engagement_rate double, tier string"


@pytest.mark.parametrize(
    ("tier", "age", "due"),
    [("A", 6, False), ("A", 7, True), ("B", 13, False), ("B", 14, True), ("Reject", 89, False), (None, 2, False), (None, 3, True), ("odd", 29, False), ("odd", 30, True)],
)
def test_refresh_is_due_at_the_interval(spark, tier, age, due):
    scores = spark.createDataFrame([(1, 1, "v2", DAY, 0.1, tier)] if tier else [], SCORES)
    snaps = spark.createDataFrame([snapshot(1, 1, date(2026, 1, 31) - timedelta(days=age))], FULL)
    frame = discover.due_for_refresh(creators(spark, 1), scores, snaps, F.lit("2026-01-31").cast("timestamp"), RULES)
    assert rows(frame) == ([("tiktok", "1", "h1")] if due else [])


def test_refresh_of_unseen_creators_uses_the_external_id(spark):
    nothing = spark.createDataFrame([], FULL)
    scores = spark.createDataFrame([], SCORES)
    who = creators(spark, 1).unionByName(creators(spark, 2, status="inactive"))
    frame = discover.due_for_refresh(who, scores, nothing, F.lit("2026-01-31").cast("timestamp"), RULES)
    assert rows(frame) == [("tiktok", "1", "1")]


def test_refresh_can_use_the_handle_of_the_last_success(spark):
    failed, good = snapshot(2, 1, date(2026, 1, 20), status="fetch_failed"), snapshot(1, 1, date(2026, 1, 5))
    snaps = spark.createDataFrame([failed, good], FULL).withColumn("handle", F.when(F.col("scrape_status") == "fetch_failed", "1").otherwise(F.lit("name")))
    scores = spark.createDataFrame([], SCORES)
    who = creators(spark, 1).unionByName(creators(spark, 2))
    as_of = F.lit("2026-01-31").cast("timestamp")
    assert rows(discover.due_for_refresh(who, scores, snaps, as_of, RULES)) == [("tiktok", "1", "1"), ("tiktok", "2", "2")]
    assert rows(discover.due_for_refresh(who, scores, snaps, as_of, RULES, last_success_handle=True)) == [("tiktok", "1", "name"), ("tiktok", "2", "2")]


def test_outreach_takes_latest_ab_scores_once(spark):
    later = DAY + timedelta(days=1)
    scores = spark.createDataFrame(
        [(1, 1, "v1", DAY, 0.1, "A"), (2, 1, "v1", later, 0.1, "C"), (3, 2, "v1", DAY, 0.1, "B"), (4, 3, "v2", DAY, 0.1, "B"), (5, 3, "v1", DAY, 0.1, "A"), (6, 4, "v1", DAY, 0.1, "A")],
        SCORES,
    )
    queued = spark.createDataFrame([(4, "pending")], "creator_id int, status string")
    ready = handoff.outreach_ready(scores, queued, RULES)
    assert rows(ready) == [(2, "B"), (3, "A"), (3, "B")]
    pushed = handoff.outreach_push(scores, queued, F.lit(DAY), RULES)
    assert [r[:2] for r in rows(pushed)] == [(2, "B"), (3, "A")]
    again = handoff.outreach_push(scores, queued.unionByName(pushed.select("creator_id", "status")), F.lit(DAY), RULES)
    assert again.count() == 0


def test_a_tier_report_lists_every_current_version_score_best_first(spark):
    scores = spark.createDataFrame(
        [(1, 1, "v1", DAY, 0.1, "A"), (2, 1, "v1", DAY, None, "A"), (3, 1, "v2", DAY, 0.9, "A"), (4, 2, "v1", DAY, 0.3, "A"), (5, 3, "v1", DAY, 0.5, "A")],
        SCORES,
    )
    snaps = spark.createDataFrame([snapshot(1, 1, date(2026, 1, 1)), snapshot(2, 2, date(2026, 1, 1))], FULL)
    queued = spark.createDataFrame([], "creator_id int, status string")
    report = handoff.a_tier_candidates(scores, creators(spark, 1, 2, 3), snaps, queued, RULES)
    assert [(r.creator_id, r.engagement_rate) for r in report.collect()] == [(1, None), (2, 0.3), (1, 0.1)]


def test_creator_upsert_reactivates_and_keeps_first_discovery(spark):
    key = spark.range(1).select(creator_key(F.lit("t"), F.lit("9")).alias("k")).first().k
    stored = spark.createDataFrame(
        [("c1", "t", "1", DAY, DAY, "inactive"), ("c2", "t", "2", DAY, DAY, "needs_review")],
        "creator_id string, platform string, external_id string, first_discovered_at timestamp, last_seen_at timestamp, status string",
    )
    later = DAY + timedelta(days=3)
    seen = spark.createDataFrame([("t", "1", later), ("t", "9", later), ("t", "9", DAY)], "platform string, external_id string, seen_at timestamp")
    after = dedup.upsert_creators(stored, seen)
    expected = [("c1", "t", "1", DAY, later, "active"), ("c2", "t", "2", DAY, DAY, "needs_review"), (key, "t", "9", DAY, later, "active")]
    assert rows(after) == sorted(expected, key=repr)
    assert rows(dedup.upsert_creators(after, seen)) == rows(after)


def parsed_batch(spark, *payloads):
    import json

    data = [(str(i), "tiktok", "profile", f"asked{i}", json.dumps(p), STAMP + timedelta(hours=i)) for i, p in enumerate(payloads)]
    return parse_payloads(spark.createDataFrame(data, RAW))


def test_failed_fetch_leaves_a_snapshot_and_quarantine_does_not(spark):
    parsed = parsed_batch(spark, {"ok": False, "reason": "no_data"}, {"profile_item": ITEM, "video_items": []}, {"profile_item": {}})
    snaps = {r.raw_id: r for r in enrich.profile_snapshots(parsed, F.lit(STAMP)).collect()}
    assert set(snaps) == {"0", "1"}
    assert (snaps["0"].scrape_status, snaps["0"].handle, snaps["0"].follower_count) == ("no_data", "asked0", None)
    assert (snaps["0"].is_verified, snaps["1"].scrape_status) == (False, "success")
    assert snaps["1"].snapshot_date == STAMP.date()
    asked = spark.range(1).select(creator_key(F.lit("tiktok"), F.lit("asked1")).alias("k")).first().k
    assert snaps["1"].creator_id == asked
    assert {r.external_id for r in enrich.sightings(parsed, F.lit(STAMP)).collect()} == {"asked0", "asked1"}


def test_first_sighting_of_a_video_wins_and_stored_videos_stay(spark):
    parsed = parsed_batch(
        spark,
        {"profile_item": ITEM, "video_items": [{**ITEM, "isAd": True}, ITEM]},
        {"profile_item": ITEM, "video_items": [ITEM, SECOND]},
    )
    listed = parsed_videos(parsed)
    known = spark.createDataFrame([(SECOND["id"],)], "video_id string")
    added = enrich.new_videos(listed, known, F.lit(STAMP))
    assert [(r.video_id, r.is_ad) for r in added.collect()] == [(ITEM["id"], True)]
    everything = known.unionByName(added.select("video_id"))
    assert enrich.new_videos(listed, everything, F.lit(STAMP)).count() == 0
    assert enrich.video_snapshots(listed, F.lit(STAMP)).count() == 4


def test_ids_keep_separators_and_nulls_apart(spark):
    parts = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("c", None), ("", "c"), ('a","b', "c"), ("a", 'b","c'), ("null", "c")]
    frame = spark.createDataFrame(parts, "p string, e string")
    keys = [r[0] for r in frame.select(creator_key(F.col("p"), F.col("e"))).collect()]
    assert len(set(keys)) == len(parts)
