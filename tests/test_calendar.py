from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from talentsift.plans import calendar
from talentsift.plans.discover import due_for_refresh
from talentsift.rules import Rules
from talentsift.sources.rounds import RoundStore
from tests.conftest import plan_of, rows

CREATOR = "creator_id string, platform string, external_id string, status string"
SNAPSHOT = "snapshot_id string, creator_id string, snapshot_date date, created_at timestamp, handle string, scrape_status string"
SCORE = "score_id string, creator_id string, computed_at timestamp, tier string"
START = datetime(2024, 3, 1, 12)


@pytest.fixture
def store(spark, tmp_path):
    return RoundStore(spark, str(tmp_path / "store"), calendar.tables(buckets=4))


def _facts(seed):
    """Creators, snapshots and scores that land in each of four rounds, some late, some again."""
    rng = random.Random(seed)
    tiers = ["A", "B", "C", "Reject", "needs_review", None]
    landed = []
    for turn in range(4):
        day = START.date() + timedelta(days=10 * turn)
        snapshots = [
            (f"s{turn}-{n:02}", str(rng.randrange(20)), None if n == 7 else day - timedelta(days=rng.randrange(30)),
             START + timedelta(minutes=rng.randrange(5)), f"h{n}-{turn}", rng.choice(["success", "fetch_failed"]))
            for n in range(18)
        ]
        scores = [(f"t{turn}-{n:02}", str(rng.randrange(20)), START + timedelta(days=10 * turn, minutes=n), rng.choice(tiers)) for n in range(12)]
        creators = [(str(n), "tiktok", f"e{n}", "active" if (n + turn) % 5 else "inactive") for n in range(22) if turn == 0 or n % 4 == turn]
        landed.append((creators, snapshots + (landed[-1][1][:3] if landed else []), scores))
    return landed


@pytest.mark.parametrize("seed, last_success_handle", [(1, False), (2, True)])
def test_calendar_equals_the_full_scan_after_every_round_and_on_days_between(spark, store, seed, last_success_handle):
    creators, snapshots, scores = {}, [], []
    for turn, (told, shot, rated) in enumerate(_facts(seed)):
        at = START + timedelta(days=10 * turn)
        frames = [spark.createDataFrame(data, schema) for data, schema in ((told, CREATOR), (shot, SNAPSHOT), (rated, SCORE))]
        for _ in range(2 if turn == 1 else 1):  # a rerun replaces its round
            calendar.calendar_round(store, f"round-{turn}", at, *frames, Rules(), last_success_handle)
        creators |= {row[0]: row for row in told}
        snapshots, scores = snapshots + shot, scores + rated
        stored = ((list(creators.values()), CREATOR), (scores, SCORE), (snapshots, SNAPSHOT))
        everything = [spark.createDataFrame(data, schema) for data, schema in stored]
        for later in (0, 4, 9):
            as_of = at + timedelta(days=later)
            moment = F.lit(as_of).cast("timestamp")
            expected = due_for_refresh(*everything, moment, Rules(), last_success_handle)
            assert rows(calendar.due_by_calendar(store, as_of)) == rows(expected), (turn, later)
    # An earlier moment sees the rounds up to it only.
    assert calendar.due_by_calendar(store, START - timedelta(days=1)).count() == 0


def test_only_the_days_since_the_last_round_are_opened(spark, store):
    creators = spark.createDataFrame([(str(n), "tiktok", f"e{n}", "active") for n in range(40)], CREATOR)
    shots = [(f"s{n}", str(n), date(2024, 2, 1) + timedelta(days=n), START, "h", "success") for n in range(40)]
    snapshots = spark.createDataFrame(shots, SNAPSHOT)
    scores = spark.createDataFrame([(f"t{n}", str(n), START, "C") for n in range(40)], SCORE)
    calendar.calendar_round(store, "r", START, creators, snapshots, scores, Rules())
    due = calendar.due_by_calendar(store, START + timedelta(days=6))
    assert due.count() == 6  # snapshots of 1 to 6 February are 30 days old on 2 to 7 March
    plan = plan_of(due)
    pruned = [line for line in plan.splitlines() if "PartitionFilters" in line and "due_on" in line.split("PartitionFilters")[1]]
    assert pruned and "due_state" not in plan


def test_empty_rounds_have_nobody_due(spark, store):
    none = [spark.createDataFrame([], schema) for schema in (CREATOR, SNAPSHOT, SCORE)]
    calendar.calendar_round(store, "r", START, *none, Rules())
    assert calendar.due_by_calendar(store, START).count() == 0
    assert store.everything("due_state").count() == 0
