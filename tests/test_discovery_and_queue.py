from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from talentsift import schemas
from talentsift.functions import failures
from talentsift.operators import dedup, discovery, queue, reports
from talentsift.plans import discover, ingest
from talentsift.rules import HASHTAG_SOURCE, Rules
from talentsift.sources import landed
from talentsift.sources.tables import append_daily, read_table, write_batch
from talentsift.streaming import jobs
from tests.conftest import rows

RULES = Rules()
ITEMS = "query string, pos bigint, item string"


def items(spark, *authors, query="skincare"):
    data = []
    for pos, author in enumerate(authors):
        item = author if "authorMeta.id" in author else {"id": f"v{pos}", "authorMeta": author}
        data.append((query, pos, json.dumps(item)))
    return spark.createDataFrame(data, ITEMS)


def found(frame, **changes):
    candidates = discovery.discover(HASHTAG_SOURCE, frame, replace(RULES, **changes))
    return sorted((r.query, r.external_id) for r in candidates.collect())


def test_follower_floor(spark):
    frame = items(spark, {"id": "1", "fans": 100_000}, {"id": "2", "fans": 100}, {"id": "3"})
    assert found(frame) == [("skincare", "1")]
    assert len(found(frame, min_followers=0)) == 3


def test_first_occurrence_decides_before_the_floor(spark):
    frame = items(spark, {"id": "1", "fans": 10}, {"id": "1", "fans": 900_000})
    assert found(frame) == []


def test_authors_repeat_across_queries_but_not_within(spark):
    one = items(spark, {"id": "1", "fans": 9000}, {"id": "1", "fans": 9000}, query="a")
    two = items(spark, {"id": "1", "fans": 9000}, query="b")
    assert found(one.unionByName(two)) == [("a", "1"), ("b", "1")]


def test_flattened_key_wins_even_when_null(spark):
    flat = {"authorMeta.id": "7", "authorMeta.name": None, "authorMeta.fans": None, "authorMeta": {"id": "8", "name": "n", "fans": 9000}}
    sighting = discovery.author_sightings(items(spark, flat)).first()
    assert (sighting.external_id, sighting.handle, sighting.follower_count) == ("7", "", None)


@pytest.mark.parametrize("bad", ["", 0, None, False, [], {}])
def test_items_without_author_are_dropped(spark, bad):
    assert found(items(spark, {"id": bad, "fans": 9000}), min_followers=0) == []


def test_candidate_carries_identity_only(spark):
    frame = discovery.discover(HASHTAG_SOURCE, items(spark, {"id": 5, "name": "n", "fans": 9000}), RULES).drop("pos")
    assert frame.columns == ["platform", "external_id", "handle", "source", "query"]
    assert rows(frame) == [("tiktok", "5", "n", "tiktok_hashtag", "skincare")]


def test_sources_can_be_registered(spark):
    @discovery.discovery_source("everything")
    def everything(frame, rules):
        return frame.select(F.lit("x").alias("external_id"))

    try:
        assert discovery.discover("everything", items(spark, {"id": 1}), RULES).first().external_id == "x"
    finally:
        del discovery.SOURCES["everything"]


INCOMING = "platform string, external_id string, handle string, reason string, priority int, pos int"
QUEUE_KEYS = "platform string, external_id string, status string"


def test_enqueue_is_idempotent_and_ignores_finished_rows(spark):
    incoming = spark.createDataFrame(
        [("t", "1", "h1", "new_candidate", 5, 0), ("t", "1", "late", "scheduled_refresh", 1, 1), ("t", "2", "h2", "new_candidate", 5, 2), ("t", "3", "h3", "new_candidate", 5, 3)],
        INCOMING,
    )
    state = spark.createDataFrame([("t", "2", "pending"), ("t", "3", "done"), ("x", "1", "pending")], QUEUE_KEYS)
    added = dedup.enqueue(incoming, state, [F.asc("pos")]).drop("pos")
    assert rows(added) == [
        ("t", "1", "h1", "new_candidate", 5, "pending"),
        ("t", "3", "h3", "new_candidate", 5, "pending"),
    ]
    again = dedup.enqueue(incoming, state.unionByName(added.select("platform", "external_id", "status")), [F.asc("pos")])
    assert again.count() == 0


def test_candidates_win_over_refreshes_of_the_same_round(spark):
    candidates = spark.createDataFrame(
        [("t", "1", "h", "s", "b", 9), ("t", "1", "h", "s", "a", 3)],
        "platform string, external_id string, handle string, source string, query string, pos bigint",
    )
    due = spark.createDataFrame([("t", "1", "old"), ("t", "2", "r")], "platform string, external_id string, handle string")
    added = discover.enqueue_round(candidates, due, spark.createDataFrame([], QUEUE_KEYS), RULES)
    assert rows(added) == [
        ("t", "1", "h", "new_candidate", 5, "pending"),
        ("t", "2", "r", "scheduled_refresh", 1, "pending"),
    ]


STATE = "queue_id string, priority int, enqueued_at timestamp, status string, error string"
NOON = datetime(2026, 1, 1, 12)


@pytest.fixture
def state(spark):
    return spark.createDataFrame(
        [
            ("a", 5, NOON, "pending", None),
            ("b", 1, NOON + timedelta(hours=1), "pending", "HTTP 404"),
            ("c", 1, NOON, "pending", None),
            ("d", 1, NOON, "done", "kept"),
            ("e", 5, NOON, "pending", None),
        ],
        STATE,
    )


def test_dequeue_takes_the_most_urgent(state):
    assert [r.queue_id for r in queue.next_batch(state, 3).collect()] == ["c", "b", "a"]
    taken = {r.queue_id: r.status for r in queue.mark_in_progress(state, 3).collect()}
    assert taken == {"a": "in_progress", "b": "in_progress", "c": "in_progress", "d": "done", "e": "pending"}


def test_completion_overwrites_the_error_only_with_a_new_one(spark, state):
    outcomes = spark.createDataFrame([("b", "done", None), ("c", "failed", "HTTP 503")], "queue_id string, status string, error string")
    after = {r.queue_id: (r.status, r.error) for r in queue.complete(state, outcomes).collect()}
    assert after["b"] == ("done", "HTTP 404")
    assert after["c"] == ("failed", "HTTP 503")
    assert after["d"] == ("done", "kept")


def test_failure_summaries(spark):
    log = spark.createDataFrame(
        [("http", 429, None, None), ("http", 418, None, None), ("timeout", None, None, None), ("other", None, "KeyError", "x" * 300)],
        "kind string, code int, type string, message string",
    )
    got = [r[0] for r in log.select(failures.summarize(F.col("kind"), F.col("code"), F.col("type"), F.col("message"), RULES)).collect()]
    assert got == ["HTTP 429 (rate limited)", "HTTP 418", "request timed out", "KeyError: " + "x" * 200]
    whole = [r[0] for r in log.select(failures.full_text(F.col("type"), F.col("message"))).collect()]
    assert whole == [None, None, None, "KeyError: " + "x" * 300]


def test_quota_errors_count_failed_rows_only(spark):
    frame = spark.createDataFrame(
        [("failed", "HTTP 402 (x)"), ("failed", "RATE LIMIT hit"), ("failed", "Payment Required"), ("failed", "HTTP 500"), ("failed", None), ("done", "HTTP 429")],
        "status string, error string",
    )
    assert reports.quota_errors(frame, RULES).first().n == 3


def test_an_ingest_round_keeps_failures_and_reruns_alike(spark, state):
    queued = state.selectExpr("*", "'tiktok' as platform", "queue_id as external_id")
    items = spark.createDataFrame([("b", 3, "{}"), ("a", 0, "{}"), ("d", 0, "{}")], "request_id string, pos int, item string")
    raised = spark.createDataFrame([("a", "http", 429, None, None)], "request_id string, kind string, status_code int, error_type string, message string")
    stamp = F.lit(NOON).cast("timestamp")

    def run():
        return ingest.ingest(queued, items, raised, stamp, Rules(fetch_batch=3))

    done = run()
    assert {r.queue_id: (r.status, r.error) for r in done.queue.collect()}["a"] == ("failed", "HTTP 429 (rate limited)")
    landed = {r.external_id: r.payload for r in done.raw_payloads.collect()}
    assert landed == {"b": '{"profile_item":{},"video_items":[{}]}', "c": '{"ok":false,"reason":"no_data"}'}
    assert rows(run().raw_payloads) == rows(done.raw_payloads)
    stored = spark.createDataFrame([], schemas.RAW_PAYLOADS).schema
    assert [(f.name, f.dataType) for f in done.raw_payloads.schema] == [(f.name, f.dataType) for f in stored]


def test_appending_a_round_again_replaces_it(spark, tmp_path):
    frame = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02")], "x int, d string").selectExpr("x", "cast(d as date) d")
    for round_id in ("r1", "r1", "r2"):
        append_daily(frame, str(tmp_path / "t"), "d", round_id)
    assert sorted(r.x for r in read_table(spark, str(tmp_path / "t")).collect()) == [1, 1, 2, 2]


def test_landed_files_with_broken_lines_read_alike_in_batch_and_stream(spark, tmp_path):
    folder, lines = tmp_path / "landed", ['{"authorMeta.id":1,"authorMeta.fans":9}', '{"broken', "", "[1]", "null", '{"authorMeta":{"id":"2","fans":"7"}}', '"text"']
    for name, part in (("cats", lines[:4]), ("dogs & co", lines[4:])):
        (folder / f"query={name}").mkdir(parents=True)
        for k, line in enumerate(part):
            (folder / f"query={name}" / f"{k}.json").write_text(line + "\n")
    items = landed.read_items(spark, str(folder))
    assert sorted((r["query"], r["value"]) for r in items.where("valid").collect()) == [("cats", lines[0]), ("dogs & co", lines[5])]
    aside = landed.corrupt(items, F.lit("2024-01-01").cast("timestamp"))
    assert sorted(r["line"] for r in aside.collect()) == sorted([lines[1], lines[2], lines[3], lines[4], lines[6]])
    assert all(r["file"].endswith(".json") for r in aside.collect())
    out = str(tmp_path / "streamed")
    stream = landed.stream_items(spark, str(folder), 2).select("query", "value", "valid")
    jobs.drain(stream, str(tmp_path), lambda batch, batch_id: write_batch(batch, out, batch_id))
    streamed = spark.read.parquet(out)
    assert streamed.select("batch_id").distinct().count() > 1
    assert rows(streamed.drop("batch_id")) == rows(items.select("query", "value", "valid"))
    found = discovery.discover(HASHTAG_SOURCE, landed.search_items(items, F.lit(0)), Rules(min_followers=8))
    assert [r["external_id"] for r in found.collect()] == ["1"]
