from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from talentsift import schemas
from talentsift.operators import dedup, parsing
from talentsift.operators.discovery import discover, queue_candidates
from talentsift.operators.latest import snapshot_order
from talentsift.plans import enrich
from talentsift.plans.score import current_and_previous, snapshot_signals
from talentsift.rules import HASHTAG_SOURCE, Rules
from talentsift.sources.samples import SAMPLE_RULES, SEARCH_RULES, Samples
from talentsift.sources import folded
from talentsift.streaming import jobs
from tests.conftest import plan_of, rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def sliced(spark, tmp_path):
    """A sample table as four files in event order, streamed one file per batch."""

    def open_sliced(table: str, order: str):
        frame = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        path = str(tmp_path / table)
        for part in range(4):
            lo, hi = (frame.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first())
            width = (hi - lo + 1) / 4
            inside = frame.where((F.col(order) >= lo + part * width) & (F.col(order) < lo + (part + 1) * width))
            inside.coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)

    return open_sliced


def test_parse_stream_equals_batch(spark, sliced, tmp_path):
    samples, folder = Samples(spark, FOLDER), str(tmp_path / "out")
    stamp = F.col("fetched_at")
    jobs.parse_landed(samples.raw_payloads(sliced("events", "event_id")), folder, stamp)
    parsed = parsing.parse_payloads(samples.raw_payloads())
    listed = parsing.videos(parsed)

    def stored(name):
        return spark.read.parquet(f"{folder}/{name}")

    assert stored("profile_snapshots").select("batch_id").distinct().count() > 1
    expected = enrich.profile_snapshots(parsed, stamp)
    assert rows(stored("profile_snapshots").drop("batch_id")) == rows(expected)
    assert rows(stored("video_snapshots").drop("batch_id")) == rows(enrich.video_snapshots(listed, stamp))
    assert rows(stored("parse_errors").drop("batch_id")) == rows(parsing.errors(parsed))
    none_known = spark.createDataFrame([], "video_id string")
    videos = stored("videos").drop("batch_id")
    assert rows(videos.select("video_id")) == rows(enrich.new_videos(listed, none_known, stamp).select("video_id"))
    creators = jobs.stored_creators(spark, folder)
    nobody = spark.createDataFrame([], creators.schema)
    assert rows(creators) == rows(dedup.upsert_creators(nobody, enrich.sightings(parsed, stamp)))


def test_rerun_batch_writes_the_same_tables(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    raw = Samples(spark, FOLDER).raw_payloads()
    early = F.col("fetched_at") < F.lit(datetime(2024, 1, 15))

    def tables():
        return {name: rows(spark.read.parquet(f"{folder}/{name}")) for name in ("videos", "profile_snapshots", "creator_sightings")}

    def replay(stream, target, write, mode="append"):
        write(raw.where(early), 0)
        write(raw.where(~early), 1)
        first = tables()
        write(raw.where(~early), 1)
        assert tables() == first

    monkeypatch.setattr(jobs, "drain", replay)
    jobs.parse_landed(raw, folder, F.col("fetched_at"))


def test_stream_without_input_gives_empty_tables(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    schema = spark.read.parquet(f"{FOLDER}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "empty"))
    queued = jobs.enqueue_sightings(Samples(spark, FOLDER).search_items(stream), str(tmp_path / "q"), SEARCH_RULES)
    assert queued.count() == 0


@pytest.fixture
def newest_first(spark, tmp_path):
    """A sample table as five files, the newest rows in the first batch."""

    def open_reversed(table: str, order: str):
        frame = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        path = tmp_path / f"{table}-reversed"
        lo, hi = frame.agg(F.min(order), F.max(order)).first()
        width = (hi - lo) / 5
        for part in reversed(range(5)):
            upper = F.col(order) <= hi if part == 4 else F.col(order) < lo + (part + 1) * width
            inside = frame.where((F.col(order) >= lo + part * width) & upper)
            inside.coalesce(1).write.mode("append").parquet(str(path))
        for age, file in enumerate(sorted(path.glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)):
            os.utime(file, (1_700_000_000 + age, 1_700_000_000 + age))
        return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(path))

    return open_reversed


def test_queue_stream_newest_first_equals_batch(spark, newest_first, tmp_path):
    samples = Samples(spark, FOLDER)
    queued = jobs.enqueue_sightings(samples.search_items(newest_first("events", "event_id")), str(tmp_path / "q"), SEARCH_RULES)
    found = discover(HASHTAG_SOURCE, samples.search_items(), SEARCH_RULES)
    nobody = spark.createDataFrame([], "platform string, external_id string, status string")
    expected = dedup.enqueue(queue_candidates(found, SEARCH_RULES), nobody, [F.asc("query"), F.asc("pos")]).select(*queued.columns)
    assert queued.count() > 0 and rows(queued) == rows(expected)


def test_queue_stream_leaves_out_creators_that_are_pending(spark, newest_first, tmp_path):
    samples = Samples(spark, FOLDER)
    found = discover(HASHTAG_SOURCE, samples.search_items(), SEARCH_RULES)
    some = found.select("platform", "external_id").distinct().orderBy("external_id").limit(5)
    standing = some.withColumn("status", F.lit("pending")).unionByName(found.select("platform", "external_id").withColumn("status", F.lit("done")))
    stream = samples.search_items(newest_first("events", "event_id"))
    queued = jobs.enqueue_sightings(stream, str(tmp_path / "q"), SEARCH_RULES, standing, F.lit(datetime(2024, 2, 1)).cast("timestamp"))
    assert queued.columns == spark.createDataFrame([], schemas.INGESTION_QUEUE).columns
    expected = found.select("external_id").distinct().join(some, "external_id", "left_anti")
    assert rows(queued.select("external_id")) == rows(expected)


def test_arrival_stream_newest_first_equals_batch_windows(spark, newest_first, tmp_path):
    stream = newest_first("events", "ts").select(F.col("ts").cast("timestamp").alias("at"))
    counted = jobs.arrival_counts(stream, str(tmp_path / "a"), "at", "2 hours", "15 minutes")
    batch = spark.read.parquet(f"{FOLDER}/events.parquet").select(F.col("ts").cast("timestamp").alias("at"))
    windows = batch.groupBy(F.window("at", "2 hours", "15 minutes").alias("w")).count()
    expected = windows.select(F.col("w.start").alias("window_start"), F.col("count").alias("n"))
    assert rows(counted.where("n > 0").select("window_start", "n")) == rows(expected)
    assert counted.agg(F.sum("n")).first()[0] == 8 * batch.count()


def test_growth_stream_equals_batch(spark, sliced, tmp_path):
    def shaped(frame):
        return frame.select(
            F.col("o_orderkey").alias("snapshot_id"),
            F.col("o_custkey").alias("creator_id"),
            F.to_date("o_orderdate").alias("snapshot_date"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.floor(F.col("o_totalprice") / 10).alias("follower_count"),
        )

    updates = jobs.growth_updates(shaped(sliced("orders", "o_orderkey")), str(tmp_path / "g"), Rules())
    samples = Samples(spark, FOLDER)
    pair = current_and_previous(samples.profile_snapshots(), snapshot_order())
    expected = snapshot_signals(pair, SAMPLE_RULES).select("creator_id", "growth")
    assert rows(updates.select("creator_id", "growth_rate")) == rows(expected)


@pytest.mark.parametrize(("fan", "prefixes"), [(2, 3), (4, 4)])
def test_ids_of_many_small_batches_lie_in_few_files(spark, tmp_path, fan, prefixes):
    store = folded.FoldedIds(spark, str(tmp_path / "ids"), "video_id", fan, prefixes)
    levels = 1
    for batch_id in range(50):
        while fan**levels <= batch_id:
            levels += 1
        ids = spark.range(batch_id * 3, batch_id * 3 + 3).select(F.col("id").cast("string").alias("video_id")).coalesce(1)
        store.begin(batch_id)
        if batch_id in (5, 16, 33):  # this batch ran before and was lost
            store.add(batch_id, ids.limit(1))
            store.begin(batch_id)
        known = store._read(folded.pieces_before(batch_id, fan))
        assert len(known.inputFiles()) <= (fan - 1) * levels * prefixes
        if batch_id % 10 == 0:
            assert rows(known.select("video_id")) == sorted((str(i),) for i in range(batch_id * 3))
        store.add(batch_id, ids)
    store.begin(50)
    wanted = spark.createDataFrame([("7",), ("149",), ("150",)], "video_id string")
    known = store.known(50, wanted)
    found = {r["video_id"] for r in known.collect()}
    assert {"7", "149"} <= found and "150" not in found and len(found) < 150
    assert "PartitionFilters: [" in plan_of(known) and "prefix#" in plan_of(known).split("PartitionFilters: [")[1]
    on_disk = {tuple(int(x.split("=")[1]) for x in p.relative_to(tmp_path / "ids").parts) for p in (tmp_path / "ids").glob("first=*/batches=*")}
    parts = {p for piece in folded.pieces_made(50, fan) for p in folded.parts_of(piece, fan)}
    assert on_disk == set(folded.pieces_before(50, fan)) | parts


def test_pieces_hold_every_batch_once():
    for fan in (2, 3, 8):
        for batch_id in range(200):
            covered = [b for first, size in folded.pieces_before(batch_id, fan) for b in range(first, first + size)]
            assert covered == list(range(batch_id))


def test_payloads_are_read_in_one_job_a_batch(spark, sliced, tmp_path, monkeypatch):
    writes = []
    real = jobs.write_batch

    def noted(frame, path, batch_id, by=None):
        writes.append((path.rsplit("/", 1)[1], "payload#" in frame._jdf.queryExecution().optimizedPlan().toString()))
        real(frame, path, batch_id, by)

    monkeypatch.setattr(jobs, "write_batch", noted)
    jobs.parse_landed(Samples(spark, FOLDER).raw_payloads(sliced("events", "event_id")), str(tmp_path / "out"), F.col("fetched_at"))
    assert {name for name, reads in writes if reads} == {"opened_payloads"}
    assert len(writes) == 6 * len([w for w in writes if w[1]])
    branches = {p.name for p in (tmp_path / "out" / "opened_payloads").glob("batch_id=0/outcome=*")}
    assert branches == {"outcome=parsed", "outcome=failed", "outcome=failed_fetch"}
