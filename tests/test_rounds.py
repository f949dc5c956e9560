from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from talentsift import schemas
from talentsift.catalog import queries
from talentsift.operators import dedup, parsing, queue
from talentsift.operators.latest import latest_n, snapshot_order
from talentsift.plans import discover, enrich, rounds
from talentsift.rules import Rules
from talentsift.session import prepare
from talentsift.sources.rounds import RoundStore, Table
from talentsift.sources.samples import Samples
from tests.conftest import plan_of, rows

FOLDER = "/root/testdata/sf0.001"
ENRICHED = ("profile_snapshots", "videos", "video_snapshots", "parse_errors", "creator_sightings", "parse_outcomes")
DAYS = [datetime(2024, 2, day) for day in range(1, 20)]


@pytest.fixture
def store(spark, tmp_path):
    return rounds.open_store(spark, str(tmp_path / "store"), buckets=4)


@pytest.fixture
def raw(spark):
    return Samples(spark, FOLDER).raw_payloads().withColumn("raw_id", F.col("raw_id").cast("string"))


EARLY, LATE = "fetched_at < timestamp '2024-01-16 00:00:00'", "fetched_at >= timestamp '2024-01-16 00:00:00'"


def contents(store, names=ENRICHED):
    return {name: rows(store.read(name).drop("snapshot_id")) for name in names}


class Lost(Exception):
    pass


@pytest.mark.parametrize("writes", [0, 2, 5])
def test_a_round_that_ends_after_any_write_shows_nothing_and_a_rerun_completes_it(store, raw, monkeypatch, writes):
    from talentsift.sources.rounds import Round

    rounds.land(store, "l1", raw, DAYS[0])
    before, write = contents(store), Round.write
    done = []

    def failing(self, name, frame):
        if len(done) == writes:
            raise Lost
        done.append(name)
        write(self, name, frame)

    monkeypatch.setattr(Round, "write", failing)
    with pytest.raises(Lost):
        rounds.enrich_round(store, "e1", DAYS[1])
    monkeypatch.undo()
    assert contents(store) == before and all(not found for found in before.values())
    assert rounds.pending_payloads(store).count() == raw.count()
    rounds.enrich_round(store, "e1", DAYS[1])
    after = contents(store)
    assert all(after.values()) and rounds.pending_payloads(store).count() == 0
    assert len(after["parse_outcomes"]) == raw.count()


def test_a_round_ended_before_its_marker_shows_nothing(store, raw, monkeypatch):
    from talentsift.sources.rounds import Round

    def lost(self):
        raise Lost

    rounds.land(store, "l1", raw, DAYS[0])
    monkeypatch.setattr(Round, "publish", lost)
    with pytest.raises(Lost):
        rounds.enrich_round(store, "e1", DAYS[1])
    monkeypatch.undo()
    assert not any(contents(store).values())


def test_two_rounds_equal_one_batch_and_reruns_change_nothing(spark, store, raw):
    rounds.land(store, "l1", raw.where(EARLY), DAYS[0])
    rounds.enrich_round(store, "e1", DAYS[1])
    rounds.land(store, "l2", raw.where(LATE), DAYS[2])
    rounds.enrich_round(store, "e2", DAYS[3])
    stamp = F.when(F.expr(EARLY), F.lit(DAYS[1])).otherwise(F.lit(DAYS[3])).cast("timestamp")
    parsed = parsing.parse_payloads(raw)
    listed = parsing.videos(parsed)
    nothing = spark.createDataFrame([], "video_id string")
    expected = {
        "profile_snapshots": enrich.profile_snapshots(parsed, stamp),
        "videos": enrich.new_videos(listed, nothing, stamp),
        "video_snapshots": enrich.video_snapshots(listed, stamp),
        "parse_errors": parsing.errors(parsed),
    }
    for name, frame in expected.items():
        assert rows(store.read(name).select(*frame.columns)) == rows(frame), name
    nobody = spark.createDataFrame([], schemas.CREATORS)
    assert rows(rounds.creators(store)) == rows(dedup.upsert_creators(nobody, enrich.sightings(parsed, stamp)))
    before, totals = contents(store), rows(store.totals("e1"))
    rounds.enrich_round(store, "e1", DAYS[1])
    rounds.enrich_round(store, "e2", DAYS[3])
    assert contents(store) == before and rows(store.totals("e1")) == totals


def test_totals_are_what_the_writes_have_seen(store, raw):
    rounds.land(store, "l1", raw, DAYS[0])
    rounds.enrich_round(store, "e1", DAYS[1])
    counted = {r["table"]: r["n"] for r in store.totals("e1").collect()}
    assert counted == {name: store.read(name).count() for name in counted} and set(ENRICHED) < set(counted)
    rounds.enrich_round(store, "e2", DAYS[2])  # nothing is pending
    assert set(r["n"] for r in store.totals("e2").collect()) == {0}


def test_status_comes_from_stored_outcomes_and_no_payload_moves(store, raw):
    rounds.land(store, "l1", raw.where(EARLY), DAYS[0])
    rounds.enrich_round(store, "e1", DAYS[1])
    rounds.land(store, "l2", raw.where(LATE), DAYS[2])
    status, waiting = rounds.payload_status(store), rounds.pending_payloads(store)
    for frame in (status, waiting):
        plan = plan_of(frame)
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
        assert "Bucketed: true" in plan
    assert "payload#" not in plan_of(status)
    payloads = next(line for line in plan_of(waiting).splitlines() if "default.raw_payloads" in line)
    assert "= l2)" in payloads.split("PartitionFilters")[1]  # the landing that has been parsed is not opened
    assert rows(waiting.select("raw_id")) == rows(raw.where(LATE).select("raw_id"))
    failed = parsing.parse_payloads(raw).where("outcome = 'failed'").select("raw_id")
    told = {r["raw_id"]: r["parse_status"] for r in status.collect()}
    late = {r["raw_id"] for r in raw.where(LATE).collect()}
    bad = {r["raw_id"] for r in failed.collect()}
    assert told == {i: "pending" if i in late else "failed" if i in bad else "parsed" for i in told} and len(told) == raw.count()


def test_a_later_session_finds_the_tables(spark, store, raw, tmp_path):
    rounds.land(store, "l1", raw, DAYS[0])
    for name in ("raw_payloads", "parse_outcomes"):
        spark.sql(f"DROP TABLE {store.name_of(name)}")
    again = rounds.open_store(spark, str(tmp_path / "store"), buckets=4)
    assert rows(again.read("raw_payloads").select("raw_id")) == rows(raw.select("raw_id"))


def test_opened_payloads_give_what_the_separate_reads_give(spark):
    raw = Samples(spark, FOLDER).raw_payloads()
    odd = spark.createDataFrame(
        [
            ("x1", "tiktok", "profile", "1", '{"profile_item":{"authorMeta":{"id":"9"}},"video_items":[{"id":"a"},7,null,{"id":""},{"id":"b","isAd":true}]}'),
            ("x2", "tiktok", "profile", "2", '{"profile_item":{"authorMeta":{"id":"9"}}}'),
            ("x3", "tiktok", "profile_page", "3", '{"video_items":[{"id":"c"}]}'),
            ("x4", "tiktok", "nobody", "4", "{}"),
            ("x5", "tiktok", "profile", "5", None),
        ],
        "raw_id string, platform string, source_type string, external_id string, payload string",
    ).withColumns({"fetched_at": F.lit(DAYS[0]), "parse_status": F.lit("pending")})
    for frame in (raw.withColumn("raw_id", F.col("raw_id").cast("string")).unionByName(odd), raw.limit(0)):
        parsed = parsing.parse_payloads(frame)
        opened = parsing.opened(parsed)
        fetches, videos = parsing.fetches(parsed), parsing.videos(parsed)
        assert rows(parsing.opened_fetches(opened).select(*fetches.columns)) == rows(fetches)
        assert rows(parsing.opened_videos(opened).select(*videos.columns)) == rows(videos)
        assert rows(parsing.errors(opened)) == rows(parsing.errors(parsed))


SNAPSHOTS = {"newest": Table("snapshot_id bigint, creator_id bigint, snapshot_date date, created_at timestamp, follower_count bigint", bucketed_by="creator_id", buckets=4)}


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2), (2, 3, 1, 0)])
def test_kept_newest_rows_equal_the_full_ranking_in_any_order_of_rounds(spark, tmp_path, order):
    store = RoundStore(spark, str(tmp_path / "kept"), SNAPSHOTS)
    frame = Samples(spark, FOLDER).profile_snapshots().select("snapshot_id", "creator_id", "snapshot_date", "created_at", "follower_count")
    part = F.ntile(4).over(Window.orderBy("snapshot_date", "snapshot_id"))
    parts = frame.withColumn("part", part - 1).persist()
    for turn, which in enumerate(order):
        with store.round(f"r{turn}", DAYS[turn]) as this:
            rounds.keep_newest(this, "newest", parts.where(F.col("part") == which), "creator_id", snapshot_order(), 2)
    expected = latest_n(frame, ["creator_id"], snapshot_order(), 2)
    assert rows(rounds.kept_newest(store, "newest")) == rows(expected)
    with store.round("r3", DAYS[3]) as this:  # a rerun of the last round
        rounds.keep_newest(this, "newest", parts.where(F.col("part") == order[3]), "creator_id", snapshot_order(), 2)
    assert rows(rounds.kept_newest(store, "newest")) == rows(expected)
    parts.unpersist()


def test_keeping_newest_moves_only_the_arriving_rows(spark, tmp_path):
    store = RoundStore(spark, str(tmp_path / "kept"), SNAPSHOTS)
    frame = Samples(spark, FOLDER).profile_snapshots().select("snapshot_id", "creator_id", "snapshot_date", "created_at", "follower_count")
    with store.round("r0", DAYS[0]) as this:
        rounds.keep_newest(this, "newest", frame, "creator_id", snapshot_order(), 2)
    kept = rounds.kept_newest(store, "newest", DAYS[1])
    plan = plan_of(rounds.merged_newest(kept, frame, "creator_id", snapshot_order(), 2, 4))
    above, below = plan.split("Union")
    assert "Exchange" not in above and "WindowGroupLimit" in above
    kept_side = [line for line in below.splitlines() if "spark_catalog.default.newest" in line]
    assert len(kept_side) == 1 and "Bucketed: true" in kept_side[0] and "round#" in kept_side[0].split("PartitionFilters")[1]
    assert below[below.index("spark_catalog.default.newest") :].count("Exchange") == 0


def test_queue_rows_can_be_taken_and_keep_their_creators_out(spark, store):
    rules = Rules(fetch_batch=2)
    found = spark.createDataFrame(
        [("tiktok", "1", "one", "src", "q", 0), ("tiktok", "1", "uno", "src", "p", 0), ("tiktok", "2", "two", "src", "q", 1), ("tiktok", "3", "three", "src", "q", 2)],
        "platform string, external_id string, handle string, source string, query string, pos bigint",
    )
    due = spark.createDataFrame([("tiktok", "3", "three"), ("tiktok", "4", "four")], "platform string, external_id string, handle string")
    empty = spark.createDataFrame([], schemas.INGESTION_QUEUE)
    rounds.discovery_round(store, "d1", found, due, empty, DAYS[0], rules)
    stored = store.read("ingestion_queue").drop("round")
    assert stored.columns == spark.createDataFrame([], schemas.INGESTION_QUEUE).columns
    batch = [(r["external_id"], r["priority"], r["attempts"], r["enqueued_at"]) for r in queue.next_batch(stored, 2).collect()]
    assert batch[0] == ("4", 1, 0, DAYS[0]) and len(batch) == 2
    assert stored.select("queue_id").distinct().count() == stored.count() == 4
    assert {r["handle"] for r in stored.where("external_id = '1'").collect()} == {"uno"}
    rounds.discovery_round(store, "d2", found, due, store.read("ingestion_queue", DAYS[1]), DAYS[1], rules)
    assert store.read("ingestion_queue").where("round = 'd2'").count() == 0
    assert store.read("discovery_events").where("round = 'd2'").count() == 4
    taken = queue.mark_in_progress(stored, 2)
    outcomes = queue.next_batch(stored, 2).select("queue_id", F.lit("done").alias("status"), F.lit(None).cast("string").alias("error"))
    assert queue.complete(taken, outcomes).groupBy("status").count().where("status = 'done'").first()["count"] == 2
    rows_ = discover.queue_rows(discover.enqueue_round(found, due, empty, rules), F.lit(DAYS[0]))
    assert rows(rows_.select("queue_id")) == rows(stored.select("queue_id"))


def test_round_names_must_be_plain(store):
    with pytest.raises(ValueError), store.round("a/b", DAYS[0]):
        pass


def test_rounds_seen_as_of_a_moment(spark, tmp_path):
    store = RoundStore(spark, str(tmp_path / "s"), {"numbers": Table("n bigint"), "dated": Table("n bigint, day date", day="day")})
    for turn in range(3):
        with store.round(f"r{turn}", DAYS[turn]) as this:
            this.write("numbers", spark.range(turn, turn + 1).select(F.col("id").alias("n")))
            this.write("dated", spark.range(2).select(F.col("id").alias("n"), F.lit(DAYS[turn].date()).alias("day")))
    assert [r["n"] for r in store.read("numbers", DAYS[2]).orderBy("n").collect()] == [0, 1]
    assert rows(store.read("numbers").drop("round")) == [(0,), (1,), (2,)]
    plan = plan_of(store.read("dated").where(F.col("day") == F.lit(DAYS[1].date())))
    assert "dynamicpruning" in plan.lower() and "PartitionFilters: [isnotnull(day" in plan
    assert store.read("numbers", DAYS[0]).count() == 0


def test_rows_of_a_day_are_written_where_they_are(spark, tmp_path):
    """No shuffle to one place per day, and no row is lost where tasks hold more days than open files."""
    store = rounds.open_store(spark, str(tmp_path / "days"), buckets=4)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")

    def snapshots(days):
        told = {"raw_id": F.col("id"), "snapshot_date": F.date_add(F.lit("2024-01-01"), (F.col("id") % days).cast("int"))}
        fields = store.tables["profile_snapshots"].columns
        return spark.range(0, 400, 1, 4).select(*[told.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    with store.round("one", datetime(2024, 1, 1)) as this:
        this.write("profile_snapshots", snapshots(1))
    assert len(store.everything("profile_snapshots").where("round = 'one'").select(F.input_file_name()).distinct().collect()) == 4
    with store.round("many", datetime(2024, 1, 2)) as this:
        this.write("profile_snapshots", snapshots(25))
    assert store.read("profile_snapshots", rounds=["many"]).groupBy("snapshot_date").count().collect() and this.rows["profile_snapshots"] == 400
    assert store.read("profile_snapshots", rounds=["many"]).agg(F.count_distinct("raw_id", "snapshot_date")).first()[0] == 400
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_buckets_of_the_sample_store_grow_with_the_payloads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "BUCKET_ROWS", 10)
    events = spark.range(117).selectExpr(
        "id as event_id", "timestamp'2024-01-10 00:00:00' + make_interval(0, 0, 0, cast(id % 15 as int)) as ts", "id % 9 as user_id",
        "element_at(array('view', 'click'), cast(id % 2 + 1 as int)) as event_type", "cast(id as double) as value", "concat('{\"k\": ', id % 50, '}') as props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    store = queries._two_landings(queries.Samples(spark, str(tmp_path)), "growing")
    assert store.tables["raw_payloads"].buckets == store.tables["parse_outcomes"].buckets == 12
    assert store.read("raw_payloads").count() == 117


def test_a_session_built_elsewhere_splits_large_methods(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    prepare(other)
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
