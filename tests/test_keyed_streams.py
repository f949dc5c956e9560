from __future__ import annotations

import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from talentsift.operators.latest import snapshot_order
from talentsift.plans.score import current_and_previous, snapshot_signals
from talentsift.rules import Rules
from talentsift.streaming import keyed
from tests.conftest import rows

SNAPSHOT = "snapshot_id bigint, creator_id bigint, snapshot_date date, created_at timestamp, follower_count bigint"


@pytest.fixture
def session(spark):
    return keyed.keyed_session(spark)


def _snapshots(spark, numbers):
    return spark.createDataFrame(
        [
            (
                n,
                None if n % 11 == 0 else n % 7,
                None if n % 13 == 0 else date(2024, 1, 1 + n % 9),
                datetime(2024, 2, 1, n % 5, tzinfo=timezone.utc),
                None if n % 17 == 0 else 1000 + n * n % 500,
            )
            for n in numbers
        ],
        SNAPSHOT,
    )


def _batch_answer(table):
    others = ("'success' AS scrape_status", "'' AS bio", "'' AS bio_link", "0L AS lifetime_likes", "0L AS video_count")
    pair = current_and_previous(table.selectExpr("*", *others, "false AS is_commerce_account"), snapshot_order())
    rates = {row.creator_id: row.growth for row in snapshot_signals(pair, Rules()).collect()}
    return {row.creator_id: (row.snapshot_date, rates[row.creator_id]) for row in pair.collect()}


def test_growth_of_changed_creators_equals_batch_over_shuffled_files_and_a_restart(spark, session, tmp_path):
    source, folder = str(tmp_path / "snapshots"), str(tmp_path / "out")
    numbers = list(range(1, 141))
    order = sorted(numbers, key=lambda n: n * 37 % 141)

    def run():
        stream = session.readStream.schema(SNAPSHOT).option("maxFilesPerTrigger", 1).parquet(source)
        keyed.changed_growth(stream, folder, Rules())

    for part in (order[:60], order[60:100]):
        _snapshots(spark, part).coalesce(1).write.mode("append").parquet(source)
    run()
    _snapshots(spark, order[100:]).coalesce(1).write.mode("append").parquet(source)
    run()

    expected = _batch_answer(spark.read.schema(SNAPSHOT).parquet(source))
    got = keyed.current_growth(spark, folder).collect()
    assert {row.creator_id: (row.snapshot_date, row.growth_rate) for row in got} == expected
    assert len(got) == len(expected) == 8
    assert any(rate is not None for _, rate in expected.values())


def test_only_changed_creators_are_written(spark, session, tmp_path):
    source, folder = str(tmp_path / "snapshots"), str(tmp_path / "out")
    at = datetime(2024, 2, 1, tzinfo=timezone.utc)

    def land(*facts):
        data = [(n, creator, date(2024, 1, day), at, followers) for n, creator, day, followers in facts]
        spark.createDataFrame(data, SNAPSHOT).coalesce(1).write.mode("append").parquet(source)
        keyed.changed_growth(session.readStream.schema(SNAPSHOT).parquet(source), folder, Rules())

    land((1, 1, 10, 100), (2, 1, 20, 200), (3, 2, 10, 100))
    land((4, 1, 5, 50), (5, 2, 5, 90))  # too old for creator 1, the second newest of creator 2
    changes = spark.read.parquet(f"{folder}/growth_changes")
    last = changes.agg(F.max("batch_id")).first()[0]
    assert [row.creator_id for row in changes.where(F.col("batch_id") == last).collect()] == [2]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != keyed._ROCKSDB


def test_reduction_before_the_shuffle_keeps_two_rows_of_a_hot_creator(spark):
    narrow = spark.range(1000).selectExpr(
        "1L AS creator_id", "id AS snapshot_id", "cast(id % 50 AS int) AS day", "id AS created", "id AS follower_count"
    ).coalesce(1)
    kept = narrow.mapInArrow(keyed._two_newest_per_batch(), narrow.schema)
    assert rows(kept.select("snapshot_id")) == [(949,), (999,)]
    assert kept.where("false").count() == 0


def test_silence_is_noticed_before_later_rows_come(spark, session, tmp_path):
    source, folder = str(tmp_path / "arrivals"), str(tmp_path / "out")
    spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "name string").write.parquet(source)
    step = 2
    query = keyed.watch_silence(session.readStream.schema("name string").parquet(source), folder, step, "1 second")
    try:
        deadline = time.time() + 90
        found = []
        while time.time() < deadline:
            found = keyed.silent_windows(spark, folder).selectExpr("name", "unix_seconds(window_start) AS at", "n").collect()
            if {row.name for row in found} == {"a", "b", None} and len(found) >= 6:
                break
            assert query.isActive, query.exception()
            time.sleep(1)
    finally:
        query.stop()
    assert {row.name for row in found} == {"a", "b", None}
    for name in ("a", "b", None):
        starts = sorted(row.at for row in found if row.name == name)
        assert starts == list(range(starts[0], starts[0] + step * len(starts), step))
        assert starts[0] % step == 0
    assert {row.n for row in found} == {0}
