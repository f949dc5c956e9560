from __future__ import annotations

import __spark_entry__ as entry_point
import duckdb
import pytest

from talentsift.catalog.oracles import ORACLES
from talentsift.catalog.queries import QUERIES
from tests.conftest import plan_of
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, FOLDER), db, ORACLES[name]) == []


def test_comparison_notices_a_changed_value_a_lost_row_and_a_type(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "x int, y string")
    db = duckdb.connect()
    good = "SELECT * FROM (VALUES (2, 'b'), (1, 'a'), (2, 'b')) t(x, y)"
    assert differences(frame, db, good) == []
    for bad in (
        good.replace("'a'", "'c'"),
        good.replace("(2, 'b'), (1", "(1"),
        good.replace("*", "x + 0.5 AS x, y"),
        good.replace("(x, y)", "(x, z)"),
    ):
        assert differences(frame, db, bad)


def test_entry_runs(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["tier", "flags", "creators"]
    assert frame.count() > 0


def _final_plan(spark, name):
    return plan_of(QUERIES[name](spark, FOLDER))


BATCH = [name for name in sorted(QUERIES) if not name.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_worker_and_no_unbounded_join(spark, name):
    plan = _final_plan(spark, name)
    for banned in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert banned not in plan


@pytest.mark.parametrize(
    "name",
    ["latest_n_per_key", "first_occurrence", "discover_candidates", "recent_video_engagement", "growth_rate", "score_creators", "refresh_due"],
)
def test_groups_shrink_before_the_shuffle(spark, name):
    plan = _final_plan(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_k_never_sorts_the_queue(spark):
    plan = _final_plan(spark, "dequeue_topk")
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["parse_outcomes", "parse_profiles", "parse_errors", "discover_candidates"])
def test_filters_do_not_parse_json_again(spark, name):
    for line in _final_plan(spark, name).splitlines():
        if " Filter " in line:
            assert "from_json" not in line and "parseJson" not in line


@pytest.mark.parametrize("name", ["enrich_snapshots", "profile_snapshots", "upsert_videos"])
def test_payloads_are_scanned_and_parsed_once(spark, name):
    plan = _final_plan(spark, name)
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_scans_read_only_what_they_use(spark):
    plan = _final_plan(spark, "latest_score_with_ties")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("o_totalprice" not in line for line in scans)
