"""The jobs as rounds: every table of a run becomes visible at once, and a rerun replaces its run."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift import schemas
from talentsift.operators import dedup, parsing
from talentsift.operators.latest import latest_n
from talentsift.operators.parsing import SHAPES, Shape
from talentsift.plans import discover, enrich, handoff, score
from talentsift.rules import PENDING, Rules
from talentsift.sources.rounds import Round, RoundStore, Table

SIGHTINGS = "platform string, external_id string, first_sighting timestamp, last_sighting timestamp"
CANDIDATES = "platform string, external_id string, handle string, source string, query string, pos bigint"
OUTCOMES = "raw_id string, outcome string, error string, reason string"
_FIGURES = """handle: string, follower_count: bigint, following_count: bigint, lifetime_likes: bigint, video_count: bigint,
    bio: string, bio_link: string, is_verified: boolean, is_private: boolean, is_commerce_account: boolean"""
_VIDEO = """pos: int, named: boolean, video_id: string, creator_external_id: string, posted_at: timestamp, is_ad: boolean,
    text_language: string, web_video_url: string, play_count: bigint, digg_count: bigint, comment_count: bigint,
    share_count: bigint, collect_count: bigint"""
OPENED = f"""raw_id string, platform string, external_id string, fetched_at timestamp, outcome string, error string,
    reason string, profile struct<{_FIGURES}>, videos array<struct<{_VIDEO}>>"""

# Payloads and their outcomes are clustered alike, so the status of a payload is found where the payload lies.
TABLES = {
    "raw_payloads": Table(schemas.RAW_PAYLOADS, bucketed_by="raw_id"),
    "parse_outcomes": Table(OUTCOMES, bucketed_by="raw_id"),
    "opened_payloads": Table(OPENED),
    "profile_snapshots": Table(f"{schemas.PROFILE_SNAPSHOTS.strip()}, raw_id string", day="snapshot_date"),
    "videos": Table(schemas.VIDEOS),
    "video_snapshots": Table(f"{schemas.VIDEO_SNAPSHOTS.strip()}, raw_id string", day="snapshot_date"),
    "parse_errors": Table(schemas.PARSE_ERRORS),
    "creator_sightings": Table(SIGHTINGS),
    "candidates": Table(CANDIDATES),
    "refreshes_due": Table("platform string, external_id string, handle string"),
    "discovery_events": Table(schemas.DISCOVERY_EVENTS),
    "ingestion_queue": Table(schemas.INGESTION_QUEUE),
    "creator_scores": Table(schemas.CREATOR_SCORES),
    "outreach_queue": Table(schemas.OUTREACH_QUEUE),
}


def open_store(spark: SparkSession, folder: str, tables: dict[str, Table] | None = None, buckets: int | None = None) -> RoundStore:
    """The store of a folder. ``buckets`` is how many parts a clustered table has, for as long as it lives."""
    tables = tables or TABLES
    if buckets:
        tables = {name: replace(table, buckets=buckets) for name, table in tables.items()}
    return RoundStore(spark, folder, tables)


def land(store: RoundStore, round_id: str, payloads: DataFrame, as_of: datetime) -> None:
    """Append payloads; each stays pending until a published round has an outcome for it."""
    with store.round(round_id, as_of) as this:
        this.write("raw_payloads", payloads.withColumn("parse_status", F.lit(PENDING)))


def _outcomes(store: RoundStore, before: datetime | None) -> DataFrame:
    return store.read("parse_outcomes", before).select("raw_id", "outcome", "error", "reason")


def payload_status(store: RoundStore, before: datetime | None = None) -> DataFrame:
    """Every landed payload with the status that the stored outcomes give it; no text is read."""
    landed = store.read("raw_payloads", before).select("raw_id", "platform", "external_id", "fetched_at")
    told = _outcomes(store, before).select("raw_id", "outcome", "error")
    status = F.when(F.col("outcome").isNull(), PENDING).otherwise(parsing.parse_status(F.col("outcome")))
    return landed.join(told.hint("shuffle_hash"), "raw_id", "left").withColumn("parse_status", status).drop("outcome")


def pending_payloads(store: RoundStore, before: datetime | None = None) -> DataFrame:
    """Landed payloads without an outcome.

    Ids are compared first, bucket by bucket. Then only the landing rounds that
    hold a pending payload are opened for their texts, and again the ids that
    have an outcome leave where they lie: no payload is shuffled. The rounds
    that come to the driver are named once each.
    """
    known = _outcomes(store, before).select("raw_id").hint("shuffle_hash")
    waiting = store.read("raw_payloads", before).select("raw_id", "round").join(known, "raw_id", "left_anti")
    rounds = sorted(row["round"] for row in waiting.select("round").distinct().collect())
    return store.read("raw_payloads", before, rounds=rounds).drop("round").join(known, "raw_id", "left_anti")


def enrich_round(store: RoundStore, round_id: str, as_of: datetime, shapes: dict[str, Shape] = SHAPES) -> None:
    """Parse every pending payload and publish all that follows from it as one round.

    Payloads are read once, into rows without their text, from which the
    outputs are projected.
    """
    with store.round(round_id, as_of) as this:
        parsed = parsing.parse_payloads(pending_payloads(store, as_of), shapes)
        this.write("opened_payloads", parsing.opened(parsed, shapes))
        opened = this.staged("opened_payloads")
        known = store.read("videos", as_of).select("video_id")
        rows = enrich.enrich_opened(opened, known, this.stamp)
        this.write("profile_snapshots", rows.profile_snapshots)
        this.write("videos", rows.videos)
        this.write("video_snapshots", rows.video_snapshots)
        this.write("parse_errors", rows.parse_errors)
        this.write("creator_sightings", dedup.sighting_range(rows.sightings))
        this.write("parse_outcomes", opened)


def creators(store: RoundStore, before: datetime | None = None) -> DataFrame:
    """The creators table after all published rounds."""
    ranges = dedup.merged_ranges(store.read("creator_sightings", before))
    return dedup.upsert_ranges(store.spark.createDataFrame([], schemas.CREATORS), ranges)


def discovery_round(
    store: RoundStore, round_id: str, candidates: DataFrame, due: DataFrame, queue: DataFrame, as_of: datetime, rules: Rules
) -> None:
    """Candidates and refreshes of one run, the events they leave and their queue rows, published together.

    ``queue`` is the queue as it stands: its pending rows keep their creators
    out. Candidates and refreshes are computed once, and the events and queue
    rows follow from what has been staged.
    """
    with store.round(round_id, as_of) as this:
        this.write("candidates", candidates)
        this.write("refreshes_due", due)
        found, refreshes = this.staged("candidates"), this.staged("refreshes_due")
        this.write("discovery_events", discover.discovery_events(found, this.stamp))
        this.write("ingestion_queue", discover.queue_rows(discover.enqueue_round(found, refreshes, queue, rules), this.stamp))


def score_round(
    store: RoundStore,
    round_id: str,
    creators_now: DataFrame,
    snapshots: DataFrame,
    videos: DataFrame,
    video_snapshots: DataFrame,
    as_of: datetime,
    rules: Rules,
    order: list | None = None,
) -> None:
    """Scores of every active creator, appended beside those of earlier rounds."""
    with store.round(round_id, as_of) as this:
        this.write("creator_scores", score.score_creators(creators_now, snapshots, videos, video_snapshots, this.stamp, rules, order))


def handoff_round(store: RoundStore, round_id: str, scores: DataFrame, outreach: DataFrame, as_of: datetime, rules: Rules) -> None:
    """Outreach rows of the creators that qualify now."""
    with store.round(round_id, as_of) as this:
        this.write("outreach_queue", handoff.outreach_push(scores, outreach, this.stamp, rules))


def keep_newest(this: Round, name: str, arriving: DataFrame, key: str, order: list, n: int) -> None:
    """Add a round's rows to a kept table of the ``n`` newest rows of each key.

    The table holds the state after each published round; its buckets by key
    stay in place, so only the arriving rows move, at most ``n`` of each key.
    Rounds may bring rows in any order of time: the newest of all are among
    the newest of what was kept and the newest of what arrives.
    """
    kept, buckets = kept_newest(this.store, name, this.as_of), this.store.tables[name].buckets
    this.write(name, merged_newest(kept, arriving, key, order, n, buckets), in_place=True)


def merged_newest(kept: DataFrame, arriving: DataFrame, key: str, order: list, n: int, buckets: int) -> DataFrame:
    """The ``n`` newest rows of each key among kept and arriving ones, in the buckets of the kept table.

    The arriving rows come first in the union: so it is seen to be in buckets,
    and the ranking above it moves nothing.
    """
    newest = latest_n(arriving, [key], order, n).select(*kept.columns).repartition(buckets, key)
    return latest_n(newest.unionByName(kept), [key], order, n)


def kept_newest(store: RoundStore, name: str, before: datetime | None = None) -> DataFrame:
    """The kept rows after the last published round that wrote them."""
    markers = store.published(before).where(F.map_contains_key("rows", name))
    last = markers.agg(F.max_by(F.struct("round", "attempt"), "as_of").alias("last")).first()["last"]
    rows = store.everything(name)
    chosen = F.lit(False) if last is None else (F.col("round") == last["round"]) & (F.col("attempt") == last["attempt"])
    return rows.where(chosen).drop("round", "attempt")
