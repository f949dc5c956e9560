"""Every operator as a named query over the sample tables.

A query takes the session and a sample folder and returns a DataFrame. Dates,
times and flag lists leave as text so that any engine's client compares them
alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentsift.functions import failures
from talentsift.functions import signals as S
from talentsift.functions import variant as V
from talentsift.operators import dedup, discovery, envelope, monitor, parsing, queue, reports, videos
from talentsift.operators.latest import (
    latest,
    latest_n,
    latest_with_ties,
    score_order,
    snapshot_order,
)
from talentsift.plans import calendar, discover, enrich, handoff, ingest, rounds, score
from talentsift.rules import HASHTAG_SOURCE, PENDING, Rules
from talentsift.session import prepare, shared_folder
from talentsift.sources import landed
from talentsift.sources.rounds import RoundStore, Table
from talentsift.sources.samples import (
    BIO_RULES,
    EVENTS_AS_OF,
    ORDERS_AS_OF,
    SAMPLE_RULES,
    SEARCH_RULES,
    Samples,
)
from talentsift.sources.tables import append_daily, read_table
from talentsift.streaming import jobs, keyed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = Rules()


def _at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


def portable(rows: DataFrame) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column, ",").alias(field.name)
        return column

    return rows.select(*[plain(field) for field in rows.schema.fields])


def query(build: Callable[[Samples], DataFrame]) -> Callable[[Samples], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return portable(build(Samples(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# Discovery and the fetch queue


@query
def discover_candidates(t: Samples) -> DataFrame:
    return discovery.discover(HASHTAG_SOURCE, t.search_items(), SEARCH_RULES).drop("pos")


def land_items(t: Samples, purpose: str) -> str:
    """The search items as JSON lines in a folder for each query, with a broken line beside every fiftieth."""
    folder = shared_folder(t.spark, purpose)
    numbered = F.concat(F.lit('{"pos":'), F.col("pos"), F.lit(","), F.expr("substring(item, 2)"))
    broken = F.when(F.col("pos") % 50 == 0, F.concat(F.lit('{"broken '), F.col("pos")))
    lines = t.search_items().select("query", F.explode(F.array_compact(F.array(numbered, broken))).alias("value"))
    lines.write.partitionBy("query").text(folder)
    return folder


@query
def landed_items(t: Samples) -> DataFrame:
    """Candidates of items that were landed as JSON files, and the lines that were set aside."""
    items = landed.read_items(t.spark, land_items(t, "landed-items"))
    found = discovery.discover(HASHTAG_SOURCE, landed.search_items(items, V.integer(V.node(F.col("document"), "pos"))), SEARCH_RULES)
    aside = landed.corrupt(items, _at(EVENTS_AS_OF))
    return found.select(F.lit("candidate").alias("part"), "query", "external_id", F.col("handle").alias("detail")).unionByName(
        aside.select(F.lit("corrupt").alias("part"), "query", F.lit(None).cast("string").alias("external_id"), F.col("line").alias("detail"))
    )


@query
def first_occurrence(t: Samples) -> DataFrame:
    return discovery.first_occurrences(t.search_items())


@discovery.discovery_source("watched_handles")
def watched_handles(items: DataFrame, rules: Rules) -> DataFrame:
    """A source of its own: each author once over all queries, if the handle starts with a watched text."""
    firsts = dedup.first_per_key(discovery.author_sightings(items), ["external_id"], [F.asc("query"), F.asc("pos")])
    return firsts.where(F.startswith("handle", F.lit("user_1"))).select("external_id", "handle", "query", "pos")


@query
def discover_own_source(t: Samples) -> DataFrame:
    """Candidates of a registered source beside the built-in one."""
    return discovery.discover("watched_handles", t.search_items(), SEARCH_RULES)


@query
def discovery_events(t: Samples) -> DataFrame:
    found = discovery.discover(HASHTAG_SOURCE, t.search_items(), SEARCH_RULES)
    return discover.discovery_events(found, _at(EVENTS_AS_OF))


def _due(t: Samples) -> DataFrame:
    return discover.due_for_refresh(
        t.creators(), t.creator_scores(), t.profile_snapshots(), _at(ORDERS_AS_OF), SAMPLE_RULES
    )


@query
def refresh_due(t: Samples) -> DataFrame:
    return _due(t)


@query
def refresh_due_by_day(t: Samples) -> DataFrame:
    """Due creators from the calendar that two rounds have kept, the second of them twelve days earlier."""
    store = RoundStore(t.spark, shared_folder(t.spark, "refresh-calendar"), calendar.tables("bigint", SAMPLE_BUCKETS))
    creators, snapshots, scores = t.creators(), t.profile_snapshots(), t.creator_scores()
    for moment, part in (("2001-06-01 00:00:00", "{0} < '2000-01-01'"), ("2001-07-20 00:00:00", "{0} >= '2000-01-01'")):
        calendar.calendar_round(
            store,
            moment[:10],
            _moment(moment),
            creators if moment < "2001-07" else creators.limit(0),
            snapshots.where(part.format("snapshot_date")),
            scores.where(part.format("computed_at")),
            SAMPLE_RULES,
        )
    return calendar.due_by_calendar(store, _moment(ORDERS_AS_OF))


@query
def enqueue_idempotent(t: Samples) -> DataFrame:
    found = discovery.discover(HASHTAG_SOURCE, t.search_items(), SEARCH_RULES)
    return discover.enqueue_round(found, _due(t), t.pending_users(), SEARCH_RULES)


@query
def dequeue_topk(t: Samples) -> DataFrame:
    return queue.next_batch(t.ingestion_queue(), RULES.fetch_batch)


@query
def queue_transition(t: Samples) -> DataFrame:
    taken = queue.mark_in_progress(t.ingestion_queue(), RULES.fetch_batch)
    return queue.complete(taken, t.fetch_outcomes()).select("queue_id", "priority", "status", "error")


@query
def error_summary(t: Samples) -> DataFrame:
    return t.failure_log().select(
        "queue_id",
        failures.summarize(
            F.col("kind"), F.col("status_code"), F.col("error_type"), F.col("message"), RULES
        ).alias("summary"),
        failures.full_text(F.col("error_type"), F.col("message")).alias("detail"),
    )


# Landing and parsing


@query
def fetch_envelope(t: Samples) -> DataFrame:
    return envelope.fetch_envelopes(t.fetch_requests(), t.fetch_items(), RULES)


@query
def land_raw_payloads(t: Samples) -> DataFrame:
    """Append the envelopes to a daily landing table and read the landed rows back."""
    payloads = envelope.fetch_envelopes(t.fetch_requests(), t.fetch_items(), RULES)
    landed = payloads.select(
        "platform",
        "source_type",
        "external_id",
        "payload",
        F.lit(PENDING).alias("parse_status"),
        F.to_date(_at(EVENTS_AS_OF)).alias("fetched_on"),
    )
    path = shared_folder(t.spark, "landing")
    for _ in range(2):  # a rerun changes nothing
        append_daily(landed, path, "fetched_on", round_id="2024-01-31")
    stored = "platform string, source_type string, external_id string, payload string, parse_status string"
    return read_table(t.spark, path, f"{stored}, fetched_on date, round string").drop("round")


@query
def ingest_round(t: Samples) -> DataFrame:
    """Landed payloads of the next queue batch, and the states that its queue rows end up with."""
    queued = t.ingestion_queue()
    batch = ingest.fetch_requests(queued, RULES)
    items = batch.join(t.user_items(), "external_id").select("request_id", "pos", "item")
    done = ingest.ingest(queued, items, t.raised_fetches(), _at(EVENTS_AS_OF), RULES)
    states = done.queue.join(batch.select(F.col("request_id").alias("queue_id")), "queue_id", "left_semi")
    landed = done.raw_payloads.select(
        F.lit("landed").alias("part"), F.col("raw_id").alias("id"), "external_id", F.col("source_type").alias("label"), F.col("payload").alias("detail")
    )
    return landed.unionByName(
        states.select(
            F.lit("queue").alias("part"), F.col("queue_id").cast("string").alias("id"), "external_id", F.col("status").alias("label"), F.col("error").alias("detail")
        )
    )


@query
def pending_payloads(t: Samples) -> DataFrame:
    raw = t.raw_payloads()
    return raw.where(F.col("parse_status") == PENDING).select("raw_id", "platform", "external_id")


def _parsed(t: Samples) -> DataFrame:
    return parsing.parse_payloads(t.raw_payloads())


@query
def parse_outcomes(t: Samples) -> DataFrame:
    return _parsed(t).select("raw_id", "outcome", "error", "reason")


@query
def parse_errors(t: Samples) -> DataFrame:
    return parsing.errors(_parsed(t))


@query
def payload_status(t: Samples) -> DataFrame:
    return _parsed(t).select("raw_id", parsing.parse_status(F.col("outcome")).alias("parse_status"))


@query
def parse_profiles(t: Samples) -> DataFrame:
    return parsing.profiles(_parsed(t)).drop("fetched_at", "landed_platform", "landed_external_id")


@query
def parse_videos(t: Samples) -> DataFrame:
    return parsing.videos(_parsed(t)).drop("platform", "external_id", "fetched_at")


@query
def parse_first_video(t: Samples) -> DataFrame:
    return parsing.first_videos(_parsed(t)).select("raw_id", "video_id", "is_ad", "digg_count")


CLIP = parsing.Shape(
    head=f"clip: struct<{parsing.AUTHOR_ID}>",
    author=lambda head: head["clip"]["authorMeta"]["id"],
    profile=lambda payload: V.read(payload, f"struct<clip: {parsing.PROFILE}>")["clip"],
    videos=lambda payload: F.array(V.read(payload, f"struct<clip: {parsing.VIDEO}>")["clip"]),
)


@query
def parse_new_shape(t: Samples) -> DataFrame:
    """Payloads of a registered new shape, parsed beside those of the shapes that are built in."""
    is_clip = F.col("source_type") == "hashtag"
    raw = t.raw_payloads().withColumns(
        {
            "payload": F.when(is_clip, F.concat(F.lit('{"clip":'), "payload", F.lit("}"))).otherwise(F.col("payload")),
            "source_type": F.when(is_clip, "clip").otherwise(F.col("source_type")),
        }
    )
    shapes = {**parsing.SHAPES, "clip": CLIP}
    opened = parsing.opened(parsing.parse_payloads(raw, shapes), shapes)
    return opened.select(
        "raw_id",
        "outcome",
        "error",
        F.col("profile.handle").alias("handle"),
        F.col("profile.follower_count").alias("follower_count"),
        F.array_sort(F.transform("videos", lambda video: video["video_id"])).alias("video_ids"),
    )


_LOOSE = """struct<id: variant, isAd: variant, shareCount: variant, playCount: variant, collectCount: variant,
    authorMeta: struct<fans: variant, following: variant, video: variant, verified: variant,
                       privateAccount: variant, ttSeller: variant, commerceUserInfo: variant>>"""


def _opened_items(t: Samples) -> DataFrame:
    """The leading item of every payload, read without any outcome rule."""
    item = F.when(F.col("source_type") == "hashtag", V.read(F.col("payload"), _LOOSE)).otherwise(
        V.read(F.col("payload"), f"struct<profile_item: {_LOOSE}>")["profile_item"]
    )
    return V.evaluate_once(t.raw_payloads(), ["raw_id"], item=item)


@query
def json_dual_shape(t: Samples) -> DataFrame:
    opened = V.evaluate_once(
        t.search_items(), ["query", "pos"], doc=V.read(F.col("item"), discovery.AUTHOR_REF)
    )

    def author(leaf: str) -> Column:
        return V.text(V.dual_shape(F.col("doc"), "authorMeta", leaf)).alias(leaf)

    return opened.select("query", "pos", author("id"), author("name"), author("fans"))


@query
def json_lenient_int(t: Samples) -> DataFrame:
    item, author = F.col("item"), F.col("item.authorMeta")
    return _opened_items(t).select(
        "raw_id",
        V.integer(author["fans"]).alias("fans"),
        V.integer(author["following"]).alias("following"),
        V.integer(author["video"]).alias("video"),
        V.integer(item["shareCount"]).alias("share_count"),
        V.integer(item["playCount"]).alias("play_count"),
        V.integer(item["collectCount"]).alias("collect_count"),
    )


@query
def json_truthy(t: Samples) -> DataFrame:
    item, author = F.col("item"), F.col("item.authorMeta")
    return _opened_items(t).select(
        "raw_id",
        V.truthy(author["verified"]).alias("verified"),
        V.truthy(author["privateAccount"]).alias("private_account"),
        V.truthy(author["ttSeller"]).alias("tt_seller"),
        V.truthy(author["commerceUserInfo"]).alias("commerce_info"),
        V.truthy(item["isAd"]).alias("is_ad"),
        V.truthy(item["id"]).alias("has_id"),
    )


# Enrichment


@query
def enrich_snapshots(t: Samples) -> DataFrame:
    rows = enrich.profile_snapshots(_parsed(t), F.col("fetched_at"))
    return rows.select(
        "raw_id",
        "creator_id",
        "snapshot_date",
        "handle",
        "follower_count",
        "is_verified",
        "is_private",
        "is_commerce_account",
        "scrape_status",
    )


@query
def profile_snapshots(t: Samples) -> DataFrame:
    """Snapshots stamped with the run date, appended to a daily history and read back."""
    rows = enrich.profile_snapshots(_parsed(t), _at(EVENTS_AS_OF))
    kept = rows.select("raw_id", "handle", "lifetime_likes", "bio", "scrape_status", "snapshot_date")
    path = shared_folder(t.spark, "profile-snapshots")
    append_daily(kept, path, "snapshot_date", round_id="2024-01-31")
    stored = ", ".join(f"{name} {kind}" for name, kind in kept.dtypes)
    return read_table(t.spark, path, f"{stored}, round string").drop("round")


@query
def video_snapshots(t: Samples) -> DataFrame:
    rows = enrich.video_snapshots(parsing.videos(_parsed(t)), _at(EVENTS_AS_OF))
    return rows.select(
        "raw_id",
        "video_id",
        "snapshot_date",
        "play_count",
        "digg_count",
        "comment_count",
        "share_count",
        "collect_count",
    )


def _earlier() -> Column:
    """Payloads that make the stored state of the upsert queries; the others arrive on top."""
    return F.col("fetched_at") < _at("2024-01-16 00:00:00")


@query
def upsert_creators(t: Samples) -> DataFrame:
    """Sightings of the later payloads over the creators that the earlier ones left."""
    stamp = F.col("fetched_at")
    seen = parsing.handled(_parsed(t)).groupBy("platform", "external_id").agg(
        F.min(F.when(_earlier(), stamp)).alias("first_discovered_at"),
        F.max(F.when(_earlier(), stamp)).alias("last_seen_at"),
        F.min(F.when(~_earlier(), stamp)).alias("first_sighting"),
        F.max(F.when(~_earlier(), stamp)).alias("last_sighting"),
    )
    stored = seen.where(F.col("first_discovered_at").isNotNull()).select(
        dedup.creator_key(F.col("platform"), F.col("external_id")).alias("creator_id"),
        "platform",
        "external_id",
        "first_discovered_at",
        "last_seen_at",
        F.lit("inactive").alias("status"),
    )
    later = seen.where(F.col("first_sighting").isNotNull())
    return dedup.upsert_ranges(stored, later.select("platform", "external_id", "first_sighting", "last_sighting"))


@query
def upsert_videos(t: Samples) -> DataFrame:
    """New state of the videos table: stored videos stay, unseen ones are added once."""
    rows = enrich.merged_videos(parsing.videos(_parsed(t)), ~_earlier(), F.col("fetched_at"))
    return rows.select("video_id", "creator_id", "posted_at", "is_ad", "first_seen_at")


# Rounds: tables that are published together


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


SAMPLE_BUCKETS = 8  # the samples hold a few megabytes of payloads
BUCKET_ROWS = 50_000
FIRST_RUN, SECOND_RUN = "2024-01-16 00:00:00", "2024-01-31 00:00:00"


class Interrupted(Exception):
    pass


def _two_landings(t: Samples, purpose: str) -> rounds.RoundStore:
    """A store whose first landing has been enriched and whose second one is pending.

    Buckets are parsed one task each, so their number grows with the payloads. The
    events are dealt out before they become payloads, since a file may be one row group.
    """
    events = t.table("events")
    buckets = max(SAMPLE_BUCKETS, -(-events.count() // BUCKET_ROWS))
    store = rounds.open_store(t.spark, shared_folder(t.spark, purpose), buckets=buckets)
    raw = t.raw_payloads(events.repartition("event_id", "ts"))
    rounds.land(store, "landing-1", raw.where(_earlier()), _moment("2024-01-15 00:00:00"))
    rounds.enrich_round(store, "enrich-1", _moment(FIRST_RUN))
    rounds.land(store, "landing-2", raw.where(~_earlier()), _moment("2024-01-30 00:00:00"))
    return store


@query
def enrich_rounds(t: Samples) -> DataFrame:
    """Every row of every table after two enrichment rounds, the second of which broke off once and ran again."""
    store = _two_landings(t, "enrich-rounds")
    try:
        with store.round("enrich-2", _moment(SECOND_RUN)) as broken:
            for name in ("profile_snapshots", "videos"):
                broken.write(name, store.read(name))
            raise Interrupted
    except Interrupted:
        rounds.enrich_round(store, "enrich-2", _moment(SECOND_RUN))

    def rows(name: str, key: Column, creator: Column, day: Column, *details: str) -> DataFrame:
        told = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in details])
        return store.read(name).select(
            F.lit(name).alias("table_name"),
            key.cast("string").alias("id"),
            creator.cast("string").alias("creator"),
            F.to_date(day).alias("day"),
            told.alias("detail"),
        )

    nobody = F.lit(None)
    return (
        rows("profile_snapshots", F.col("snapshot_id"), F.col("creator_id"), F.col("snapshot_date"), "raw_id", "handle", "follower_count", "lifetime_likes", "video_count", "is_verified", "is_private", "is_commerce_account", "scrape_status")
        .unionByName(rows("videos", F.col("video_id"), F.col("creator_id"), F.col("first_seen_at"), "is_ad", "text_language", "web_video_url"))
        .unionByName(rows("video_snapshots", F.col("snapshot_id"), nobody, F.col("snapshot_date"), "raw_id", "video_id", "play_count", "digg_count", "comment_count", "share_count"))
        .unionByName(rows("parse_errors", F.col("raw_id"), nobody, F.col("occurred_at"), "error"))
        .unionByName(rows("parse_outcomes", F.col("raw_id"), nobody, nobody, "outcome", "reason"))
        .unionByName(rows("creator_sightings", F.col("external_id"), F.col("platform"), F.col("last_sighting"), "round"))
    )


@query
def stored_status(t: Samples) -> DataFrame:
    """Status of every landed payload from the stored outcomes, while the second landing waits."""
    status = rounds.payload_status(_two_landings(t, "stored-status"))
    return status.select("raw_id", "external_id", "error", "parse_status")


@query
def waiting_payloads(t: Samples) -> DataFrame:
    """The payloads that the next round will parse, and what it will make of them."""
    waiting = rounds.pending_payloads(_two_landings(t, "waiting-payloads"))
    return parsing.parse_payloads(waiting).select("raw_id", "source_type", "external_id", "outcome", "error")


NEWEST = {
    "newest_snapshots": Table(
        "snapshot_id bigint, creator_id bigint, snapshot_date date, created_at timestamp, follower_count bigint",
        bucketed_by="creator_id",
        buckets=8,
    )
}


@query
def kept_newest(t: Samples) -> DataFrame:
    """The two newest snapshots of each creator, kept over rounds that bring the years in no order."""
    store = rounds.open_store(t.spark, shared_folder(t.spark, "kept-newest"), NEWEST)
    snapshots = t.profile_snapshots()
    year = F.year("snapshot_date")
    for turn, part in enumerate((year >= 2000, year < 1997, (year >= 1997) & (year < 2000))):
        with store.round(f"round-{turn}", datetime(2001, 9, 1 + turn)) as this:
            rounds.keep_newest(this, "newest_snapshots", snapshots.where(part), "creator_id", snapshot_order(), 2)
    kept = rounds.kept_newest(store, "newest_snapshots")
    ranked = latest_n(kept, ["creator_id"], snapshot_order(), 2, rank_as="position")
    return ranked.select("creator_id", "position", "snapshot_id", "snapshot_date", "follower_count")


@query
def queue_round(t: Samples) -> DataFrame:
    """Events and queue rows that a discovery round stored, and the state of the queue after its next batch was taken."""
    store = rounds.open_store(t.spark, shared_folder(t.spark, "queue-round"))
    found = discovery.discover(HASHTAG_SOURCE, t.search_items(), SEARCH_RULES)
    rounds.discovery_round(store, "2024-01-31", found, _due(t), t.pending_users(), _moment(EVENTS_AS_OF), SEARCH_RULES)
    queued = queue.mark_in_progress(store.read("ingestion_queue").drop("round"), SEARCH_RULES.fetch_batch)
    events = store.read("discovery_events").select(
        F.lit("event").alias("part"),
        F.lit(None).cast("string").alias("id"),
        "platform",
        "external_id",
        F.col("source").alias("reason"),
        F.col("query").alias("label"),
        F.lit(None).cast("int").alias("priority"),
        F.col("discovered_at").alias("at"),
    )
    return events.unionByName(
        queued.select(
            F.lit("queue").alias("part"), F.col("queue_id").alias("id"), "platform", "external_id", "reason", F.col("status").alias("label"), "priority", F.col("enqueued_at").alias("at")
        )
    )


@query
def score_rounds(t: Samples) -> DataFrame:
    """Scores of two rounds a month apart, the later beside the earlier, with their ids."""
    store = rounds.open_store(t.spark, shared_folder(t.spark, "score-rounds"))
    for moment in (ORDERS_AS_OF, "2001-09-01 00:00:00"):
        rounds.score_round(
            store, moment[:10], t.creators(), t.profile_snapshots(), t.videos(), t.video_snapshots(), _moment(moment), SAMPLE_RULES, t.video_snapshot_order()
        )
    return store.read("creator_scores").select(
        "score_id", "creator_id", "score_version", "computed_at", "engagement_rate", "growth_rate", "posting_consistency", "account_type", "tier", "flags"
    )


@query
def outreach_listing(t: Samples) -> DataFrame:
    """The outreach queue as its operators list it, after a push."""
    stored = t.outreach_queue()
    pushed = handoff.outreach_push(t.creator_scores(), stored, _at(ORDERS_AS_OF), RULES)
    return reports.outreach_listing(stored.unionByName(pushed, allowMissingColumns=True))


# Latest rows and signals


@query
def active_creators(t: Samples) -> DataFrame:
    return reports.active_creators(t.creators()).select("creator_id")


@query
def creators_per_platform(t: Samples) -> DataFrame:
    return reports.count_by(t.creators(), "platform")


@query
def latest_per_key(t: Samples) -> DataFrame:
    """The latest score, profile snapshot and video snapshot of each key."""
    scores = latest(t.creator_scores(), ["creator_id"], score_order())
    profiles = latest(t.profile_snapshots(), ["creator_id"], snapshot_order())
    counters = latest(t.video_snapshots(), ["video_id"], t.video_snapshot_order())
    return (
        scores.select(
            F.lit("score").alias("kind"),
            F.col("creator_id").alias("key"),
            F.to_date("computed_at").alias("day"),
            F.col("score_id").alias("picked"),
        )
        .unionByName(
            profiles.select(
                F.lit("profile").alias("kind"),
                F.col("creator_id").alias("key"),
                F.col("snapshot_date").alias("day"),
                F.col("snapshot_id").alias("picked"),
            )
        )
        .unionByName(
            counters.select(
                F.lit("video").alias("kind"),
                F.col("video_id").alias("key"),
                F.col("snapshot_date").alias("day"),
                F.col("digg_count").alias("picked"),
            )
        )
    )


@query
def latest_n_per_key(t: Samples) -> DataFrame:
    rows = latest_n(t.profile_snapshots(), ["creator_id"], snapshot_order(), 2, rank_as="position")
    return rows.select("creator_id", "position", "snapshot_id", "snapshot_date", "follower_count")


@query
def latest_score_with_ties(t: Samples) -> DataFrame:
    return latest_with_ties(t.creator_scores(), ["creator_id"], "computed_at").select(
        "creator_id", "score_id", "tier", "computed_at"
    )


@query
def lifetime_engagement(t: Samples) -> DataFrame:
    rate = S.lifetime_engagement(F.col("lifetime_likes"), F.col("video_count"), F.col("follower_count"))
    return t.profile_snapshots().select("snapshot_id", rate.alias("engagement_rate"))


def _recent(t: Samples) -> DataFrame:
    return videos.recent_video_engagement(
        t.videos(), t.video_snapshots(), SAMPLE_RULES, t.video_snapshot_order()
    )


@query
def recent_video_engagement(t: Samples) -> DataFrame:
    return _recent(t)


@query
def recent_engagement(t: Samples) -> DataFrame:
    activity = videos.video_summary(_recent(t), _at(ORDERS_AS_OF), SAMPLE_RULES)
    followers = latest(t.profile_snapshots(), ["creator_id"], snapshot_order()).select(
        "creator_id", "follower_count"
    )
    rate = S.recent_engagement(
        F.col("organic_interactions"), F.col("organic_videos"), F.col("follower_count")
    )
    return followers.join(activity, "creator_id", "left").select("creator_id", rate.alias("engagement_rate"))


@query
def posting_consistency(t: Samples) -> DataFrame:
    activity = videos.video_summary(_recent(t), _at(ORDERS_AS_OF), SAMPLE_RULES)
    rate = S.posting_rate(F.col("videos_in_window"), F.col("dated_videos"), SAMPLE_RULES)
    return activity.select("creator_id", rate.alias("posting_consistency"))


def _figures(t: Samples) -> DataFrame:
    return score.snapshot_signals(score.current_and_previous(t.profile_snapshots()), SAMPLE_RULES)


@query
def growth_rate(t: Samples) -> DataFrame:
    return _figures(t).select("creator_id", F.col("growth").alias("growth_rate"))


@query
def suspicious_growth(t: Samples) -> DataFrame:
    return _figures(t).select(
        "creator_id",
        S.suspicious(F.col("growth"), F.col("lifetime_rate"), SAMPLE_RULES).alias("suspicious_growth"),
    )


@query
def account_type(t: Samples) -> DataFrame:
    kind = S.account_type(F.col("bio"), F.col("bio_link"), F.col("sells"), BIO_RULES)
    return t.bios().select("page_id", kind.alias("account_type"))


@query
def assign_tier(t: Samples) -> DataFrame:
    """Creators by tier and flags, judged on their snapshots alone."""
    signals = _figures(t).select(
        "follower_count",
        F.col("lifetime_rate").alias("engagement_rate"),
        F.col("growth").alias("growth_rate"),
        F.col("account").alias("account_type"),
        "scrape_status",
        S.suspicious(F.col("growth"), F.col("lifetime_rate"), SAMPLE_RULES).alias("suspicious_growth"),
    )
    tiered = score.with_tier(signals, SAMPLE_RULES)
    return tiered.groupBy("tier", F.array_join("flags", ",").alias("flags")).agg(
        F.count(F.lit(1)).alias("creators")
    )


STRICT_RULES = replace(SAMPLE_RULES, engagement_a=0.12, engagement_b=0.07, engagement_c=0.04, excluded_accounts=("brand",))


@query
def assign_tier_own_rules(t: Samples) -> DataFrame:
    """``assign_tier`` of single creators under changed thresholds and exclusions."""
    signals = _figures(t).select(
        "creator_id",
        "follower_count",
        F.col("lifetime_rate").alias("engagement_rate"),
        F.col("growth").alias("growth_rate"),
        F.col("account").alias("account_type"),
        "scrape_status",
        S.suspicious(F.col("growth"), F.col("lifetime_rate"), STRICT_RULES).alias("suspicious_growth"),
    )
    return score.with_tier(signals, STRICT_RULES).select("creator_id", "tier", "flags")


@query
def creator_signals(t: Samples) -> DataFrame:
    return score.creator_signals(
        t.creators(),
        t.profile_snapshots(),
        t.videos(),
        t.video_snapshots(),
        _at(ORDERS_AS_OF),
        SAMPLE_RULES,
        t.video_snapshot_order(),
    )


@query
def score_creators(t: Samples) -> DataFrame:
    return score.score_creators(
        t.creators(),
        t.profile_snapshots(),
        t.videos(),
        t.video_snapshots(),
        _at(ORDERS_AS_OF),
        SAMPLE_RULES,
        t.video_snapshot_order(),
    ).drop("score_id")


# Handoff


@query
def outreach_ready(t: Samples) -> DataFrame:
    return handoff.outreach_ready(t.creator_scores(), t.outreach_queue(), RULES)


@query
def outreach_push(t: Samples) -> DataFrame:
    return handoff.outreach_push(t.creator_scores(), t.outreach_queue(), _at(ORDERS_AS_OF), RULES)


@query
def a_tier_candidates(t: Samples) -> DataFrame:
    return handoff.a_tier_candidates(
        t.creator_scores(), t.creators(), t.profile_snapshots(), t.outreach_queue(), RULES
    )


# Monitoring


def _hours_before(moment: str, hours: int) -> Column:
    return _at(moment) - F.expr(f"INTERVAL {hours} HOURS")


@query
def count_since(t: Samples) -> DataFrame:
    events = reports.count_since(
        t.discovery_events(), "discovered_at", _hours_before(EVENTS_AS_OF, RULES.discovery_hours)
    )
    payloads = reports.count_since(
        t.raw_payloads(), "fetched_at", _hours_before(EVENTS_AS_OF, RULES.ingestion_hours)
    )
    return events.select(F.lit("discovery_events").alias("source_table"), "n").unionByName(
        payloads.select(F.lit("raw_payloads").alias("source_table"), "n")
    )


@query
def count_by_status(t: Samples) -> DataFrame:
    return reports.count_by(t.ingestion_queue(), "status")


@query
def count_by_parse_status(t: Samples) -> DataFrame:
    return reports.count_by(t.raw_payloads(), "parse_status")


@query
def quota_errors(t: Samples) -> DataFrame:
    return reports.quota_errors(t.ingestion_queue(), RULES)


@query
def failure_rate(t: Samples) -> DataFrame:
    fetches = reports.failure_rate(t.ingestion_queue(), "status")
    parses = reports.failure_rate(t.raw_payloads(), "parse_status")
    return fetches.withColumn("stage", F.lit("fetch")).unionByName(parses.withColumn("stage", F.lit("parse")))


@query
def report_counts(t: Samples) -> DataFrame:
    return reports.operator_report(
        t.discovery_events(), t.ingestion_queue(), t.raw_payloads(), t.creator_scores(), t.outreach_queue()
    )


@query
def discovery_today(t: Samples) -> DataFrame:
    return reports.discovery_today(t.discovery_events(), F.date_sub(F.to_date(_at(EVENTS_AS_OF)), 1))


@query
def run_totals(t: Samples) -> DataFrame:
    """Candidates found, refreshes due and creators pushed: counted by the writes of the rounds that make them."""
    store = rounds.open_store(t.spark, shared_folder(t.spark, "run-totals"))
    found = discovery.discover(HASHTAG_SOURCE, t.search_items(), SEARCH_RULES)
    rounds.discovery_round(store, "discovery", found, _due(t), t.pending_users(), _moment(EVENTS_AS_OF), SEARCH_RULES)
    rounds.handoff_round(store, "handoff", t.creator_scores(), t.outreach_queue(), _moment(ORDERS_AS_OF), RULES)
    names = {"candidates": "found", "refreshes_due": "due", "outreach_queue": "pushed"}
    counted = store.totals("discovery").unionByName(store.totals("handoff")).where(F.col("table").isin(*names))
    label = F.coalesce(*[F.when(F.col("table") == table, total) for table, total in names.items()])
    return counted.select(label.alias("total"), "n")


@query
def latest_snapshot_by_tier(t: Samples) -> DataFrame:
    return monitor.latest_snapshot_by_tier(t.creator_scores(), t.profile_snapshots())


@query
def tier_freshness(t: Samples) -> DataFrame:
    return monitor.tier_checks(t.creator_scores(), t.profile_snapshots(), _at(ORDERS_AS_OF), RULES)


def _checks(t: Samples, tiers_as_of: str = ORDERS_AS_OF) -> DataFrame:
    return monitor.all_checks(
        t.discovery_events(),
        t.raw_payloads(),
        t.ingestion_queue(),
        t.creator_scores(),
        t.profile_snapshots(),
        _at(EVENTS_AS_OF),
        RULES,
        tiers_as_of=_at(tiers_as_of),
    )


@query
def monitor_checks(t: Samples) -> DataFrame:
    return _checks(t)


@query
def monitor_failures(t: Samples) -> DataFrame:
    """Alarms of all checks, with tier freshness measured a month after the last snapshot."""
    return monitor.failed_checks(_checks(t, "2001-09-01 00:00:00"))


# Streams, run over everything available


@query
def stream_parse(t: Samples) -> DataFrame:
    folder = shared_folder(t.spark, "stream-parse")
    raw = t.raw_payloads(jobs.open_stream(t.spark, t.folder, "events"))
    jobs.parse_landed(raw, folder, F.col("fetched_at"))

    def rows(name: str, key: str, *details: str) -> DataFrame:
        told = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in details])
        table = t.spark.read.parquet(f"{folder}/{name}")
        return table.select(F.lit(name).alias("written_to"), F.col(key).cast("string").alias("id"), told.alias("detail"))

    creators = jobs.stored_creators(t.spark, folder)
    seen = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("first_discovered_at", "last_seen_at")]
    return (
        rows("profile_snapshots", "raw_id", "creator_id", "handle", "follower_count", "lifetime_likes", "scrape_status")
        .unionByName(rows("videos", "video_id", "creator_id", "is_ad"))
        .unionByName(rows("video_snapshots", "video_id", "raw_id", "play_count", "digg_count", "comment_count", "share_count"))
        .unionByName(rows("parse_errors", "raw_id", "error"))
        .unionByName(creators.select(F.lit("creators").alias("written_to"), F.col("external_id").alias("id"), F.concat_ws("|", "status", *seen).alias("detail")))
    )


@query
def stream_dedup(t: Samples) -> DataFrame:
    items = t.search_items(jobs.open_stream(t.spark, t.folder, "events"))
    folder = shared_folder(t.spark, "stream-dedup")
    queued = jobs.enqueue_sightings(items, folder, SEARCH_RULES, t.pending_users(), _at(EVENTS_AS_OF))
    return queued.select("queue_id", "platform", "external_id", "handle", "reason", "priority", "status", "enqueued_at")


@query
def stream_arrivals(t: Samples) -> DataFrame:
    rows = t.raw_payloads(jobs.open_stream(t.spark, t.folder, "events")).select("fetched_at")
    folder = shared_folder(t.spark, "stream-arrivals")
    return jobs.arrival_counts(rows, folder, "fetched_at", "2 hours", "15 minutes")


def _snapshot_stream(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.open_stream(spark, folder, "orders").select(
        F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_custkey").alias("creator_id"),
        F.to_date("o_orderdate").alias("snapshot_date"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.floor(F.col("o_totalprice") / 10).alias("follower_count"),
    )


@query
def stream_growth(t: Samples) -> DataFrame:
    return jobs.growth_updates(_snapshot_stream(t.spark, t.folder), shared_folder(t.spark, "stream-growth"), SAMPLE_RULES)


@query
def stream_changed_growth(t: Samples) -> DataFrame:
    folder = shared_folder(t.spark, "stream-changed-growth")
    keyed.changed_growth(_snapshot_stream(keyed.keyed_session(t.spark), t.folder), folder, SAMPLE_RULES)
    return keyed.current_growth(t.spark, folder)
