"""Refreshes by calendar: the day on which a creator falls due is stored when a snapshot, a score or a status lands.

A round merges what landed into one row per creator, and writes which planned
days came up and which were taken back, partitioned by day. Finding the due
creators then reads the open ones of the last round and the days since, and
neither snapshots nor scores. The result is that of ``due_for_refresh`` over
everything that the rounds brought.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.tiering import refresh_interval
from talentsift.operators.reports import active_creators
from talentsift.rules import SUCCESS, Rules
from talentsift.sources.rounds import RoundStore, Table

# A creator that was never fetched is due since this day.
ALWAYS = "1970-01-01"


def tables(id_type: str = "string", buckets: int = 64) -> dict[str, Table]:
    """Tables of the calendar for creators, snapshots and scores with ids of ``id_type``."""
    plan = "due_on: date, platform: string, external_id: string, handle: string"
    snapshot = f"struct<snapshot_date: date, created_at: timestamp, snapshot_id: {id_type}, handle: string>"
    state = f"""creator_id {id_type}, newest {snapshot}, fetched {snapshot},
        score struct<computed_at: timestamp, score_id: {id_type}, tier: string>,
        facts struct<told_at: timestamp, platform: string, external_id: string, active: boolean>,
        planned struct<{plan}>, former struct<{plan}>"""
    entry = plan.replace(":", "")
    return {
        "due_state": Table(state, bucketed_by="creator_id", buckets=buckets),
        "due_entries": Table(f"{entry}, change int", day="due_on"),
        "due_open": Table(entry),
    }


def _arriving(creators: DataFrame, snapshots: DataFrame, scores: DataFrame, told_at: Column) -> DataFrame:
    """The newest of what landed, one row per creator.

    Order within a struct is the order of its fields, nulls first, so its
    maximum is the first row of ``snapshot_order`` or ``score_order``; maxima
    are combined before the shuffle.
    """
    snapshot = F.struct("snapshot_date", "created_at", "snapshot_id", "handle")
    facts = F.struct(told_at.alias("told_at"), "platform", "external_id", "active")
    known = creators.join(active_creators(creators).select("creator_id", F.lit(True).alias("active")), "creator_id", "left")
    told = (
        snapshots.select("creator_id", snapshot.alias("newest"), F.when(F.col("scrape_status") == SUCCESS, snapshot).alias("fetched"))
        .unionByName(scores.select("creator_id", F.struct("computed_at", "score_id", "tier").alias("score")), allowMissingColumns=True)
        .unionByName(
            known.withColumn("active", F.coalesce("active", F.lit(False))).select("creator_id", facts.alias("facts")),
            allowMissingColumns=True,
        )
    )
    return told.groupBy("creator_id").agg(*[F.max(c).alias(c) for c in ("newest", "fetched", "score", "facts")])


def _planned(rules: Rules, last_success_handle: bool) -> Column:
    """When an active creator is due, and what the queue needs to know of it then; null for others."""
    newest, facts = F.col("newest"), F.col("facts")
    due_on = F.date_add(newest["snapshot_date"], refresh_interval(F.col("score")["tier"], rules))
    handle = F.coalesce(F.col("fetched")["handle"], newest["handle"]) if last_success_handle else newest["handle"]
    plan = F.struct(
        F.coalesce(due_on, F.lit(ALWAYS).cast("date")).alias("due_on"),
        facts["platform"].alias("platform"),
        facts["external_id"].alias("external_id"),
        F.coalesce(handle, facts["external_id"]).alias("handle"),
    )
    return F.when(facts["active"], plan)


def _last(store: RoundStore, before: datetime) -> tuple[Column, datetime | None]:
    """The rows of the last calendar round before a moment, and when that round was."""
    markers = store.published(before).where(F.map_contains_key("rows", F.lit("due_state")))
    last = markers.agg(F.max(F.struct("as_of", "round", "attempt")).alias("last")).first()["last"]
    if last is None:
        return F.lit(False), None
    return (F.col("round") == last["round"]) & (F.col("attempt") == last["attempt"]), last["as_of"]


def calendar_round(
    store: RoundStore,
    round_id: str,
    as_of: datetime,
    creators: DataFrame,
    snapshots: DataFrame,
    scores: DataFrame,
    rules: Rules,
    last_success_handle: bool = False,
) -> None:
    """Bring what landed since the last round into the calendar.

    ``creators`` holds new and changed rows, ``snapshots`` and ``scores`` the
    landed ones; each may be empty, hold rows of any age, and bring a row again.
    Rounds are run in the order of their moments. The state lies in buckets by
    creator, so only what landed is shuffled.
    """
    buckets = store.tables["due_state"].buckets
    chosen, _ = _last(store, as_of)
    with store.round(round_id, as_of) as this:
        kept = store.everything("due_state").where(chosen)
        state = kept.select("creator_id", "newest", "fetched", "score", "facts", F.col("planned").alias("former"))
        landed = _arriving(creators, snapshots, scores, this.stamp).repartition(buckets, "creator_id")
        merged = (
            landed.unionByName(state, allowMissingColumns=True)
            .groupBy("creator_id")
            .agg(*[F.max(c).alias(c) for c in ("newest", "fetched", "score", "facts", "former")])
        )
        this.write("due_state", merged.withColumn("planned", _planned(rules, last_success_handle)), in_place=True)
        now = this.staged("due_state")
        today = F.to_date(this.stamp)
        this.write("due_open", now.select("planned.*").where(F.col("due_on") <= today))
        moved = now.where(~F.col("planned").eqNullSafe(F.col("former")))
        changes = F.array(
            F.struct(F.col("former").alias("plan"), F.lit(-1).alias("change")),
            F.struct(F.col("planned").alias("plan"), F.lit(1).alias("change")),
        )
        entries = moved.select(F.inline(changes)).select("plan.*", "change")
        this.write("due_entries", entries.where(F.col("due_on") > today))


def due_by_calendar(store: RoundStore, as_of: datetime) -> DataFrame:
    """Creators due at ``as_of``: those open after the last round, and those whose day came since.

    Days after ``as_of`` and days up to the last round are not opened. A round
    at ``as_of`` itself counts.
    """
    before = as_of + timedelta(microseconds=1)
    chosen, last = _last(store, before)
    columns = ["due_on", "platform", "external_id", "handle"]
    standing = store.everything("due_open").where(chosen).select(*columns)
    if last is None:
        return standing.drop("due_on")
    days = (F.col("due_on") > F.to_date(F.lit(last).cast("timestamp"))) & (F.col("due_on") <= F.to_date(F.lit(as_of).cast("timestamp")))
    planned = store.read("due_entries", before).where(days).groupBy(*columns).agg(F.sum("change").alias("standing"))
    return standing.unionByName(planned.where("standing > 0").select(*columns)).drop("due_on")
