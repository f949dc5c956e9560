"""Data-quality checks: one row ``(name, passed, measured, allowed, message)`` each.

Every source table is aggregated once, ungrouped, so a check also reports on
an empty table; checks that share a table share its scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.failures import is_quota_error
from talentsift.rules import FAILED, Rules


def _check(name: str, passed: Column, measured: Column, allowed: float, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        passed.alias("passed"),
        measured.cast("double").alias("measured"),
        F.lit(float(allowed)).alias("allowed"),
        message.alias("message"),
    )


def _rows(totals: DataFrame, *checks: Column) -> DataFrame:
    return totals.select(F.inline(F.array(*checks)))


def _arrivals(name: str, count: Column, noun: str, hours: int, rules: Rules) -> Column:
    text = F.concat(
        count.cast("string"), F.lit(f" {noun} in the last {hours}h (expected >= {rules.min_arrivals})")
    )
    return _check(name, count >= rules.min_arrivals, count, rules.min_arrivals, text)


def _percent(part: Column, whole: Column) -> Column:
    """A share with one digit, halves away from zero; whole-number arithmetic, so every engine can spell it alike."""
    tenths = F.floor((part * 2000 + whole) / (whole * 2))
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))


def _failures(name: str, failed: Column, total: Column, allowed: float, noun: str, idle: str) -> Column:
    rate = F.try_divide(failed, total)
    text = F.when(total == 0, F.lit(idle)).otherwise(
        F.concat(
            failed.cast("string"),
            F.lit("/"),
            total.cast("string"),
            F.lit(f" {noun} ("),
            _percent(failed, total),
            F.lit(f", threshold {allowed:.1%})"),
        )
    )
    return _check(name, (total == 0) | (rate <= allowed), F.coalesce(rate, F.lit(0.0)), allowed, text)


def _within(moment: str, as_of: Column, hours: int) -> Column:
    return F.col(moment) >= as_of - F.expr(f"INTERVAL {hours} HOURS")


def discovery_checks(events: DataFrame, as_of: Column, rules: Rules) -> DataFrame:
    recent = events.where(_within("discovered_at", as_of, rules.discovery_hours))
    totals = recent.agg(F.count(F.lit(1)).alias("n"))
    return _rows(
        totals,
        _arrivals("discovery_freshness", F.col("n"), "discovery events", rules.discovery_hours, rules),
    )


def payload_checks(raw: DataFrame, as_of: Column, rules: Rules) -> DataFrame:
    totals = raw.agg(
        F.count_if(_within("fetched_at", as_of, rules.ingestion_hours)).alias("n"),
        F.count_if(F.col("parse_status") == FAILED).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )
    return _rows(
        totals,
        _arrivals("ingestion_freshness", F.col("n"), "raw payloads landed", rules.ingestion_hours, rules),
        _failures(
            "parse_error_rate",
            F.col("failed"),
            F.col("total"),
            rules.max_parse_failures,
            "raw payloads failed to parse",
            "No raw payloads processed yet",
        ),
    )


def queue_checks(queue: DataFrame, rules: Rules) -> DataFrame:
    totals = queue.agg(
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_quota_error(F.col("status"), F.col("error"), rules)).alias("quota"),
    )
    quota, allowed = F.col("quota"), rules.max_quota_errors
    text = F.concat(
        quota.cast("string"),
        F.lit(" ingestion failures look like quota/rate-limit errors (402/429)"),
        F.when(quota > allowed, F.lit(" — check usage")).otherwise(F.lit("")),
    )
    return _rows(
        totals,
        _failures(
            "ingestion_health",
            F.col("failed"),
            F.col("total"),
            rules.max_queue_failures,
            "ingestion items failed",
            "No ingestion queue activity yet",
        ),
        _check("quota_exhaustion", quota <= allowed, quota, allowed, text),
    )


def latest_snapshot_by_tier(scores: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Newest snapshot date among all creators that ever had each tier.

    Both sides reduce to their distinct keys before they meet, so the join
    returns at most one row per creator and tier instead of every pairing of
    scores and snapshots.
    """
    dates = snapshots.groupBy("creator_id").agg(F.max("snapshot_date").alias("snapshot_date"))
    tiers = scores.select("creator_id", "tier").distinct()
    return (
        tiers.join(dates, "creator_id").groupBy("tier").agg(F.max("snapshot_date").alias("latest_snapshot"))
    )


def tier_checks(scores: DataFrame, snapshots: DataFrame, as_of: Column, rules: Rules) -> DataFrame:
    """One row per configured tier; a tier without creators passes."""
    entries = [F.struct(F.lit(tier).alias("tier"), F.lit(days).alias("days")) for tier, days in rules.refresh_days]
    intervals = scores.sparkSession.range(1).select(F.inline(F.array(*entries)))
    known = latest_snapshot_by_tier(scores, snapshots)
    age = F.datediff(F.to_date(as_of), "latest_snapshot")
    allowed = F.col("days") + rules.freshness_grace_days
    text = F.when(
        F.col("latest_snapshot").isNull(), F.concat(F.lit("No creators in tier "), "tier", F.lit(" yet"))
    ).otherwise(
        F.concat(
            F.lit("Tier "),
            "tier",
            F.lit(" most recent snapshot is "),
            age.cast("string"),
            F.lit("d old (SLA "),
            F.col("days").cast("string"),
            F.lit("d)"),
        )
    )
    return intervals.join(known, "tier", "left").select(
        F.concat(F.lit("tier_freshness_"), "tier").alias("name"),
        F.coalesce(age <= allowed, F.lit(True)).alias("passed"),
        age.cast("double").alias("measured"),
        allowed.cast("double").alias("allowed"),
        text.alias("message"),
    )


def all_checks(
    events: DataFrame,
    raw: DataFrame,
    queue: DataFrame,
    scores: DataFrame,
    snapshots: DataFrame,
    as_of: Column,
    rules: Rules,
    tiers_as_of: Column | None = None,
) -> DataFrame:
    tier_clock = as_of if tiers_as_of is None else tiers_as_of
    return (
        discovery_checks(events, as_of, rules)
        .unionByName(payload_checks(raw, as_of, rules))
        .unionByName(queue_checks(queue, rules))
        .unionByName(tier_checks(scores, snapshots, tier_clock, rules))
    )


def failed_checks(checks: DataFrame) -> DataFrame:
    """Failing checks by group, tier failures joined into one alarm; empty when all is well."""
    group = F.when(F.startswith("name", F.lit("tier_freshness_")), "tier_freshness").otherwise(F.col("name"))
    ordered = F.sort_array(F.collect_list(F.struct("name", "message")))
    return (
        checks.where(~F.col("passed"))
        .groupBy(group.alias("alarm"))
        .agg(F.array_join(F.transform(ordered, lambda entry: entry["message"]), "; ").alias("message"))
    )


def raise_on_failure(checks: DataFrame) -> None:
    """Fail the calling job when any check failed; at most one line per check reaches the driver."""
    alarms = failed_checks(checks).orderBy("alarm").collect()
    if alarms:
        raise RuntimeError("; ".join(f"[{row.alarm}] {row.message}" for row in alarms))


def with_silent_windows(counts: DataFrame, step: str) -> DataFrame:
    """Window counts with a zero row for every silent step between the first and last window.

    A windowed aggregate emits nothing for silence, which is what a freshness
    alarm has to see. The range is listed by day and each day's steps where
    the day lands, so a stray early or late time costs rows but not one task.
    """
    by = F.expr(f"INTERVAL {step}")
    ends = counts.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"))
    days = ends.select("lo", "hi", F.explode(F.sequence(F.date_trunc("day", "lo"), F.date_trunc("day", "hi"), F.expr("INTERVAL 1 DAY"))).alias("day"))
    # Steps count from the first window, so a day starts with the first step that falls into it.
    seconds = F.unix_seconds(F.timestamp_seconds(F.lit(0)) + by)
    late = F.greatest(F.lit(0), F.ceil((F.unix_seconds("day") - F.unix_seconds("lo")) / seconds))
    first = F.timestamp_seconds(F.unix_seconds("lo") + late * seconds)
    last = F.least("hi", F.timestamp_seconds(F.unix_seconds("day") + 86_399))
    spine = (
        days.repartition("day")
        .select(first.alias("first"), last.alias("last"))
        .where("first <= last")
        .select(F.explode(F.sequence("first", "last", by)).alias("window_start"))
    )
    return spine.join(counts, "window_start", "left").withColumn("n", F.coalesce("n", F.lit(0)))
