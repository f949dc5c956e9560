"""Counts that operators look at by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions.failures import is_quota_error
from talentsift.rules import ACTIVE, FAILED, Rules


def active_creators(creators: DataFrame) -> DataFrame:
    return creators.where(F.col("status") == ACTIVE)


def count_since(rows: DataFrame, moment: str, cutoff: Column) -> DataFrame:
    """One row even when nothing arrived: zero is the alarm."""
    return rows.where(F.col(moment) >= cutoff).agg(F.count(F.lit(1)).alias("n"))


def count_by(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def failure_rate(rows: DataFrame, status: str) -> DataFrame:
    """Failed and total rows with their ratio, NULL for an empty table."""
    return rows.agg(
        F.count_if(F.col(status) == FAILED).alias("failed"), F.count(F.lit(1)).alias("total")
    ).withColumn("rate", F.try_divide("failed", "total"))


def quota_errors(queue: DataFrame, rules: Rules) -> DataFrame:
    return queue.agg(F.count_if(is_quota_error(F.col("status"), F.col("error"), rules)).alias("n"))


def discovery_today(events: DataFrame, as_of: Column) -> DataFrame:
    return count_by(events.where(F.col("discovered_at") >= as_of), "source")


def outreach_listing(outreach: DataFrame) -> DataFrame:
    """Every outreach row, the latest push first."""
    return outreach.select("creator_id", "tier", "pushed_at", "status").orderBy(F.desc_nulls_last("pushed_at"), "creator_id")


def operator_report(
    events: DataFrame, queue: DataFrame, raw: DataFrame, scores: DataFrame, outreach: DataFrame
) -> DataFrame:
    """The ad-hoc counts in one frame: ``(report, label, detail, n)``."""

    def section(report: str, rows: DataFrame, label: str, detail: str | None = None) -> DataFrame:
        keys = [label, detail] if detail else [label]
        return count_by(rows, *keys).select(
            F.lit(report).alias("report"),
            F.col(label).alias("label"),
            (F.col(detail) if detail else F.lit(None).cast("string")).alias("detail"),
            "n",
        )

    return (
        section("discovery", events, "source", "query")
        .unionByName(section("queue", queue, "status"))
        .unionByName(section("fetch_errors", queue.where(F.col("status") == FAILED), "error"))
        .unionByName(section("payloads", raw, "parse_status"))
        .unionByName(section("scores", scores, "tier"))
        .unionByName(section("outreach", outreach, "status"))
    )
