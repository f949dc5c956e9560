"""Search results to candidates, per source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions import variant as V
from talentsift.operators.dedup import first_per_key
from talentsift.rules import HASHTAG_SOURCE, NEW_CANDIDATE, PLATFORM, Rules

DiscoverySource = Callable[[DataFrame, Rules], DataFrame]
SOURCES: dict[str, DiscoverySource] = {}


def discovery_source(name: str) -> Callable[[DiscoverySource], DiscoverySource]:
    """Register a function from landed items to candidate rows under a source name."""

    def register(source: DiscoverySource) -> DiscoverySource:
        SOURCES[name] = source
        return source

    return register


AUTHOR_REF = V.dual_schema("authorMeta", "id", "name", "fans")


def author_sightings(items: DataFrame, keep: Sequence[str] = ("query", "pos")) -> DataFrame:
    """One row per item ``(query, pos, item)`` that names an author, in either payload shape."""
    opened = V.evaluate_once(items, keep, doc=V.read(F.col("item"), AUTHOR_REF))

    def author(leaf: str) -> Column:
        return V.dual_shape(F.col("doc"), "authorMeta", leaf)

    fields = opened.select(
        *keep, author("id").alias("id"), author("name").alias("name"), author("fans").alias("fans")
    )
    named = V.evaluate_once(
        fields,
        keep,
        external_id=F.when(V.truthy(F.col("id")), V.text(F.col("id"))),
        handle=F.when(V.truthy(F.col("name")), V.text(F.col("name"))).otherwise(F.lit("")),
        follower_count=V.integer(F.col("fans")),
    )
    return named.where(F.col("external_id").isNotNull())


def first_occurrences(items: DataFrame) -> DataFrame:
    """The first item of each author within a query; other queries count on their own."""
    return first_per_key(author_sightings(items), ["query", "external_id"], [F.asc("pos")])


def qualified(firsts: DataFrame, rules: Rules) -> DataFrame:
    """Candidates among first occurrences.

    The follower floor looks at the first occurrence only, so it must stay
    above the deduplication: a larger later count never rescues an author. An
    unknown count fails the floor; a floor of zero switches it off.
    """
    if rules.min_followers:
        firsts = firsts.where(F.col("follower_count") >= rules.min_followers)
    return firsts.select(
        F.lit(PLATFORM).alias("platform"),
        "external_id",
        "handle",
        F.lit(HASHTAG_SOURCE).alias("source"),
        "query",
        "pos",
    )


@discovery_source(HASHTAG_SOURCE)
def hashtag_candidates(items: DataFrame, rules: Rules) -> DataFrame:
    """Candidates of every query at once."""
    return qualified(first_occurrences(items), rules)


def discover(source: str, items: DataFrame, rules: Rules) -> DataFrame:
    return SOURCES[source](items, rules)


def queue_candidates(candidates: DataFrame, rules: Rules) -> DataFrame:
    """Candidates as queue rows that have yet to pass the pending check, with what orders them."""
    return candidates.select(
        "platform",
        "external_id",
        "handle",
        F.lit(NEW_CANDIDATE).alias("reason"),
        F.lit(rules.candidate_priority).alias("priority"),
        "query",
        "pos",
    )
