"""Engagement, growth, posting and account-type signals as Column expressions.

NULL means "cannot be measured" throughout and never turns into zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talentsift.rules import Rules


def _nonzero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def lifetime_engagement(likes: Column, videos: Column, followers: Column) -> Column:
    """Likes per video as a share of followers; NULL if any figure is missing or zero."""
    return _nonzero(likes).cast("double") / _nonzero(videos) / _nonzero(followers)


def interactions(likes: Column, comments: Column, shares: Column) -> Column:
    """Interactions of one video; a missing counter adds nothing."""
    return (
        F.coalesce(likes, F.lit(0)) + F.coalesce(comments, F.lit(0)) + F.coalesce(shares, F.lit(0))
    ).cast("bigint")


def recent_engagement(total: Column, videos: Column, followers: Column) -> Column:
    """Mean interactions per organic video over followers.

    Takes whole-number sums, so the result does not depend on the order in
    which partial aggregates meet.
    """
    return total.cast("double") / _nonzero(videos) / _nonzero(followers)


def growth(before: Column, before_date: Column, now: Column, now_date: Column, rules: Rules) -> Column:
    """Relative follower change scaled to a fixed period; NULL without a usable earlier count."""
    elapsed = F.datediff(now_date, before_date)
    days = F.when(elapsed > 0, elapsed)
    change = (_nonzero(now) - before).cast("double") / _nonzero(before)
    return change * (F.lit(float(rules.growth_days)) / days)


def in_posting_window(posted_on: Column, as_of: Column, rules: Rules) -> Column:
    """Both ends of the window count; a later date does not."""
    return F.datediff(as_of, posted_on).between(0, rules.posting_days)


def posting_rate(in_window: Column, dated: Column, rules: Rules) -> Column:
    """Videos per week in the window; NULL, not zero, when no video carries a date."""
    return F.when(dated > 0, in_window / F.lit(rules.posting_days / 7))


def _mentions(haystack: Column, needles: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(haystack, F.lit(needle))
    return F.coalesce(found, F.lit(False))


def account_type(bio: Column, bio_link: Column, is_commerce: Column, rules: Rules) -> Column:
    """``brand`` by platform flag, ``reseller`` by bio or link wording, else ``creator``."""
    sells = _mentions(F.lower(bio), rules.reseller_keywords) | _mentions(
        F.lower(bio_link), rules.storefront_domains
    )
    return F.when(F.coalesce(is_commerce, F.lit(False)), "brand").when(sells, "reseller").otherwise("creator")


def suspicious(growth_rate: Column, engagement_rate: Column, rules: Rules) -> Column:
    return F.coalesce(engagement_rate > rules.max_engagement, F.lit(False)) | F.coalesce(
        growth_rate > rules.max_growth, F.lit(False)
    )
