from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from talentsift.functions import signals as S
from talentsift.rules import Rules

RULES = Rules()


def evaluate(spark, schema: str, values: tuple, expression):
    return spark.createDataFrame([values], schema).select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    ("likes", "videos", "followers", "expected"),
    [
        (1_000_000, 100, 500_000, 0.02),
        (8_000_000, 200, 100_000, 0.4),
        (None, 100, 500_000, None),
        (0, 100, 500_000, None),
        (10, 0, 500_000, None),
        (10, 100, 0, None),
        (10, 100, None, None),
    ],
)
def test_lifetime_engagement(spark, likes, videos, followers, expected):
    rate = S.lifetime_engagement(F.col("l"), F.col("v"), F.col("f"))
    assert evaluate(spark, "l bigint, v bigint, f bigint", (likes, videos, followers), rate) == expected


@pytest.mark.parametrize(
    ("total", "videos", "followers", "expected"),
    [(115, 1, 1000, 0.115), (None, 0, 1000, None), (115, 1, 0, None), (0, 2, 10, 0.0)],
)
def test_recent_engagement(spark, total, videos, followers, expected):
    rate = S.recent_engagement(F.col("t"), F.col("v"), F.col("f"))
    assert evaluate(spark, "t bigint, v bigint, f bigint", (total, videos, followers), rate) == expected


@pytest.mark.parametrize(
    ("before", "before_date", "now", "now_date", "expected"),
    [
        (1000, date(2026, 1, 1), 1100, date(2026, 1, 16), pytest.approx(0.2)),
        (None, date(2026, 1, 1), 1100, date(2026, 1, 16), None),
        (1000, None, 1100, date(2026, 1, 16), None),
        (0, date(2026, 1, 1), 1100, date(2026, 1, 16), None),
        (1000, date(2026, 1, 1), 0, date(2026, 1, 16), None),
        (1000, date(2026, 1, 1), 1100, date(2026, 1, 1), None),
        (1000, date(2026, 1, 2), 1100, date(2026, 1, 1), None),
        (1000, date(2026, 1, 1), 900, date(2026, 1, 31), pytest.approx(-0.1)),
    ],
)
def test_growth(spark, before, before_date, now, now_date, expected):
    rate = S.growth(F.col("b"), F.col("bd"), F.col("n"), F.col("nd"), RULES)
    values = (before, before_date, now, now_date)
    assert evaluate(spark, "b bigint, bd date, n bigint, nd date", values, rate) == expected


def test_posting_rate_counts_both_ends_and_ignores_the_future(spark):
    days = [date(2026, 1, 31), date(2026, 1, 1), date(2025, 12, 31), date(2026, 2, 1)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    as_of = F.lit("2026-01-31").cast("date")
    counted = frame.agg(
        F.count_if(S.in_posting_window(F.col("d"), as_of, RULES)).alias("hits"), F.count("d").alias("dated")
    )
    assert counted.select(S.posting_rate(F.col("hits"), F.col("dated"), RULES)).first()[0] == 2 / (30 / 7)


def test_posting_rate_tells_silence_from_missing_dates(spark):
    rate = S.posting_rate(F.col("hits"), F.col("dated"), RULES)
    assert evaluate(spark, "hits bigint, dated bigint", (0, 3), rate) == 0.0
    assert evaluate(spark, "hits bigint, dated bigint", (0, 0), rate) is None


@pytest.mark.parametrize(
    ("bio", "link", "commerce", "expected"),
    [
        ("My Store opens on Monday", "https://goods.shopify.example/a", False, "reseller"),
        ("notes on birds", None, False, "creator"),
        ("not a shop at all", None, False, "reseller"),
        ("weekend workshops", None, None, "reseller"),
        ("plain", "HTTPS://LINKTR.EE/SHOP?x=1", False, "reseller"),
        ("shop", None, True, "brand"),
        (None, None, False, "creator"),
        (None, "https://etsy.com/listing/7", False, "reseller"),
    ],
)
def test_account_type(spark, bio, link, commerce, expected):
    kind = S.account_type(F.col("b"), F.col("l"), F.col("c"), RULES)
    assert evaluate(spark, "b string, l string, c boolean", (bio, link, commerce), kind) == expected


@pytest.mark.parametrize(
    ("growth", "engagement", "expected"),
    [(None, None, False), (1.0, 0.25, False), (1.01, None, True), (None, 0.251, True), (0.1, 0.1, False)],
)
def test_suspicion_is_strict_and_null_safe(spark, growth, engagement, expected):
    hit = S.suspicious(F.col("g"), F.col("e"), RULES)
    assert evaluate(spark, "g double, e double", (growth, engagement), hit) is expected
