"""Landed payloads to profile rows, video rows and quarantined errors.

Shapes are declared per source type; what an item means is declared once for
all of them. Payloads stay text between the steps, and each step reads only
the fields it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.functions import variant as V
from talentsift.rules import (
    FAILED,
    FETCH_FAILED,
    MISSING_AUTHOR,
    MISSING_PROFILE,
    NOT_AN_OBJECT,
    PARSED,
    PLATFORM,
)

FAILED_FETCH = "failed_fetch"


# Item fields as they are read. Counts, identifiers and flags stay VARIANT because the
# lenient cast and emptiness depend on the JSON type.
_COUNTS = ("playCount", "diggCount", "commentCount", "shareCount", "collectCount")
_AUTHOR_COUNTS = ("fans", "following", "heart", "video")
AUTHOR = f"""struct<
    id: variant, name: string, verified: variant, privateAccount: variant, signature: string,
    bioLink: string, commerceUserInfo: struct<commerceUser: variant>, ttSeller: variant,
    {", ".join(f"{name}: variant" for name in _AUTHOR_COUNTS)}>"""
PROFILE = f"struct<authorMeta: {AUTHOR}>"
VIDEO = f"""struct<
    id: variant, createTimeISO: string, isAd: variant, textLanguage: string, webVideoUrl: string,
    {", ".join(f"{name}: variant" for name in _COUNTS)}, authorMeta: struct<id: string>>"""
AUTHOR_ID = "authorMeta: struct<id: variant>"


@dataclass(frozen=True)
class Shape:
    """How a source type lays out its payload.

    ``head`` names what the first look reads besides ``ok`` and ``reason``, and
    ``author`` finds the author id in it; both stay empty for a payload without
    a profile of its own. ``profile`` and ``videos`` read the payload text.
    """

    videos: Callable[[Column], Column]
    head: str | None = None
    author: Callable[[Column], Column] | None = None
    profile: Callable[[Column], Column] | None = None
    wraps_profile: bool = False


def _listed(payload: Column) -> Column:
    """The video list. A list with members that are no objects is read again without them."""
    shape = f"array<{VIDEO}>"
    return F.coalesce(
        V.read(payload, f"struct<video_items: {shape}>")["video_items"],
        V.typed(F.try_parse_json(payload), shape, "video_items"),
    )


# ``profile_page`` carries further videos of a fetch.
SHAPES: dict[str, Shape] = {
    "profile": Shape(
        videos=_listed,
        head=f"profile_item: struct<{AUTHOR_ID}>",
        author=lambda head: head["profile_item"]["authorMeta"]["id"],
        profile=lambda payload: V.read(payload, f"struct<profile_item: {PROFILE}>")["profile_item"],
        wraps_profile=True,
    ),
    "profile_page": Shape(videos=_listed),
    "hashtag": Shape(
        videos=lambda payload: F.array(V.read(payload, VIDEO)),
        head=AUTHOR_ID,
        author=lambda head: head["authorMeta"]["id"],
        profile=lambda payload: V.read(payload, PROFILE),
    ),
}


def profile_fields(item: Column) -> list[Column]:
    author_id = V.text(item["authorMeta"]["id"])
    return [F.lit(PLATFORM).alias("platform"), author_id.alias("external_id"), *profile_figures(item)]


def profile_figures(item: Column) -> list[Column]:
    """What a snapshot records of a profile."""
    author = item["authorMeta"]
    commerce = V.truthy(author["commerceUserInfo"]["commerceUser"]) | V.truthy(author["ttSeller"])
    return [
        F.coalesce(author["name"], F.lit("")).alias("handle"),
        V.integer(author["fans"]).alias("follower_count"),
        V.integer(author["following"]).alias("following_count"),
        V.integer(author["heart"]).alias("lifetime_likes"),
        V.integer(author["video"]).alias("video_count"),
        author["signature"].alias("bio"),
        author["bioLink"].alias("bio_link"),
        V.truthy(author["verified"]).alias("is_verified"),
        V.truthy(author["privateAccount"]).alias("is_private"),
        commerce.alias("is_commerce_account"),
    ]


def video_fields(item: Column) -> list[Column]:
    return [
        V.text(item["id"]).alias("video_id"),
        F.coalesce(item["authorMeta"]["id"], F.lit("")).alias("creator_external_id"),
        F.try_to_timestamp(item["createTimeISO"]).alias("posted_at"),
        V.truthy(item["isAd"]).alias("is_ad"),
        item["textLanguage"].alias("text_language"),
        item["webVideoUrl"].alias("web_video_url"),
        V.integer(item["playCount"]).alias("play_count"),
        V.integer(item["diggCount"]).alias("digg_count"),
        V.integer(item["commentCount"]).alias("comment_count"),
        V.integer(item["shareCount"]).alias("share_count"),
        V.integer(item["collectCount"]).alias("collect_count"),
    ]


_LANDING = ("raw_id", "platform", "external_id", "fetched_at")


def _by_shape(source_type: Column, cases: dict[str, Column]) -> Column:
    chain = F
    for name, value in cases.items():
        chain = chain.when(source_type == name, value)
    return chain.otherwise(F.lit(None))


def parse_payloads(raw: DataFrame, shapes: dict[str, Shape] = SHAPES) -> DataFrame:
    """The payloads with their ``outcome``, ``error`` and ``reason``.

    A soft failure is a recorded fact (``failed_fetch``), a shape the parser
    cannot read is an error (``failed``), and neither stops the batch. The
    first look reads a few fields; checks that walk a whole document run only
    for rows without a usable author.
    """
    payload, source_type = F.col("payload"), F.col("source_type")
    with_profile = {name: shape for name, shape in shapes.items() if shape.profile}
    wrapping = [name for name, shape in shapes.items() if shape.wraps_profile]
    heads = dict.fromkeys(shape.head for shape in with_profile.values())
    landed = ["raw_id", "platform", "source_type", "external_id", "fetched_at"]

    head_schema = f"struct<ok: variant, reason: string, {', '.join(heads)}>"
    looked_at = V.evaluate_once(raw, [*landed, "payload"], head=V.read(payload, head_schema))
    head = F.col("head")
    author_id = _by_shape(source_type, {name: shape.author(head) for name, shape in with_profile.items()})
    weighed = looked_at.select(
        *landed,
        "payload",
        V.is_false(head["ok"]).alias("soft"),
        V.truthy(author_id).alias("named"),
        head["reason"].alias("given_reason"),
    )
    soft, document = F.col("soft"), F.try_parse_json(payload)
    error = (
        F.when(soft | F.col("named"), F.lit(None))
        .when(~V.is_object(document), NOT_AN_OBJECT)
        .when(~source_type.isin(*with_profile), F.lit(None))
        .when(source_type.isin(*wrapping) & ~V.truthy(V.node(document, "profile_item")), MISSING_PROFILE)
        .otherwise(MISSING_AUTHOR)
    )
    judged = V.evaluate_once(
        weighed,
        [*landed, "payload"],
        soft_failure=soft,
        reason=F.when(soft, F.coalesce("given_reason", F.lit(FETCH_FAILED))),
        error=error,
    )
    outcome = (
        F.when(F.col("soft_failure"), FAILED_FETCH)
        .when(F.col("error").isNotNull(), FAILED)
        .otherwise(PARSED)
    )
    return judged.select(*landed, "payload", outcome.alias("outcome"), "error", "reason")


def _profile_item(shapes: dict[str, Shape]) -> tuple[Column, Column]:
    """Whether a payload carries a readable profile, and its profile item."""
    cases = {name: shape for name, shape in shapes.items() if shape.profile}
    item = _by_shape(
        F.col("source_type"), {name: shape.profile(F.col("payload")) for name, shape in cases.items()}
    )
    return (F.col("outcome") == PARSED) & F.col("source_type").isin(*cases), item


def profiles(parsed: DataFrame, shapes: dict[str, Shape] = SHAPES) -> DataFrame:
    """The profile of each parsed payload that carries one, keyed by its landing row."""
    readable, item = _profile_item(shapes)
    return parsed.where(readable).select("*", item.alias("item")).select(
        "raw_id",
        "fetched_at",
        F.col("platform").alias("landed_platform"),
        F.col("external_id").alias("landed_external_id"),
        *profile_fields(F.col("item")),
    )


def fetches(parsed: DataFrame, shapes: dict[str, Shape] = SHAPES) -> DataFrame:
    """Every fetch with its profile fields in one pass; a soft failure has its ``reason`` and none of them."""
    readable, item = _profile_item(shapes)
    missed = F.col("outcome") == FAILED_FETCH
    opened = parsed.where(readable | missed).select(
        *_LANDING, missed.alias("missed"), "reason", F.when(~missed, item).alias("item")
    )
    return opened.select(*_LANDING, "missed", "reason", *profile_figures(F.col("item")))


def _video_lists(parsed: DataFrame, shapes: dict[str, Shape]) -> DataFrame:
    listed = _by_shape(
        F.col("source_type"), {name: shape.videos(F.col("payload")) for name, shape in shapes.items()}
    )
    return V.evaluate_once(parsed.where(F.col("outcome") == PARSED), _LANDING, video_items=listed)


def videos(parsed: DataFrame, shapes: dict[str, Shape] = SHAPES) -> DataFrame:
    """Every video of every payload; an item without an id is skipped, an ad is kept."""
    listed = _video_lists(parsed, shapes).select(
        *_LANDING, F.posexplode("video_items").alias("pos", "item")
    )
    return listed.where(V.truthy(F.col("item.id"))).select(*_LANDING, "pos", *video_fields(F.col("item")))


def first_videos(parsed: DataFrame, shapes: dict[str, Shape] = SHAPES) -> DataFrame:
    """The leading video of each payload, when it has an id."""
    lead = _video_lists(parsed, shapes).select("raw_id", F.get("video_items", F.lit(0)).alias("item"))
    return lead.where(V.truthy(F.col("item.id"))).select("raw_id", *video_fields(F.col("item")))


def opened(parsed: DataFrame, shapes: dict[str, Shape] = SHAPES) -> DataFrame:
    """Everything that is read from a payload, in one row and without its text.

    ``profile`` is null without a readable profile, ``videos`` lists the items
    with an id and their places. All outputs of a batch are projections of
    these rows, so writing them once saves reading payloads once for each.
    """
    readable, item = _profile_item(shapes)
    listed = _by_shape(F.col("source_type"), {name: shape.videos(F.col("payload")) for name, shape in shapes.items()})
    kept = [*_LANDING, "outcome", "error", "reason"]
    looked_at = V.evaluate_once(
        parsed, kept, item=F.when(readable, item), items=F.when(F.col("outcome") == PARSED, listed)
    )
    numbered = F.transform(
        "items", lambda x, pos: F.struct(pos.alias("pos"), V.truthy(x["id"]).alias("named"), *video_fields(x))
    )
    return looked_at.select(
        *kept,
        F.when(F.col("item").isNotNull(), F.struct(*profile_figures(F.col("item")))).alias("profile"),
        F.filter(numbered, lambda video: video["named"]).alias("videos"),
    )


def opened_fetches(rows: DataFrame) -> DataFrame:
    """``fetches`` of opened payloads."""
    missed = F.col("outcome") == FAILED_FETCH
    told = rows.where(missed | F.col("profile").isNotNull())
    figures = [field.name for field in rows.schema["profile"].dataType.fields]
    flags = [name for name in figures if name.startswith("is_")]
    return told.select(*_LANDING, missed.alias("missed"), "reason", "profile.*").withColumns(
        {name: F.coalesce(name, F.lit(False)) for name in flags} | {"handle": F.coalesce("handle", F.lit(""))}
    )


def opened_videos(rows: DataFrame) -> DataFrame:
    """``videos`` of opened payloads."""
    listed = rows.where(F.col("outcome") == PARSED).select(*_LANDING, F.explode("videos").alias("video"))
    return listed.select(*_LANDING, "video.*").drop("named")


def errors(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("outcome") == FAILED).select(
        "raw_id", "error", F.col("fetched_at").alias("occurred_at")
    )


def parse_status(outcome: Column) -> Column:
    """Status that a payload ends up with: a soft failure has been dealt with too."""
    return F.when(outcome == FAILED, FAILED).otherwise(PARSED)


def handled(parsed: DataFrame) -> DataFrame:
    """Payloads that say something about their creator: parsed ones and soft failures."""
    return parsed.where(F.col("outcome") != FAILED)
