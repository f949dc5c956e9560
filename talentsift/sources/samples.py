"""The sample tables read as domain frames.

The samples are a retail schema with an event log. Each function below is a
projection or a join on unique keys that gives one domain frame its columns
and its awkward cases: ties, NULLs, loose JSON types, broken payloads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift.functions.failures import HTTP, TIMEOUT
from talentsift.rules import HASHTAG_SOURCE, HTTP_LABELS, PLATFORM, Rules

EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-01 00:00:00"

# The samples hold no storefront wording and at most 99 "fans", and a customer
# has too few orders for a limit of 30 to bind.
SAMPLE_RULES = Rules(reseller_keywords=("low",), storefront_domains=("example.net",), recent_videos=5)
SEARCH_RULES = Rules(min_followers=50)
BIO_RULES = Rules(reseller_keywords=("track(1",), storefront_domains=("example.net",))


def _digit(priority: str = "o_orderpriority") -> Column:
    return F.substring(priority, 1, 1).cast("int")


def _json(**members: Column) -> Column:
    """JSON object text from members that are JSON text; NULL members are left out."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _number(value: Column) -> Column:
    return value.cast("string")


@dataclass(frozen=True)
class Samples:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Creators and their history, from customers, orders and order lines

    def creators(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("creator_id"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "instagram").otherwise(PLATFORM).alias("platform"),
            F.col("c_custkey").cast("string").alias("external_id"),
            F.when(F.col("c_acctbal") >= 0, "active").otherwise("inactive").alias("status"),
        )

    def profile_snapshots(self) -> DataFrame:
        """One snapshot per order; its lines give the counters and the commerce flag."""
        lines = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.sum(F.col("l_quantity").cast("bigint") * F.col("l_linenumber") * 20).alias("lifetime_likes"),
                F.count(F.lit(1)).alias("video_count"),
                (F.count_if(F.col("l_returnflag") == "R") >= 3).alias("is_commerce_account"),
            )
        )
        partial = F.col("o_orderstatus") == "P"
        return (
            self.table("orders")
            .join(lines, "o_orderkey", "left")
            .select(
                F.col("o_orderkey").alias("snapshot_id"),
                F.col("o_custkey").alias("creator_id"),
                F.to_date("o_orderdate").alias("snapshot_date"),
                F.col("o_orderdate").cast("timestamp").alias("created_at"),
                F.concat(
                    F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")
                ).alias("handle"),
                F.floor(F.col("o_totalprice") / 10).alias("follower_count"),
                "lifetime_likes",
                "video_count",
                F.col("o_orderpriority").alias("bio"),
                F.lit(None).cast("string").alias("bio_link"),
                "is_commerce_account",
                F.when(partial & _digit().isin(1, 2), "no_data")
                .when(partial & (_digit() == 3), "fetch_failed")
                .otherwise("success")
                .alias("scrape_status"),
            )
        )

    def videos(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("video_id"),
            F.col("o_custkey").alias("creator_id"),
            F.when(_digit() != 5, F.col("o_orderdate").cast("timestamp")).alias("posted_at"),
            (_digit() == 1).alias("is_ad"),
        )

    def video_snapshots(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("video_id"),
            F.to_date("l_shipdate").alias("snapshot_date"),
            F.lit(None).cast("bigint").alias("play_count"),
            F.col("l_quantity").cast("bigint").alias("digg_count"),
            F.col("l_linenumber").cast("bigint").alias("comment_count"),
            F.when(F.col("l_returnflag") != "R", F.lit(1).cast("bigint")).alias("share_count"),
            "l_partkey",
            "l_suppkey",
            "l_extendedprice",
        )

    @staticmethod
    def video_snapshot_order() -> list[Column]:
        """Order lines have no single key; together these columns decide every tie."""
        return [
            F.desc("snapshot_date"),
            F.desc("comment_count"),
            F.desc("l_partkey"),
            F.desc("l_suppkey"),
            F.desc("l_extendedprice"),
            F.desc("digg_count"),
            F.desc_nulls_last("share_count"),
        ]

    def creator_scores(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("score_id"),
            F.col("o_custkey").alias("creator_id"),
            F.when(F.col("o_orderstatus") == "P", "v2").otherwise("v1").alias("score_version"),
            F.col("o_orderdate").cast("timestamp").alias("computed_at"),
            (F.col("o_totalprice") / 1e6).alias("engagement_rate"),
            F.when(_digit() == 1, "A")
            .when(_digit() == 2, "B")
            .when(_digit() == 3, "C")
            .when(_digit() == 4, "Reject")
            .otherwise("needs_review")
            .alias("tier"),
        )

    def outreach_queue(self) -> DataFrame:
        return (
            self.table("customer")
            .where(F.col("c_mktsegment") == "BUILDING")
            .select(F.col("c_custkey").alias("creator_id"), F.lit("pending").alias("status"))
        )

    # The fetch queue and its failures, from orders

    def ingestion_queue(self) -> DataFrame:
        failed = F.col("o_orderstatus") == "F"
        return self.table("orders").select(
            F.col("o_orderkey").alias("queue_id"),
            F.lit(PLATFORM).alias("platform"),
            F.col("o_custkey").cast("string").alias("external_id"),
            _digit().alias("priority"),
            F.when(failed, "failed")
            .when(F.col("o_orderstatus") == "O", "pending")
            .otherwise("done")
            .alias("status"),
            F.when(failed & (_digit() == 1), "HTTP 402 (quota exhausted)")
            .when(failed & (_digit() == 2), "HTTP 404")
            .when(failed & (_digit() == 3), "request timed out")
            .when(failed & (_digit() == 4), "Rate limit hit")
            .alias("error"),
            F.col("o_orderdate").cast("timestamp").alias("enqueued_at"),
        )

    def failure_log(self) -> DataFrame:
        """One raised failure per failed queue row."""
        return (
            self.table("orders")
            .where(F.col("o_orderstatus") == "F")
            .select(
                F.col("o_orderkey").alias("queue_id"),
                F.when(_digit().isin(1, 2, 4), HTTP)
                .when(_digit() == 3, TIMEOUT)
                .otherwise("other")
                .alias("kind"),
                F.when(
                    _digit() <= 2,
                    F.element_at(F.array(*[F.lit(code) for code, _ in HTTP_LABELS]), (F.col("o_orderkey") % 7 + 1).cast("int")),
                )
                .when(_digit() == 4, 418)
                .alias("status_code"),
                F.lit("ValueError").alias("error_type"),
                F.repeat(F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" refused; ")), 20)
                .alias("message"),
            )
        )

    def fetch_outcomes(self) -> DataFrame:
        """An outcome for each urgent queue row: done without an error text, or failed with one."""
        queue = self.ingestion_queue().where(F.col("priority") <= 2)
        return queue.select(
            "queue_id",
            F.when(F.col("priority") == 1, "done").otherwise("failed").alias("status"),
            F.when(F.col("priority") == 2, "HTTP 503").alias("error"),
        )

    # Search results and payloads, from events

    def events(self, rows: DataFrame | None = None) -> DataFrame:
        source = self.table("events") if rows is None else rows
        return source.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )

    def search_items(self, rows: DataFrame | None = None) -> DataFrame:
        """One search result per event, flattened or nested; every tenth has no follower count."""
        k, user = F.col("k"), F.col("user_id")
        name = _quoted(F.concat(F.lit("user_"), user.cast("string")))
        fans = F.when(k % 10 != 9, _number(k))
        flat = F.concat(
            F.lit("{"),
            F.concat_ws(
                ",",
                F.concat(F.lit('"authorMeta.id":'), _number(user)),
                F.concat(F.lit('"authorMeta.name":'), name),
                F.concat(F.lit('"authorMeta.fans":'), fans),
            ),
            F.lit("}"),
        )
        nested = _json(authorMeta=_json(id=_number(user), name=name, fans=fans))
        return self.events(rows).select(
            F.col("event_type").alias("query"),
            F.col("event_id").alias("pos"),
            F.col("ts").alias("discovered_at"),
            F.when(F.col("event_id") % 2 == 0, flat).otherwise(nested).alias("item"),
        )

    def discovery_events(self) -> DataFrame:
        return self.events().select(
            F.lit(PLATFORM).alias("platform"),
            F.col("user_id").cast("string").alias("external_id"),
            F.lit(HASHTAG_SOURCE).alias("source"),
            F.col("event_type").alias("query"),
            F.col("ts").alias("discovered_at"),
        )

    def pending_users(self) -> DataFrame:
        """Queue rows already pending: the busier users."""
        return (
            self.table("events")
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 66)
            .select(
                F.lit(PLATFORM).alias("platform"),
                F.col("user_id").cast("string").alias("external_id"),
                F.lit("pending").alias("status"),
            )
        )

    @staticmethod
    def _item(k: Column, user: Column) -> Column:
        """A search-result item whose fields take every loose type the readers must handle."""
        event = F.col("event_id")
        author = _json(
            id=_number(user),
            name=F.when(k % 10 == 0, "null").otherwise(_quoted(F.concat(F.lit("user_"), user.cast("string")))),
            verified=F.when(k % 4 == 0, "true")
            .when(k % 4 == 1, "false")
            .when(k % 4 == 2, '"false"')
            .otherwise("0"),
            privateAccount=F.when(k % 3 == 1, '""').when(k % 3 == 2, "[1]"),
            signature=_quoted(F.col("event_type")),
            bioLink=F.when(k % 2 == 1, "null").otherwise(
                _quoted(F.concat(F.lit("https://shop.example/"), user.cast("string")))
            ),
            commerceUserInfo=F.when(k % 5 == 0, '{"commerceUser":true}')
            .when(k % 5 == 1, "null")
            .otherwise('{"commerceUser":false}'),
            ttSeller=F.when(k % 7 == 0, "1").otherwise("false"),
            fans=F.when(k % 3 == 0, _number(k * 100))
            .when(k % 3 == 1, _quoted(k * 100))
            .otherwise('"n/a"'),
            following=F.concat(_number(k), F.lit(".7")),
            heart=_number(k * 100000),
            video=F.when(k % 6 == 0, "true").otherwise(_number(k)),
        )
        stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        return _json(
            id=F.when(k % 11 != 0, _quoted(F.concat(F.lit("v"), event.cast("string")))),
            createTimeISO=F.when(k % 13 == 0, '"junk"').otherwise(_quoted(stamp)),
            isAd=F.when(F.col("event_type") == "click", "true").otherwise("false"),
            textLanguage=F.lit('"en"'),
            webVideoUrl=_quoted(F.concat(F.lit("https://v.example/"), event.cast("string"))),
            authorMeta=author,
            diggCount=_number(k),
            shareCount=_quoted(k),
            playCount=_number(F.col("value")),
            collectCount=F.lit("null"),
            commentCount=F.when(k % 2 == 0, _number(k * 2)),
        )

    @staticmethod
    def _repeated_video(k: Column, user: Column) -> Column:
        """A video that later fetches of the same user list again."""
        return _json(
            id=_quoted(F.concat(F.lit("u"), user.cast("string"), F.lit("_"), (k % 10).cast("string"))),
            isAd=F.when(F.col("event_type") == "purchase", "true").otherwise("false"),
            authorMeta=_json(id=_number(user)),
            diggCount=_number(F.col("event_id")),
        )

    def raw_payloads(self, rows: DataFrame | None = None) -> DataFrame:
        """One payload per event: soft failures, three kinds of malformed ones, items and fetches."""
        k, user, case = F.col("k"), F.col("user_id"), F.col("event_id") % 20
        item = self._item(k, user)
        fetch = F.concat(
            F.lit('{"profile_item":'),
            F.col("item"),
            F.lit(',"video_items":['),
            F.col("item"),
            F.lit(","),
            self._repeated_video(k, user),
            F.lit("]}"),
        )
        is_search = (F.col("event_type") == "view") & (case > 3)
        return self.events(rows).withColumn("item", item).select(
            F.col("event_id").alias("raw_id"),
            F.lit(PLATFORM).alias("platform"),
            F.when(is_search, "hashtag").otherwise("profile").alias("source_type"),
            user.cast("string").alias("external_id"),
            F.when(F.col("event_id") % 40 == 0, '{"ok":false,"reason":"no_data"}')
            .when(case == 0, '{"ok":false}')
            .when(case == 1, '{"profile_item":{"id":"x"},"video_items":[]}')
            .when(case == 2, '{"video_items":[]}')
            .when(case == 3, '{"broken')
            .when(is_search, F.col("item"))
            .otherwise(fetch)
            .alias("payload"),
            F.col("ts").alias("fetched_at"),
            F.when(case.isin(1, 2, 3), "failed")
            .when(case.isin(5, 10), "pending")
            .otherwise("parsed")
            .alias("parse_status"),
        )

    def fetch_requests(self) -> DataFrame:
        """Four consecutive events make one request, on behalf of the lowest user id among them."""
        return (
            self.table("events")
            .groupBy(F.floor(F.col("event_id") / 4).alias("request_id"))
            .agg(F.min("user_id").cast("string").alias("external_id"))
            .select("request_id", F.lit(PLATFORM).alias("platform"), "external_id")
        )

    def fetch_items(self) -> DataFrame:
        """Items returned for the requests: error and signup events return nothing."""
        return (
            self.table("events")
            .where(~F.col("event_type").isin("error", "signup"))
            .select(
                F.floor(F.col("event_id") / 4).alias("request_id"),
                (F.col("event_id") % 4).alias("pos"),
                _json(id=_number(F.col("event_id")), note=_quoted(F.col("event_type"))).alias("item"),
            )
        )

    def user_items(self) -> DataFrame:
        """What a fetch of a user returns: an item for each of their events but errors and signups."""
        return (
            self.table("events")
            .where(~F.col("event_type").isin("error", "signup"))
            .select(
                F.col("user_id").cast("string").alias("external_id"),
                F.col("event_id").alias("pos"),
                _json(id=_number(F.col("event_id")), note=_quoted(F.col("event_type"))).alias("item"),
            )
        )

    def raised_fetches(self) -> DataFrame:
        """Fetches that raise: those of every fifth queue row find the service unavailable."""
        return self.table("orders").where(F.col("o_orderkey") % 5 == 0).select(
            F.col("o_orderkey").alias("request_id"),
            F.lit(HTTP).alias("kind"),
            F.lit(503).alias("status_code"),
            F.lit(None).cast("string").alias("error_type"),
            F.lit(None).cast("string").alias("message"),
        )

    # Bios, from web pages

    def bios(self) -> DataFrame:
        return self.table("pages").select(
            "page_id", F.col("html").alias("bio"), F.col("url").alias("bio_link"), F.lit(False).alias("sells")
        )
