"""Fetched items to landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.rules import NO_DATA, Rules


def fetch_envelopes(requests: DataFrame, items: DataFrame, rules: Rules) -> DataFrame:
    """Payload rows for ``requests (request_id, platform, external_id)``.

    ``items (request_id, pos, item)`` holds the response items as JSON text and
    their position, counted from the first one that arrived, so every response
    with items has a first page. A response fits one page of ``items_per_fetch``; a
    longer one continues in ``profile_page`` payloads of the same size, so no
    row grows with the response. No items at all is a soft failure.
    """
    first = items.groupBy("request_id").agg(F.min("pos").alias("first_pos"))
    paged = items.join(first, "request_id").select(
        "request_id",
        F.floor((F.col("pos") - F.col("first_pos")) / rules.items_per_fetch).cast("int").alias("page"),
        F.struct("pos", "item").alias("entry"),
    )
    pages = paged.groupBy("request_id", "page").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    listed = F.concat(F.lit("["), F.array_join(F.col("entries.item"), ","), F.lit("]"))
    first_item = F.get(F.col("entries.item"), F.lit(0))
    payload = (
        F.when(F.col("page").isNull(), F.lit(f'{{"ok":false,"reason":"{NO_DATA}"}}'))
        .when(
            F.col("page") == 0,
            F.concat(F.lit('{"profile_item":'), first_item, F.lit(',"video_items":'), listed, F.lit("}")),
        )
        .otherwise(F.concat(F.lit('{"video_items":'), listed, F.lit("}")))
    )
    return requests.join(pages, "request_id", "left").select(
        "request_id",
        "platform",
        "external_id",
        F.coalesce("page", F.lit(0)).alias("page"),
        F.when(F.col("page") > 0, "profile_page").otherwise("profile").alias("source_type"),
        payload.alias("payload"),
    )
