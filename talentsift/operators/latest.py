"""Latest rows per key.

``row_number() <= n`` over a total order plans as a partial group limit on the
map side, so a key that owns a third of the table sends at most ``n`` rows per
map task into the shuffle. No joins back to the table, no collected groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_n(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_as: str | None = None
) -> DataFrame:
    """The first ``n`` rows per key in ``order``, which must be total to be repeatable."""
    window = W.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n)
    return ranked.withColumnRenamed(_RANK, rank_as) if rank_as else ranked.drop(_RANK)


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return latest_n(rows, keys, order, 1)


def latest_with_previous(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """The latest row per key, with ``columns`` of the row before it as ``previous_*``.

    The look-back window repeats the ranking window, so it needs no second
    shuffle or sort.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    pair = latest_n(rows, keys, order, 2, rank_as=_RANK)
    for column in columns:
        pair = pair.withColumn(f"previous_{column}", F.lead(column).over(window))
    return pair.where(F.col(_RANK) == 1).drop(_RANK)


def latest_with_ties(rows: DataFrame, keys: Sequence[str], moment: str) -> DataFrame:
    """Every row that shares its key's greatest ``moment``.

    The maximum is a hash aggregate with map-side combine. Joining it back
    keeps ties of any number spread over tasks: AQE broadcasts the maxima when
    they measure small and splits a hot key's partition otherwise.
    """
    newest = rows.groupBy(*keys).agg(F.max(moment).alias(moment))
    return rows.join(newest, [*keys, moment], "left_semi")


def score_order() -> list[Column]:
    return [F.desc_nulls_last("computed_at"), F.desc("score_id")]


def snapshot_order() -> list[Column]:
    """Days are too coarse to order snapshots, so creation time and id decide within a day."""
    return [F.desc_nulls_last("snapshot_date"), F.desc_nulls_last("created_at"), F.desc("snapshot_id")]


def video_order() -> list[Column]:
    """Undated videos come first, as in a descending SQL sort that puts NULLs high."""
    return [F.desc_nulls_first("posted_at"), F.desc("video_id")]
