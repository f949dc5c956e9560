"""Connected components by alternating star operations, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import forget, stored


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link ``a, b``; the component is its smallest node.

    Large-star hangs every larger neighbour under the smallest one and
    small-star the node and its smaller neighbours; after a number of rounds
    that grows with the logarithm of the longest chain only stars remain. Each
    round is stored, so the plan does not grow. Minima combine before their
    shuffle, and the joins of a hub can be split.
    """
    current = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    mark = _fingerprint(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
        following = stored(small.distinct(), "links")
        forget(current)
        current, before, mark = following, mark, _fingerprint(following)
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
