"""Line deduplication by frequency relative to a site.

For every host, the pages that contain a line are divided by the pages of the
host, and lines above the ratio are dropped from all pages of that host. Lines
are made distinct within a page before they are counted, so counting is one
sum that combines before its shuffle; a hot host or line costs no more than
others. A host has fewer boilerplate lines than its mean lines per page over
the ratio, since their counts share its line slots, so the set kept per host
is bounded. That set is copied to ``SALTS`` parts of the host, and pages go to
a part by hash, so the pages of a hot host spread over as many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCRIPTS = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BLOCKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre"
    r"|section|table|tbody|td|th|thead|title|tr|ul)(?:\s[^>]*|/)?>"
)
TAGS = r"<[^>]+>"
SALTS = 64
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


def page_text(html: Column) -> Column:
    """Text of a page with one line for each block; scripts, styles and comments are left out."""
    text = F.regexp_replace(html, SCRIPTS, "")
    return F.regexp_replace(F.regexp_replace(text, BLOCKS, "\n"), TAGS, "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def _key(line: Column) -> Column:
    """What makes lines equal: their text without surrounding blanks, as 128 bits."""
    return F.md5(F.trim(line).cast("binary"))


def drop_boilerplate(
    pages: DataFrame, *, host: str = "host", text: str = "text", ratio: float = 0.1, min_pages: int = 5, copies_count: bool = True
) -> DataFrame:
    """The same rows with boilerplate lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``.

    A line goes when more than ``ratio`` of the host's pages and at least
    ``min_pages`` of them contain it. Blank lines never go. A null host is the
    empty host; a null text stays null with no lines. Rows that repeat are
    pages of their own, unless ``copies_count`` is off: then pages of a host
    with equal texts count once, so that a text copied often keeps its lines.
    Columns of other names pass through.
    """
    body = F.col(text)
    lines = F.split(body, "\n", -1)
    site = F.coalesce(F.col(host).cast("string"), F.lit(""))
    row = F.struct(*pages.columns)
    keyed = pages.select(row.alias("row"), site.alias("site"), F.pmod(F.xxhash64(row), F.lit(SALTS)).alias("part"))
    keys = F.array_distinct(F.transform(F.filter(lines, lambda x: F.trim(x) != ""), _key))
    number = F.count("*") if copies_count else F.count_distinct("copy")
    known = pages.select(site.alias("site"), *([] if copies_count else [F.xxhash64(body).alias("copy")]), keys.alias("keys"))
    totals = known.groupBy("site").agg(number.alias("pages"))
    counts = known.withColumn("line", F.explode("keys")).groupBy("site", "line").agg(number.alias("holding"))
    boilerplate = (
        counts.where(F.col("holding") >= min_pages)
        .join(totals, "site")
        .where(F.col("holding") > F.col("pages") * F.lit(ratio))
        .groupBy("site")
        .agg(F.collect_set("line").alias("drop"))
        .select("site", "drop", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("part"))
    )
    drop = F.coalesce("drop", F.array().cast("array<string>"))
    kept = F.when(F.size(drop) == 0, F.col("lines")).otherwise(
        F.filter("lines", lambda x: (F.trim(x) == "") | ~F.array_contains(drop, _key(x)))
    )
    return (
        keyed.join(boilerplate, ["site", "part"], "left")
        .select("row", "drop", F.split(F.col("row")[text], "\n", -1).alias("lines"))
        .select("row", "lines", kept.alias("kept"))
        .select(
            *[F.col("row")[c].alias(c) for c in pages.columns if c not in (text, "n_lines", "n_dropped")],
            F.when(F.col("lines").isNotNull(), F.array_join("kept", "\n")).alias(text),
            F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
