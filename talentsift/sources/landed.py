"""Landed JSON files as a source: one item a line, with lines that are no item set aside.

Files lie in one folder for each query, ``query=<text>``. A batch read and a
stream give the same rows; the place of an item is its file and its line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift.functions import variant as V

LINES = "value string, query string"


def _items(lines: DataFrame) -> DataFrame:
    document = F.try_parse_json("value")
    kept = ["query", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"]
    return V.evaluate_once(lines.select(*kept), ["query", "file", "block", "value"], document=document, valid=V.is_object(document))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """``query, file, block, value, document, valid`` of every line of the landed files.

    ``document`` is the item as a VARIANT; ``valid`` is false for a line that
    is broken JSON or no object, whose text stays in ``value``. Empty lines
    count as broken.
    """
    return _items(spark.read.option("basePath", path).schema(LINES).text(path))


def stream_items(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """``read_items`` of files as they land."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("basePath", path)
    return _items(reader.schema(LINES).text(path))


def corrupt(items: DataFrame, as_of: Column) -> DataFrame:
    """Lines to quarantine, with where they were found."""
    return items.where(~F.col("valid")).select("query", "file", F.col("value").alias("line"), as_of.alias("occurred_at"))


def search_items(items: DataFrame, pos: Column) -> DataFrame:
    """Valid items as ``(query, pos, item)``, as discovery takes them; ``pos`` orders the items of a query."""
    return items.where("valid").select("query", pos.alias("pos"), F.col("value").alias("item"))
