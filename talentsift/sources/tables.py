"""Parquet reads and retry-safe writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A declared schema saves the footer scan that inference would run over every file."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def append_daily(rows: DataFrame, path: str, date_column: str, round_id: str) -> None:
    """Append one round to a history that is partitioned by round and date.

    A rerun of the round replaces what it wrote before. Rebalancing gives each
    date few files and lets AQE split a date that is too large for one writer.
    """
    spread = rows.hint("rebalance", date_column)
    spread.write.mode("overwrite").partitionBy(date_column).parquet(f"{path}/round={round_id}")


def write_batch(rows: DataFrame, path: str, batch_id: int, by: str | None = None) -> None:
    """Write one micro-batch under its own directory, split ``by`` a column; a rerun replaces what it wrote before."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(f"{path}/batch_id={batch_id}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, wherever the session's file systems keep it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All micro-batches of a table, with their ``batch_id``; empty when no batch has run."""
    full = f"{schema.strip()}, batch_id bigint"
    try:
        return spark.read.option("basePath", path).schema(full).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
