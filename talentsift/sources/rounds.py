"""Tables that grow by rounds, each of which becomes visible as a whole.

A round writes its rows of every table under an attempt of its own and is
published by one row, its marker, written last. Readers join a table with the
markers, so rows of a round that ended between two writes, or of an attempt
that a rerun has replaced, are never seen. The join is on partition columns:
files of other attempts are not opened. The marker keeps how many rows the
writes have seen, so totals cost no second run of any job.

A table may be clustered into buckets. Two tables with the same buckets join
without moving rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKERS = "attempt string, as_of timestamp, rows map<string, bigint>, round string"
PARTITIONS = "round string, attempt string"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Table:
    """Columns as DDL, a date column to partition by, and a column to cluster by.

    Clustering is by one key, so that two tables with equal ``buckets`` match.
    """

    schema: str
    day: str | None = None
    bucketed_by: str | None = None
    buckets: int = 64

    @property
    def columns(self) -> list[T.StructField]:
        return T.StructType.fromDDL(self.schema).fields


def _counted(seen: Observation) -> int:
    """Rows that a finished write has passed on. A plan that is known to be empty runs without counting."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as problem:
        if "AssertionError" not in problem.java_exception.getClass().getName():
            raise
        return 0


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """A task that meets a few days or buckets keeps a file open for each, instead of sorting whole rows by them first."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, "8")
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


class Round:
    """One attempt at a round; see ``RoundStore.round``."""

    def __init__(self, store: RoundStore, round_id: str, as_of: datetime):
        self.store, self.round_id, self.as_of = store, round_id, as_of
        self.attempt = uuid.uuid4().hex
        self.rows: dict[str, int] = {}

    @property
    def stamp(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    def write(self, name: str, rows: DataFrame, in_place: bool = False) -> None:
        """Stage rows of a table, cast to its columns; they are invisible until the round is published.

        Rows ``in_place`` lie in the buckets of their table already.
        """
        table, seen = self.store.tables[name], Observation()
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.columns])
        counted = typed.observe(seen, F.count(F.lit(1)).alias("rows"))
        with _open_writers(self.store.spark):
            if table.bucketed_by:
                # One writer for each bucket, so that a round adds one file to it.
                clustered = counted if in_place else counted.repartition(table.buckets, table.bucketed_by)
                clustered.select("*", F.lit(self.round_id), F.lit(self.attempt)).write.mode("append").insertInto(self.store.name_of(name))
            else:
                # The rows of a round are of one day or of a few, so they stay where they are.
                writer = counted.write.partitionBy(table.day) if table.day else counted.write
                writer.parquet(f"{self.store.folder}/{name}/round={self.round_id}/attempt={self.attempt}")
        self.rows[name] = _counted(seen)

    def staged(self, name: str) -> DataFrame:
        """What this attempt has written of a table."""
        return self.store.everything(name).where((F.col("round") == self.round_id) & (F.col("attempt") == self.attempt)).drop("round", "attempt")

    def publish(self) -> None:
        counts = [x for name, n in self.rows.items() for x in (F.lit(name), F.lit(n).cast("long"))]
        counted = F.create_map(*counts) if counts else F.lit(None)
        marker = self.store.spark.range(1, numPartitions=1).select(
            F.lit(self.attempt).alias("attempt"), self.stamp.alias("as_of"), counted.cast("map<string, bigint>").alias("rows")
        )
        marker.write.mode("overwrite").parquet(f"{self.store.folder}/published/round={self.round_id}")


class RoundStore:
    """The tables of one folder. One writer at a time adds rounds; any number of readers may look on."""

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, Table]):
        self.spark, self.folder, self.tables = spark, folder.rstrip("/"), tables
        for name in ("published", *tables):
            self._make_folder(name)
        for name, table in tables.items():
            if table.bucketed_by and not spark.catalog.tableExists(self.name_of(name)):
                spark.sql(
                    f"CREATE TABLE {self.name_of(name)} ({table.schema}, {PARTITIONS}) USING parquet PARTITIONED BY (round, attempt) "
                    f"CLUSTERED BY ({table.bucketed_by}) INTO {table.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
                )
                spark.catalog.recoverPartitions(self.name_of(name))

    def _make_folder(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)

    def name_of(self, name: str) -> str:
        return f"{name}_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}"

    @contextmanager
    def round(self, round_id: str, as_of: datetime) -> Iterator[Round]:
        """Stage tables of a round inside the block; it is published when the block ends well.

        A round that exists is replaced: its new attempt shows up, and the old
        one disappears, with the one write of the marker.
        """
        if not re.fullmatch(r"[\w.-]+", round_id):
            raise ValueError(f"a round is named by letters, digits, dots and dashes: {round_id!r}")
        attempt = Round(self, round_id, as_of)
        yield attempt
        attempt.publish()

    def published(self, before: datetime | None = None) -> DataFrame:
        """Markers, of rounds with an earlier ``as_of`` only if ``before`` is given."""
        rows = self._read("published", MARKERS)
        return rows if before is None else rows.where(F.col("as_of") < F.lit(before).cast("timestamp"))

    def everything(self, name: str) -> DataFrame:
        """All rows of a table with their ``round`` and ``attempt``, published or not."""
        table = self.tables[name]
        if table.bucketed_by:
            return self.spark.table(self.name_of(name))
        return self._read(name, f"{table.schema.strip()}, {PARTITIONS}")

    def read(self, name: str, before: datetime | None = None, rounds: Sequence[str] | None = None) -> DataFrame:
        """Published rows of a table.

        A round reads with its own ``as_of`` as ``before``, so that a rerun
        starts from what its first attempt saw. ``rounds`` keeps those named.
        """
        rows = self.everything(name)
        if rounds is not None:
            rows = rows.where(F.col("round").isin(*rounds))
        visible = self.published(before).where("as_of is not null").select("round", "attempt")
        return rows.join(visible, ["round", "attempt"], "left_semi").select(*[f.name for f in self.tables[name].columns], "round")

    def totals(self, round_id: str) -> DataFrame:
        """Rows ``table, n`` that the published attempt of a round wrote."""
        marker = self.published().where(F.col("round") == round_id)
        return marker.select(F.explode("rows").alias("table", "n"))

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        return self.spark.read.option("basePath", path).schema(schema).parquet(path)
