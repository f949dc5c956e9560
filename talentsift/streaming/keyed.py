"""Streaming jobs that keep state per key: growth of changed creators, and silence noticed while nothing arrives.

These are the only Python functions of the catalog part; Spark has no built-in
expression over kept state. Rows are reduced to a few per key and Arrow batch
before the shuffle, so a key with a third of all rows sends few of them. State
holds two rows or one number a key, lives in RocksDB and is recovered from the
stream's checkpoint. Times travel as whole numbers, so no time zone of a Python
worker takes part. Processors are made inside functions, which sends them to
workers by value: a worker needs no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from talentsift.functions import signals as S
from talentsift.operators.latest import latest
from talentsift.rules import Rules
from talentsift.sources.tables import read_batches, write_batch
from talentsift.streaming.jobs import drain

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that keeps state in RocksDB, which keyed state needs; ``spark`` stays as it is.

    Open the streams of this module with it.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set(_PROVIDER, _ROCKSDB)
    return session


_SNAPSHOT = "snapshot_id bigint, day int, created bigint, follower_count bigint"


def _two_newest_per_batch() -> Callable:
    """The two newest snapshots of each creator in an Arrow batch, in the order of ``snapshot_order``."""

    def reduce(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        order = [("creator_id", "ascending"), *[(c, "descending") for c in ("day", "created", "snapshot_id")]]
        for batch in batches:
            ordered = batch.take(pc.sort_indices(batch, sort_keys=order, null_placement="at_end"))
            creators = pc.dictionary_encode(ordered.column("creator_id"), null_encoding="encode").indices.to_numpy()
            keep = [True, True, *(creators[2:] != creators[:-2])][: len(creators)]
            yield ordered.filter(pa.array(keep, pa.bool_()))

    return reduce


def _newest_two() -> StatefulProcessor:
    def newness(row: tuple) -> tuple:
        return tuple((value is not None, value or 0) for value in (row[1], row[2], row[0]))

    class NewestTwo(StatefulProcessor):
        """Keeps a creator's two newest snapshots and reports the pair when rows changed it."""

        def init(self, handle):
            self.newest = handle.getListState("newest", _SNAPSHOT)

        def handleInputRows(self, key, rows, timerValues):
            from pyspark.sql import Row

            before = sorted((tuple(row) for row in self.newest.get()), key=newness, reverse=True)
            kept = before
            for row in rows:
                arrived = (row.snapshot_id, row.day, row.created, row.follower_count)
                kept = sorted([*kept, arrived], key=newness, reverse=True)[:2]
            if kept != before:
                self.newest.put(kept)
                last, previous = kept[0], (kept[1] if len(kept) > 1 else (None,) * 4)
                yield Row(
                    creator_id=key[0],
                    day=last[1],
                    follower_count=last[3],
                    previous_day=previous[1],
                    previous_follower_count=previous[3],
                )

        def close(self):
            pass

    return NewestTwo()


_CHANGE = "creator_id bigint, snapshot_date date, growth_rate double"


def changed_growth(snapshots: DataFrame, folder: str, rules: Rules) -> None:
    """Growth from a snapshot stream: each batch writes the creators whose two newest snapshots it changed.

    An older snapshot that arrives late changes a creator only if it becomes
    the second newest. Equal rows count as often as they arrive, as in a table.
    Creators without an id are one creator. A row per change stays below
    ``folder``; ``current_growth`` reads the last one of each creator.
    """
    path = f"{folder}/growth_changes"
    narrow = snapshots.select(
        F.col("creator_id").cast("long").alias("creator_id"),
        F.col("snapshot_id").cast("long").alias("snapshot_id"),
        F.unix_date("snapshot_date").alias("day"),
        F.unix_micros("created_at").alias("created"),
        F.col("follower_count").cast("long").alias("follower_count"),
    )
    pairs = (
        narrow.mapInArrow(_two_newest_per_batch(), narrow.schema)
        .groupBy("creator_id")
        .transformWithState(
            _newest_two(),
            "creator_id bigint, day int, follower_count bigint, previous_day int, previous_follower_count bigint",
            "Update",
            "None",
        )
    )
    day, previous_day = F.date_from_unix_date("day"), F.date_from_unix_date("previous_day")
    growth = S.growth(F.col("previous_follower_count"), previous_day, F.col("follower_count"), day, rules)
    changes = pairs.select("creator_id", day.alias("snapshot_date"), growth.alias("growth_rate"))
    drain(changes, folder, lambda batch, batch_id: write_batch(batch, path, batch_id), mode="update")


def current_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Growth of every creator so far: the last change of each."""
    changes = read_batches(spark, f"{folder}/growth_changes", _CHANGE)
    return latest(changes, ["creator_id"], [F.desc("batch_id")]).drop("batch_id")


def _one_per_batch() -> Callable:
    """One row for each name in an Arrow batch."""

    def reduce(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("name").unique()], schema=batch.schema)

    return reduce


def _silence(step_ms: int) -> StatefulProcessor:
    class Silence(StatefulProcessor):
        """One timer a name, at the end of the first window that is wholly without arrivals so far."""

        def init(self, handle):
            self.handle = handle
            self.due = handle.getValueState("due", "at bigint")

        def _wait_until(self, at):
            self.handle.registerTimer(at)
            self.due.update((at,))

        def handleInputRows(self, key, rows, timerValues):
            for _ in rows:
                pass
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            now = timerValues.getCurrentProcessingTimeInMs()
            self._wait_until(now - now % step_ms + 2 * step_ms)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            from pyspark.sql import Row

            # A stream that was down wakes up late: all windows that ended meanwhile were silent as well.
            end, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentProcessingTimeInMs()
            while end <= now:
                yield Row(name=key[0], window_ms=end - step_ms, n=0)
                end += step_ms
            self._wait_until(end)

        def close(self):
            pass

    return Silence()


_SILENT = "name string, window_start timestamp, n bigint"


def watch_silence(arrivals: DataFrame, folder: str, step_seconds: int, trigger: str) -> StreamingQuery:
    """A running stream that writes a zero row for every window of arrival time in which a ``name`` sent nothing.

    The row is written when the window ends, with no need of later rows. A name
    is watched from its first arrival on; a null name is a name. The caller
    stops the query. Windows are aligned to whole steps since 1970.
    """
    path = f"{folder}/silent_windows"
    names = arrivals.select(F.col("name").cast("string").alias("name"))
    alarms = (
        names.mapInArrow(_one_per_batch(), names.schema)
        .groupBy("name")
        .transformWithState(
            _silence(step_seconds * 1000), "name string, window_ms bigint, n bigint", "Update", "ProcessingTime"
        )
    )
    rows = alarms.select("name", F.timestamp_millis("window_ms").alias("window_start"), "n")
    return (
        rows.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime=trigger)
        .start()
    )


def silent_windows(spark: SparkSession, folder: str) -> DataFrame:
    return read_batches(spark, f"{folder}/silent_windows", _SILENT).drop("batch_id")
