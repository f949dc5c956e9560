"""Streaming jobs. The checkpoint replaces status polling; writes are keyed by batch id.

Each job takes a stream and a folder for its tables and checkpoint, runs with
the ``availableNow`` trigger and returns when the backlog is done. A batch
writes only what its own rows add, under its own directory, so a rerun
replaces its output and no batch rewrites state. Readers fold the batches by
key with operators whose result does not depend on the order in which rows
arrived; nothing is dropped for being late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift import schemas
from talentsift.functions import signals as S
from talentsift.operators import dedup, parsing
from talentsift.operators.discovery import first_occurrences, qualified, queue_candidates
from talentsift.operators.latest import latest_n, latest_with_previous, snapshot_order
from talentsift.operators.monitor import with_silent_windows
from talentsift.plans.discover import queue_rows
from talentsift.plans.enrich import enrich_opened
from talentsift.rules import Rules
from talentsift.sources.folded import FoldedIds
from talentsift.sources.tables import read_batches, write_batch

BatchWriter = Callable[[DataFrame, int], None]


FILES_PER_BATCH = 256


def open_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A file stream over one table, whether it is a single file or a directory of files.

    ``files_per_batch`` bounds a micro-batch, so a backlog is worked off in steps.
    """
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{table}.parque[t]")


def drain(stream: DataFrame, folder: str, write: BatchWriter, mode: str = "append") -> None:
    """Run the stream over everything available now."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


_SEEN = "platform string, external_id string, first_sighting timestamp, last_sighting timestamp"


def parse_landed(raw: DataFrame, folder: str, as_of: Column) -> None:
    """Payload stream to snapshots, new videos, quarantine and creator sightings; ``stored_creators`` folds the last.

    A batch reads its payloads once: parsed, failed and soft-failed rows leave
    in one write, split by outcome and without the text, and the tables follow
    from those rows. Ids of earlier videos are looked up where the batch's own
    ids can be.
    """
    spark = raw.sparkSession
    ids = FoldedIds(spark, f"{folder}/video_ids", "video_id")

    def write(batch: DataFrame, batch_id: int) -> None:
        ids.begin(batch_id)
        read = parsing.opened(parsing.parse_payloads(batch))
        write_batch(read, f"{folder}/opened_payloads", batch_id, by="outcome")
        schema = ", ".join(f"{name} {kind}" for name, kind in read.dtypes)
        opened = read_batches(spark, f"{folder}/opened_payloads", schema).where(F.col("batch_id") == batch_id).drop("batch_id")
        rows = enrich_opened(opened, ids.known(batch_id, parsing.opened_videos(opened)), as_of)
        write_batch(rows.profile_snapshots, f"{folder}/profile_snapshots", batch_id)
        write_batch(rows.videos, f"{folder}/videos", batch_id)
        write_batch(rows.video_snapshots, f"{folder}/video_snapshots", batch_id)
        write_batch(rows.parse_errors, f"{folder}/parse_errors", batch_id)
        write_batch(dedup.sighting_range(rows.sightings), f"{folder}/creator_sightings", batch_id)
        ids.add(batch_id, read_batches(spark, f"{folder}/videos", schemas.VIDEOS).where(F.col("batch_id") == batch_id))

    drain(raw, folder, write)


def stored_creators(spark: SparkSession, folder: str) -> DataFrame:
    """The creators table as all batches so far have it: earliest and latest sighting of each."""
    seen = read_batches(spark, f"{folder}/creator_sightings", _SEEN)
    return dedup.upsert_ranges(spark.createDataFrame([], schemas.CREATORS), dedup.merged_ranges(seen))


_FIRSTS = "query string, pos bigint, external_id string, handle string, follower_count bigint"


def enqueue_sightings(
    items: DataFrame, folder: str, rules: Rules, queue: DataFrame | None = None, as_of: Column | None = None
) -> DataFrame:
    """Author stream to pending queue rows, equal to the batch result in whatever order items arrive.

    A batch keeps the first item of each author and query. Reading takes the
    first of these over all batches, then the follower floor, then the first
    query of each creator. Creators with a pending row in ``queue`` get none;
    with ``as_of`` the rows are as the queue table stores them.
    """
    spark, path = items.sparkSession, f"{folder}/first_sightings"

    def write(batch: DataFrame, batch_id: int) -> None:
        firsts = first_occurrences(batch)
        write_batch(firsts.select(F.col("query"), F.col("pos").cast("long"), "external_id", "handle", "follower_count"), path, batch_id)

    drain(items.select("query", "pos", "item"), folder, write)
    firsts = dedup.first_per_key(read_batches(spark, path, _FIRSTS), ["query", "external_id"], [F.asc("pos")])
    standing = spark.createDataFrame([], "platform string, external_id string, status string") if queue is None else queue
    incoming = queue_candidates(qualified(firsts, rules), rules)
    fresh = dedup.enqueue(incoming, standing, [F.asc("query"), F.asc("pos")]).drop("query", "pos")
    return fresh if as_of is None else queue_rows(fresh, as_of)


_WINDOWS = "window_start timestamp, n bigint"


def arrival_counts(rows: DataFrame, folder: str, moment: str, span: str, step: str) -> DataFrame:
    """Arrivals per sliding window, with zero rows for silence between the first and last window.

    A batch writes the counts of its own rows and reading adds them up, so a
    row counts however late it comes.
    """
    spark, path = rows.sparkSession, f"{folder}/arrivals"

    def write(batch: DataFrame, batch_id: int) -> None:
        windows = batch.groupBy(F.window(moment, span, step).alias("w")).agg(F.count(F.lit(1)).alias("n"))
        write_batch(windows.select(F.col("w.start").alias("window_start"), "n"), path, batch_id)

    drain(rows, folder, write)
    counts = read_batches(spark, path, _WINDOWS).groupBy("window_start").agg(F.sum("n").alias("n"))
    return with_silent_windows(counts, step)


_PAIRS = "snapshot_id bigint, creator_id bigint, snapshot_date date, created_at timestamp, follower_count bigint"


def growth_updates(snapshots: DataFrame, folder: str, rules: Rules) -> DataFrame:
    """Growth per creator from a snapshot stream.

    A batch keeps the two newest snapshots of each creator it saw; the two
    newest of all are among these, whatever batch brought them.
    """
    spark, path = snapshots.sparkSession, f"{folder}/newest"
    columns = ["snapshot_id", "creator_id", "snapshot_date", "created_at", "follower_count"]

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_n(batch.select(*columns), ["creator_id"], snapshot_order(), 2), path, batch_id)

    drain(snapshots, folder, write)
    newest = read_batches(spark, path, _PAIRS).drop("batch_id")
    pair = latest_with_previous(newest, ["creator_id"], snapshot_order(), ["snapshot_date", "follower_count"])
    growth = S.growth(
        F.col("previous_follower_count"),
        F.col("previous_snapshot_date"),
        F.col("follower_count"),
        F.col("snapshot_date"),
        rules,
    )
    return pair.select("creator_id", "snapshot_date", growth.alias("growth_rate"))
