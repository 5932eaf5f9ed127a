"""Incremental driver: the batch plans applied to new listing documents as
they land in the details folder (Structured Streaming file source).

Each micro-batch runs ``plans.run.run_frames`` on the batch's documents with
the side feeds read as of that batch.  All sinks are keyed upserts (price
history included, keyed by its repeatable row id), so a micro-batch replayed
after a failure leaves the curated tables unchanged; the stream's progress
lives in the shared checkpoint folder.  No streaming state is kept: nothing
in the pipeline aggregates across batches.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.plans.run import FeedPaths, Sinks, ingest_details, prepare, run_frames
from feedlake.session import ensure_checkpoint_dir, stage
from feedlake.sources.feeds import SOURCE_FILE, require_key, split_rejects, with_corrupt_record


def start(spark: SparkSession, paths: FeedPaths, ref, run_date: str, sinks: Sinks | None = None,
          name: str = "listing_feed", available_now: bool = True, max_files_per_trigger: int | None = None,
          run_ts: str | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``available_now=True`` processes every file present at start in one or
    more micro-batches and stops (a scheduled incremental run); otherwise the
    query keeps polling the folder.
    """
    sinks = sinks or Sinks()
    lenient = paths.on_reject == "write"
    reader = (spark.readStream.schema(with_corrupt_record(schemas.DETAILS) if lenient else schemas.DETAILS)
              .option("multiLine", paths.multiline).option("mode", "PERMISSIVE" if lenient else "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    details = reader.json(paths.details)
    if lenient:
        details = details.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def per_batch(batch_df, epoch_id: int) -> None:
        feeds = prepare(spark, paths, skip=("details",))
        if lenient:
            landed = stage(batch_df, f"landed_{name}_{epoch_id}")
            rows, rejects = split_rejects(landed, "details", "id")
            feeds["rejects"] = feeds["rejects"].unionByName(rejects)
        else:
            rows = require_key(batch_df, "id", "details")
        feeds["details"] = ingest_details(rows)
        run_frames(spark, feeds, ref, run_date, sinks, tag=f"{name}_{epoch_id}", run_ts=run_ts)

    writer = details.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
