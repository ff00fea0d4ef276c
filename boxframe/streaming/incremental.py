"""Run the download (list -> copy -> manifest) incrementally over list files as they arrive.

No new operator: the file source with a checkpoint hands each new list file
to ``copy_objects`` exactly once; each micro-batch's manifest is written to
its own ``batch_id=N`` folder with overwrite, so a replayed batch after a
failure rewrites the same rows instead of appending duplicates. The
checkpoint is the caller's: a restart with another one would number its
batches from 0 again and overwrite manifests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxframe.operators.listing import parse_image_list
from boxframe.operators.transfer import copy_objects


def incremental_download(
    spark: SparkSession,
    list_dir: str,
    src_root: str,
    dst_root: str,
    manifest_path: str,
    checkpoint_location: str,
    ext: str = ".jpg",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    parsed = parse_image_list(reader.load(list_dir), "value")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        manifest = copy_objects(batch, src_root, dst_root, ext=ext)
        manifest.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{manifest_path.rstrip('/')}/batch_id={batch_id}"
        )

    w = parsed.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
