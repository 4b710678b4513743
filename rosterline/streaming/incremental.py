"""New files in a landing folder into a snapshot store, each file once.

The checkpoint remembers which files are done; a batch that is run again after a failure
replaces the dates it wrote, so nothing is loaded twice. A date is always written with all its
files, also those of other batches and of earlier calls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.sources.file_store import FILE_SCHEMA, ingest_files, published_files
from rosterline.sources.manifest import path_snapshot_date
from rosterline.sources.store import ingest_pending


def load_new_files(
    spark: SparkSession,
    folder: str,
    store: str,
    checkpoint: str,
    read: Callable[[SparkSession, list[str]], DataFrame],
    files_per_batch: int = 200,
) -> None:
    """Load all files that have come in since the last call, then return.

    The stream itself carries file names only; ``read`` opens them as one distributed scan per
    header. Files of one snapshot date may come in any number of batches and calls: the first
    batch that has one of them takes all that are in the folder, and a late file makes its date be
    loaded again. Files have to stay in the folder as long as late ones may come.
    """
    date = path_snapshot_date("path").alias(SNAPSHOT_DATE)

    def load(batch: DataFrame, _: int) -> None:
        dates = batch.select(date).distinct()
        here = spark.read.format("binaryFile").schema(FILE_SCHEMA).load(folder).select("path", date)
        files = {row[0]: row[1] for row in here.join(dates, SNAPSHOT_DATE).select("path", SNAPSHOT_DATE).collect()}
        ingest_pending(spark, store, files, read)

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )
    (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def load_changed_files(
    spark: SparkSession,
    folder: str,
    store: str,
    read: Callable[[SparkSession, list[str]], DataFrame],
    files_per_load: int = 200,
) -> list[str]:
    """Load the files of ``folder`` that are new or were published again, each by itself.

    A stream knows a file by its path and passes over one that has changed; here the store's own
    list says what is held. Files that have left the folder stay in the store.
    """
    return ingest_files(spark, store, published_files(spark, folder), read, files_per_load)
