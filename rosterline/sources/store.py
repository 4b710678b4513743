"""Snapshot tables: parquet directories with one partition per snapshot date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.fixed import SNAPSHOT_DATE


#: Folder with the names of loaded files; readers of the store pass over names like this.
FILES = "_files"


def append_snapshot(
    df: DataFrame, path: str, date: dt.date | None = None, date_col: str = SNAPSHOT_DATE
) -> None:
    """Write the snapshots held in ``df``; a date that is already there is replaced.

    Rows stay in the tasks that read them: no shuffle, and each task writes the dates it holds.
    """
    stamped = df if date is None else df.withColumn(date_col, F.lit(date))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )


def snapshot_dates(
    spark: SparkSession, path: str, date_col: str = SNAPSHOT_DATE
) -> list[dt.date]:
    """Dates held by a store, oldest first, from directory names: no data file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(root)]
    mark = f"{date_col}="
    return sorted(dt.date.fromisoformat(n[len(mark) :]) for n in names if n.startswith(mark))


def read_store(spark: SparkSession, path: str, date_col: str = SNAPSHOT_DATE) -> DataFrame:
    """The whole store; columns of all snapshots, null where a snapshot lacks one.

    The schema is put together from one file per date, instead of merging every footer.
    """
    fields = {}
    for date in reversed(snapshot_dates(spark, path, date_col)):
        for field in spark.read.parquet(f"{path}/{date_col}={date.isoformat()}").schema:
            fields.setdefault(field.name, field.dataType.simpleString())
    columns = [f"`{name}` {kind}" for name, kind in fields.items() if name != date_col]
    schema = ", ".join([*columns, f"`{date_col}` date"])
    return spark.read.schema(schema).parquet(path)


def read_latest(spark: SparkSession, path: str, date_col: str = SNAPSHOT_DATE) -> DataFrame:
    """Newest snapshot only; the date is known from the listing, so one partition is scanned."""
    newest = snapshot_dates(spark, path, date_col)[-1]
    return read_store(spark, path, date_col).where(F.col(date_col) == F.lit(newest))


def loaded_files(spark: SparkSession, path: str) -> dict[str, dt.date]:
    """Files that the store has taken in, with their dates: a small table beside the dates."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FILES}")
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return {}
    rows = spark.read.schema(f"path string, `{SNAPSHOT_DATE}` date").parquet(f"{path}/{FILES}")
    return {row[0]: row[1] for row in rows.collect()}


def ingest_pending(
    spark: SparkSession,
    path: str,
    files: dict[str, dt.date],
    read: Callable[[SparkSession, list[str]], DataFrame],
) -> list[str]:
    """Load those of ``files`` (path -> snapshot date) that the store has not taken in yet.

    A date is replaced as a whole: with a new file, the files of its date that were loaded before
    are read again, so it makes no difference in how many calls they come. A file that is gone by
    then fails the load instead of losing its rows. The list of files is written last: a call that
    broke off is done again.
    """
    known = loaded_files(spark, path)
    todo = {p: date for p, date in files.items() if p not in known}
    if todo:
        dates = set(todo.values())
        every = [p for p, date in {**known, **files}.items() if date in dates]
        append_snapshot(read(spark, sorted(every)), path)
        rows = spark.createDataFrame(sorted(todo.items()), f"path string, `{SNAPSHOT_DATE}` date")
        rows.coalesce(1).write.mode("append").parquet(f"{path}/{FILES}")
    return sorted(todo)
