"""Snapshot tables in which every published file has a folder of its own.

A store has ``<date>/<file and load>`` folders and a list of files: where each came from, how long
it was, when it was last changed, which folder has its rows, and their schema. A late file of a
date adds its own rows, and a file that is published again under its old path replaces its own;
no other file is read, so files may leave the landing folder once they are in.

The list is written last and names the folders that count. A load that broke off leaves folders
that nobody reads; they go, like replaced ones, at the beginning of the next load, so readers that
have begun are not disturbed by the load that replaces what they read. Loads of one store take
turns. The list has a row for each file and load, which is what the driver holds of a store.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.sources.manifest import path_snapshot_date
from rosterline.sources.readers import SOURCE_FILE

#: Partition column of a file's rows, and the folder of the list.
FILE = "_file"
LIST = "_list"

# Columns of Spark's binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

_LIST_SCHEMA = "load int, path string, folder string, length bigint, changed string, schema string"

Reader = Callable[[SparkSession, list[str]], DataFrame]


class Published(NamedTuple):
    """A file as it lies in a landing folder; ``name`` is its path in file metadata."""

    path: str
    name: str
    length: int
    changed: str


class Held(NamedTuple):
    """A file as the store has it."""

    load: int
    path: str
    folder: str
    length: int
    changed: str
    schema: str


def published_files(spark: SparkSession, folder: str) -> list[Published]:
    """Files with a snapshot date in their names, below ``folder`` (a path or a pattern)."""
    listed = (
        spark.read.format("binaryFile")
        .schema(FILE_SCHEMA)
        .load(folder)
        .select(
            "path",
            F.col("_metadata.file_path").alias("name"),
            "length",
            F.col("modificationTime").cast("string").alias("changed"),
        )
        .where(path_snapshot_date(F.col("path")).isNotNull())
    )
    return sorted(Published(*row) for row in listed.collect())


def _folder(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def held_files(spark: SparkSession, store: str) -> dict[str, Held]:
    """The newest entry of every file in the store, by path."""
    files, root = _folder(spark, f"{store}/{LIST}")
    if not files.exists(root):
        return {}
    entries = spark.read.schema(_LIST_SCHEMA).parquet(f"{store}/{LIST}").collect()
    return {row.path: Held(*row) for row in sorted(entries, key=lambda row: row.load)}


def _folders(spark: SparkSession, store: str) -> dict[str, str]:
    """Folders with rows: name -> path, by one listing."""
    files, pattern = _folder(spark, f"{store}/{SNAPSHOT_DATE}=*/{FILE}=*")
    found = files.globStatus(pattern) or []
    paths = [entry.getPath() for entry in found]
    return {path.getName().removeprefix(f"{FILE}="): path.toString() for path in paths}


def _clear(spark: SparkSession, store: str, held: dict[str, Held]) -> None:
    """Delete the folders that do not count: replaced ones, and those of loads that broke off."""
    counted = {entry.folder for entry in held.values()}
    for name, path in _folders(spark, store).items():
        if name not in counted:
            files, root = _folder(spark, path)
            files.delete(root, True)


def _load(spark: SparkSession, store: str, batch: list[Published], number: int, read: Reader) -> None:
    token = uuid.uuid4().hex[:12]
    rows = read(spark, [file.path for file in batch])
    stamped = rows.withColumn(FILE, _named(F.col(SOURCE_FILE), token)).drop(SOURCE_FILE)
    # Rows stay in the tasks that read them; a task writes the few files that it holds.
    stamped.write.mode("append").partitionBy(SNAPSHOT_DATE, FILE).parquet(store)
    stored = StructType([f for f in stamped.schema if f.name not in (SNAPSHOT_DATE, FILE)])
    _enter(spark, store, batch, number, token, stored)


def _named(source: Column, token: str) -> Column:
    """Name of the folder for a file's rows of one load."""
    return F.concat(F.md5(source), F.lit(f"-{token}"))


def _enter(
    spark: SparkSession,
    store: str,
    batch: list[Published],
    number: int,
    token: str,
    stored: StructType,
) -> None:
    """Add the files of a load to the list, from when on their rows count."""
    entries = [(number, f.path, f.name, f.length, f.changed, stored.json()) for f in batch]
    named = spark.createDataFrame(entries, _LIST_SCHEMA).withColumn(
        "folder", _named(F.col("folder"), token)
    )
    named.coalesce(1).write.mode("append").parquet(f"{store}/{LIST}")


def ingest_files(
    spark: SparkSession,
    store: str,
    published: list[Published],
    read: Reader,
    files_per_load: int = 200,
) -> list[str]:
    """Load the files that are new, or have another length or time than those the store has.

    ``read`` gets paths and returns rows with their snapshot date and ``SOURCE_FILE``, as the
    readers do that are given ``source=True``. Files that the store has and ``published`` lacks
    stay in the store. A file without rows is held as well, and empties what it replaces.
    """
    held = held_files(spark, store)
    _clear(spark, store, held)
    todo = [
        file
        for file in published
        if file.path not in held
        or (held[file.path].length, held[file.path].changed) != (file.length, file.changed)
    ]
    number = max((entry.load for entry in held.values()), default=0)
    for start in range(0, len(todo), files_per_load):
        number += 1
        _load(spark, store, todo[start : start + files_per_load], number, read)
    return [file.path for file in todo]


def read_file_store(
    spark: SparkSession, store: str, since: dt.date | None = None
) -> DataFrame:
    """Rows of all files that count; columns of all, null where a file lacks one.

    Schemas come from the list, so no footer is read before the scan, and only folders of dates
    from ``since`` on are opened.
    """
    held = sorted(held_files(spark, store).values(), reverse=True)
    if not held:
        raise FileNotFoundError(f"no file has been taken into {store}")
    fields: dict[str, StructField] = {}
    for text in dict.fromkeys(entry.schema for entry in held):
        for field in StructType.fromJson(json.loads(text)):
            fields.setdefault(field.name, field)
    kinds = [StructField(SNAPSHOT_DATE, DateType()), StructField(FILE, StringType())]
    schema = StructType([*fields.values(), *kinds])
    counted = {entry.folder for entry in held}
    paths = [path for name, path in _folders(spark, store).items() if name in counted]
    if not paths:
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).option("basePath", store).parquet(*sorted(paths))
    if since is not None:
        rows = rows.where(F.col(SNAPSHOT_DATE) >= F.lit(since))
    return rows.drop(FILE)
