"""Start-end tables that are kept up to date by snapshots, in whatever order these come.

A history's state is its intervals. A new snapshot is one more day of every value it holds: it
extends an interval, opens one, or closes the gap between two, and a day inside an interval changes
nothing. So only the snapshot and the intervals are read, not the snapshots before, and a late
snapshot is as good as a new one.

A state is a folder of versions. Each has the snapshot dates in it; the dates are written last, so a
version that broke off is passed over and written again. Its intervals are tables beside the
versions: the merged one, and the days of up to ``UNMERGED`` calls after it as they came, which are
merged by whoever reads them. So not every call writes all intervals again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.operators.history import GAP_DAYS, merge_intervals
from rosterline.plans.histories import History

VERSION = "version="
MERGED, ADDED = "merged=", "added="

#: Calls whose days are held beside the merged intervals until the next call merges them.
UNMERGED = 6


def _folder(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions of a state, oldest first."""
    files, root = _folder(spark, path)
    if not files.exists(root):
        return []
    found = []
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/dates/_SUCCESS")
        if name.startswith(VERSION) and files.exists(done):
            found.append(int(name.removeprefix(VERSION)))
    return sorted(found)


def held_table(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table of the newest version, None before the first snapshot."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/{VERSION}{found[-1]}/{name}") if found else None


def _numbers(spark: SparkSession, path: str, mark: str) -> list[int]:
    """Numbers of the versions that have written a table ``mark``."""
    files, root = _folder(spark, path)
    names = [entry.getPath().getName() for entry in files.listStatus(root)]
    return sorted(int(name.removeprefix(mark)) for name in names if name.startswith(mark))


def _tables(spark: SparkSession, path: str, number: int) -> tuple[int | None, list[str]]:
    """The version that merged last, up to version ``number``, and the paths of the tables that
    make ``number``: what it merged and what was added since."""
    merged = max((n for n in _numbers(spark, path, MERGED) if n <= number), default=None)
    first = -1 if merged is None else merged
    added = [n for n in _numbers(spark, path, ADDED) if first < n <= number]
    held = [] if merged is None else [f"{path}/{MERGED}{merged}"]
    tables = held + [f"{path}/{ADDED}{n}" for n in added]
    # States once had their intervals inside the version's folder.
    return merged, tables or [f"{path}/{VERSION}{number}/intervals"]


def held_intervals(
    spark: SparkSession, path: str, history: History, gap_days: int = GAP_DAYS
) -> DataFrame | None:
    found = versions(spark, path)
    if not found:
        return None
    _, tables = _tables(spark, path, found[-1])
    held = spark.read.parquet(*tables)
    if len(tables) == 1 and tables[0].startswith(f"{path}/{MERGED}"):
        return held
    return merge_intervals(held, history.keys, *history.dates, gap_days)


def held_dates(spark: SparkSession, path: str) -> set[dt.date]:
    found = versions(spark, path)
    if not found:
        return set()
    dates = spark.read.parquet(f"{path}/{VERSION}{found[-1]}/dates")
    return {row[0] for row in dates.collect()}


def write_version(
    spark: SparkSession, path: str, name: str, table: DataFrame, dates: set[dt.date]
) -> None:
    """Write ``table`` and the snapshot dates in it as the next version; the newest and the one
    before it stay, all older ones go."""
    found = versions(spark, path)
    number = found[-1] + 1 if found else 0
    table.write.mode("overwrite").parquet(f"{path}/{VERSION}{number}/{name}")
    _write_dates(spark, path, found, dates)


def _write_dates(spark: SparkSession, path: str, found: list[int], dates: set[dt.date]) -> None:
    """End the version after those ``found``."""
    number = found[-1] + 1 if found else 0
    every = [(date,) for date in sorted(dates)]
    spark.createDataFrame(every, f"`{SNAPSHOT_DATE}` date").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/{VERSION}{number}/dates")
    files, _ = _folder(spark, path)
    for old in found[:-1]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}{old}"), True)


def with_snapshots(
    held: DataFrame | None, history: History, rows: DataFrame, gap_days: int = GAP_DAYS
) -> DataFrame:
    """The intervals after the snapshots in ``rows``; one shuffle of intervals and new values."""
    start, end = history.dates
    days = _days(history, rows)
    every = days if held is None else held.unionByName(days)
    return merge_intervals(every, history.keys, start, end, gap_days)


def _days(history: History, rows: DataFrame) -> DataFrame:
    """The values of the snapshots in ``rows`` as intervals of one day."""
    seen = history.seen(rows).where(F.col(SNAPSHOT_DATE).isNotNull())
    dates = [F.col(SNAPSHOT_DATE).alias(name) for name in history.dates]
    return seen.select(*history.keys, *dates)


def update_history(
    spark: SparkSession, path: str, history: History, rows: DataFrame, gap_days: int = GAP_DAYS
) -> list[dt.date]:
    """Take the snapshots in ``rows`` into the state at ``path``; the dates that were new.

    Dates that the state has are left out, so the same snapshot twice changes nothing. The version
    before stays until the next update, for readers that have begun.
    """
    known = held_dates(spark, path)
    # As many dates as there are snapshots in the call.
    dates = {row[0] for row in rows.select(SNAPSHOT_DATE).distinct().collect()} - {None}
    new = sorted(dates - known)
    if not new:
        return []
    fresh = rows.where(F.col(SNAPSHOT_DATE).isin(new))
    found = versions(spark, path)
    number = found[-1] + 1 if found else 0
    merged, tables = _tables(spark, path, found[-1]) if found else (None, [])
    files, _ = _folder(spark, path)

    def drop(name: str) -> None:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)

    for mark in (MERGED, ADDED):  # of a version that broke off
        drop(f"{mark}{number}")
    inside = any(f"/{VERSION}" in table.removeprefix(path) for table in tables)
    if gap_days == GAP_DAYS and not inside and len(tables) - (merged is not None) < UNMERGED:
        _days(history, fresh).write.parquet(f"{path}/{ADDED}{number}")
    else:
        held = spark.read.parquet(*tables) if tables else None
        with_snapshots(held, history, fresh, gap_days).write.parquet(f"{path}/{MERGED}{number}")
    _write_dates(spark, path, found, known | set(new))
    for mark in (MERGED, ADDED):  # of no version that stays
        for old in _numbers(spark, path, mark):
            if merged is not None and old < merged:
                drop(f"{mark}{old}")
    return new


def read_history(spark: SparkSession, path: str, history: History) -> DataFrame:
    """The start-end table of a state, as the functions in ``histories`` make it of all snapshots."""
    held = held_intervals(spark, path, history)
    if held is None:
        raise FileNotFoundError(f"no snapshot has been taken into {path}")
    return history.table(held)
