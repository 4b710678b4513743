"""Schemas out of file headers; names are never taken by position from another file."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from rosterline.functions.text import header_name


def header_schema(header: Iterable[str], date_suffix: str | None = "_date") -> StructType:
    """Nullable columns named after ``header``; dates by suffix, text otherwise.

    ``date_suffix=None`` makes every column text, as the side files are kept.
    """

    def kind(name: str) -> StringType | DateType:
        return DateType() if date_suffix and name.endswith(date_suffix) else StringType()

    names = [header_name(cell) for cell in header]
    return StructType([StructField(name, kind(name), True) for name in names])


def data_files(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """Files behind ``paths``, folders of part files opened: path -> name in file metadata."""
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", "_metadata.file_path")
    return {row[0]: row[1] for row in listed.collect()}


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, opened through Hadoop: no job, and no more than a buffer is read."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def with_line_breaks(spark: SparkSession, files: dict[str, str]) -> set[str]:
    """Files in which a quoted field goes over a line end: some line has an odd number of quotes.

    One scan of the text for all files, which splits freely; only names come back.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = spark.read.text(list(files)).where(quotes % 2 == 1).select("_metadata.file_path")
    found = {row[0] for row in odd.distinct().collect()}
    return {path for path, name in files.items() if name in found}


def files_by_header(
    spark: SparkSession, paths: Iterable[str], multi_line: bool | None = None
) -> dict[tuple[tuple[str, ...], bool], list[str]]:
    """Files by their own header line and by whether they need multi-line reading.

    Each group is one scan. ``multi_line`` settles the latter, None looks into the files.
    """
    files = data_files(spark, paths)
    broken = with_line_breaks(spark, files) if multi_line is None else set()
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda path: first_line(spark, path), files))
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path, line in zip(files, lines, strict=True):
        header = tuple(next(csv.reader([line]), ()))
        if header:  # a part file without rows may lack even the header
            groups.setdefault((header, multi_line or path in broken), []).append(path)
    return groups
